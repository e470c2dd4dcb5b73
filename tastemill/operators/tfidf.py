"""Term counts, vocabulary pruning and TF-IDF in long form."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import TfidfParams
from ..functions.text import word_tokens
from ..session import cut_lineage
from .ranking import radix_rank

# Prefix lengths of the radix levels that number sorted labels.
_PREFIX_LENGTHS = (8, 12, 18, 26)


def english_stop_words() -> tuple[str, ...]:
    """Spark's own English list (needs a running session)."""
    from pyspark.ml.feature import StopWordsRemover

    return tuple(StopWordsRemover.loadDefaultStopWords("english"))


def term_counts(docs: DataFrame, doc: str, text: str) -> DataFrame:
    """(doc, term, tf) over whole texts; counted with map-side combining."""
    return (
        docs.select(F.col(doc).alias("doc"), F.explode(word_tokens(F.col(text))).alias("term"))
        .groupBy("doc", "term").agg(F.count(F.lit(1)).alias("tf"))
    )


def tag_term_counts(tags: DataFrame, index: DataFrame) -> DataFrame:
    """(doc, term, tf) straight from the tag rows of the indexed items: equal to
    counting in the concatenated tag text, without building it."""
    return term_counts(tags.join(index.select("movieId", "movie_idx"), "movieId"), "movie_idx", "tag")


def vocabulary(counts: DataFrame, n_docs, params: TfidfParams = TfidfParams()) -> DataFrame:
    """(term, df, total, term_idx) after document-frequency limits, keeping the
    ``max_features`` terms of highest total count (ties: term ascending).

    ``n_docs`` counts empty documents too. Bounded by ``max_features`` rows.
    """
    terms = counts.groupBy("term").agg(
        F.count(F.lit(1)).alias("df"), F.sum("tf").alias("total")
    )
    if params.stop_words:
        terms = terms.filter(~F.col("term").isin(*params.stop_words))
    kept = (
        terms.filter((F.col("df") >= params.min_df) & (F.col("df") <= F.lit(params.max_df) * n_docs))
        .orderBy(F.desc("total"), F.asc("term")).limit(params.max_features)
    )
    order = Window.partitionBy(F.lit(0)).orderBy("term")  # at most max_features rows
    return kept.withColumn("term_idx", F.row_number().over(order) - 1)


def tfidf(counts: DataFrame, vocab: DataFrame, n_docs, params: TfidfParams = TfidfParams()) -> DataFrame:
    """(doc, terms): per document the array of (term_idx, weight), L2-normalised.

    The join goes by the measured size of the vocabulary; one shuffle on the document
    packs its at most ``max_features`` weights and takes their norm.
    """
    tf = F.col("tf").cast("double")
    tf = 1.0 + F.log(tf) if params.sublinear_tf else tf
    idf = F.log((1.0 + F.col("n_docs")) / (1.0 + F.col("df"))) + 1.0
    weighted = (
        counts.join(vocab.select("term", "df", "term_idx"), "term")
        .withColumn("n_docs", n_docs)
        .select("doc", "term_idx", (tf * idf).alias("weight"))
    )
    packed = weighted.groupBy("doc").agg(
        F.sort_array(F.collect_list(F.struct("term_idx", "weight"))).alias("terms"),
        F.sqrt(F.sum(F.col("weight") * F.col("weight"))).alias("norm"),
    )
    return packed.select(
        "doc",
        F.transform(
            "terms", lambda c: F.struct(c["term_idx"].alias("term_idx"), (c["weight"] / F.col("norm")).alias("weight"))
        ).alias("terms"),
    )


def fit_tfidf(counts: DataFrame, docs: DataFrame, params: TfidfParams = TfidfParams()) -> tuple[DataFrame, DataFrame]:
    """(packed TF-IDF rows, vocabulary) with the document count of ``docs``.

    The counts are written once, so texts are tokenised once although fitting
    and weighting both need them; the vocabulary is fitted state.
    """
    n_docs = docs.agg(F.count(F.lit(1)).cast("double")).scalar()
    counts = cut_lineage(counts)
    vocab = cut_lineage(vocabulary(counts, n_docs, params))
    return tfidf(counts, vocab, n_docs, params), vocab


def binary_labels(labels: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Learned-vocabulary 0/1 encoding of (doc, label) rows.

    Returns (doc, terms with weight 1, one row per document) and
    (term, term_idx); indices follow the sorted labels. The vocabulary grows
    with the data, so neither its numbering nor the join is done in one task.
    """
    distinct = labels.dropna().distinct()
    vocab = number_terms(distinct.select(F.col("label").alias("term")).distinct())
    packed = (
        distinct.join(vocab, F.col("label") == F.col("term"))
        .groupBy("doc").agg(F.sort_array(F.collect_list(F.struct("term_idx", F.lit(1.0).alias("weight")))).alias("terms"))
    )
    return packed, vocab


def number_terms(terms: DataFrame) -> DataFrame:
    """(term, term_idx) in sorted order, ranked by growing prefixes."""
    levels = [F.substring("term", 1, length) for length in _PREFIX_LENGTHS]
    ranked = radix_rank(cut_lineage(terms), [], levels, ["term"], "__rank")
    return ranked.select("term", (F.col("__rank") - 1).cast("int").alias("term_idx"))
