"""Queries: feature groups, TF-IDF, SVD and the nine model recipes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import DIRECTOR_COMPONENTS, TAGS_COMPONENTS, TfidfParams
from ..functions import metadata, text
from ..operators import features, indexing, matrices, similarity, svd, tfidf
from ..session import cut_lineage
from ..sources import tables
from ..sources.driver_views import VIEW_GENRES, Views, with_views
from . import prepare
from .queries_recommend import NEIGHBOURS, r6
from .registry import register
from .specs import SPECS, FeatureGroups


def _items(v: Views):
    index = indexing.build_index(v.movies_raw, "movieId", "movie_idx")
    return tables.preprocess_movies(v.movies_raw).join(index, "movieId")


def _full_items(v: Views):
    """Enriched items as a written table: feature groups read it many times."""
    index = cut_lineage(indexing.build_index(v.movies_raw, "movieId", "movie_idx"))
    return cut_lineage(prepare.enrich_items(
        tables.preprocess_movies(v.movies_raw), index, tables.type_links(v.links_raw),
        metadata.flatten(v.metadata_raw),
    ))


_GENRE_LIST = ", ".join(f"'{g}'" for g in VIEW_GENRES)
_ITEM_CTES = {
    "items": "SELECT *, CAST(row_number() OVER (ORDER BY movieId) - 1 AS INT) AS movie_idx FROM movies_pre",
    "filled": "SELECT movie_idx, coalesce(year, (SELECT median(year) FROM items))::DOUBLE AS y FROM items",
    "yb": "SELECT min(y) AS lo, max(y) AS hi FROM filled",
    "fg": f"SELECT movie_idx, list_transform([{_GENRE_LIST}], lambda g: CASE WHEN list_contains(genres_list, g) THEN 1.0::DOUBLE ELSE 0.0 END) AS g FROM items",
    "fy": "SELECT movie_idx, [CASE WHEN hi = lo THEN 0.0::DOUBLE ELSE (y - lo) / (hi - lo) END] AS y FROM filled, yb",
}


def _digits(vec: str):
    return F.array_join(F.transform(vec, lambda x: F.round(x * 1000000).cast("bigint").cast("string")), "|")


_MICRO = "array_to_string(list_transform({0}, lambda x: CAST(CAST(round(x * 1000000) AS BIGINT) AS VARCHAR)), '|')"


@register("f2_genres_multihot", with_views(["movies_pre"], f"SELECT movie_idx, {_MICRO.format('g')} AS features FROM fg", _ITEM_CTES))
def f2_genres_multihot(v):
    return features.genres(_items(v), VIEW_GENRES).select("movie_idx", _digits("features").alias("features"))


@register("f3_year_scaled", with_views(["movies_pre"], "SELECT movie_idx, round(y[1], 6) AS year_scaled FROM fy", _ITEM_CTES))
def f3_year_scaled(v):
    return features.year(_items(v)).select("movie_idx", F.round(F.col("features")[0], 6).alias("year_scaled"))


@register("a15_median", with_views(["metadata"], """
SELECT median(runtime_min)::DOUBLE AS runtime_median, round(median(vote_average), 6) AS vote_median FROM metadata"""))
def a15_median(v):
    from ..operators.ranking import exact_median

    flat = metadata.flatten(v.metadata_raw)
    return exact_median(flat, "runtime_min").select(F.col("median").alias("runtime_median")).withColumn(
        "vote_median", F.round(exact_median(flat, "vote_average").scalar(), 6)
    )


@register("f9_numeric_scaled", with_views(["movies", "links", "metadata"], """
SELECT movieId, round((coalesce(r, rm) - r0) / (r1 - r0), 6) AS runtime_scaled, round((coalesce(va, vm) - v0) / (v1 - v0), 6) AS vote_scaled
FROM j, (SELECT median(r) AS rm, min(r) AS r0, max(r) AS r1, median(va) AS vm, min(va) AS v0, max(va) AS v1 FROM j)""",
    {"j": "SELECT movieId, CAST(runtime_min AS DOUBLE) AS r, vote_average AS va FROM movies LEFT JOIN links USING (movieId) LEFT JOIN metadata USING (tmdbId)"}))
def f9_numeric_scaled(v):
    items = (
        v.movies_raw.join(tables.type_links(v.links_raw), "movieId", "left")
        .join(metadata.flatten(v.metadata_raw), "tmdbId", "left").withColumnRenamed("movieId", "movie_idx")
    )
    return features.numerical(items, ("runtime_min", "vote_average")).select(
        F.col("movie_idx").alias("movieId"), F.round(F.col("features")[0], 6).alias("runtime_scaled"), F.round(F.col("features")[1], 6).alias("vote_scaled")
    )


_UNIT = "list_transform({v}, lambda x: x / CASE WHEN {n} = 0 THEN 1 ELSE {n} END * {w}::DOUBLE)"


def _unit_sql(v: str, w: float) -> str:
    return _UNIT.format(v=v, n=f"sqrt(list_sum(list_transform({v}, lambda z: z * z)))", w=w)


_EMBED = {
    "ev": """SELECT movie_idx, coalesce(CAST(embedding AS DOUBLE[]), list_transform(range(64), lambda i: 0.0::DOUBLE)) AS e
        FROM items LEFT JOIN embeddings ON vec_id = movieId""",
    "gen": """SELECT movie_idx, coalesce(list_transform(CAST(embedding AS DOUBLE[]), lambda x: round((x + 1) / 2, 6)),
        list_transform(range(64), lambda i: 0.0::DOUBLE)) AS gv FROM items LEFT JOIN embeddings ON vec_id = movieId""",
}


@register("f6_dense_embedding", with_views(["movies_pre"], f"SELECT movie_idx, {_MICRO.format('e')} AS features FROM ev", {**_ITEM_CTES, **_EMBED}))
def f6_dense_embedding(v):
    return features.dense(v.embeddings, _items(v)).select("movie_idx", _digits("features").alias("features"))


def _nudged(vec: str):
    """Millionths, nudged off the halves that two engines round differently."""
    return F.array_join(F.transform(vec, lambda x: F.round(x * 1000000 + 3e-4).cast("bigint").cast("string")), "|")


@register("f10_combined", with_views(["movies_pre"], f"""
SELECT movie_idx, array_to_string(list_transform(list_concat(list_concat({_unit_sql('gv', 1.0)}, {_unit_sql('g', 0.5)}), {_unit_sql('y', 0.2)}),
  lambda x: CAST(CAST(round(x * 1000000 + 3e-4) AS BIGINT) AS VARCHAR)), '|') AS features
FROM gen JOIN fg USING (movie_idx) JOIN fy USING (movie_idx)""", {**_ITEM_CTES, **_EMBED}))
def f10_combined(v):
    return _groups(v).combined(SPECS["cb3"]).select("movie_idx", _nudged("features").alias("features"))


# --- TF-IDF on whole documents -------------------------------------------------

_WORDS = {
    "tok": r"SELECT doc_id, unnest(regexp_extract_all(lower(text), '([\p{L}\p{N}_]{2,})', 1)) AS term FROM documents",
    "tf": "SELECT doc_id, term, count(*) AS tf FROM tok GROUP BY ALL",
    "vocab": """SELECT term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS total FROM tf GROUP BY term
        HAVING count(*) >= 2 AND count(*) <= 0.95::DOUBLE * (SELECT count(*) FROM documents)
        ORDER BY total DESC, term LIMIT 5000""",
    "w": """SELECT doc_id, term, (1 + ln(tf)) * (ln((1.0::DOUBLE + (SELECT count(*) FROM documents)) / (1.0::DOUBLE + df)) + 1) AS w
        FROM tf JOIN vocab USING (term)""",
}


def _with(ctes: dict[str, str], body: str) -> str:
    return "WITH " + ",\n".join(f"{n} AS ({s})" for n, s in ctes.items()) + body


def _doc_counts(v):
    return tfidf.term_counts(v.documents, "doc_id", "text")


@register("f12_tokens", _with({k: _WORDS[k] for k in ("tok", "tf")}, " SELECT doc_id, term, tf FROM tf"))
def f12_tokens(v):
    return _doc_counts(v).withColumnRenamed("doc", "doc_id")


@register("f13_vocabulary", _with({k: _WORDS[k] for k in ("tok", "tf", "vocab")}, """
SELECT term, df, total, row_number() OVER (ORDER BY term) - 1 AS term_idx FROM vocab"""))
def f13_vocabulary(v):
    n = v.documents.agg(F.count(F.lit(1)).cast("double")).scalar()
    return tfidf.vocabulary(_doc_counts(v), n)


@register("f14_tfidf", _with(_WORDS, """
SELECT doc_id, term, round(w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)), 6) AS weight FROM w"""))
def f14_tfidf(v):
    rows, vocab = tfidf.fit_tfidf(_doc_counts(v), v.documents)
    cells = rows.select("doc", F.explode("terms").alias("c")).select("doc", "c.*")
    named = cells.join(vocab.select("term", "term_idx"), "term_idx")
    return named.select(F.col("doc").alias("doc_id"), "term", F.round("weight", 6).alias("weight"))


@register("f15_binary_labels", with_views(["metadata"], """
SELECT tmdbId, label, CAST(dense_rank() OVER (ORDER BY label) - 1 AS INT) AS term_idx, 1.0::DOUBLE AS weight FROM lab""", {"lab": """
SELECT tmdbId, 'dir_' || replace(lower(director), ' ', '_') AS label FROM metadata WHERE director IS NOT NULL
  UNION SELECT tmdbId, 'cast_' || replace(lower(c), ' ', '_') FROM
    (SELECT tmdbId, unnest(string_split(cast_names, '|')[1:3]) AS c FROM metadata WHERE cast_names <> '')"""}))
def f15_binary_labels(v):
    flat = metadata.flatten(v.metadata_raw)
    director = flat.select(F.col("tmdbId").alias("doc"), text.token("dir_", F.col("director")).alias("label"))
    cast = flat.select(F.col("tmdbId").alias("doc"), F.explode(text.first_n(F.col("cast"), 3)).alias("c")).select(
        "doc", text.token("cast_", F.col("c")).alias("label")
    )
    rows, vocab = tfidf.binary_labels(director.unionByName(cast))
    cells = rows.select("doc", F.explode("terms").alias("c")).select("doc", "c.*")
    return cells.join(vocab, "term_idx").select(F.col("doc").alias("tmdbId"), F.col("term").alias("label"), "term_idx", "weight")


# --- SVD -----------------------------------------------------------------------

SVD_K = TAGS_COMPONENTS


def _doc_svd(v):
    """TF-IDF of the whole documents on 20 components."""
    rows, vocab = tfidf.fit_tfidf(_doc_counts(v), v.documents)
    rows = cut_lineage(rows)
    return rows, svd.truncated_svd(rows, vocab.count(), SVD_K)


def _power_ctes(rounds: int = 40) -> dict[str, str]:
    """The largest singular value of the TF-IDF rows by power iteration, one CTE pair a round."""
    ctes = {**_WORDS, "x": "SELECT doc_id, term, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS w FROM w", "v0": "SELECT term, 1.0::DOUBLE AS v FROM vocab"}
    for k in range(rounds):
        ctes[f"y{k}"] = f"SELECT doc_id, sum(w * v) AS y FROM x JOIN v{k} USING (term) GROUP BY doc_id"
        ctes[f"z{k}"] = f"SELECT term, sum(w * y) AS z FROM x JOIN y{k} USING (doc_id) GROUP BY term"
        ctes[f"v{k + 1}"] = f"SELECT term, z / (SELECT sqrt(sum(z * z)) FROM z{k}) AS v FROM z{k}"
    last = rounds - 1
    ctes["top"] = f"SELECT sqrt(sum(v{last}.v * z)) AS top FROM v{last} JOIN z{last} USING (term)"
    return ctes


@register("f16_svd_gram", _with(_power_ctes(), f"""
SELECT component, CASE WHEN component = 0 THEN round(top, 4) END AS largest, true AS norm_is_value, true AS descending, true AS orthogonal
FROM (SELECT unnest(range(least({SVD_K}, (SELECT count(*) FROM vocab)))) AS component), top"""))
def f16_svd_gram(v):
    """The projection's columns: their norms are the singular values, they fall, and neighbours are orthogonal; the largest value itself."""
    _, result = _doc_svd(v)
    values = F.array(*[F.lit(float(s)) for s in result.singular_values])
    sums = svd.component_sums(result.projected).select(F.col("c").alias("component"), F.sqrt("q").alias("norm"), "cross")
    value, top = values[F.col("component")], F.lit(float(result.singular_values[0]))
    return sums.select(
        F.col("component").cast("bigint").alias("component"), F.when(F.col("component") == 0, F.round("norm", 4)).alias("largest"),
        (F.abs(F.col("norm") - value) <= 1e-6 * top).alias("norm_is_value"),
        F.coalesce(F.get(values, F.col("component") + 1) <= value, F.lit(True)).alias("descending"), (F.abs("cross") <= 1e-6 * top * top).alias("orthogonal"))


@register("f17_explained_variance", _with({k: _power_ctes(0)[k] for k in (*_WORDS, "x")}, """
SELECT round(sum(q / n - (s / n) * (s / n)), 6) AS original_variance, true AS is_share, true AS grows
FROM (SELECT term, sum(w) AS s, sum(w * w) AS q FROM x GROUP BY term), (SELECT count(*)::DOUBLE AS n FROM documents)"""))
def f17_explained_variance(v):
    """Share of the variance that the components keep: between 0 and 1, and more than half of the components keep; with the variance itself."""
    rows, result = _doc_svd(v)
    n = v.documents.agg(F.count(F.lit(1))).scalar()
    # written, a row per term and per component: the rows are projected and their cells added up once
    terms, parts = cut_lineage(svd.term_sums(rows)), cut_lineage(svd.component_sums(result.projected))
    whole = svd.total_variance(terms, n).select("v")
    share, fewer = (svd.total_variance(c, n).scalar() / whole.scalar() for c in (parts, parts.where(F.col("c") < SVD_K // 2)))
    return whole.select(F.round("v", 6).alias("original_variance"), share.between(0.0, 1.0).alias("is_share"), (fewer < share).alias("grows"))


@register("f18_component_cap", with_views(["movies", "links", "metadata"], f"""
SELECT least({DIRECTOR_COMPONENTS}, (SELECT count(DISTINCT director) FROM links JOIN metadata USING (tmdbId)) - 1) AS components,
  (SELECT count(*) FROM movies) AS n_items"""))
def f18_component_cap(v):
    """Director group of the test tables: components are capped by its vocabulary."""
    items = v.movies_raw.join(tables.type_links(v.links_raw), "movieId").join(metadata.flatten(v.metadata_raw), "tmdbId", "left")
    groups = FeatureGroups(items.withColumnRenamed("movieId", "movie_idx"))
    return groups.get("director").groupBy(F.size("features").alias("components")).agg(F.count(F.lit(1)).alias("n_items"))


# --- recipes -------------------------------------------------------------------


def _groups(v: Views) -> FeatureGroups:
    items = _full_items(v)
    index = items.select("movieId", "movie_idx")
    return FeatureGroups(
        items,
        genome=matrices.genome_vectors(v.genome_scores, index),
        embeddings=v.embeddings.withColumnRenamed("movie_idx", "movieId").join(index, "movieId").select("movie_idx", "features"),
        tags=tables.clean_tags(v.tags_raw),
        genre_vocabulary=VIEW_GENRES,
    )


_CB_SQL = {
    "cb1": _unit_sql("gv", 1.0),
    "cb2": f"list_concat({_unit_sql('g', 1.0)}, {_unit_sql('y', 1.0)})",
    "cb3": f"list_concat(list_concat({_unit_sql('gv', 1.0)}, {_unit_sql('g', 0.5)}), {_unit_sql('y', 0.2)})",
    "cb6": _unit_sql("e", 1.0),
}


def _cb_oracle(name: str) -> str | None:
    if name not in _CB_SQL:
        return None
    return with_views(["movies_pre"], f"""
SELECT movie_idx, rank, neighbour_idx, round(score + 3e-11, 6) + 0.0 AS score FROM
(SELECT a.movie_idx, b.movie_idx AS neighbour_idx,
   round(CASE WHEN a.n = 0 OR b.n = 0 THEN 0 ELSE list_dot_product(a.v, b.v) / a.n / b.n END, 10) AS score,
   row_number() OVER (PARTITION BY a.movie_idx ORDER BY score DESC, b.movie_idx) AS rank
 FROM vec a JOIN vec b ON a.movie_idx <> b.movie_idx QUALIFY rank <= {NEIGHBOURS})""", {
        **_ITEM_CTES, **_EMBED,
        "v0": f"SELECT movie_idx, {_CB_SQL[name]} AS v FROM gen JOIN fg USING (movie_idx) JOIN fy USING (movie_idx) JOIN ev USING (movie_idx)",
        "vec": "SELECT movie_idx, v, sqrt(list_dot_product(v, v)) AS n FROM v0",
    })


def _cb_query(name: str):
    def body(v):
        vectors = cut_lineage(_groups(v).combined(SPECS[name]))
        found = similarity.neighbours(vectors, NEIGHBOURS, SPECS[name].metric)
        return found.select("movie_idx", "rank", "neighbour_idx", r6("score").alias("score"))

    body.__doc__ = f"{NEIGHBOURS} neighbours of every item under recipe {name}."
    return body


for _name in SPECS:
    register(f"{_name}_topk", _cb_oracle(_name))(_cb_query(_name))


_LEARNED = ("cb4", "cb5", "cb7", "cb8", "cb9")


@register("cb_lists", with_views(["movies_pre"], f"""
SELECT model, movie_idx, rank, true AS in_order, true AS other_item, true AS on_scale FROM
(SELECT unnest({list(_LEARNED)}) AS model), (SELECT movie_idx FROM items),
(SELECT unnest(range(1, 1 + least({NEIGHBOURS}, (SELECT count(*) FROM items) - 1))) AS rank)""", _ITEM_CTES))
def cb_lists(v):
    """Neighbour lists of the recipes with learned components, on shared groups: complete, in order, without the item itself, cosines."""
    groups = _groups(v)
    found = []
    for name in _LEARNED:
        lists = similarity.neighbours(cut_lineage(groups.combined(SPECS[name])), NEIGHBOURS, SPECS[name].metric)
        before = F.lag("score").over(Window.partitionBy("movie_idx").orderBy("rank"))  # a list has at most NEIGHBOURS rows
        found.append(lists.select(
            F.lit(name).alias("model"), F.col("movie_idx").cast("bigint").alias("movie_idx"), F.col("rank").cast("bigint").alias("rank"),
            F.coalesce(F.col("score") <= before, F.lit(True)).alias("in_order"), (F.col("movie_idx") != F.col("neighbour_idx")).alias("other_item"),
            F.col("score").between(-1.0, 1.0).alias("on_scale")))
    return reduce(DataFrame.unionByName, found)
