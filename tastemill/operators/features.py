"""Vector-valued feature groups: DataFrame(movie_idx, features ARRAY<DOUBLE>)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import GENRES, NUMERICAL_FEATURES
from ..functions.text import as_list
from .ranking import exact_median


def multi_hot(labels: Column, vocabulary: Sequence[str]) -> Column:
    """0/1 per vocabulary value; other values and null lists count as nothing."""
    known = F.coalesce(labels, F.array().cast("array<string>"))
    vocab = F.array(*[F.lit(g) for g in vocabulary])
    return F.transform(vocab, lambda g: F.when(F.array_contains(known, g), 1.0).otherwise(0.0))


def genres(items: DataFrame, vocabulary: Sequence[str] = GENRES) -> DataFrame:
    return items.select("movie_idx", multi_hot(as_list(items, "genres_list"), vocabulary).alias("features"))


def scale_column(df: DataFrame, column: str) -> Column:
    """Median fill, then min-max to [0, 1]; a zero range, or a column without
    any value, gives 0.

    Median, minimum and maximum are one-row subqueries, not joins.
    """
    value = F.col(column).cast("double")
    bounds = df.agg(F.struct(F.min(value).alias("lo"), F.max(value).alias("hi")).alias("b")).scalar()
    filled = F.coalesce(value, exact_median(df, column).scalar())
    span = bounds["hi"] - bounds["lo"]
    return F.when(span > 0, (filled - bounds["lo"]) / span).otherwise(0.0)


def scaled(items: DataFrame, columns: Sequence[str]) -> DataFrame:
    return items.select("movie_idx", F.array(*[scale_column(items, c) for c in columns]).alias("features"))


def year(items: DataFrame) -> DataFrame:
    return scaled(items, ["year"])


def numerical(items: DataFrame, columns: Sequence[str] = NUMERICAL_FEATURES) -> DataFrame:
    """The available numeric columns; none available gives one zero column."""
    present = [c for c in columns if c in items.columns]
    return scaled(items, present) if present else empty(items)


def empty(items: DataFrame) -> DataFrame:
    return items.select("movie_idx", F.array(F.lit(0.0)).alias("features"))


def align(features: DataFrame, index: DataFrame) -> DataFrame:
    """One row per indexed item; items without a vector get zeros.

    Vectors are many times larger than the files they come from: they are never broadcast.
    """
    dims = F.coalesce(features.agg(F.max(F.size("features"))).scalar(), F.lit(1))
    return index.select("movie_idx").join(features.hint("merge"), "movie_idx", "left").withColumn(
        "features", F.coalesce("features", F.array_repeat(F.lit(0.0), dims))
    )


def dense(embeddings: DataFrame, index: DataFrame) -> DataFrame:
    """Given text embeddings; items without text (no row) get zeros."""
    vectors = embeddings.select("movie_idx", F.col("features").cast("array<double>").alias("features"))
    return align(vectors, index)


def encode_text(items: DataFrame, text: str, make_encoder, batch_size: int = 64) -> DataFrame:
    """Embeddings by a user-supplied encoder: ``make_encoder()`` is called once
    per task and returns a function from a list of texts to a list of vectors.
    Missing text gets no row, hence a zero vector after alignment."""
    def run(batches):
        encoder = make_encoder()
        for pdf in batches:
            for lo in range(0, len(pdf), batch_size):
                part = pdf.iloc[lo : lo + batch_size]
                vectors = [[float(x) for x in v] for v in encoder(part["text"].tolist())]
                yield part[["movie_idx"]].assign(features=vectors)

    present = items.select("movie_idx", F.col(text).alias("text")).filter(F.length("text") > 0)
    schema = f"movie_idx {present.schema['movie_idx'].dataType.simpleString()}, features ARRAY<DOUBLE>"
    return present.mapInPandas(run, schema)


def unit(vec: Column, weight: float = 1.0) -> Column:
    """L2-normalised vector times a weight; a zero vector stays zero.

    The outer one-element transform binds the factor, so it is computed once per
    vector and not once per element.
    """
    norm = F.sqrt(F.aggregate(vec, F.lit(0.0), lambda a, x: a + x * x))
    factor = F.when(norm == 0, 0.0).otherwise(F.lit(float(weight)) / norm)
    return F.transform(F.array(factor), lambda f: F.transform(vec, lambda x: x * f))[0]


def combine(groups: Sequence[tuple[DataFrame, float]], index: DataFrame) -> DataFrame:
    """Concatenate weighted, row-normalised groups, aligned to the index: one union and one grouping
    by item, however many groups there are. Missing vectors are zeros of the group's width."""
    none = F.array().cast("array<double>")
    rows = index.select("movie_idx", F.lit(-1).alias("g"), none.alias("vec"))
    for i, (df, weight) in enumerate(groups):
        rows = rows.union(df.select("movie_idx", F.lit(i), unit(F.col("features").cast("array<double>"), weight)))
    of = {i: F.max(F.when(F.col("g") == i, F.col("vec"))).alias(f"g{i}") for i in range(-1, len(groups))}
    wide = rows.groupBy("movie_idx").agg(*of.values()).where("`g-1` IS NOT NULL")
    widths = [F.coalesce(df.agg(F.max(F.size("features"))).scalar(), F.lit(1)) for df, _ in groups]
    parts = [F.coalesce(f"g{i}", F.array_repeat(F.lit(0.0), width)) for i, width in enumerate(widths)]
    return wide.select("movie_idx", F.concat(*parts).alias("features"))
