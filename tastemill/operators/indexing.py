"""Contiguous 0-based ids in sorted order, and the joins that use them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .ranking import radix_rank

# Bits per radix level: a bucket holds at most 2^20 distinct ids.
_LEVEL_BITS = (40, 20)


def build_index(ids: DataFrame, key: str, out: str) -> DataFrame:
    """(key, out): ``out`` numbers the distinct ids in ascending order from 0."""
    # Written once: the level counts and the final rank both read the ids.
    distinct = cut_lineage(ids.select(F.col(key).cast("bigint").alias(key)).dropna().distinct())
    levels = [F.shiftright(F.col(key), bits) for bits in _LEVEL_BITS]
    ranked = radix_rank(distinct, [], levels, [key], "__rank")
    return ranked.select(key, (F.col("__rank") - 1).cast("int").alias(out))


def encode_ids(ratings: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(ratings with user_idx and movie_idx, user lookup, movie lookup)."""
    users = build_index(ratings, "userId", "user_idx")
    movies = build_index(ratings, "movieId", "movie_idx")
    return attach_index(attach_index(ratings, movies, "movieId"), users, "userId"), users, movies


def attach_index(df: DataFrame, lookup: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Id to index. The join strategy follows the measured size of the lookup;
    a hot id is split by the runtime skew-join rule."""
    return df.join(lookup, key, how)


def detach_index(df: DataFrame, lookup: DataFrame, idx: str) -> DataFrame:
    """Index back to id."""
    return df.join(lookup, idx)


def resolve_titles(items: DataFrame, order: str = "movie_idx") -> DataFrame:
    """(title, movie_idx): for duplicate titles the last row wins."""
    return (
        items.filter(F.col("movie_idx").isNotNull())
        .groupBy("title").agg(F.max_by("movie_idx", order).alias("movie_idx"))
    )


# Fixed value: title of an item that has none.
UNKNOWN_TITLE = "Unknown"


def attach_titles(df: DataFrame, items: DataFrame) -> DataFrame:
    """movie_idx to title, UNKNOWN_TITLE when there is none."""
    titles = items.filter(F.col("movie_idx").isNotNull()).select("movie_idx", "title")
    return df.join(titles, "movie_idx", "left").withColumn(
        "title", F.coalesce("title", F.lit(UNKNOWN_TITLE))
    )


def first_by_title(items: DataFrame, titles: DataFrame, order: str = "movieId") -> DataFrame:
    """Row of each requested title; the first match in source order wins."""
    cols = [c for c in items.columns if c != "title"]
    return (
        items.join(titles.select("title").distinct(), "title", "left_semi")
        .groupBy("title").agg(F.min_by(F.struct(*cols), order).alias("row"))
        .select("title", "row.*")
    )


def unresolved_titles(requests: DataFrame, items: DataFrame) -> DataFrame:
    return requests.join(items.select("title"), "title", "left_anti")
