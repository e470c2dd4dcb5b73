"""Taste profiles: what the liked items of each user have in common."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import RELEVANCE_THRESHOLD
from ..functions import text
from .ranking import top_per_group

# List lengths of the profile and the word rule.
TOP_VALUES = 5
TOP_WORDS = 125
MIN_WORD_COUNT = 2


def liked_items(ratings: DataFrame, items: DataFrame, threshold: float = RELEVANCE_THRESHOLD) -> DataFrame:
    """Item rows each user rated at least ``threshold``."""
    return ratings.filter(F.col("rating") >= threshold).select("user_id", "movie_idx").join(items, "movie_idx")


def item_values(items: DataFrame, tags: DataFrame | None = None) -> DataFrame:
    """(movie_idx, kind, value, n): genres, cast, director and long tag words of
    each item, counted per item before any user is involved. Tag words come from
    the rows of ``tags`` (movie_idx, tag), or else from a text column."""
    cells = []
    for kind, column in (("genre", "genres_list"), ("cast", "cast")):
        if column in items.columns:
            cells.append(_cells(kind, text.as_list(items, column)))
    if "director" in items.columns:
        cells.append(_cells("director", F.array_compact(F.array("director"))))
    if tags is None and "user_tags_text" in items.columns:
        cells.append(_cells("tag", text.long_words(F.col("user_tags_text"))))
    parts = []
    if cells:  # one pass over the items, whose columns may be costly
        parts.append(items.select("movie_idx", F.explode(F.concat(*cells)).alias("c")).select("movie_idx", "c.*", F.lit(1).cast("bigint").alias("n")))
    if tags is not None:  # equal tags of an item are split into words once
        counted = tags.groupBy("movie_idx", "tag").agg(F.count(F.lit(1)).alias("n"))
        words = F.explode(text.long_words(F.col("tag")))
        parts.append(counted.select("movie_idx", F.lit("tag").alias("kind"), words.alias("value"), "n"))
    values = reduce(DataFrame.unionByName, parts)
    return values.groupBy("movie_idx", "kind", "value").agg(F.sum("n").alias("n"))


def _cells(kind: str, values):
    """Array of (kind, value); empty for a null array."""
    cells = F.transform(values, lambda x: F.struct(F.lit(kind).alias("kind"), x.cast("string").alias("value")))
    return F.coalesce(cells, F.array().cast("array<struct<kind:string,value:string>>"))


def taste_profile(
    ratings: DataFrame, items: DataFrame, threshold: float = RELEVANCE_THRESHOLD,
    top: int = TOP_VALUES, top_words: int = TOP_WORDS, tags: DataFrame | None = None,
) -> DataFrame:
    """(user_id, kind, rank, value, n): top values per user and kind. Tag words
    are cut to the top ones first and then need a count above one."""
    liked = ratings.filter(F.col("rating") >= threshold).select("user_id", "movie_idx")
    # dealt out once: neither the sums nor the ranks move the values of all liked items again
    counted = (
        liked.join(item_values(items, tags), "movie_idx").repartition("user_id", "kind")
        .groupBy("user_id", "kind", "value").agg(F.sum("n").alias("n"))
    )
    ranked = top_per_group(counted, ["user_id", "kind"], [F.desc("n"), F.asc("value")], max(top, top_words))
    is_tag = F.col("kind") == "tag"
    return ranked.filter(
        (is_tag & (F.col("rank") <= top_words) & (F.col("n") >= MIN_WORD_COUNT)) | (~is_tag & (F.col("rank") <= top))
    )
