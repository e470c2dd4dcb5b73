"""Tag text per item and the leakage-safe variant."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Tags of 2^12 neighbouring user ids are joined in one task.
USER_RANGE_BITS = 12


def tag_chunks(tags: DataFrame) -> DataFrame:
    """(movieId, chunk, tag_text): all tags of an item in user, time, tag order, in numbered chunks.

    A chunk holds the tags of USER_RANGE_BITS neighbouring user ids, so the rows
    of a hot item are sorted on many tasks and never meet in one cell. Chunks of an
    item count from 0, without gaps; read in order they are the item's text.
    """
    ranges = tags.groupBy("movieId", F.shiftright("userId", USER_RANGE_BITS).alias("range")).agg(
        F.expr("listagg(tag, ' ') WITHIN GROUP (ORDER BY userId, timestamp, tag)").alias("tag_text")
    )
    # a row per item and range, and the texts do not take part in the numbering
    number = ranges.select("movieId", "range").withColumn(
        "chunk", F.row_number().over(Window.partitionBy("movieId").orderBy("range")) - 1)
    return ranges.join(number, ["movieId", "range"]).select("movieId", "chunk", "tag_text")


def join_chunks(chunks: DataFrame) -> DataFrame:
    """(movieId, user_tags_text): one cell per item, on request. Spark bounds a cell at 2 GB."""
    return chunks.groupBy("movieId").agg(F.expr("listagg(tag_text, ' ') WITHIN GROUP (ORDER BY chunk)").alias("user_tags_text"))


def concat_tags(tags: DataFrame) -> DataFrame:
    return join_chunks(tag_chunks(tags))


def train_only_tags(tags: DataFrame, train: DataFrame, items: DataFrame) -> DataFrame:
    """Tags whose (user, movie) is a training pair and whose movie is known."""
    return tags.join(train.select("userId", "movieId"), ["userId", "movieId"], "left_semi").join(
        items.select("movieId"), "movieId", "left_semi"
    )


def leakage_report(tags: DataFrame, train: DataFrame, items: DataFrame) -> DataFrame:
    """Catalogue tags, train-only tags, percent kept, items with rebuilt text."""
    catalogue = tags.join(items.select("movieId").distinct(), "movieId", "left_semi")
    pairs = train.select("userId", "movieId").distinct().withColumn("kept", F.lit(1))
    per_movie = (
        catalogue.join(pairs, ["userId", "movieId"], "left")
        .groupBy("movieId").agg(
            F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("kept"), F.lit(0)).alias("k")
        )
    )
    return per_movie.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("n_catalogue_tags"),
        F.coalesce(F.sum("k"), F.lit(0)).cast("bigint").alias("n_train_tags"),
        (F.sum("k") * 100.0 / F.sum("n")).alias("percent_kept"),
        F.count_if(F.col("k") > 0).alias("n_movies_rebuilt"),
    )


def train_only_items(items: DataFrame, tags: DataFrame, train: DataFrame) -> DataFrame:
    """Enriched items with the chunks (chunk, tag_text) of their training pairs' tags: a row per
    chunk, and one with nulls for an item without such tags."""
    chunks = tag_chunks(train_only_tags(tags, train, items))
    return items.drop("user_tags_text").join(chunks, "movieId", "left")
