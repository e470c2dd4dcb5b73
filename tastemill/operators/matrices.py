"""User-item cells, bounded histories and item-by-tag vectors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Items per history chunk: bounds the array one row can hold.
HISTORY_CHUNK = 4096


def user_item_cells(ratings: DataFrame) -> DataFrame:
    """Long sparse matrix; duplicate (user, item) cells are summed."""
    return ratings.groupBy("user_idx", "movie_idx").agg(F.sum("rating").alias("rating"))


def sparsity(cells: DataFrame, users: DataFrame, movies: DataFrame) -> DataFrame:
    """1 - nonzero / (users * movies), sizes from the lookups."""
    n_users = users.agg(F.count(F.lit(1))).scalar()
    n_movies = movies.agg(F.count(F.lit(1))).scalar()
    return (
        cells.agg(F.count_if(F.col("rating") != 0).alias("nnz"))
        .withColumns({"n_users": n_users, "n_movies": n_movies})
        .withColumn("sparsity", 1.0 - F.col("nnz") / (F.col("n_users").cast("double") * F.col("n_movies")))
    )


def user_histories(ratings: DataFrame, user: str = "userId", item: str = "movieId") -> DataFrame:
    """Each user's (item, rating) list in chunks of bounded size."""
    return (
        ratings.groupBy(user, F.floor(F.col(item) / HISTORY_CHUNK).alias("chunk"))
        .agg(F.sort_array(F.collect_list(F.struct(item, "rating"))).alias("history"))
    )


def genome_vectors(scores: DataFrame, movies: DataFrame) -> DataFrame:
    """(movie_idx, features): relevance per tag in tagId order for every item.

    No 1,128-column pivot: one aggregation packs each item's scores (as many
    as there are tags) sorted by tag. An item scored on all tags, the usual case,
    is that array as it is; others are looked up along the tag vocabulary. Items
    without scores get zeros. Of repeated (item, tag) scores the largest counts.
    """
    tags = scores.agg(F.array_sort(F.collect_set("tagId")).alias("t")).select("t").scalar()
    packed = (
        scores.join(movies, "movieId")
        .groupBy("movie_idx")
        .agg(F.sort_array(F.collect_set(F.struct("tagId", "relevance"))).alias("cells"))
        .withColumn("cells", F.filter("cells", lambda cell, at: F.coalesce(
            F.get("cells", at + 1)["tagId"] != cell["tagId"], F.lit(True)
        )))
    )
    joined = movies.select("movie_idx").join(packed, "movie_idx", "left").withColumn("tags", tags)
    by_tag = F.map_from_entries("cells")
    looked_up = F.transform(
        F.array(by_tag), lambda m: F.transform("tags", lambda t: F.coalesce(F.element_at(m, t), F.lit(0.0)))
    )[0]
    return joined.select(
        "movie_idx",
        F.when(F.col("cells").isNull(), F.array_repeat(F.lit(0.0), F.size("tags")))
        .when(F.size("cells") == F.size("tags"), F.col("cells.relevance"))
        .otherwise(looked_up).alias("features"),
    )


def coverage(features: DataFrame) -> DataFrame:
    """Items in all, and items whose vector sum is positive."""
    total = F.aggregate("features", F.lit(0.0), lambda a, x: a + x)
    return features.agg(
        F.count(F.lit(1)).alias("n_items"), F.count_if(total > 0).alias("n_covered")
    )
