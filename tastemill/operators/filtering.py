"""Activity filter, catalogue alignment, counts and table profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import MIN_MOVIE_RATINGS, MIN_USER_RATINGS, RELEVANCE_THRESHOLD


def rating_counts(ratings: DataFrame, key: str) -> DataFrame:
    return ratings.groupBy(key).agg(F.count(F.lit(1)).alias("n"))


def _keep_active(ratings: DataFrame, key: str, minimum: int) -> DataFrame:
    active = rating_counts(ratings, key).filter(F.col("n") >= minimum).select(key)
    return ratings.join(active, key, "left_semi")


def filter_ratings(
    ratings: DataFrame,
    min_user_ratings: int = MIN_USER_RATINGS,
    min_movie_ratings: int = MIN_MOVIE_RATINGS,
) -> DataFrame:
    """One pass, users first: movies are counted on what remains and users are
    not checked again."""
    users_kept = _keep_active(ratings, "userId", min_user_ratings)
    return _keep_active(users_kept, "movieId", min_movie_ratings)


def align_to_ratings(table: DataFrame, ratings: DataFrame, key: str = "movieId") -> DataFrame:
    """Rows of an item table whose item survives in the ratings."""
    return table.join(ratings.select(key).distinct(), key, "left_semi")


def ratings_profile(ratings: DataFrame) -> DataFrame:
    """Rows, distinct users, distinct movies.

    Two independent aggregations instead of a row-expanding double
    count(distinct); each is a partial aggregation on one narrow column.
    """
    users = ratings.groupBy("userId").agg(F.count(F.lit(1)).alias("n"))
    movies = ratings.select("movieId").distinct().agg(F.count(F.lit(1))).scalar()
    return users.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("n_ratings"),
        F.count(F.lit(1)).alias("n_users"),
    ).withColumn("n_movies", movies)


def filter_report(before: DataFrame, after: DataFrame) -> DataFrame:
    """Table profile before and after the activity filter."""
    return (
        ratings_profile(before).select(F.lit("before").alias("stage"), "*")
        .unionByName(ratings_profile(after).select(F.lit("after").alias("stage"), "*"))
    )


def relevant(ratings: DataFrame, item: str = "movie_idx", threshold: float = RELEVANCE_THRESHOLD) -> DataFrame:
    return ratings.filter((F.col("rating") >= threshold) & F.col(item).isNotNull())
