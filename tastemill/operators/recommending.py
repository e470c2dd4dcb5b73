"""Top-N recommendations for all users of a ratings table in one job."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import HOT_USER_ROWS, HOT_USER_SALT, N_RECOMMENDATIONS
from ..session import cut_lineage
from . import tiles
from .indexing import attach_titles, resolve_titles
from .similarity import check_metric, check_strategy


def rating_weights(ratings: DataFrame, strategy: str = "mean_centering") -> DataFrame:
    """Add ``weight``: share of the rating sum (the rating itself where the sum is 0), or distance from the user's mean
    (1/n when all ratings are equal).

    Per-user statistics come from a partial aggregation and are joined back, so
    a hot user is split by the skew-join rule instead of filling one window.
    """
    check_strategy(strategy)
    stats = ratings.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("__n"), F.sum("rating").alias("__sum"),
        F.min("rating").alias("__lo"), F.max("rating").alias("__hi"),
    )
    if strategy == "weighted":
        weight = F.when(F.col("__sum") == 0, F.col("rating")).otherwise(F.col("rating") / F.col("__sum"))
    else:
        weight = F.when(F.col("__lo") == F.col("__hi"), 1.0 / F.col("__n")).otherwise(
            F.col("rating") - F.col("__sum") / F.col("__n")
        )
    return ratings.join(stats.hint("merge"), "user_id").withColumn("weight", weight).drop("__n", "__sum", "__lo", "__hi")


def _vectors(features: DataFrame) -> DataFrame:
    return features.select(F.col("movie_idx").alias("item"), F.col("features").alias("vec"))


def _split_hot(rows: DataFrame, key: str, hot_rows: int, grouped=None) -> tuple[DataFrame | None, DataFrame]:
    """Rows of the keys with more than ``hot_rows`` rows (None if there are none), and the others. ``grouped``: rows
    with the same keys, grouped, that take less to count."""
    hot = cut_lineage((grouped or rows.groupBy(key)).count().where(F.col("count") > hot_rows).select(key))
    if hot.isEmpty():
        return None, rows
    return rows.join(hot, key, "left_semi"), rows.join(hot, key, "left_anti")


def user_profiles(
    ratings: DataFrame,
    features: DataFrame,
    strategy: str = "mean_centering",
    layout: tiles.Layout | None = None,
    hot_rows: int = HOT_USER_ROWS,
) -> DataFrame:
    """(user_id, profile): weighted sum of the rated items' vectors, not normalised.

    The ratings of users with more than ``hot_rows`` are spread over HOT_USER_SALT
    shards and the partial profiles added.
    """
    # Written: the statistics, the weights and the search for hot users all read them.
    known = cut_lineage(ratings.join(features.select("movie_idx"), "movie_idx", "left_semi"))
    weights = rating_weights(known, strategy)
    entries = weights.select(F.col("user_id").alias("key"), F.col("movie_idx").alias("item"), "weight")
    layout = layout or tiles.plan_layout(features)
    hot, cold = _split_hot(entries, "key", hot_rows, known.groupBy(F.col("user_id").alias("key")))
    sums = tiles.weighted_sums(cold, _vectors(features), layout)
    if hot is not None:
        sums = sums.union(tiles.weighted_sums(hot, _vectors(features), layout, HOT_USER_SALT))
    return sums.select(F.col("key").alias("user_id"), F.col("vec").alias("profile"))


def recommend(
    ratings: DataFrame,
    features: DataFrame,
    n: int = N_RECOMMENDATIONS,
    metric: str = "cosine",
    strategy: str = "mean_centering",
    layout: tiles.Layout | None = None,
    hot_rows: int = HOT_USER_ROWS,
) -> DataFrame:
    """(user_id, rank, movie_idx, score) for every user in (user_id, movie_idx, rating).

    Rated items are never returned; ties go to the smaller index. A single
    request is a one-user table. The strategy is an argument, not fitted state.
    """
    check_metric(metric)
    check_strategy(strategy)
    layout = layout or tiles.plan_layout(features)
    ratings = cut_lineage(ratings.select("user_id", "movie_idx", "rating"))  # read by every step below

    def by_profile(rows):
        profiles = user_profiles(rows, features, strategy, layout, hot_rows)
        return tiles.top_k(
            profiles.select(F.col("user_id").alias("key"), F.col("profile").alias("vec")),
            _vectors(features), n, layout, metric,
            seen=rows.select(F.col("user_id").alias("key"), F.col("movie_idx").alias("item")),
        )

    if layout.blocks > 1:
        found = by_profile(ratings)
    else:
        hot, cold = _split_hot(ratings, "user_id", hot_rows)
        rows = cold.select(F.col("user_id").alias("key"), F.col("movie_idx").alias("item"), F.col("rating").alias("weight"))
        found = tiles.recommend_one_block(rows, _vectors(features), n, layout, metric, strategy)
        if hot is not None:
            found = found.unionByName(by_profile(hot))
    return found.select(
        F.col("key").alias("user_id"), "rank", F.col("item").alias("movie_idx"), "score"
    )


def recommend_for_titles(
    requests: DataFrame,
    features: DataFrame,
    items: DataFrame,
    n: int = N_RECOMMENDATIONS,
    metric: str = "cosine",
    strategy: str = "mean_centering",
) -> DataFrame:
    """As ``recommend`` for (user_id, title, rating); unknown titles are skipped."""
    rated = requests.join(resolve_titles(items), "title").select("user_id", "movie_idx", "rating")
    return attach_titles(recommend(rated, features, n, metric, strategy), items)


def display_scores(recs: DataFrame, metric: str = "cosine") -> DataFrame:
    """Score in [0, 1]: clipped cosine, or min-max over each user's returned list."""
    check_metric(metric)
    score = F.col("score")
    if metric == "cosine":
        return recs.withColumn("display_score", F.least(F.greatest(score, F.lit(0.0)), F.lit(1.0)))
    w = Window.partitionBy("user_id")  # at most n rows per user
    low, high = F.min(score).over(w), F.max(score).over(w)
    span = F.when(high == low, 1.0).otherwise(high - low)
    return recs.withColumn("display_score", (score - low) / span)


def featured(recs: DataFrame, first: int = 3) -> DataFrame:
    return recs.withColumn("section", F.when(F.col("rank") <= first, "featured").otherwise("more"))
