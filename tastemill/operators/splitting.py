"""Per-user temporal split into train, val and test."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import (
    HOT_GROUP_ROWS,
    MIN_RATINGS_PER_USER_SPLIT,
    TEST_RATIO,
    VAL_RATIO,
)
from .ranking import radix_rank

SPLITS = ("train", "val", "test")


def _order_in_history(ratings: DataFrame, hot_rows: int) -> DataFrame:
    """Add n (history length) and k (1-based position by time, then movie).

    Ordinary users: one window, one shuffle. Users above ``hot_rows`` go through
    radix ranks. Whether there are any is one narrow counting job (partial
    aggregation on the user column); usually there are none and the plan is the
    plain window.
    """
    hot = (
        ratings.groupBy("userId").agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") > hot_rows)
    )
    any_hot = not hot.isEmpty()
    # One window spec for both columns: one shuffle and one sort.
    w = Window.partitionBy("userId").orderBy("timestamp", "movieId")
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ordinary = (
        (ratings.join(hot, "userId", "left_anti") if any_hot else ratings)
        .withColumn("n", F.count(F.lit(1)).over(whole))
        .withColumn("k", F.row_number().over(w).cast("bigint"))
    )
    if not any_hot:
        return ordinary
    levels = [
        F.shiftright("timestamp", 16),
        F.col("timestamp"),
        F.shiftright("movieId", 16),
    ]
    heavy = radix_rank(
        ratings.join(hot, "userId"), ["userId"], levels, ["movieId"], "k"
    )
    return ordinary.unionByName(heavy)


def temporal_split(
    ratings: DataFrame,
    val_ratio: float = VAL_RATIO,
    test_ratio: float = TEST_RATIO,
    min_ratings_per_user: int = MIN_RATINGS_PER_USER_SPLIT,
    hot_rows: int = HOT_GROUP_ROWS,
) -> DataFrame:
    """Add ``split``: the newest ratings are test, the ones before them val.

    Sizes are floored shares, at least one each; shorter histories stay whole in
    train. Equal timestamps are ordered by movieId.
    """
    n, k = F.col("n"), F.col("k")
    n_test = F.greatest(F.lit(1), F.floor(n * F.lit(float(test_ratio))))
    n_val = F.greatest(F.lit(1), F.floor(n * F.lit(float(val_ratio))))
    split = (
        F.when(n < min_ratings_per_user, "train")
        .when(k > n - n_test, "test")
        .when(k > n - n_test - n_val, "val")
        .otherwise("train")
    )
    return _order_in_history(ratings, hot_rows).withColumn("split", split).drop("n", "k")


def select_split(ratings: DataFrame, split: str) -> DataFrame:
    if split not in SPLITS:
        raise ValueError(f"unknown split '{split}', expected one of {SPLITS}")
    return ratings.filter(F.col("split") == split).drop("split")


def eval_split(ratings: DataFrame, split: str) -> DataFrame:
    """Held-out part for evaluation: val or test only."""
    if split not in ("val", "test"):
        raise ValueError(f"unknown evaluation split '{split}', expected 'val' or 'test'")
    return select_split(ratings, split)


def train_val(ratings: DataFrame) -> DataFrame:
    return ratings.filter(F.col("split").isin("train", "val"))


def split_summary(ratings: DataFrame) -> DataFrame:
    """Rows and share per split."""
    total = ratings.agg(F.count(F.lit(1))).scalar()
    return (
        ratings.groupBy("split").agg(F.count(F.lit(1)).alias("n_rows"))
        .withColumn("share", F.col("n_rows") / total)
    )
