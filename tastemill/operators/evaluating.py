"""Offline evaluation: profile from train, truth from a held-out split."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import KS, RELEVANCE_THRESHOLD, STRATEGIES
from . import filtering, metrics, recommending, splitting, tiles
from .similarity import check_metric, check_strategy


def user_stats(
    ratings: DataFrame, items: DataFrame, split: str, threshold: float = RELEVANCE_THRESHOLD
) -> DataFrame:
    """Per held-out user: train rows, train rows of known items, relevant held-out
    items. One pass and one partial aggregation decide who is eligible."""
    splitting.eval_split(ratings, split)  # rejects other names
    flags = items.select("movie_idx").withColumn("known", F.lit(True))
    train, held = F.col("split") == "train", F.col("split") == split
    relevant = (F.col("rating") >= threshold) & F.col("movie_idx").isNotNull()
    return (
        ratings.filter(train | held).join(flags, "movie_idx", "left")
        .groupBy("user_id").agg(
            F.count_if(train).alias("n_train"),
            F.count_if(train & F.col("known").isNotNull()).alias("n_known"),
            F.count_if(held).alias("n_held"),
            F.count_if(held & relevant).alias("n_relevant"),
        )
        .filter(F.col("n_held") > 0)
    )


def _capped(stats: DataFrame, max_users: int | None) -> DataFrame:
    """A cap on evaluated users takes the smallest ids, before eligibility."""
    return stats.orderBy("user_id").limit(max_users) if max_users is not None else stats


def eligible(stats: DataFrame) -> DataFrame:
    """Users with a known train item and at least one relevant held-out item."""
    return stats.filter((F.col("n_known") > 0) & (F.col("n_relevant") > 0))


def eligibility_report(
    ratings: DataFrame, items: DataFrame, split: str = "val",
    threshold: float = RELEVANCE_THRESHOLD, max_users: int | None = None,
) -> DataFrame:
    """Evaluated and skipped users."""
    ok = (F.col("n_known") > 0) & (F.col("n_relevant") > 0)
    return _capped(user_stats(ratings, items, split, threshold), max_users).agg(
        F.count(F.lit(1)).alias("n_users"),
        F.count_if(ok).alias("n_evaluated"),
        F.count_if(~ok).alias("n_skipped"),
    )


def evaluate(
    ratings: DataFrame,
    features: DataFrame,
    split: str = "val",
    ks: Sequence[int] = KS,
    threshold: float = RELEVANCE_THRESHOLD,
    max_users: int | None = None,
    metric: str = "cosine",
    strategy: str = "mean_centering",
    layout: tiles.Layout | None = None,
) -> DataFrame:
    """Per-user metrics over (user_id, movie_idx, rating, split).

    Only eligible users are scored; on the test split, val items are neither
    profile nor masked. ``ratings`` is read three times: pass a written table.
    """
    check_metric(metric)
    check_strategy(strategy)
    users = eligible(_capped(user_stats(ratings, features, split, threshold), max_users))
    keys = users.select("user_id")
    train = splitting.select_split(ratings, "train").join(keys, "user_id", "left_semi")
    truth = filtering.relevant(splitting.eval_split(ratings, split), threshold=threshold)
    recs = recommending.recommend(train, features, max(ks), metric, strategy, layout)
    scored = metrics.per_user_metrics(recs, truth.join(keys, "user_id", "left_semi"), ks)
    return users.select("user_id", "n_train").join(scored, "user_id")


def row_key(model: str, strategy: str, strategies: Sequence[str]) -> str:
    return f"{model}_{strategy}" if len(strategies) > 1 else model


def report(
    ratings: DataFrame,
    models: dict[str, DataFrame | None],
    split: str = "val",
    ks: Sequence[int] = KS,
    threshold: float = RELEVANCE_THRESHOLD,
    max_users: int | None = None,
    strategies: Sequence[str] = STRATEGIES,
    metric: str = "cosine",
) -> DataFrame:
    """One row per (model, strategy); a model without features is skipped, and
    so is a pair without eligible users."""
    rows = []
    for name, features in models.items():
        if features is None:
            continue
        layout = tiles.plan_layout(features)
        for strategy in strategies:
            per_user = evaluate(ratings, features, split, ks, threshold, max_users, metric, strategy, layout)
            summary = metrics.aggregate_metrics(per_user, ks)
            rows.append(summary.select(F.lit(row_key(name, strategy, strategies)).alias("model"), "*"))
    if not rows:
        raise ValueError("no model to report on")
    return reduce(DataFrame.unionByName, rows).filter(F.col("n_users") > 0)
