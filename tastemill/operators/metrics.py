"""Ranking metrics in long form, rating error, and their means."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import KS


def _ideal_gain(n_gt: Column, k: int) -> Column:
    """Discounted gain of min(n_gt, k) hits at the top ranks."""
    ranks = F.sequence(F.lit(1), F.least(n_gt, F.lit(k)).cast("int"))
    return F.aggregate(ranks, F.lit(0.0), lambda acc, i: acc + 1.0 / F.log2(i + 1.0))


# Every metric at a cut-off k, from the hits found, their discounted gain and the number of relevant items.
PER_CUTOFF = {
    "hr": lambda found, gain, n_gt, k: F.when(found > 0, 1.0).otherwise(0.0),
    "p": lambda found, gain, n_gt, k: found / F.lit(k) if k else F.lit(0.0),
    "r": lambda found, gain, n_gt, k: found / n_gt,
    "ndcg": lambda found, gain, n_gt, k: gain / _ideal_gain(n_gt, k) if k else F.lit(0.0),
}


def columns_at(ks: Sequence[int]) -> dict[str, Column]:
    """Column name to expression, cut-off by cut-off."""
    return {
        f"{name}@{k}": of(F.col(f"__h{k}"), F.col(f"__g{k}"), F.col("n_gt"), k)
        for k in ks for name, of in PER_CUTOFF.items()
    }


def hits(recs: DataFrame, truth: DataFrame) -> DataFrame:
    """Recommendations with ``hit`` 1 where the item is relevant to the user."""
    marked = truth.select("user_id", "movie_idx").distinct().withColumn("hit", F.lit(1))
    return recs.join(marked, ["user_id", "movie_idx"], "left").withColumn(
        "hit", F.coalesce("hit", F.lit(0))
    )


def per_user_metrics(recs: DataFrame, truth: DataFrame, ks: Sequence[int] = KS) -> DataFrame:
    """(user_id, n_gt, hr@K, p@K, r@K, ndcg@K) for every user with relevant items.

    Relevant items carry their rank, if any, so the relevant count and all
    sums of all cut-offs come from one aggregation per user.
    """
    relevant = truth.select("user_id", "movie_idx").distinct()
    ranked = relevant.join(recs.select("user_id", "movie_idx", "rank"), ["user_id", "movie_idx"], "left")
    rank = F.col("rank")
    sums = [F.count(F.lit(1)).alias("n_gt")]
    for k in ks:
        sums.append(F.count_if(rank <= k).alias(f"__h{k}"))
        sums.append(F.coalesce(F.sum(F.when(rank <= k, 1.0 / F.log2(rank + 1.0))), F.lit(0.0)).alias(f"__g{k}"))
    user = ranked.groupBy("user_id").agg(*sums)
    return user.select("user_id", "n_gt", *[c.alias(name) for name, c in columns_at(ks).items()])


def aggregate_metrics(per_user: DataFrame, ks: Sequence[int] = KS) -> DataFrame:
    """One row: evaluated users and the mean of every metric column present."""
    means = [F.avg(F.col(f"`{m}`")).alias(m) for m in columns_at(ks) if m in per_user.columns]
    return per_user.agg(F.count(F.lit(1)).alias("n_users"), *means)


def rmse(predictions: DataFrame, predicted: str = "prediction", actual: str = "rating") -> DataFrame:
    """Root mean squared error over every row."""
    error = F.pow(F.col(predicted) - F.col(actual), 2)
    return predictions.agg(F.count(F.lit(1)).alias("n"), F.sqrt(F.avg(error)).alias("rmse"))
