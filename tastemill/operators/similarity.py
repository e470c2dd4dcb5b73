"""Item-to-item neighbours."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import METRICS, N_RECOMMENDATIONS, STRATEGIES, TOP_K
from ..session import cut_lineage
from . import tiles
from .indexing import attach_titles, resolve_titles
from .ranking import top_per_group

# Members of a class that one task expands.
_CLASS_PIECE = 8192


def check_metric(metric: str) -> None:
    if metric not in METRICS:
        raise ValueError(f"unknown metric '{metric}', expected one of {METRICS}")


def check_strategy(strategy: str) -> None:
    if strategy not in STRATEGIES:
        raise ValueError(f"unknown profile strategy '{strategy}', expected one of {STRATEGIES}")


def neighbours(
    features: DataFrame,
    top_k: int = TOP_K,
    metric: str = "cosine",
    layout: tiles.Layout | None = None,
) -> DataFrame:
    """(movie_idx, rank, neighbour_idx, score): exact top-K per item, self excluded.

    Cosine scores 0 for zero vectors; euclidean is the negative squared
    distance. A catalogue of fewer than K + 1 items gives n - 1 rows per item.
    Items with equal vectors form a class: classes are compared, their members
    share the list of the class.
    """
    check_metric(metric)
    rows = features.select(F.col("movie_idx").cast("bigint").alias("key"), F.col("features").alias("vec"))
    members, classes = _classes(rows)
    n = classes.agg(F.sum("size"), F.count(F.lit(1)), F.countDistinct("class")).first()
    if n[0] == n[1] or n[1] != n[2]:  # no copies, or ids that come with several vectors
        layout = layout or tiles.plan_layout(features, self_join=True)
        found = tiles.top_k(rows, rows.withColumnRenamed("key", "item"), top_k, layout, metric, exclude_self=True, by_cell=n[1] == n[2])
        return found.select(
            F.col("key").alias("movie_idx"), "rank", F.col("item").alias("neighbour_idx"), "score"
        )
    layout = layout or tiles.plan_layout(classes, vec="vec", self_join=True)
    # One more than asked for: a member leaves itself out.
    found = tiles.top_k(
        classes.select(F.col("class").alias("key"), "vec"), classes.select(F.col("class").alias("item"), "vec"),
        top_k + 1, layout, metric, by_cell=True,
    )
    return _expand(_class_lists(found, members, classes, top_k + 1), members, top_k)


def _digests(batches):
    """(key, digest of the vector's doubles); minus zero is zero."""
    for batch in batches:
        lists = batch.column("vec")
        ends = np.cumsum(lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)) * 8
        data = memoryview((lists.flatten().to_numpy(zero_copy_only=False) + 0.0).tobytes())
        found = [hashlib.blake2b(data[a:b], digest_size=16).digest() for a, b in zip(np.append(0, ends[:-1]), ends)]
        yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(found, pa.binary()), lists], names=["key", "digest", "vec"])


def _classes(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """((class, size, key) of every row, (class, size, vec) of every distinct vector); a class is named by its smallest key."""
    marked = rows.select("key", F.col("vec").cast("array<double>").alias("vec")).mapInArrow(
        _digests, "key BIGINT, digest BINARY, vec ARRAY<DOUBLE>")
    classes = cut_lineage(marked.groupBy("digest").agg(
        F.min("key").alias("class"), F.count(F.lit(1)).alias("size"), F.first("vec").alias("vec")))
    members = marked.select("key", "digest").join(classes.select("digest", "class", "size"), "digest")
    return members.select("class", "size", "key"), classes.drop("digest")


def _class_lists(found: DataFrame, members: DataFrame, classes: DataFrame, k: int) -> DataFrame:
    """(class, best): the k best items of each class as (0 - score, item) in order, its own members included.

    The k best classes by score and smallest member hold the k best items; of these
    only those count that are not behind k items of better scores, with their k smallest members.
    """
    heads = top_per_group(members, ["class"], ["key"], k).groupBy("class").agg(F.sort_array(F.collect_list("key")).alias("head"))
    sized = found.select(F.col("key").alias("of"), F.col("item").alias("class"), "score").join(classes.select("class", "size"), "class")
    upto = F.sum("size").over(Window.partitionBy("of").orderBy(F.desc("score")))  # k rows a class
    equal = F.sum("size").over(Window.partitionBy("of", "score"))
    near = sized.withColumn("before", upto - equal).where(F.col("before") < k)
    items = near.join(heads, "class").select("of", (F.lit(0.0) - F.col("score")).alias("far"), F.explode("head").alias("item"))
    best = F.slice(F.sort_array(F.collect_list(F.struct("far", "item"))), 1, k)
    return items.groupBy("of").agg(best.alias("best")).withColumnRenamed("of", "class")


def _expand(lists: DataFrame, members: DataFrame, k: int) -> DataFrame:
    """The list of its class for every member, without one entry of the member itself; large classes go in pieces."""
    pieces = F.ceil(F.col("size") / _CLASS_PIECE)
    sizes = members.select("class", "size").distinct()
    dealt = lists.join(sizes, "class").withColumn("piece", F.explode(F.sequence(F.lit(0).cast("bigint"), pieces - 1))).drop("size")
    mine = members.withColumn("piece", F.pmod(F.xxhash64("key"), pieces)).drop("size")
    own = F.array_position(F.col("best.item"), F.col("key")).cast("int")
    others = F.when(F.col("own") == 0, F.col("best")).otherwise(
        F.concat(F.expr("slice(best, 1, greatest(own - 1, 0))"), F.expr("slice(best, own + 1, size(best))")))
    return (
        mine.join(dealt, ["class", "piece"]).withColumn("own", own).withColumn("best", F.slice(others, 1, k))
        .select(F.col("key").alias("movie_idx"), F.posexplode("best").alias("at", "b"))
        .select("movie_idx", (F.col("at") + 1).alias("rank"), F.col("b.item").alias("neighbour_idx"), (F.lit(0.0) - F.col("b.far")).alias("score"))
    )


def similar_by_title(
    titles: DataFrame, neighbour_table: DataFrame, items: DataFrame, n: int = N_RECOMMENDATIONS
) -> DataFrame:
    """Stored neighbours of each requested title; unknown titles give no rows."""
    wanted = resolve_titles(items).join(titles.select("title").distinct(), "title", "left_semi")
    found = (
        neighbour_table.filter(F.col("rank") <= n)
        .join(wanted.withColumnRenamed("title", "query_title"), "movie_idx")
        .select("query_title", "rank", F.col("neighbour_idx").alias("movie_idx"), "score")
    )
    return attach_titles(found, items)
