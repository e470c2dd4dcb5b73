"""Exact order statistics without unbounded windows.

``row_number`` over a key that holds a third of all rows is one endless task,
and a global ``row_number`` is always one task. ``radix_rank`` splits the sort
key into order-preserving levels: counts per level prefix (partial aggregation)
give the offset of each small bucket, and only rows inside one bucket are ever
sorted together. It is a deterministic function of the data, so a recomputed
task after executor loss gives the same ranks.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage


def radix_rank(
    df: DataFrame,
    group: list[str],
    levels: list[Column],
    order: list[str],
    out: str,
) -> DataFrame:
    """1-based rank of each row within ``group`` by ``order``.

    ``levels`` are coarse-to-fine expressions that never disagree with
    ``order``; each must take a bounded number of values inside the level above.
    """
    names = [f"__l{i}" for i in range(len(levels))]
    keyed = df.withColumns(dict(zip(names, levels)))
    prefix = group + names
    counts = keyed.groupBy(*prefix).agg(F.count(F.lit(1)).alias("__n"))

    offsets = None
    level_counts = counts
    for depth in range(len(names), 0, -1):
        keys = group + names[:depth]
        if depth < len(names):
            level_counts = level_counts.groupBy(*keys).agg(F.sum("__n").alias("__n"))
        parent = keys[:-1]
        w = (
            Window.partitionBy(*(parent or [F.lit(0)]))
            .orderBy(keys[-1])
            .rowsBetween(Window.unboundedPreceding, -1)
        )
        step = level_counts.select(
            *keys, F.coalesce(F.sum("__n").over(w), F.lit(0)).alias(f"__o{depth}")
        )
        offsets = step if offsets is None else offsets.join(step, keys)
    total = sum((F.col(f"__o{d}") for d in range(1, len(names) + 1)), F.lit(0))
    offsets = offsets.select(*prefix, total.alias("__offset"))

    within = F.row_number().over(Window.partitionBy(*prefix).orderBy(*order))
    return (
        keyed.withColumn("__rn", within)
        .join(offsets, prefix)
        .withColumn(out, F.col("__rn") + F.col("__offset"))
        .drop("__rn", "__offset", *names)
    )


def top_per_group(
    df: DataFrame, group: list[str], order: list, k: int, out: str = "rank"
) -> DataFrame:
    """First k rows per group. Catalyst puts a group limit before the shuffle,
    so a hot group sends at most k rows per map task."""
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(out, F.row_number().over(w)).filter(F.col(out) <= k)


# Bits of a value that one pass settles; a histogram has at most 2 ** _DIGIT rows per wanted rank.
_DIGIT = 16


def _ordered_bits(batches):
    """Doubles as integers of the same order; minus zero is zero, every NaN one value above infinity."""
    for batch in batches:
        values = batch.column(0).to_numpy(zero_copy_only=False) + 0.0
        values[np.isnan(values)] = np.nan
        bits = values.view(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(bits ^ (bits >> 63 & np.int64(2**63 - 1)))], names=["bits"])


def _double(bits: int) -> float:
    bits = np.int64(bits)
    return float((bits ^ (bits >> 63 & np.int64(2**63 - 1))).view(np.float64))


def select_ranks(values: DataFrame, ranks: list[int]) -> list[int]:
    """Values (column ``bits``, BIGINT) at 0-based ranks, by radix selection.

    Each pass counts the next digit of the values that share a wanted prefix; no
    value is ever sorted, and equal values cost nothing but their count.
    """
    found = [(0, rank) for rank in ranks]  # prefix, rank inside of it
    for shift in range(64 - _DIGIT, -1, -_DIGIT):
        rows = values
        if shift < 64 - _DIGIT:
            rows = values.where(F.shiftright("bits", shift + _DIGIT).isin(sorted({p for p, _ in found})))
        counts = sorted(map(tuple, rows.groupBy(F.shiftright("bits", shift)).count().collect()))
        for k, (prefix, rank) in enumerate(found):
            for digit, n in counts:
                if shift < 64 - _DIGIT and digit >> _DIGIT != prefix:
                    continue
                if rank < n:
                    found[k] = (digit, rank)
                    break
                rank -= n
    return [bits for bits, _ in found]


def exact_median(df: DataFrame, column: str) -> DataFrame:
    """One row, one column ``median`` (linear interpolation, nulls ignored; null without values)."""
    v = df.select(F.col(column).cast("double").alias("v")).where("v IS NOT NULL")
    values = cut_lineage(v.mapInArrow(_ordered_bits, "bits BIGINT"))
    n = values.count()
    median = None
    if n:
        low, high = map(_double, select_ranks(values, [(n - 1) // 2, n // 2]))
        median = low if low == high else (low + high) / 2
    return df.sparkSession.createDataFrame([(median,)], "median DOUBLE")
