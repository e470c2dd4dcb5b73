"""Current rating per (user, title) from a change feed, batch and streaming.

Feed rows: (user_id, title, rating, ts, event_id, op) with op 'upsert' or
'delete'. The last write by (ts, event_id) wins; deletes remove the key.

The stream keeps no state store: every micro-batch is reduced to the last
change of each key it saw and written as its own version, and a read takes the
last change over all versions. Late rows need no watermark, because the order
is the rows' own (ts, event_id).

``compact`` folds versions into a snapshot and then moves the pointer, a small
table whose last row names the snapshot and the last version in it. Readers take
that snapshot and the versions behind it, so a running stream goes on without
knowing of it. What a reader may still use, the snapshot before and the versions
behind that one, stays until the next hand-over; everything older is deleted.

  log/version=<batch>   snapshots/snapshot=<last version in it>   pointer/
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..sources.artifacts import exists

CHANGES = "user_id BIGINT, title STRING, op STRING, rating DOUBLE, ts TIMESTAMP_NTZ, event_id BIGINT"


def latest(changes: DataFrame) -> DataFrame:
    """Last change per key: one aggregation with map-side combining."""
    row = F.struct("op", "rating", "ts", "event_id")
    return (
        changes.groupBy("user_id", "title")
        .agg(F.max_by(row, F.struct("ts", "event_id")).alias("last"))
        .select("user_id", "title", "last.*")
    )


def current_ratings(changes: DataFrame) -> DataFrame:
    return latest(changes).filter(F.col("op") == "upsert").select("user_id", "title", "rating")


def stream_changes(feed: DataFrame, out: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Write each micro-batch as a version. A replayed batch overwrites its own
    version, so the sink is idempotent."""
    def write(batch: DataFrame, batch_id: int) -> None:
        latest(batch).write.mode("overwrite").parquet(f"{out}/log/version={batch_id}")

    writer = feed.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def _pointers(spark: SparkSession, out: str) -> list[int]:
    """Snapshots so far, oldest first (a row per compaction)."""
    if not exists(spark, f"{out}/pointer"):
        return []
    return sorted(r["snapshot"] for r in spark.read.schema("snapshot BIGINT").parquet(f"{out}/pointer").collect())


def _versions(spark: SparkSession, out: str) -> list[int]:
    """Versions in the log, by the names of their folders."""
    if not exists(spark, f"{out}/log"):
        return []
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{out}/log")
    found = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(path)
    names = [f.getPath().getName() for f in found]
    return sorted(int(n.removeprefix("version=")) for n in names if n.startswith("version="))


def _changes(spark: SparkSession, out: str, snapshot: int | None, versions: list[int]) -> DataFrame:
    paths = [f"{out}/snapshots/snapshot={snapshot}"] if snapshot is not None else []
    paths += [f"{out}/log/version={v}" for v in versions if snapshot is None or v > snapshot]
    return spark.read.schema(CHANGES).parquet(*paths) if paths else spark.createDataFrame([], CHANGES)


def read_current(spark: SparkSession, out: str) -> DataFrame:
    """Current ratings: the last snapshot and the versions behind it."""
    snapshot = (_pointers(spark, out) or [None])[-1]
    return current_ratings(_changes(spark, out, snapshot, _versions(spark, out)))


def compact(spark: SparkSession, out: str) -> None:
    """Fold the versions so far into a new snapshot, hand readers over to it, and
    delete what neither it nor the snapshot before needs. Deletes stay as markers,
    so that later, older-stamped rows cannot revive a key."""
    pointers, versions = _pointers(spark, out), _versions(spark, out)
    before = pointers[-1] if pointers else None
    if not versions or (before is not None and versions[-1] <= before):
        return
    now = versions[-1]
    latest(_changes(spark, out, before, versions)).write.mode("overwrite").parquet(f"{out}/snapshots/snapshot={now}")
    spark.createDataFrame([(now,)], "snapshot BIGINT").coalesce(1).write.mode("append").parquet(f"{out}/pointer")
    if before is None:
        return
    fs_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    old = [f"snapshots/snapshot={p}" for p in pointers[:-1]] + [f"log/version={v}" for v in versions if v <= before]
    for name in old:
        path = fs_path(f"{out}/{name}")
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
