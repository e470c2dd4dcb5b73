"""Session defaults and the shared-checkpoint helper."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# SQL settings every plan here relies on: runtime re-planning (join strategy by
# measured size, skewed-join splitting, empty-branch removal) and UTC time.
SQL_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def apply_sql_defaults(spark: SparkSession) -> SparkSession:
    for key, value in SQL_DEFAULTS.items():
        spark.conf.set(key, value)
    return spark


def build_session(app: str = "tastemill", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the defaults; cluster settings come from spark-submit."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SQL_DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the cluster's shared folder; a temporary one only in local mode."""
    sc = spark.sparkContext
    if sc.getCheckpointDir():
        return
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        sc.setCheckpointDir(shared)
    elif sc.master.startswith("local"):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="tastemill-ckpt-"))
    else:
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")


_SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

# Folders that this process has handed out, by application.
_SCRATCH: dict[str, list[str]] = {}


def scratch_path(spark: SparkSession, name: str = "table") -> str:
    """A new folder under the checkpoint folder; ``release`` deletes it."""
    ensure_checkpoint_dir(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"
    _SCRATCH.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def release(spark: SparkSession) -> int:
    """Delete the intermediate tables written so far, and say how many. DataFrames that read them are
    of no further use: call it when a result has been written or collected."""
    paths = _SCRATCH.pop(spark.sparkContext.applicationId, [])
    for name in paths:
        _delete(spark, name)
    return len(paths)


def _delete(spark: SparkSession, name: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def discard(table: DataFrame) -> None:
    """Delete what ``cut_lineage`` wrote for ``table``, once no DataFrame reads it any more."""
    for folder in {name.rpartition("/")[0] for name in table.inputFiles()}:
        _delete(table.sparkSession, folder)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` as a table in the shared checkpoint folder and read it back.

    The plan behind it runs once (an RDD checkpoint would run the last stage
    twice), readers prune columns, the file size is known to the join planner,
    and a lost executor costs a re-read, not a recomputation.
    """
    spark = df.sparkSession
    path = scratch_path(spark)
    # shuffle files, which nothing reads again, leave the disks with the job; the setting is read when a plan is made
    before = spark.conf.get(_SHUFFLE_CLEANUP, "false")
    spark.conf.set(_SHUFFLE_CLEANUP, "true")
    try:
        df.select("*").write.parquet(path)
    finally:
        spark.conf.set(_SHUFFLE_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)
