"""Raw metadata cache: (tmdbId, raw) rows, a null raw marks a failed fetch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..session import cut_lineage
from .artifacts import exists


def read_cache_jsonl(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.METADATA_RAW).json(path)


def upsert(cache: DataFrame, responses: DataFrame, force: bool = False) -> DataFrame:
    """Keyed upsert. Known ids keep their row unless ``force``; new ids are added.

    One hash aggregation with map-side combining: the winner per id is the
    newest side, not a sort of all versions.
    """
    rank_new = 1 if force else -1
    both = cache.select("tmdbId", "raw", F.lit(0).alias("side")).unionByName(
        responses.select("tmdbId", "raw", F.lit(rank_new).alias("side"))
    )
    return (
        both.groupBy("tmdbId")
        .agg(F.max_by(F.struct("raw"), F.struct("side", "raw")).alias("w"))
        .select("tmdbId", "w.raw")
    )


# Hash buckets of the cache on disk: an upsert rewrites those that its ids fall into.
CACHE_BUCKETS = 64


def _bucket() -> Column:
    return F.pmod(F.xxhash64("tmdbId"), F.lit(CACHE_BUCKETS)).cast("int").alias("bucket")


def read_cache(spark: SparkSession, path: str) -> DataFrame:
    """(tmdbId, raw) of the cache on disk; a path without a cache is an empty one."""
    if not exists(spark, path):
        return spark.createDataFrame([], schemas.METADATA_RAW)
    return spark.read.schema(f"{schemas.METADATA_RAW}, bucket INT").parquet(path).select("tmdbId", "raw")


def upsert_cache(spark: SparkSession, path: str, responses: DataFrame, force: bool = False) -> None:
    """Upsert into the cache on disk: buckets without a response keep their files.

    The merged rows are written aside first, so a failure on the way leaves the
    cache as it was.
    """
    responses = cut_lineage(responses.select("tmdbId", "raw", _bucket()))
    merged = responses.select("tmdbId", "raw")
    if exists(spark, path):
        old = spark.read.schema(f"{schemas.METADATA_RAW}, bucket INT").parquet(path)
        touched = old.join(responses.select("bucket").distinct(), "bucket", "left_semi")
        merged = upsert(touched.select("tmdbId", "raw"), merged, force)
    else:
        merged = upsert(merged.limit(0), merged, force)
    merged = cut_lineage(merged.select("tmdbId", "raw", _bucket()).repartition("bucket"))
    if merged.isEmpty():
        return
    merged.repartition("bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(path)


def plan_fetch(
    links: DataFrame,
    cache: DataFrame,
    max_movies: int | None = None,
    retry_failed: bool = False,
) -> DataFrame:
    """Ids still to fetch: not cached, or failed before when ``retry_failed``.

    ``max_movies`` caps the links considered, in movieId order, before the
    cached ones are removed.
    """
    wanted = links.dropna(subset=["tmdbId"])
    if max_movies is not None:
        wanted = wanted.orderBy("movieId").limit(max_movies)
    known = cache.filter(F.col("raw").isNotNull()) if retry_failed else cache
    return wanted.select("tmdbId").distinct().join(known.select("tmdbId"), "tmdbId", "left_anti")


def failed_ids(cache: DataFrame) -> DataFrame:
    return cache.filter(F.col("raw").isNull()).select("tmdbId")


def successful_ids(cache: DataFrame) -> DataFrame:
    return cache.filter(F.col("raw").isNotNull()).select("tmdbId")


def ingest_report(cache: DataFrame) -> DataFrame:
    """Cached ids, fetched and failed ones, and what ``flatten`` makes of them: records, and entries skipped as failed."""
    ok = F.count_if(F.col("raw").isNotNull())
    failed = F.count_if(F.col("raw").isNull())
    return cache.agg(
        F.count(F.lit(1)).alias("n_total"), ok.alias("n_ok"), failed.alias("n_failed"), ok.alias("n_records"), failed.alias("n_skipped"),
    )
