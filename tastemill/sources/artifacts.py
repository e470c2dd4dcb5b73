"""Named artefacts: one Parquet directory per name, models with parameters."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession


def exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def save_artifacts(base: str, **frames: DataFrame) -> None:
    for name, frame in frames.items():
        frame.write.mode("overwrite").parquet(f"{base}/{name}")


def load_artifact(spark: SparkSession, base: str, name: str) -> DataFrame:
    path = f"{base}/{name}"
    if not exists(spark, path):
        raise FileNotFoundError(f"no artefact '{name}' under {base}")
    return spark.read.parquet(path)


def save_params(spark: SparkSession, base: str, name: str, params: dict) -> None:
    row = spark.createDataFrame([(json.dumps(params, sort_keys=True),)], "params STRING")
    row.write.mode("overwrite").parquet(f"{base}/{name}")


def load_params(spark: SparkSession, base: str, name: str) -> dict:
    return json.loads(load_artifact(spark, base, name).first()["params"])
