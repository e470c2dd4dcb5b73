"""Scans and sinks: CSV tables with explicit schemas, Parquet, result CSVs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType

from .. import schemas
from ..functions import text


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Header CSV in UTF-8; doubled quotes inside quoted fields are one quote."""
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("encoding", "UTF-8")
        .option("quote", '"')
        .option("escape", '"')
        .csv(path)
    )


def load_ratings(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, schemas.RATINGS)


def preprocess_movies(movies: DataFrame) -> DataFrame:
    """Add year, title_clean and genres_list."""
    title, genres = F.col("title"), F.col("genres")
    return movies.select(
        "*",
        text.title_year(title).alias("year"),
        text.title_clean(title).alias("title_clean"),
        text.genres_list(genres).alias("genres_list"),
    )


def load_movies(spark: SparkSession, path: str) -> DataFrame:
    return preprocess_movies(read_csv(spark, path, schemas.MOVIES))


def clean_tags(tags: DataFrame) -> DataFrame:
    return tags.withColumn("tag", text.clean_tag(F.col("tag")))


def load_tags(spark: SparkSession, path: str) -> DataFrame:
    return clean_tags(read_csv(spark, path, schemas.TAGS))


def type_links(links: DataFrame) -> DataFrame:
    return links.select(
        "movieId", F.col("imdbId").cast("string").alias("imdbId"),
        text.to_bigint(F.col("tmdbId")).alias("tmdbId"),
    )


def load_links(spark: SparkSession, path: str) -> DataFrame:
    return type_links(read_csv(spark, path, schemas.LINKS))


def load_genome(spark: SparkSession, scores: str, tags: str) -> tuple[DataFrame, DataFrame]:
    return (
        read_csv(spark, scores, schemas.GENOME_SCORES),
        read_csv(spark, tags, schemas.GENOME_TAGS),
    )


def read_items(spark: SparkSession, path: str, columns: list[str] | None = None, schema: str | None = None) -> DataFrame:
    """Enriched items; the projection reaches the Parquet scan. With a declared ``schema`` no footer is read to plan it."""
    items = (spark.read.schema(schema) if schema else spark.read).parquet(path)
    return items.select(*columns) if columns else items


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def write_results_csv(results: DataFrame, path: str) -> None:
    """One row per (model, strategy): small by construction, hence one file."""
    results.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def read_results_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return read_csv(spark, path, schema)


def table_profile(df: DataFrame) -> DataFrame:
    """Per column: type, rows, nulls, distinct values, in one aggregation pass.

    Distinct counts of several columns would expand every row; hashing each
    column into its own (column, value) row keeps it to one shuffle with
    map-side combining.
    """
    def as_text(field):
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (ArrayType, MapType, StructType)):
            return F.to_json(c)
        return c.cast("string")

    cells = F.explode(
        F.array(*[
            F.struct(
                F.lit(i).alias("position"),
                F.lit(f.name).alias("column"),
                F.lit(f.dataType.simpleString()).alias("type"),
                as_text(f).alias("value"),
            )
            for i, f in enumerate(df.schema.fields)
        ])
    )
    per_value = (
        df.select(cells.alias("c")).select("c.*")
        .groupBy("position", "column", "type", "value").agg(F.count(F.lit(1)).alias("n"))
    )
    return per_value.groupBy("position", "column", "type").agg(
        F.sum("n").alias("n_rows"),
        F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0)).cast("bigint").alias("n_null"),
        F.count("value").alias("n_distinct"),
    )


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    """Head of a table (a display feature)."""
    return df.limit(n)
