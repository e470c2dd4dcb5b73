"""Queries that write a table of the library's formats and read it back: scans, sinks, artefacts, cache, stream, preparation."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import metadata
from ..operators import indexing, splitting
from ..session import scratch_path
from ..sources import artifacts, metadata_cache, tables
from ..sources.driver_views import VIEW_MIN_MOVIE, VIEW_MIN_USER, Views, with_views
from ..streaming import feed as rating_feed
from .models import ContentModel
from .prepare import prepare
from .queries_features import _groups
from .queries_prepare import split
from .queries_report import _cf, _sql
from .registry import register
from .specs import SPECS


def _csv(v: Views, df, name: str) -> str:
    path = scratch_path(v.spark, name)
    df.write.option("header", True).option("escape", '"').csv(path)
    return path


@register("s1_ratings_csv", with_views(["ratings"], 'SELECT userId, movieId, rating, "timestamp" FROM ratings'))
def s1_ratings_csv(v):
    return tables.load_ratings(v.spark, _csv(v, v.ratings, "ratings"))


@register("s2_movies_csv", with_views(["movies_pre"], """
SELECT movieId, title, year, title_clean, array_to_string(genres_list, ';') AS genres FROM movies_pre"""))
def s2_movies_csv(v):
    movies = tables.load_movies(v.spark, _csv(v, v.movies_raw, "movies"))
    return movies.select("movieId", "title", "year", "title_clean", F.array_join("genres_list", ";").alias("genres"))


_GENOME_TAGS = "SELECT DISTINCT tagId, 'dimension ' || tagId AS tag FROM genome_scores"


def _genome_tags(v: Views):
    return v.genome_scores.select("tagId").distinct().withColumn("tag", F.concat(F.lit("dimension "), "tagId"))


@register("s5_genome_csv", with_views(["genome_scores"], """
SELECT movieId, tag, round(relevance, 6) AS relevance FROM genome_scores JOIN genome_tags USING (tagId)""", {"genome_tags": _GENOME_TAGS}))
def s5_genome_csv(v):
    scores, labels = tables.load_genome(v.spark, _csv(v, v.genome_scores, "scores"), _csv(v, _genome_tags(v), "labels"))
    return scores.join(labels, "tagId").select("movieId", "tag", F.round("relevance", 6).alias("relevance"))


@register("s6_cache_jsonl", with_views(["metadata"], """
SELECT p_partkey + 100000 AS tmdbId, p_partkey % 13 <> 0 AS fetched, overview, director
FROM part LEFT JOIN metadata ON tmdbId = p_partkey + 100000"""))
def s6_cache_jsonl(v):
    """One JSON object a line; a failed fetch keeps its id and no content."""
    path = scratch_path(v.spark, "cache")
    v.metadata_raw.write.json(path)
    cache = metadata_cache.read_cache_jsonl(v.spark, path)
    flat = metadata.flatten(cache).select("tmdbId", "overview", "director")
    return cache.select("tmdbId", F.col("raw").isNotNull().alias("fetched")).join(flat, "tmdbId", "left")


@register("s7_cache_on_disk", """
SELECT p_partkey + 100000 AS tmdbId,
  CASE WHEN p_partkey % 5 = 0 THEN 'third ' || p_name WHEN p_retailprice < 950 THEN 'second ' || p_name
       WHEN p_partkey % 13 = 0 THEN NULL ELSE 'first ' || p_name END AS raw
FROM part""")
def s7_cache_on_disk(v):
    """Three upserts: what is there, all ids without force, a fifth of the ids with force."""
    path = scratch_path(v.spark, "cache")
    part = v.table("part").withColumn("tmdbId", F.col("p_partkey") + 100000)
    first = part.filter("p_retailprice >= 950").selectExpr("tmdbId", "CASE WHEN p_partkey % 13 <> 0 THEN concat('first ', p_name) END AS raw")
    metadata_cache.upsert_cache(v.spark, path, first)
    metadata_cache.upsert_cache(v.spark, path, part.selectExpr("tmdbId", "concat('second ', p_name) AS raw"))
    third = part.filter("p_partkey % 5 = 0").selectExpr("tmdbId", "concat('third ', p_name) AS raw")
    metadata_cache.upsert_cache(v.spark, path, third, force=True)
    return metadata_cache.read_cache(v.spark, path)


@register("s8_items_parquet", with_views(["movies_pre"], "SELECT movieId, title_clean, year FROM movies_pre"))
def s8_items_parquet(v):
    """Only the declared columns are read."""
    path = scratch_path(v.spark, "items")
    tables.write_parquet(tables.preprocess_movies(v.movies_raw), path)
    return tables.read_items(v.spark, path, schema="movieId BIGINT, title_clean STRING, year INT")


@register("s9_partitioned_split", with_views(["split"], "SELECT userId, movieId, rating FROM split WHERE split = 'val'"))
def s9_partitioned_split(v):
    """The split ratings by folder; a split's reader opens its own folder only."""
    path = scratch_path(v.spark, "split")
    tables.write_parquet(split(v), path, partition_by=["split"])
    return splitting.eval_split(v.spark.read.parquet(path), "val").select("userId", "movieId", "rating")


@register("s10_artifacts", with_views(["movies"], """
SELECT movieId, row_number() OVER (ORDER BY movieId) - 1 AS movie_idx, title FROM movies"""))
def s10_artifacts(v):
    """Named tables under one folder: an index and the titles."""
    base = scratch_path(v.spark, "artifacts")
    artifacts.save_artifacts(base, index=indexing.build_index(v.movies_raw, "movieId", "movie_idx"), titles=v.movies_raw.select("movieId", "title"))
    return artifacts.load_artifact(v.spark, base, "index").join(artifacts.load_artifact(v.spark, base, "titles"), "movieId").select(
        "movieId", F.col("movie_idx").cast("bigint").alias("movie_idx"), "title")


@register("s11_saved_model", with_views(["movies"], """
SELECT movie_idx, rank, true AS same_as_fitted, 'cosine' AS metric FROM
(SELECT row_number() OVER (ORDER BY movieId) - 1 AS movie_idx FROM movies),
(SELECT unnest(range(1, 1 + least(100, (SELECT count(*) FROM movies) - 1))) AS rank)"""))
def s11_saved_model(v):
    """A fitted recipe, saved and loaded: the loaded neighbours are the fitted ones, all of them."""
    base = scratch_path(v.spark, "models")
    model = ContentModel(SPECS["cb2"]).fit(_groups(v))
    model.save(base)
    loaded = ContentModel.load(v.spark, base, "cb2")
    pair = ["movie_idx", "rank", "neighbour_idx"]
    fitted = model.neighbours.select(*pair, F.lit(True).alias("same"))
    # Lists compress so well that the planner takes them for small: no broadcast of them.
    return loaded.neighbours.select(*pair).join(fitted.hint("merge"), pair, "left").select(
        F.col("movie_idx").cast("bigint").alias("movie_idx"), F.col("rank").cast("bigint").alias("rank"),
        F.coalesce("same", F.lit(False)).alias("same_as_fitted"), F.lit(loaded.spec.metric).alias("metric"))


@register("s12_params", with_views(["ratings"], """
SELECT 'n_ratings' AS name, count(*)::DOUBLE AS value FROM ratings UNION ALL SELECT 'mean', round(avg(rating), 6) FROM ratings"""))
def s12_params(v):
    base = scratch_path(v.spark, "params")
    n, mean = v.ratings.agg(F.count(F.lit(1)), F.round(F.avg("rating"), 6)).first()
    artifacts.save_params(v.spark, base, "params", {"n_ratings": float(n), "mean": mean})
    found = artifacts.load_params(v.spark, base, "params")
    return v.spark.createDataFrame(list(found.items()), "name STRING, value DOUBLE")


@register("s13_results_csv", _sql("""SELECT model, n_users, rmse, "hr@10", "ndcg@10", "p@20" FROM cf"""))
def s13_results_csv(v):
    path = scratch_path(v.spark, "results")
    tables.write_results_csv(_cf(v), path)
    return tables.read_results_csv(v.spark, path, "model STRING, n_users BIGINT, rmse DOUBLE, `hr@10` DOUBLE, `ndcg@10` DOUBLE, `p@20` DOUBLE")


@register("r1_stream_with_compaction", with_views(["feed"], """
SELECT user_id, title, rating FROM (SELECT *, row_number() OVER (PARTITION BY user_id, title ORDER BY ts DESC, event_id DESC) AS rn FROM feed)
WHERE rn = 1 AND op = 'upsert'"""))
def r1_stream_with_compaction(v):
    """The feed in three deliveries out of order, streamed one file at a time, folded after each."""
    base = scratch_path(v.spark, "feed")
    schema = v.feed.schema
    for i in (2, 0, 1):
        v.feed.filter(F.pmod("event_id", F.lit(3)) == i).coalesce(2).write.mode("append").parquet(f"{base}/in")
        stream = v.spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{base}/in")
        rating_feed.stream_changes(stream, f"{base}/out", f"{base}/progress").awaitTermination()
        rating_feed.compact(v.spark, f"{base}/out")
    return rating_feed.read_current(v.spark, f"{base}/out")


@register("e13_prepare", with_views(["split", "tags", "genome_scores", "movies"], """
SELECT 'filtered' AS name, count(*) AS n_rows, round(sum(rating), 3) AS total FROM filtered
UNION ALL SELECT 'user_index', count(*), sum(userId)::DOUBLE FROM (SELECT DISTINCT userId FROM filtered)
UNION ALL SELECT 'movie_index', count(*), sum(movieId)::DOUBLE FROM m
UNION ALL SELECT 'ratings_' || split, count(*), round(sum(rating), 3) FROM split GROUP BY split
UNION ALL SELECT 'tags', count(*), sum(length(tag))::DOUBLE FROM kt
UNION ALL SELECT 'tag_text', count(*), sum(length(t))::DOUBLE FROM (SELECT string_agg(tag, ' ') AS t FROM kt GROUP BY movieId, userId >> 12)
UNION ALL SELECT 'genome', (SELECT count(*) FROM m), round(sum(relevance), 3) FROM genome_scores SEMI JOIN m USING (movieId)
UNION ALL SELECT 'genome_tags', count(*), sum(length(tag))::DOUBLE FROM gt
UNION ALL SELECT 'items', count(*), sum(length(title))::DOUBLE FROM movies SEMI JOIN m USING (movieId)""", {
    "m": "SELECT DISTINCT movieId FROM filtered", "kt": "SELECT * FROM tags SEMI JOIN m USING (movieId)", "gt": _GENOME_TAGS}))
def e13_prepare(v):
    """All tables of the preparation, written and read back: rows and a total of each."""
    paths = prepare(v.spark, v.ratings, v.movies_raw, v.tags_raw, v.links_raw, v.genome_scores, v.metadata_raw,
                    scratch_path(v.spark, "prepared"), VIEW_MIN_USER, VIEW_MIN_MOVIE, genome_tags=_genome_tags(v))
    totals = {
        "filtered": F.sum("rating"), "user_index": F.sum("userId"), "movie_index": F.sum("movieId"), "tags": F.sum(F.length("tag")),
        "tag_text": F.sum(F.length("tag_text")), "genome": F.sum(F.aggregate("features", F.lit(0.0), lambda a, x: a + x)),
        "genome_tags": F.sum(F.length("tag")), "items": F.sum(F.length("title")),
    }
    read = {name: v.spark.read.parquet(path) for name, path in paths.items()}
    found = read["ratings"].groupBy(F.concat(F.lit("ratings_"), "split").alias("name")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.round(F.sum("rating"), 3).alias("total"))
    for name, total in totals.items():
        found = found.unionByName(read[name].agg(F.count(F.lit(1)).alias("n_rows"), F.round(total.cast("double"), 3).alias("total")).withColumn("name", F.lit(name)))
    return found
