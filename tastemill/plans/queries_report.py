"""Queries: result comparison, taste profiles, change feed."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import metadata, text
from ..operators import insights, reporting
from ..operators.indexing import first_by_title, resolve_titles
from ..sources import tables
from ..sources.driver_views import Views, with_views
from ..streaming import feed as rating_feed
from .registry import register

# Result tables are derived from the data: one popularity-style ranking per
# market segment of the customers, named like two strategies of four models.
_RESULTS_SQL = {
    "per": """SELECT c_mktsegment, CASE l_returnflag WHEN 'A' THEN 'weighted' ELSE 'mean_centering' END AS variant, count(*) AS n_lines, count(DISTINCT c_custkey) AS n_users,
        avg(l_discount) AS d, avg(l_tax) AS t, avg(l_quantity) / 100 AS q
        FROM customer JOIN orders ON o_custkey = c_custkey JOIN lineitem ON l_orderkey = o_orderkey GROUP BY ALL""",
    "results": """SELECT 'cb' || CAST(dense_rank() OVER (ORDER BY c_mktsegment) AS VARCHAR) || '_' || variant AS model, n_users,
        round(d, 9) AS "hr@10", round(t, 9) AS "ndcg@10", round(q, 9) AS "p@20" FROM per""",
    "cf": """SELECT 'CF_' || l_returnflag || '_' || l_linestatus AS model, count(DISTINCT l_suppkey) AS n_users,
        round(avg(l_extendedprice) / 50000, 9) AS rmse, round(avg(l_discount), 9) AS "hr@10", round(avg(l_tax), 9) AS "ndcg@10",
        round(avg(l_quantity) / 100, 9) AS "p@20" FROM lineitem GROUP BY l_returnflag, l_linestatus""",
    "long": """SELECT model, name, value FROM (UNPIVOT (SELECT model, "hr@10", "p@20", "ndcg@10" FROM results) ON "hr@10", "p@20", "ndcg@10" INTO NAME name VALUE value)""",
}
_R_KS = (10, 20)


def _sql(body: str) -> str:
    return "WITH " + ",\n".join(f"{n} AS ({s})" for n, s in _RESULTS_SQL.items()) + body


def _cb(v: Views):
    variant = F.when(F.col("l_returnflag") == "A", "weighted").otherwise("mean_centering").alias("variant")
    per = (
        v.table("customer").join(v.table("orders"), F.col("o_custkey") == F.col("c_custkey"))
        .join(v.table("lineitem"), F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy("c_mktsegment", variant).agg(
            F.countDistinct("c_custkey").alias("n_users"), F.avg("l_discount").alias("d"),
            F.avg("l_tax").alias("t"), (F.avg("l_quantity") / 100).alias("q"),
        )
    )
    segments = per.agg(F.array_sort(F.collect_set("c_mktsegment"))).scalar()
    number = F.array_position(segments, F.col("c_mktsegment")).cast("string")
    return per.select(
        F.concat(F.lit("cb"), number, F.lit("_"), "variant").alias("model"), "n_users",
        F.round("d", 9).alias("hr@10"), F.round("t", 9).alias("ndcg@10"), F.round("q", 9).alias("p@20"),
    )


def _cf(v: Views):
    return v.table("lineitem").groupBy("l_returnflag", "l_linestatus").agg(
        F.countDistinct("l_suppkey").alias("n_users"), F.round(F.avg("l_extendedprice") / 50000, 9).alias("rmse"),
        F.round(F.avg("l_discount"), 9).alias("hr@10"), F.round(F.avg("l_tax"), 9).alias("ndcg@10"),
        F.round(F.avg("l_quantity") / 100, 9).alias("p@20"),
    ).select(F.concat_ws("_", F.lit("CF"), "l_returnflag", "l_linestatus").alias("model"), "n_users", "rmse", "`hr@10`", "`ndcg@10`", "`p@20`")


@register("a12_variant_mean", _sql("""
SELECT name AS metric, round(avg(value) FILTER (model LIKE '%weighted'), 6) AS weighted,
  round(avg(value) FILTER (model LIKE '%mean_centering'), 6) AS mean_centering FROM long GROUP BY name"""))
def a12_variant_mean(v):
    return reporting.variant_means(_cb(v), _R_KS).select("metric", *[F.round(c, 6).alias(c) for c in ("weighted", "mean_centering")])


@register("a13_best_model", _sql("""
SELECT name AS metric, arg_max(model, value) AS model, round(max(value), 6) AS value FROM
  (UNPIVOT (SELECT model, "hr@10", "p@20", "ndcg@10" FROM cf) ON "hr@10", "p@20", "ndcg@10" INTO NAME name VALUE value) GROUP BY name
UNION ALL SELECT 'rmse', arg_min(model, rmse), round(min(rmse), 6) FROM cf"""))
def a13_best_model(v):
    return reporting.best_models(_cf(v), _R_KS).withColumn("value", F.round("value", 6))


@register("a14_pivot", _sql("""
SELECT regexp_extract(model, '^(cb\\d+)_', 1) AS base, round(max("ndcg@10") FILTER (model LIKE '%weighted'), 6) AS weighted,
  round(max("ndcg@10") FILTER (model LIKE '%mean_centering'), 6) AS mean_centering FROM results GROUP BY base"""))
def a14_pivot(v):
    return reporting.pivot_metric(_cb(v), "ndcg@10").select("base", *[F.round(c, 6).alias(c) for c in ("weighted", "mean_centering")])


@register("t19_model_key", _sql("""
SELECT model, regexp_extract(model, '^(cb\\d+)_(.*)$', 1) AS base, regexp_extract(model, '^(cb\\d+)_(.*)$', 2) AS variant,
  CAST(regexp_extract(model, '^cb(\\d+)', 1) AS INT) AS model_number FROM results"""))
def t19_model_key(v):
    return reporting.sorted_results(_cb(v)).select("model", "base", "variant", "model_number")


@register("t22_unpivot", _sql("SELECT model, name, round(value, 6) AS value FROM long"))
def t22_unpivot(v):
    return reporting.unpivot_metrics(_cb(v), _R_KS).withColumn("value", F.round("value", 6))


@register("t24_metric_by_k", _sql("""
SELECT model, split_part(name, '@', 1) AS metric, CAST(split_part(name, '@', 2) AS INT) AS k, round(value, 6) AS value FROM long"""))
def t24_metric_by_k(v):
    return reporting.metric_by_k(_cb(v), _R_KS).withColumn("value", F.round("value", 6))


@register("t23_relative_gain", _sql("""
SELECT l.name AS metric, lm AS left_model, rm AS right_model, round((l - r) / r * 100, 6) AS gain_percent FROM
 (SELECT name, arg_max(model, value) AS lm, max(value) AS l FROM long GROUP BY name) l JOIN
 (SELECT name, arg_max(model, value) AS rm, max(value) AS r FROM
   (UNPIVOT (SELECT model, "hr@10", "p@20", "ndcg@10" FROM cf) ON "hr@10", "p@20", "ndcg@10" INTO NAME name VALUE value) GROUP BY name) r USING (name)"""))
def t23_relative_gain(v):
    return reporting.relative_gain(_cb(v), _cf(v), _R_KS).withColumn("gain_percent", F.round("gain_percent", 6))


@register("o4_top_models", _sql('SELECT model, round("ndcg@10", 6) AS value FROM results ORDER BY "ndcg@10" DESC, model LIMIT 5'))
def o4_top_models(v):
    return reporting.top_models(_cb(v)).withColumn("value", F.round("value", 6))


@register("t21_markdown", _sql("""
SELECT 0 AS part, '' AS model, '|model|n_users|hr@10|ndcg@10|p@20|' AS line
UNION ALL SELECT 1, '', '|:--|--:|--:|--:|--:|'
UNION ALL SELECT 2, model, '|' || model || '|' || n_users || printf('|%.4f|%.4f|%.4f|', "hr@10", "ndcg@10", "p@20") FROM results"""))
def t21_markdown(v):
    return reporting.markdown_lines(_cb(v), _R_KS)


@register("t20_rounded_report", _sql('SELECT model, n_users, round(rmse, 4) AS rmse, round("hr@10", 6) AS "hr@10", round("ndcg@10", 6) AS "ndcg@10", round("p@20", 6) AS "p@20" FROM cf'))
def t20_rounded_report(v):
    return reporting.rounded(_cf(v), _R_KS)


# --- taste profiles --------------------------------------------------------------


def _profile_items(v: Views):
    return (
        tables.preprocess_movies(v.movies_raw)
        .join(tables.type_links(v.links_raw), "movieId", "left").join(metadata.flatten(v.metadata_raw), "tmdbId", "left")
        .withColumnRenamed("movieId", "movie_idx")
    )


_TASTE = {
    "liked": "SELECT userId AS user_id, movieId FROM ratings WHERE rating >= 4.0",
    "vals": """SELECT movieId, 'genre' AS kind, unnest(genres_list) AS value FROM movies_pre
        UNION ALL SELECT movieId, 'cast', unnest(string_split(cast_names, '|')) FROM links JOIN metadata USING (tmdbId) WHERE cast_names <> ''
        UNION ALL SELECT movieId, 'director', director FROM links JOIN metadata USING (tmdbId) WHERE director IS NOT NULL
        UNION ALL SELECT movieId, 'tag', w FROM (SELECT movieId, unnest(string_split_regex(tag, '\\s+')) AS w FROM tags) WHERE length(w) > 4""",
    "cnt": "SELECT user_id, kind, value, count(*) AS n FROM liked JOIN vals USING (movieId) GROUP BY ALL",
    "rk": "SELECT *, row_number() OVER (PARTITION BY user_id, kind ORDER BY n DESC, value) AS rank FROM cnt",
}


@register("a11_taste_profile", with_views(["ratings", "movies_pre", "links", "metadata", "tags"], """
SELECT user_id, kind, rank, value, n FROM rk
WHERE (kind = 'tag' AND rank <= 125 AND n > 1) OR (kind <> 'tag' AND rank <= 5)""", _TASTE))
def a11_taste_profile(v):
    ratings = v.ratings.withColumnsRenamed({"userId": "user_id", "movieId": "movie_idx"})
    tags = tables.clean_tags(v.tags_raw).select(F.col("movieId").alias("movie_idx"), "tag")
    return insights.taste_profile(ratings, _profile_items(v), tags=tags).select("user_id", "kind", "rank", "value", "n")


@register("p6_liked_items", with_views(["ratings", "movies"], """
SELECT userId AS user_id, movieId AS movie_idx, title FROM ratings JOIN movies USING (movieId) WHERE rating >= 4.0"""))
def p6_liked_items(v):
    ratings = v.ratings.withColumnsRenamed({"userId": "user_id", "movieId": "movie_idx"})
    return insights.liked_items(ratings, v.movies_raw.withColumnRenamed("movieId", "movie_idx")).select("user_id", "movie_idx", "title")


@register("p7_first_by_title", with_views(["movies"], """
SELECT title, min(movieId) AS movieId, arg_min(genres, movieId) AS genres FROM movies GROUP BY title"""))
def p7_first_by_title(v):
    return first_by_title(v.movies_raw, v.movies_raw.select("title")).select("title", "movieId", "genres")


@register("j9_title_lookup", with_views(["movies"], "SELECT title, max(movieId) AS movie_idx FROM movies GROUP BY title"))
def j9_title_lookup(v):
    return resolve_titles(v.movies_raw.withColumnRenamed("movieId", "movie_idx"))


@register("t15_tag_words", with_views(["tags"], """
SELECT movieId, w AS word, count(*) AS n FROM (SELECT movieId, unnest(string_split_regex(tag, '\\s+')) AS w FROM tags) WHERE length(w) > 4 GROUP BY ALL"""))
def t15_tag_words(v):
    tags = tables.clean_tags(v.tags_raw)
    words = tags.select("movieId", F.explode(text.long_words(F.col("tag"))).alias("word"))
    return words.groupBy("movieId", "word").agg(F.count(F.lit(1)).alias("n"))


@register("t16_preview", """
SELECT doc_id, CASE WHEN length(text) > 200 THEN substr(text, 1, 200) || '...' ELSE text END AS preview FROM documents""")
def t16_preview(v):
    return v.documents.select("doc_id", text.preview(F.col("text")).alias("preview"))


@register("r1_current_ratings", with_views(["feed"], """
SELECT user_id, title, rating FROM (SELECT *, row_number() OVER (PARTITION BY user_id, title ORDER BY ts DESC, event_id DESC) AS rn FROM feed)
WHERE rn = 1 AND op = 'upsert'"""))
def r1_current_ratings(v):
    return rating_feed.current_ratings(v.feed)
