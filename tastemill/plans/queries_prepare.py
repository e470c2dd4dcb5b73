"""Queries: scans, filters, ids, splits, tags, metadata, enrichment."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import metadata, text
from ..operators import filtering, indexing, matrices, splitting, tag_text
from ..session import cut_lineage
from ..sources import metadata_cache, tables
from ..sources.driver_views import VIEW_MIN_MOVIE, VIEW_MIN_USER, Views, with_views
from . import prepare
from .registry import register


def active(v: Views):
    return filtering.filter_ratings(v.ratings, VIEW_MIN_USER, VIEW_MIN_MOVIE)


def filtered(v: Views):
    """The active ratings as a written table, for queries with several readers."""
    return cut_lineage(active(v))


def split(v: Views):
    return splitting.temporal_split(filtered(v))


@register("s1_ratings_profile", with_views(["ratings", "filtered"], """
SELECT 'before' AS stage, count(*) AS n_ratings, count(DISTINCT userId) AS n_users,
       count(DISTINCT movieId) AS n_movies FROM ratings
UNION ALL SELECT 'after', count(*), count(DISTINCT userId), count(DISTINCT movieId) FROM filtered"""))
def s1_ratings_profile(v):
    return filtering.filter_report(v.ratings, active(v))


@register("s15_table_profile", with_views(["ratings"], """
SELECT 0 AS position, 'userId' AS "column", 'bigint' AS type, count(*) AS n_rows,
       count(*) - count(userId) AS n_null, count(DISTINCT userId) AS n_distinct FROM ratings
UNION ALL SELECT 1, 'movieId', 'bigint', count(*), count(*) - count(movieId), count(DISTINCT movieId) FROM ratings
UNION ALL SELECT 2, 'rating', 'double', count(*), count(*) - count(rating), count(DISTINCT rating) FROM ratings
UNION ALL SELECT 3, 'timestamp', 'bigint', count(*), count(*) - count("timestamp"), count(DISTINCT "timestamp") FROM ratings"""))
def s15_table_profile(v):
    return tables.table_profile(v.ratings)


@register("a1_rating_counts", with_views(["ratings"], """
SELECT 'user' AS kind, userId AS id, count(*) AS n FROM ratings GROUP BY userId
UNION ALL SELECT 'movie', movieId, count(*) FROM ratings GROUP BY movieId"""))
def a1_rating_counts(v):
    return (
        filtering.rating_counts(v.ratings, "userId").select(F.lit("user").alias("kind"), F.col("userId").alias("id"), "n")
        .unionByName(filtering.rating_counts(v.ratings, "movieId").select(F.lit("movie").alias("kind"), F.col("movieId").alias("id"), "n"))
    )


@register("a4_user_histories", with_views(["filtered"], """
SELECT userId, movieId // 4096 AS chunk, count(*) AS n_items,
       string_agg(concat(movieId, ':', CAST(CAST(rating * 2 AS INT) AS VARCHAR)), '|' ORDER BY movieId) AS history
FROM filtered GROUP BY ALL"""))
def a4_user_histories(v):
    h = matrices.user_histories(active(v))
    item = lambda x: F.concat(x["movieId"].cast("string"), F.lit(":"), (x["rating"] * 2).cast("int").cast("string"))
    return h.select(
        "userId", "chunk", F.size("history").cast("bigint").alias("n_items"),
        F.array_join(F.transform("history", item), "|").alias("history"),
    )


@register("p1_activity_filter", with_views(["filtered"], 'SELECT userId, movieId, rating, "timestamp" FROM filtered'))
def p1_activity_filter(v):
    return active(v).select("userId", "movieId", "rating", "timestamp")


@register("p2_align_catalogue", with_views(["filtered", "movies", "links", "tags"], """
SELECT movieId, title, imdbId, tmdbId, n_tags FROM movies SEMI JOIN kept USING (movieId)
JOIN links USING (movieId)
LEFT JOIN (SELECT movieId, count(*) AS n_tags FROM tags SEMI JOIN kept USING (movieId) GROUP BY movieId) USING (movieId)""", {"kept": "SELECT DISTINCT movieId FROM filtered"}))
def p2_align_catalogue(v):
    r = filtered(v)
    movies = filtering.align_to_ratings(v.movies_raw, r)
    links = filtering.align_to_ratings(tables.type_links(v.links_raw), r)
    tags = filtering.align_to_ratings(tables.clean_tags(v.tags_raw), r)
    counts = tags.groupBy("movieId").agg(F.count(F.lit(1)).alias("n_tags"))
    return movies.select("movieId", "title").join(links, "movieId").join(counts, "movieId", "left")


_IDX = {
    "u": "SELECT userId, CAST(dense_rank() OVER (ORDER BY userId) - 1 AS INT) AS user_idx FROM (SELECT DISTINCT userId FROM filtered)",
    "m": "SELECT movieId, CAST(dense_rank() OVER (ORDER BY movieId) - 1 AS INT) AS movie_idx FROM (SELECT DISTINCT movieId FROM filtered)",
}


@register("w2_encode_ids", with_views(["filtered"], """
SELECT 'user' AS kind, userId AS id, user_idx AS idx FROM u
UNION ALL SELECT 'movie', movieId, movie_idx FROM m""", _IDX))
def w2_encode_ids(v):
    r = filtered(v)
    users = indexing.build_index(r, "userId", "idx").select(F.lit("user").alias("kind"), F.col("userId").alias("id"), "idx")
    movies = indexing.build_index(r, "movieId", "idx").select(F.lit("movie").alias("kind"), F.col("movieId").alias("id"), "idx")
    return users.unionByName(movies)


@register("j4_attach_idx", with_views(["filtered"], """
SELECT userId, movieId, user_idx, movie_idx, rating FROM filtered JOIN u USING (userId) JOIN m USING (movieId)""", _IDX))
def j4_attach_idx(v):
    encoded, _, _ = indexing.encode_ids(filtered(v))
    return encoded.select("userId", "movieId", "user_idx", "movie_idx", "rating")


@register("w1_temporal_split", with_views(["split"], 'SELECT userId, movieId, rating, "timestamp", split FROM split'))
def w1_temporal_split(v):
    return split(v)


@register("a10_split_summary", with_views(["split"], """
SELECT split, count(*) AS n_rows, round(count(*) / CAST(sum(count(*)) OVER () AS DOUBLE), 6) AS share FROM split GROUP BY split"""))
def a10_split_summary(v):
    return splitting.split_summary(split(v)).withColumn("share", F.round("share", 6))


@register("u1_train_val_union", with_views(["split"], """
SELECT userId, movieId, rating, split FROM split WHERE split IN ('train', 'val')"""))
def u1_train_val_union(v):
    return splitting.train_val(split(v)).select("userId", "movieId", "rating", "split")


@register("e8_eval_split", with_views(["split"], "SELECT userId, movieId, rating FROM split WHERE split = 'test'"))
def e8_eval_split(v):
    return splitting.eval_split(split(v), "test").select("userId", "movieId", "rating")


@register("a5_sparse_matrix", with_views(["filtered"], """
SELECT user_idx, movie_idx, sum(rating) AS rating FROM filtered JOIN u USING (userId) JOIN m USING (movieId) GROUP BY ALL""", _IDX))
def a5_sparse_matrix(v):
    encoded, _, _ = indexing.encode_ids(filtered(v))
    return matrices.user_item_cells(encoded)


@register("a5_sparsity", with_views(["filtered"], """
SELECT count(*) AS nnz, count(DISTINCT userId) AS n_users, count(DISTINCT movieId) AS n_movies,
       round(1 - count(*) / (count(DISTINCT userId)::DOUBLE * count(DISTINCT movieId)), 6) AS sparsity FROM filtered"""))
def a5_sparsity(v):
    encoded, users, movies = indexing.encode_ids(filtered(v))
    return matrices.sparsity(matrices.user_item_cells(encoded), users, movies).withColumn("sparsity", F.round("sparsity", 6))


_GENOME = {
    "items": "SELECT movieId, CAST(row_number() OVER (ORDER BY movieId) - 1 AS INT) AS movie_idx FROM movies",
    "ntags": "SELECT count(DISTINCT tagId) AS nt FROM genome_scores",
    "gv": """SELECT movie_idx, CASE WHEN count(tagId) = 0 THEN NULL ELSE
        array_to_string(list_transform(list(relevance ORDER BY tagId), lambda x: CAST(CAST(round(x * 1000000) AS BIGINT) AS VARCHAR)), '|') END AS features,
        coalesce(sum(relevance), 0) AS total
        FROM items LEFT JOIN genome_scores USING (movieId) GROUP BY movie_idx""",
}


def _genome(v):
    items = indexing.build_index(v.movies_raw, "movieId", "movie_idx")
    return matrices.genome_vectors(v.genome_scores, items)


@register("a6_genome_vectors", with_views(["movies", "genome_scores"], """
SELECT movie_idx, coalesce(features, array_to_string(list_transform(range(nt), lambda i: '0'), '|')) AS features FROM gv, ntags""", _GENOME))
def a6_genome_vectors(v):
    micro = F.transform("features", lambda x: F.round(x * 1000000).cast("bigint").cast("string"))
    return _genome(v).select("movie_idx", F.array_join(micro, "|").alias("features"))


@register("a7_genome_coverage", with_views(["movies", "genome_scores"], """
SELECT count(*) AS n_items, count_if(total > 0) AS n_covered FROM gv""", _GENOME))
def a7_genome_coverage(v):
    return matrices.coverage(_genome(v))


@register("t1_title_year", with_views(["movies_pre"], "SELECT movieId, title, year, title_clean FROM movies_pre"))
def t1_title_year(v):
    return tables.preprocess_movies(v.movies_raw).select("movieId", "title", "year", "title_clean")


@register("t3_genres_list", with_views(["movies_pre"], """
SELECT movieId, len(genres_list) AS n_genres, array_to_string(genres_list, ';') AS genres_list FROM movies_pre"""))
def t3_genres_list(v):
    m = tables.preprocess_movies(v.movies_raw)
    return m.select("movieId", F.size("genres_list").cast("bigint").alias("n_genres"), F.array_join("genres_list", ";").alias("genres_list"))


@register("s3_tags_clean", with_views(["tags"], 'SELECT userId, movieId, tag, "timestamp" FROM tags'))
def s3_tags_clean(v):
    return tables.clean_tags(v.tags_raw)


@register("a3_tag_text", with_views(["tags"], """
SELECT movieId, row_number() OVER (PARTITION BY movieId ORDER BY r) - 1 AS chunk, tag_text FROM
(SELECT movieId, userId >> 12 AS r, string_agg(tag, ' ' ORDER BY userId, "timestamp", tag) AS tag_text FROM tags GROUP BY ALL)"""))
def a3_tag_text(v):
    return tag_text.tag_chunks(tables.clean_tags(v.tags_raw))


_TRAIN_TAGS = {
    "train": "SELECT userId, movieId FROM split WHERE split = 'train'",
    "catalogue": "SELECT DISTINCT movieId FROM filtered",
    "tt": "SELECT * FROM tags SEMI JOIN train USING (userId, movieId) SEMI JOIN catalogue USING (movieId)",
}


def _train_inputs(v):
    r = filtered(v)
    train = splitting.select_split(splitting.temporal_split(r), "train")
    items = filtering.align_to_ratings(v.movies_raw, r)
    return tables.clean_tags(v.tags_raw), train, items


@register("j5_train_only_tags", with_views(["split", "tags"], 'SELECT userId, movieId, tag, "timestamp" FROM tt', _TRAIN_TAGS))
def j5_train_only_tags(v):
    return tag_text.train_only_tags(*_train_inputs(v)).select("userId", "movieId", "tag", "timestamp")


@register("a17_tag_leakage", with_views(["split", "tags"], """
SELECT c AS n_catalogue_tags, t AS n_train_tags, round(t * 100.0::DOUBLE / c, 6) AS percent_kept, m AS n_movies_rebuilt
FROM (SELECT count(*) AS c FROM tags SEMI JOIN catalogue USING (movieId)),
     (SELECT count(*) AS t, count(DISTINCT movieId) AS m FROM tt)""", _TRAIN_TAGS))
def a17_tag_leakage(v):
    return tag_text.leakage_report(*_train_inputs(v)).withColumn("percent_kept", F.round("percent_kept", 6))


@register("e11_train_only_items", with_views(["split", "tags", "movies"], """
SELECT movieId, title, row_number() OVER (PARTITION BY movieId ORDER BY r) - CASE WHEN tag_text IS NULL THEN NULL ELSE 1 END AS chunk, tag_text
FROM movies SEMI JOIN catalogue USING (movieId)
LEFT JOIN (SELECT movieId, userId >> 12 AS r, string_agg(tag, ' ' ORDER BY userId, "timestamp", tag) AS tag_text FROM tt GROUP BY ALL) USING (movieId)""", _TRAIN_TAGS))
def e11_train_only_items(v):
    tags, train, items = _train_inputs(v)
    return tag_text.train_only_items(items, tags, train).select("movieId", "title", "chunk", "tag_text")


@register("s4_links_typed", with_views(["links"], "SELECT movieId, imdbId, tmdbId FROM links"))
def s4_links_typed(v):
    return tables.type_links(v.links_raw)


@register("j8_ingest_plan", with_views(["links"], """
SELECT 'new' AS plan, tmdbId FROM (SELECT DISTINCT tmdbId FROM links WHERE tmdbId IS NOT NULL)
WHERE tmdbId NOT IN (SELECT tmdbId FROM cached)
UNION ALL
SELECT 'retry', tmdbId FROM (SELECT DISTINCT tmdbId FROM links WHERE tmdbId IS NOT NULL)
WHERE tmdbId NOT IN (SELECT tmdbId FROM cached WHERE ok)""",
    {"cached": "SELECT p_partkey + 100000 AS tmdbId, p_partkey % 13 <> 0 AS ok FROM part WHERE p_retailprice >= 950"}))
def j8_ingest_plan(v):
    """Against a cache that holds the items from one price upward."""
    priced = v.table("part").filter("p_retailprice >= 950").select((F.col("p_partkey") + 100000).alias("tmdbId"))
    cache = v.metadata_raw.join(priced, "tmdbId", "left_semi")
    links = tables.type_links(v.links_raw)
    new = metadata_cache.plan_fetch(links, cache)
    retry = metadata_cache.plan_fetch(links, cache, retry_failed=True)
    return new.select(F.lit("new").alias("plan"), "tmdbId").unionByName(retry.select(F.lit("retry").alias("plan"), "tmdbId"))


@register("p9_ingest_status", """
SELECT p_partkey + 100000 AS tmdbId, CASE WHEN p_partkey % 13 = 0 THEN 'failed' ELSE 'ok' END AS status FROM part""")
def p9_ingest_status(v):
    failed = metadata_cache.failed_ids(v.metadata_raw).withColumn("status", F.lit("failed"))
    return failed.unionByName(metadata_cache.successful_ids(v.metadata_raw).withColumn("status", F.lit("ok")))


@register("a18_ingest_report", """
SELECT count(*) AS n_total, count_if(p_partkey % 13 <> 0) AS n_ok, count_if(p_partkey % 13 = 0) AS n_failed,
  count_if(p_partkey % 13 <> 0) AS n_records, count_if(p_partkey % 13 = 0) AS n_skipped FROM part""")
def a18_ingest_report(v):
    return metadata_cache.ingest_report(v.metadata_raw)


@register("s7_cache_upsert", """
SELECT force, p_partkey + 100000 AS tmdbId,
  CASE WHEN p_retailprice < 950 OR force THEN 'new ' || p_name
       WHEN p_partkey % 13 = 0 THEN NULL ELSE 'old ' || p_name END AS raw
FROM part, (VALUES (true), (false)) t(force)""")
def s7_cache_upsert(v):
    part = v.table("part").withColumn("tmdbId", F.col("p_partkey") + 100000)
    old = part.filter("p_retailprice >= 950").selectExpr("tmdbId", "CASE WHEN p_partkey % 13 <> 0 THEN concat('old ', p_name) END AS raw")
    new = part.selectExpr("tmdbId", "concat('new ', p_name) AS raw")
    return (
        metadata_cache.upsert(old, new, force=True).select(F.lit(True).alias("force"), "*")
        .unionByName(metadata_cache.upsert(old, new).select(F.lit(False).alias("force"), "*"))
    )


@register("t14_metadata_flat", with_views(["metadata"], """
SELECT tmdbId, overview, poster_url, runtime_min, round(vote_average, 6) AS vote_average, tmdb_genres, cast_names, director FROM metadata"""))
def t14_metadata_flat(v):
    return metadata.flatten(v.metadata_raw).select(
        "tmdbId", "overview", "poster_url", "runtime_min", F.round("vote_average", 6).alias("vote_average"),
        F.array_join("tmdb_genres", "|").alias("tmdb_genres"), F.array_join("cast", "|").alias("cast_names"), "director",
    )


@register("t6_parse_list", """
SELECT p_partkey AS movieId,
  CASE p_partkey % 4 WHEN 0 THEN p_name || ';' || p_type WHEN 1 THEN '' WHEN 2 THEN '' ELSE p_brand END AS strict_list,
  CASE p_partkey % 4 WHEN 0 THEN p_name || ';' || p_type WHEN 1 THEN p_name WHEN 2 THEN '' ELSE p_brand END AS tolerant_list,
  CASE WHEN p_partkey % 5 = 0 THEN '' ELSE p_type || ';' || p_name END AS from_array
FROM part""")
def t6_parse_list(v):
    """List literals in single and double quotes, plain text and blanks; arrays and null arrays."""
    literal = F.expr(
        """CASE p_partkey % 4 WHEN 0 THEN concat("['", p_name, "', '", p_type, "']")
           WHEN 1 THEN concat(' ', p_name, ' ') WHEN 2 THEN '   ' ELSE concat('["', p_brand, '"]') END"""
    )
    array = F.when(F.col("p_partkey") % 5 != 0, F.array("p_type", "p_name"))
    rows = v.table("part").select(F.col("p_partkey").alias("movieId"), literal.alias("x"), array.alias("a"))
    return rows.select(
        "movieId", F.array_join(text.as_list(rows, "a"), ";").alias("from_array"),
        F.array_join(text.parse_list(F.col("x")), ";").alias("strict_list"),
        F.array_join(text.as_list(rows, "x"), ";").alias("tolerant_list"),
    )


@register("t8_tokens", with_views(["metadata"], """
SELECT tmdbId, 'dir_' || replace(lower(director), ' ', '_') AS director_token,
  array_to_string(list_transform(list_filter(string_split(cast_names, '|')[1:3], lambda x: x <> ''),
    lambda x: 'cast_' || replace(lower(x), ' ', '_')), '|') AS cast_tokens FROM metadata"""))
def t8_tokens(v):
    flat = metadata.flatten(v.metadata_raw)
    cast = F.transform(text.first_n(F.col("cast"), 3), lambda c: text.token("cast_", c))
    return flat.select("tmdbId", text.token("dir_", F.col("director")).alias("director_token"), F.array_join(cast, "|").alias("cast_tokens"))


@register("t13_poster", with_views(["metadata"], """
SELECT tmdbId, poster_url, poster_url IS NOT NULL AS has_poster FROM metadata"""))
def t13_poster(v):
    flat = metadata.flatten(v.metadata_raw)
    return flat.select("tmdbId", "poster_url", text.has_poster(F.col("poster_url")).alias("has_poster"))


@register("j1_enriched_items", with_views(["filtered", "movies_pre", "links", "tags", "metadata"], """
SELECT movieId, movie_idx, title, title_clean, year, array_to_string(genres_list, ';') AS genres, imdbId, tmdbId, overview,
       poster_url, runtime_min, cast_names, director, user_tags_text
FROM movies_pre JOIN m USING (movieId) LEFT JOIN links USING (movieId) LEFT JOIN metadata USING (tmdbId)
LEFT JOIN (SELECT movieId, string_agg(tag, ' ' ORDER BY userId, "timestamp", tag) AS user_tags_text FROM tags GROUP BY movieId) USING (movieId)""", _IDX))
def j1_enriched_items(v):
    items = prepare.enrich_items(
        tables.preprocess_movies(v.movies_raw),
        indexing.build_index(filtered(v), "movieId", "movie_idx"),
        tables.type_links(v.links_raw),
        metadata.flatten(v.metadata_raw),
        tables.clean_tags(v.tags_raw),
    )
    return items.select(
        "movieId", "movie_idx", "title", "title_clean", "year", F.array_join("genres_list", ";").alias("genres"),
        "imdbId", "tmdbId", "overview", "poster_url", "runtime_min",
        F.array_join("cast", "|").alias("cast_names"), "director", "user_tags_text",
    )


@register("o3_titles", with_views(["movies"], "SELECT title FROM movies WHERE title IS NOT NULL"))
def o3_titles(v):
    return v.movies_raw.select("title").dropna().orderBy("title")


@register("j14_decorate", with_views(["movies", "links", "metadata"], """
SELECT title, poster_url, CASE WHEN length(overview) > 200 THEN substr(overview, 1, 200) || '...' ELSE overview END AS overview FROM
  (SELECT title, max(movieId) AS movieId FROM movies GROUP BY title) JOIN links USING (movieId) LEFT JOIN metadata USING (tmdbId)"""))
def j14_decorate(v):
    """Poster and overview per title; for duplicate titles the last row wins."""
    items = v.movies_raw.join(tables.type_links(v.links_raw), "movieId").join(metadata.flatten(v.metadata_raw), "tmdbId", "left")
    return items.groupBy("title").agg(
        F.max_by(F.struct("poster_url", text.preview(F.col("overview")).alias("overview")), "movieId").alias("d")
    ).select("title", "d.*")
