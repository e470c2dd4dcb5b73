"""Golden rows and invariants of scans, filters, ids and splits."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tastemill.functions import metadata, text
from tastemill.operators import filtering, indexing, matrices, ranking, splitting, tag_text
from tastemill.sources import artifacts, metadata_cache, tables


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


def test_csv_scans(spark, tmp_path):
    (tmp_path / "movies.csv").write_text(
        'movieId,title,genres\n1,"American President, The (1995)",Comedy|Drama\n'
        '2,"Say ""Yes"" (to me) (1999)",(no genres listed)\n3,No Year,Drama\n', encoding="utf-8"
    )
    (tmp_path / "links.csv").write_text("movieId,imdbId,tmdbId\n1,0114709,862\n2,0000001,\n3,0000002,abc\n")
    (tmp_path / "tags.csv").write_text("userId,movieId,tag,timestamp\n1,1, Fun\tNY ,10\n2,1,,11\n")
    (tmp_path / "ratings.csv").write_text("userId,movieId,rating,timestamp\n1,1,4.5,100\n")
    (tmp_path / "gs.csv").write_text("movieId,tagId,relevance\n1,1,0.5\n")
    (tmp_path / "gt.csv").write_text("tagId,tag\n1,007\n")
    movies = tables.load_movies(spark, f"{tmp_path}/movies.csv")
    assert rows(movies.select("movieId", "title", "year", "title_clean", "genres_list"), "movieId") == [
        (1, "American President, The (1995)", 1995, "American President, The", ["Comedy", "Drama"]),
        (2, 'Say "Yes" (to me) (1999)', 1999, 'Say "Yes" (to me)', []),
        (3, "No Year", None, "No Year", ["Drama"]),
    ]
    assert rows(tables.load_links(spark, f"{tmp_path}/links.csv"), "movieId") == [
        (1, "0114709", 862), (2, "0000001", None), (3, "0000002", None)
    ]
    assert [r[2] for r in rows(tables.load_tags(spark, f"{tmp_path}/tags.csv"), "userId")] == ["fun\tny", ""]
    assert rows(tables.load_ratings(spark, f"{tmp_path}/ratings.csv")) == [(1, 1, 4.5, 100)]
    scores, tags = tables.load_genome(spark, f"{tmp_path}/gs.csv", f"{tmp_path}/gt.csv")
    assert rows(scores) == [(1, 1, 0.5)] and rows(tags) == [(1, "007")]


def test_filter_is_one_pass_users_first(spark):
    data = [(u, m, 3.0, 0) for u in (1, 2, 3) for m in (1, 2)] + [(1, 9, 3.0, 0), (4, 1, 3.0, 0)]
    r = spark.createDataFrame(data, "userId LONG, movieId LONG, rating DOUBLE, timestamp LONG")
    out = filtering.filter_ratings(r, 2, 3)
    # user 4 goes first, then movie 9; user 1 stays although only two rows remain
    assert {(x.userId, x.movieId) for x in out.collect()} == {(u, m) for u in (1, 2, 3) for m in (1, 2)}


@pytest.mark.parametrize("n, expect", [(1, (1, 0, 0)), (4, (4, 0, 0)), (5, (3, 1, 1)), (9, (7, 1, 1)), (10, (8, 1, 1)), (19, (17, 1, 1)), (20, (16, 2, 2))])
def test_split_sizes(spark, n, expect):
    r = spark.range(n).selectExpr("7L AS userId", "id AS movieId", "3.0D AS rating", "id AS timestamp")
    for hot in (10**9, 0):
        got = {x["split"]: x["count"] for x in splitting.temporal_split(r, hot_rows=hot).groupBy("split").count().collect()}
        assert tuple(got.get(s, 0) for s in splitting.SPLITS) == expect


def test_split_hot_branch_equals_window(spark, sf_dir):
    from tastemill.sources.driver_views import Views

    r = Views(spark, sf_dir).ratings
    usual = splitting.temporal_split(r)
    for hot_rows, parts in ((0, 1), (36, 7)):
        other = splitting.temporal_split(r.repartition(parts), hot_rows=hot_rows)
        assert usual.exceptAll(other).count() == 0 and other.exceptAll(usual).count() == 0


def test_split_guards(spark):
    r = spark.createDataFrame([(1, 1, 3.0, 1, "val")], "userId LONG, movieId LONG, rating DOUBLE, timestamp LONG, split STRING")
    assert splitting.eval_split(r, "val").count() == 1
    with pytest.raises(ValueError):
        splitting.eval_split(r, "train")
    with pytest.raises(ValueError):
        splitting.select_split(r, "dev")


def test_index_is_dense_and_sorted_for_wide_ids(spark):
    ids = [-(2**62), -5, 0, 3, 2**20, 2**20 + 1, 2**40 + 7, 2**62]
    df = spark.createDataFrame([(i,) for i in ids * 3], "k LONG").repartition(5)
    assert rows(indexing.build_index(df, "k", "i"), "i") == [(k, i) for i, k in enumerate(ids)]


@pytest.mark.parametrize("values", [[1.0], [3.0, 1.0], [5.0, 5.0, 5.0, 1.0], [float(i % 97) for i in range(3001)], [1.0, None, 8.0], [None]])
def test_exact_median(spark, values):
    import statistics

    df = spark.createDataFrame([(v,) for v in values], "x DOUBLE").repartition(3)
    known = [v for v in values if v is not None]
    assert ranking.exact_median(df, "x").first()[0] == (statistics.median(known) if known else None)


def test_median_of_a_million_distinct_values(spark):
    """Both signs, all magnitudes; no plan step orders the values."""
    df = spark.range(1_000_000).select(((F.col("id") * 7919 % 1_000_003 - 400_000) * F.pow(F.lit(10.0), F.col("id") % 9 - 4)).alias("x"))
    values = np.array([r[0] for r in df.collect()])
    assert len(np.unique(values)) > 900_000
    assert ranking.exact_median(df, "x").first()[0] == np.median(values)
    bits = df.mapInArrow(ranking._ordered_bits, "bits BIGINT")
    ranks = [0, 1, 250_000, 999_999]
    assert [ranking._double(b) for b in ranking.select_ranks(bits, ranks)] == np.sort(values)[ranks].tolist()


def test_title_lookups(spark):
    items = spark.createDataFrame([(0, "A"), (1, "B"), (2, "A"), (3, None)], "movie_idx INT, title STRING")
    assert ("A", 2) in rows(indexing.resolve_titles(items))
    recs = spark.createDataFrame([(1,), (3,), (9,)], "movie_idx INT")
    assert [r[1] for r in rows(indexing.attach_titles(recs, items), "movie_idx")] == ["B", "Unknown", "Unknown"]
    first = indexing.first_by_title(items, spark.createDataFrame([("A",)], "title STRING"), "movie_idx")
    assert rows(first) == [("A", 0)]
    asked = spark.createDataFrame([("A",), ("Z",)], "title STRING")
    assert rows(indexing.unresolved_titles(asked, items)) == [("Z",)]


def test_duplicate_cells_are_summed(spark):
    r = spark.createDataFrame([(0, 0, 2.0), (0, 0, 1.5), (0, 1, 3.0)], "user_idx INT, movie_idx INT, rating DOUBLE")
    assert rows(matrices.user_item_cells(r), "movie_idx") == [(0, 0, 3.5), (0, 1, 3.0)]


def test_genome_vectors_align_and_fill(spark):
    s = spark.createDataFrame([(10, 1, 0.5), (10, 3, 0.25), (30, 3, 1.0)], "movieId LONG, tagId INT, relevance DOUBLE")
    index = spark.createDataFrame([(10, 0), (20, 1), (30, 2)], "movieId LONG, movie_idx INT")
    v = matrices.genome_vectors(s, index)
    assert rows(v, "movie_idx") == [(0, [0.5, 0.25]), (1, [0.0, 0.0]), (2, [0.0, 1.0])]
    assert rows(matrices.coverage(v)) == [(3, 2)]


def test_train_only_items_null_without_train_tags(spark):
    tags = spark.createDataFrame([(1, 1, "a", 1), (2, 1, "b", 2), (1, 2, "c", 3)], "userId LONG, movieId LONG, tag STRING, timestamp LONG")
    train = spark.createDataFrame([(2, 1)], "userId LONG, movieId LONG")
    items = spark.createDataFrame([(1, "old"), (2, "old")], "movieId LONG, user_tags_text STRING")
    assert rows(tag_text.train_only_items(items, tags, train), "movieId") == [(1, 0, "b"), (2, None, None)]
    assert rows(tag_text.leakage_report(tags, train, items))[0][:2] == (3, 1)


def test_list_parsers(spark):
    df = spark.createDataFrame([("['a', \"b\"]",), ("plain",), ("[broken",), ("  ",), (None,)], "x STRING")
    out = df.select(text.parse_list(F.col("x")).alias("s"), text.tolerant_list(F.col("x")).alias("t"))
    assert rows(out) == [(["a", "b"], ["a", "b"]), ([], ["plain"]), ([], ["[broken"]), ([], []), ([], [])]


def test_small_text_functions(spark):
    one = spark.range(1)
    got = one.select(
        text.preview(F.lit("x" * 201)), text.preview(F.lit("x")), text.percent_label(F.lit(0.999)), text.percent_label(F.lit(-0.019)),
        text.clip(F.lit(9.0)), text.clip(F.lit(0.1)), text.token("dir_", F.lit("Ann Lee")), text.has_poster(F.lit(None).cast("string")),
        text.long_words(F.lit("Tiny WONDERFUL  words")),
    ).first()
    assert tuple(got) == ("x" * 200 + "...", "x", 99, -1, 5.0, 0.5, "dir_ann_lee", False, ["wonderful", "words"])


def test_metadata_edge_rows(spark):
    raw = [
        (1, '{"overview":"o","poster_path":"","credits":{"cast":[],"crew":[{"job":"Producer","name":"P"}]}}'),
        (2, None),
        (3, '{"runtime":90,"genres":[{"name":"Drama"}],"poster_path":"/p.jpg","credits":{"cast":[{"name":"A"},{"name":"B"}],"crew":[{"job":"Director","name":"D1"},{"job":"Director","name":"D2"}]}}'),
    ]
    flat = metadata.flatten(spark.createDataFrame(raw, "tmdbId LONG, raw STRING"), top_cast=1)
    a, b = flat.orderBy("tmdbId").collect()
    assert (a.poster_url, a.director, a["cast"], a.tmdb_genres) == (None, None, [], [])
    assert (b.poster_url, b.director, b["cast"], b.tmdb_genres, b.runtime_min) == (
        "https://image.tmdb.org/t/p/w500/p.jpg", "D1", ["A"], ["Drama"], 90
    )


def test_cache_plan_and_upsert(spark, tmp_path):
    (tmp_path / "cache.json").write_text('{"tmdbId":1,"raw":"x"}\n{"tmdbId":2,"raw":null}\n')
    cache = metadata_cache.read_cache_jsonl(spark, f"{tmp_path}/cache.json")
    links = spark.createDataFrame([(1, 1), (2, 2), (3, 3), (4, None)], "movieId LONG, tmdbId LONG")
    ids = lambda df: sorted(r[0] for r in df.collect())
    assert ids(metadata_cache.plan_fetch(links, cache)) == [3]
    assert ids(metadata_cache.plan_fetch(links, cache, retry_failed=True)) == [2, 3]
    assert ids(metadata_cache.plan_fetch(links, cache, max_movies=2)) == []
    new = spark.createDataFrame([(1, "y"), (3, "z")], "tmdbId LONG, raw STRING")
    assert rows(metadata_cache.upsert(cache, new), "tmdbId") == [(1, "x"), (2, None), (3, "z")]
    assert rows(metadata_cache.upsert(cache, new, force=True), "tmdbId") == [(1, "y"), (2, None), (3, "z")]
    assert ids(metadata_cache.failed_ids(cache)) == [2] and ids(metadata_cache.successful_ids(cache)) == [1]


def test_artifacts_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(0, [1.0, 2.0])], "movie_idx INT, features ARRAY<FLOAT>")
    artifacts.save_artifacts(str(tmp_path), matrix=df)
    assert rows(artifacts.load_artifact(spark, str(tmp_path), "matrix")) == rows(df)
    with pytest.raises(FileNotFoundError):
        artifacts.load_artifact(spark, str(tmp_path), "absent")
    res = spark.createDataFrame([("cb1", 5, 0.5)], "model STRING, n_users LONG, `hr@10` DOUBLE")
    tables.write_results_csv(res, f"{tmp_path}/res")
    assert rows(tables.read_results_csv(spark, f"{tmp_path}/res", "model STRING, n_users BIGINT, `hr@10` DOUBLE")) == rows(res)


def test_prepare_writes_all_tables(spark, sf_dir, tmp_path):
    from tastemill.plans.prepare import prepare
    from tastemill.sources.driver_views import Views

    v = Views(spark, sf_dir)
    paths = prepare(
        spark, v.ratings, v.movies_raw, v.tags_raw, v.links_raw, v.genome_scores, v.metadata_raw,
        str(tmp_path), 20, 20,
    )
    ratings = spark.read.parquet(paths["ratings"])
    assert {"split", "user_idx", "movie_idx"} <= set(ratings.columns) and ratings.count() == 4885
    items = tables.read_items(spark, paths["items"], ["movie_idx", "title"])
    assert items.columns == ["movie_idx", "title"] and items.count() == 183


def test_tag_chunks_are_numbered_and_join_to_the_text(spark):
    far = 5 << tag_text.USER_RANGE_BITS
    tags = spark.createDataFrame([(far, 1, "late", 1), (2, 1, "b", 7), (2, 1, "a", 7), (1, 1, "first", 9), (far + 1, 1, "last", 0), (3, 2, "x", 1)],
                                 "userId LONG, movieId LONG, tag STRING, timestamp LONG").repartition(3)
    assert rows(tag_text.tag_chunks(tags), "movieId", "chunk") == [(1, 0, "first a b"), (1, 1, "late last"), (2, 0, "x")]
    assert rows(tag_text.concat_tags(tags), "movieId") == [(1, "first a b late last"), (2, "x")]


def test_persisted_cache_rewrites_touched_buckets_only(spark, tmp_path):
    import glob
    import os

    path = f"{tmp_path}/cache"
    files = lambda: {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{path}/bucket=*/*.parquet")}
    first = spark.createDataFrame([(k, f"r{k}" if k % 3 else None) for k in range(200)], "tmdbId LONG, raw STRING")
    metadata_cache.upsert_cache(spark, path, first)
    assert rows(metadata_cache.read_cache(spark, path), "tmdbId") == rows(first, "tmdbId")
    before = files()
    more = spark.createDataFrame([(3, "new"), (500, "five hundred")], "tmdbId LONG, raw STRING")
    metadata_cache.upsert_cache(spark, path, more)
    kept = dict(rows(metadata_cache.read_cache(spark, path)))
    assert kept[3] is None and kept[500] == "five hundred" and len(kept) == 201
    after = files()
    changed = {os.path.dirname(f) for f, _ in set(before.items()) ^ set(after.items())}
    assert 1 <= len(changed) <= 2
    metadata_cache.upsert_cache(spark, path, more, force=True)
    kept = dict(rows(metadata_cache.read_cache(spark, path)))
    assert kept[3] == "new" and kept[500] == "five hundred" and len(kept) == 201
    metadata_cache.upsert_cache(spark, path, more.limit(0))
    assert len(dict(rows(metadata_cache.read_cache(spark, path)))) == 201


def test_lists_as_text_or_as_arrays(spark):
    df = spark.createDataFrame([("['a', 'b']", ["c"]), (None, None), ("plain", [])], "t STRING, a ARRAY<STRING>")
    got = df.select(text.as_list(df, "t").alias("t"), text.as_list(df, "a").alias("a"))
    assert rows(got) == [(["a", "b"], ["c"]), ([], []), (["plain"], [])]
