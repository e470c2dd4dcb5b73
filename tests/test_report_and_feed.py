"""Reports, taste profiles and the change feed."""

from pyspark.sql import functions as F

from tastemill.operators import insights, metrics, reporting
from tastemill.sources.driver_views import Views
from tastemill.streaming import feed

# Published result rows used as test input.
CB = [("cb1_weighted", 62411, 0.016952, 0.002267), ("cb1_mean_centering", 62411, 0.167679, 0.026947),
      ("cb4_weighted", 62411, 0.012370, 0.001410), ("cb4_mean_centering", 62411, 0.209290, 0.034755)]
CF = [("CF_SVD", 62411, 0.7553, 0.186986, 0.030877), ("CF_SVDPP", 62411, 0.7552, 0.183125, 0.029143)]


def cb(spark):
    return spark.createDataFrame(CB, "model STRING, n_users LONG, `hr@10` DOUBLE, `ndcg@10` DOUBLE")


def cf(spark):
    return spark.createDataFrame(CF, "model STRING, n_users LONG, rmse DOUBLE, `hr@10` DOUBLE, `ndcg@10` DOUBLE")


def test_best_and_gain(spark):
    best = {r.metric: r.model for r in reporting.best_models(cf(spark)).collect()}
    assert best == {"rmse": "CF_SVDPP", "hr@10": "CF_SVD", "ndcg@10": "CF_SVD"}
    gain = {r.metric: round(r.gain_percent, 1) for r in reporting.relative_gain(cb(spark), cf(spark)).collect()}
    assert gain == {"hr@10": 11.9, "ndcg@10": 12.6}


def test_variants_and_pivot(spark):
    means = {r.metric: r for r in reporting.variant_means(cb(spark)).collect()}
    assert abs(means["hr@10"].mean_centering - (0.167679 + 0.209290) / 2) < 1e-12
    pivot = {r.base: r.weighted for r in reporting.pivot_metric(cb(spark), "hr@10").collect()}
    assert pivot == {"cb1": 0.016952, "cb4": 0.012370}
    assert [r.model for r in reporting.top_models(cb(spark), n=1).collect()] == ["cb4_mean_centering"]
    order = [r.model for r in reporting.sorted_results(cb(spark)).select("model").collect()]
    assert order == ["cb1_mean_centering", "cb1_weighted", "cb4_mean_centering", "cb4_weighted"]
    assert reporting.metric_by_k(cb(spark)).filter("k = 10").count() == 8


def test_markdown(spark):
    text = reporting.render_markdown(cf(spark)).splitlines()
    assert text[0] == "|model|n_users|rmse|hr@10|ndcg@10|" and text[1] == "|:--|--:|--:|--:|--:|"
    assert text[2] == "|CF_SVD|62411|0.7553|0.1870|0.0309|"
    assert reporting.render_markdown(cf(spark).limit(0)) == ""
    assert "|cb1_mean_centering|62411|0.1677|0.0269|" in reporting.render_markdown(cb(spark))
    assert list(metrics.columns_at((5, 10))) == ["hr@5", "p@5", "r@5", "ndcg@5", "hr@10", "p@10", "r@10", "ndcg@10"]


def test_taste_profile_rules(spark):
    items = spark.createDataFrame(
        [(0, ["Drama", "War"], ["A"], "D", "gloomy gloomy war"), (1, ["Drama"], [], None, "gloomy bright"), (2, ["Comedy"], ["B"], "E", None)],
        "movie_idx INT, genres_list ARRAY<STRING>, cast ARRAY<STRING>, director STRING, user_tags_text STRING",
    )
    r = spark.createDataFrame([(1, 0, 5.0), (1, 1, 4.0), (1, 2, 3.5)], "user_id LONG, movie_idx INT, rating DOUBLE")
    got = {(x.kind, x.value): (x["rank"], x.n) for x in insights.taste_profile(r, items).collect()}
    assert got == {("genre", "Drama"): (1, 2), ("genre", "War"): (2, 1), ("cast", "A"): (1, 1), ("director", "D"): (1, 1), ("tag", "gloomy"): (1, 3)}


def test_item_values_read_the_items_once(spark):
    items = spark.createDataFrame([(0, ["Drama", None], ["A"], "D"), (1, None, [], None)], "movie_idx INT, genres_list ARRAY<STRING>, cast ARRAY<STRING>, director STRING")
    values = insights.item_values(items)
    assert values._jdf.queryExecution().executedPlan().toString().count("Scan") == 1
    assert sorted((x.kind, x.value or "", x.n) for x in values.collect()) == [("cast", "A", 1), ("director", "D", 1), ("genre", "", 1), ("genre", "Drama", 1)]
    tags = spark.createDataFrame([(0, "gloomy gloomy ends"), (0, "gloomy gloomy ends"), (0, None), (1, "bright")], "movie_idx INT, tag STRING")
    assert sorted((x.movie_idx, x.value, x.n) for x in insights.item_values(items.select("movie_idx"), tags).collect()) == [(0, "gloomy", 4), (1, "bright", 1)]


def test_feed_golden(spark):
    rows = [(1, "A", 3.0, 1, 1, "upsert"), (1, "A", 4.0, 2, 2, "upsert"), (1, "B", 5.0, 1, 3, "upsert"), (1, "B", None, 5, 4, "delete"),
            (2, "A", 2.0, 7, 6, "upsert"), (2, "A", 1.0, 7, 5, "upsert")]
    df = spark.createDataFrame(rows, "user_id LONG, title STRING, rating DOUBLE, ts LONG, event_id LONG, op STRING")
    assert sorted(tuple(r) for r in feed.current_ratings(df).collect()) == [(1, "A", 4.0), (2, "A", 2.0)]


def test_stream_replay_equals_batch(spark, sf_dir, tmp_path):
    changes = Views(spark, sf_dir).feed
    # Four files out of time order: late rows must not win.
    for i in range(4):
        changes.filter(F.pmod("event_id", F.lit(4)) == (i * 3) % 4).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    schema = spark.read.parquet(f"{tmp_path}/in").schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    query = feed.stream_changes(stream, f"{tmp_path}/out", f"{tmp_path}/ck")
    query.awaitTermination()
    want = sorted(tuple(r) for r in feed.current_ratings(changes).collect())
    assert sorted(tuple(r) for r in feed.read_current(spark, f"{tmp_path}/out").collect()) == want


def test_stream_goes_on_over_compactions(spark, sf_dir, tmp_path):
    """Readers and the running stream follow the snapshot; folded files go once no reader needs them."""
    changes, out = Views(spark, sf_dir).feed, f"{tmp_path}/out"
    schema, total = changes.schema, []

    def add(i):
        part = changes.filter(F.pmod("event_id", F.lit(6)) == (i * 5) % 6)
        part.coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        total.append(part)

    def run():
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
        feed.stream_changes(stream, out, f"{tmp_path}/ck").awaitTermination()

    def check():
        every = total[0]
        for part in total[1:]:
            every = every.union(part)
        want = sorted(tuple(r) for r in feed.current_ratings(every).collect())
        assert sorted(tuple(r) for r in feed.read_current(spark, out).collect()) == want

    folders = lambda: sorted(p.name for p in (tmp_path / "out").glob("*/*=*"))
    for i in range(6):
        add(i)
        run()
        check()
        if i % 2:
            early = feed.read_current(spark, out)  # planned before the hand-over
            before = sorted(map(tuple, early.collect()))
            feed.compact(spark, out)
            assert sorted(map(tuple, early.collect())) == before
            check()
    names = folders()
    assert sum(n.startswith("snapshot=") for n in names) == 2  # the current one and the one before
    assert sum(n.startswith("version=") for n in names) == 2  # only those that the one before does not hold
    feed.compact(spark, out)  # nothing new: nothing happens
    assert folders() == names


def test_empty_feed_folder_compacts_to_nothing(spark, tmp_path):
    feed.compact(spark, f"{tmp_path}/none")
    assert feed.read_current(spark, f"{tmp_path}/none").count() == 0
