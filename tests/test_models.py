"""TF-IDF, SVD, recipes, factor models: golden values and invariants."""

import glob
import math
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from tastemill import session
from tastemill.config import TfidfParams
from tastemill.operators import factor_evaluating, factor_models, features, least_squares, svd, svdpp, tfidf
from tastemill.plans.models import ContentModel, fit_models
from tastemill.plans.specs import SPECS, FeatureGroups, ModelSpec


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


def test_tfidf_golden(spark):
    docs = spark.createDataFrame([(0, "Red red BLUE a"), (1, "blue green"), (2, None), (3, "red solo")], "doc_id LONG, text STRING")
    counts = tfidf.term_counts(docs, "doc_id", "text")
    packed, vocab = tfidf.fit_tfidf(counts, docs)
    # one-letter words are no tokens; green and solo fail min_df
    assert [(r.term, r.df, r.total, r.term_idx) for r in vocab.orderBy("term_idx").collect()] == [("blue", 2, 2, 0), ("red", 2, 3, 1)]
    idf = math.log(5 / 3) + 1
    a, b = idf, (1 + math.log(2)) * idf
    terms = {r.doc: [tuple(c) for c in r.terms] for r in packed.collect()}
    norm = math.hypot(a, b)
    assert np.allclose(terms[0], [(0, a / norm), (1, b / norm)]) and set(terms) == {0, 1, 3}
    stop = tfidf.fit_tfidf(counts, docs, TfidfParams(stop_words=("red",)))[1]
    assert [r.term for r in stop.collect()] == ["blue"]
    capped = tfidf.fit_tfidf(counts, docs, TfidfParams(max_features=1))[1]
    assert [r.term for r in capped.collect()] == ["red"]


def test_tag_rows_count_like_concatenated_text(spark, sf_dir):
    from tastemill.operators import indexing, tag_text
    from tastemill.sources import tables
    from tastemill.sources.driver_views import Views

    v = Views(spark, sf_dir)
    tags = tables.clean_tags(v.tags_raw)
    index = indexing.build_index(v.movies_raw, "movieId", "movie_idx")
    direct = tfidf.tag_term_counts(tags, index)
    joined = tfidf.term_counts(tag_text.concat_tags(tags).join(index, "movieId"), "movie_idx", "user_tags_text")
    assert direct.exceptAll(joined).count() == 0 and joined.exceptAll(direct).count() == 0


def test_term_numbers_are_dense_and_sorted(spark):
    words = sorted({f"{a}{b}word{c}" for a in "abc" for b in "xyz" for c in range(4)} | {"a", "ab", "zz"})
    df = spark.createDataFrame([(w,) for w in words], "term STRING").repartition(4)
    assert rows(tfidf.number_terms(df), "term_idx") == [(w, i) for i, w in enumerate(words)]


def sparse_rows(spark, m):
    data = [(i, [(int(j), float(x[j])) for j in np.flatnonzero(x)]) for i, x in enumerate(m)]
    return spark.createDataFrame(data, "doc LONG, terms ARRAY<STRUCT<term_idx: INT, weight: DOUBLE>>").repartition(3)


@pytest.mark.parametrize("basis_bytes", [1 << 26, 1])
def test_svd_recovers_a_low_rank_matrix(spark, basis_bytes):
    rng = np.random.default_rng(0)
    m = np.abs(rng.normal(size=(40, 3))) @ np.abs(rng.normal(size=(3, 30)))
    r = svd.truncated_svd(sparse_rows(spark, m), 30, 5, basis_bytes=basis_bytes)
    p = np.array([x.features for x in r.projected.orderBy("doc").collect()])
    assert p.shape == (40, 5)
    assert np.allclose(p @ p.T, m @ m.T, atol=1e-6 * np.abs(m @ m.T).max())
    want = np.linalg.svd(m, compute_uv=False)[:3]
    assert np.allclose(r.singular_values[:3], want, rtol=1e-6)


def reference_projection(m, k):
    """U * Sigma by LAPACK under the operator's sign rule."""
    _, values, vt = np.linalg.svd(m, full_matrices=False)
    v = vt[:k].T * [svd._sign(np.arange(m.shape[1]), x) for x in vt[:k]]
    return m @ v, values[:k]


@pytest.mark.parametrize("basis_bytes, n, k", [(1 << 26, 200, 8), (1 << 26, 257, 8), (1 << 26, 5000, 8), (1 << 26, 12, 12), (1, 5000, 6)])
def test_svd_is_exact_at_every_size_and_in_both_carriers(spark, basis_bytes, n, k):
    rng = np.random.default_rng(n)
    m = rng.random((90, n)) * (rng.random((90, n)) < 0.1) * (1 + np.arange(n)) ** -0.5
    m[7] = 0  # a document without terms
    r = svd.truncated_svd(sparse_rows(spark, m), n, k, basis_bytes=basis_bytes)
    want, values = reference_projection(m, k)
    found = np.array([x.features for x in r.projected.orderBy("doc").collect()])
    assert r.error <= svd.TOLERANCE
    assert np.allclose(r.singular_values, values, rtol=1e-9)
    assert np.allclose(found, want, atol=1e-6 * values[0])


def test_equal_singular_values_get_one_basis(spark):
    """One-hot rows: many equal values, whose vectors both carriers choose alike."""
    rng = np.random.default_rng(4)
    m = np.zeros((70, 40))
    m[np.arange(70), rng.integers(0, 40, 70)] = 1.0
    small, large = (svd.truncated_svd(sparse_rows(spark, m), 40, 9, basis_bytes=b) for b in (1 << 26, 1))
    a, b = (np.array([x.features for x in r.projected.orderBy("doc").collect()]) for r in (small, large))
    assert np.allclose(small.singular_values, np.linalg.svd(m, compute_uv=False)[:9], rtol=1e-9)
    assert np.allclose(a, b, atol=1e-6)


def test_explained_variance(spark):
    m = np.random.default_rng(7).random((80, 60)) * (np.random.default_rng(8).random((80, 60)) < 0.2)
    r = svd.truncated_svd(sparse_rows(spark, m), 60, 8)
    share = svd.explained_variance(sparse_rows(spark, m), r.projected, F.lit(80)).first()[0]
    p = reference_projection(m, 8)[0]
    assert abs(share - p.var(axis=0).sum() / m.var(axis=0).sum()) < 1e-9


def test_component_cap():
    assert [svd.component_cap(50, n) for n in (200, 51, 3, 1, 0)] == [50, 50, 2, 0, 0]


def test_scaling_rules(spark):
    items = spark.createDataFrame([(0, 1990, 5.0), (1, None, 5.0), (2, 2010, None), (3, 2000, 5.0)], "movie_idx INT, year INT, flat DOUBLE")
    assert [r.features for r in features.year(items).orderBy("movie_idx").collect()] == [[0.0], [0.5], [1.0], [0.5]]
    assert {tuple(r.features) for r in features.scaled(items, ["flat"]).collect()} == {(0.0,)}
    assert {tuple(r.features) for r in features.numerical(items, ["absent"]).collect()} == {(0.0,)}


def test_year_becomes_a_flag_after_row_normalisation(spark):
    items = spark.createDataFrame([(0, 1990), (1, 1995), (2, 2010)], "movie_idx INT, year INT")
    both = features.combine([(features.year(items), 0.2)], items)
    assert np.allclose([r.features for r in both.orderBy("movie_idx").collect()], [[0.0], [0.2], [0.2]])


def test_genres_fixed_vocabulary(spark):
    items = spark.createDataFrame([(0, ["B", "X"]), (1, None), (2, [])], "movie_idx INT, genres_list ARRAY<STRING>")
    assert [r.features for r in features.genres(items, ("A", "B")).orderBy("movie_idx").collect()] == [[0.0, 1.0], [0.0, 0.0], [0.0, 0.0]]


def test_user_encoder(spark):
    items = spark.createDataFrame([(0, "ab"), (1, None), (2, "")], "movie_idx INT, overview STRING")
    encoded = features.encode_text(items, "overview", lambda: (lambda texts: [[len(t), 1] for t in texts]))
    assert [r.features for r in features.dense(encoded, items).orderBy("movie_idx").collect()] == [[2.0, 1.0], [0.0, 0.0], [0.0, 0.0]]


def test_combine_weights_and_zero_rows(spark):
    index = spark.createDataFrame([(0,), (1,)], "movie_idx INT")
    g = spark.createDataFrame([(0, [3.0, 4.0])], "movie_idx INT, features ARRAY<DOUBLE>")
    h = spark.createDataFrame([(0, [2.0]), (1, [5.0])], "movie_idx INT, features ARRAY<DOUBLE>")
    got = [r.features for r in features.combine([(g, 1.0), (h, 0.5)], index).orderBy("movie_idx").collect()]
    assert np.allclose(got, [[0.6, 0.8, 0.5], [0.0, 0.0, 0.5]])


def item_groups(spark):
    items = spark.createDataFrame(
        [(i, i, f"T{i}", ["Drama"] if i % 2 else ["Comedy"], 1990 + i, f"good story number{i % 3}", ["A", f"C{i % 4}"], f"D{i % 3}", 90.0 + i, "funny dark")
         for i in range(12)],
        "movieId LONG, movie_idx INT, title STRING, genres_list ARRAY<STRING>, year INT, overview STRING, cast ARRAY<STRING>, director STRING, runtime_min DOUBLE, user_tags_text STRING",
    )
    genome = items.select("movie_idx", F.array(*[(F.col("movie_idx") % k).cast("double") for k in (2, 3, 5)]).alias("features"))
    return FeatureGroups(items, genome=genome, embeddings=genome, components={"tags": 2, "overview": 2})


def test_all_recipes_fit_save_and_load(spark, tmp_path):
    groups = item_groups(spark)
    models, status = fit_models(spark, groups, [*SPECS, "cb99"], str(tmp_path))
    assert dict(rows(status.select("model", "status"))) == {**{n: "ok" for n in SPECS}, "cb99": "failed"}
    loaded = ContentModel.load(spark, str(tmp_path), "cb4")
    assert loaded.spec == SPECS["cb4"]
    ask = spark.createDataFrame([("T1",), ("none",)], "title STRING")
    assert rows(loaded.similar_movies(ask, 3), "rank") == rows(models["cb4"].similar_movies(ask, 3), "rank")
    req = spark.createDataFrame([(1, "T1", 5.0), (1, "T2", 5.0), (1, "T4", 1.0)], "user_id LONG, title STRING, rating DOUBLE")
    assert loaded.recommend_from_ratings(req, 5).count() == 5
    with pytest.raises(RuntimeError):
        ContentModel(SPECS["cb1"]).similar_movies(ask)
    with pytest.raises(FileNotFoundError):
        ContentModel.load(spark, str(tmp_path), "cb0")
    with pytest.raises(ValueError):
        ModelSpec("x", (("genome", 1.0),), metric="dot")


def planted(spark):
    rng = np.random.default_rng(11)
    p, q = rng.normal(size=(60, 2)), rng.normal(size=(40, 2))
    bu, bi = rng.normal(0, 0.3, 60), rng.normal(0, 0.3, 40)
    data = []
    for u in range(60):
        for i in range(40):
            if rng.random() < 0.6:
                r = float(np.clip(3 + bu[u] + bi[i] + 0.6 * p[u] @ q[i], 0.5, 5))
                data.append((u, i, r, "val" if rng.random() < 0.15 else "train"))
    return spark.createDataFrame(data, "user_id LONG, movie_id LONG, rating DOUBLE, split STRING").cache()


@pytest.fixture(scope="module")
def world(spark):
    return planted(spark)


def rmse_of(model, val):
    return factor_evaluating.compute_rmse(model, val).first()["rmse"]


@pytest.mark.parametrize("algorithm, params", [
    ("svd", {"n_factors": 3, "n_epochs": 8, "reg": 0.05}),
    ("svdpp", {"n_factors": 4, "n_epochs": 25, "lr": 0.02}),
    ("nmf", {"n_factors": 4, "n_epochs": 10, "reg": 0.05}),
])
def test_factor_models_beat_the_mean(spark, world, algorithm, params, tmp_path):
    train, val = world.filter("split = 'train'"), world.filter("split = 'val'")
    model = factor_models.FactorModel(algorithm, params).fit(train)
    base = val.select(F.stddev_pop("rating")).first()[0]
    assert rmse_of(model, val) < 0.95 * base
    pred = model.predict(val)
    low, high = pred.agg(F.min("prediction"), F.max("prediction")).first()
    assert 0.5 <= low and high <= 5.0 and pred.count() == val.count()
    if algorithm == "nmf":
        for table in (model.users, model.items):
            assert table.select(F.min(F.array_min("factors"))).first()[0] >= 0

    # top-N equals brute-force prediction, rated items left out; 777 is unknown
    users = spark.createDataFrame([(0,), (1,), (555,)], "user_id LONG")
    items = spark.createDataFrame([(i,) for i in [*range(40), 777]], "movie_id LONG")
    recs = model.recommend(users, items, 5)
    pairs = users.crossJoin(items).join(train, ["user_id", "movie_id"], "left_anti")
    scored = {}
    for r in model.predict(pairs).collect():
        scored.setdefault(r.user_id, []).append((-round(r.prediction, 10), r.movie_id))
    got = {}
    for r in recs.orderBy("user_id", "rank").collect():
        got.setdefault(r.user_id, []).append(r.movie_id)
    assert got == {u: [i for _, i in sorted(s)[:5]] for u, s in scored.items()}
    assert model.recommend(users.limit(1), items, 100, filter_rated=False).count() == 41

    model.save(str(tmp_path))
    again = factor_models.FactorModel.load(spark, str(tmp_path), algorithm)
    assert math.isclose(rmse_of(again, val), rmse_of(model, val), rel_tol=1e-9)


def test_svd_beats_biases_alone(spark, world):
    train, val = world.filter("split = 'train'"), world.filter("split = 'val'")
    b = factor_models.fit_biases(train)
    none = F.lit(None).cast("array<double>").alias("factors")
    only = factor_models.FactorModel("svd", mean=b.mean, users=b.users.select("*", none), items=b.items.select("*", none))
    full = factor_models.FactorModel("svd", {"n_factors": 3, "n_epochs": 8, "reg": 0.05}).fit(train)
    assert rmse_of(full, val) < rmse_of(only, val)


@pytest.mark.parametrize("budget", [least_squares._SOLVE_BYTES, 1, 3000])
def test_least_squares_of_few_and_many_ratings(monkeypatch, budget):
    monkeypatch.setattr(least_squares, "_SOLVE_BYTES", budget)
    rng = np.random.default_rng(3)
    y, counts = rng.normal(size=(50, 8)).astype(np.float32), np.array([3, 20, 1, 8, 3, 40])
    pos, ratings = rng.integers(0, 50, counts.sum()), rng.normal(size=counts.sum())
    found = least_squares.solve(y, pos, ratings, counts, 0.3)
    for k, (n, end) in enumerate(zip(counts, np.cumsum(counts))):
        own = y[pos[end - n : end]].astype(float)
        assert np.allclose(found[k], np.linalg.solve(own.T @ own + 0.3 * n * np.eye(8), own.T @ ratings[end - n : end]), atol=1e-5)


def test_alternating_rounds_equal_plain_ones(spark, monkeypatch):
    """Ids below zero and wide ones, a repeated rating, a user of one rating; many blocks and few."""
    rng = np.random.default_rng(4)
    rows = [(u * 2**33 - 5, i - 3, float(rng.integers(1, 11)) / 2) for u in range(25) for i in range(18) if (u * i) % 3 < 2]
    rows += [rows[7], (99, 4, 2.5)]
    ratings = spark.createDataFrame(rows, "user_id long, movie_id long, rating double")
    rank, reg, seed = 5, 0.1, 7

    def draw(i):
        d = np.random.default_rng([seed, int(i < 0), abs(i)]).normal(size=rank)
        return (d / np.linalg.norm(d)).astype(np.float32)

    users, items = {u: draw(u) for u, _, _ in rows}, {}
    for _ in range(2):
        for mine, theirs, at in ((items, users, 1), (users, items, 0)):
            by = {}
            for r in rows:
                by.setdefault(r[at], []).append((theirs[r[1 - at]].astype(float), r[2]))
            for k, own in by.items():
                m, v = np.array([o[0] for o in own]), np.array([o[1] for o in own])
                mine[k] = np.linalg.solve(m.T @ m + reg * len(own) * np.eye(rank), m.T @ v).astype(np.float32)
    for most in (2_000_000, 30):
        monkeypatch.setattr(least_squares, "BLOCK_RATINGS", most)
        p, q = least_squares.fit(ratings, rank, 2, reg, seed, 3)
        for table, want in ((p, users), (q, items)):
            found = {r[0]: r[1] for r in table.collect()}
            assert set(found) == set(want) and all(np.allclose(found[k], want[k], atol=1e-4) for k in want)


@pytest.mark.parametrize("odd", [None, float("nan")])
def test_least_squares_refuses_unknown_ratings(spark, odd):
    ratings = spark.createDataFrame([(1, 1, 3.0), (2, 1, odd)], "user_id long, movie_id long, rating double")
    with pytest.raises(Exception, match="MUST NOT be Null"):
        least_squares.fit(ratings, 2, 1, 0.1, 7, 2)


def test_least_squares_blocks_follow_what_a_block_holds():
    assert least_squares.grid_blocks(467_000, 20_000, 100, 8) == 8
    n = least_squares.grid_blocks(28_000_000, 1_200_000, 100, 8)
    assert 28_000_000 / n * 100 * 4 <= least_squares.BLOCK_BYTES and n < 60


def test_factor_guards_and_wide_ids(spark, world):
    with pytest.raises(ValueError):
        factor_models.FactorModel("knn")
    with pytest.raises(NotImplementedError):
        factor_models.FactorModel("svd").recommend_from_ratings({})
    with pytest.raises(RuntimeError):
        factor_models.FactorModel("svd").predict(world)
    wide = world.withColumn("user_id", F.col("user_id") + 2**40)
    model = factor_models.FactorModel("nmf", {"n_factors": 2, "n_epochs": 2}).fit(wide.filter("split = 'train'"))
    assert model.users.agg(F.min("user_id")).first()[0] == 2**40


def test_factor_report(spark, world):
    models, status = factor_evaluating.fit_factor_models(world, ["svd", "oops"], {"svd": {"n_factors": 2, "n_epochs": 3}})
    assert dict(rows(status.select("model", "status"))) == {"svd": "ok", "oops": "failed"}
    items = world.select("movie_id").distinct()
    row = factor_evaluating.report(list(models.values()), world, items, ks=[5]).first()
    assert row["model"] == "CF_SVD" and row["n_users"] > 0 and 0 < row["rmse"] < 2 and 0 <= row["ndcg@5"] <= 1


def plain_svdpp(user, items, rating, order, mean, lr, reg):
    """Every batch of one user's ratings steps the implicit factors of the whole history."""
    width = len(user) - 1
    bi, q, y = items[:, 0].copy(), items[:, 1 : 1 + width].copy(), items[:, 1 + width :].copy()
    bu, p, scale = user[0], user[1:].copy(), 1 / math.sqrt(len(items))
    for at in order:
        whole = p + y.sum(axis=0) * scale
        err = rating[at] - (mean + bu + bi[at] + q[at] @ whole)
        pull, m = err @ q[at], len(err)
        bu += lr * (err.sum() - reg * bu * m)
        bi[at] += lr * (err - reg * bi[at])
        q[at] += lr * (err[:, None] * whole - reg * q[at])
        p += lr * (pull - reg * p * m)
        y = y * (1 - lr * reg) ** m + lr * scale * pull
    return np.concatenate(([bu], p)), np.hstack([bi[:, None], q, y])


@pytest.mark.parametrize("cells", [1, 3])
def test_svdpp_steps_the_whole_history_across_cells(cells):
    """Items catch up on the steps made in other cells: one user's epochs equal those on undivided items."""
    rng = np.random.default_rng(4)
    n, width, mean, lr, reg, epochs = 300, 3, 3.5, 0.02, 0.1, 3
    items = np.hstack([rng.normal(0, 0.3, (n, 1 + width)), np.zeros((n, width))])
    user, rating = rng.normal(0, 0.3, 1 + width), rng.uniform(1, 5, n)
    parts = np.array_split(np.arange(n), cells)
    batch = svdpp.MINI_BATCH
    order = [part[lo : lo + batch] for _ in range(epochs) for part in parts for lo in range(0, len(part), batch)]
    want_user, want_items = plain_svdpp(user, items, rating, order, mean, lr, reg)

    ids, state = np.array([7]), np.concatenate([[user[0], n, 0.0], user[1:], np.zeros(2 * width)])[None, :]
    blocks, memos = [items[part].copy() for part in parts], [None] * cells
    for epoch in range(epochs + 1):
        for k, part in enumerate(parts):
            cell = np.full(len(part), 7), part, rating[part]
            memos[k] = svdpp.visit(ids, state, part, blocks[k], cell, memos[k], mean, width, lr, reg, epoch < epochs)
    np.testing.assert_allclose(np.concatenate([[state[0, 0]], state[0, 3 : 3 + width]]), want_user, rtol=1e-8)
    np.testing.assert_allclose(np.concatenate(blocks), want_items, rtol=1e-7, atol=1e-10)
    np.testing.assert_allclose(state[0, 3 + width : 3 + 2 * width], want_items[:, 1 + width :].sum(axis=0), rtol=1e-7)


def test_svdpp_visits_users_without_common_items_at_once():
    rng = np.random.default_rng(2)
    user = np.repeat(np.arange(300), 4)
    item = np.concatenate([rng.choice(2000, 4, replace=False) for _ in range(300)])
    item[4 * 7] = item[4 * 8] = item[4 * 200] = 5  # one that three users share
    starts = np.arange(0, 1200, 4)
    groups = list(svdpp._apart(item, starts, starts + 4, 2000))
    assert sorted(k for g in groups for k in g) == list(range(300)) and len(groups) < 30
    at = {k: n for n, g in enumerate(groups) for k in g}
    assert at[7] < at[8] < at[200]
    for g in groups:
        own = [set(item[4 * k : 4 * k + 4]) for k in g]
        assert len(set().union(*own)) == sum(map(len, own))
    assert list(svdpp._apart(item[:0], starts[:0], starts[:0], 0)) == []


def test_svdpp_does_not_depend_on_shuffle_partitions(spark, world, monkeypatch):
    monkeypatch.setattr(svdpp, "CELL_RATINGS", 40)  # several hundred ratings: more blocks than the fewest
    train = world.filter("split = 'train'")
    before, found = spark.conf.get("spark.sql.shuffle.partitions"), []
    try:
        for partitions in ("2", "16"):
            spark.conf.set("spark.sql.shuffle.partitions", partitions)
            model = factor_models.FactorModel("svdpp", {"n_factors": 3, "n_epochs": 2}).fit(train)
            found.append([rows(model.users, "user_id"), rows(model.items, "movie_id")])
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert svdpp.grid_blocks(train.count()) > svdpp.BLOCKS
    for a, b in zip(*found):
        assert [(r[0], r[1]) for r in a] == [(r[0], r[1]) for r in b]
        np.testing.assert_allclose([r[2] for r in a], [r[2] for r in b], rtol=1e-12)


def test_svdpp_exchanges_no_ratings_in_an_epoch(spark, world, monkeypatch):
    """The kept ratings are read in place: above their scan no plan of a stratum has an exchange."""
    plans, plain = [], svdpp.cut_lineage

    def traced(df):
        if df.columns == ["kind", "block", "ids", "state"]:
            plans.append(df._jdf.queryExecution().executedPlan().toString().splitlines())
        return plain(df)

    monkeypatch.setattr(svdpp, "cut_lineage", traced)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "16")  # more than the blocks: the joins could prefer it
    try:
        factor_models.FactorModel("svdpp", {"n_factors": 2, "n_epochs": 1}).fit(world.filter("split = 'train'"))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert len(plans) == 2 * svdpp.BLOCKS
    for lines in plans:
        scan = next(k for k, line in enumerate(lines) if "InMemoryTableScan" in line)
        # in a plan's text the parent of an only child is the line above: the sort of the join, not an exchange
        assert "Sort [" in lines[scan - 1] and not any("Exchange" in line and ", 16)" in line for line in lines[:scan]), lines[: scan + 1]


def test_unknown_parameters_are_refused():
    with pytest.raises(ValueError, match="lr"):
        factor_models.FactorModel("svd", {"lr": 0.1})


def test_item_tables_are_not_broadcast(spark):
    """A file of few bytes may hold a vector or a link for every item: joins on items ship neither to every task."""
    from tastemill.operators import features
    from tastemill.plans import prepare

    index = spark.createDataFrame([(i, i) for i in range(6)], "movieId LONG, movie_idx INT")
    vectors = spark.createDataFrame([(i, [1.0, float(i)]) for i in range(4)], "movie_idx INT, features ARRAY<DOUBLE>")
    aligned = features.align(vectors, index)
    movies = spark.createDataFrame([(i, f"m{i}") for i in range(6)], "movieId LONG, title STRING")
    links = spark.createDataFrame([(i, i + 100) for i in range(5)], "movieId LONG, tmdbId LONG")
    metadata = spark.createDataFrame([(i + 100, "d") for i in range(5)], "tmdbId LONG, director STRING")
    items = prepare.enrich_items(movies, index, links, metadata)
    for frame in (aligned, items):
        assert "Broadcast" not in frame._jdf.queryExecution().executedPlan().toString()
        assert frame.count() == 6
    assert {r.movie_idx: r.features for r in aligned.collect()}[5] == [0.0, 0.0]


def test_solver_blocks_follow_what_a_block_holds():
    # a factor travels once per block: few blocks while the factors fit one, more beyond
    assert factor_models._als_blocks(467_000, 20_000, 100) == 8
    assert factor_models._als_blocks(28_000_000, 1_200_000, 15) == 8
    assert factor_models._als_blocks(28_000_000, 1_200_000, 100) <= 10
    n = factor_models._als_blocks(170_000_000, 7_000_000, 100)
    assert 170_000_000 / n * 100 * 4 <= factor_models._ALS_BLOCK_BYTES


def _shuffle_files(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}


def test_written_tables_leave_no_shuffle_files(spark):
    before = _shuffle_files(spark)
    table = session.cut_lineage(spark.range(1000).repartition(4, "id"))
    assert table.count() == 1000
    for _ in range(100):  # they go in the background
        left = {f for f in _shuffle_files(spark) - before if f.endswith(".data")}
        if not left:
            break
        time.sleep(0.1)
    assert not left


def test_svdpp_keeps_only_the_last_states(spark):
    rows = [(u, i, float(1 + (u * i) % 5)) for u in range(12) for i in range(10) if (u + i) % 3]
    ratings = spark.createDataFrame(rows, "user_id long, movie_id long, rating double")
    session.ensure_checkpoint_dir(spark)
    base = spark.sparkContext.getCheckpointDir().removeprefix("file:")
    tables = lambda: set(glob.glob(f"{base}/table-*"))
    before = tables()
    _, users, _ = svdpp.fit(ratings, {"n_factors": 3, "n_epochs": 3, "lr": 0.01, "reg": 0.02, "seed": 1})
    assert users.count() == 12
    # 16 visits, of which the last one to each stratum is kept, and seven other tables
    assert len(tables() - before) <= svdpp.BLOCKS + 7


def test_svd_reads_rows_once_for_the_gram(spark, monkeypatch):
    """X'X is made in one pass, from short rows, dense ones and repeated cells; every product reads its strips."""
    from tastemill.session import cut_lineage

    r = np.random.default_rng(5)
    m = np.where(r.random((700, 150)) < 0.03, r.normal(size=(700, 150)), 0.0)
    m[600:] = r.normal(size=(100, 150))
    rows = cut_lineage(sparse_rows(spark, m))
    want = m.T @ m
    block = r.normal(size=(150, 9))
    monkeypatch.setattr(svd, "_ROWS", 100)
    for outer in (0, 1e9):
        monkeypatch.setattr(svd, "_OUTER", outer)
        strips = svd._gram_strips(rows, 150)
        assert np.allclose(svd._strip_product(strips, block), want @ block, atol=1e-9)
    twice = spark.createDataFrame([(0, [(1, 2.0), (1, 3.0), (0, 1.0)])], "doc LONG, terms ARRAY<STRUCT<term_idx: INT, weight: DOUBLE>>")
    assert np.allclose(svd._strip_product(svd._gram_strips(twice, 2), np.eye(2)), [[1.0, 5.0], [5.0, 25.0]])
    monkeypatch.setattr(svd, "_gram_pass", None)  # no product reads the rows
    values = np.linalg.svd(m, compute_uv=False)
    assert np.allclose(svd.truncated_svd(rows, 150, 5).singular_values, values[:5], atol=1e-6)


def test_component_sums(spark):
    m = np.random.default_rng(6).normal(size=(40, 4))
    rows = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(m)], "doc LONG, features ARRAY<DOUBLE>").repartition(3)
    got = np.array([list(x) for x in svd.component_sums(rows).orderBy("c").collect()])
    assert np.allclose(got[:, 1:], np.array([m.sum(0), (m**2).sum(0), np.append((m[:, :-1] * m[:, 1:]).sum(0), 0.0)]).T)
