"""Kernels, profiles, recommendations and evaluation against brute force."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tastemill.operators import evaluating, metrics, recommending, similarity, tiles
from tastemill.operators.tiles import Layout

LAYOUTS = [Layout(1, 1), Layout(3, 1), Layout(2, 3), Layout(1, 5)]


def vectors(spark, matrix):
    return spark.createDataFrame([(i, [float(x) for x in row]) for i, row in enumerate(matrix)], "movie_idx LONG, features ARRAY<DOUBLE>")


def best(scores, k, banned=()):
    order = sorted((j for j in range(len(scores)) if j not in banned), key=lambda j: (-round(scores[j], 10), j))
    return order[:k]


def cosine(a, b):
    na, nb = np.linalg.norm(a), np.linalg.norm(b)
    return 0.0 if na == 0 or nb == 0 else float(a @ b / na / nb)


@pytest.fixture(scope="module")
def matrix():
    m = np.random.default_rng(1).normal(size=(60, 7))
    m[5] = 0.0  # zero vector
    m[11] = m[10]  # exact ties
    m[12] = 2 * m[10]
    return m


@pytest.mark.parametrize("layout", LAYOUTS)
@pytest.mark.parametrize("metric", ["cosine", "euclidean"])
def test_neighbours_match_brute_force(spark, matrix, layout, metric):
    got = similarity.neighbours(vectors(spark, matrix), 6, metric, layout).collect()
    lists = {}
    for r in sorted(got, key=lambda r: (r.movie_idx, r["rank"])):
        lists.setdefault(r.movie_idx, []).append(r.neighbour_idx)
        assert metric == "cosine" or r.score <= 0
    for i, row in enumerate(matrix):
        s = [cosine(row, o) if metric == "cosine" else -float(((row - o) ** 2).sum()) for o in matrix]
        assert lists[i] == best(s, 6, {i}), i


@pytest.mark.parametrize("layout", [Layout(2, 1), Layout(2, 3)])
@pytest.mark.parametrize("metric", ["cosine", "euclidean"])
def test_neighbours_compare_classes_of_equal_vectors(spark, matrix, layout, metric, monkeypatch):
    """1,200 items with few vectors: the tiles get each vector once, the lists are those of all pairs."""
    kind = np.random.default_rng(4).integers(0, 60, size=1200)
    kind[kind == 7] = 5  # a class of zero vectors that is larger than a piece
    kind[100:300] = 5
    sides, plain = [], tiles.top_k
    monkeypatch.setattr(similarity, "_CLASS_PIECE", 50)
    monkeypatch.setattr(tiles, "top_k", lambda q, v, *a, **b: sides.append((q.count(), v.count())) or plain(q, v, *a, **b))
    lists = {}
    for r in sorted(similarity.neighbours(vectors(spark, matrix[kind]), 30, metric, layout).collect(), key=lambda r: (r.movie_idx, r["rank"])):
        lists.setdefault(r.movie_idx, []).append(r.neighbour_idx)
    assert sides == [(len(np.unique(matrix[kind], axis=0)),) * 2]
    for i in range(1200):
        a, score = matrix[kind[i]], {}
        for c in set(kind):
            score[c] = cosine(a, matrix[c]) if metric == "cosine" else -float(((a - matrix[c]) ** 2).sum())
        assert lists[i] == best([score[c] for c in kind], 30, {i}), i


def test_small_catalogue_gives_all_other_items(spark):
    got = similarity.neighbours(vectors(spark, np.eye(3)), 100)
    assert got.count() == 6


def profile(matrix, rated, strategy):
    idx, r = list(rated), np.array(list(rated.values()))
    if strategy == "weighted":
        w = r / r.sum()
    else:
        w = r - r.mean() if r.max() != r.min() else np.full(len(r), 1 / len(r))
    return (matrix[idx] * w[:, None]).sum(axis=0)


@pytest.fixture(scope="module")
def ratings():
    rng = np.random.default_rng(2)
    out = {u: {int(i): float(rng.integers(1, 11)) / 2 for i in rng.choice(60, size=rng.integers(1, 40), replace=False)} for u in range(25)}
    out[100] = {3: 4.0}
    out[101] = {i: 3.0 for i in range(10)}
    out[102] = {i: float(i % 5 + 1) for i in range(58)}  # two items left
    return out


def rating_rows(spark, ratings, extra=()):
    rows = [(u, i, r) for u, rated in ratings.items() for i, r in rated.items()]
    return spark.createDataFrame(rows + list(extra), "user_id LONG, movie_idx LONG, rating DOUBLE")


@pytest.mark.parametrize("layout", LAYOUTS)
@pytest.mark.parametrize("metric, strategy", [("cosine", "mean_centering"), ("euclidean", "weighted"), ("cosine", "weighted"), ("euclidean", "mean_centering")])
def test_recommend_matches_brute_force(spark, matrix, ratings, layout, metric, strategy):
    # an item without a vector is ignored everywhere
    df = rating_rows(spark, ratings, [(100, 999, 1.0)]).repartition(5)
    got = recommending.recommend(df, vectors(spark, matrix), 8, metric, strategy, layout).collect()
    lists = {}
    for r in sorted(got, key=lambda r: (r.user_id, r["rank"])):
        lists.setdefault(r.user_id, []).append((r.movie_idx, r.score))
    for u, rated in ratings.items():
        p = profile(matrix, rated, strategy)
        s = [cosine(p, o) if metric == "cosine" else -float(((p - o) ** 2).sum()) for o in matrix]
        want = best(s, 8, set(rated))
        assert [i for i, _ in lists[u]] == want, u
        assert np.allclose([x for _, x in lists[u]], [s[i] for i in want], atol=1e-8)
    assert len(lists[102]) == 2


def test_hot_user_straddles_arrow_batches(spark):
    n = 400
    m = np.random.default_rng(3).normal(size=(n, 4))
    hot = {i: float(i % 10 + 1) / 2 for i in range(n - 5)}
    rest = {u: {u % n: 4.0, (u * 7 + 1) % n: 2.0} for u in range(1, 200)}
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "50")
    try:
        df = rating_rows(spark, {0: hot, **rest})
        got = recommending.recommend(df, vectors(spark, m), 5, layout=Layout(2, 1))
        again = recommending.recommend(df, vectors(spark, m), 5, layout=Layout(3, 4))
        key = lambda d: sorted((r.user_id, r["rank"], r.movie_idx) for r in d.collect())
        assert key(got) == key(again)
        assert {r.movie_idx for r in got.filter("user_id = 0").collect()} == set(range(n - 5, n))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


@pytest.mark.parametrize("layout", [Layout(2, 1), Layout(2, 3)])
def test_hot_users_are_split_with_the_same_result(spark, matrix, ratings, layout):
    df = rating_rows(spark, ratings)
    key = lambda d: sorted((r.user_id, r["rank"], r.movie_idx, round(r.score, 8)) for r in d.collect())
    for metric, strategy in (("cosine", "mean_centering"), ("euclidean", "weighted")):
        whole = key(recommending.recommend(df, vectors(spark, matrix), 8, metric, strategy, layout))
        assert key(recommending.recommend(df, vectors(spark, matrix), 8, metric, strategy, layout, hot_rows=20)) == whole


@pytest.mark.parametrize("metric, clip", [("cosine", None), ("euclidean", None), ("dot", None), ("dot", (0.5, 5.0))])
@pytest.mark.parametrize("slab", [8 * 256 * 7, 1 << 24])
def test_scorer_slices_lose_nothing(metric, clip, slab):
    rng = np.random.default_rng(6)
    m = rng.normal(size=(500, 6)) * rng.lognormal(0, 2, 500)[:, None]
    m[40:60] = m[7]
    m[3] = 0
    q, keys = rng.normal(size=(30, 6)) * 3, np.arange(100, 130)
    q[4] = 0
    row, pos = rng.integers(0, 30, 400), rng.integers(0, 500, 400)
    ids = np.arange(500) * 3 + 1
    cols = tiles._Scorer(ids, m, metric, 25, clip, slab).top(keys, q, row, pos)
    got = {}
    for k, i, s, r in zip(*cols):
        got.setdefault(k, []).append((i, s, r))
    for n, x in enumerate(q):
        s = [cosine(x, y) if metric == "cosine" else float(x @ y) if metric == "dot" else -float(((x - y) ** 2).sum()) for y in m]
        s = np.clip(s, *clip) if clip else s
        want = best(s, 25, set(pos[row == n].tolist()))
        found = got[100 + n]
        assert [r for _, _, r in found] == list(range(1, 26))
        assert np.allclose([v for _, v, _ in found], [s[j] for j in want], atol=1e-6)
        if metric != "euclidean":  # large distances lose decimals, so near ties may differ there
            assert [i for i, _, _ in found] == [ids[j] for j in want]


@pytest.mark.parametrize("metric", ["cosine", "euclidean"])
def test_scorer_sorts_only_scores_ahead_of_the_best_so_far(metric, monkeypatch):
    rng = np.random.default_rng(9)
    m, q = rng.normal(size=(20_000, 12)), rng.normal(size=(256, 12))
    sorted_cells, plain = [], np.lexsort
    scorer = tiles._Scorer(np.arange(20_000), m, metric, 20, None)
    monkeypatch.setattr(tiles, "_best", lambda s, k, f=tiles._best: sorted_cells.append(s.size) or f(s, k))
    monkeypatch.setattr(np, "lexsort", lambda keys: sorted_cells.append(np.size(keys[0])) or plain(keys))
    none = np.zeros(0, np.int64)
    found = scorer.top(np.arange(256), q, none, none)
    assert sum(sorted_cells) < 256 * 20_000 / 2
    s = m @ q[9]
    want = np.sort(s / np.linalg.norm(m, axis=1) / np.linalg.norm(q[9]) if metric == "cosine" else 2 * s - (m**2).sum(1) - (q[9] ** 2).sum())[::-1][:20]
    assert np.allclose(found[2][found[0] == 9], want)


def _in_cells(rng, n, cells=30, width=0.2, d=12):
    m = rng.normal(size=(cells, d))[rng.integers(0, cells, n)] + rng.normal(size=(n, d)) * width
    m[n // 2] = 0
    return m


@pytest.mark.parametrize("metric", ["cosine", "euclidean"])
def test_scorer_meets_only_cells_within_reach(metric, monkeypatch):
    m = _in_cells(np.random.default_rng(10), 20_000)
    at = np.random.default_rng(11).permutation(20_000)[:256]
    cells, plain = [], tiles._Scorer._scores
    monkeypatch.setattr(tiles, "_CELL_ROWS", 500)
    monkeypatch.setattr(tiles._Scorer, "_scores", lambda self, q, length, lo, hi: cells.append(len(q) * (hi - lo)) or plain(self, q, length, lo, hi))
    scorer = tiles._Scorer(np.arange(20_000), m, metric, 20, None)
    found = scorer.top(at, m[at], np.arange(256), at)
    assert sum(cells) < 256 * 20_000 / 4
    for n in range(0, 256, 25):
        x = m[at[n]]
        s = m @ x / np.linalg.norm(x) / np.where((size := np.linalg.norm(m, axis=1)) == 0, 1, size) if metric == "cosine" else -((m - x) ** 2).sum(1)
        assert found[1][found[0] == at[n]].tolist() == best(s, 20, {at[n]})


@pytest.mark.parametrize("metric", ["cosine", "euclidean"])
@pytest.mark.parametrize("copies", [False, True])
def test_blocks_of_cells_lose_no_neighbour(spark, metric, copies, monkeypatch):
    """Vectors in cells, over four blocks: the lists of all pairs, and few queries leave their own block. A cell of
    fewer items than a list is long, and zero vectors, need the others."""
    m = _in_cells(np.random.default_rng(12), 600, cells=9)
    m[:4] = 40.0 + np.arange(4)[:, None] * np.eye(12)[3]
    if copies:
        m[100:130] = m[99]
    sent, plain = [], tiles._to_tiles
    monkeypatch.setattr(tiles, "_to_tiles", lambda items, rows, *a: sent.append(rows.count()) or plain(items, rows, *a))
    got = similarity.neighbours(vectors(spark, m), 8, metric, Layout(2, 4)).collect()
    assert len(sent) == 2 and sent[1] < sent[0]
    lists = {}
    for r in sorted(got, key=lambda r: (r.movie_idx, r["rank"])):
        lists.setdefault(r.movie_idx, []).append((r["rank"], r.neighbour_idx))
    for i, row in enumerate(m):
        s = [cosine(row, o) if metric == "cosine" else -float(((row - o) ** 2).sum()) for o in m]
        assert lists[i] == list(enumerate(best(s, 8, {i}), 1)), i


def test_scorer_memory_and_walk_are_bounded(monkeypatch):
    """A million short vectors: scores fill a few slabs at most, and long vectors end the walk."""
    import tracemalloc

    rng = np.random.default_rng(8)
    n = 1_000_000
    m = rng.normal(size=(n, 10)) * rng.pareto(1.0, n)[:, None]
    scorer = tiles._Scorer(np.arange(n), m, "dot", 10, None, 1 << 22)
    seen, plain = [], tiles._Scorer._scores
    monkeypatch.setattr(tiles._Scorer, "_scores", lambda self, q, length, lo, hi: seen.append(hi - lo) or plain(self, q, length, lo, hi))
    q = rng.normal(size=(256, 10))
    none = np.zeros(0, np.int64)
    tracemalloc.start()
    found = scorer.top(np.arange(256), q, none, none)
    assert tracemalloc.get_traced_memory()[1] < 10 * (1 << 22)
    tracemalloc.stop()
    assert sum(seen) < n / 10
    at = found[0] == 5
    assert np.allclose(found[2][at], np.sort(m @ q[5])[::-1][:10])


@pytest.mark.parametrize("salt", [1, 4])
@pytest.mark.parametrize("layout", LAYOUTS)
def test_weighted_sums(spark, matrix, layout, salt):
    rng = np.random.default_rng(4)
    dense = rng.normal(size=(9, 60)) * (rng.random((9, 60)) < 0.3)
    cells = [(int(a), int(b), float(dense[a, b])) for a, b in zip(*np.nonzero(dense))]
    entries = spark.createDataFrame(cells, "key LONG, item LONG, weight DOUBLE")
    items = vectors(spark, matrix).withColumnsRenamed({"movie_idx": "item", "features": "vec"})
    got = {r.key: r.vec for r in tiles.weighted_sums(entries, items, layout, salt).collect()}
    for k in {c[0] for c in cells}:
        assert np.allclose(got[k], dense[k] @ matrix)


def test_guards(spark, matrix):
    v = vectors(spark, matrix)
    with pytest.raises(ValueError):
        similarity.neighbours(v, 5, "manhattan")
    with pytest.raises(ValueError):
        recommending.recommend(v, v, strategy="median")


def test_titles_path_skips_unknown_and_last_duplicate_wins(spark):
    v = vectors(spark, np.array([[1.0, 0], [0, 1.0], [0.9, 0.1], [0.1, 0.9]]))
    items = spark.createDataFrame([(0, "A"), (1, "B"), (2, "A"), (3, "C")], "movie_idx LONG, title STRING")
    req = spark.createDataFrame([(1, "A", 5.0), (1, "Nope", 1.0), (2, "Nope", 3.0)], "user_id LONG, title STRING, rating DOUBLE")
    got = recommending.recommend_for_titles(req, v, items, 3)
    assert {r.user_id for r in got.collect()} == {1}
    assert [r.movie_idx for r in got.orderBy("rank").collect()] == [0, 3, 1]
    none = recommending.recommend_for_titles(req.filter("user_id = 2"), v, items, 3)
    assert none.count() == 0 and set(none.columns) == {"user_id", "rank", "movie_idx", "score", "title"}


def test_display_scores_and_sections(spark):
    recs = spark.createDataFrame([(1, 1, 1.5), (1, 2, -0.5), (2, 1, -4.0), (2, 2, -8.0), (3, 1, -2.0)], "user_id LONG, rank INT, score DOUBLE")
    cos = [r.display_score for r in recommending.display_scores(recs).orderBy("user_id", "rank").collect()]
    euc = [r.display_score for r in recommending.display_scores(recs, "euclidean").orderBy("user_id", "rank").collect()]
    assert cos == [1.0, 0.0, 0.0, 0.0, 0.0] and euc == [1.0, 0.0, 1.0, 0.0, 0.0]
    assert [r.section for r in recommending.featured(recs, 1).filter("user_id = 1").orderBy("rank").collect()] == ["featured", "more"]


def test_metric_values(spark):
    recs = spark.createDataFrame([(1, r, i) for r, i in enumerate([10, 11, 12], 1)], "user_id LONG, rank INT, movie_idx LONG")
    truth = spark.createDataFrame([(1, 11), (1, 99), (2, 5)], "user_id LONG, movie_idx LONG")
    one, two = metrics.per_user_metrics(recs, truth, [1, 2, 5]).orderBy("user_id").collect()
    assert (one["hr@1"], one["p@1"], one["hr@2"], one["p@2"], one["r@2"]) == (0.0, 0.0, 1.0, 0.5, 0.5)
    assert one["p@5"] == 0.2  # divided by K although only three were recommended
    assert math.isclose(one["ndcg@5"], (1 / math.log2(3)) / (1 + 1 / math.log2(3)))
    assert (two["n_gt"], two["hr@5"], two["ndcg@5"]) == (1, 0.0, 0.0)
    hit = metrics.hits(recs, truth).orderBy("rank").collect()
    assert [r.hit for r in hit] == [0, 1, 0]


def test_planted_clusters_are_found(spark):
    """Users who like one of two item clusters get its held-out items."""
    rng = np.random.default_rng(5)
    m = np.vstack([rng.normal(0, 0.05, (20, 4)) + [1, 0, 0, 0], rng.normal(0, 0.05, (20, 4)) + [0, 1, 0, 0]])
    rows = []
    for u in range(8):
        liked = range(0, 20) if u % 2 == 0 else range(20, 40)
        other = range(20, 40) if u % 2 == 0 else range(0, 20)
        rows += [(u, i, 5.0, "train") for i in list(liked)[:15]] + [(u, i, 1.0, "train") for i in list(other)[:15]]
        rows += [(u, i, 5.0, "val") for i in list(liked)[15:]]
    rows += [(50, 1, 5.0, "val"), (51, 1, 4.0, "train"), (51, 2, 2.0, "val")]  # no train; nothing relevant
    r = spark.createDataFrame(rows, "user_id LONG, movie_idx LONG, rating DOUBLE, split STRING")
    out = evaluating.evaluate(r, vectors(spark, m), ks=[5])
    assert sorted(x.user_id for x in out.collect()) == list(range(8))
    mean = metrics.aggregate_metrics(out, [5]).first()
    assert mean["ndcg@5"] == 1.0 and mean["p@5"] == 1.0 and mean["n_users"] == 8
    rep = evaluating.eligibility_report(r, vectors(spark, m)).first()
    assert (rep.n_users, rep.n_evaluated, rep.n_skipped) == (10, 8, 2)
    assert evaluating.evaluate(r, vectors(spark, m), ks=[5], max_users=3).count() == 3
    single = evaluating.report(r, {"m": vectors(spark, m)}, ks=[5], strategies=["weighted"])
    assert [x.model for x in single.collect()] == ["m"]


@pytest.mark.parametrize("name", ["k3_profile_weighted", "k5_recommend_cosine", "k5_recommend_euclidean", "w5_display_score", "o8_featured", "j13_hits"])
def test_users_and_items_of_little_activity_are_served(spark, tmp_path, name):
    """Three users with three ratings each of items that have vectors: no threshold leaves them out of result or SQL."""
    import datetime as dt

    import duckdb

    from tastemill.plans.catalog import ORACLES, QUERIES
    from tastemill.sources.driver_views import TABLES

    day = dt.datetime(2024, 1, 1)
    rows = {
        "orders": [(o, o % 3, "F", 1.0, day, "1") for o in range(9)],
        "lineitem": [(o, o // 3 * 3 + o % 3, 0, 1, 5.0 * (o % 4 + 1), 1.0, 0.0, 0.0, "A", "F", day + dt.timedelta(o)) for o in range(9)],
        "embeddings": [(i, [float(i % 5 - 2), float(i % 3), 1.0], 0) for i in range(12)],
        "part": [(i, f"p{i}", "b", "t", 1, 1.0) for i in range(12)],
    }
    con = duckdb.connect()
    for table, found in rows.items():
        spark.createDataFrame(found, TABLES[table]).coalesce(1).write.parquet(f"{tmp_path}/{table}.parquet")
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{tmp_path}/{table}.parquet/*.parquet')")
    found = QUERIES[name](spark, str(tmp_path))
    assert {r.user_id for r in found.select("user_id").collect()} == {0, 1, 2}
    assert found.count() == len(con.execute(ORACLES[name]).fetchall())


def test_sparse_entries_take_no_more_tiles_than_the_cores_need(spark):
    """Every shard gets a copy of the vectors: 200 copies for a handful of weights is what moved the most."""
    from tastemill.operators import tiles

    m = np.random.default_rng(1).normal(size=(12, 3))
    vecs = vectors(spark, m).select(F.col("movie_idx").alias("item"), F.col("features").alias("vec"))
    entries = spark.createDataFrame([(u, i, 1.0 + u) for u in range(5) for i in range(u, 12, 3)], "key LONG, item LONG, weight DOUBLE")
    found = tiles.weighted_sums(entries, vecs, Layout(200, 1))
    assert found.rdd.getNumPartitions() <= tiles._TILES_PER_CORE * spark.sparkContext.defaultParallelism < 200
    for r in found.collect():
        assert np.allclose(r.vec, (1.0 + r.key) * m[r.key::3].sum(axis=0))


@pytest.mark.parametrize("metric", ["cosine", "euclidean"])
@pytest.mark.parametrize("scale", [1.0, 2.0, 1e3])
def test_single_precision_only_rules_out(metric, scale):
    """Lists are those of exact scores, with ties, seen items and vectors too long for single precision."""
    from tastemill.operators import tiles

    r = np.random.default_rng(3)
    m = r.normal(size=(3000, 8)) * scale
    m[1000:1400] = m[:400]
    m[1400:1500] = m[:100] * (1 + 1e-9)
    q = np.concatenate((m[:60], r.normal(size=(60, 8)) * scale))
    own = (np.arange(60), np.arange(60))
    exact = tiles._Scorer(np.arange(3000), m, metric, 20, None)
    assert (exact.near is None) == (scale == 1e3 and metric == "euclidean")
    exact.near = None
    got = tiles._Scorer(np.arange(3000), m, metric, 20, None).top(np.arange(120), q, *own)
    for a, b in zip(got, exact.top(np.arange(120), q, *own)):
        assert np.array_equal(a, b)
