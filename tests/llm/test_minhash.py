"""MinHash near-duplicates against brute force over the whole sets."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from tastemill.llm import minhash

SPACED = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, node string, family string, digest string, part string"


def plain_set(text):
    words = SPACED.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))
    return {tuple(words[k:k + 4]) for k in range(max(1, len(words) - 3))} if words else set()


def corpus():
    """Families of edited copies on both sides of 0.8, exact copies, a shared passage, and one family just below 0.8."""
    rnd = random.Random(3)
    vocabulary = [f"w{k}" for k in range(500)]
    draw = lambda n: [rnd.choice(vocabulary) for _ in range(n)]
    rows, doc = [], 0

    def add(text):
        nonlocal doc
        rows.append((doc, text))
        doc += 1

    for _ in range(30):
        base = draw(rnd.randrange(20, 300))
        for _ in range(6):
            words = list(base)
            for _ in range(rnd.randrange(0, 1 + len(base) // 25)):
                words[rnd.randrange(len(words))] = f"edited{rnd.randrange(9)}"
            add(" ".join(words))
    passage = " ".join(draw(60))
    for _ in range(60):
        add(passage + " " + " ".join(draw(rnd.randrange(10, 60))))
    base = draw(120)
    for k in range(60):  # pairs at about 0.76
        add(" ".join(base + [f"own{k}x{j}" for j in range(15)]))
    for text in (None, "", " \t\n", "One two", "one  TWO", "one two three", "Gämma ÄB c", "gämma Äb c", "go " * 500, "go " * 600, passage, passage.upper(), "x" * 30_000):
        add(text)
    long_text = " ".join(draw(20_000))
    add(long_text)
    add(long_text + " and more")
    rows += [(3, "another text of document three here"), (400, "another text of document three here"), rows[9], rows[9], (None, passage), (None, None), (401, None)]
    rnd.shuffle(rows)
    return rows


def brute_force(rows):
    rows = [(d, t) for d, t in rows if d is not None]
    sets = [plain_set(t) for _, t in rows]
    parent = {d: d for d, _ in rows}

    def find(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for i, a in enumerate(sets):
        for j in range(i):
            same = len(a & sets[j])
            if same and 100 * same >= 80 * (len(a) + len(sets[j]) - same):
                x, y = sorted((find(rows[i][0]), find(rows[j][0])))
                parent[y] = x
    return find


@pytest.mark.parametrize("bucket_rows, family_bytes", [(4096, 16 << 20), (8, 20_000)])
def test_components(spark, monkeypatch, bucket_rows, family_bytes):
    """In blocks too: small limits deal buckets and families out as pairs of blocks."""
    monkeypatch.setattr(minhash, "BUCKET_ROWS", bucket_rows)
    monkeypatch.setattr(minhash, "FAMILY_BYTES", family_bytes)
    rows = corpus()
    root = brute_force(rows)
    docs = spark.createDataFrame([(*r, "clash", "clash", "clash", "clash") for r in rows], SCHEMA).repartition(3)
    found = minhash.near_duplicates(docs).collect()
    texts = {}
    for d, t in rows:
        texts.setdefault(d, set()).add(len(plain_set(t)))
    assert len(found) == len(rows)
    linked = set()
    for r in found:
        assert r.n_shingles in texts[r.doc_id]
        if r.doc_id is None:
            assert r.component_id is None and r.kept
            continue
        expected = root(r.doc_id) if r.n_shingles else r.doc_id
        assert (r.component_id, r.kept) == (expected, r.doc_id == expected)
        linked.add(r.component_id)
    assert len(linked) < len({r.doc_id for r in found}) - 100


def test_empty_table_and_no_links(spark):
    docs = spark.createDataFrame([(2, "a b c d e"), (1, "f g h i j")], "doc_id long, text string")
    assert sorted(map(tuple, minhash.near_duplicates(docs).collect())) == [(1, 2, 1, True), (2, 2, 2, True)]
    assert minhash.near_duplicates(docs.where("false")).count() == 0


def test_sets_and_minima():
    texts = [t for _, t in corpus()]
    values, first = minhash.shingle_sets(pa.array(texts, pa.string()))
    assert np.diff(first).tolist() == [len(plain_set(t)) for t in texts]
    some = np.flatnonzero(np.diff(first))
    least = minhash.minima(values, first[some])
    # the share of equal minima estimates the similarity
    sets = [plain_set(texts[k]) for k in some]
    errors = []
    for i in range(0, len(sets), 7):
        for j in range(i, min(i + 6, len(sets))):
            similarity = len(sets[i] & sets[j]) / len(sets[i] | sets[j])
            errors.append((least[i] == least[j]).mean() - similarity)
    assert abs(np.mean(errors)) < 0.03 and np.abs(errors).max() < 0.3


def test_walk_links_what_all_pairs_link():
    rng = np.random.default_rng(1)
    sets = []
    for _ in range(20):
        base = rng.integers(0, 1 << 60, 80).astype(np.uint64)
        sets += [np.unique(np.concatenate((base[:rng.integers(55, 81)], rng.integers(0, 1 << 60, rng.integers(0, 25)).astype(np.uint64)))) for _ in range(15)]
    sig = np.zeros((len(sets), 4), np.uint64)  # all alike: only the sets decide
    parent = list(range(len(sets)))

    def find(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a, b in minhash.exact_links(np.arange(len(sets)), sets, sig):
        for x, y in zip(a.tolist(), b.tolist()):
            assert find(x) != find(y)  # a forest
            parent[find(x)] = find(y)
    for i, a in enumerate(sets):
        for j in range(i):
            same = len(np.intersect1d(a, sets[j]))
            if 100 * same >= 80 * (len(a) + len(sets[j]) - same):
                assert find(i) == find(j)
