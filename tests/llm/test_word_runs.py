"""Periodic runs against plain scans of every period."""

import collections
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from tastemill.llm import word_runs

SPACED = re.compile(r"[^\x20\x09-\x0D]+")


def plain_runs(words):
    """Maximal stretches by period; those inside a stretch of a smaller period have that period."""
    found = []
    for q in range(1, len(words) // 4 + 1):
        k = 0
        while k + q < len(words):
            if words[k] != words[k + q]:
                k += 1
                continue
            start = k
            while k + q < len(words) and words[k] == words[k + q]:
                k += 1
            end = k + q
            if end - start >= max(6, 4 * q) and not any(s <= start and s + n >= end for s, n, _ in found):
                found.append((start, end - start, q))
    return sorted(found, key=lambda r: (r[0], r[2]))


def plain_kept(words, runs):
    gone = {k for s, n, q in runs for k in range(s + q, s + n)}
    return " ".join(w for k, w in enumerate(words) if k not in gone)


def texts():
    rnd = random.Random(9)
    out = [None, "", "  \n", "a", "a a a a a", "a a a a a a", "a b a b a b a", "a b a b a b a b", "a b c " * 4, "a b c " * 4 + "a", "x " * 300, "a b " * 3 + "c " + "a b " * 4,
           "same\nsame\tsame same  same same same same", "é ü " * 40, "w" * 9_000]
    for letters in (1, 2, 3, 5):
        for _ in range(60):
            out.append(" ".join(rnd.choice("abcde"[:letters]) for _ in range(rnd.randrange(1, 120))))
    for _ in range(60):  # nested and neighbouring repetitions
        unit = [rnd.choice("abcdef") for _ in range(rnd.randrange(1, 9))]
        unit = unit * rnd.randrange(1, 7) + [rnd.choice("abcdef") for _ in range(rnd.randrange(0, 4))]
        words = [rnd.choice("abcdef") for _ in range(rnd.randrange(0, 9))] + unit * rnd.randrange(2, 7) + unit[:rnd.randrange(len(unit))]
        out.append(" ".join(words + [rnd.choice("abcdef") for _ in range(rnd.randrange(0, 9))]))
    for _ in range(40):  # one long period from some word on
        words = [f"w{rnd.randrange(400)}" for _ in range(rnd.randrange(10, 600))]
        a = rnd.randrange(len(words))
        p = 1 + (len(words) - a) // rnd.randrange(3, 11)
        out.append(" ".join(words[i] if i < a else words[a + (i - a) % p] for i in range(len(words))))
    return out


def test_runs_of_many_texts_at_once():
    all_texts = texts()
    n, runs, kept = word_runs.collapse(pa.array(all_texts, pa.string()))
    for text, count, mine, left in zip(all_texts, n, runs.to_pylist(), kept):
        words = SPACED.findall(text or "")
        expected = plain_runs(words)
        assert [(r["start"], r["length"], r["period"]) for r in mine] == expected, (text or "")[:200]
        assert count == len(words) and left.decode() == plain_kept(words, expected)
    assert sum(len(r) for r in runs.to_pylist()) > 200  # the texts do have runs


@pytest.mark.parametrize("n", [1, 2, 5, 64, 1000])
def test_successor(n):
    rng = np.random.default_rng(n)
    values = rng.permutation(n)
    tree = word_runs.WaveletTree(values)
    low = rng.integers(0, n, 300)
    high = low + rng.integers(0, n - low + 1)
    x = rng.integers(0, n, 300)
    expected = [min((v for v in values[a:b].tolist() if v > k), default=-1) for a, b, k in zip(low, high, x)]
    assert tree.successor(low, high, x).tolist() == expected


def test_runs_do_not_rest_on_sums(monkeypatch):
    """Prefix sums that agree by chance are noticed, and the stretch is read word by word."""
    monkeypatch.setattr(word_runs, "_common", lambda sums, a, d, limit, back: limit)
    words = "z a b a b a b a b y a b a b a b a b c c c c c c x".split()
    _, runs, _ = word_runs.collapse(pa.array([" ".join(words)]))
    assert [(r["start"], r["length"], r["period"]) for r in runs.to_pylist()[0]] == plain_runs(words)


def test_long_texts_stay_quick():
    import time

    rnd = random.Random(1)
    tower = ["a"]
    for k in range(12):
        tower = tower * 3 + [f"s{k % 3}"]
    long_texts = ["go " * 200_000, " ".join(rnd.choice("ab") for _ in range(200_000)), " ".join(tower[:200_000]), "a b c d e f g h i j " * 20_000]
    start = time.perf_counter()
    n, runs, _ = word_runs.collapse(pa.array(long_texts))
    assert time.perf_counter() - start < 30
    assert runs.to_pylist()[0] == [{"start": 0, "length": 200_000, "period": 1}] and runs.to_pylist()[3] == [{"start": 0, "length": 200_000, "period": 10}]


def test_find_runs(spark):
    rows = [*enumerate(texts()), (3, "a"), (None, "b b b b b b"), (None, None)]
    docs = spark.createDataFrame([(*r, "clash", "clash", 1) for r in rows], "doc_id long, text string, runs string, kept string, n_words long").repartition(4)
    expected = collections.Counter()
    for d, t in rows:
        words = SPACED.findall(t or "")
        runs = plain_runs(words)
        expected[d, len(words), tuple(runs), plain_kept(words, runs)] += 1
    found = collections.Counter((r.doc_id, r.n_words, tuple(map(tuple, r.runs)), r.kept) for r in word_runs.find_runs(docs).collect())
    assert found == expected
    assert word_runs.find_runs(docs.where("false")).count() == 0
