"""The Merkle manifest against trees built level by level in plain Python."""

import collections
import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tastemill.llm import merkle

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, g string, payload string, path string"


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_leaf(row, n_chars=None):
    values = [row[0], row[1], row[2], row[3] if n_chars is None else n_chars, row[4]]
    return sha(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def way(level, at):
    """Siblings of a node up to the root of its level, and the root."""
    path = []
    while len(level) > 1:
        path += [level[at ^ 1]] if at ^ 1 < len(level) else []
        level = [sha(*level[k:k + 2]) for k in range(0, len(level), 2)]
        at //= 2
    return path, level[0]


def plain(rows):
    groups = collections.defaultdict(list)
    for row in rows:
        groups[row[2]].append((-1 if row[0] is None else row[0], plain_leaf(row), row))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    leaves = {g: [h for _, h, _ in sorted(groups[g], key=lambda x: x[:2])] for g in names}
    heads = [way(leaves[g], 0)[1] for g in names]
    out = collections.Counter()
    for k, g in enumerate(names):
        above, root = way(heads, k)
        for at, (_, h, row) in enumerate(sorted(groups[g], key=lambda x: x[:2])):
            out[row[0], h, heads[k], root, sha(*way(leaves[g], at)[0], *above)] += 1
    return out


def rows_of(n, seed=1):
    rnd = random.Random(seed)
    rows = [(k, rnd.choice(["web", None, "ü|-"]), rnd.choice(["en", "de", None, "", "zh"]), rnd.choice([k, None]), rnd.choice([f"text {k}", "", None, "日本 " * 50])) for k in range(n)]
    rows += [rows[3], rows[3], (rows[5][0], "other", rows[5][2], 1, "same id"), (None, None, "en", None, None), (None, "s", "en", 3, "x" * 100_000), (7, "s", "alone", 1, "one")]
    rnd.shuffle(rows)
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, "clash", "clash", "clash") for r in rows], SCHEMA).repartition(3)


@pytest.mark.parametrize("height", [10, 2])
def test_proofs(spark, monkeypatch, height):
    monkeypatch.setattr(merkle, "HEIGHT", height)
    rows = rows_of(60)
    docs = frame(spark, rows)
    later = merkle.leaf([F.col(c) + 1 if c == "n_chars" else F.col(c) for c in merkle.FIELDS])
    found = merkle.verify(merkle.prove(merkle.manifest(docs, claimed=F.when(F.col("doc_id") % 3 == 0, later)))).collect()
    assert collections.Counter((r.doc_id, r.leaf, r.subroot, r.root, r.proof_sha256) for r in found) == plain(rows)
    changed = {plain_leaf(r) for r in rows if r[0] is not None and r[0] % 3 == 0 and r[3] is not None}
    assert changed and all(r.verified == (r.leaf not in changed) for r in found)
    assert all((r.folded_root == r.root) == r.verified for r in found)


def test_one_row_and_none(spark):
    one = frame(spark, [(4, "s", None, 3, "abc")])
    row = merkle.verify(merkle.prove(merkle.manifest(one))).first()
    assert row.leaf == row.subroot == row.root == row.folded_root and row.proof_sha256 == sha("")
    assert merkle.prove(merkle.manifest(one.where("false"))).count() == 0


def test_addresses_are_van_emde_boas():
    """A permutation in which every subtree below half height is contiguous."""
    for levels in range(1, 9):
        places = [merkle.address(levels, d, np.arange(1 << d)) for d in range(levels)]
        assert sorted(np.concatenate(places).tolist()) == list(range((1 << levels) - 1))
        top = levels // 2
        for sub in range(1 << top if top else 0):
            cells = [c for d in range(top, levels) for c in places[d][sub << (d - top):(sub + 1) << (d - top)].tolist()]
            assert max(cells) - min(cells) == len(cells) - 1
    assert merkle.address(4, 2, np.arange(4)).tolist() == [3, 6, 9, 12]


def test_order_does_not_depend_on_partitions(spark):
    docs = frame(spark, rows_of(40, 2))
    first, second = (collections.Counter(map(tuple, merkle.prove(merkle.manifest(d)).collect())) for d in (docs, docs.repartition(5, "text")))
    assert first == second
