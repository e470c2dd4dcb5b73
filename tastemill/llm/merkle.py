"""Merkle manifest of a dataset: a root per group, a root over all, and a proof per row.

A leaf is the SHA-256 of a row's fields. The leaves of a group (one language)
stand in the order of doc_id; two neighbours become one node until a single one
is left, and the roots of the groups become the root of the dataset the same way.
A tree is cut into aligned blocks: up to ``HEIGHT`` levels are one block, up to
twice that are cut at half height, taller ones ``HEIGHT`` levels at a time. The
roots of the blocks are the leaves of the next stage, so a stage is one shuffle
and no task sees more than a block. A block is one cell, its digests in van Emde
Boas order: the upper half of the levels first, then each subtree below, each laid
out likewise. Building a block and reading siblings from it use the same address
arithmetic. Proofs run the other way: a stage reads the siblings inside a block
and hands the rest of the path on to the blocks below.

Null fields have their own mark in the leaf; a null group is a group, the first.
Rows of one doc_id stand in the order of their leaves; equal rows are leaves of
their own. A null doc_id comes first. No rows give no proofs and no root. Only
the five named columns are read, whatever others there are.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

HEIGHT = 10  # levels of a block: 1,024 leaves, 64 kB of digests
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_BLOCK = "g string, block long, n long, height int, payload binary, tree binary"


def digest(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(fields: list[Column]) -> Column:
    """Digest (hex) of a row: each field as its byte count, a colon and its text, null as a dash."""
    coded = [F.when(f.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(f).cast("string"), F.lit(":"), f)) for f in (c.cast("string") for c in fields)]
    return F.sha2(F.concat(*coded).cast("binary"), 256)


def address(levels: int, depth: int, index: np.ndarray) -> np.ndarray:
    """Place of the nodes ``index`` at ``depth`` (root 0) in the van Emde Boas order of a full tree of that many levels."""
    base = np.zeros_like(index)
    while levels > 1:
        top = levels // 2
        if depth < top:
            levels = top
            continue
        below, under = levels - top, depth - top
        base = base + (1 << top) - 1 + (index >> under) * ((1 << below) - 1)
        index, depth, levels = index & ((1 << under) - 1), under, below
    return base


@lru_cache(maxsize=None)
def _places(height: int) -> list[np.ndarray]:
    return [address(height + 1, d, np.arange(1 << d, dtype=np.int64)) for d in range(height + 1)]


def build_block(leaves: list[str], height: int) -> tuple[bytes, str]:
    """All digests of a block in their places, and its root; positions without a node stay zero."""
    places, level = _places(height), leaves
    tree = np.zeros(((2 << height) - 1, 32), np.uint8)
    for depth in range(height, -1, -1):
        if depth < height:
            level = [digest(*level[k:k + 2]) for k in range(0, len(level), 2)]
        tree[places[depth][:len(level)]] = np.frombuffer(bytes.fromhex("".join(level)), np.uint8).reshape(-1, 32)
    return tree.tobytes(), level[0]


def siblings(tree: bytes, height: int, count: int) -> list[str]:
    """Path of each of the ``count`` leaves to the block's root: per level R or L and the sibling on that side, or a dash for none."""
    places, raw = _places(height), tree.hex()
    paths = [[] for _ in range(count)]
    for depth in range(height, 0, -1):
        shift = height - depth
        nodes = ((count - 1) >> shift) + 1
        at = places[depth]
        steps = [("-" if k ^ 1 >= nodes else ("L" if k & 1 else "R") + raw[64 * (a := int(at[k ^ 1])):64 * a + 64]) for k in range(nodes)]
        for k, path in enumerate(paths):
            path.append(steps[k >> shift])
    return list(map("".join, paths))


def steps_of(path: str) -> list[str]:
    """The steps of a path: "-", or side and digest."""
    out, at = [], 0
    while at < len(path):
        end = at + (1 if path[at] == "-" else 65)
        out.append(path[at:end])
        at = end
    return out


def fold(value: str, path: str) -> str:
    """Root that a leaf and its path lead to."""
    for step in steps_of(path):
        value = digest(value) if step == "-" else digest(value, step[1:]) if step[0] == "R" else digest(step[1:], value)
    return value


@dataclass
class Tree:
    """Blocks of every stage, the leaves' first, and the root of each group (g, root)."""

    stages: list[DataFrame]
    roots: DataFrame


def _numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` with pos, their number in the group g in that order, and n, the size of the group."""
    ranged = rows.repartitionByRange("g", *order).sortWithinPartitions("g", *order)
    placed = cut_lineage(ranged.withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftright("_at", 33)
    sizes = placed.groupBy("g", part.alias("_part")).agg(F.min("_at").alias("_from"), F.count("*").alias("_rows"))
    before = Window.partitionBy("g").orderBy("_part")
    sizes = sizes.select("g", "_part", "_from", (F.sum("_rows").over(before) - F.col("_rows")).alias("_before"),
                         F.sum("_rows").over(Window.partitionBy("g")).alias("n"))
    joined = placed.withColumn("_part", part).join(sizes, ["g", "_part"])
    return joined.select("g", (F.col("_before") + F.col("_at") - F.col("_from")).alias("pos"), "n", "digest", "payload")


def _blocks(rows: DataFrame) -> DataFrame:
    """One row per aligned block of nodes (g, pos, n, digest, payload)."""

    def run(batches):
        key, held = None, []

        def out():
            tree, _ = build_block([d.hex() for d, _ in held], key[3])
            # doc ids and what else the leaves carry, as one Arrow table in a cell
            payload = pa.BufferOutputStream()
            if held[0][1] is not None:
                table = pa.table({"payload": pa.array([p for _, p in held], kind)})
                with pa.ipc.new_stream(payload, table.schema) as writer:
                    writer.write_table(table)
            return key, payload.getvalue().to_pybytes(), tree

        def batch_of(blocks):
            keys = list(zip(*(k for k, _, _ in blocks)))
            columns = [pa.array(keys[0], pa.string()), pa.array(keys[1], pa.int64()), pa.array(keys[2], pa.int64()), pa.array(keys[3], pa.int32())]
            columns += [pa.array([p for _, p, _ in blocks], pa.binary()), pa.array([t for _, _, t in blocks], pa.binary())]
            return pa.RecordBatch.from_arrays(columns, names=["g", "block", "n", "height", "payload", "tree"])

        ready, kind = [], None
        for batch in batches:
            kind = batch.column("payload").type
            keys = zip(*(batch.column(c).to_pylist() for c in ("g", "block", "n", "height")))
            for k, d, p in zip(keys, batch.column("digest").to_pylist(), batch.column("payload").to_pylist()):
                if k != key:
                    if held:
                        ready.append(out())
                    key, held = k, []
                    if len(ready) >= 64:
                        yield batch_of(ready)
                        ready = []
                held.append((d, p))
        if held:
            ready.append(out())
        if ready:
            yield batch_of(ready)

    tall = F.when(F.col("n") <= 1, 0).otherwise(F.length(F.bin(F.col("n") - 1)))
    height = F.when(tall <= HEIGHT, tall).when(tall <= 2 * HEIGHT, F.ceil(tall / 2)).otherwise(HEIGHT)
    cut = rows.withColumn("height", height.cast("int")).withColumn("block", F.expr("shiftright(pos, height)"))
    dealt = cut.repartition("g", "block").sortWithinPartitions("g", "block", "pos")
    return dealt.select("g", "block", "n", "height", "digest", "payload").mapInArrow(run, _BLOCK)


def build(rows: DataFrame) -> Tree:
    """Trees of the nodes (g, pos, n, digest, payload), pos without gaps in each group."""
    stages, roots = [], []
    while True:
        blocks = cut_lineage(_blocks(rows))
        stages.append(blocks)
        # the root of a block stands first in its order
        nodes = blocks.select("g", F.col("block").alias("pos"), F.expr("shiftright(n - 1, height) + 1").alias("n"),
                              F.substring("tree", 1, 32).alias("digest"), F.lit(None).cast("string").alias("payload"))
        roots.append(nodes.where("n = 1").select("g", F.col("digest").alias("root")))
        rows = nodes.where("n > 1")
        if rows.isEmpty():
            break
    every = roots[0]
    for more in roots[1:]:
        every = every.union(more)
    return Tree(stages, every)


def paths(tree: Tree, above: DataFrame, kind: str) -> DataFrame:
    """(g, payload, digest, path) of every leaf; ``above`` (g, path) goes on from each group's root."""

    def run(payloads: bool):
        def of(batches):
            for batch in batches:
                for g, block, n, height, payload, store, up in zip(*(batch.column(c) for c in ("g", "block", "n", "height", "payload", "tree", "path"))):
                    height, block, store, up = height.as_py(), block.as_py(), store.as_py(), up.as_py()
                    count = min(n.as_py() - (block << height), 1 << height)
                    ways = [path + up for path in siblings(store, height, count)]
                    at = _places(height)[height][:count]
                    found = np.frombuffer(store, np.uint8).reshape(-1, 32)[at]
                    leaves = pa.FixedSizeBinaryArray.from_buffers(pa.binary(32), count, [None, pa.py_buffer(found.tobytes())]).cast(pa.binary())
                    names = pa.array([g.as_py()] * count, pa.string())
                    if payloads:
                        carried = pa.ipc.open_stream(payload.as_buffer()).read_all().column(0).combine_chunks()
                        yield pa.RecordBatch.from_arrays([names, carried, leaves, pa.array(ways)], names=["g", "payload", "digest", "path"])
                    else:
                        yield pa.RecordBatch.from_arrays([names, pa.array(np.arange(count) + (block << height)), pa.array(ways)], names=["g", "block", "path"])

        return of

    rest = None
    for k in range(len(tree.stages) - 1, -1, -1):
        blocks = tree.stages[k]
        last = F.col("n") <= F.expr("shiftleft(1L, height)")  # the only block of its group
        met = blocks.where(last).join(above, "g")
        if rest is not None:
            met = met.unionByName(blocks.where(~last).join(rest, ["g", "block"]))
        schema = f"g string, payload {kind}, digest binary, path string" if k == 0 else "g string, block long, path string"
        rest = met.mapInArrow(run(k == 0), schema)
        if k:
            rest = cut_lineage(rest)
    return rest


@dataclass
class Manifest:
    """The trees of the groups, the tree over their roots, and its root (no row for an empty table)."""

    groups: Tree
    top: Tree


def manifest(docs: DataFrame, group: str = "lang", claimed: Column | None = None) -> Manifest:
    """Manifest of ``docs``. ``claimed``, the leaf (hex) of a row's later state where that changed, travels along to be verified."""
    claimed = F.lit(None).cast("string") if claimed is None else claimed
    key = F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit(""))  # null first, then by bytes
    rows = cut_lineage(docs.select(key.alias("g"), F.unhex(leaf([F.col(c) for c in FIELDS])).alias("digest"),
                                   F.col("doc_id").cast("long").alias("_id"), F.unhex(claimed).alias("_claimed")).hint("rebalance"))
    carried = F.struct(F.col("_id").alias("doc_id"), F.col("_claimed").alias("claimed")).alias("payload")
    groups = build(_numbered(rows.select("g", "_id", "digest", carried), ["_id", "digest"]))
    heads = groups.roots.select(F.lit("").alias("g"), F.col("g").alias("_name"), F.col("root").alias("digest"), F.col("g").alias("payload"))
    return Manifest(groups, build(_numbered(heads, ["_name"])))


def prove(of: Manifest) -> DataFrame:
    """doc_id, claimed, leaf, subroot, root (binary) and path of every row."""
    start = of.top.roots.select("g", F.lit("").alias("path"))
    above = paths(of.top, start, "string").join(of.top.roots, "g")
    above = cut_lineage(above.select(F.col("payload").alias("g"), F.col("digest").alias("subroot"), "root", "path"))
    found = paths(of.groups, above.select("g", "path"), "struct<doc_id: bigint, claimed: binary>")
    return found.join(above.select("g", "subroot", "root"), "g").select(
        "payload.doc_id", "payload.claimed", F.col("digest").alias("leaf"), "subroot", "root", "path")


def verify(proofs: DataFrame) -> DataFrame:
    """proofs with proof_sha256 (of the siblings), folded_root (of the claimed leaf, else the leaf) and verified; digests in hex."""

    def run(batches):
        for batch in batches:
            sha, roots = [], []
            for value, path in zip(batch.column("value").to_pylist(), batch.column("path").to_pylist()):
                sha.append(digest(*(s[1:] for s in steps_of(path))))
                roots.append(fold(value, path))
            kept = [batch.column(c) for c in ("doc_id", "leaf", "subroot", "root")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(sha, pa.string()), pa.array(roots, pa.string())],
                                             names=["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root"])

    text = lambda c: F.lower(F.hex(c))
    rows = proofs.select("doc_id", text("leaf").alias("leaf"), text("subroot").alias("subroot"), text("root").alias("root"),
                         text(F.coalesce("claimed", "leaf")).alias("value"), "path")
    found = rows.mapInArrow(run, "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string")
    return found.withColumn("verified", F.col("folded_root") == F.col("root"))
