"""MinHash near-dedup: universal hash minima, banding, verification, alternating stars.

Two documents link when the sets of their distinct four-word shingles have a
Jaccard similarity of ``PERCENT`` or more; a text of fewer words is one shingle.
Equal sets are one node, named by its smallest doc_id. A node has ``BANDS`` times
``ROWS`` minima under multiply-add hashes; a band of equal minima is a bucket, and a
pair of similarity 0.8 meets in none with chance (1 - 0.8^4)^28, 4e-7. In a bucket
signatures of two bits a minimum are compared (a pair of similarity 0.8 agrees in
fewer than ``LEAST_EQUAL`` with a chance of about 1e-6); alike nodes join a family.
A family then gets the whole sets of its members, each once, and walks from node to
node over exact links, so that a group of near copies costs a walk, not its pairs.
Both steps send out spanning forests, never pairs. Buckets of more than
``BUCKET_ROWS`` nodes and families of more than ``FAMILY_BYTES`` are dealt out as
pairs of blocks, in which every pair still meets. Components of the links are found
by large-star and small-star steps.

Null texts and texts without words have no set and link with nothing. Rows of one
doc_id are one document: if their texts differ, all of them link. A row with a
null doc_id links with nothing; its component is null and it is kept.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .components import components
from .simhash import _forest as forest
from .words import LOWER, Words, blocks, mix, spans_hash, text_buffer, windows

SHINGLE = 4
PERCENT = 80
BANDS, ROWS = 28, 4
LEAST_EQUAL = 76  # of 112
BUCKET_ROWS = 4096
FAMILY_BYTES = 16 << 20
CHUNK = 1024  # hashes of a set in one cell

_MINIMA = BANDS * ROWS
_DRAW = np.random.default_rng(12)
_TIMES = _DRAW.integers(0, 1 << 31, _MINIMA, np.uint32) * np.uint32(2) + np.uint32(1)
_PLUS = _DRAW.integers(0, 1 << 32, _MINIMA, np.uint32)
_ODD_BITS = np.uint64(0x5555555555555555)


def shingle_sets(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of all texts, one after another, and where each text's begin."""
    buf, offsets = text_buffer(texts)
    words = Words(LOWER[buf], offsets)
    hashes, counts = words.hashes(), words.counts
    at = windows(words.first, SHINGLE)
    owner = np.searchsorted(words.first, at, side="right") - 1
    short = np.flatnonzero((counts > 0) & (counts < SHINGLE))
    starts = np.concatenate((at, words.first[short]))
    ends = np.concatenate((at + SHINGLE, words.first[short + 1]))
    order = np.argsort(starts, kind="stable")
    starts, ends, owner = starts[order], ends[order], np.concatenate((owner, short))[order]
    values = spans_hash(hashes, starts, ends)
    order = np.lexsort((values, owner))
    values, owner = values[order], owner[order]
    new = np.append(True, (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])) if len(values) else np.zeros(0, bool)
    values, owner = values[new], owner[new]
    return values, np.searchsorted(owner, np.arange(len(counts) + 1))


def minima(values: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Least value of each set under each hash; begins of sets that are not empty."""
    folded = (values ^ (values >> np.uint64(32))).astype(np.uint32)
    out = np.empty((len(begins), _MINIMA), np.uint32)
    for k in range(_MINIMA if len(begins) else 0):
        out[:, k] = np.minimum.reduceat(folded * _TIMES[k] + _PLUS[k], begins)
    return out


def signatures(least: np.ndarray) -> np.ndarray:
    """Two well-mixed bits of each minimum, as four 64-bit words."""
    two = ((least * np.uint32(0x9E3779B1)) >> np.uint32(30)).astype(np.uint64)
    out = np.zeros((len(least), 4), np.uint64)
    for k in range(_MINIMA):
        out[:, k // 32] |= two[:, k] << np.uint64(2 * (k % 32))
    return out


def band_keys(least: np.ndarray) -> np.ndarray:
    pairs = np.ascontiguousarray(least).view(np.uint64).reshape(len(least), BANDS, ROWS // 2)
    key = mix(pairs[:, :, 0] + np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    return mix(key ^ pairs[:, :, 1] * np.uint64(0x9E3779B97F4A7C15)).view(np.int64)


def _cells(rows: np.ndarray) -> pa.Array:
    """A binary cell per row of a matrix."""
    width = rows.itemsize * rows.shape[1]
    offsets = pa.py_buffer((np.arange(len(rows) + 1) * width).astype(np.int32).tobytes())
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, offsets, pa.py_buffer(np.ascontiguousarray(rows).tobytes())])


def _matrix(column: pa.Array, dtype, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype).reshape(-1, width)


def describe(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, and digest of the set, signature and band keys (null for an empty set) of every row."""

    def run(batches):
        for block in blocks(batches):
            values, first = shingle_sets(block.column("text"))
            n = np.diff(first)
            some = np.flatnonzero(n)
            least = minima(values, first[some])
            data = values.tobytes()
            digests = [xxhash.xxh3_128_digest(data[8 * a:8 * b]) for a, b in zip(first[some].tolist(), first[some + 1].tolist())]
            place = np.full(len(n), -1)
            place[some] = np.arange(len(some))
            take = pa.array(place, mask=place < 0)
            columns = [pa.array(digests, pa.binary()), _cells(signatures(least)), _cells(band_keys(least))]
            yield pa.RecordBatch.from_arrays([block.column("doc_id"), pa.array(n, pa.int64()), *(c.take(take) for c in columns)],
                                             names=["doc_id", "n_shingles", "digest", "sig", "bands"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, n_shingles long, digest binary, sig binary, bands binary")


def _equal(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Agreeing minima of signatures, row by row."""
    differ = a ^ b
    return _MINIMA - np.bitwise_count((differ | differ >> np.uint64(1)) & _ODD_BITS).sum(axis=-1, dtype=np.int32)


def _walk(nodes: np.ndarray, sig: np.ndarray):
    """Forest of alike rows of one bucket: each row met is compared with those not yet met."""
    rest = np.arange(len(nodes))
    while len(rest):
        queue, rest = [int(rest[0])], rest[1:]
        while queue and len(rest):
            k = queue.pop()
            hit = _equal(sig[rest], sig[k]) >= LEAST_EQUAL
            if hit.any():
                found, rest = rest[hit], rest[~hit]
                queue += found.tolist()
                yield np.full(len(found), nodes[k]), nodes[found]


def _bucket_links(keys: np.ndarray, nodes: np.ndarray, sig: np.ndarray):
    """Alike nodes of rows sorted by key: small buckets by row distance, others by walking."""
    begin = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    size = np.diff(np.append(begin, len(keys)))
    room = np.repeat(begin + size, size) - np.arange(len(keys))
    small = np.repeat(size <= 16, size)
    for step in range(1, 16):
        at = np.flatnonzero(small & (room > step))
        if not len(at):
            break
        at = at[_equal(sig[at], sig[at + step]) >= LEAST_EQUAL]
        yield nodes[at], nodes[at + step]
    for b, n in zip(begin[size > 16].tolist(), size[size > 16].tolist()):
        yield from _walk(nodes[b:b + n], sig[b:b + n])


def _candidates(batches):
    """(a, b) alike nodes, as forests, from rows sorted by (bucket, part)."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    n, keep = 0, None

    def out():
        a, b = (np.concatenate(x) for x in zip(*held))
        a, b = forest(a[a != b], b[a != b])
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    for batch in batches:
        if not batch.num_rows:
            continue
        rows = [batch.column("bucket").to_numpy(), batch.column("part").to_numpy(), batch.column("node").to_numpy(), _matrix(batch.column("sig"), np.uint64, 4)]
        if keep is not None:
            rows = [np.concatenate(x) for x in zip(keep, rows)]
        new = (rows[0][1:] != rows[0][:-1]) | (rows[1][1:] != rows[1][:-1])
        cuts = np.flatnonzero(new)
        whole = int(cuts[-1]) + 1 if len(cuts) else 0  # the last bucket may go on
        if whole:
            held += _bucket_links(np.cumsum(np.append(0, new[:whole - 1])), rows[2][:whole], rows[3][:whole])
            n = sum(len(a) for a, _ in held)
        keep = [r[whole:] for r in rows]
        if n > 1 << 18:
            yield out()
            held, n = [], 0
    if keep is not None:
        held += _bucket_links(np.zeros(len(keep[0]), np.int64), keep[2], keep[3])
    if held:
        yield out()


def _deal(batches):
    for batch in batches:
        for at in range(0, batch.num_rows, 2048):
            part = batch.slice(at, 2048)
            keys = _matrix(part.column("bands"), np.int64, BANDS)
            sig = np.repeat(_matrix(part.column("sig"), np.uint64, 4), BANDS, axis=0)
            node = np.repeat(part.column("node").to_numpy(), BANDS)
            yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), pa.array(node), _cells(sig)], names=["bucket", "node", "sig"])


def _parts(own, n):
    """The pairs of n blocks that block ``own`` is in; blocks i <= j meet in part i * n + j."""
    return F.transform(F.sequence(F.lit(0).cast("long"), n - 1), lambda k: F.least(k, own) * n + F.greatest(k, own))


def candidate_links(nodes: DataFrame) -> DataFrame:
    """Links (a, b) that join all nodes (node, sig, bands) of equal bands and alike signatures."""
    dealt = nodes.mapInArrow(_deal, "bucket long, node long, sig binary")
    hot = dealt.groupBy("bucket").count().where(F.col("count") > BUCKET_ROWS).select(
        "bucket", F.ceil(F.col("count") / (BUCKET_ROWS // 2)).cast("long").alias("n"))
    parts = F.when(F.col("n").isNull(), F.array(F.lit(0).cast("long"))).otherwise(_parts(F.pmod(F.xxhash64("node"), F.col("n")), F.col("n")))
    rows = dealt.join(hot, "bucket", "left").select("bucket", F.explode(parts).alias("part"), "node", "sig")
    return rows.repartition("bucket", "part").sortWithinPartitions("bucket", "part").mapInArrow(_candidates, "a long, b long")


def exact_links(nodes: np.ndarray, sets: list[np.ndarray], sig: np.ndarray):
    """Forest (a, b) of the nodes whose sets are similar enough, by walking over exact links."""
    order = np.argsort([len(s) for s in sets], kind="stable")
    nodes, sig, size = nodes[order], sig[order], np.array([len(sets[k]) for k in order], np.int64)
    flat = np.unique(np.concatenate([sets[k] for k in order]), return_inverse=True)[1]
    mark = np.zeros(int(flat.max()) + 1, np.uint8)
    begin = np.concatenate(([0], np.cumsum(size)))
    open_ = np.ones(len(nodes), bool)
    for root in range(len(nodes)):
        queue = [root] if open_[root] else []
        open_[root] = False
        while queue:
            k = queue.pop()
            # similar sets differ little in size, and stand near by
            low, high = np.searchsorted(size, (-(-PERCENT * size[k] // 100), 100 * size[k] // PERCENT + 1))
            rows = low + np.flatnonzero(open_[low:high])
            rows = rows[_equal(sig[rows], sig[k]) >= LEAST_EQUAL]
            if not len(rows):
                continue
            mine = flat[begin[k]:begin[k + 1]]
            mark[mine] = 1
            for at in range(0, len(rows), 4096):
                part = rows[at:at + 4096]
                ends = np.cumsum(size[part])
                places = np.arange(ends[-1]) + np.repeat(begin[part] - ends + size[part], size[part])
                same = np.add.reduceat(mark[flat[places]], ends - size[part], dtype=np.int64)
                hit = part[100 * same >= PERCENT * (size[part] + size[k] - same)]
                if len(hit):
                    open_[hit] = False
                    queue += hit.tolist()
                    yield np.full(len(hit), nodes[k]), nodes[hit]
            mark[mine] = 0


def _spread(batches):
    """Signature and set of every text, in chunks, once for each part of its family."""
    for block in blocks(batches):
        values, first = shingle_sets(block.column("text"))
        some = np.flatnonzero(np.diff(first))
        sig = signatures(minima(values, first[some])).tobytes()
        data, rows = values.tobytes(), []
        for row, (k, a, b) in enumerate(zip(some.tolist(), first[some].tolist(), first[some + 1].tolist())):
            family, node, parts = (block.column(c)[k].as_py() for c in ("family", "node", "parts"))
            content = sig[32 * row:32 * row + 32] + data[8 * a:8 * b]
            name = xxhash.xxh3_128_digest(content)
            for at in range(0, len(content), 8 * CHUNK):
                rows += [(family, p, node, name, at, content[at:at + 8 * CHUNK]) for p in parts]
            if len(rows) >= 1024:
                yield _set_rows(rows)
                rows = []
        if rows:
            yield _set_rows(rows)


_SET = "family long, part long, node long, name binary, at long, content binary"
_SET_TYPES = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.binary()]


def _set_rows(rows) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _SET_TYPES)], names=[f.split()[0] for f in _SET.split(", ")])


def _family_links(batches):
    """Exact links of each (family, part) from set chunks in order."""
    key, node, name, last, sets = None, None, None, -1, []

    def out():
        whole = [(n, b"".join(c)) for n, c in sets]
        sig = np.frombuffer(b"".join(c[:32] for _, c in whole), np.uint64).reshape(-1, 4)
        found = list(exact_links(np.array([n for n, _ in whole]), [np.frombuffer(c, np.uint64, offset=32) for _, c in whole], sig))
        if found:
            a, b = (np.concatenate(x) for x in zip(*found))
            yield pa.RecordBatch.from_arrays([pa.array(a[a != b]), pa.array(b[a != b])], names=["a", "b"])

    for batch in batches:
        columns = [batch.column(k).to_pylist() for k in range(5)]
        for row, (f, p, n, m, at) in enumerate(zip(*columns)):
            if (f, p) != key:
                if len(sets) > 1:
                    yield from out()
                key, node, name, sets = (f, p), None, None, []
            if (n, m) != (node, name):
                node, name, last = n, m, -1
                sets.append((n, []))
            if at != last:  # a repeated row repeats its chunks
                sets[-1][1].append(batch.column(5)[row].as_py())
                last = at
    if len(sets) > 1:
        yield from out()


def verified_links(docs: DataFrame, families: DataFrame, sizes: DataFrame) -> DataFrame:
    """Exact links (a, b) inside the families (node, root); ``sizes`` (node, n_shingles) bounds what a task holds."""
    members = sizes.groupBy("node").agg(F.sum("n_shingles").alias("n_shingles")).join(families, "node")
    heavy = members.groupBy("root").agg(F.sum(F.col("n_shingles") * 8 + 64).alias("_bytes"), F.count("*").alias("_nodes")).where("_nodes > 1").select(
        "root", F.when(F.col("_bytes") <= FAMILY_BYTES, 1).otherwise(F.ceil(F.col("_bytes") / (FAMILY_BYTES // 2))).cast("long").alias("n"))
    wanted = members.join(heavy, "root").select(F.col("root").alias("family"), "node", _parts(F.pmod(F.xxhash64("node"), F.col("n")), F.col("n")).alias("parts"))
    texts = docs.select(F.col("doc_id").cast("long").alias("_id"), "text").join(cut_lineage(wanted), F.col("_id") == F.col("node"))
    chunks = texts.select("family", "node", "parts", "text").mapInArrow(_spread, _SET)
    dealt = chunks.repartition("family", "part").sortWithinPartitions("family", "part", "node", "name", "at")
    return dealt.mapInArrow(_family_links, "a long, b long")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable over links) and kept (doc_id is component_id) of every row."""
    rows = cut_lineage(describe(docs).hint("rebalance"))  # files of one size, whatever the input's are
    sets = rows.where("digest IS NOT NULL AND doc_id IS NOT NULL")
    nodes = cut_lineage(sets.groupBy("digest").agg(F.min("doc_id").alias("node"), F.count("*").alias("copies"), F.max("n_shingles").alias("n_shingles"),
                                                   F.first("sig").alias("sig"), F.first("bands").alias("bands")))
    families = cut_lineage(components(cut_lineage(candidate_links(nodes.select("node", "sig", "bands")))))
    links = cut_lineage(verified_links(docs, families, nodes.select("node", "n_shingles")))
    several = sets.groupBy("doc_id").agg(F.min(F.xxhash64("digest")).alias("a"), F.max(F.xxhash64("digest")).alias("b")).where("a <> b").select("doc_id")
    if not several.isEmpty():  # a doc_id with different texts is one document
        of = sets.join(several, "doc_id", "left_semi").select("doc_id", "digest").distinct().join(nodes.select("digest", "node"), "digest")
        links = links.union(of.where("doc_id <> node").select(F.col("node").alias("a"), F.col("doc_id").alias("b")))
    roots = components(links).toDF("_node", "root")
    placed = nodes.join(roots, F.col("node") == F.col("_node"), "left").select("digest", F.coalesce("root", "node").alias("_root"), "node", "copies")
    moved = placed.where("copies > 1 OR _root <> node").select("digest", "_root")
    found = rows.select("doc_id", "n_shingles", "digest").join(moved, "digest", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("_root", "doc_id"))
    return found.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))
