"""SimHash near-duplicates with Golay-code fuzzy hashing.

A fingerprint is cut into segments of 22, 21 and 21 bits, each padded to a word
of the perfect (23, 12, 7) Golay code. Two words that differ in one bit share
the nearest codeword of the first among the codewords within distance 4 of the
second (one of them, or six). Of three differing bits at most one segment can
get two or more, so some pair of segments differs by at most one bit in each:
for every pair a fingerprint goes to the buckets (nearest, any) and (any,
nearest), 29 in the mean, and every link meets in one of them. Buckets are
compared block by block and give a spanning forest of the verified links, never
all pairs; a bucket beyond ``BUCKET_ROWS`` is dealt out as pairs of blocks.

Documents of one fingerprint are one node. Null and empty texts, and texts
without words, have fingerprint zero and link like any other. Repeated rows get
the same result; a null doc_id is never a component's id unless all are null.
"""

from __future__ import annotations

from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .components import components

SHINGLE = 3
SEED = 42
MAX_BITS = 3
BUCKET_ROWS = 4096

_GENERATOR = 0b101011100011  # x^11 + x^9 + x^7 + x^6 + x^5 + x + 1
_SEGMENTS = ((42, 22), (21, 21), (0, 21))  # shift, bits


def fingerprint(text: bytes | None, words: int = SHINGLE) -> int:
    """SimHash of the word shingles of a UTF-8 text, A-Z lowered, as a signed 64-bit integer."""
    tokens = (text or b"").lower().split()  # both for ASCII only
    if not tokens:
        return 0
    if len(tokens) <= words:
        shingles = [b" ".join(tokens)]
    else:
        shingles = list(map(b" ".join, zip(*(tokens[k:] for k in range(words)))))
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), ">u8", len(shingles))
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 15):
        part = hashes[at:at + (1 << 15)]
        ones += np.unpackbits(part.view(np.uint8)).reshape(-1, 64).sum(axis=0, dtype=np.int32)
    return int(np.packbits(ones * 2 > len(hashes)).view(">i8")[0])


def fingerprints(docs: DataFrame, words: int = SHINGLE) -> DataFrame:
    """(doc_id, fp) of every row."""

    def run(batches):
        for batch in batches:
            text = batch.column("text").cast(pa.large_binary())
            values = [fingerprint(t.as_py(), words) for t in text]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(values, pa.int64())], names=["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, fp long")


def _syndromes(words: np.ndarray) -> np.ndarray:
    """Remainder of each 23-bit word by the generator."""
    rest = words.astype(np.int64)
    for bit in range(22, 10, -1):
        rest = np.where(rest >> bit & 1, rest ^ (_GENERATOR << (bit - 11)), rest)
    return rest


def _error_table() -> tuple[np.ndarray, np.ndarray]:
    """By syndrome: error patterns that lead to codewords within distance 4, the nearest first, and how many."""
    table, found = np.zeros((2048, 6), np.int64), np.zeros(2048, np.int64)
    for weight in range(5):
        patterns = np.array([sum(1 << b for b in bits) for bits in combinations(range(23), weight)], np.int64)
        for pattern, s in zip(patterns.tolist(), _syndromes(patterns).tolist()):
            table[s, found[s]] = pattern
            found[s] += 1
    return table, found


_ERRORS, _FOUND = _error_table()


def codewords(segment: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Indices (0 to 4095) of the codewords near each segment, and how many of the six columns count."""
    words = segment.astype(np.int64) << (23 - bits)
    s = _syndromes(words)
    return (words[:, None] ^ _ERRORS[s]) >> 11, _FOUND[s]


def bucket_keys(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) of all buckets of each fingerprint, without repeats."""
    unsigned = fps.astype(np.uint64)
    near = [codewords((unsigned >> np.uint64(shift)) & np.uint64((1 << bits) - 1), bits) for shift, bits in _SEGMENTS]
    rows, keys = [], []
    for pair, (i, j) in enumerate(combinations(range(3), 2)):
        (a, na), (b, nb) = near[i], near[j]
        for k in range(6):
            for of, left, right in ((np.flatnonzero(nb > k), a[:, 0], b[:, k]), (np.flatnonzero((na > k) & (k > 0)), a[:, k], b[:, 0])):
                rows.append(of)
                keys.append((pair << 24 | left << 12 | right)[of])
    return np.concatenate(rows), np.concatenate(keys)


def _forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that join the same nodes, one per node but the roots."""
    nodes, at = np.unique(np.concatenate((a, b)), return_inverse=True)
    left, right, label = at[:len(a)], at[len(a):], np.arange(len(nodes))
    while True:
        least = np.minimum(label[left], label[right])
        new = label.copy()
        np.minimum.at(new, left, least)
        np.minimum.at(new, right, least)
        np.minimum.at(new, label[left], least)
        np.minimum.at(new, label[right], least)
        new = new[new]
        if np.array_equal(new, label):
            break
        label = new
    rest = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[rest], nodes[label[rest]]


def _close(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    differ = (a ^ b).view(np.uint64)  # signed values would be counted without their sign
    return (np.bitwise_count(differ) <= MAX_BITS) & (differ != 0)


def _bucket_links(keys: np.ndarray, fps: np.ndarray):
    """Verified links of rows sorted by key: small buckets by row distance, large ones tile by tile."""
    begin = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    size = np.diff(np.append(begin, len(keys)))
    room = np.repeat(begin + size, size) - np.arange(len(keys))  # rows left in the bucket, this one included
    small = np.repeat(size <= 64, size)
    for step in range(1, 64):
        at = np.flatnonzero(small & (room > step))
        if not len(at):
            break
        at = at[_close(fps[at], fps[at + step])]
        yield fps[at], fps[at + step]
    for b, n in zip(begin[size > 64].tolist(), size[size > 64].tolist()):
        rows = fps[b:b + n]
        for i in range(0, n, 1024):
            for j in range(i, n, 1024):
                left, right = np.nonzero(_close(rows[i:i + 1024, None], rows[None, j:j + 1024]))
                if len(left):
                    yield _forest(rows[i + left], rows[j + right])


def _links(batches):
    """(a, b) fingerprints that link, as forests, from rows sorted by (bucket, part)."""
    held_a, held_b, held = [], [], 0
    keep: tuple[np.ndarray, np.ndarray] | None = None

    def out():
        a, b = _forest(np.concatenate(held_a), np.concatenate(held_b))
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    def take(keys, fps):
        nonlocal held
        for a, b in _bucket_links(keys, fps):
            if len(a):
                held_a.append(a)
                held_b.append(b)
                held += len(a)

    for batch in batches:
        keys, fps = batch.column("bucket").to_numpy(), batch.column("fp").to_numpy()
        part = batch.column("part").to_numpy()
        keys = keys << 32 | part
        if keep is not None:
            keys, fps = np.concatenate((keep[0], keys)), np.concatenate((keep[1], fps))
        if not len(keys):
            continue
        whole = int(np.searchsorted(keys, keys[-1]))  # the last bucket may go on
        take(keys[:whole], fps[:whole]) if whole else None
        keep = keys[whole:], fps[whole:]
        if held > 1 << 20:
            yield out()
            held_a, held_b, held = [], [], 0
    if keep is not None and len(keep[0]):
        take(*keep)
    if held:
        yield out()


def fingerprint_links(fps: DataFrame) -> DataFrame:
    """Links (a, b) between the distinct fingerprints of ``fps`` (column fp) that join all within MAX_BITS."""

    def deal(batches):
        for batch in batches:
            values = batch.column("fp").to_numpy()
            rows, keys = bucket_keys(values)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(values[rows], pa.int64())], names=["bucket", "fp"])

    dealt = fps.select("fp").mapInArrow(deal, "bucket long, fp long")
    hot = dealt.groupBy("bucket").count().where(F.col("count") > BUCKET_ROWS).select(
        "bucket", F.ceil(F.col("count") / (BUCKET_ROWS // 2)).cast("long").alias("n"))
    own = F.pmod(F.xxhash64("fp"), F.col("n"))
    # blocks i <= j of a large bucket meet in part i * n + j; the small ones have part 0
    part = F.when(F.col("n").isNull(), F.array(F.lit(0).cast("long"))).otherwise(
        F.transform(F.sequence(F.lit(0).cast("long"), F.col("n") - 1), lambda k: F.least(k, own) * F.col("n") + F.greatest(k, own)))
    parts = dealt.join(hot, "bucket", "left").select("bucket", "fp", F.explode(part).alias("part"))
    return parts.repartition("bucket", "part").sortWithinPartitions("bucket", "part").mapInArrow(_links, "a long, b long")


def grouped(docs: DataFrame, words: int = SHINGLE) -> DataFrame:
    """doc_id, fp (signed), root (a fingerprint of the component) and component_id of every row."""
    rows = cut_lineage(fingerprints(docs, words))
    nodes = cut_lineage(rows.groupBy("fp").agg(F.min("doc_id").alias("first")))
    roots = components(fingerprint_links(nodes))
    rooted = nodes.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    of = rooted.join(least, "root").select("fp", "root", "component_id")
    return rows.join(of, "fp").select("doc_id", "fp", "root", "component_id")


def near_duplicates(docs: DataFrame, words: int = SHINGLE) -> DataFrame:
    """doc_id, fp (signed) and component_id, the smallest doc_id reachable over links of MAX_BITS or fewer bits."""
    return grouped(docs, words).select("doc_id", "fp", "component_id")


def _fingerprinted(docs: DataFrame, words: int, name: str) -> DataFrame:
    """Whole rows with their fingerprint in column ``name``."""
    schema = docs.select("*", F.lit(0).cast("long").alias(name)).schema

    def run(batches):
        for batch in batches:
            values = [fingerprint(t.as_py(), words) for t in batch.column("text").cast(pa.large_binary())]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(values, pa.int64())], names=[*batch.schema.names, name])

    return docs.mapInArrow(run, schema)


def drop_near_duplicates(docs: DataFrame, words: int = SHINGLE) -> DataFrame:
    """One row of each component, in the columns of docs: that of the smallest doc_id (then of the least fingerprint).

    Rows of one doc_id with texts that are not near stay, each as its own
    component; of repeated rows one stays. A row with a null doc_id stays.
    """
    found = cut_lineage(grouped(docs.where("doc_id IS NOT NULL"), words))
    first = found.groupBy("root").agg(F.min(F.struct("doc_id", "fp")).alias("first")).select("first.*")
    ids = cut_lineage(found.groupBy(F.col("doc_id").alias("_id")).agg(
        (F.col("_id") == F.min("component_id")).alias("_first"), F.count("*").alias("_n")).where("NOT _first OR _n > 1"))
    kept = docs.join(ids, F.col("doc_id") == F.col("_id"), "left_anti")
    twice = ids.where("_n > 1")
    if twice.isEmpty():
        return kept
    name = "_fp" + "_" * max(map(len, docs.columns))
    rows = _fingerprinted(docs.join(twice, F.col("doc_id") == F.col("_id"), "left_semi"), words, name)
    rows = rows.join(first.toDF("_id", "_of"), (F.col("doc_id") == F.col("_id")) & (F.col(name) == F.col("_of")), "left_semi")
    order = [f.name for f in docs.schema.fields if "map<" not in f.dataType.simpleString()]
    at = Window.partitionBy("doc_id", name).orderBy(*(F.col(c) for c in order))
    again = rows.withColumn(name + "_", F.row_number().over(at)).where(F.col(name + "_") == 1)
    return kept.union(again.select(*docs.columns))
