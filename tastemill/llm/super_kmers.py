"""Exact repeated word windows by super-k-mer partitioning.

A window of 13 words belongs to the bucket of its minimiser, the 3-word gram
with the least hash. Consecutive windows with one minimiser travel as one packed
string. A task packs its share by bucket: the distinct strings with the smallest
doc_id of each, and, behind them, where they occur. A bucket reads all its strings
first, sorts their windows and so knows the smallest doc_id of every window; then
the occurrences stream past and the covered word ranges leave. What a bucket holds
are distinct strings, so a passage that a third of all documents share costs one
string per task, not one per document. Buckets are weighed first, by the distinct
strings that the tasks would send: one beyond ``HEAVY_BYTES`` (a phrase that recurs
every few words with other words around it) is dealt out window by window, by the
hash of the whole window, so that equal windows still meet.

Windows that one smaller doc_id shares cover their words; words of a document
covered so are removed. Null and empty texts have no words; texts of fewer than
13 words have no window. A row with a null doc_id is neither earlier nor later
than others and keeps all its words. Rows of one doc_id are copies of one
document: ranges found in one of them hold for all.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .words import Words, blocks, mix, spans_hash, text_buffer, windows

WINDOW = 13
MINIMISER = 3
BUCKET_BYTES = 4 << 20  # text bytes per bucket, in the mean
FLUSH_BYTES = 8 << 20  # text bytes that a task packs at once
HEAVY_BYTES = 32 << 20  # text bytes beyond which a bucket is dealt out by windows

_PACKED = "bucket long, kind int, uid long, payload binary"


def _pack(*arrays: np.ndarray) -> bytes:
    sizes = np.array([a.nbytes for a in arrays], np.int64)
    return zstandard.ZstdCompressor(level=3).compress(b"".join([np.int64(len(arrays)).tobytes(), sizes.tobytes(), *(a.tobytes() for a in arrays)]))


def _unpack(payload: bytes, *dtypes) -> list[np.ndarray]:
    data = zstandard.ZstdDecompressor().decompress(payload)
    n = int(np.frombuffer(data, np.int64, 1)[0])
    ends = 8 * (n + 1) + np.cumsum(np.frombuffer(data, np.int64, n, 8))
    starts = np.append(8 * (n + 1), ends[:-1])
    return [np.frombuffer(data[s:e], t) for s, e, t in zip(starts, ends, dtypes)]


def sliding_argmin(values: np.ndarray, at: np.ndarray, width: int) -> np.ndarray:
    """Position of the least of values[i:i + width] for each i of ``at``; the leftmost of equals."""
    best, place = values[at], at.copy()
    for step in range(1, width):
        new = values[at + step]
        less = new < best
        best = np.where(less, new, best)
        place[less] = at[less] + step
    return place


def super_kmers(words: Words, window: int = WINDOW, width: int = MINIMISER) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(minimiser hash, first word, number of windows) of each run of windows with one minimiser."""
    hashes = words.hashes()
    at = windows(words.first, window)
    if not len(at):
        none = np.zeros(0, np.int64)
        return none.astype(np.uint64), none, none
    grams = np.full(len(hashes), np.uint64(2**64 - 1))
    starts = np.arange(len(hashes) - width + 1)
    grams[:len(starts)] = spans_hash(hashes, starts, starts + width)
    place = sliding_argmin(grams, at, window - width + 1)
    new = np.append(True, (place[1:] != place[:-1]) | (at[1:] != at[:-1] + 1))
    first = np.flatnonzero(new)
    return grams[place[first]], at[first], np.diff(np.append(first, len(at)))


def _squeeze(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """All words joined by one space, and where each starts in it."""
    lengths = words.ends - words.starts
    starts = np.concatenate(([0], np.cumsum(lengths + 1)))
    out = np.full(starts[-1], 0x20, np.uint8)
    shift = np.repeat(starts[:-1] - words.starts, lengths)
    source = np.arange(len(shift)) + np.repeat(words.starts - np.concatenate(([0], np.cumsum(lengths)[:-1])), lengths)
    out[source + shift] = words.buf[source]
    return out, starts


def _buckets(minimiser: np.ndarray, n_buckets: int) -> np.ndarray:
    return (mix(minimiser) % np.uint64(n_buckets)).astype(np.int64)


def _weigh(n_buckets: int, window: int):
    """Bytes of the distinct strings of each block of texts, by bucket."""

    def run(batches):
        total = np.zeros(0, np.int64)
        keys = np.zeros(0, np.int64)
        for block in blocks(batches):
            words = Words(*text_buffer(block.column("text")))
            minimiser, first, n = super_kmers(words, window)
            if not len(first):
                continue
            last = first + n + window - 1
            _, one = np.unique(spans_hash(words.hashes(), first, last), return_index=True)
            bucket, size = _buckets(minimiser[one], n_buckets), words.ends[last[one] - 1] - words.starts[first[one]]
            keys, at = np.unique(np.concatenate((keys, bucket)), return_inverse=True)
            total = np.bincount(at, np.concatenate((total, size)), len(keys)).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(total)], names=["bucket", "bytes"])

    return run


def heavy_buckets(texts: DataFrame, n_buckets: int, size: int, window: int) -> dict[int, int]:
    """Buckets over HEAVY_BYTES, and into how many parts each goes."""
    if size <= HEAVY_BYTES:
        return {}
    weighed = texts.select("text").mapInArrow(_weigh(n_buckets, window), "bucket long, bytes long")
    heavy = weighed.groupBy("bucket").agg(F.sum("bytes").alias("bytes")).where(F.col("bytes") > HEAVY_BYTES)
    # a window of w words is w times as long as what it adds to a string
    return {r["bucket"]: math.ceil(r["bytes"] * window / HEAVY_BYTES) for r in heavy.collect()}


def _emit(n_buckets: int, window: int, heavy: dict[int, int]):
    dealt = np.array(sorted(heavy), np.int64)
    parts = np.array([heavy[b] for b in sorted(heavy)], np.int64)
    base = n_buckets + np.cumsum(parts) - parts  # the parts are buckets behind the others

    def by_windows(words: Words, bucket, first, n):
        """Strings of heavy buckets, one for each window."""
        hot = np.isin(bucket, dealt)
        if not hot.any():
            return bucket, first, n
        count = n[hot]
        at = np.arange(count.sum()) + np.repeat(first[hot] - np.cumsum(count) + count, count)
        k = np.repeat(np.searchsorted(dealt, bucket[hot]), count)
        value = spans_hash(words.hashes(), at, at + window)
        part = base[k] + (value % parts[k].astype(np.uint64)).astype(np.int64)
        return np.concatenate((bucket[~hot], part)), np.concatenate((first[~hot], at)), np.concatenate((n[~hot], np.ones(len(at), n.dtype)))

    def flush(held: dict, uid: int):
        """Rows of what was gathered: bucket -> [(strings, docs, positions)]."""
        for bucket, parts in held.items():
            index: dict[bytes, int] = {}
            least: list[int] = []
            which, docs, places = [], [], []
            for string, doc, place in parts:
                k = index.setdefault(string, len(index))
                if k == len(least):
                    least.append(doc)
                elif doc < least[k]:
                    least[k] = doc
                which.append(k)
                docs.append(doc)
                places.append(place)
            data = b"\n".join(index)
            yield bucket, 0, uid, _pack(np.array(least, np.int64), np.frombuffer(data, np.uint8))
            yield bucket, 1, uid, _pack(np.array(which, np.int32), np.diff(np.array(docs, np.int64), prepend=0), np.array(places, np.int32))

    def batch_of(rows):
        bucket, kind, uid, payload = zip(*rows)
        return pa.RecordBatch.from_arrays([pa.array(bucket, pa.int64()), pa.array(kind, pa.int32()), pa.array(uid, pa.int64()), pa.array(payload, pa.binary())],
                                          names=["bucket", "kind", "uid", "payload"])

    def run(batches):
        uid, held, size = TaskContext.get().partitionId() << 32, {}, 0
        for block in blocks(batches):
            ids = block.column("doc_id").to_numpy(zero_copy_only=False)
            buf, offsets = text_buffer(block.column("text"))
            words = Words(buf, offsets)
            minimiser, first, n = super_kmers(words, window)
            if len(first):
                joined, starts = _squeeze(words)
                data = joined.tobytes()
                bucket, first, n = by_windows(words, _buckets(minimiser, n_buckets), first, n)
                owner = np.searchsorted(words.first, first, side="right") - 1
                order = np.argsort(bucket, kind="stable")
                columns = (bucket, ids[owner], first - words.first[owner], starts[first], starts[first + n + window - 1] - 1)
                for b, doc, place, s, e in zip(*(c[order].tolist() for c in columns)):
                    held.setdefault(b, []).append((data[s:e], doc, place))
            size += len(buf)
            if size >= FLUSH_BYTES:
                yield batch_of(flush(held, uid))
                uid, held, size = uid + 1, {}, 0
        if held:
            yield batch_of(flush(held, uid))

    return run


def _window_ids(words: Words, at: np.ndarray, window: int) -> np.ndarray:
    """Equal numbers for windows of equal words: hashes are sorted, equal ones compared byte by byte."""
    value = spans_hash(words.hashes(), at, at + window)
    order = np.argsort(value, kind="stable")
    value = value[order]
    same = np.append(False, value[1:] == value[:-1])
    starts, ends = words.starts[at[order]], words.ends[at[order] + window - 1]
    data = words.buf.tobytes()
    twice, differ = np.flatnonzero(same), []
    for part in np.array_split(twice, len(twice) // 65536 + 1):
        spans = (x.tolist() for x in (part, starts[part], ends[part], starts[part - 1], ends[part - 1]))
        differ += [k for k, s, e, t, f in zip(*spans) if data[s:e] != data[t:f]]
    ids = np.empty(len(at), np.int64)
    ids[order] = np.cumsum(~same)
    if differ:  # hashes met by chance: number the windows of these hashes by their words
        groups = np.unique(np.cumsum(~same)[differ])
        names: dict[bytes, int] = {}
        for k in np.flatnonzero(np.isin(ids, groups)).tolist():
            s, e = words.starts[at[k]], words.ends[at[k] + window - 1]
            ids[k] = names.setdefault(data[s:e], len(at) + 1 + len(names))
    return ids


class _Bucket:
    """Distinct strings of a bucket; after close(), the least doc_id of every window."""

    def __init__(self, window: int):
        self.window, self.index, self.least, self.local = window, {}, [], {}

    def add(self, uid: int, payload: bytes) -> None:
        least, data = _unpack(payload, np.int64, np.uint8)
        numbers = []
        for string, doc in zip(data.tobytes().split(b"\n"), least.tolist()):
            k = self.index.setdefault(string, len(self.index))
            numbers.append(k)
            if k == len(self.least):
                self.least.append(doc)
            elif doc < self.least[k]:
                self.least[k] = doc
        self.local[uid] = np.array(numbers, np.int64)

    def close(self) -> None:
        column = pa.array(list(self.index), pa.large_binary())
        self.index = {}
        words = Words(*text_buffer(column))
        at = windows(words.first, self.window)
        self.count = np.diff(words.first) - self.window + 1
        self.begin = np.concatenate(([0], np.cumsum(self.count)[:-1]))
        ids = _window_ids(words, at, self.window)
        _, ids = np.unique(ids, return_inverse=True)
        docs = np.repeat(np.array(self.least, np.int64), self.count)
        first = np.full(ids.max() + 1, np.iinfo(np.int64).max)
        np.minimum.at(first, ids, docs)
        self.first = first[ids]
        self.string_first = np.minimum.reduceat(self.first, self.begin)

    def ranges(self, uid: int, payload: bytes):
        """(doc_id, first word, end) of the words covered in the occurrences of a task."""
        which, docs, places = _unpack(payload, np.int32, np.int64, np.int32)
        strings, docs = self.local[uid][which], np.cumsum(docs)
        some = np.flatnonzero(docs > self.string_first[strings])
        strings, docs, places = strings[some], docs[some], places[some]
        n = self.count[strings]
        step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        docs, at = np.repeat(docs, n), np.repeat(places, n) + step
        hit = docs > self.first[np.repeat(self.begin[strings], n) + step]
        docs, at = docs[hit], at[hit]
        if not len(docs):
            return docs, at, at
        begin = np.flatnonzero(np.append(True, (docs[1:] != docs[:-1]) | (at[1:] != at[:-1] + 1)))
        last = np.append(begin[1:], len(docs)) - 1
        return docs[begin], at[begin], at[last] + self.window


def _count(window: int):
    def run(batches):
        bucket, current, closed = None, -1, False
        for batch in batches:
            for b, kind, uid, cell in zip(*(batch.column(k).to_pylist() for k in range(3)), batch.column(3)):
                payload = cell.as_buffer()
                if b != current:
                    bucket, current, closed = _Bucket(window), b, False
                if kind == 0:
                    bucket.add(uid, payload)
                    continue
                if not closed:
                    bucket.close()
                    closed = True
                docs, starts, ends = bucket.ranges(uid, payload)
                if len(docs):
                    yield pa.RecordBatch.from_arrays([pa.array(docs), pa.array(starts.astype(np.int32)), pa.array(ends.astype(np.int32))], names=["doc", "start", "end"])

    return run


def covered_ranges(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc, ranges) of documents with words covered by a window that starts in a smaller doc_id."""
    texts = docs.where("doc_id IS NOT NULL").select(F.col("doc_id").cast("long"), "text")
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, math.ceil(size / BUCKET_BYTES))
    packed = texts.mapInArrow(_emit(n, window, heavy_buckets(texts, n, size, window)), _PACKED)
    found = packed.repartition("bucket").sortWithinPartitions("bucket", "kind", "uid").mapInArrow(_count(window), "doc long, start int, end int")
    return found.groupBy("doc").agg(F.collect_list(F.struct("start", "end")).alias("ranges"))


def _keep(batches):
    """n_words, n_removed and the kept words of each text."""
    for batch in batches:
        total, removed, kept = [], [], []
        for text, ranges in zip(batch.column("text").to_pylist(), batch.column("ranges")):
            words = (text or "").encode().split()
            mask = np.zeros(len(words) + 1, np.int32)
            if ranges.is_valid:
                pairs = ranges.values
                np.add.at(mask, np.minimum(pairs.field(0).to_numpy(), len(words)), 1)
                np.add.at(mask, np.minimum(pairs.field(1).to_numpy(), len(words)), -1)
            stay = np.cumsum(mask[:-1]) == 0
            total.append(len(words))
            removed.append(int(len(words) - stay.sum()))
            kept.append(b" ".join(words if not removed[-1] else [words[k] for k in np.flatnonzero(stay).tolist()]))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(total, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string()),
                                          pa.array([hashlib.sha256(k).hexdigest() for k in kept])], names=["doc_id", "n_words", "n_removed", "kept", "kept_sha256"])


def remove_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_removed, kept (the words that stay, joined by one space) and kept_sha256 of every row."""
    texts = docs.select(F.col("doc_id").cast("long"), "text")
    joined = texts.join(covered_ranges(docs, window), F.col("doc_id") == F.col("doc"), "left").select("doc_id", "text", "ranges")
    return joined.mapInArrow(_keep, "doc_id long, n_words long, n_removed long, kept string, kept_sha256 string")
