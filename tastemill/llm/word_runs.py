"""Periodic runs of words by internal pattern matching.

A run is a stretch of consecutive words with smallest period q, of at least
``LEAST_WORDS`` words and ``LEAST_EXPONENT`` periods, that no neighbour extends.
A block of m words, m a power of two, starts at every multiple of m / 2. A run
whose period is above m / 2 and at most m (at most 4 for m = 4) holds a whole block
and its copy q words on: 4 q words are enough for both. No nearer copy exists, or
the run had a smaller period. So one question a block finds all runs: where is its
next occurrence within the window of m words behind its start? Occurrences of a
block are an interval of the suffix array, built by doubling of names over the
positions whose four words return in their text; a wavelet tree over it answers the
smallest occurrence beyond a position. Blocks that follow each other with one
distance are one progression, and its distance is a candidate period, extended to
both sides by prefix hashes and compared word by word. All steps work on whole
groups of texts as arrays, about log n array operations a level.

Null and empty texts have no words and no runs. Repeated rows have equal results, a
null doc_id is like any other. A text is one unit of work, however long: memory
follows the longest text. Texts need words and nothing else; no rows are exchanged.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .super_kmers import _squeeze as squeeze
from .words import _BASE, Words, _power, blocks, mix, spans_hash, text_buffer, windows

LEAST_WORDS = 6
LEAST_EXPONENT = 4
_BLOCK = 4  # words of the shortest blocks


class WaveletTree:
    """Values below 2 ** bits; answers the least value above x among values[low:high], for whole arrays of questions."""

    def __init__(self, values: np.ndarray):
        self.bits = len(values).bit_length()
        self.ones, self.zeros = [], []
        for bit in range(self.bits - 1, -1, -1):
            one = (values >> bit & 1).astype(bool)
            self.ones.append(np.concatenate(([0], np.cumsum(one, dtype=np.int64))))
            self.zeros.append(len(values) - int(self.ones[-1][-1]))
            values = np.concatenate((values[~one], values[one]))

    def successor(self, low: np.ndarray, high: np.ndarray, x: np.ndarray) -> np.ndarray:
        """Least value above x of each range, or -1."""
        left, right, above, less = low, high, x + 1, np.zeros(len(x), np.int64)
        for level, bit in enumerate(range(self.bits - 1, -1, -1)):
            one_l, one_r = self.ones[level][left], self.ones[level][right]
            zero_l, zero_r = left - one_l, right - one_r
            up = (above >> bit & 1).astype(bool)
            less += np.where(up, zero_r - zero_l, 0)
            left = np.where(up, self.zeros[level] + one_l, zero_l)
            right = np.where(up, self.zeros[level] + one_r, zero_r)
        some = np.flatnonzero(less < high - low)
        left, right, rank, value = low[some], high[some], less[some], np.zeros(len(some), np.int64)
        for level, bit in enumerate(range(self.bits - 1, -1, -1)):
            one_l, one_r = self.ones[level][left], self.ones[level][right]
            zero_l, zero_r = left - one_l, right - one_r
            zeros = zero_r - zero_l
            up = rank >= zeros
            rank = np.where(up, rank - zeros, rank)
            value |= up.astype(np.int64) << bit
            left = np.where(up, self.zeros[level] + one_l, zero_l)
            right = np.where(up, self.zeros[level] + one_r, zero_r)
        out = np.full(len(x), -1)
        out[some] = value
        return out


def _groups(sorted_keys: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """For each row of sorted keys: where its group begins, and the group's size."""
    new = np.ones(len(sorted_keys[0]), bool)
    new[1:] = False
    for keys in sorted_keys:
        new[1:] |= keys[1:] != keys[:-1]
    begin = np.flatnonzero(new)
    size = np.diff(np.append(begin, len(new)))
    return np.repeat(begin, size), np.repeat(size, size)


def _questions(hashes: np.ndarray, first: np.ndarray):
    """The suffix array over the returning positions, and the questions (block, length, low, high) about its intervals."""
    at = windows(first, _BLOCK)
    owner = np.repeat(np.arange(len(first) - 1), np.diff(first))
    key = mix(spans_hash(hashes, at, at + _BLOCK) + owner[at].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) if len(at) else np.zeros(0, np.uint64)
    order = np.argsort(key)
    _, size = _groups([key[order]]) if len(at) else (order, order)
    suffixes = at[order][size > 1]
    if not len(suffixes):
        return suffixes, []
    start, size = _groups([key[order][size > 1]])
    end = first[owner + 1]
    rank = -1 - np.arange(len(hashes))  # a name of its own for what does not return
    rank[suffixes] = start
    place, length, questions = np.arange(len(suffixes)), _BLOCK, []
    while True:
        offset = suffixes[place] - first[owner[suffixes[place]]]
        ask = np.flatnonzero(offset % (length // 2) == 0)
        questions.append((suffixes[place][ask], np.full(len(ask), length), start[ask], start[ask] + size[ask]))
        # names of twice the length: only groups of several positions can part
        here = suffixes[place]
        behind = np.minimum(here + length, len(hashes) - 1)
        second = np.where(here + 2 * length <= end[here], rank[behind], -1 - here)
        order = np.lexsort((second, start))
        here, second, old = here[order], second[order], start[order]
        begin, size = _groups([old, second])
        suffixes[place] = here
        start = place[begin]
        rank[here] = start
        more = size > 1
        place, start, size, length = place[more], start[more], size[more], 2 * length
        if not len(place):
            return suffixes, questions


def candidates(hashes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(position, period) of progressions of blocks."""
    suffixes, questions = _questions(hashes, first)
    if not questions:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    ordered = np.sort(suffixes)
    tree = WaveletTree(np.searchsorted(ordered, suffixes))
    places, periods = [], []
    for s, length, low, high in questions:
        found = tree.successor(low, high, np.searchsorted(ordered, s))
        distance = np.where(found >= 0, ordered[found], s + length + 1) - s
        near = np.flatnonzero(distance <= length)
        s, distance, step = s[near], distance[near], length[:1] // 2
        order = np.argsort(s)
        s, distance = s[order], distance[order]
        goes_on = np.zeros(len(s), bool)
        goes_on[1:] = (s[1:] - s[:-1] == step) & (distance[1:] == distance[:-1])
        places.append(s[~goes_on])
        periods.append(distance[~goes_on])
    return np.concatenate(places), np.concatenate(periods)


def _common(sums: np.ndarray, a: np.ndarray, d: np.ndarray, limit: np.ndarray, back: bool) -> np.ndarray:
    """Most words up to ``limit`` that agree behind (or before) a and a + d, by halving."""
    shift = _power(_BASE, int(d.max()) + 1)[d] if len(d) else np.zeros(0, np.uint64)
    low, high = np.zeros_like(limit), limit.copy()
    while (open_ := low < high).any():
        half = (low + high + 1) // 2
        s, e = (a - half, a) if back else (a, a + half)
        same = (sums[e] - sums[s]) * shift == sums[e + d] - sums[s + d]
        low = np.where(open_ & same, half, low)
        high = np.where(open_ & ~same, half - 1, high)
    return low


def _stretch(words: np.ndarray, at: int, period: int) -> tuple[int, int]:
    """The stretch of that period around a position of a text, word by word."""
    differ = np.flatnonzero(words[period:] != words[:-period])
    k = int(np.searchsorted(differ, at))
    return (int(differ[k - 1]) + 1 if k else 0), (int(differ[k]) if k < len(differ) else len(words) - period) + period


def word_runs(hashes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of all runs, by start and period; starts count from the first text's first word."""
    at, period = candidates(hashes, first)
    owner = np.searchsorted(first, at, side="right") - 1
    sums = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(hashes * _power(_BASE, len(hashes)), out=sums[1:])
    right = _common(sums, at, period, first[owner + 1] - at - period, False)
    left = _common(sums, at, period, at - first[owner], True)
    rows = np.stack((at - left, left + right + period, period), axis=1).reshape(-1, 3)
    _, one, which = np.unique(rows, axis=0, return_index=True, return_inverse=True)
    for k, row in enumerate(one.tolist()):
        s, n, q = rows[row].tolist()
        if not np.array_equal(hashes[s:s + n - q], hashes[s + q:s + n]):  # sums agreed by chance
            for c in np.flatnonzero(which.ravel() == k).tolist():
                base = int(first[owner[c]])
                low, high = _stretch(hashes[base:first[owner[c] + 1]], int(at[c]) - base, q)
                rows[c, :2] = base + low, high - low
    rows = np.unique(rows[rows[:, 1] >= np.maximum(LEAST_WORDS, LEAST_EXPONENT * rows[:, 2])], axis=0)
    order = np.lexsort((rows[:, 2], rows[:, 0]))
    return rows[order, 0], rows[order, 1], rows[order, 2]


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def collapse(texts: pa.Array) -> tuple[list[int], pa.Array, list[bytes]]:
    """Words, runs and kept words of each text: of a run only the first period stays."""
    words = Words(*text_buffer(texts))
    first = words.first.astype(np.int64)
    start, length, period = word_runs(words.hashes(), first)
    dropped = np.zeros(len(words.starts) + 1, np.int32)
    np.add.at(dropped, start + period, 1)
    np.add.at(dropped, start + length, -1)
    stays = np.cumsum(dropped[:-1]) == 0
    joined, starts = squeeze(words)
    data = joined.tobytes()
    at = np.searchsorted(start, first)
    kept = []
    for k in range(len(first) - 1):
        a, b = int(first[k]), int(first[k + 1])
        if at[k] == at[k + 1]:
            kept.append(data[starts[a]:starts[b] - 1] if a < b else b"")
            continue
        edges = np.flatnonzero(np.diff(np.concatenate(([0], stays[a:b].view(np.int8), [0])))) + a
        kept.append(b" ".join(data[starts[s]:starts[e] - 1] for s, e in zip(edges[::2].tolist(), edges[1::2].tolist())))
    begin = np.repeat(first[:-1], np.diff(at))
    cells = pa.StructArray.from_arrays([pa.array(start - begin), pa.array(length), pa.array(period)], fields=list(_RUN))
    return words.counts.tolist(), pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), cells), kept


def find_runs(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, runs (by start, then period) and kept (the words outside of repetitions, joined by one space) of every row."""

    def run(batches):
        for block in blocks(batches):
            n, runs, kept = collapse(block.column("text"))
            yield pa.RecordBatch.from_arrays([block.column("doc_id"), pa.array(n, pa.int64()), runs, pa.array(kept, pa.binary()).cast(pa.string())],
                                             names=["doc_id", "n_words", "runs", "kept"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, n_words long, runs array<struct<start: bigint, length: bigint, period: bigint>>, kept string")
