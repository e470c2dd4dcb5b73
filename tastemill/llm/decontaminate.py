"""Benchmark decontamination with suffix arrays.

A block of training texts is a shard: its words become ids of the benchmark's
vocabulary (0: no benchmark word), and the suffixes that could hold a whole
window (all words known) are sorted. Every benchmark window is located by
binary search, which gives all positions it occurs at, and with them the words hit
and the items. The benchmark has a suffix array of its own, to full depth: a hit
position is searched in its window's part of it, and the longer of the two
neighbours is the longest verbatim match there. A match that is the tail of one a
word earlier is left out. No pairs of positions are formed, so a word that fills
both a text and an item costs no more than other words. A text never leaves its
task, so nothing is shuffled. The benchmark is the stated query set: it is
broadcast in blocks of at most ``BLOCK`` bytes of text (measured first).

Nulls and texts without words have no windows and no hits. Items of fewer than
``window`` words are one window. Rows of one item_id are one item; a null
item_id is an item with the name "". Repeated documents are judged one by one.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .words import _BASE, ALNUM, LOWER, Words, _power, blocks, text_buffer, windows

WINDOW = 10
BLOCK = 16 << 20

SCHEMA = "n_words long, n_hit long, n_items long, items array<string>, longest_match long, matches array<struct<item:string,start:long,length:long>>"


@dataclass
class Windows:
    """Distinct windows of one length, sorted: key, part of the suffix array, items (of window k, items[first[k]:first[k + 1]])."""

    keys: np.ndarray
    low: np.ndarray
    high: np.ndarray
    first: np.ndarray
    items: np.ndarray


@dataclass
class Index:
    """Benchmark block: vocabulary and, by length, its distinct windows."""

    hashes: np.ndarray  # of the vocabulary, sorted
    text: np.ndarray
    starts: np.ndarray
    lengths: np.ndarray
    names: list[str]
    depth: int
    windows: dict[int, Windows]  # by words of a window
    words: np.ndarray  # ids of all items, a number of its own behind each text
    order: np.ndarray  # suffix array of ``words``
    item: np.ndarray  # item of each word
    sums: np.ndarray  # prefix sums of ``words``

    @property
    def dtype(self):
        return np.dtype(">u2") if len(self.hashes) < 0xFFFF else np.dtype(">u4")

    def ids(self, words: Words) -> np.ndarray:
        """Vocabulary id + 1 of each word, compared byte by byte; 0 for others."""
        if not len(self.hashes) or not len(words.starts):
            return np.zeros(len(words.starts), np.int64)
        hashes = words.hashes()
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        lengths = words.ends - words.starts
        known = np.flatnonzero((self.hashes[at] == hashes) & (self.lengths[at] == lengths))
        left, ids = known, np.zeros(len(at), np.int64)
        ids[known] = at[known] + 1
        byte = 0
        while len(left):
            differs = words.buf[words.starts[left] + byte] != self.text[self.starts[at[left]] + byte]
            ids[left[differs]] = 0
            byte += 1
            left = left[~differs & (lengths[left] > byte)]
        return ids

    def keys(self, ids: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
        """The n ids from each position as one byte string that sorts like the ids."""
        rows = np.ascontiguousarray(ids[at[:, None] + np.arange(n)].astype(self.dtype))
        return rows.view(f"S{n * self.dtype.itemsize}").ravel()


def suffix_order(values: np.ndarray) -> np.ndarray:
    """Suffix array by doubling; groups that are settled take no further part."""
    order = np.argsort(values, kind="stable")
    begin = np.flatnonzero(np.append(True, np.diff(values[order]) != 0)) if len(values) else np.zeros(0, np.int64)
    size = np.diff(np.append(begin, len(values)))
    rank = np.empty(len(values), np.int64)
    rank[order] = np.repeat(begin, size)
    place, length = np.flatnonzero(np.repeat(size, size) > 1), 1
    while len(place):
        here = order[place]
        behind = here + length
        second = np.where(behind < len(values), rank[np.minimum(behind, len(values) - 1)], -1)
        old = rank[here]
        by = np.lexsort((second, old))
        here, second, old = here[by], second[by], old[by]
        new = np.append(True, (old[1:] != old[:-1]) | (second[1:] != second[:-1]))
        begin = np.flatnonzero(new)
        size = np.diff(np.append(begin, len(here)))
        order[place] = here
        rank[here] = np.repeat(place[begin], size)
        place, length = place[np.repeat(size, size) > 1], 2 * length
    return order


def build_index(items: list[tuple[str, str]], window: int = WINDOW) -> Index:
    column = pa.array([text for _, text in items], pa.string())
    buf, offsets = text_buffer(column)
    words = Words(LOWER[buf], offsets, ALNUM)
    hashes, at = np.unique(words.hashes(), return_index=True)
    names = sorted({n for n, _ in items})
    place = {n: i for i, n in enumerate(names)}
    owner = np.array([place[n] for n, _ in items], np.int64)
    ids, counts = np.searchsorted(hashes, words.hashes()) + 1, words.counts
    # behind every text a number that is in no other place
    spread = np.full(len(ids) + len(items), 0, np.int64)
    spots = np.arange(len(ids)) + words.owners()
    spread[spots] = ids
    ends = words.first[1:] + np.arange(len(items))
    spread[ends] = len(hashes) + 1 + np.arange(len(items))
    order = suffix_order(spread)
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    item = np.repeat(owner, counts + 1)
    index = Index(hashes, words.buf, words.starts[at], (words.ends - words.starts)[at], names, window, {}, spread, order, item, _sums(spread))
    short = np.where((counts > 0) & (counts < window), counts, 0)
    for n in sorted({window} | set(short[short > 0].tolist())):
        of = counts >= window if n == window else short == n
        pieces = [np.arange(words.first[d], words.first[d + 1] - n + 1) for d in np.flatnonzero(of)]
        if not pieces:
            continue
        starts = np.concatenate(pieces)
        keys = index.keys(ids, starts, n)
        by = np.lexsort((rank[spots[starts]], keys))
        keys, starts = keys[by], spots[starts[by]]
        begin = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        which = np.repeat(np.arange(len(begin)), np.diff(np.append(begin, len(keys))))
        pairs = np.unique(np.stack((which, item[starts]), axis=1), axis=0)
        first = np.searchsorted(pairs[:, 0], np.arange(len(begin) + 1))
        low, high = np.minimum.reduceat(rank[starts], begin), np.maximum.reduceat(rank[starts], begin) + 1
        index.windows[n] = Windows(keys[begin], low, high, first, pairs[:, 1])
    return index


def locate(index: Index, words: Words, ids: np.ndarray) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """By length: (position, number of the window) of every occurrence of a window, positions ascending."""
    found = {}
    unknown = np.concatenate(([0], np.cumsum(ids == 0)))
    for n, table in index.windows.items():
        suffixes = windows(words.first, n)
        suffixes = suffixes[unknown[suffixes + n] == unknown[suffixes]]
        if not len(suffixes):
            continue
        sorted_keys = index.keys(ids, suffixes, n)
        order = np.argsort(sorted_keys, kind="stable")
        suffixes, sorted_keys = suffixes[order], sorted_keys[order]
        lo, hi = np.searchsorted(sorted_keys, table.keys, "left"), np.searchsorted(sorted_keys, table.keys, "right")
        hit = np.flatnonzero(hi > lo)
        if len(hit):
            spots = np.concatenate([suffixes[lo[k]:hi[k]] for k in hit])
            which = np.repeat(hit, (hi - lo)[hit])
            order = np.argsort(spots)
            found[n] = spots[order], which[order]
    return found


def _sums(values: np.ndarray) -> np.ndarray:
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values.astype(np.uint64) * _power(_BASE, len(values)), out=total[1:])
    return total


def _alike(index: Index, sums: np.ndarray, power: np.ndarray, position, limit, at) -> np.ndarray:
    """Words, up to ``limit``, that agree from a position of the texts and a word of the benchmark on, by halving over prefix sums."""
    low, high = np.zeros(len(position), np.int64), np.minimum(limit, len(index.words) - at)
    up, down = power[at], power[position]
    while (low < high).any():
        half = (low + high + 1) // 2
        same = (sums[position + half] - sums[position]) * up == (index.sums[at + half] - index.sums[at]) * down
        low, high = np.where(same, half, low), np.where(same, high, half - 1)
    return low


_STEP = 64


def _agreeing(index: Index, ids: np.ndarray, position, limit, at) -> np.ndarray:
    """The same count, word by word: no more than ``limit``."""
    same = np.zeros(len(position), np.int64)
    left = np.flatnonzero(limit > 0)
    ahead = np.arange(_STEP)
    while len(left):
        p, b = position[left] + same[left], at[left] + same[left]
        text = ids[np.minimum(p[:, None] + ahead, len(ids) - 1)]
        test = index.words[np.minimum(b[:, None] + ahead, len(index.words) - 1)]
        equal = (text == test) & (ahead < (limit[left] - same[left])[:, None])
        run = np.where(equal.all(axis=1), _STEP, np.argmin(equal, axis=1))
        same[left] += run
        left = left[run == _STEP]
    return same


_SLICE = 1 << 14  # positions searched at once


def longest(index: Index, words: Words, ids: np.ndarray, position: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(words, item) of the longest match that begins at each position, whose whole window is number ``which``.

    Prefix sums lead the search; the match found is compared word by word.
    """
    table, sums = index.windows[index.depth], _sums(ids)
    power = _power(_BASE, max(len(sums), len(index.sums)))
    out = []
    for begin in range(0, len(position), _SLICE):
        p, low = position[begin:begin + _SLICE], table.low[which[begin:begin + _SLICE]]
        high = table.high[which[begin:begin + _SLICE]]
        limit = words.first[np.searchsorted(words.first, p, side="right")] - p
        lo, hi = low.copy(), high.copy()
        while (open_ := np.flatnonzero(lo < hi)).size:
            mid = (lo[open_] + hi[open_]) // 2
            at, here, room = index.order[mid], p[open_], limit[open_]
            same = _alike(index, sums, power, here, room, at)
            mine = np.where(same < room, ids[np.minimum(here + same, len(ids) - 1)], -1)
            less = index.words[np.minimum(at + same, len(index.words) - 1)] < mine
            lo[open_] = np.where(less, mid + 1, lo[open_])
            hi[open_] = np.where(less, hi[open_], mid)
        best, at = np.zeros(len(p), np.int64), index.order[low]
        for beside in (lo - 1, lo):
            ok = np.flatnonzero((beside >= low) & (beside < high))
            of = index.order[beside[ok]]
            same = _alike(index, sums, power, p[ok], limit[ok], of)
            better = (same > best[ok]) | ((same == best[ok]) & (index.item[of] < index.item[at[ok]]))
            best[ok], at[ok] = np.where(better, same, best[ok]), np.where(better, of, at[ok])
        out.append((_agreeing(index, ids, p, best, at), index.item[at]))
    length, item = zip(*out)
    return np.concatenate(length), np.concatenate(item)


def _scan(index: Index, block: pa.RecordBatch) -> tuple[list[int], list[list[tuple[int, int]]], list[list[str]], list[list[dict]]]:
    """Of each text: its words, runs of hit words (start, length), items and matches."""
    buf, offsets = text_buffer(block.column("text"))
    words = Words(LOWER[buf], offsets, ALNUM)
    ids = index.ids(words)
    rows = block.num_rows
    hits: list[list] = [[] for _ in range(rows)]
    items: list[list] = [[] for _ in range(rows)]
    matches: list[list] = [[] for _ in range(rows)]
    edge, pairs = np.zeros(len(words.starts) + 1, np.int64), []
    for n, (position, which) in locate(index, words, ids).items():
        table = index.windows[n]
        np.add.at(edge, position, 1)
        np.add.at(edge, position + n, -1)
        text = np.searchsorted(words.first, position, side="right") - 1
        seen = np.unique(np.stack((text, which), axis=1), axis=0)
        count = table.first[seen[:, 1] + 1] - table.first[seen[:, 1]]
        of = np.arange(count.sum()) + np.repeat(table.first[seen[:, 1]] - np.cumsum(count) + count, count)
        pairs.append(np.stack((np.repeat(seen[:, 0], count), table.items[of]), axis=1))
        if n == index.depth:
            length, item = longest(index, words, ids, position, which)
            tail = np.zeros(len(position), bool)  # of the match that begins a word earlier
            tail[1:] = (position[1:] == position[:-1] + 1) & (text[1:] == text[:-1]) & (length[:-1] > length[1:])
        else:
            length, item, tail = np.full(len(position), n), table.items[table.first[which]], np.zeros(len(position), bool)
        for d, i, p, m in zip(*(x[~tail].tolist() for x in (text, item, position - words.first[text], length))):
            matches[d].append({"item": index.names[i], "start": p, "length": m})
    if pairs:
        for d, i in np.unique(np.concatenate(pairs), axis=0).tolist():
            items[d].append(index.names[i])
    # runs of hit words: a new text starts a new run
    covered = np.cumsum(edge[:-1]) > 0
    starts = covered.copy()
    starts[1:] &= ~covered[:-1]
    heads = words.first[:-1][words.counts > 0]
    starts[heads] = covered[heads]
    begin = np.flatnonzero(starts)
    stop = np.searchsorted(begin, np.arange(len(covered)), side="right")
    size = np.bincount(stop[covered], minlength=len(begin) + 1)[1:] if len(begin) else begin
    text = np.searchsorted(words.first, begin, side="right") - 1
    for d, p, m in zip(text.tolist(), (begin - words.first[text]).tolist(), size.tolist()):
        hits[d].append((p, m))
    return words.counts.tolist(), hits, [sorted(x) for x in items], [sorted(x, key=lambda m: (m["start"], m["length"], m["item"])) for x in matches]


def _index_blocks(benchmark: DataFrame, window: int):
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), "text")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, math.ceil(size / BLOCK))
    for k in range(n):
        part = items.where(F.pmod(F.xxhash64("item"), F.lit(n)) == k)
        yield k == n - 1, build_index([(r[0], r[1]) for r in part.collect()], window)


_HITS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))
_MATCHES = pa.list_(pa.struct([("item", pa.string()), ("start", pa.int64()), ("length", pa.int64())]))
_NAMES = ["doc_id", "n_words", "n_hit", "n_items", "items", "longest_match", "matches"]
_STATE = ("n_words long, hits array<struct<start:long,length:long>>, items array<string>, matches array<struct<item:string,start:long,length:long>>")


def _finished(ids: pa.Array, n_words: list[int], hits, items, matches) -> pa.RecordBatch:
    """Columns of SCHEMA from what all blocks of the benchmark found."""
    n_hit = []
    for runs in hits:
        end, total = 0, 0
        for start, n in sorted(runs):
            total += max(0, start + n - max(start, end))
            end = max(end, start + n)
        n_hit.append(total)
    longest_match = [max((m["length"] for m in x), default=0) for x in matches]
    columns = [pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64()), pa.array([len(x) for x in items], pa.int64()),
               pa.array(items, pa.list_(pa.string())), pa.array(longest_match, pa.int64()), pa.array(matches, _MATCHES)]
    return pa.RecordBatch.from_arrays([ids, *columns], names=_NAMES)


def find_matches(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id and the columns of SCHEMA for every row of docs."""
    spark = docs.sparkSession
    state = docs.select(F.col("doc_id").cast("long"), "text")
    several = False
    for last, index in _index_blocks(benchmark, window):
        shared = spark.sparkContext.broadcast(index)

        def scan(batches, shared=shared, several=several, last=last):
            for block in blocks(batches):
                n_words, hits, items, matches = _scan(shared.value, block)
                if several:  # what earlier blocks of the benchmark found
                    hits = [[(h["start"], h["length"]) for h in a] + b for a, b in zip(block.column("hits").to_pylist(), hits)]
                    items = [sorted({*a, *b}) for a, b in zip(block.column("items").to_pylist(), items)]
                    matches = [a + b for a, b in zip(block.column("matches").to_pylist(), matches)]
                if last:
                    yield _finished(block.column("doc_id"), n_words, hits, items, matches)
                    continue
                runs = pa.array([[{"start": p, "length": n} for p, n in x] for x in hits], _HITS)
                yield pa.RecordBatch.from_arrays(
                    [block.column("doc_id"), block.column("text"), pa.array(n_words, pa.int64()), runs, pa.array(items, pa.list_(pa.string())), pa.array(matches, _MATCHES)],
                    names=["doc_id", "text", "n_words", "hits", "items", "matches"])

        if last:
            return state.mapInArrow(scan, "doc_id long, " + SCHEMA)
        state = cut_lineage(state.mapInArrow(scan, "doc_id long, text string, " + _STATE))
        several = True


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of docs without any benchmark window, in the columns of docs."""
    kept, schema = docs, docs.schema
    for last, index in _index_blocks(benchmark, window):
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def clean(batches, shared=shared):
            for block in blocks(batches):
                yield block.filter(pa.array([not runs for runs in _scan(shared.value, block)[1]], pa.bool_()))

        kept = kept.mapInArrow(clean, schema)
        if not last:
            kept = cut_lineage(kept)
    return kept
