"""Words of whole Arrow text columns as NumPy arrays: bounds, owners and 64-bit hashes, without Python strings."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 2 << 20  # text bytes handled at once; one longer text is a block of its own
CHUNK = 1 << 20  # values hashed at once

# Kinds of bytes: 0 separates words, and a word is a run of one other kind.
SPACED = np.ones(256, np.uint8)
SPACED[[0x20, *range(0x09, 0x0E)]] = 0
ALNUM = np.zeros(256, np.uint8)
ALNUM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = 1
RUNS = SPACED * (2 - ALNUM)  # letters and digits, or signs
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20

_BASE, _INVERSE = np.uint64(0x9E3779B97F4A7C15), np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_BYTES = np.random.default_rng(20240607).integers(1, 1 << 63, 256, dtype=np.uint64)
_powers: dict[int, np.ndarray] = {}


def _power(base: np.uint64, n: int) -> np.ndarray:
    """base ** i mod 2**64 for i < n; kept up to the usual block size only."""
    have = _powers.get(int(base))
    if have is None or len(have) < n:
        have = np.full(max(n, 1), base, np.uint64)
        have[0] = 1
        np.multiply.accumulate(have, out=have)
        if n <= 2 * CHUNK:
            _powers[int(base)] = have
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads the bits of 64-bit values."""
    x = x.copy()
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def spans_hash(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, table: np.ndarray | None = None) -> np.ndarray:
    """Position-free hash of values[start:end] for each span, starts ascending; equal spans have equal hashes.

    ``table`` maps the values first. Works on slices of about CHUNK values, so
    that the memory needed does not follow the length of ``values``.
    """
    out, at = np.empty(len(starts), np.uint64), 0
    while at < len(starts):
        low = int(starts[at])
        to = max(at + 1, int(np.searchsorted(starts, low + CHUNK)))
        high = int(ends[at:to].max())
        part = values[low:high] if table is None else table[values[low:high]]
        total = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(part * _power(_BASE, len(part)), out=total[1:])
        s, e = starts[at:to] - low, ends[at:to] - low
        out[at:to] = mix((total[e] - total[s]) * _power(_INVERSE, len(part) + 1)[s] + (e - s).astype(np.uint64))
        at = to
    return out


class Words:
    """Words of several texts: ``buf[starts[i]:ends[i]]`` is word i; text d has words first[d] to first[d + 1]."""

    def __init__(self, buf: np.ndarray, offsets: np.ndarray, kinds: np.ndarray = SPACED):
        self.buf, self.offsets = buf, offsets
        kind = kinds[buf]
        opens, closes = kind > 0, kind > 0
        changes = kind[1:] != kind[:-1]
        cuts = offsets[(offsets > 0) & (offsets < len(buf))]  # a new text starts a new word
        changes[cuts - 1] = True
        opens[1:] &= changes
        closes[:-1] &= changes
        self.starts, self.ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
        self.first = np.searchsorted(self.starts, offsets)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def hashes(self) -> np.ndarray:
        return spans_hash(self.buf, self.starts, self.ends, _BYTES)

    def owners(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.offsets) - 1), self.counts)


def windows(first: np.ndarray, n: int) -> np.ndarray:
    """Index of the first word of every window of n words inside one text."""
    counts = np.maximum(np.diff(first) - n + 1, 0)
    base = np.repeat(first[:-1] - np.concatenate(([0], np.cumsum(counts)[:-1])), counts)
    return base + np.arange(counts.sum())


def text_buffer(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and offsets of a string column; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    buf = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return buf[offsets[0]:offsets[-1]], offsets - offsets[0]


def blocks(batches: Iterator[pa.RecordBatch], limit: int = BLOCK_BYTES, column: str = "text") -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches into runs of rows with at most ``limit`` text bytes (or one row)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = text_buffer(batch.column(column))[1][1:]
        at = 0
        while at < batch.num_rows:
            used = size[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(size, used + limit, side="right")))
            yield batch.slice(at, to - at)
            at = to

