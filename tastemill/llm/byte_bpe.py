"""Byte-level BPE encoding and decoding of whole texts with a hierarchical-bitmap rank queue.

Pairs wait in one bucket per merge rank; a bucket holds positions of a linked
list of parts, taken from the left. A three-level bitmap marks the ranks in use: find-first-set of
each level gives the least rank in three steps, whatever the length of the
pre-token. Positions whose pair has changed are stale and are skipped when
they come up. A pre-token of n bytes costs O(n) queue operations, so very long
ones need no special case. The new pre-tokens of a group of texts share one
queue, with one linked list each; short ones are remembered.

Null and empty texts have no ids and decode to nothing.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

REMEMBERED = 150_000  # pre-tokens kept per generation; a worker keeps one generation between tasks
LEARNT = 500_000  # pairs whose rank, or lack of one, is kept
REMEMBERED_CHARS = 48  # of at most so many characters
GROUP_CHARS = 4 << 20  # texts looked up together
MERGE_BYTES = 256 << 10  # bytes of new pre-tokens in one queue; a longer pre-token has its own


class Merges:
    """Merges the bytes of pre-tokens by rank.

    ``single`` gives the id of each byte, ``rank_of`` the rank of a pair of ids
    or -1, ``merged[rank]`` the new id.
    """

    def __init__(self, ranks: int, single: list[int], rank_of, merged):
        self.single, self.rank_of, self.merged = np.array(single, np.int64), rank_of, merged
        self.first = np.array([[rank_of(a, b) for b in single] for a in single], np.int32)
        self.base = {single[a] << 20 | single[b]: int(self.first[a, b]) for a, b in np.argwhere(self.first >= 0).tolist()}
        self.pairs = dict(self.base)
        # the lower levels of the bitmap: 64 ranks, and 64 words of those, to a word; a merge leaves them empty
        self.low, self.mid = [0] * (ranks // 64 + 1), [0] * (ranks // 4096 + 1)

    def forget(self) -> None:
        """Drop learnt pairs; between merges only, since waiting positions are checked against them."""
        self.pairs = dict(self.base)

    def _learn(self, pair: int) -> int:
        rank = self.pairs[pair] = self.rank_of(pair >> 20, pair & 0xFFFFF)
        return rank

    def merge(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words, none of them empty, one after the other, and the end of each word among them.

        All words share one queue. Their lists are not linked to each other, so
        within each the least rank goes first, the leftmost of equals, until no
        pair has a rank.
        """
        if len(self.pairs) > LEARNT:
            self.forget()
        raw = np.frombuffer(b"".join(words), np.uint8)
        n, ends = len(raw), np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))
        after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
        after[ends - 1], before[ends[:-1]] = n, -1
        after, before, ids = after.tolist(), before.tolist(), self.single[raw].tolist()
        low, mid, top, get, learn = self.low, self.mid, 0, self.pairs.get, self._learn

        first = self.first[raw[:-1], raw[1:]]
        first[ends[:-1] - 1] = -1
        order = np.argsort(first, kind="stable")[np.count_nonzero(first < 0):]
        used, begin = np.unique(first[order], return_index=True)
        order, begin = order.tolist(), [*begin.tolist(), len(order)]
        buckets: dict[int, list[int]] = {}
        for k, rank in enumerate(used.tolist()):
            buckets[rank] = order[begin[k]:begin[k + 1]]
            low[rank >> 6] |= 1 << (rank & 63)
            mid[rank >> 12] |= 1 << (rank >> 6 & 63)
            top |= 1 << (rank >> 12)
        while top:
            b = (top & -top).bit_length() - 1  # find-first-set, level by level
            word = mid[b]
            a = b << 6 | (word & -word).bit_length() - 1
            word = low[a]
            rank = a << 6 | (word & -word).bit_length() - 1
            bucket = buckets.pop(rank)
            low[a] = word = word & word - 1
            if not word:
                mid[b] = word = mid[b] & mid[b] - 1
                if not word:
                    top &= top - 1
            if len(bucket) > 1:
                bucket.sort()
            # a merged part is longer than its halves, so no new pair has this rank, and all positions can be taken at once
            new, token = [], self.merged[rank]
            for at in bucket:
                right = after[at]
                if ids[at] < 0 or right >= n or get(ids[at] << 20 | ids[right]) != rank:
                    continue  # stale: a part is gone or the pair is another one
                ids[at], ids[right] = token, -1
                beyond = after[at] = after[right]
                if beyond < n:
                    before[beyond] = at
                    new.append((at, token << 20 | ids[beyond]))
                left = before[at]
                if left >= 0:
                    new.append((left, ids[left] << 20 | token))
            for at, pair in new:  # push
                rank = get(pair)
                if rank is None:
                    rank = learn(pair)
                if rank < 0:
                    continue
                if rank in buckets:
                    buckets[rank].append(at)
                    continue
                buckets[rank] = [at]
                a, b = rank >> 6, rank >> 12
                low[a] |= 1 << (rank & 63)
                mid[b] |= 1 << (a & 63)
                top |= 1 << b
        ids = np.array(ids, np.int64)
        left = ids >= 0
        return ids[left], np.cumsum(left)[ends - 1]

    def results(self, tokens: list[str], result) -> list:
        """``result(ids, ends)`` of all tokens, a list, by queues of about MERGE_BYTES."""
        out, words, size = [], [], 0
        for token in tokens:
            words.append(token.encode())
            size += len(words[-1])
            if size >= MERGE_BYTES:
                out += result(*self.merge(words))
                words, size = [], 0
        return out + result(*self.merge(words)) if words else out


class Remembered:
    """Results by pre-token in two generations, so that frequent ones stay: a full one replaces the older."""

    def __init__(self, pattern: str, work):
        self.pattern, self.work = regex.compile(pattern), work
        self.now: dict = {}
        self.older: dict = {}

    def _pieces(self, text: str):
        """Pre-tokens in lists; long texts are cut between pre-tokens, as they are found."""
        if len(text) <= GROUP_CHARS:
            yield self.pattern.findall(text)
            return
        found = (m.group() for m in self.pattern.finditer(text))
        while piece := list(islice(found, GROUP_CHARS // 16)):
            yield piece

    def look_up(self, texts) -> Iterator[tuple[bool, Iterator]]:
        """For each text, in pieces: whether this is its last piece, and the results of the pre-tokens there."""
        held, size = [], 0
        for text in texts:
            for piece in self._pieces(text):
                held.append((False, piece))
                size += len(piece)
                if size >= GROUP_CHARS // 16:
                    yield from self._answer(held)
                    held, size = [], 0
            held.append((True, []))
        yield from self._answer(held)

    def rest(self) -> None:
        """At the end of a task: leave memory to the other stages that this worker runs."""
        self.older = {}

    def _answer(self, held):
        if len(self.now) >= REMEMBERED:
            self.older, self.now = self.now, {}
        new = set().union(*(piece for _, piece in held)).difference(self.now)
        again = new.intersection(self.older)
        self.now.update((t, self.older[t]) for t in again)
        new = list(new - again)
        self.now.update(zip(new, self.work(new)))
        for last, piece in held:
            yield last, map(self.now.__getitem__, piece)
        for token in new:
            if len(token) > REMEMBERED_CHARS:
                del self.now[token]


class Encoder:
    """Texts to ids and back."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        of, size = self.bytes_of, max(ranks.values()) + 1
        self.ranks = ranks
        self.merges = Merges(size, [ranks[bytes([b])] for b in range(256)], lambda a, b: ranks.get(of[a] + of[b], -1), range(size))
        self.memory = Remembered(pattern, self._packed)

    def _packed(self, tokens: list[str]) -> list[bytes]:
        """Packed ids of each pre-token: a whole token has its own, the rest is merged."""
        whole = [self.ranks.get(t.encode()) for t in tokens]
        rest = iter(self.merges.results([t for t, rank in zip(tokens, whole) if rank is None], self._cut))
        return [next(rest) if rank is None else array("I", (rank,)).tobytes() for rank in whole]

    @staticmethod
    def _cut(ids: np.ndarray, ends: np.ndarray) -> list[bytes]:
        packed, ends = ids.astype(np.uint32).tobytes(), (ends * 4).tolist()
        return [packed[a:b] for a, b in zip([0, *ends], ends)]

    def encode(self, texts) -> Iterator[np.ndarray]:
        """Ids of each text."""
        parts = []
        for last, packed in self.memory.look_up(texts):
            parts.append(b"".join(packed))
            if last:
                yield np.frombuffer(b"".join(parts), np.uint32)
                parts = []

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids.tolist()))


def read_ranks(path: str) -> dict[bytes, int]:
    """Tokens and ranks of a rank file: base64 of the token, a space, the rank."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


_encoders: dict[tuple[str, str], Encoder] = {}


def worker_encoder(name: str, pattern: str) -> Encoder:
    """The encoder of this Python worker, built once from the file that Spark has sent to it."""
    if (name, pattern) not in _encoders:
        _encoders[name, pattern] = Encoder(read_ranks(SparkFiles.get(name)), pattern)
    return _encoders[name, pattern]


def send_file(docs: DataFrame, path: str) -> str:
    """Send a vocabulary file to all executors; its name there."""
    docs.sparkSession.sparkContext.addFile(path)
    return path.rsplit("/", 1)[-1]


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """All columns of docs and ``token_ids`` array<int>, the ids of the whole text."""
    name = send_file(docs, path)
    out = [c for c in docs.columns if c != "token_ids"]

    def run(batches):
        encoder = worker_encoder(name, pattern)
        for batch in batches:
            ids = [i.astype(np.int32) for i in encoder.encode(t.as_py() or "" for t in batch.column("text"))]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in out), pa.array(ids, pa.list_(pa.int32()))], names=[*out, "token_ids"])
        encoder.memory.rest()
        encoder.merges.forget()

    schema = docs.select(*out).schema.add("token_ids", T.ArrayType(T.IntegerType()))
    return docs.mapInArrow(run, schema)


def decode(rows: DataFrame, path: str, pattern: str) -> DataFrame:
    """All columns of rows and ``decoded`` binary, the bytes of ``token_ids``."""
    name = send_file(rows, path)
    out = [c for c in rows.columns if c != "decoded"]

    def run(batches):
        encoder = worker_encoder(name, pattern)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                data = [b"" if not ids.is_valid else encoder.decode(ids.values.to_numpy()) for ids in part.column("token_ids")]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in out), pa.array(data, pa.binary())], names=[*out, "decoded"])

    return rows.mapInArrow(run, rows.select(*out).schema.add("decoded", T.BinaryType()))


def round_trip(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (ids as little-endian unsigned 32-bit) and decoded_sha256 of every row, ids and text staying in the task."""
    name = send_file(docs, path)

    def run(batches):
        encoder = worker_encoder(name, pattern)
        for batch in batches:
            counts, digests, decoded = [], [], []
            for ids in encoder.encode(t.as_py() or "" for t in batch.column("text")):
                counts.append(len(ids))
                digests.append(hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest())
                decoded.append(hashlib.sha256(encoder.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(digests), pa.array(decoded)],
                                             names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
        encoder.memory.rest()
        encoder.merges.forget()

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
