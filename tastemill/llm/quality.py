"""Quality classifier: random-indexing word vectors, pooled per document, and a two-layer network with calibrated scores.

Every word hashes to one of ``BUCKETS`` rows; words are runs of letters and
digits or runs of signs. A row has a sparse random index vector, and its word
vector is the sum of the index vectors around all its occurrences in the whole
corpus. Tasks add up their share and send it by slices of rows, so what is
gathered is bounded by the parameters and not by the vocabulary. A document is
the mean of its unit word vectors, with the length of that mean and the
logarithm of its word count. The network is fitted on at most ``SAMPLE``
labelled documents (least hash of the id) whose crc32(doc_id) mod 5 is not 0; a
fifth of them sets the temperature.

Null and empty texts pool to zero and are scored like any other. Without any
label every score is 0.5. Repeated rows get the same score; the labels of a
document that differ are averaged.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .words import RUNS, Words, blocks, text_buffer

BUCKETS = 1 << 15
DIMENSIONS = 64
NONZEROS = 2
REACH = 2
SLICE = 256  # rows of the vector table that travel together
SAMPLE = 8000
HIDDEN = 32
THRESHOLD = 0.3


def held_out(doc_id: Column) -> Column:
    """Documents whose labels are never learnt from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _index_vectors() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(7)
    return rng.integers(0, DIMENSIONS, (BUCKETS, NONZEROS)), rng.choice(np.array([-1, 1], np.int32), (BUCKETS, NONZEROS))


def _rows(words: Words) -> np.ndarray:
    return (words.hashes() % np.uint64(BUCKETS)).astype(np.int64)


def word_vectors(docs: DataFrame) -> np.ndarray:
    """The unit word vectors of all rows of the table, BUCKETS x DIMENSIONS."""
    places, signs = _index_vectors()

    def gather(batches):
        total = np.zeros(BUCKETS * DIMENSIONS, np.int32)
        for block in blocks(batches):
            words = Words(*text_buffer(block.column("text")), RUNS)
            row, owner = _rows(words), words.owners()
            for step in range(1, REACH + 1):
                left, right = row[:-step], row[step:]
                same = owner[:-step] == owner[step:]
                left, right = left[same], right[same]
                for of, other in ((left, right), (right, left)):
                    for k in range(NONZEROS):
                        np.add.at(total, of * DIMENSIONS + places[other, k], signs[other, k])
        total = total.reshape(-1, SLICE * DIMENSIONS)
        used = np.flatnonzero(total.any(axis=1))
        pack = zstandard.ZstdCompressor(level=1).compress
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array([pack(total[k].tobytes()) for k in used], pa.binary())], names=["slice", "part"])

    def add(batches):
        totals: dict[int, np.ndarray] = {}
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            for k, part in zip(batch.column("slice").to_pylist(), batch.column("part")):
                values = np.frombuffer(unpack(part.as_buffer()), np.int32)
                totals[k] = totals[k] + values if k in totals else values.astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(list(totals), pa.int64()), pa.array([t.astype(np.float32).tobytes() for t in totals.values()], pa.binary())], names=["slice", "total"])

    parts = docs.select("text").mapInArrow(gather, "slice long, part binary").repartition("slice")
    vectors = np.zeros((BUCKETS // SLICE, SLICE * DIMENSIONS), np.float32)
    for k, total in parts.mapInArrow(add, "slice long, total binary").collect():  # BUCKETS rows at most
        vectors[k] = np.frombuffer(total, np.float32)
    vectors = vectors.reshape(BUCKETS, DIMENSIONS)
    length = np.linalg.norm(vectors, axis=1, keepdims=True)
    vectors = vectors / np.maximum(length, 1)
    used = length[:, 0] > 0
    if used.any():
        vectors[used] -= vectors[used].mean(axis=0)
        vectors[used] /= np.maximum(np.linalg.norm(vectors[used], axis=1, keepdims=True), 1e-6)
    return vectors


def pool(vectors: np.ndarray, column: pa.Array) -> np.ndarray:
    """Features of each text."""
    words = Words(*text_buffer(column), RUNS)
    row, out = _rows(words), np.zeros((len(column), DIMENSIONS + 2), np.float32)
    for k, (a, b) in enumerate(zip(words.first[:-1].tolist(), words.first[1:].tolist())):
        if b > a:
            total = sum(vectors[row[i:min(i + 16384, b)]].sum(axis=0) for i in range(a, b, 16384))
            out[k, :DIMENSIONS] = total / (b - a)
            out[k, DIMENSIONS] = np.linalg.norm(out[k, :DIMENSIONS])
            out[k, DIMENSIONS + 1] = np.log1p(b - a)
    return out


@dataclass
class Network:
    mean: np.ndarray
    scale: np.ndarray
    hidden: np.ndarray
    hidden_bias: np.ndarray
    out: np.ndarray
    out_bias: float
    temperature: float = 1.0

    def logits(self, features: np.ndarray) -> np.ndarray:
        x = (features - self.mean) / self.scale
        return np.tanh(x @ self.hidden + self.hidden_bias) @ self.out + self.out_bias

    def scores(self, features: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(features) / self.temperature, -30, 30)))


def fit(features: np.ndarray, labels: np.ndarray, steps: int = 1200, batch: int = 512, rate: float = 0.01, decay: float = 1e-4) -> Network:
    """Adam on the log loss; every fifth row is kept for the temperature."""
    rng = np.random.default_rng(11)
    width = features.shape[1]
    if not len(labels):
        return Network(np.zeros(width), np.ones(width), np.zeros((width, HIDDEN)), np.zeros(HIDDEN), np.zeros(HIDDEN), 0.0)
    check = np.arange(len(labels)) % 5 == 4
    x, y = features[~check].astype(np.float64), labels[~check]
    mean, scale = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-6)
    x = (x - mean) / scale
    p = [rng.normal(0, 1 / np.sqrt(width), (width, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN), np.zeros(1)]
    first, second = [np.zeros_like(w) for w in p], [np.zeros_like(w) for w in p]
    for step in range(1, steps + 1):
        of = rng.integers(0, len(y), min(batch, len(y)))
        h = np.tanh(x[of] @ p[0] + p[1])
        error = (1 / (1 + np.exp(-np.clip(h @ p[2] + p[3], -30, 30))) - y[of]) / len(of)
        back = np.outer(error, p[2]) * (1 - h * h)
        for k, grad in enumerate((x[of].T @ back, back.sum(axis=0), h.T @ error, error.sum(keepdims=True))):
            grad = grad + decay * p[k]
            first[k] = 0.9 * first[k] + 0.1 * grad
            second[k] = 0.999 * second[k] + 0.001 * grad * grad
            p[k] -= rate * (first[k] / (1 - 0.9 ** step)) / (np.sqrt(second[k] / (1 - 0.999 ** step)) + 1e-8)
    net = Network(mean, scale, p[0], p[1], p[2], float(p[3][0]))
    if check.any():
        logits, y, grid = net.logits(features[check].astype(np.float64)), labels[check], np.logspace(-1, 1, 41)
        losses = [(np.logaddexp(0, logits / t) - y * logits / t).mean() for t in grid]
        net.temperature = float(grid[int(np.argmin(losses))])
    return net


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> tuple[np.ndarray, Network]:
    """Word vectors of all docs, and the network of a bounded sample of labelled ones."""
    spark, vectors = docs.sparkSession, word_vectors(docs)
    known = labels.where(~held_out(F.col("doc_id").cast("long"))).groupBy(F.col("doc_id").cast("long").alias("_id")).agg(
        F.avg("quality").alias("_quality")).where("_quality IS NOT NULL AND _id IS NOT NULL")
    chosen = F.broadcast(known.orderBy(F.xxhash64("_id"), "_id").limit(sample))  # at most ``sample`` rows
    shared = spark.sparkContext.broadcast(vectors)

    def run(batches):
        for block in blocks(batches):
            features = pool(shared.value, block.column("text"))
            yield pa.RecordBatch.from_arrays([block.column("_id"), block.column("_quality"), pa.array([f.tobytes() for f in features], pa.binary())], names=["id", "quality", "features"])

    rows = docs.select(F.col("doc_id").cast("long").alias("_id"), "text").join(chosen, "_id").select("_id", "_quality", "text").mapInArrow(run, "id long, quality double, features binary").collect()
    rows.sort(key=lambda r: (r.id, bytes(r.features)))
    features = np.array([np.frombuffer(r.features, np.float32) for r in rows], np.float32).reshape(-1, DIMENSIONS + 2)
    order = np.random.default_rng(3).permutation(len(rows))
    return vectors, fit(features[order], np.array([float(r.quality >= 0.5) for r in rows])[order])


def score(docs: DataFrame, vectors: np.ndarray, network: Network) -> DataFrame:
    """doc_id and score of every row."""
    shared = docs.sparkSession.sparkContext.broadcast((vectors, network))

    def run(batches):
        vectors, network = shared.value
        for block in blocks(batches):
            yield pa.RecordBatch.from_arrays([block.column("doc_id"), pa.array(network.scores(pool(vectors, block.column("text"))), pa.float64())], names=["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, score double")


def keep_quality(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs that score ``threshold`` or more, in the columns of docs."""
    shared = docs.sparkSession.sparkContext.broadcast(train(docs, labels))

    def run(batches):
        vectors, network = shared.value
        for block in blocks(batches):
            yield block.filter(pc.greater_equal(pa.array(network.scores(pool(vectors, block.column("text"))), pa.float64()), threshold))

    return docs.mapInArrow(run, docs.schema)
