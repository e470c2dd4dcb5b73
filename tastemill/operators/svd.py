"""Truncated SVD without centring: block subspace iteration with Chebyshev steps.

Rows are (doc, terms ARRAY<STRUCT<term_idx, weight>>). The block starts from
values that follow from the seed and the term id alone, is made orthonormal by
tall-skinny QR (R factors per task, combined), and is turned to its Ritz vectors
each round. A round ends the solution when every wanted vector's residual is small
against the distance to its neighbours; else a Chebyshev polynomial of X'X, small on
everything below the wanted values, is applied to the block. Vectors of equal
singular values are turned to one basis that depends on their span only, and one
rule fixes all signs, so the result does not depend on how the block is carried:
while it fits SVD_BASIS_BYTES it is an array, shipped to the tasks, and one pass
over the rows gives each task's share of X'XQ; beyond that it is a table and
both products run through ``tiles.weighted_sums``. With so few columns that X'X itself
fits GRAM_BYTES, one pass over the rows makes it, as a written table of strips, and the
products read that instead of the rows. The steps are the same.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import SEED, SVD_BASIS_BYTES
from ..session import cut_lineage
from . import tiles

# Largest X'X that a task sums up: 5,792 columns.
GRAM_BYTES = 256 * 1024 * 1024
OVERSAMPLING = 10
ROUNDS = 60
# Largest error of a component, as residual over the distance to the next value.
TOLERANCE = 1e-7
# Values nearer than this (relative) count as one value of higher multiplicity.
EQUAL_VALUES = 1e-7
_NOISE = 1e-14
_SLICE = 8192


@dataclass(frozen=True)
class SvdResult:
    projected: DataFrame  # (doc, features): rows of U * Sigma
    singular_values: np.ndarray
    error: float = 0.0  # largest residual over gap; above TOLERANCE only if ROUNDS ran out
    passes: int = 0  # products with X'X


def component_cap(k: int, n_columns: int) -> int:
    """Components for a learned vocabulary: at most one fewer than its size."""
    return max(min(k, n_columns - 1), 0)


def truncated_svd(
    rows: DataFrame,
    n_columns: int,
    k: int,
    seed: int = SEED,
    basis_bytes: int = SVD_BASIS_BYTES,
) -> SvdResult:
    """Project each row on the k leading right singular vectors. Missing
    components (rank below k) come out as zeros."""
    if n_columns == 0 or k <= 0:
        zero = rows.select("doc", F.array(F.lit(0.0)).alias("features"))
        return SvdResult(zero, np.zeros(1))
    width = min(n_columns, k + max(OVERSAMPLING, k))
    rows = cut_lineage(rows)  # every pass below reads the same written rows
    if n_columns * width * 8 > basis_bytes:
        space = _Table(rows, n_columns)
    else:
        space = (_Gram if n_columns**2 * 8 <= GRAM_BYTES else _Array)(rows, n_columns)
    values, components, error = _solve(space, width, k, seed)
    out = _padded(space.project(components), k)
    return SvdResult(out, np.pad(np.sqrt(values), (0, k - len(values))), error, space.passes)


def _start_rows(terms: np.ndarray, width: int, seed: int) -> np.ndarray:
    """Uniform values in [-1, 1) from (seed, term, column) alone."""
    with np.errstate(over="ignore"):
        x = terms.astype(np.uint64)[:, None] * np.uint64(0x9E3779B97F4A7C15) + np.arange(1, width + 1, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95)
        x += np.uint64(seed) * np.uint64(0xA24BAED4963EE407)
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return ((x ^ (x >> np.uint64(31))) >> np.uint64(11)).astype(np.float64) / 2.0**52 - 1.0


def _whitener(r: np.ndarray) -> np.ndarray:
    """Matrix that makes the columns of Y = QR orthonormal; vanishing directions go."""
    if not r.size:
        return np.zeros((r.shape[1], 0))
    _, size, turn = np.linalg.svd(r)
    size = size[: len(turn)]
    keep = size > size.max(initial=0.0) * 1e-12
    return turn[: len(size)].T[:, keep] / size[keep]


def _orthonormal(space, block):
    for _ in range(2):  # the second time removes what rounding left
        block = space.mix((block, _whitener(space.r_factor(block))))
    return block


def _solve(space, width: int, k: int, seed: int):
    """(values of X'X, their vectors, largest error) of the k leading components."""
    start = space.start(width, seed)
    block = _orthonormal(space, space.apply(start))
    for step in range(ROUNDS):
        image = space.apply(block)
        small = space.cross(block, image)
        values, turn = np.linalg.eigh((small + small.T) / 2)
        values, turn = np.maximum(values[::-1], 0.0), turn[:, ::-1]
        if not len(values):
            return values, block, 0.0
        rest = space.mix((image, turn), (block, -turn * values))
        residual = np.sqrt(np.maximum(np.diag(space.cross(rest, rest)), 0.0))
        wanted = min(k, len(values))
        error = _errors(values, residual)[:wanted].max()
        if error <= TOLERANCE or step + 1 == ROUNDS:
            break
        # everything up to ``edge`` is damped; it stays below the wanted values, which may be equal to the last
        edge = min(values[-1], 0.9 * values[wanted - 1])
        block = _orthonormal(space, _chebyshev(space, block, image, turn, values, max(edge, values[0] * 1e-12)))
    turn = turn @ _one_basis(values, turn, space.cross(block, start))
    vectors = space.mix((block, turn[:, :wanted]))
    vectors = space.mix((vectors, np.diag(space.signs(vectors))))
    return values[:wanted], vectors, float(error)


def _errors(values: np.ndarray, residual: np.ndarray) -> np.ndarray:
    """Residual over the distance to the next other value; below rounding it is 0."""
    ids = _clusters(values)
    gap = np.empty(len(values))
    for c in range(ids[-1] + 1):
        member = np.flatnonzero(ids == c)
        above = values[member[0] - 1] - values[member[0]] if member[0] else np.inf
        below = values[member[-1]] - values[member[-1] + 1] if member[-1] + 1 < len(values) else max(values[member[-1]], values[0] * EQUAL_VALUES)
        gap[member] = min(above, below)
    return np.where(residual <= _NOISE * len(values) * values[0], 0.0, residual / np.maximum(gap, values * EQUAL_VALUES + 1e-300))


def _clusters(values: np.ndarray) -> np.ndarray:
    """Number of the group of (nearly) equal values that each descending value is in."""
    return np.concatenate(([0], np.cumsum(values[:-1] - values[1:] > EQUAL_VALUES * values[:-1])))


def _one_basis(values: np.ndarray, turn: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Rotation inside each group of equal values to the basis that the start block's projection gives."""
    ids, out = _clusters(values), np.eye(len(values))
    for c in np.flatnonzero(np.bincount(ids) > 1):
        member = np.flatnonzero(ids == c)
        q, r = np.linalg.qr((turn[:, member].T @ start)[:, : len(member)])
        out[np.ix_(member, member)] = q * np.where(np.diag(r) < 0, -1.0, 1.0)
    return out


def _chebyshev(space, block, image, turn, values, edge: float):
    """A Chebyshev polynomial of X'X, bounded by 1 on [0, edge], times the Ritz vectors, each scaled to about its size."""
    reach = np.arccosh(np.maximum(2 * values / edge - 1, 1.0))
    degree = int(np.clip(np.log(1e13) / max(reach[0], 1e-3), 2, 12))
    before, now = space.mix((block, turn)), space.mix((image, turn * (2 / edge)), (block, -turn))
    same = np.eye(len(values))
    for _ in range(degree - 1):
        before, now = now, space.mix((space.apply(now), same * (4 / edge)), (now, -2 * same), (before, -same))
    return space.mix((now, np.diag(1 / np.cosh(degree * reach))))


class _Array:
    """The block as a driver array, bounded by SVD_BASIS_BYTES and shipped to the tasks."""

    def __init__(self, rows: DataFrame, n: int):
        self.rows, self.n, self.passes = rows, n, 0

    def start(self, width, seed):
        return _start_rows(np.arange(self.n), width, seed)

    def apply(self, block):
        self.passes += 1
        return _gram_pass(self.rows, block)

    def mix(self, *parts):
        return sum(block @ matrix for block, matrix in parts)

    def cross(self, a, b):
        return a.T @ b

    def r_factor(self, block):
        return np.linalg.qr(block, mode="r")

    def signs(self, vectors):
        return np.array([_sign(np.arange(len(v)), v) for v in vectors.T])

    def project(self, vectors):
        shared = self.rows.sparkSession.sparkContext.broadcast(vectors)

        def kernel(batches):
            for batch in batches:
                yield tiles._vec_batch(batch.column("doc").to_numpy(), _times(batch, shared.value))

        rows = self.rows.select(F.col("doc").cast("bigint").alias("doc"), "terms")
        if not vectors.shape[1]:
            return rows.select("doc", F.array().cast("array<double>").alias("features"))
        return rows.mapInArrow(kernel, "key BIGINT, vec ARRAY<DOUBLE>").toDF("doc", "features")


class _Gram(_Array):
    """The block as an array, and X'X as a written table of strips: the rows are read once, however many products follow."""

    def __init__(self, rows: DataFrame, n: int):
        super().__init__(rows, n)
        self.strips = _gram_strips(rows, n)

    def apply(self, block):
        self.passes += 1
        return _strip_product(self.strips, block)


class _Table:
    """The block as a table (key, vec); only products of its narrow side reach the driver."""

    def __init__(self, rows: DataFrame, n: int):
        cells = rows.select(F.col("doc").cast("bigint").alias("doc"), F.explode("terms").alias("c")).select(
            "doc", F.col("c.term_idx").cast("bigint").alias("term"), F.col("c.weight").alias("weight"))
        self.by_doc = cells.select(F.col("doc").alias("key"), F.col("term").alias("item"), "weight")
        self.by_term = cells.select(F.col("term").alias("key"), F.col("doc").alias("item"), "weight")
        self.rows, self.passes = rows, 0

    def _product(self, entries, vectors, salt=1):
        v = vectors.select(F.col("key").alias("item"), "vec")
        return tiles.weighted_sums(entries, v, tiles.plan_layout(v, vec="vec"), salt)

    def start(self, width, seed):
        def kernel(batches):
            for batch in batches:
                keys = batch.column("key").to_numpy()
                if len(keys):
                    yield tiles._vec_batch(keys, _start_rows(keys, width, seed))

        return cut_lineage(self.by_term.select("key").distinct().mapInArrow(kernel, "key BIGINT, vec ARRAY<DOUBLE>"))

    def apply(self, block):
        self.passes += 1
        # A term can be in nearly every document: its entries are salted.
        return cut_lineage(self._product(self.by_term, self._product(self.by_doc, block), salt=16))

    def mix(self, *parts):
        mixed = [_apply(block, matrix) for block, matrix in parts]
        if len(mixed) == 1:
            return cut_lineage(mixed[0])
        every = mixed[0]
        for more in mixed[1:]:
            every = every.union(more)
        return cut_lineage(tiles.sum_vectors(every, "key", "vec"))

    def cross(self, a, b):
        return _narrow_product(a, b)

    def r_factor(self, block):
        return _tall_r(block)

    def signs(self, vectors):
        def kernel(batches):
            # per batch: the first of each column's largest entries
            for batch in batches:
                keys, m = batch.column("key").to_numpy(), tiles._matrix(batch.column("vec"))
                if len(keys):
                    order = np.argsort(keys)
                    at = [order[_peak(m[order, j])] for j in range(m.shape[1])]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.arange(m.shape[1])), pa.array(keys[at]), pa.array(m[at, np.arange(m.shape[1])])], names=["column", "key", "x"])

        peaks = vectors.select("key", "vec").mapInArrow(kernel, "column BIGINT, key BIGINT, x DOUBLE")
        largest = peaks.groupBy("column").agg(F.max(F.abs("x")).alias("top"))
        near = peaks.join(largest, "column").where(F.abs("x") >= F.col("top") * (1 - _PEAK))
        first = near.groupBy("column").agg(F.min_by("x", "key").alias("x")).toArrow().sort_by("column")
        return np.where(first.column("x").to_numpy() < 0, -1.0, 1.0)

    def project(self, vectors):
        found = self._product(self.by_doc, vectors).toDF("_key", "features")
        docs = self.rows.select(F.col("doc").cast("bigint").alias("doc"))
        return docs.join(found, F.col("doc") == F.col("_key"), "left").select(
            "doc", F.coalesce("features", F.array().cast("array<double>")).alias("features"))


# The sign of a component makes its largest entry positive; of entries within
# this share of the largest, the one of the smallest term id counts.
_PEAK = 1e-6


def _peak(v: np.ndarray) -> int:
    size = np.abs(v)
    return int(np.argmax(size >= size.max() * (1 - _PEAK)))


def _sign(terms: np.ndarray, v: np.ndarray) -> float:
    return -1.0 if len(v) and v[_peak(v)] < 0 else 1.0


def _csr(batch: pa.RecordBatch):
    """(row number, column, weight) of the cells of a batch."""
    lists = batch.column("terms")
    counts = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    cells = lists.flatten()
    return (
        np.repeat(np.arange(len(counts)), counts),
        cells.field("term_idx").to_numpy(zero_copy_only=False).astype(np.int64),
        cells.field("weight").to_numpy(zero_copy_only=False).astype(np.float64),
    )


def _scatter(out, target, source_rows, weight):
    """out[target] += weight * source_rows, in slices, target sorted."""
    for lo in range(0, len(target), _SLICE):
        t = target[lo : lo + _SLICE]
        starts = np.flatnonzero(np.append(True, t[1:] != t[:-1]))
        out[t[starts]] += np.add.reduceat(source_rows(lo, lo + len(t)) * weight[lo : lo + _SLICE, None], starts, axis=0)


# Rows multiplied at once, and the least share of cells that makes a dense product the cheaper one.
_ROWS = 512
_DENSE = 0.01


def _slices(batch: pa.RecordBatch, densely: bool = True):
    """(first row, rows, sorted columns, dense slice or None, (row, column, weight)) of runs of rows."""
    row, col, weight = _csr(batch)
    for lo in range(0, batch.num_rows, _ROWS):
        a, b = np.searchsorted(row, (lo, lo + _ROWS))
        n = min(_ROWS, batch.num_rows - lo)
        r, c, w = row[a:b] - lo, col[a:b], weight[a:b]
        columns, at = np.unique(c, return_inverse=True)
        dense = None
        if densely and len(c) > _DENSE * n * len(columns):
            dense = np.bincount(r * len(columns) + at, w, n * len(columns)).reshape(n, len(columns))
        yield lo, n, columns, dense, (r, c, w)


def _slice_times(part, basis) -> np.ndarray:
    _, n, columns, dense, (r, c, w) = part
    if dense is not None:
        return dense @ basis[columns]
    y = np.zeros((n, basis.shape[1]))
    _scatter(y, r, lambda a, b: basis[c[a:b]], w)
    return y


def _times(batch, basis) -> np.ndarray:
    """Rows of the batch times a dense basis."""
    y = np.zeros((batch.num_rows, basis.shape[1]))
    for part in _slices(batch):
        y[part[0] : part[0] + part[1]] = _slice_times(part, basis)
    return y


def _gram_pass(rows: DataFrame, basis: np.ndarray) -> np.ndarray:
    """X'X times the basis: one pass, partial sums per task, added per column."""
    shared = rows.sparkSession.sparkContext.broadcast(basis)

    def kernel(batches):
        q = shared.value
        z = np.zeros(q.shape)
        for batch in batches:
            for part in _slices(batch):
                y, (_, _, columns, dense, (r, c, w)) = _slice_times(part, q), part
                if dense is not None:
                    z[columns] += dense.T @ y
                    continue
                order = np.argsort(c, kind="stable")
                rows_of = r[order]
                _scatter(z, c[order], lambda a, b: y[rows_of[a:b]], w[order])
        held = [(c, z[c * _COLUMNS : (c + 1) * _COLUMNS]) for c in range(-(-len(z) // _COLUMNS))]
        yield _chunk_rows([(c, part) for c, part in held if part.any()])

    total = _summed(rows.select("terms").mapInArrow(kernel, "chunk INT, part BINARY"), basis.shape)
    shared.unpersist()
    return total


def _add_chunks(batches):
    """Sums of the parts of each chunk."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for c, part in zip(batch.column("chunk").to_pylist(), batch.column("part")):
            values = np.frombuffer(part.as_buffer(), np.float64)
            if c in sums:
                sums[c] += values
            else:
                sums[c] = values.copy()
    for c in list(sums):
        yield _chunk_rows([(c, sums.pop(c))])


def _summed(partial: DataFrame, shape: tuple[int, int]) -> np.ndarray:
    """The sum of partial (chunk, part) as an array, bounded by SVD_BASIS_BYTES, checked in truncated_svd."""
    total = np.zeros(shape)
    summed = partial.repartition("chunk").mapInArrow(_add_chunks, "chunk INT, part BINARY").toArrow()
    for c, part in zip(summed.column("chunk").to_pylist(), summed.column("part")):
        total[c * _COLUMNS : (c + 1) * _COLUMNS] = np.frombuffer(part.as_buffer(), np.float64).reshape(-1, shape[1])
    return total


# Cost of a cell of an outer product, in multiplications of a dense one (measured: about 3 ns against 0.05).
_OUTER = 64
# Cells of an outer product that are held at once.
_OUTER_CELLS = 1 << 20


def _add_outer(gram: np.ndarray, part) -> None:
    """gram += rows' rows of a slice: as one dense product, or row by row where the rows are short."""
    _, n, columns, _, (r, c, w) = part
    if not len(c):
        return
    counts = np.bincount(r, minlength=n)
    if _OUTER * float((counts.astype(np.float64) ** 2).sum()) >= n * float(len(columns)) ** 2 or (np.diff(r * len(gram) + c) <= 0).any():
        at = np.searchsorted(columns, c)
        dense = np.bincount(r * len(columns) + at, w, n * len(columns)).reshape(n, len(columns))
        for lo in range(0, len(columns), _SLICE // 8):  # strips: no second matrix of the whole size
            gram[np.ix_(columns[lo : lo + _SLICE // 8], columns)] += dense[:, lo : lo + _SLICE // 8].T @ dense
        return
    ends = np.cumsum(counts)
    for a, b in zip(ends - counts, ends):  # columns of a row are distinct here
        step = max(_OUTER_CELLS // max(b - a, 1), 1)
        for lo in range(a, b, step):
            gram[c[lo : min(lo + step, b), None], c[a:b]] += w[lo : min(lo + step, b), None] * w[a:b]


def _gram_strips(rows: DataFrame, n: int) -> DataFrame:
    """(chunk, part): X'X in strips of _COLUMNS rows, each from its first column on, as X'X is symmetric.

    A task sums up its rows and sends the strips out once, so there are as many tasks as cores, whatever the rows.
    """
    def kernel(batches):
        gram = np.zeros((n, n))
        for batch in batches:
            for part in _slices(batch, densely=False):
                _add_outer(gram, part)
        for c in range(-(-n // _COLUMNS)):
            strip = gram[c * _COLUMNS : (c + 1) * _COLUMNS, c * _COLUMNS :]
            if strip.any():
                yield _chunk_rows([(c, strip)])

    cores = rows.sparkSession.sparkContext.defaultParallelism
    partial = rows.select("terms").coalesce(cores).mapInArrow(kernel, "chunk INT, part BINARY")
    return cut_lineage(partial.repartition(2 * cores, "chunk").mapInArrow(_add_chunks, "chunk INT, part BINARY"))


def _strip_product(strips: DataFrame, basis: np.ndarray) -> np.ndarray:
    """X'X times the basis, from the strips of its upper half."""
    shared = strips.sparkSession.sparkContext.broadcast(basis)
    n, width = basis.shape

    def kernel(batches):
        q = shared.value
        z = np.zeros(q.shape)
        for batch in batches:
            for c, part in zip(batch.column("chunk").to_pylist(), batch.column("part")):
                lo, hi = c * _COLUMNS, min((c + 1) * _COLUMNS, n)
                strip = np.frombuffer(part.as_buffer(), np.float64).reshape(hi - lo, n - lo)
                z[lo:hi] += strip @ q[lo:]
                z[hi:] += strip[:, hi - lo :].T @ q[lo:hi]
        held = [(c, z[c * _COLUMNS : (c + 1) * _COLUMNS]) for c in range(-(-n // _COLUMNS))]
        yield _chunk_rows([(c, part) for c, part in held if part.any()])

    total = _summed(strips.mapInArrow(kernel, "chunk INT, part BINARY"), (n, width))
    shared.unpersist()
    return total


# Columns whose partial sums travel as one cell: small, as a cell comes from every task.
_COLUMNS = 64


def _chunk_rows(chunks) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([c for c, _ in chunks], pa.int32()), pa.array([np.ascontiguousarray(p).tobytes() for _, p in chunks], pa.binary())], names=["chunk", "part"])


def _padded(df: DataFrame, k: int) -> DataFrame:
    missing = F.array_repeat(F.lit(0.0), F.greatest(F.lit(k) - F.size("features"), F.lit(0)))
    return df.withColumn("features", F.concat("features", missing))


def _narrow_product(a: DataFrame, b: DataFrame) -> np.ndarray:
    """a'b of two tall tables over the same keys: partial products per task, added."""
    both = a.select("key", "vec").join(b.select("key", F.col("vec").alias("other")), "key") if a is not b else a.select("key", "vec", F.col("vec").alias("other"))

    def kernel(batches):
        g = None
        for batch in batches:
            if batch.num_rows:
                part = tiles._matrix(batch.column("vec")).T @ tiles._matrix(batch.column("other"))
                g = part if g is None else g + part
        if g is not None:
            yield tiles._vec_batch(np.arange(len(g)), g)

    partial = both.select("vec", "other").mapInArrow(kernel, "key BIGINT, vec ARRAY<DOUBLE>")
    return _collected(tiles.sum_vectors(partial, "key", "vec"))


def _collected(narrow: DataFrame) -> np.ndarray:
    """A table of as many rows as the block is wide."""
    table = narrow.toArrow().sort_by("key")
    return tiles._matrix(table.column("vec").combine_chunks()) if table.num_rows else np.zeros((0, 0))


# R factors that are combined in one task, at each of two levels.
_R_GROUP = 64


def _tall_r(vectors: DataFrame) -> np.ndarray:
    """R of a tall table's QR: each task's own R, stacked and reduced in groups, then in one."""

    def own(batches):
        r = None
        for batch in batches:
            if batch.num_rows:
                m = tiles._matrix(batch.column("vec"))
                r = np.linalg.qr(m if r is None else np.concatenate((r, m)), mode="r")
        if r is not None:
            yield tiles._vec_batch(np.arange(len(r)), r)

    level = vectors.select("vec").mapInArrow(own, "key BIGINT, vec ARRAY<DOUBLE>")
    task = F.spark_partition_id()
    level = level.select((task % _R_GROUP).alias("g"), "vec").repartition(_R_GROUP, "g").select("vec").mapInArrow(own, "key BIGINT, vec ARRAY<DOUBLE>")
    table = level.toArrow()  # at most _R_GROUP factors
    return np.linalg.qr(tiles._matrix(table.column("vec").combine_chunks()), mode="r") if table.num_rows else np.zeros((0, 0))


def _apply(vectors: DataFrame, matrix: np.ndarray) -> DataFrame:
    """Each vector times a small matrix."""
    def kernel(batches):
        for batch in batches:
            if batch.num_rows:
                yield tiles._vec_batch(batch.column("key").to_numpy(), tiles._matrix(batch.column("vec")) @ matrix)

    return vectors.select("key", "vec").mapInArrow(kernel, "key BIGINT, vec ARRAY<DOUBLE>")


def term_sums(rows: DataFrame) -> DataFrame:
    """(c, s, q): sum and sum of squares of each column of the rows."""
    cells = rows.select(F.explode("terms").alias("t")).select(F.col("t.term_idx").alias("c"), F.col("t.weight").alias("x"))
    return cells.groupBy("c").agg(F.sum("x").alias("s"), F.sum(F.col("x") * F.col("x")).alias("q"))


def component_sums(projected: DataFrame) -> DataFrame:
    """(c, s, q, cross): sum, sum of squares and of products with the next one of each projected column; every task adds up its rows."""
    def kernel(batches):
        sums = None
        for batch in batches:
            if batch.num_rows:
                m = tiles._matrix(batch.column("features"))
                after = np.hstack((m[:, 1:], np.zeros((len(m), 1))))
                part = np.array([m.sum(axis=0), (m**2).sum(axis=0), (m * after).sum(axis=0)])
                sums = part if sums is None else sums + part
        if sums is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(sums.shape[1])), *map(pa.array, sums)], names=["c", "s", "q", "cross"])

    partial = projected.select("features").mapInArrow(kernel, "c BIGINT, s DOUBLE, q DOUBLE, cross DOUBLE")
    return partial.groupBy("c").agg(*(F.sum(name).alias(name) for name in ("s", "q", "cross")))


def total_variance(sums: DataFrame, n_docs) -> DataFrame:
    """One row, one column ``v``: the variances of the columns, added; documents without a row count as zeros."""
    n = F.col("n")
    return sums.withColumn("n", n_docs).agg(F.sum(F.col("q") / n - (F.col("s") / n) * (F.col("s") / n)).alias("v"))


def explained_variance(rows: DataFrame, projected: DataFrame, n_docs) -> DataFrame:
    """Variance of the projected columns over the variance of the originals;
    documents without terms count as zero rows."""
    kept = total_variance(component_sums(projected), n_docs)
    return kept.withColumn("o", total_variance(term_sums(rows), n_docs).scalar()).select((F.col("v") / F.col("o")).alias("explained_variance"))
