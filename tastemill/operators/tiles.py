"""Dense kernels over tiles: weighted vector sums and exact top-K.

Vectors live in an *item side* that is cut into blocks of bounded bytes by
hash; the other side (ratings, queries) is cut into shards. A tile is one
(shard, block) pair and is one partition: its block rows arrive first, then the
shard rows stream by in key order, so a task holds one block plus one Arrow
batch. Blocks reach the tiles through the shuffle. Nothing passes through the
driver, and pairs are only scored inside a tile, where K rows per key leave it.

With one block (the catalogue fits ITEM_BLOCK_BYTES) a tile result is final.
With more, partial sums are added and partial top-K lists are merged per key; where
the vectors lie in cells around pivots, blocks are made of cells, a query starts in
its own block and goes on only to blocks that may hold something better.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import ITEM_BLOCK_BYTES, SLAB_BYTES
from ..session import cut_lineage
from .ranking import top_per_group

# Scores are compared at this many decimals, so that equal vectors tie exactly
# whatever block they are in; ties go to the smaller id.
SCORE_DECIMALS = 10
_QUERY_CHUNK = 256
_GATHER_CHUNK = 4096
# Items of the first slice, at least; each further one has twice as many, up to the slab.
_FIRST_SLICE = 512
# Longest vectors whose exact scores may be told apart from single-precision ones.
_NEAR_LENGTH = 16.0
# Fewest queries worth a copy of the item side.
_SHARD_ROWS = 64
# Tiles of sparse entries for each core.
_TILES_PER_CORE = 3
# Cells of a block are made around pivots from so many of its vectors, with so many vectors to a cell, so many cells at most.
_PIVOT_ROWS = 4096
_CELL_ROWS = 2500
_BLOCK_CELLS = 128
# Cells are used where distances to their centres (squared, mean) are below this share of those to the mean of all.
_TIGHT = 0.7
# Cells of a layout of several blocks, for each block and in all.
_LAYOUT_CELLS = 16
_MOST_CELLS = 512


@dataclass(frozen=True)
class Layout:
    shards: int
    blocks: int
    dims: int | None = None  # width of the vectors, where it was measured

    @property
    def tiles(self) -> int:
        return self.shards * self.blocks


def plan_layout(
    vectors: DataFrame, block_bytes: int = ITEM_BLOCK_BYTES, vec: str = "features", self_join: bool = False
) -> Layout:
    """Blocks from the measured size of the item side; shards fill the cluster.

    Every shard gets a copy of each block, so a self join, whose query count is
    known, takes no more shards than it has work for.
    """
    size = vectors.agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.max(F.size(vec)), F.lit(1)).alias("d")
    ).first()
    blocks = max(1, -(-size["n"] * size["d"] * 8 // block_bytes))
    shards = -(-_parallelism(vectors.sparkSession) // blocks)
    if self_join:
        shards = min(shards, -(-size["n"] // _SHARD_ROWS))
    return Layout(max(1, int(shards)), int(blocks), int(size["d"]))


def _for_entries(layout: Layout, spark: SparkSession) -> Layout:
    """The layout with so many shards that the cores are busy, and no more: a shard row of ids and a weight is small
    against the copy of the blocks that its shard gets."""
    shards = max(1, -(-_TILES_PER_CORE * spark.sparkContext.defaultParallelism // layout.blocks))
    return replace(layout, shards=min(layout.shards, shards))


def _parallelism(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def _bucket(col, n: int):
    return F.pmod(F.xxhash64(col), F.lit(n)).cast("int")


def _spread(df: DataFrame, name: str, n: int) -> DataFrame:
    """Copy each row to every bucket of the other side."""
    return df.withColumn(name, F.explode(F.sequence(F.lit(0), F.lit(n - 1))))


def _to_tiles(items: DataFrame, rows: DataFrame, layout: Layout, extra: dict[str, str]) -> DataFrame:
    """Union of replicated blocks (side 0) and shard rows (side 1), one tile per partition."""
    tile = (F.col("shard") * layout.blocks + F.col("block")).cast("int")
    if "block" not in items.columns:
        items = items.withColumn("block", _bucket("item", layout.blocks))
    left = _spread(items, "shard", layout.shards)
    left = left.select(
        tile.alias("tile"), F.lit(0).alias("side"), F.lit(0).cast("bigint").alias("key"), "item", "vec",
        *[F.lit(None).cast(t).alias(c) for c, t in extra.items()],
    )
    right = rows.withColumn("shard", _bucket("shard_key", layout.shards))
    right = right.select(
        tile.alias("tile"), F.lit(1).alias("side"), "key", "item", "vec", *extra,
    )
    return (
        left.unionByName(right)
        .repartitionById(layout.tiles, "tile")
        .sortWithinPartitions("tile", "side", "key", "item")
    )


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """List column to a dense matrix (all lists have one length)."""
    values = column.flatten().to_numpy(zero_copy_only=False)
    return np.ascontiguousarray(values.reshape(len(column), -1), dtype=np.float64)


def _read_tiles(batches: Iterator[pa.RecordBatch]):
    """Yield (tile, ids, matrix, iterator over the shard batches of the tile)."""
    pending: list[pa.RecordBatch] = []
    source = iter(batches)

    def pull():
        return pending.pop() if pending else next(source, None)

    def cut(batch, mask):
        """Split off the leading run where mask holds."""
        n = len(mask) if mask.all() else int(np.argmin(mask))
        if n < len(mask):
            pending.append(batch.slice(n))
        return batch.slice(0, n), n < len(mask)

    def shard_batches(tile):
        while (batch := pull()) is not None:
            head, ended = cut(batch, batch.column("tile").to_numpy() == tile)
            if head.num_rows:
                yield head
            if ended:
                return

    while (batch := pull()) is not None:
        if not batch.num_rows:
            continue
        tile = batch.column("tile")[0].as_py()
        ids, rows = [], []
        while batch is not None:
            keep = (batch.column("tile").to_numpy() == tile) & (batch.column("side").to_numpy() == 0)
            head, ended = cut(batch, keep)
            if head.num_rows:
                ids.append(head.column("item").to_numpy())
                rows.append(_matrix(head.column("vec")))
            if ended:
                break
            batch = pull()
        rest = shard_batches(tile)
        if ids:
            yield tile, np.concatenate(ids), _stacked(rows), rest
        for _ in rest:  # a tile without item rows, or rows the caller left over
            pass


def _stacked(parts: list[np.ndarray]) -> np.ndarray:
    """The parts as one matrix; each is let go once it is copied."""
    out = np.empty((sum(map(len, parts)), parts[0].shape[1]))
    at = len(out)
    while parts:
        part = parts.pop()
        out[at - len(part) : at] = part
        at -= len(part)
    return out


def _complete_groups(batches, columns: list[str]):
    """Regroup key-sorted batches so that no key straddles two chunks."""
    held: list[dict] = []  # pieces of the last key, put together once it ends

    def whole():
        return {c: np.concatenate([h[c] for h in held]) for c in columns}

    for batch in batches:
        if not batch.num_rows:
            continue
        table = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in columns}
        key = table["key"]
        last = int(np.searchsorted(key, key[-1], side="left"))
        if held and held[0]["key"][0] != key[0]:
            yield whole()
            held = []
        if last:
            held.append({c: a[:last] for c, a in table.items()})
            yield whole()
            held = []
        held.append({c: a[last:] for c, a in table.items()})
    if held:
        yield whole()


def _positions(ids: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    pos = np.minimum(np.searchsorted(ids, wanted), len(ids) - 1)
    return pos, ids[pos] == wanted


def _segment_sums(matrix, pos, weight, starts) -> np.ndarray:
    """Per segment: sum of weight * matrix[pos]; gathers a bounded slice at a time."""
    out = np.zeros((len(starts), matrix.shape[1]))
    ends = np.append(starts[1:], len(pos))
    for lo in range(0, len(pos), _GATHER_CHUNK):
        hi = min(lo + _GATHER_CHUNK, len(pos))
        first = int(np.searchsorted(ends, lo, side="right"))
        last = int(np.searchsorted(starts, hi, side="left"))
        local = np.maximum(starts[first:last], lo) - lo
        part = matrix[pos[lo:hi]] * weight[lo:hi, None]
        out[first:last] += np.add.reduceat(part, local, axis=0)
    return out


def _segments(key: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.append(True, key[1:] != key[:-1]))


def _unit(matrix: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1; rows that cancelled out to zero stay zero."""
    norm = np.linalg.norm(matrix, axis=1, keepdims=True)
    return matrix / np.where(norm < 1e-12, 1.0, norm)


def _square_distances(matrix: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances of rows to centres; rounding may leave them slightly off."""
    d = (matrix**2).sum(axis=1)[:, None] - 2.0 * (matrix @ centres.T) + (centres**2).sum(axis=1)
    return np.maximum(d, 0.0, out=d)


def _pivots(sample: np.ndarray, n: int) -> np.ndarray | None:
    """Centres of at most n cells of the sample: rows far from each other, then twice the means of
    their cells. None where cells are about as wide as all of the sample."""
    mean = sample.mean(axis=0, keepdims=True)
    near = _square_distances(sample, mean)[:, 0]
    spread = near.mean()
    at = []
    while len(at) < n and near.max() > 1e-6 * spread:
        at.append(int(near.argmax()))
        near = np.minimum(near, _square_distances(sample, sample[at[-1:]])[:, 0]) if len(at) > 1 else _square_distances(sample, sample[at])[:, 0]
    if len(at) < 2:
        return None
    centres = sample[at]
    for _ in range(2):
        cell = _square_distances(sample, centres).argmin(axis=1)
        used, cell = np.unique(cell, return_inverse=True)
        order = np.argsort(cell, kind="stable")
        starts = np.searchsorted(cell[order], np.arange(len(used)))
        centres = np.add.reduceat(sample[order], starts, axis=0) / np.diff(np.append(starts, len(sample)))[:, None]
    return centres if _square_distances(sample, centres).min(axis=1).mean() < _TIGHT * spread else None


def _nearest(matrix: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Number of the nearest centre of each row."""
    out = np.empty(len(matrix), np.int64)
    for lo in range(0, len(matrix), _GATHER_CHUNK):
        out[lo : lo + _GATHER_CHUNK] = _square_distances(matrix[lo : lo + _GATHER_CHUNK], centres).argmin(axis=1)
    return out


def _cell_reach(q: np.ndarray, length: np.ndarray, centres: np.ndarray, radius: np.ndarray, metric: str) -> np.ndarray:
    """(query, cell): no score of the cell is higher."""
    if metric == "euclidean":
        gap = np.maximum(np.sqrt(_square_distances(q, centres)) - radius, 0.0)
        return -(gap**2) * (1 - 1e-6) + 1e-6 * (1.0 + length[:, None] ** 2)
    return q @ centres.T + length[:, None] * (radius * (1 + 1e-9)) + 1e-9 * (1.0 + length[:, None])


class _Scorer:
    """Scores query vectors against one block, slice by slice, and keeps the best k per query.

    A slice has so many items that its scores for a chunk of queries fit
    SLAB_BYTES; the first ones are short, so that a k-th best score is known early
    and of later slices only the few scores above it are rounded and sorted.
    Slices go by falling length of their vectors, so that an upper bound of what a
    slice can reach, against the k-th best so far, passes over it. Cosine and euclidean
    blocks whose vectors lie in cells have slices inside of cells instead, met by falling
    bound and only by the queries whose bound is not behind their k-th best.
    """

    def __init__(self, ids, matrix, metric: str, k: int, clip, slab_bytes: int = SLAB_BYTES):
        self.metric, self.k, self.clip = metric, k, clip
        size = np.linalg.norm(matrix, axis=1)
        scale = np.where(size < 1e-12, 1.0, size)
        if metric == "cosine":
            size = (size >= 1e-12).astype(float)
        step = max(slab_bytes // (8 * _QUERY_CHUNK), 1)
        cell = self._cells(matrix, scale) if metric != "dot" else None
        if cell is None:
            begins, width = [0], min(max(_FIRST_SLICE, 4 * k), step)
            while begins[-1] + width < len(ids):
                begins.append(begins[-1] + width)
                width = min(2 * width, step)
            order = np.argsort(-size, kind="stable")
        else:  # longest first inside a cell
            order = np.lexsort((-size, cell))
            ends = np.append(np.flatnonzero(np.diff(cell[order])) + 1, len(ids))
            begins = [at for lo, hi in zip(np.append(0, ends[:-1]), ends) for at in range(lo, hi, step)]
        self.bounds = np.append(begins, len(ids))
        # longest first; inside a slice by id, so that ties go to the smaller id
        order = order[np.lexsort((ids[order], np.repeat(np.arange(len(begins)), np.diff(self.bounds))))]
        self.ids, self.matrix, self.size = ids[order], matrix[order], size[order]
        if metric == "cosine":
            self.matrix /= scale[order, None]
        self.place = np.empty(len(ids), np.int64)
        self.place[order] = np.arange(len(ids))
        # Rounded, with half of the squared length as one more column: scores below the k-th best are told by these alone.
        self.near = None
        top = size.max(initial=0.0)
        if metric != "dot" and clip is None and top <= _NEAR_LENGTH:  # false for what is not a number
            half = (self.size**2 / -2.0)[:, None] if metric == "euclidean" else np.zeros((len(ids), 0))
            self.near = np.hstack((self.matrix, half)).astype(np.float32)
            self.top_length = top
        self.longest, self.shortest = np.maximum.reduceat(self.size, begins), np.minimum.reduceat(self.size, begins)
        self.centres = None
        if cell is not None:
            self.centres = np.add.reduceat(self.matrix, begins, axis=0) / np.diff(self.bounds)[:, None]
            self.radius = np.array([np.linalg.norm(self.matrix[lo:hi] - c, axis=1).max() for lo, hi, c in zip(self.bounds, self.bounds[1:], self.centres)])

    def _cells(self, matrix: np.ndarray, scale: np.ndarray) -> np.ndarray | None:
        """Cell of each item, or None: few items, or no cells that are tight enough to pass over."""
        if len(matrix) < 2 * _CELL_ROWS or not np.isfinite(scale).all():
            return None
        at = np.linspace(0, len(matrix) - 1, min(len(matrix), _PIVOT_ROWS)).astype(np.int64)
        unit = self.metric == "cosine"
        centres = _pivots(matrix[at] / scale[at, None] if unit else matrix[at], min(len(matrix) // _CELL_ROWS, _BLOCK_CELLS))
        if centres is None:
            return None
        return np.concatenate([
            _nearest(matrix[lo : lo + _GATHER_CHUNK] / scale[lo : lo + _GATHER_CHUNK, None] if unit else matrix[lo : lo + _GATHER_CHUNK], centres)
            for lo in range(0, len(matrix), _GATHER_CHUNK)])

    def _reach(self, q: np.ndarray, length: np.ndarray) -> np.ndarray:
        """(query, slice): no score of the slice is higher."""
        if self.metric == "euclidean":
            gap = np.maximum(np.maximum(length[:, None] - self.longest, self.shortest - length[:, None]), 0.0)
            reach = -(gap**2) * (1 - 1e-9) + 1e-9
        else:
            reach = (self.longest if self.metric == "cosine" else length[:, None] * self.longest) * (1 + 1e-9) + 1e-9
            reach = np.broadcast_to(reach, (len(length), len(self.longest)))
        if self.centres is not None:
            reach = np.minimum(reach, _cell_reach(q, length, self.centres, self.radius, self.metric))
        return reach if self.clip is None else np.clip(reach, *self.clip)

    def _scores(self, q: np.ndarray, length: np.ndarray, lo: int, hi: int) -> np.ndarray:
        s = q @ self.matrix[lo:hi].T
        if self.metric == "euclidean":
            s = np.minimum(2.0 * s - self.size[None, lo:hi] ** 2 - length[:, None] ** 2, 0.0)
        return s if self.clip is None else np.clip(s, *self.clip, out=s)

    def _near_bound(self, length: np.ndarray, floor: np.ndarray) -> np.ndarray:
        """For each query: rounded scores below are certainly below the floor."""
        top = self.top_length if self.metric == "euclidean" else 1.0 + 1e-9
        error = (self.matrix.shape[1] + 16) * 2.0**-23 * (length * top + top * top + 1e-30)
        return ((floor + length**2) / 2.0 if self.metric == "euclidean" else floor) - error

    def _ahead_by_near(self, q, near, length, last, last_item, who, at, lo: int, hi: int):
        """As ``_ahead``, from the scores of the few items that their rounded scores do not rule out; None for many."""
        ids = self.ids[lo:hi]
        floor = last - np.where(last_item < ids[0], -0.4, 0.6) * 10.0**-SCORE_DECIMALS
        s = near @ self.near[lo:hi].T
        s[who, at] = -np.inf
        flat = np.flatnonzero(s >= self._near_bound(length, floor).astype(np.float32)[:, None])
        if len(flat) > s.size // 32:
            return None
        row, at = np.divmod(flat, hi - lo)
        exact = np.einsum("ij,ij->i", q[row], self.matrix[lo + at])
        if self.metric == "euclidean":
            exact = np.minimum(2.0 * exact - self.size[lo + at] ** 2 - length[row] ** 2, 0.0)
        keep = exact >= floor[row]
        return self._lists(row[keep], exact[keep], ids[at[keep]], len(q))

    @staticmethod
    def _lists(row, score, item, n: int):
        """(queries, scores, items) as rows of equal length, padded with -inf; row is sorted."""
        counts = np.bincount(row, minlength=n)
        rows = np.flatnonzero(counts)
        counts = counts[rows]
        width = counts.max(initial=0)
        best, found = np.full((len(rows), width), -np.inf), np.full((len(rows), width), np.iinfo(np.int64).max)
        line = np.repeat(np.arange(len(rows)), counts)
        column = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
        best[line, column], found[line, column] = np.round(score, SCORE_DECIMALS) + 0.0, item
        return rows, best, found

    def alike(self, q: np.ndarray) -> np.ndarray | None:
        """An order of queries in which those of one cell are neighbours; None without cells."""
        if self.centres is None:
            return None
        return np.argsort(_nearest(_unit(q) if self.metric == "cosine" else q, self.centres), kind="stable")

    def top(self, keys, q, mask_row, mask_pos, floor=-np.inf):
        """Arrays (key, item, score, rank); masked cells never come out, nor what is below the floor of its query."""
        if self.metric == "cosine":
            q = _unit(q)
        length = np.linalg.norm(q, axis=1)
        hidden = self.place[mask_pos]
        order = np.argsort(hidden, kind="stable")
        hidden, hidden_row = hidden[order], mask_row[order]
        score = np.full((len(q), self.k), -np.inf)
        item = np.full((len(q), self.k), np.iinfo(np.int64).max)
        reach = self._reach(q, length)
        near = None
        if self.near is not None and length.max(initial=0.0) <= _NEAR_LENGTH:
            near = np.hstack((q, np.ones((len(q), self.near.shape[1] - q.shape[1])))).astype(np.float32)
        parts = np.arange(len(self.longest))
        if self.metric == "euclidean" or self.centres is not None:  # slices near the queries first
            parts = parts[np.argsort(-reach.mean(axis=0), kind="stable")]
        for part in parts:
            lo, hi = self.bounds[part], self.bounds[part + 1]
            need = reach[:, part] >= np.maximum(score[:, -1], floor)
            if not need.any():
                if self.metric == "euclidean" or self.centres is not None:
                    continue
                break  # shorter vectors reach less
            a, b = np.searchsorted(hidden, (lo, hi))
            who, at = hidden_row[a:b], hidden[a:b] - lo
            some = np.flatnonzero(need) if self.centres is not None and not need.all() else np.arange(len(q))
            if len(some) < len(q):
                who, at = (np.cumsum(need) - 1)[who[need[who]]], at[need[who]]
            ahead = None
            if near is not None and np.isfinite(score[some, -1]).all():
                ahead = self._ahead_by_near(q[some], near[some], length[some], score[some, -1], item[some, -1], who, at, lo, hi)
            if ahead is None:
                s = self._scores(q[some], length[some], lo, hi)
                s[who, at] = -np.inf
                ahead = self._ahead(s, score[some, -1], item[some, -1], lo, hi)
            rows, best, found = ahead
            rows = some[rows]
            both, ids = np.hstack((score[rows], best)), np.hstack((item[rows], found))
            first = np.lexsort((ids, -both))[:, : self.k]
            score[rows], item[rows] = np.take_along_axis(both, first, 1), np.take_along_axis(ids, first, 1)
        self.last = score[:, -1]
        row, rank = np.nonzero((score > -np.inf) & (score >= np.reshape(floor, (-1, 1))))
        return [keys[row], item[row, rank], score[row, rank], rank + 1]

    def _ahead(self, s, last, last_item, lo: int, hi: int):
        """(queries, scores, items) of a slice that may be ahead of the k-th best so far, padded with -inf."""
        ids = self.ids[lo:hi]
        # Of rounded scores, an equal one is ahead only if its id is the smaller.
        slack = np.where(last_item < ids[0], -0.4, 0.6) * 10.0**-SCORE_DECIMALS
        row, at = np.nonzero(s >= (last - slack)[:, None]) if np.isfinite(last).any() else (None, None)
        if row is None or len(row) > s.size // 8:
            best, at = _best(np.round(s, SCORE_DECIMALS) + 0.0, self.k)
            return slice(None), best, ids[at]
        counts = np.bincount(row, minlength=len(s))
        rows = np.flatnonzero(counts)
        counts = counts[rows]
        width = counts.max(initial=0)
        if len(rows) * width > s.size // 4:
            best, at = _best(np.round(s, SCORE_DECIMALS) + 0.0, self.k)
            return slice(None), best, ids[at]
        return self._lists(row, s[row, at], ids[at], len(s))


def _best(s: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k largest of each row and their columns; of equal ones the leftmost."""
    n = s.shape[1]
    if n <= k:
        return s, np.broadcast_to(np.arange(n), s.shape)
    bound = np.partition(s, n - k, axis=1)[:, n - k, None]
    keep = s >= bound
    if (keep.sum(axis=1) > k).any():
        more, equal = s > bound, s == bound
        keep = more | (equal & (np.cumsum(equal, axis=1) <= k - more.sum(axis=1, keepdims=True)))
    at = np.nonzero(keep)[1].reshape(len(s), k)
    return np.take_along_axis(s, at, 1), at


_TOP_SCHEMA = "key BIGINT, item BIGINT, score DOUBLE, rank INT"


def _top_batch(cols) -> pa.RecordBatch:
    types = (pa.int64(), pa.int64(), pa.float64(), pa.int32())
    return pa.RecordBatch.from_arrays(
        [pa.array(c, type=t) for c, t in zip(cols, types)], names=["key", "item", "score", "rank"]
    )


def _vec_batch(keys, matrix) -> pa.RecordBatch:
    offsets = np.arange(0, matrix.size + 1, matrix.shape[1], dtype=np.int32)
    vec = pa.ListArray.from_arrays(pa.array(offsets), pa.array(matrix.ravel()))
    return pa.RecordBatch.from_arrays([pa.array(keys, type=pa.int64()), vec], names=["key", "vec"])


# Widest vectors summed as one generated-code sum per element.
_WIDE = 64


def sum_vectors(df: DataFrame, key: str, vec: str, dims: int | None = None) -> DataFrame:
    """Element-wise sum of an array column per key (JVM-side, partial aggregation).

    Short vectors of known width are plain sums; others use the ML summarizer.
    """
    if dims is not None and dims <= _WIDE:
        sums = df.groupBy(key).agg(*[F.expr(f"sum({vec}[{i}]) AS __{i}") for i in range(dims)])
        return sums.select(key, F.array(*[f"__{i}" for i in range(dims)]).alias(vec))
    summed = df.groupBy(key).agg(Summarizer.sum(array_to_vector(F.col(vec))).alias(vec))
    return summed.select(key, vector_to_array(vec).alias(vec))


def weighted_sums(
    entries: DataFrame, vectors: DataFrame, layout: Layout, salt: int = 1
) -> DataFrame:
    """Sparse times dense: (key, item, weight) x (item, vec) -> (key, vec).

    ``salt`` spreads the entries of one key over that many shards; the partial
    sums are then added. Keys without a known item do not appear.
    """
    layout = _for_entries(layout, entries.sparkSession)
    shard_key = F.col("key") if salt == 1 else F.concat_ws(
        ":", F.col("key").cast("string"), F.pmod(F.xxhash64("item"), F.lit(salt)).cast("string")
    )
    rows = entries.select(
        F.col("key").cast("bigint").alias("key"), F.col("item").cast("bigint").alias("item"),
        F.col("weight").cast("double").alias("weight"), shard_key.alias("shard_key"),
        F.lit(None).cast("array<double>").alias("vec"),
    )
    # A shard row only belongs to the block its item is in: no replication here.
    rows = rows.withColumn("block", _bucket("item", layout.blocks))
    items = vectors.select(F.col("item").cast("bigint").alias("item"), "vec")
    tiles = _to_tiles(items, rows, layout, {"weight": "double"})

    def kernel(batches):
        for _, ids, matrix, rest in _read_tiles(batches):
            for g in _complete_groups(rest, ["key", "item", "weight"]):
                pos, known = _positions(ids, g["item"])
                key, pos, weight = g["key"][known], pos[known], g["weight"][known]
                if not len(key):
                    continue
                starts = _segments(key)
                for lo in range(0, len(starts), _QUERY_CHUNK):
                    hi = starts[lo + _QUERY_CHUNK] if lo + _QUERY_CHUNK < len(starts) else len(key)
                    a = starts[lo]
                    seg = starts[lo : lo + _QUERY_CHUNK] - a
                    yield _vec_batch(key[a:hi][seg], _segment_sums(matrix, pos[a:hi], weight[a:hi], seg))

    partial = tiles.mapInArrow(kernel, "key BIGINT, vec ARRAY<DOUBLE>")
    return partial if layout.blocks == 1 and salt == 1 else sum_vectors(partial, "key", "vec", layout.dims)


def top_k(
    queries: DataFrame,
    vectors: DataFrame,
    k: int,
    layout: Layout,
    metric: str = "cosine",
    exclude_self: bool = False,
    seen: DataFrame | None = None,
    clip: tuple[float, float] | None = None,
    by_cell: bool = False,
) -> DataFrame:
    """Best k items per query: (key, vec) x (item, vec) -> (key, item, score, rank).

    ``seen`` (key, item) pairs are never returned; ``exclude_self`` drops
    item = key. Each block masks its own seen items, so its k best are enough.
    ``by_cell``, for distinct keys: blocks follow the cells of the vectors, if there are any.
    """
    queries = queries.select(F.col("key").cast("bigint").alias("key"), "vec")
    items = vectors.select(F.col("item").cast("bigint").alias("item"), "vec")
    if by_cell and layout.blocks > 1 and seen is None and clip is None and metric != "dot":
        cells = _plan_cells(items, layout, metric)
        if cells is not None:
            return _top_k_by_cell(queries, items, k, cells, metric, exclude_self)
    q = _spread(queries, "block", layout.blocks)
    if seen is None:
        q = q.withColumn("mask", F.array().cast("array<bigint>"))
    else:
        # Bounded: seen pairs are distinct and one block holds a bounded number of items.
        masks = (
            seen.select(F.col("key").cast("bigint").alias("key"), F.col("item").cast("bigint").alias("item"))
            .withColumn("block", _bucket("item", layout.blocks))
            .groupBy("key", "block").agg(F.collect_set("item").alias("mask"))
        )
        q = q.join(masks, ["key", "block"], "left").withColumn(
            "mask", F.coalesce("mask", F.array().cast("array<bigint>"))
        )
    rows = q.select("key", F.col("key").alias("item"), "vec", "mask", "block", F.col("key").alias("shard_key"))
    tiles = _to_tiles(items, rows, layout, {"mask": "array<bigint>"})

    def kernel(batches):
        for _, ids, matrix, rest in _read_tiles(batches):
            scorer = _Scorer(ids, matrix, metric, k, clip)
            del matrix  # the scorer has its own order of it
            for keys, q, part in _query_chunks(rest, scorer):
                lists = part.column("mask")
                counts = lists.value_lengths().to_numpy(zero_copy_only=False)
                mask_row = np.repeat(np.arange(len(keys)), counts)
                masked = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                if exclude_self:
                    mask_row = np.append(mask_row, np.arange(len(keys)))
                    masked = np.append(masked, keys)
                pos, known = _positions(ids, masked)
                yield _top_batch(scorer.top(keys, q, mask_row[known], pos[known]))

    return _merge(tiles.mapInArrow(kernel, _TOP_SCHEMA), k, layout)


def _query_chunks(batches, scorer: _Scorer):
    """(keys, vectors, rows) of chunks of queries, those of one cell together."""
    for batch in batches:
        order = scorer.alike(_matrix(batch.column("vec")))
        if order is not None:
            batch = batch.take(pa.array(order))
        for lo in range(0, batch.num_rows, _QUERY_CHUNK):
            part = batch.slice(lo, _QUERY_CHUNK)
            yield part.column("key").to_numpy(), _matrix(part.column("vec")), part


@dataclass(frozen=True)
class _Cells:
    """Cells around centres; those that follow each other share a block, one that is too large has several blocks."""

    layout: Layout
    centres: np.ndarray
    radius: np.ndarray
    first: np.ndarray  # first block of each cell
    parts: np.ndarray  # its blocks

    def blocks(self, cell: np.ndarray, ids: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            mixed = ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)
        return self.first[cell] + (mixed % self.parts[cell].astype(np.uint64)).astype(np.int64)

    def members(self) -> np.ndarray:
        """(cell, block): 1 where the block has items of the cell."""
        out = np.zeros((len(self.first), self.layout.blocks), np.float32)
        for c, (a, n) in enumerate(zip(self.first, self.parts)):
            out[c, a : a + n] = 1
        return out


def _plan_cells(items: DataFrame, layout: Layout, metric: str) -> _Cells | None:
    """Cells of the item side, their radii and blocks of about equal size, or None if the vectors lie in no cells.

    Centres come from _PIVOT_ROWS vectors; every vector is then assigned and measured, so the choice
    of the centres changes no result.
    """
    sample = items.orderBy(F.xxhash64("item"), "item").limit(_PIVOT_ROWS).select("vec").toArrow().column("vec").combine_chunks()
    if not len(sample):
        return None
    points = _unit(_matrix(sample)) if metric == "cosine" else _matrix(sample)
    centres = _pivots(points, min(_LAYOUT_CELLS * layout.blocks, _MOST_CELLS, -(-len(points) // 4)))
    if centres is None:
        return None
    order = [0]  # each cell is followed by the nearest one left
    between = _square_distances(centres, centres)
    while len(order) < len(centres):
        between[:, order[-1]] = np.inf
        order.append(int(between[order[-1]].argmin()))
    centres = centres[order]

    def measure(batches):
        for batch in batches:
            if batch.num_rows:
                m = _unit(_matrix(batch.column("vec"))) if metric == "cosine" else _matrix(batch.column("vec"))
                cell = _nearest(m, centres)
                far = np.linalg.norm(m - centres[cell], axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(far)], names=["cell", "far"])

    sizes = items.select("vec").mapInArrow(measure, "cell BIGINT, far DOUBLE").groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("far").alias("far")).collect()
    n, radius = np.zeros(len(centres), np.int64), np.zeros(len(centres))
    for row in sizes:  # a row per cell
        n[row["cell"]], radius[row["cell"]] = row["n"], row["far"]
    if not np.isfinite(radius).all():
        return None
    most = max(-(-int(n.sum()) // layout.blocks), 1)
    first, parts = np.zeros(len(centres), np.int64), np.maximum(-(-n // most), 1)
    block, room = -1, 0
    for c, size in enumerate(n):
        if size > room:
            block, room = block + 1, most
        first[c] = block
        room -= size
        if parts[c] > 1:
            block, room = block + int(parts[c]) - 1, 0
    blocks = max(block + 1, 1)
    return _Cells(Layout(max(1, -(-layout.tiles // blocks)), blocks), centres, radius, first, parts)


def _top_k_by_cell(queries: DataFrame, items: DataFrame, k: int, cells: _Cells, metric: str, exclude_self: bool) -> DataFrame:
    """``top_k`` in two steps: each query in the block of its own cell, then in the blocks that its k-th best score does
    not rule out. Keys are distinct."""
    centres, radius, members = cells.centres, cells.radius, cells.members()

    def placed(name):
        def run(batches):
            for batch in batches:
                if batch.num_rows:
                    ids, m = batch.column(name).to_numpy(), _matrix(batch.column("vec"))
                    block = cells.blocks(_nearest(_unit(m) if metric == "cosine" else m, centres), ids)
                    yield pa.RecordBatch.from_arrays([batch.column(name), batch.column("vec"), pa.array(block, pa.int32())], names=[name, "vec", "block"])
        return run

    items = items.mapInArrow(placed("item"), "item BIGINT, vec ARRAY<DOUBLE>, block INT")
    homes = queries.mapInArrow(placed("key"), "key BIGINT, vec ARRAY<DOUBLE>, block INT")

    def step(rows, further: bool):
        tiles = _to_tiles(items, rows.select("key", F.col("key").alias("item"), "vec", "block", "floor", F.col("key").alias("shard_key")),
                          cells.layout, {"floor": "double"})

        def kernel(batches):
            for tile, ids, matrix, rest in _read_tiles(batches):
                scorer = _Scorer(ids, matrix, metric, k, None)
                del matrix
                for keys, q, part in _query_chunks(rest, scorer):
                    pos, known = _positions(ids, keys)
                    known &= exclude_self
                    floor = part.column("floor").to_numpy()
                    yield _top_batch(scorer.top(keys, q, np.flatnonzero(known), pos[known], floor))
                    if further:
                        unit = _unit(q) if metric == "cosine" else q
                        reach = _cell_reach(unit, np.linalg.norm(unit, axis=1), centres, radius, metric)
                        more = (reach >= scorer.last[:, None]).astype(np.float32) @ members > 0
                        more[:, tile % cells.layout.blocks] = False
                        row, block = np.nonzero(more)
                        yield _top_batch([keys[row], block, scorer.last[row], np.zeros(len(row))])

        return tiles.mapInArrow(kernel, _TOP_SCHEMA)

    # Rank 0: a block to go on to.
    found = cut_lineage(step(homes.withColumn("floor", F.lit(float("-inf"))), True))
    lists, more = found.where("rank > 0"), found.where("rank = 0").select("key", F.col("item").cast("int").alias("block"), F.col("score").alias("floor"))
    if more.isEmpty():
        return lists
    again = step(queries.join(more.hint("merge"), "key"), False)
    return top_per_group(lists.unionByName(again).drop("rank"), ["key"], [F.desc("score"), F.asc("item")], k)


def _merge(found: DataFrame, k: int, layout: Layout) -> DataFrame:
    if layout.blocks == 1:
        return found
    return top_per_group(found.drop("rank"), ["key"], [F.desc("score"), F.asc("item")], k)


def _profile_weights(rating, starts, strategy: str) -> np.ndarray:
    """Rating weights inside each segment of one user's rated items."""
    counts = np.diff(np.append(starts, len(rating)))
    total = np.add.reduceat(rating, starts)
    if strategy == "weighted":
        return rating / np.repeat(np.where(total == 0, 1.0, total), counts)
    flat = np.maximum.reduceat(rating, starts) == np.minimum.reduceat(rating, starts)
    centred = rating - np.repeat(total / counts, counts)
    return np.where(np.repeat(flat, counts), np.repeat(1.0 / counts, counts), centred)


def recommend_one_block(
    ratings: DataFrame, vectors: DataFrame, k: int, layout: Layout, metric: str, strategy: str
) -> DataFrame:
    """Profile, score, mask and top-k in one pass over (key, item, weight) ratings.

    Only for a one-block layout: a user's rated items are all in the tile, so the
    profile vectors never leave the task.
    """
    layout = _for_entries(layout, ratings.sparkSession)
    rows = ratings.select(
        F.col("key").cast("bigint").alias("key"), F.col("item").cast("bigint").alias("item"),
        F.col("weight").cast("double").alias("weight"), F.col("key").alias("shard_key"),
        F.lit(0).alias("block"), F.lit(None).cast("array<double>").alias("vec"),
    )
    items = vectors.select(F.col("item").cast("bigint").alias("item"), "vec")
    tiles = _to_tiles(items, rows, layout, {"weight": "double"})

    def kernel(batches):
        for _, ids, matrix, rest in _read_tiles(batches):
            scorer = _Scorer(ids, matrix, metric, k, None)
            for g in _complete_groups(rest, ["key", "item", "weight"]):
                pos, known = _positions(ids, g["item"])
                key, pos, rating = g["key"][known], pos[known], g["weight"][known]
                if not len(key):
                    continue
                starts = _segments(key)
                weight = _profile_weights(rating, starts, strategy)
                for lo in range(0, len(starts), _QUERY_CHUNK):
                    hi = starts[lo + _QUERY_CHUNK] if lo + _QUERY_CHUNK < len(starts) else len(key)
                    a = starts[lo]
                    seg = starts[lo : lo + _QUERY_CHUNK] - a
                    profile = _segment_sums(matrix, pos[a:hi], weight[a:hi], seg)
                    owner = np.repeat(np.arange(len(seg)), np.diff(np.append(seg, hi - a)))
                    yield _top_batch(scorer.top(key[a:hi][seg], profile, owner, pos[a:hi]))

    return tiles.mapInArrow(kernel, _TOP_SCHEMA)
