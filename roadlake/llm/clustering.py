"""Centroid clustering of integer vectors with Hilbert-ordered zone maps.

Vectors are sorted by their place on a Hilbert curve and cut into blocks that
store the smallest box around them, their sum and their number.  In a round,
the box alone tells which centroids can be nearest to a vector of the block: a
centroid is no candidate if another one is nearer in every point of the box.
Blocks with one candidate give their stored sum; the others are compared with
their candidates in whole arrays of exact integers.  A round brings the driver
k sums, never a vector.

Results that the data leave open: a vector takes part if it has exactly the
wanted number of components and none is null, NaN or infinite; other vectors
have no row.  Components beyond 2**62 count as 2**62, distances beyond a long
as the largest long.  Repeated rows are vectors of their own.  Rows with a null
id take part but start no centroid while others are left.  An empty table gives
no rows.  Other columns stay behind.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadlake.llm.common import map_batches, store

BLOCK = 256
BITS = 4
_LIMIT = 2**62
_LONG = 2**63 - 1
#: Up to here squares and sums of 64 components and more stay exact in doubles.
_EXACT = 2**22


def hilbert_keys(cells: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Place on the Hilbert curve of each row of ``cells`` (n, dims), as rows of big-endian bytes.

    Coordinates are below 2**bits.  Skilling's transform, a dimension at a time
    for all rows: undo the rotations from the highest bit down, then Gray code.
    """
    x = np.ascontiguousarray(cells.T, dtype=np.int64).copy()
    dims = len(x)
    for bit in range(bits - 1, 0, -1):
        low = (1 << bit) - 1
        for i in range(dims):
            flip = (x[i] >> bit) & 1
            swap = np.where(flip, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(flip, low, swap)
            if i:
                x[i] ^= swap
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    for bit in range(bits - 1, 0, -1):
        turn ^= np.where((x[-1] >> bit) & 1, (1 << bit) - 1, 0)
    x ^= turn
    planes = (x[None] >> np.arange(bits - 1, -1, -1)[:, None, None]) & 1
    return np.packbits(planes.reshape(bits * dims, -1).T.astype(np.uint8), axis=1)


def grid(vectors: np.ndarray, centre: np.ndarray, spread: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Cells of 2**bits levels a dimension, two spreads to either side of the centre."""
    half = 2 ** (bits - 1)
    return np.clip(np.floor((vectors - centre) / spread * (half / 2)) + half, 0, 2 * half - 1).astype(np.int64)


def candidates(low: np.ndarray, high: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """(boxes, k): whether a centroid can be nearest to a point of the box.

    The distance to centroid i less that to the centroid nearest to the middle
    of the box is linear, so its least value is in a corner; above zero, i is
    farther in the whole box.
    """
    sizes = (centroids * centroids).sum(axis=1)
    near = (sizes - (low + high) @ centroids.T).argmin(axis=1)
    best = centroids[near]  # (boxes, dims)
    found = np.empty((len(low), len(centroids)), bool)
    for i, c in enumerate(centroids):
        slope = 2 * (best - c)
        least = np.where(slope > 0, slope * low, slope * high).sum(axis=1) + sizes[i] - sizes[near]
        found[:, i] = least <= 0
    return found


def distances(vectors: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared distances (n, k) as exact integers, Python's own where they pass the doubles."""
    if max(np.abs(vectors).max(initial=0), max((abs(int(c)) for c in centroids.flat), default=0)) <= _EXACT:
        v, c = vectors.astype(np.float64), centroids.astype(np.float64)
        return ((v * v).sum(axis=1)[:, None] - 2 * (v @ c.T) + (c * c).sum(axis=1)).astype(np.int64)
    wide = vectors.astype(object)
    return np.stack([((wide - c.astype(object)) ** 2).sum(axis=1) for c in centroids], axis=1)


def _packed(v: np.ndarray) -> bytes:
    return v.astype(np.int32 if np.abs(v).max(initial=0) < 2**31 else np.int64).tobytes()


def _unpacked(data: bytes, n: int, dims: int) -> np.ndarray:
    return np.frombuffer(data, np.int32 if len(data) == 4 * n * dims else np.int64).reshape(n, dims).astype(np.int64)


def integers(vectors: DataFrame, dims: int, scale: int = 1024) -> DataFrame:
    """(vec_id, v): floor(scale * component) of the vectors that take part."""
    e = F.col("embedding").cast("array<double>")
    odd = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    whole = lambda x: F.greatest(F.least(F.floor(x * scale).cast("long"), F.lit(_LIMIT)), F.lit(-_LIMIT))
    return (
        vectors.select(F.col("vec_id").cast("long").alias("vec_id"), e.alias("e"))
        .where((F.size("e") == dims) & ~F.exists("e", odd))
        .select("vec_id", F.transform("e", whole).alias("v"))
    )


def _matrix(column: pa.ListArray, dims: int) -> np.ndarray:
    return column.flatten().to_numpy().reshape(-1, dims)


def _spread(whole: DataFrame, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """Mean and standard deviation of each component; they only steer the order of the blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = _matrix(batch.column("v"), dims).astype(np.float64)
            parts = [np.full(dims, float(len(v))), v.sum(axis=0), (v * v).sum(axis=0)]
            yield pa.record_batch([pa.array(range(dims)), *map(pa.array, parts)], ["i", "n", "s", "q"])

    sums = map_batches(whole.select("v"), run, "i long, n double, s double, q double")
    rows = sums.groupBy("i").agg(*(F.sum(c).alias(c) for c in "nsq")).collect()
    centre, spread = np.zeros(dims), np.ones(dims)
    for r in rows:
        centre[r.i] = r.s / r.n
        spread[r.i] = max(r.q / r.n - centre[r.i] ** 2, 1.0) ** 0.5
    return centre, spread


def zone_maps(whole: DataFrame, dims: int, block: int = BLOCK) -> DataFrame:
    """(n, ids, data, low, high, total): Hilbert-ordered blocks of ``whole``, stored."""
    centre, spread = _spread(whole, dims)

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = _matrix(batch.column("v"), dims)
            keys = hilbert_keys(grid(v, centre, spread))
            yield pa.record_batch(
                [batch.column("vec_id"), pa.array([_packed(x) for x in v], pa.binary()), pa.array([k.tobytes() for k in keys], pa.binary())],
                ["vec_id", "v", "key"],
            )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list = []
        rows: list = []

        def flush() -> pa.RecordBatch:
            v = np.concatenate([_unpacked(x, 1, dims) for x in rows])
            low, high, total = v.min(axis=0), v.max(axis=0), v.astype(object).sum(axis=0)
            return pa.record_batch(
                [
                    pa.array([len(v)], pa.int64()),
                    pa.array([list(ids)], pa.list_(pa.int64())),
                    *(pa.array([x], pa.binary()) for x in (_packed(v), low.tobytes(), high.tobytes())),
                    pa.array([[Decimal(int(t)) for t in total]], pa.list_(pa.decimal128(38, 0))),
                ],
                ["n", "ids", "data", "low", "high", "total"],
            )

        for batch in batches:
            for i, x in zip(batch.column("vec_id").to_pylist(), batch.column("v").to_pylist(), strict=True):
                ids.append(i)
                rows.append(x)
                if len(rows) == block:
                    yield flush()
                    ids.clear()
                    rows.clear()
        if rows:
            yield flush()

    ordered = (
        map_batches(whole, keyed, "vec_id long, v binary, key binary")
        .withColumn("salt", F.monotonically_increasing_id())  # copies of one vector may fill many tasks
        .repartitionByRange("key", "salt")
        .sortWithinPartitions("key", "salt")
        .drop("key", "salt")
    )
    schema = "n long, ids array<long>, data binary, low binary, high binary, total array<decimal(38,0)>"
    return store(map_batches(ordered, cut, schema))


def _assigned(batch: pa.RecordBatch, centroids: np.ndarray, measure: bool) -> Iterator[tuple]:
    """(row, vectors or None, numbers of the nearest centroids, distances or None) of each block.

    Blocks with one candidate are not looked at unless distances are wanted.
    """
    dims = centroids.shape[1]
    n = batch.column("n").to_pylist()
    box = [
        np.frombuffer(b"".join(batch.column(c).to_pylist()), np.int64).reshape(-1, dims) for c in ("low", "high")
    ]
    narrow = (np.abs(box[0]).max(axis=1) <= _EXACT) & (np.abs(box[1]).max(axis=1) <= _EXACT)
    possible = np.ones((len(n), len(centroids)), bool)
    if all(abs(int(c)) <= _EXACT for c in centroids.flat):
        short = centroids.astype(np.int64)
        possible[narrow] = candidates(box[0][narrow], box[1][narrow], short)
    for i, data in enumerate(batch.column("data")):
        open_ = np.flatnonzero(possible[i])
        if len(open_) == 1 and not measure:
            yield i, None, open_, None
            continue
        v = _unpacked(data.as_py(), n[i], dims)
        d = distances(v, centroids[open_])
        at = d.argmin(axis=1)  # the smallest number of those at the same distance
        yield i, v, open_[at], d[np.arange(len(v)), at]


def _round(blocks: DataFrame, centroids: np.ndarray, measure: bool = False) -> dict[int, tuple[int, list[int], int]]:
    """Of each non-empty cluster: (vectors, componentwise sums, summed distances if wanted)."""
    k, dims = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, sums, spread = [0] * k, np.zeros((k, dims), object), [0] * k
        for batch in batches:
            for i, v, at, d in _assigned(batch, centroids, measure):
                if v is None:
                    count[at[0]] += batch.column("n")[i].as_py()
                    sums[at[0]] += np.array([int(t) for t in batch.column("total")[i].as_py()], object)
                    continue
                safe = np.abs(v).max(initial=0) <= _EXACT
                for c in np.unique(at):
                    mine = at == c
                    count[c] += int(mine.sum())
                    part = v[mine].sum(axis=0) if safe else v[mine].astype(object).sum(axis=0)
                    sums[c] += part.astype(object)
                    spread[c] += sum(map(int, d[mine])) if measure else 0
        rows = [c for c in range(k) if count[c]]
        cells = [[count[c], *sums[c], spread[c]] for c in rows]
        yield pa.record_batch(
            [
                pa.array([c for c in rows for _ in range(dims + 2)], pa.int64()),
                pa.array([i for _ in rows for i in range(dims + 2)], pa.int64()),
                pa.array([Decimal(int(x)) for row in cells for x in row], pa.decimal128(38, 0)),
            ],
            ["cluster", "i", "x"],
        )

    parts = map_batches(blocks, run, "cluster long, i long, x decimal(38,0)")
    found = {(r.cluster, r.i): int(r.x) for r in parts.groupBy("cluster", "i").agg(F.sum("x").alias("x")).collect()}
    return {
        c: (found[c, 0], [found[c, i] for i in range(1, dims + 1)], found[c, dims + 1])
        for c in {c for c, _ in found}
    }


def start(whole: DataFrame, k: int, seed: int) -> np.ndarray:
    """The ``k`` vectors of smallest SHA-256 of ``seed:vec_id``; equal ids by their components."""
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    rows = whole.orderBy(order.asc_nulls_last(), "v").limit(k).collect()
    return np.array([r.v for r in rows], object)


def cluster(
    vectors: DataFrame, k: int = 8, rounds: int = 10, dims: int = 64, seed: int = 3, block: int = BLOCK
) -> DataFrame:
    """Lloyd's rounds on floor(1024 * component): (vec_id, cluster, distance, cluster_inertia, inertia,
    centroid_sha256), one row per vector that takes part."""
    schema = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    whole = integers(vectors, dims)
    centroids = start(whole, k, seed)
    if not len(centroids):
        return vectors.sparkSession.createDataFrame([], schema)
    blocks = zone_maps(whole, dims, block)
    for _ in range(rounds):
        for c, (n, sums, _) in _round(blocks, centroids).items():
            centroids[c] = [s // n for s in sums]
    spread = {c: x for c, (_, _, x) in _round(blocks, centroids, measure=True).items()}
    total = min(sum(spread.values()), _LONG)
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("ids")
            for i, _, at, d in _assigned(batch, centroids, measure=True):
                yield pa.record_batch(
                    [
                        ids[i].values,
                        pa.array(at, pa.int32()),
                        pa.array([min(int(x), _LONG) for x in d], pa.int64()),
                        pa.array([min(spread[c], _LONG) for c in at], pa.int64()),
                        pa.array([total] * len(at), pa.int64()),
                        pa.array([digest[c] for c in at]),
                    ],
                    ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"],
                )

    return map_batches(blocks, run, schema)
