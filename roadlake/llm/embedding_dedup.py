"""Embedding near-dedup by sorted projection passes.

In several passes distinct vectors are sorted by the bits of random hyperplanes,
put together as one key, and each is compared with its neighbours in a bounded
window of that order; pairs at or above the cosine threshold are united across
passes.  Vectors that share a pass's leading bits are neighbours in its order.  A
pair at the threshold shares them with a probability that depends on its angle
and the number of bits only, not on the other vectors; the passes follow from it
and the recall wanted.  The number of bits is the one of least work, by the
measured sizes of the groups of equal leading bits, of those whose groups fit the
window.  A group that is wider than the window nevertheless, or that a border of
the range partitions cuts, is compared in full, in pairs of blocks of bounded
size: the exact rest, so crowded vectors lose nothing.  The links inside a
component are then counted exactly, in the same blocks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadlake.llm.common import map_batches, store, union_pairs
from roadlake.llm.components import connected_components

BITS = 64
MOST_BITS = 48  # above, passes are thousands


def passes_for(bits: int, threshold: float, recall: float) -> int:
    """Passes after which a pair at the threshold has shared a bucket with this probability.

    A random hyperplane leaves a pair on one side with probability 1 - angle / pi.
    """
    once = (1 - math.acos(threshold) / math.pi) ** bits
    return 1 if once >= recall else max(1, math.ceil(math.log(1 - recall) / math.log(1 - once)))


def passes_needed(n: int, window: int, threshold: float, recall: float) -> int:
    """Passes for n evenly spread vectors, in buckets of half a window."""
    return passes_for(math.ceil(max(0.0, math.log2(max(n, 1) / window)) + 1), threshold, recall)


def _bits(first_pass: DataFrame, n: int, window: int, threshold: float, recall: float) -> int:
    """The number of leading bits with the least work: passes, times the mates in a group and a row's own window.

    Of the numbers of bits whose groups have half a window of mates or fewer for the mean row; of all if none has.
    No bits if all vectors fit one window.
    """
    if n <= window:
        return 0
    tried = F.sequence(F.lit(0), F.lit(MOST_BITS))
    sizes = (
        first_pass.groupBy("tag", "key")
        .agg(F.count("*").alias("n"))
        .select("tag", "key", "n", F.explode(tried).alias("bits"))
        .groupBy("tag", "bits", _prefix(F.col("key"), F.col("bits")).alias("prefix"))
        .agg(F.sum("n").cast("double").alias("n"))
        .groupBy("bits")
        .agg(F.sum(F.col("n") * F.col("n")).alias("pairs"))
        .collect()  # one row for each number of bits
    )
    fitting = [r for r in sizes if r.pairs / n <= window / 2] or sizes
    return min(fitting, key=lambda r: (passes_for(r.bits, threshold, recall) * (r.pairs / n + window), r.bits)).bits


def _prefix(key, bits):
    """The leading bits of a key of BITS."""
    return F.when(bits == 0, F.lit(0).cast("long")).otherwise(F.call_function("shiftrightunsigned", key, F.lit(BITS) - bits))


def _units(batch: pa.RecordBatch, column: str) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """(dimension, places in the batch, unit vectors) of a list column, by dimension."""
    lists = batch.column(column)
    size = np.diff(lists.offsets.to_numpy())
    flat = lists.values.to_numpy(zero_copy_only=False)[lists.offsets[0].as_py() :]
    at = np.r_[0, np.cumsum(size)[:-1]] if len(size) else size
    out = []
    for dim in np.unique(size).tolist():
        rows = np.flatnonzero(size == dim)
        v = flat[at[rows][:, None] + np.arange(dim)]
        v = v / np.abs(v).max(axis=1, keepdims=True)  # squares stay finite
        out.append((dim, rows, v / np.linalg.norm(v, axis=1, keepdims=True)))
    return out


def _hashes(passes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for dim, rows, unit in _units(batch, "embedding"):
                for p in range(passes):
                    if (p, dim) not in planes:
                        planes[p, dim] = np.random.default_rng((p, dim)).standard_normal((dim, BITS))
                    bits = np.packbits(unit @ planes[p, dim] > 0, axis=1)
                    key = bits.view(">u8")[:, 0].astype(np.int64)
                    tag = np.full(len(rows), p << 32 | dim)
                    yield pa.record_batch(
                        [pa.array(tag), pa.array(key), batch.column("rep").take(pa.array(rows)), batch.column("embedding").take(pa.array(rows))],
                        ["tag", "key", "rep", "embedding"],
                    )

    return run


def _by_blocks(keys: tuple[str, ...], made):
    """``made`` of each pair of blocks; rows come sorted by the keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            t = pa.Table.from_batches([batch])
            t = t if held is None else pa.concat_tables([held, t])
            k = [t.column(c).to_numpy() for c in keys]
            change = np.flatnonzero(np.logical_or.reduce([x[1:] != x[:-1] for x in k])) + 1
            cut = [0, *change.tolist()]
            for s, e in zip(cut[:-1], cut[1:], strict=True):
                yield made(t.slice(s, e - s).combine_chunks().to_batches()[0])
            held = t.slice(cut[-1])
        if held is not None:
            yield made(held.combine_chunks().to_batches()[0])

    return run


def _united(threshold: float):
    def made(b: pa.RecordBatch) -> pa.RecordBatch:
        """Ties that join what lies near in a pair of blocks, at most one a row."""
        rep, mine = (b.column(c).to_numpy(zero_copy_only=False) for c in ("rep", "block"))
        left, right = b.column("left")[0].as_py(), b.column("right")[0].as_py()
        parent = np.arange(len(rep))
        for _, rows, unit in _units(b, "embedding"):
            x, y = mine[rows] == left, mine[rows] == right
            i, j = np.nonzero(unit[x] @ unit[y].T >= threshold)
            union_pairs(parent, rows[x][i], rows[y][j])
        tied = np.flatnonzero(parent != np.arange(len(rep)))
        return pa.record_batch([pa.array(rep[tied]), pa.array(rep[parent[tied]])], ["a", "b"])

    return made


PASS_OUT = "kind int, a long, b long, tag long, key long, rep long, embedding array<double>"


def _neighbours(bits: int, window: int, threshold: float):
    """Of rows in the order of (tag, key): ties within the window (kind 0), and the rows of the groups of equal leading
    bits that are wider than the window or touch an end of the partition (kind 1)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vectors = pa.list_(pa.float64())

        def ties(rep: np.ndarray, parent: np.ndarray) -> pa.RecordBatch:
            tied = np.flatnonzero(parent != np.arange(len(rep)))
            none = pa.nulls(len(tied), pa.int64())
            columns = [pa.array(np.zeros(len(tied), np.int32)), pa.array(rep[tied]), pa.array(rep[parent[tied]]), none, none, none]
            return pa.record_batch([*columns, pa.nulls(len(tied), vectors)], ["kind", "a", "b", "tag", "key", "rep", "embedding"])

        def rest(t: pa.Table) -> pa.RecordBatch:
            none = pa.nulls(len(t), pa.int64())
            b = t.combine_chunks()
            prefix = pa.array(_leading(b.column("key").to_numpy(), bits))
            columns = [pa.array(np.ones(len(t), np.int32)), none, none, b.column("tag"), prefix, b.column("rep"), b.column("embedding")]
            flat = [c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in columns]
            return pa.record_batch(flat, ["kind", "a", "b", "tag", "key", "rep", "embedding"])

        before: pa.Table | None = None  # the block before
        group, held, size, wide = None, [], 0, True  # the group that goes on; that of the partition's start counts as wide

        def blocks() -> Iterator[pa.Table]:
            waiting: list[pa.Table] = []
            rows = 0
            for batch in batches:
                waiting.append(pa.Table.from_batches([batch]))
                rows += batch.num_rows
                if rows >= window:
                    t = pa.concat_tables(waiting)
                    whole = rows - rows % window
                    for at in range(0, whole, window):
                        yield t.slice(at, window)
                    waiting, rows = [t.slice(whole)], rows - whole
            if rows:
                yield pa.concat_tables(waiting)

        for block in blocks():
            both = (block if before is None else pa.concat_tables([before, block])).combine_chunks().to_batches()[0]
            new = both.num_rows - len(block)
            rep, tag = both.column("rep").to_numpy(), both.column("tag").to_numpy()
            parent = np.arange(len(rep))
            for _, rows, unit in _units(both, "embedding"):
                mine = rows >= new
                near = (unit[mine] @ unit.T >= threshold) & (tag[rows[mine]][:, None] == tag[rows])
                i, j = np.nonzero(near)
                union_pairs(parent, rows[mine][i], rows[j])
            yield ties(rep, parent)
            before = block
            lead = _leading(block.column("key").to_numpy(), bits)
            own = block.column("tag").to_numpy()
            cut = np.flatnonzero((lead[1:] != lead[:-1]) | (own[1:] != own[:-1])) + 1
            edges = [0, *cut.tolist(), len(block)]
            inner = edges[1:-1]
            runs = [(edges[0], edges[1])] + ([(inner[-1], edges[-1])] if inner else [])  # those between are whole and narrow
            for s, e in runs:
                name = (int(own[s]), int(lead[s]))
                if name != group:
                    group, held, size, wide = name, [], 0, group is None
                held.append(block.slice(s, e - s))
                size += e - s
                wide = wide or size > window
                if wide:
                    yield rest(pa.concat_tables(held))
                    held = []
        if held:
            yield rest(pa.concat_tables(held))

    return run


def _leading(key: np.ndarray, bits: int) -> np.ndarray:
    return (key.view(np.uint64) >> np.uint64(BITS - bits)).view(np.int64) if bits else np.zeros(len(key), np.int64)


def _count(threshold: float):
    def made(b: pa.RecordBatch) -> pa.RecordBatch:
        rep, mine, other = (b.column(c).to_numpy(zero_copy_only=False) for c in ("rep", "block", "n"))
        left, right = b.column("left")[0].as_py(), b.column("right")[0].as_py()
        links = np.zeros(len(rep), np.int64)
        for _, rows, unit in _units(b, "embedding"):
            x, y = rows[mine[rows] == left], rows[mine[rows] == right]
            ux, uy = unit[mine[rows] == left], unit[mine[rows] == right]
            near = ux @ uy.T >= threshold
            if left == right:
                np.fill_diagonal(near, False)
                links[x] = near @ other[x]
            else:
                links[x] = near @ other[y]
                links[y] = near.T @ other[x]
        return pa.record_batch([pa.array(rep), pa.array(links)], ["rep", "links"])

    return made


def _block_pairs(rows: DataFrame, keys: tuple[str, ...], block: int, *columns: str) -> DataFrame:
    """Each group's rows once for each pair of its blocks that they are part of, sorted by (keys, left, right)."""
    groups = rows.groupBy(*keys).agg(F.ceil(F.count("*") / block).cast("long").alias("blocks"))
    sized = rows.join(groups, list(keys)).withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")))
    pairs = sized.withColumn("with", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).select(
        *keys, F.least("block", "with").alias("left"), F.greatest("block", "with").alias("right"), "block", "rep", *columns
    )
    by = (*keys, "left", "right")
    return pairs.repartition(*by).sortWithinPartitions(*by)


def near_duplicates(
    vectors: DataFrame, threshold: float = 0.9, window: int = 256, recall: float = 0.995, block: int = 1024
) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept.

    n_links counts the other vectors, repeated rows included, at or above the
    threshold.  Vectors that are null, empty, zero or hold null or non-finite
    components link with nothing, nor do vectors of different length.  A row
    without a vec_id takes part but names no component; its kept is false, and
    its component_id is null if it reaches no id.  An empty table gives no rows.
    """
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding")
    )
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf)))
    usable = F.coalesce(finite & F.exists("embedding", lambda x: x != 0), F.lit(False))
    good = rows.where(usable)
    classes = store(
        good.groupBy("embedding")
        .agg(F.min("vec_id").alias("least"), F.count("*").alias("n"))
        .withColumn("rep", F.monotonically_increasing_id())
    )
    plain = classes.select("rep", "embedding")
    types = "tag long, key long, rep long, embedding array<double>"
    bits = _bits(map_batches(plain, _hashes(1), types), classes.count(), window, threshold, recall)
    hashed = map_batches(plain, _hashes(passes_for(bits, threshold, recall)), types)
    signed = F.col("key").bitwiseXOR(F.lit(-(2**63)))  # the order of the bits
    ordered = (
        hashed.withColumn("order", signed)
        .repartitionByRange("tag", "order", "rep")
        .sortWithinPartitions("tag", "order", "rep")
        .drop("order")
    )
    passed = store(map_batches(ordered, _neighbours(bits, window, threshold), PASS_OUT))
    keys = ("tag", "key")
    mates = _block_pairs(passed.where("kind = 1").select("tag", "key", "rep", "embedding"), keys, block, "embedding")
    rest = map_batches(mates, _by_blocks((*keys, "left", "right"), _united(threshold)), "a long, b long")
    ties = passed.where("kind = 0").select("a", "b").unionAll(rest)
    found = connected_components(ties)
    found = store(found.withColumnRenamed("id", "rep").join(classes, "rep"))
    keys = ("component",)
    pairs = _block_pairs(found, keys, block, "n", "embedding")
    direct = (
        map_batches(pairs, _by_blocks((*keys, "left", "right"), _count(threshold)), "rep long, links long")
        .groupBy("rep")
        .agg(F.sum("links").alias("links"))
    )
    first = found.groupBy("component").agg(F.min("least").alias("first"))
    known = found.join(first, "component").select("rep", "first").join(direct, "rep")
    labelled = classes.join(known, "rep", "left").select(
        "embedding",
        (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
        F.coalesce("first", "least").alias("component_id"),
    )
    linked = good.join(labelled, "embedding").select("vec_id", "n_links", "component_id")
    alone = rows.where(~usable).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionAll(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
