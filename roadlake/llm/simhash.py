"""SimHash near-duplicates through Gray-ordered hierarchical indexes.

Fingerprints of whole texts are first reduced to distinct values.  Two values
within two of 64 bits agree on at least two of four 16-bit blocks, so each value
is sent to six buckets, one per pair of blocks.  A bucket sorts its values by
Gray rank and factors the bits that neighbours share into upper nodes; a search
carries the differences found so far down the tree and drops a whole group as
soon as they exceed the limit.  Beyond two bits the Gray order itself is cut into
pages under a tree of their shared bits, and a value visits only pages within the
limit.  Buckets and pages emit spanning links, never all pairs, and these are
joined by connected components.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadlake.llm.common import id_and_text, LOWER, map_batches, store, union_pairs
from roadlake.llm.components import connected_components

U64 = np.uint64
FAN, LEAF = 8, 16
#: Values of a page, at least.
PAGE = 1 << 14


def fingerprint_batch(texts: list[bytes], shingle: int = 3, seed: int = 42) -> np.ndarray:
    """64-bit SimHash of each text; no words: zero, fewer than ``shingle``: one shingle."""
    import xxhash

    xxh = xxhash.xxh64_intdigest
    out = np.zeros(len(texts), U64)
    for k, text in enumerate(texts):
        w = text.translate(LOWER).split()
        if not w:
            continue
        n = max(1, len(w) - shingle + 1)
        joined = b" ".join(w)
        ends = np.cumsum(np.fromiter(map(len, w), np.int64, len(w)) + 1)
        starts = np.r_[0, ends[:-1]][:n].tolist()
        stops = (ends[min(shingle, len(w)) - 1 :] - 1).tolist()
        h = np.array([xxh(joined[a:b], seed) for a, b in zip(starts, stops, strict=True)], dtype="<u8")
        # per byte of the hashes, how often each value occurs; then bits from 256 counts
        set_ = np.zeros(64, np.int64)
        if n < 512:
            set_ = np.unpackbits(h.view(np.uint8).reshape(n, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        else:
            octets = h.view(np.uint8).reshape(n, 8)
            for b in range(8):
                set_[8 * b : 8 * b + 8] = np.bincount(octets[:, b], minlength=256) @ _BITS
        out[k] = np.packbits(2 * set_ > n, bitorder="little").view("<u8")[0]
    return out


_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """(doc_id, fp): the fingerprint as a signed long, one row per document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = fingerprint_batch(batch.column("text").to_pylist(), shingle)
            yield pa.record_batch([batch.column("doc_id"), pa.array(fp.view(np.int64))], ["doc_id", "fp"])

    return map_batches(id_and_text(docs), run, "doc_id long, fp long")


def gray_rank(v: np.ndarray) -> np.ndarray:
    """Place of each value in the reflected binary Gray sequence."""
    v = v.copy()
    for s in (1, 2, 4, 8, 16, 32):
        v ^= v >> U64(s)
    return v


class GrayIndex:
    """Levels of (mask, bits): what all values below a node share and its ancestors don't fix yet.

    The leaves are values, or groups of values as (mask, bits), in Gray order.
    ``dropped`` counts the groups that searches have dropped, by level.
    """

    def __init__(self, values: np.ndarray, mask: np.ndarray | None = None):
        if mask is None:
            values = values[np.argsort(gray_rank(values), kind="stable")]
            mask = np.full(len(values), ~U64(0))
        self.values = bits = values
        size, levels = LEAF, [(mask, bits)]
        while len(mask) > 1:
            cut = np.arange(0, len(mask), size)
            size = FAN
            first = bits[cut]
            differ = np.bitwise_or.reduceat(bits ^ np.repeat(first, np.diff(np.r_[cut, len(bits)])), cut)
            mask = np.bitwise_and.reduceat(mask, cut) & ~differ
            bits = first & mask
            levels.append((mask, bits))
        levels.reverse()
        fans = [1] + [FAN] * (len(levels) - 2) + [LEAF] * (len(levels) > 1)
        self.levels = []
        for k, (mask, bits) in enumerate(levels):
            above = U64(0) if not k else levels[k - 1][0][np.arange(len(mask)) // fans[k]]
            own = mask & ~above
            self.levels.append((fans[k], own, bits & own))
        self.dropped = [0] * len(self.levels)

    def search(self, queries: np.ndarray, limit: int, block: int = 2048) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(place of the query, place of the leaf) of all leaves within ``limit`` bits, a block of queries at a time."""
        for at in range(0, len(queries) if len(self.values) else 0, block):
            q = np.arange(at, min(at + block, len(queries)))
            node, diff = np.zeros(len(q), np.int64), np.zeros(len(q), np.int64)
            for k, (fan, mask, bits) in enumerate(self.levels):
                if fan > 1:
                    q, diff = np.repeat(q, fan), np.repeat(diff, fan)
                    node = (node[:, None] * fan + np.arange(fan)).ravel()
                    here = node < len(mask)
                    q, diff, node = q[here], diff[here], node[here]
                diff = diff + np.bitwise_count((queries[q] ^ bits[node]) & mask[node])
                keep = diff <= limit
                self.dropped[k] += len(keep) - int(keep.sum())
                q, diff, node = q[keep], diff[keep], node[keep]
            yield q, node

    def pairs(self, limit: int, block: int = 2048) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Places (i < j) of values within ``limit`` bits, a block of queries at a time."""
        for q, node in self.search(self.values, limit, block):
            yield q[q < node], node[q < node]


def forest(values: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links (value, smaller-placed value) of the groups that ``limit`` bits connect."""
    index = GrayIndex(values)
    parent = np.arange(len(values))
    for i, j in index.pairs(limit):
        union_pairs(parent, i, j)
    tied = np.flatnonzero(parent != np.arange(len(values)))
    return index.values[tied], index.values[parent[tied]]


def _paged(distinct: DataFrame, page: int) -> DataFrame:
    """(page, fp): the values in Gray order, cut into pages of at most ``page``; page numbers follow the order."""
    rank = F.col("fp")
    for s in (1, 2, 4, 8, 16, 32):
        rank = rank.bitwiseXOR(F.shiftrightunsigned(rank, s))
    order = rank.bitwiseXOR(F.lit(-(2**63)))  # unsigned order

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, at = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            number = first + (at + np.arange(batch.num_rows)) // page
            at += batch.num_rows
            yield pa.record_batch([pa.array(number), batch.column("fp")], ["page", "fp"])

    ranked = distinct.select("fp", order.alias("rank")).repartitionByRange("rank").sortWithinPartitions("rank")
    return store(map_batches(ranked.select("fp"), run, "page long, fp long"))


def _visits(paged: DataFrame, roots: GrayIndex, numbers: np.ndarray, limit: int) -> DataFrame:
    """(page, visitor, fp): each value in its own page, and in every later page whose shared bits lie within the limit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, fp = batch.column("page").to_numpy(), batch.column("fp").to_numpy()
            yield pa.record_batch([batch.column("page"), pa.array(np.zeros(len(fp), bool)), batch.column("fp")], ["page", "visitor", "fp"])
            for q, node in roots.search(fp.view(U64), limit):
                later = numbers[node] > own[q]
                yield pa.record_batch(
                    [pa.array(numbers[node[later]]), pa.array(np.ones(int(later.sum()), bool)), pa.array(fp[q[later]])],
                    ["page", "visitor", "fp"],
                )

    return map_batches(paged, run, "page long, visitor boolean, fp long")


def _links(limit: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by page, its own values before its visitors; a page's values are held, visitors pass."""
        page, own, index = None, [], None

        def linked(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
            return pa.record_batch([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

        def within() -> Iterator[pa.RecordBatch]:
            nonlocal index
            values = np.concatenate(own)
            yield linked(*forest(values, limit))
            index = GrayIndex(values)

        for batch in batches:
            number, visitor = batch.column("page").to_numpy(), batch.column("visitor").to_numpy(zero_copy_only=False)
            fp = batch.column("fp").to_numpy().view(U64)
            cut = np.flatnonzero((number[1:] != number[:-1]) | (visitor[1:] != visitor[:-1])) + 1
            for s, e in zip([0, *cut.tolist()], [*cut.tolist(), len(fp)], strict=True):
                if s == e:
                    continue
                if number[s] != page:
                    if own and index is None:
                        yield from within()
                    page, own, index = number[s], [], None
                if not visitor[s]:
                    own.append(fp[s:e])
                    continue
                if index is None:
                    yield from within()
                here = fp[s:e]
                every = np.concatenate([here, index.values])
                parent = np.arange(len(every))
                for q, node in index.search(here, limit):
                    union_pairs(parent, q, node + len(here))
                tied = np.flatnonzero(parent != np.arange(len(every)))
                yield linked(every[tied], every[parent[tied]])
        if own and index is None:
            yield from within()

    return run


def page_links(distinct: DataFrame, max_bits: int = 2, page: int = PAGE) -> DataFrame:
    """``near_links`` within any number of bits, by pages of the Gray order.

    ``page`` is the least size of a page; pages grow with the square root of the
    values, so that their roots, which every task gets, stay few.
    """
    if max_bits < 0:
        raise ValueError("max_bits is a number of bits")
    n = distinct.count()
    if not n:
        return distinct.sparkSession.createDataFrame([], "a long, b long")
    paged = _paged(distinct, max(page, isqrt(n)))
    shared = paged.groupBy("page").agg(F.bit_and("fp").alias("all"), F.bit_or("fp").alias("any"))
    rows = sorted(shared.collect())  # one row a page
    number, every, some = (np.array(c, np.int64) for c in zip(*rows, strict=True))
    mask = ~(every ^ some).view(U64)
    roots = GrayIndex(every.view(U64) & mask, mask)
    visits = _visits(paged, roots, number, max_bits)
    return map_batches(visits.repartition("page").sortWithinPartitions("page", "visitor"), _links(max_bits), "a long, b long")


def _bucket_links(limit: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by bucket; a bucket may go over from one batch to the next."""
        held_key, held_fp = np.zeros(0, np.int64), np.zeros(0, U64)

        def emit(key: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
            start = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
            size = np.diff(np.r_[start, len(key)])
            two = start[size == 2]
            near = np.bitwise_count(fp[two] ^ fp[two + 1]) <= limit
            a, b = [fp[two][near]], [fp[two + 1][near]]
            for s, n in zip(start[size > 2].tolist(), size[size > 2].tolist(), strict=True):
                x, y = forest(fp[s : s + n], limit)
                a.append(x)
                b.append(y)
            return pa.record_batch([pa.array(np.concatenate(c).view(np.int64)) for c in (a, b)], ["a", "b"])

        for batch in batches:
            key = np.concatenate([held_key, batch.column("key").to_numpy()])
            fp = np.concatenate([held_fp, batch.column("fp").to_numpy().view(U64)])
            if not len(key):
                continue
            last = int(np.searchsorted(key, key[-1]))
            if last:
                yield emit(key[:last], fp[:last])
            held_key, held_fp = key[last:], fp[last:]
        if len(held_key):
            yield emit(held_key, held_fp)

    return run


def block_links(distinct: DataFrame, max_bits: int = 2) -> DataFrame:
    """``near_links`` within 0 to 2 bits: each value in six buckets, one per pair of equal 16-bit blocks."""
    if not 0 <= max_bits <= 2:
        raise ValueError("four blocks prove pairs within 0 to 2 bits only")
    block = [F.shiftrightunsigned("fp", 16 * b).bitwiseAND(F.lit(0xFFFF)) for b in range(4)]
    keys = [
        F.lit(n << 32).bitwiseOR(F.shiftleft(block[i], 16)).bitwiseOR(block[j]).cast("long")
        for n, (i, j) in enumerate(combinations(range(4), 2))
    ]
    spread = distinct.select("fp", F.explode(F.array(*keys)).alias("key"))
    return map_batches(spread.repartition("key").sortWithinPartitions("key"), _bucket_links(max_bits), "a long, b long")


def near_links(distinct: DataFrame, max_bits: int = 2) -> DataFrame:
    """Links (a, b) that connect the values ``fp`` as all pairs within ``max_bits`` would.

    Up to 2 bits the values meet in buckets, six rows a value; beyond, where
    blocks prove nothing, they visit pages, whose visits grow faster than the
    values.
    """
    return block_links(distinct, max_bits) if 0 <= max_bits <= 2 else page_links(distinct, max_bits)


def simhash_groups(docs: DataFrame, shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """One row per input row: doc_id, fingerprint (16 hex digits), component_id.

    Words are runs between ASCII white space, A-Z lower-cased.  Null and empty
    texts have fingerprint zero and link like any other.  A row without a
    doc_id links too but never names a component (null if no row of it has an
    id); rows that share a doc_id stay rows of their own.  An empty table gives
    no rows.
    """
    fps = store(fingerprints(docs, shingle))
    return fps.join(_labels(fps, max_bits), "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def _labels(fps: DataFrame, max_bits: int) -> DataFrame:
    """(fp, component, component_id) of the distinct fingerprints."""
    distinct = store(fps.groupBy("fp").agg(F.min("doc_id").alias("least")))
    of = connected_components(near_links(distinct.select("fp"), max_bits))
    named = distinct.join(of, distinct["fp"] == of["id"], "left").select(
        "fp", "least", F.coalesce("component", "fp").alias("component")
    )
    named = store(named)
    smallest = named.groupBy("component").agg(F.min("least").alias("component_id"))
    return named.join(smallest, "component")


def keep_one(docs: DataFrame, shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """One whole row of each group: that with the smallest doc_id (a null id after all others).

    Of several rows with that id one stays, whichever Spark meets first.
    """
    fps = store(fingerprints(docs, shingle))
    best = store(
        fps.join(_labels(fps, max_bits), "fp")
        .groupBy("component", "doc_id")
        .agg(F.min("fp").alias("fp"), F.count("*").alias("n"))
        .groupBy("component")
        .agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "fp", "n")).alias("b"))
        .select(F.col("b.doc_id").alias("__id"), F.col("b.fp").alias("__fp"), F.col("b.n").alias("__n"))
    )
    names = docs.columns

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = fingerprint_batch([(t or "").encode() for t in batch.column("text").to_pylist()], shingle)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(fp.view(np.int64))], names=[*names, "__fp"])

    marked = map_batches(docs, add, T.StructType([*docs.schema.fields, T.StructField("__fp", T.LongType())]))
    kept = marked.join(best, (marked["__fp"] == best["__fp"]) & marked["doc_id"].eqNullSafe(best["__id"])).drop("__id")
    once = kept.where("__n = 1").select(*names)
    if best.where("__n > 1").isEmpty():
        return once
    again = kept.where("__n > 1").select(*names, marked["__fp"].alias("__one")).dropDuplicates(["__one"])
    return once.unionAll(again.select(*names))
