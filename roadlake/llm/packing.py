"""Best-fit packing by a grouping genetic algorithm on islands.

Documents become pieces of at most ``capacity`` tokens; pieces are dealt evenly
into shards of bounded size, each a bin-packing problem of its own.  Several
islands per shard evolve populations of groupings in Spark tasks; after each
epoch every island sends its best grouping to the next one.  A crossover injects
whole well-filled bins of one parent into the other, drops the bins that held
their pieces and best-fits the displaced pieces.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadlake.llm.common import id_and_text, map_batches, store
from roadlake.llm.tokens import encoder

END = (2).to_bytes(4, "little")
PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, tokenizer: str | None = None, capacity: int = 1024) -> DataFrame:
    """Each document's ids and the end id, cut from the back into ``capacity`` pieces."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        for batch in batches:
            rows = []
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                ids = enc.encode(text.decode()) + END
                n = len(ids) // 4
                at, end = 0, (n - 1) % capacity + 1
                for k in range(-(-n // capacity)):
                    rows.append((doc, k, at, end - at, zlib.crc32(ids[4 * at : 4 * end])))
                    at, end = end, end + capacity
            types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.record_batch(
                [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
                if rows
                else [pa.array([], t) for t in types],
                [f.split()[0] for f in PIECE.split(", ")],
            )

    return map_batches(id_and_text(docs), cut, PIECE)


class Bins:
    """A grouping under best fit: open bins by free space, the tightest found by a bit mask."""

    def __init__(self, lengths: list[int], capacity: int):
        self.lengths, self.capacity = lengths, capacity
        self.bins: list[list[int]] = []
        self.room: list[int] = []
        self.free: dict[int, list[int]] = {}
        self.mask = 0

    def add(self, items: list[int], room: int) -> None:
        self.bins.append(items)
        self.room.append(room)
        if room:
            self.free.setdefault(room, []).append(len(self.bins) - 1)
            self.mask |= 1 << room

    def best_fit(self, items: list[int]) -> None:
        """Longest first, each into the bin that it leaves least room in."""
        for i in sorted(items, key=self.lengths.__getitem__, reverse=True):
            n = self.lengths[i]
            fits = self.mask >> n
            if not fits:
                self.add([i], self.capacity - n)
                continue
            room = n + (fits & -fits).bit_length() - 1
            b = self.free[room].pop()
            if not self.free[room]:
                self.mask ^= 1 << room
            self.bins[b].append(i)
            self.room[b] = left = room - n
            if left:
                self.free.setdefault(left, []).append(b)
                self.mask |= 1 << left

    def fitness(self) -> tuple[int, float]:
        """Fewer bins first, then the more unevenly filled grouping: its slack is easier to use."""
        fill = 1 - np.array(self.room) / self.capacity
        return -len(self.bins), float(fill @ fill)


def _child(mother: Bins, father: Bins, rng) -> Bins:
    """Inject whole bins of ``father``, well-filled ones likelier, into ``mother``."""
    fill = 1 - np.array(father.room) / father.capacity
    given = np.flatnonzero(rng.random(len(fill)) < 0.5 * fill**8).tolist()
    taken = {i for b in given for i in father.bins[b]}
    out, displaced = Bins(mother.lengths, mother.capacity), []
    for b in given:
        out.add(father.bins[b].copy(), father.room[b])
    apart = set(rng.choice(len(mother.bins), size=max(1, len(mother.bins) // 50), replace=False).tolist())
    for k, (items, room) in enumerate(zip(mother.bins, mother.room, strict=True)):
        if k not in apart and taken.isdisjoint(items):
            out.add(items.copy(), room)
        else:
            displaced += [i for i in items if i not in taken]
    out.best_fit(displaced)
    return out


def evolve(
    lengths: list[int], start: list[list[list[int]]], capacity: int, seed: int, population: int, generations: int
) -> list[list[int]]:
    """The best grouping after some generations; ``start`` holds groupings to begin with."""
    rng = np.random.default_rng(seed)
    whole = [[i] for i, n in enumerate(lengths) if n == capacity]  # these leave no choice
    part = np.flatnonzero(np.array(lengths) < capacity)
    if not len(part):
        return whole
    pool = []
    for bins in start:
        one = Bins(lengths, capacity)
        for items in bins:
            if lengths[items[0]] < capacity:
                one.add(items, capacity - sum(lengths[i] for i in items))
        pool.append((one.fitness(), one))
    while len(pool) < population:
        new = Bins(lengths, capacity)
        head = rng.random(len(part)) < (0.1 if pool else 0.0)  # the first is best fit decreasing
        for some in (part[head], part[~head]):
            new.best_fit(some.tolist())
        pool.append((new.fitness(), new))
    floor = -(-sum(lengths[i] for i in part.tolist()) // capacity)
    for _ in range(generations):
        pool.sort(key=lambda p: p[0], reverse=True)
        if -pool[0][0][0] <= floor:
            break
        a, b = rng.choice(max(2, population // 2), size=2, replace=False)
        new = _child(pool[a][1], pool[b][1], rng)
        fit = new.fitness()
        if fit > pool[-1][0] and all(fit != p[0] for p in pool):
            pool[-1] = (fit, new)
    return whole + max(pool, key=lambda p: p[0])[1].bins


def _to_bins(numbers: np.ndarray) -> list[list[int]]:
    out: list[list[int]] = [[] for _ in range(int(numbers.max()) + 1 if len(numbers) else 0)]
    for i, b in enumerate(numbers.tolist()):
        out[b].append(i)
    return out


def pack(
    docs: DataFrame,
    tokenizer: str | None = None,
    capacity: int = 1024,
    shard_pieces: int = 4096,
    islands: int = 2,
    epochs: int = 2,
    population: int = 4,
    generations: int = 16,
    loosest: int = 8,
) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Null and empty texts are the end id alone.  Rows that share a doc_id, or
    have none, are packed as documents of their own.  Pieces are shuffled into
    shards by their place, not by key, so no key makes a shard large; the
    ``loosest`` sequences of each shard are then packed again together with
    those of other shards, starting from what they are.  An empty table gives no
    rows.
    """
    cut = store(pieces(docs, tokenizer, capacity).withColumn("place", F.monotonically_increasing_id()))
    shards = max(1, -(-cut.count() // shard_pieces))
    rows = F.struct("doc_id", "piece", "start", "length", "ids_crc32")
    problem = store(
        cut.groupBy(F.pmod(F.xxhash64("place"), F.lit(shards)).alias("shard")).agg(
            F.sort_array(F.collect_list(F.struct("place", rows.alias("row")))).alias("items")
        )
    ).select("shard", "items.row")
    island = F.explode(F.sequence(F.lit(0), F.lit(islands - 1))).alias("island")
    state = problem.select("shard", F.col("row.length").alias("lengths"), island).withColumn(
        "start", F.array().cast("array<binary>")
    )
    out = "shard long, island int, n_bins long, best binary"

    def epoch(number: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows = []
                for r in batch.to_pylist():
                    best = evolve(
                        r["lengths"],
                        [_to_bins(np.frombuffer(b, "<i4")) for b in r["start"]],
                        capacity,
                        (r["shard"] * islands + r["island"]) * epochs + number,
                        population,
                        generations,
                    )
                    of = np.empty(len(r["lengths"]), "<i4")
                    for n, b in enumerate(best):
                        of[b] = n
                    rows.append({"shard": r["shard"], "island": r["island"], "n_bins": len(best), "best": of.tobytes()})
                yield pa.RecordBatch.from_pylist(
                    rows,
                    pa.schema([("shard", pa.int64()), ("island", pa.int32()), ("n_bins", pa.int64()), ("best", pa.binary())]),
                )

        return run

    tasks = min(shards * islands, 4096)
    for number in range(epochs):
        done = store(map_batches(state.repartition(tasks, "shard", "island"), epoch(number), out))
        elite = done.select("shard", F.pmod(F.col("island") + 1, F.lit(islands)).alias("island"), F.col("best").alias("guest"))
        state = (
            problem.select("shard", F.col("row.length").alias("lengths"))
            .join(done, "shard")
            .join(elite, ["shard", "island"])
            .select("shard", "lengths", "island", F.array("best", "guest").alias("start"))
        )
    best = done.groupBy("shard").agg(F.min_by("best", F.struct("n_bins", "island")).alias("best"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, items, best in zip(
                batch.column("shard").to_pylist(), batch.column("row"), batch.column("best").to_pylist(), strict=True
            ):
                flat = pa.RecordBatch.from_struct_array(items.values)
                of = np.frombuffer(best, "<i4").astype(np.int64)
                fill = np.bincount(of, flat.column("length").to_numpy())
                order = np.argsort(fill, kind="stable")[:loosest]
                loose = np.isin(of, order[fill[order] < capacity])
                columns = [*flat.columns, pa.array(of + (shard << 24)), pa.array(_offsets(of, flat)), pa.array(loose)]
                yield pa.record_batch(columns, [*flat.schema.names, "sequence_id", "offset", "loose"])

    kinds = f"{PIECE}, sequence_id long, offset long"
    names = [c.split()[0] for c in kinds.split(", ")]
    placed = store(map_batches(problem.join(best, "shard"), place, f"{kinds}, loose boolean"))
    rest = placed.where("loose")
    groups = max(1, -(-rest.count() // shard_pieces))

    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for group, items in zip(batch.column("group").to_pylist(), batch.column("items"), strict=True):
                flat = pa.RecordBatch.from_struct_array(items.values)
                lengths = flat.column("length").to_pylist()
                _, now = np.unique(flat.column("sequence_id").to_numpy(), return_inverse=True)
                of = np.empty(len(lengths), np.int64)
                for n, b in enumerate(evolve(lengths, [_to_bins(now)], capacity, group, population, generations)):
                    of[b] = n
                columns = [flat.column(c) for c in names[:-2]]
                yield pa.record_batch([*columns, pa.array(of + (1 << 62) + (group << 24)), pa.array(_offsets(of, flat))], names)

    row = F.struct("sequence_id", "offset", *names[:-2])
    grouped = rest.groupBy(F.pmod(F.xxhash64(F.shiftright("sequence_id", 24)), F.lit(groups)).alias("group")).agg(
        F.sort_array(F.collect_list(row)).alias("items")
    )
    return placed.where("not loose").select(names).unionAll(map_batches(grouped, again, kinds).select(names))


def _offsets(of: np.ndarray, flat: pa.RecordBatch) -> np.ndarray:
    """Place of each piece in its sequence, gapless in the order of the rows."""
    length = flat.column("length").to_numpy()
    order = np.argsort(of, kind="stable")
    before = np.cumsum(length[order]) - length[order]
    first = np.r_[True, of[order][1:] != of[order][:-1]][: len(of)]
    offset = np.empty_like(length)
    offset[order] = before - np.maximum.accumulate(np.where(first, before, 0))
    return offset
