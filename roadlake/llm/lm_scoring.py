"""Log-likelihood of whole documents under a word count base and a recurrent model.

Counts cover every training document.  At most ``head`` of the most frequent
words are broadcast; all other words meet their counts in a join.  The model
predicts the most frequent words, ``vocabulary`` or the square root of the
number of distinct words if that is more, and one class for the rest, whose
words then share it by their counts.  Its weights are learnt in rounds from every
training document: hashes deal the documents to rounds and, within a round, to
shards of about SHARD_TOKENS tokens; each shard passes once over its documents
from the round's common start, and the results are averaged.  So the model
depends on the table alone, not on its partitions.  A caller may give a smaller
``share`` of the documents; the query does not.
"""

from __future__ import annotations

import math
import pickle
from collections import Counter
from collections.abc import Iterator
from copy import copy
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadlake.llm import recurrent
from roadlake.llm.common import id_and_text, map_batches, store
from roadlake.session import scratch_path

END = b"\n"  # no word holds a line feed
CLASSES = 48  # at least
WIDTH, WINDOW = 512, 32
#: Of training: lanes, steps of back-propagation, tokens of a shard and of what a task lays on the lanes at a time.
LANES, STEPS = 256, 16
SHARD_TOKENS = 1_000_000
BATCH_TOKENS = 500_000
#: Shares of the training documents that have been learnt after each round.
ROUNDS = (0.1, 0.3, 0.6, 1.0)


def class_starts(counts: np.ndarray) -> np.ndarray:
    """About as many classes as words in a class."""
    return recurrent.class_starts(counts, max(CLASSES, math.isqrt(len(counts))))


def held_out(doc_id):
    """crc32 of the id as text, modulo 7, is 2; false for a null id."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(7)) == 2, F.lit(False))


def words(text: bytes) -> list[bytes]:
    return text.lower().split()  # bytes: A-Z and ASCII white space only


def word_counts(training: DataFrame, most: int = 300_000) -> DataFrame:
    """(word, c) over all tokens, the end of each document included."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[bytes] = Counter()

        def out() -> pa.RecordBatch:
            batch = pa.record_batch([pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())], ["word", "c"])
            seen.clear()
            return batch

        for batch in batches:
            for text in batch.column("text").to_pylist():
                seen.update(words(text))
                seen[END] += 1
                if len(seen) > most:
                    yield out()
        yield out()

    return map_batches(training.select("text"), count, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


class Vocabulary:
    """The head of the counts; the model knows its first words, the end and the class of the rest."""

    def __init__(self, head: list[tuple[bytes, int]], total: int, distinct: int, size: int):
        self.total, self.distinct = total, distinct
        ends = next((c for w, c in head if w == END), 0)
        inside = [(w, c) for w, c in head if w != END]
        self.known = {w: k for k, (w, _) in enumerate(inside)}
        self.logs = np.log10(np.array([c for _, c in inside], float) + 1)
        self.end_log = math.log10(ends + 1)
        self.any_end = ends > 0
        named = inside[: max(size, math.isqrt(distinct))]
        self.rest_total = total - ends - sum(c for _, c in named)
        self.rest_distinct = distinct - self.any_end - len(named)
        counts = np.array([c for _, c in named] + [ends, self.rest_total], float)
        order = np.argsort(-counts, kind="stable")
        place = np.empty(len(order), np.int32)
        place[order] = np.arange(len(order))
        self.counts, self.ids, self.end, self.rest = counts[order], place[:-2], int(place[-2]), int(place[-1])

    def model_ids(self, ranks: np.ndarray) -> np.ndarray:
        out = np.full(len(ranks) + 1, self.rest, np.int32)
        named = (ranks >= 0) & (ranks < len(self.ids))
        out[:-1][named] = self.ids[ranks[named]]
        out[-1] = self.end
        return out

    def named(self) -> Vocabulary:
        """The same for the model alone: without the words that it does not name."""
        small = copy(self)
        small.known = {w: k for w, k in self.known.items() if k < len(self.ids)}
        small.logs = self.logs[:0]
        return small

    def ranks(self, text: bytes) -> tuple[list[bytes], np.ndarray]:
        w = words(text)
        get = self.known.get
        return w, np.fromiter(map(get, w, repeat(-1)), np.int64, len(w))


def _vocabulary(counts: DataFrame, head: int, size: int) -> Vocabulary:
    """Words are taken from the most frequent down, by whole steps of 1/64 octave, while they number ``head`` at most."""
    step = F.floor(64 * F.log2("c")).cast("long")
    steps = counts.groupBy(step.alias("step")).agg(F.count("*").alias("n"), F.sum("c").alias("c")).collect()  # < 4,096
    lowest, held = 2**62, 0
    for r in sorted(steps, reverse=True):
        held += r.n
        if held > head:
            break
        lowest = r.step
    top = counts.where((step >= lowest) | (F.col("word") == END)).collect()
    rows = sorted(((bytes(w), c) for w, c in top), key=lambda r: (-r[1], r[0]))
    return Vocabulary(rows, sum(r.c for r in steps), sum(r.n for r in steps), size)


def _learnt(training: DataFrame, shared, params: recurrent.Params, rate: float, shards: int) -> recurrent.Params:
    """The average of what ``shards`` copies of the model learn from their documents, weighted by tokens.

    A shard's documents come to one task in the order of their hashes, whatever
    the partitions; a task passes over its shards one after the other and adds
    them up.  Rows that repeat a document's id and text teach once.
    """
    start = training.sparkSession.sparkContext.broadcast(recurrent.flatten(params))
    row = "weight double, total binary"

    def summed(weight: float, total: np.ndarray) -> pa.RecordBatch:
        return pa.record_batch([pa.array([weight]), pa.array([total.tobytes()], pa.binary())], ["weight", "total"])

    def ranked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = pickle.loads(shared.value)
        kind = np.uint16 if len(vocabulary.counts) < 1 << 16 else np.int32
        for batch in batches:
            ids = [vocabulary.model_ids(vocabulary.ranks(t)[1]).astype(kind).tobytes() for t in batch.column("text").to_pylist()]
            yield pa.record_batch([batch.column("shard"), batch.column("key"), pa.array(ids, pa.binary())], ["shard", "key", "ids"])

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = pickle.loads(shared.value)
        kind = np.uint16 if len(vocabulary.counts) < 1 << 16 else np.int32
        starts = class_starts(vocabulary.counts)
        weight, total = 0.0, np.zeros(len(start.value))
        model, memory, docs, tokens, seen, now, last = None, {}, [], 0, 0, None, None

        def pass_over() -> None:
            nonlocal docs, tokens, seen
            if docs:
                model.learn(docs, vocabulary.end, memory, rate, LANES, STEPS)
            docs, tokens, seen = [], 0, seen + tokens

        def leave() -> None:
            nonlocal weight, total
            pass_over()
            weight += seen
            total += seen * recurrent.flatten(model.p).astype(np.float64)

        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("shard", "key", "ids"))
            for shard, key, ids in zip(*columns, strict=True):
                if shard != now:
                    if model:
                        leave()
                    p = recurrent.unflatten(start.value, params)
                    model, memory = recurrent.Model(p, starts), {k: np.full_like(v, 1e-8) for k, v in p.items()}
                    now, seen, last = shard, 0, None
                if key == last:
                    continue
                last = key
                docs.append(np.frombuffer(ids, kind).astype(np.int32))
                tokens += len(docs[-1])
                if tokens > BATCH_TOKENS:
                    pass_over()
        if model:
            leave()
            yield summed(weight, total)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight, total = 0.0, None
        for b in batches:
            for r in b.to_pylist():
                weight += r["weight"]
                part = np.frombuffer(r["total"])
                total = part.copy() if total is None else total + part
        if total is not None:
            yield summed(weight, total)

    place = F.pmod(F.xxhash64("key"), F.lit(shards))
    ids = map_batches(training.select(place.alias("shard"), "key", "text"), ranked, "shard long, key binary, ids binary")
    ordered = ids.repartition("shard").sortWithinPartitions("shard", "key")
    learnt = store(map_batches(ordered, learn, row))
    n = learnt.count()
    while n > 16:
        n = -(-n // 16)
        learnt = store(map_batches(learnt.repartition(n), merge, row))
    rows = [(r.weight, np.frombuffer(bytes(r.total))) for r in learnt.collect()]
    if not sum(w for w, _ in rows):
        return params
    average = sum(t for _, t in rows) / sum(w for w, _ in rows)
    # cut to 2**-16, so that the order in which the parts were added does not show
    return recurrent.unflatten(np.round(average * 65536) / 65536, params)


def score(
    docs: DataFrame,
    vocabulary: int = 2000,
    head: int = 200_000,
    hidden: int = 16,
    share: float = 1.0,
    rate: float = 0.1,
) -> DataFrame:
    """One row per document.

    doc_id, held_out, n_tokens (words and one end), n_known, train_tokens,
    base_score and score, both log10 probabilities of the whole text.  Null and
    empty texts are the end alone; a null doc_id is a training document.  With
    no training document all counts are 0 and the model is untrained.  An empty
    table gives no rows.
    """
    spark = docs.sparkSession
    source = docs.select(
        held_out(F.col("doc_id").cast("long")).alias("held_out"),
        F.pmod(F.xxhash64("doc_id", "text"), F.lit(1000)).alias("slice"),
        F.unhex(F.md5(F.to_binary(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), "text"), F.lit("utf-8")))).alias("key"),
        "text",
    )
    training = source.where("not held_out").select(
        "slice", "key", F.coalesce(F.col("text").cast("binary"), F.lit(b"").cast("binary")).alias("text")
    )
    counts = store(word_counts(training))
    known = _vocabulary(counts, head, vocabulary)
    shared = spark.sparkContext.broadcast(pickle.dumps(known))
    learning = spark.sparkContext.broadcast(pickle.dumps(known.named()))
    starts = class_starts(known.counts)
    params = recurrent.fresh(known.counts, starts, hidden)
    low = 0.0
    for high in ROUNDS:
        some = training.where((F.col("slice") >= int(1000 * share * low)) & (F.col("slice") < int(1000 * share * high)))
        params = _learnt(some, learning, params, rate, max(1, round(known.total * share * (high - low) / SHARD_TOKENS)))
        low = high
    weights = spark.sparkContext.broadcast(recurrent.flatten(params))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = pickle.loads(shared.value)
        model = recurrent.Model(recurrent.unflatten(weights.value, params), starts)
        rid = TaskContext.get().partitionId() << 33
        for batch in batches:
            ids, columns = [], []
            rare_words: list[bytes] = []
            rare_counts: list[int] = []
            offsets = [0]
            for text in batch.column("text").to_pylist():
                w, ranks = v.ranks(text)
                there = ranks >= 0
                outside = ranks >= len(v.ids)
                rare = Counter(map(w.__getitem__, np.flatnonzero(~there).tolist()))
                rare_words += rare
                rare_counts += rare.values()
                offsets.append(len(rare_words))
                ids.append(v.model_ids(ranks))
                columns.append(
                    (
                        len(w) + 1,
                        int(there.sum()) + v.any_end,
                        float(v.logs[ranks[there]].sum()) + v.end_log,
                        float(v.logs[ranks[outside]].sum()),
                        int((outside | ~there).sum()),
                    )
                )
            if not ids:
                continue
            logp = model.log_likelihood(ids, v.end, WIDTH, WINDOW) / math.log(10)
            pairs = pa.StructArray.from_arrays([pa.array(rare_words, pa.binary()), pa.array(rare_counts, pa.int64())], ["word", "n"])
            c = list(zip(*columns, strict=True))
            yield pa.record_batch(
                [
                    batch.column("doc_id"),
                    pa.array(np.arange(rid, rid + len(ids))),
                    *(pa.array(x, t) for x, t in zip(c, (pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.int64()), strict=True)),
                    pa.array(logp),
                    pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pairs),
                ],
                ["doc_id", "rid", "n_tokens", "in_head", "head_logs", "outside_logs", "n_outside", "logp", "rare"],
            )
            rid += len(ids)

    types = (
        "doc_id long, rid long, n_tokens long, in_head long, head_logs double, outside_logs double, n_outside long, "
        "logp double, rare array<struct<word:binary,n:bigint>>"
    )
    path = scratch_path(spark, "lm-scores")
    map_batches(id_and_text(docs), run, types).write.parquet(path)
    scored = spark.read.parquet(path)
    rare = (
        scored.select("rid", F.inline("rare"))
        .join(counts, "word", "left")
        .groupBy("rid")
        .agg(
            F.sum(F.col("n") * F.log10(F.coalesce("c", F.lit(0)) + 1.0)).alias("rare_logs"),
            F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("rare_known"),
        )
    )
    logs = F.coalesce("rare_logs", F.lit(0.0))
    every = math.log10(known.total + known.distinct + 1)
    rest = math.log10(known.rest_total + known.rest_distinct + 1)
    return (
        scored.drop("rare")
        .join(rare, "rid", "left")
        .select(
            "doc_id",
            held_out(F.col("doc_id")).alias("held_out"),
            "n_tokens",
            (F.col("in_head") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
            F.lit(known.total).cast("long").alias("train_tokens"),
            (F.col("head_logs") + logs - F.col("n_tokens") * every).alias("base_score"),
            (F.col("logp") + F.col("outside_logs") + logs - F.col("n_outside") * rest).alias("score"),
        )
    )
