"""Substring dedup with suffix automata of reference shards.

A window of ``window`` words is removed when its words also start in a document
with a smaller id.  Streaming every document past the automata of all shards
would be quadratic, so text is sent only where it can match: each window has a
smallest ``GRAM``-word hash, equal windows have the same one, and the windows
around a hash that only one text holds are dropped early.  The spans around
shared hashes are dealt to shards by that hash.  A shard takes its spans in
order of document, streams each through the suffix automaton of the spans before
it, and reports the windows whose matching statistics reach the window's length.

Equal texts are reduced to one beforehand.  Hashes that more than ``HOT`` texts
hold do not become one shard's load: their windows are compared as words, least
id first by aggregation, then joined back.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadlake.llm.automaton import SuffixAutomaton
from roadlake.llm.common import map_batches

GRAM = 4
HOT = 4096
SHARD_WORDS = 60_000
NO_ID = 2**63 - 1  # stands for a null id: larger than any other
U64 = np.uint64


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> U64(31))
    x = x * U64(0x9E3779B97F4A7C15)
    return x ^ (x >> U64(29))


def _rolled(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of n entries."""
    k = len(h) - n + 1
    out = h[:k].copy()
    for j in range(1, n):
        out *= U64(_BASE)
        out += h[j : j + k]
    return _mix(out)


_SPACE = np.isin(np.arange(256), list(b" \t\n\v\f\r"))
_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2^64
_PIECE = 1 << 20


def _powers(n: int, base: int) -> np.ndarray:
    out = np.full(n, base, U64)
    out[:1] = 1
    return np.cumprod(out)


_UP, _DOWN = _powers(2 * _PIECE, _BASE), _powers(2 * _PIECE, pow(_BASE, -1, 1 << 64))


def word_hashes(text: bytes) -> np.ndarray:
    """64-bit hash of each word, from sums of powers over the bytes; equal words have equal hashes."""
    if len(text) > _PIECE:  # cut at white space; what has none is hashed word by word
        words, out, at = text.split(), [], 0
        while at < len(words):
            to, size = at, 0
            while to < len(words) and (to == at or size + len(words[to]) < _PIECE):
                size += len(words[to]) + 1
                to += 1
            if size > _PIECE:
                out.append(np.frombuffer(hashlib.blake2b(words[at], digest_size=8).digest(), U64))
            else:
                out.append(word_hashes(b" ".join(words[at:to])))
            at = to
        return np.concatenate(out) if out else np.zeros(0, U64)
    raw = np.frombuffer(text, np.uint8)
    edge = np.diff(np.concatenate([[True], _SPACE[raw], [True]]).astype(np.int8))
    start, end = np.flatnonzero(edge < 0), np.flatnonzero(edge > 0)
    total = np.zeros(len(raw) + 1, U64)
    np.cumsum((raw + U64(1)) * _UP[: len(raw)], out=total[1:])
    return _mix((total[end] - total[start]) * _DOWN[start])


def smallest(hashes: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows with the same smallest gram: (its hash, first window, number of windows)."""
    gram = min(GRAM, window)
    n = len(hashes) - window + 1
    if n < 1:
        none = np.zeros(0, np.int64)
        return none.astype(U64), none, none
    # the six lowest bits tell the places of a window apart; equal windows still agree on the rest
    key = _rolled(hashes, gram) & ~U64(63)
    key |= np.arange(len(key), dtype=U64) & U64(63)
    span, wide = 1, window - gram + 1
    while span < wide:
        step = min(span, wide - span)
        key = np.minimum(key[:-step], key[step:])
        span += step
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    return key[first] & ~U64(63), first, np.diff(np.r_[first, n])


def _grams(window: int, places: bool):
    """Each text's distinct smallest hashes; with their places, start * 64 + number of windows, if asked for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes, owners, packed, ends = [np.zeros(0, U64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            size = 0
            for t, text in zip(batch.column("t").to_pylist(), batch.column("text").to_pylist(), strict=True):
                value, first, count = smallest(word_hashes(text), window)
                if not places:
                    hashes.append(np.unique(value))
                    continue
                order = np.argsort(value, kind="stable")
                value = value[order]
                last = np.flatnonzero(np.r_[value[1:] != value[:-1], True][: len(value)])
                hashes.append(value[last])
                owners.append(np.full(len(last), t))
                packed.append((first * 64 + count)[order])
                ends.append(size + 8 * (last + 1))
                size += 8 * len(value)
            h = pa.array(np.concatenate(hashes).view(np.int64))
            if not places:
                yield pa.record_batch([h], ["h"])
                continue
            offsets = np.concatenate([[0], *ends]).astype(np.int64)
            at = pa.LargeBinaryArray.from_buffers(
                pa.large_binary(), len(h), [None, pa.py_buffer(offsets), pa.py_buffer(np.concatenate(packed))]
            )
            yield pa.record_batch([h, pa.array(np.concatenate(owners)), at.cast(pa.binary())], ["h", "t", "at"])

    return run


def _spans(window: int):
    """The spans around shared hashes; around hot ones each window is a span of its own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for r in batch.to_pylist():
                words = r["text"].split()
                mine: dict[tuple, list[int]] = {}
                for span in r["spans"]:
                    for packed in np.frombuffer(span["at"], np.int64).tolist():
                        start, count = divmod(packed, 64)
                        if span["hot"]:
                            for i in range(start, start + count):
                                mine.setdefault((None, b" ".join(words[i : i + window])), []).append(i)
                        else:
                            end = start + count + window - 1
                            mine.setdefault((span["h"], b" ".join(words[start:end])), []).append(start)
                out += [(h, r["t"], r["owner"], np.array(at).tobytes(), text) for (h, text), at in mine.items()]
            yield pa.record_batch(
                [
                    pa.array(c, t)
                    for c, t in zip(
                        zip(*out, strict=True) if out else [[]] * 5,
                        (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary()),
                        strict=True,
                    )
                ],
                ["h", "t", "owner", "at", "words"],
            )

    return run


def shard_hits(rows: list[tuple[int, int, bytes, bytes]], window: int) -> list[tuple[int, bytes]]:
    """(t, hit windows) of a shard's spans (t, owner, starts, words)."""
    number: dict[bytes, int] = {}
    spans = [[number.setdefault(w, len(number)) for w in words.split()] for _, _, _, words in rows]
    rows_of = np.repeat(np.arange(len(rows)), [len(s) - window + 1 for s in spans])
    # hashes of all windows: spans without one that two owners share cannot match
    flat = np.fromiter((w for s in spans for w in s), np.int64).astype(U64)
    inside = np.concatenate([np.arange(len(s)) < len(s) - window + 1 for s in spans])
    key = _rolled(_mix(flat + U64(1)), window)[inside[: len(flat) - window + 1]]
    owner = np.array([r[1] for r in rows])[rows_of]
    order = np.lexsort((owner, key))
    k, o = key[order], owner[order]
    start = np.flatnonzero(np.r_[True, k[1:] != k[:-1]])
    size = np.diff(np.r_[start, len(k)])
    shared = np.repeat(o[start] != o[start + size - 1], size)
    live = np.unique(rows_of[order[shared]])
    live = live[np.argsort(np.array([rows[i][1] for i in live.tolist()], dtype=np.int64), kind="stable")].tolist()

    automaton, out = SuffixAutomaton(), []
    known: dict[bytes, int] = {}  # spans the automaton holds, with their first owner
    waiting: list[int] = []
    for n, i in enumerate(live):
        t, own, starts, words = rows[i]
        span = spans[i]
        if known.get(words, own) < own:
            hit = np.arange(len(span) - window + 1)
        else:
            reach = automaton.matching(span)
            hit = np.flatnonzero(np.array(reach[window - 1 :]) >= window)
            if words not in known:
                known[words] = own
                waiting.append(i)
        if len(hit):
            at = np.frombuffer(starts, np.int64)
            out.append((t, (at[:, None] + hit).ravel().tobytes()))
        if n + 1 == len(live) or rows[live[n + 1]][1] != own:
            for w in waiting:
                automaton.add(spans[w])
            waiting.clear()
    return out


def _shards(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by hash; a shard is a run of whole hashes of some SHARD_WORDS words."""
        held: list[tuple] = []
        size, last = 0, None

        def emit() -> pa.RecordBatch:
            hits = shard_hits(held, window) if held else []
            return pa.record_batch(
                [pa.array([t for t, _ in hits], pa.int64()), pa.array([b for _, b in hits], pa.binary())], ["t", "hit"]
            )

        for batch in batches:
            for h, t, owner, at, words in zip(
                *(batch.column(c).to_pylist() for c in ("h", "t", "owner", "at", "words")), strict=True
            ):
                if size > SHARD_WORDS and h != last:
                    yield emit()
                    held, size = [], 0
                held.append((t, owner, at, words))
                size += words.count(b" ") + 1
                last = h
        yield emit()

    return run


def _kept(window: int, texts: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                words = r["text"].split()
                cover = np.zeros(len(words) + 1, np.int64)
                for hit in r["hits"] or ():
                    at = np.unique(np.frombuffer(hit, np.int64))
                    cover[at] += 1
                    np.subtract.at(cover, at + window, 1)
                gone = np.cumsum(cover[:-1]) > 0
                kept = b" ".join(w for w, g in zip(words, gone.tolist(), strict=True) if not g) if gone.any() else b" ".join(words)
                row = {
                    "t": r["t"],
                    "owner": r["owner"],
                    "n_words": len(words),
                    "n_removed": int(gone.sum()),
                    "kept_sha256": hashlib.sha256(kept).hexdigest(),
                }
                out.append(row | {"kept": kept.decode()} if texts else row)
            names = [("t", pa.int64()), ("owner", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string())]
            yield pa.RecordBatch.from_pylist(out, pa.schema(names + [("kept", pa.string())] * texts))

    return run


def dedup(docs: DataFrame, window: int = 13, texts: bool = True) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_sha256 and, with ``texts``, kept.

    Words are runs between ASCII white space.  Null and empty texts have none
    and keep an empty text, as does a text shorter than the window keep all its
    words.  Rows with the same doc_id never remove each other's words; a null id
    counts as larger than any other, and two null ids as the same.  An empty
    table gives no rows.  Texts are told apart by a 64-bit hash.
    """
    if not GRAM <= window <= 63:
        raise ValueError("the window must hold 4 to 63 words")
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("t"),
        F.coalesce(F.col("text").cast("binary"), F.lit(b"").cast("binary")).alias("text"),
    )
    unique = rows.groupBy("t").agg(
        F.min(F.coalesce("doc_id", F.lit(NO_ID))).alias("owner"), F.first("text").alias("text")
    )
    grams = map_batches(unique, _grams(window, True), "h long, t long, at binary")
    shared = map_batches(unique, _grams(window, False), "h long").groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h", (F.col("n") > HOT).alias("hot"))
    around = grams.join(shared, "h").groupBy("t").agg(F.collect_list(F.struct("h", "hot", "at")).alias("spans"))
    spans = map_batches(unique.join(around, "t"), _spans(window), "h long, t long, owner long, at binary, words binary")
    dealt = spans.where("h is not null").repartition("h").sortWithinPartitions("h")
    by_shard = map_batches(dealt, _shards(window), "t long, hit binary")
    hot = spans.where("h is null")
    first = hot.groupBy("words").agg(F.min("owner").alias("first"))
    by_word = hot.join(first, "words").where("first < owner").select("t", F.col("at").alias("hit"))
    hits = by_shard.unionAll(by_word).groupBy("t").agg(F.collect_list("hit").alias("hits"))
    result = map_batches(
        unique.join(hits, "t", "left"),
        _kept(window, texts),
        "t long, owner long, n_words long, n_removed long, kept_sha256 string" + ", kept string" * texts,
    )
    copy = (F.coalesce("doc_id", F.lit(NO_ID)) > F.col("owner")) & (F.col("n_words") >= window)
    out = rows.select("doc_id", "t").join(result, "t").select(
        "doc_id",
        "n_words",
        F.when(copy, F.col("n_words")).otherwise(F.col("n_removed")).alias("n_removed"),
        F.when(copy, F.sha2(F.lit(""), 256)).otherwise(F.col("kept_sha256")).alias("kept_sha256"),
        *([F.when(copy, F.lit("")).otherwise(F.col("kept")).alias("kept")] if texts else []),
    )
    return out
