"""Benchmark decontamination with an Aho-Corasick automaton.

Items and documents are normalised alike (A-Z lower-cased, words of digits,
letters and non-ASCII bytes, single spaces); every window of ``window`` item
words is one pattern.  Each document is scanned once per automaton, and word
offsets lead back to the original text.  One automaton holds the benchmark when
its text is within ``max_bytes``; a larger benchmark is dealt into blocks by
item, each with its own automaton and pass, so that no broadcast exceeds the bound.
"""

from __future__ import annotations

import hashlib
import pickle
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadlake.llm.common import ALNUM, filter_batches, id_and_text, map_batches, store

_WORD = re.compile(rb"[^ ]+")


def words(text: bytes) -> list[bytes]:
    return text.translate(ALNUM).split()


def patterns(items: list[tuple[str | None, bytes]], window: int) -> dict[bytes, tuple[int, set[str]]]:
    """Normalised window -> (its number of words, ids of the items that hold it)."""
    out: dict[bytes, tuple[int, set[str]]] = {}
    for item, text in items:
        w = words(text)
        size = min(window, len(w))
        for i in range(len(w) - size + 1 if w else 0):
            ids = out.setdefault(b" " + b" ".join(w[i : i + size]) + b" ", (size, set()))[1]
            if item is not None:
                ids.add(item)
    return out


def automaton(found: dict[bytes, tuple[int, set[str]]]):
    import ahocorasick

    a = ahocorasick.Automaton()
    for text, (size, ids) in found.items():
        a.add_word(text.decode("latin-1"), (size, ids))
    if found:
        a.make_automaton()
    return a


def scan(a, text: bytes) -> tuple[int, np.ndarray, set[str]]:
    """Number of words, which of them are hit, and the items whose windows occur."""
    w = words(text)
    hit, ids = np.zeros(len(w), bool), set()
    if len(a) and w:
        ends = None
        for at, (size, items) in a.iter((b" " + b" ".join(w) + b" ").decode("latin-1")):
            if ends is None:
                ends = np.cumsum(np.fromiter(map(len, w), np.int64, len(w)) + 1)  # place of the space after each word
            last = int(np.searchsorted(ends, at))
            hit[last - size + 1 : last + 1] = True
            ids |= items
    return len(w), hit, ids


def runs(hit: np.ndarray) -> list[tuple[int, int]]:
    """(first, last + 1) of the runs of true entries."""
    edge = np.flatnonzero(np.diff(np.r_[False, hit, False].astype(np.int8)))
    return list(zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True))


def spans(text: bytes, hit: np.ndarray) -> list[dict]:
    """Character offsets, in the original text, of the runs of hit words."""
    at = [(m.start(), m.end()) for m in _WORD.finditer(text.translate(ALNUM))]
    before = np.cumsum(np.r_[0, (np.frombuffer(text, np.uint8) & 0xC0) != 0x80], dtype=np.int32)  # characters before a byte
    chars = lambda n: int(before[n])
    return [{"start": chars(at[i][0]), "end": chars(at[j - 1][1])} for i, j in runs(hit)]


STATE = pa.schema([("doc_id", pa.int64()), ("text", pa.binary()), ("hits", pa.binary()), ("items", pa.list_(pa.string()))])
RESULT = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_words", pa.int64()),
        ("n_hit", pa.int64()),
        ("n_items", pa.int64()),
        ("items_sha256", pa.string()),
        ("items", pa.list_(pa.string())),
        ("spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
    ]
)


def _pass(docs: DataFrame, items: list, window: int, last: bool, with_spans: bool) -> DataFrame:
    """One automaton over all rows; ``docs`` carries what earlier automata hit."""
    shared = docs.sparkSession.sparkContext.broadcast(pickle.dumps(patterns(items, window)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a = automaton(pickle.loads(shared.value))
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                n, hit, ids = scan(a, r["text"])
                if r["hits"]:
                    hit |= np.unpackbits(np.frombuffer(r["hits"], np.uint8), count=n).astype(bool)
                ids = sorted(ids.union(r["items"]))
                if last:
                    out.append(
                        {
                            "doc_id": r["doc_id"],
                            "n_words": n,
                            "n_hit": int(hit.sum()),
                            "n_items": len(ids),
                            "items_sha256": hashlib.sha256(",".join(ids).encode()).hexdigest(),
                            "items": ids,
                            "spans": spans(r["text"], hit) if with_spans and hit.any() else [],
                        }
                    )
                else:
                    out.append(r | {"hits": np.packbits(hit).tobytes(), "items": ids})
            yield pa.RecordBatch.from_pylist(out, RESULT if last else STATE)

    if last:
        types = (
            "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, items array<string>, "
            "spans array<struct<start:int,end:int>>"
        )
        return map_batches(docs, run, types)
    return store(map_batches(docs, run, "doc_id long, text binary, hits binary, items array<string>"))


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, window: int = 10, max_bytes: int = 512 << 10, with_spans: bool = True
) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, n_items, items_sha256, items, spans.

    items: sorted ids of items with an occurring window; spans: character
    offsets, in the original text, of the runs of hit words.  A null text or
    item has no words, an item of fewer than ``window`` words is one window, an item without words has none.  An item without an id hits but
    is not listed; items that share an id count once.  Each row is judged by
    itself; an empty table gives no rows, an empty benchmark hits nothing.
    Without ``with_spans`` the spans are left empty.
    """
    state = id_and_text(docs).withColumns({"hits": F.lit(b"").cast("binary"), "items": F.array().cast("array<string>")})
    blocks = _blocks(benchmark, max_bytes)
    for b, items in enumerate(blocks):
        state = _pass(state, items, window, b == len(blocks) - 1, with_spans)
    return state


class _blocks:
    """Blocks of the benchmark, dealt by item to within about ``max_bytes`` of text, read one at a time."""

    def __init__(self, benchmark: DataFrame, max_bytes: int):
        self.texts = benchmark.select(
            F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("binary").alias("text")
        ).where("text is not null")
        size = self.texts.agg(F.sum(F.length("text"))).first()[0] or 0
        self.n = -(-size // max_bytes) or 1

    def __len__(self) -> int:
        return self.n

    def __iter__(self) -> Iterator[list[tuple[str | None, bytes]]]:
        for b in range(self.n):
            some = self.texts.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(self.n)) == b)
            yield [(i, bytes(t)) for i, t in some.distinct().collect()]


def keep_clean(docs: DataFrame, benchmark: DataFrame, window: int = 10, max_bytes: int = 512 << 10) -> DataFrame:
    """The rows of ``docs``, whole, in which no window of an item occurs; null texts stay."""
    for items in _blocks(benchmark, max_bytes):
        docs = _without(docs, items, window)
    return docs


def _without(docs: DataFrame, items: list, window: int) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(pickle.dumps(patterns(items, window)))

    def clean(batch: pa.RecordBatch, state: dict) -> list[bool]:
        if not state:
            state["automaton"] = automaton(pickle.loads(shared.value))
        return [not scan(state["automaton"], (t or "").encode())[1].any() for t in batch.column("text").to_pylist()]

    return filter_batches(docs, clean)
