"""Quality classifier: histogram gradient-boosted trees over document statistics.

The statistics read the whole text and nothing else.  The trees are grown on a
bounded sample of labelled rows (``max_rows``, the rows of smallest id hash) and
flattened into arrays of features, thresholds and leaf values, which a batch of
documents passes level by level in numpy.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadlake.llm.common import filter_batches, id_and_text, map_batches, store

THRESHOLD = 0.3

_CLASSES = {
    "upper": range(65, 91),
    "lower": range(97, 123),
    "digit": range(48, 58),
    "high": range(128, 256),
    "space": b" ",
    "line": b"\n",
    "stop": b".!?",
    "comma": b",;:",
    "bang": b"!",
    "bar": b"|",
    "sign": b"#$%&*+<=>@\\^_`{}~",
    "slash": b"/",
    "quote": b"\"'()[]-",
    "control": [*range(9), 11, 12, *range(14, 32), 127],
}
_BY_CLASS = np.zeros((256, len(_CLASSES)))
for _k, _bytes in enumerate(_CLASSES.values()):
    _BY_CLASS[list(_bytes), _k] = 1

_SIGN = re.compile(rb"[#$%&*+<=>@\\^_`{}~|]|!!")
FEATURES = [
    *_CLASSES, "log_bytes", "log_words", "word_bytes", "longest_word", "distinct_words", "distinct_lines", "line_words",
    "top_byte", "byte_entropy", "signs_a_word", "short_words", "capital_words", "shouted_words", "same_word_next",
]


def statistics(text: bytes) -> list[float]:
    """FEATURES of a whole text; all zero where there is nothing to divide by."""
    n = len(text)
    if not n:
        return [0.0] * len(FEATURES)
    counts = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    shares = counts / n
    seen = shares[shares > 0]
    words = text.split()
    lines = [x for x in text.split(b"\n") if x]
    m, k = max(1, len(words)), max(1, len(lines))
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    return [
        *(shares @ _BY_CLASS).tolist(),
        math.log1p(n),
        math.log1p(len(words)),
        float(sizes.sum()) / m,
        math.log1p(int(sizes.max(initial=0))),
        len(set(words)) / m,
        len(set(lines)) / k,
        math.log1p(m / k),
        float(shares.max()),
        float(-(seen * np.log2(seen)).sum()),
        len(_SIGN.findall(text)) / m,
        float((sizes <= 3).sum()) / m,
        sum(map(bytes.istitle, words)) / m,
        sum(map(bytes.isupper, words)) / m,
        sum(map(bytes.__eq__, words[1:], words)) / m,
    ]


def matrix(texts: list[bytes]) -> np.ndarray:
    return np.array([statistics(t) for t in texts], dtype=np.float64).reshape(len(texts), len(FEATURES))


@dataclass
class Forest:
    """Complete trees as arrays: node i of a tree has the children 2i + 1 and 2i + 2."""

    base: float
    feature: np.ndarray  # (trees, inner nodes)
    threshold: np.ndarray  # (trees, inner nodes); inf sends all to the left
    value: np.ndarray  # (trees, leaves)

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        rows = np.arange(len(x))
        inner = self.feature.shape[1]
        for feature, threshold, value in zip(self.feature, self.threshold, self.value, strict=True):
            node = np.zeros(len(x), np.int64)
            while inner and node[:1].size and node[0] < inner:  # complete: all rows reach the leaves together
                node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
            total += value[node - inner]
        return 1 / (1 + np.exp(-total))


def fit(
    x: np.ndarray, y: np.ndarray, trees: int = 120, depth: int = 4, rate: float = 0.1, bins: int = 64, least: int = 10
) -> Forest:
    """Boosted logistic loss over histograms of at most ``bins`` quantile bins a feature."""
    share = float(y.mean()) if len(y) else 0.5
    inner = 2**depth - 1
    constant = not len(y) or share in (0.0, 1.0)
    base = math.log((share + 1e-3) / (1 - share + 1e-3))
    n = 0 if constant else trees
    forest = Forest(base, np.zeros((n, inner), np.int64), np.full((n, inner), np.inf), np.zeros((n, inner + 1)))
    if constant:
        return forest
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(x.shape[1])]
    binned = np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)], axis=1)
    total = np.full(len(y), base)
    for t in range(trees):
        p = 1 / (1 + np.exp(-total))
        grad, hess = y - p, p * (1 - p)
        node = np.zeros(len(y), np.int64)
        for level in range(depth):
            first, width = 2**level - 1, 2**level
            place = node - first
            best = np.full(width, 1e-6)
            for f, e in enumerate(edges):
                if not len(e):
                    continue
                cell = place * (bins + 1) + binned[:, f]
                g, h, c = (
                    np.bincount(cell, w, width * (bins + 1)).reshape(width, -1).cumsum(axis=1)
                    for w in (grad, hess, None)
                )
                left = slice(0, len(e))
                gain = lambda a, b: a * a / (b + 1.0)
                rise = (
                    gain(g[:, left], h[:, left])
                    + gain(g[:, -1:] - g[:, left], h[:, -1:] - h[:, left])
                    - gain(g[:, -1:], h[:, -1:])
                )
                rise[(c[:, left] < least) | (c[:, -1:] - c[:, left] < least)] = 0
                at = rise.argmax(axis=1)
                top = rise[np.arange(width), at]
                better = np.flatnonzero(top > best)
                best[better] = top[better]
                forest.feature[t, first + better] = f
                forest.threshold[t, first + better] = e[at[better]]
            node = 2 * node + 1 + (x[np.arange(len(y)), forest.feature[t, node]] > forest.threshold[t, node])
        leaf = node - inner
        g, h = np.bincount(leaf, grad, inner + 1), np.bincount(leaf, hess, inner + 1)
        forest.value[t] = rate * g / (h + 1.0)
        total += forest.value[t][leaf]
    return forest


def fold(doc_id, folds: int = 5):
    """crc32 of the id as text, modulo ``folds``; null for a null id."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(folds))


def train(docs: DataFrame, labels: DataFrame, max_rows: int = 20_000) -> Forest:
    """Learn from labelled rows outside fold 0, at most ``max_rows`` of them.

    Null ids and labels teach nothing; of several rows with an id one text does.
    Without rows, or with one label only, the model is the share of that label.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("double").alias("y"))
    sample = (
        known.where("doc_id is not null and y is not null")
        .where(fold(F.col("doc_id")) != 0)
        .orderBy(F.xxhash64("doc_id"), "doc_id", "y")
        .limit(max_rows)
    )

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column("text").to_pylist())
            yield pa.record_batch(
                [batch.column("doc_id"), batch.column("y"), pa.array([r.tobytes() for r in x], pa.binary())],
                ["doc_id", "y", "x"],
            )

    sample = store(sample)
    one_text = (  # an id may stand in many rows: the largest text teaches
        id_and_text(docs).join(F.broadcast(sample.select("doc_id").distinct()), "doc_id").groupBy("doc_id").agg(F.max("text").alias("text"))
    )
    rows = map_batches(
        one_text.join(F.broadcast(sample), "doc_id").select("doc_id", "text", "y"),
        measured,
        "doc_id long, y double, x binary",
    ).toArrow()
    order = np.lexsort([rows.column("y").to_numpy(), rows.column("doc_id").to_numpy()])
    x = np.frombuffer(b"".join(rows.column("x").to_pylist())).reshape(-1, len(FEATURES))
    return fit(x[order], rows.column("y").to_numpy()[order])


def score(docs: DataFrame, forest: Forest) -> DataFrame:
    """(doc_id, held_out, score, predicted), one row per document.

    held_out is true where crc32 of the id modulo 5 is 0, false for a null id.
    Null and empty texts are scored alike, on statistics that are all zero.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s = forest.score(matrix(batch.column("text").to_pylist()))
            yield pa.record_batch([batch.column("doc_id"), pa.array(s)], ["doc_id", "score"])

    return map_batches(id_and_text(docs), run, "doc_id long, score double").select(
        "doc_id",
        F.coalesce(fold(F.col("doc_id")) == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def keep_accepted(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, whole, whose score reaches the threshold."""
    forest = train(docs, labels)

    def accepted(batch: pa.RecordBatch, state: dict) -> list[bool]:
        texts = [(t or "").encode() for t in batch.column("text").to_pylist()]
        return (forest.score(matrix(texts)) >= threshold).tolist()

    return filter_batches(docs, accepted)
