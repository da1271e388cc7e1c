"""Toxicity: a subsequence string-kernel support vector machine with Nyström landmarks.

The kernel counts subsequences of three and four characters, gaps allowed, up to a span
of ``SPAN``; each occurrence weighs ``DECAY`` to the power of its span, and
a value is divided by the norms that two windows of these lengths have if nothing in
them repeats.  Inserted characters and gaps lower a match without ending it.  It is taken between
landmarks, which are windows of labelled sentences, and the windows of a text:
its words, and runs of single spaced characters as one window, with their inner
signs and without them.

Labels belong to whole texts.  Landmarks are the windows that lean to toxic texts
beyond doubt; they teach with their own counts and ask for a margin that grows with
their odds.  Of clean texts the strongest windows of sentences are clean, chosen
again each round; of a toxic text without a landmark the strongest one is toxic.
The Nyström machine is linear in the kernel values and these are linear in the
subsequences, so that a fitted model is one weight a subsequence.  A text is judged
by its three strongest windows, so that one insult or several doubtful ones count.

Null and empty texts have no window; their score is that of windows without any
known subsequence.  Long texts are read in overlapping parts.
Ties and repeated rows score alike; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from heapq import nlargest
from itertools import groupby, product
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadlake.llm.common import id_and_text, map_batches, store
from roadlake.llm.quality import fold

THRESHOLD = 0.5
LENGTHS = (3, 4)
SPAN = 7
DECAY = 0.8
#: Windows below these smoothed log odds are no toxic landmarks; margins above SURE count on their own.
LEAST_ODDS = 0.5
SURE = 2.0
#: Weight of all toxic windows against all clean ones.
SHARE = 0.1
#: Windows are cut to this many bytes, half a window apart.
WIDTH = 32
PART = 1 << 20

_DIGIT, _SIGN, _EDGE, _TAIL = range(26, 30)
_SIZE = _TAIL + 16
#: Letters, digits, other ASCII; continuation bytes of UTF-8 by their low half, which folds É with é.
_CODE = np.full(256, _SIGN)
_CODE[list(range(97, 123))] = range(26)
_CODE[48] = _DIGIT
_CODE[0x80:0xC0] = _TAIL + np.arange(64) % 16
#: Gaps between the characters of a subsequence of LENGTHS.
_OFFSETS = [g for n in LENGTHS for g in product(range(1, SPAN), repeat=n - 1) if sum(g) < SPAN]
_KEYS = sum(_SIZE**n for n in LENGTHS)

#: Lower-cases A-Z, makes every digit 0 and every other ASCII sign a full stop; UTF-8 lead bytes go.
_FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 48 if 48 <= c <= 57 else 32 if c in b" \t\n\v\f\r" else 46
    for c in range(256)
)
_LEADS = bytes(range(0xC0, 256))
_ONE = rb"[.]*[a-z0\x80-\xbf][.]*"
_SPACED = re.compile(rb"(?<![^ ])" + _ONE + rb"(?: +" + _ONE + rb"){2,}(?![^ ])")
_SIGNS = re.compile(rb"[. ]+")
_SENTENCE = re.compile(rb"[^\n.!?]+(?:[.!?]+(?![\x20\x09-\x0d]|$)[^\n.!?]*)*[.!?]*|[.!?]+")


def _pieces(window: bytes) -> list[bytes]:
    """The window and, if it has inner signs, the window without them, cut to WIDTH."""
    found = []
    for w in (window, window.replace(b".", b"")) if b"." in window else (window,):
        found += [w[i : i + WIDTH] for i in range(0, max(1, len(w) - WIDTH // 2), WIDTH // 2)] if len(w) > WIDTH else [w]
    return found


def parts(text: bytes, size: int = PART) -> Iterator[bytes]:
    """The text in parts of about ``size`` bytes that overlap by two windows or more, cut at spaces where there are any."""
    at = 0
    while len(text) - at > 2 * size:
        cut = max(text.rfind(c, at + size, at + 2 * size) for c in (b" ", b"\n"))
        cut = at + 2 * size if cut < 0 else cut
        yield text[at:cut]
        back = max(text.rfind(c, at, cut - 2 * WIDTH) for c in (b" ", b"\n"))
        at = max(back, cut - 4 * WIDTH)
    yield text[at:]


def windows(text: bytes) -> set[bytes]:
    """Distinct windows of a text: words and runs of three or more spaced single characters, folded, without outer signs."""
    found: set[bytes] = set()
    for part in parts(text.translate(_FOLD, _LEADS)):
        words = {w.strip(b".") for w in set(part.split())}
        odd = {w for w in words if len(w) > WIDTH or b"." in w}
        found |= words - odd
        for w in odd:
            found.update(_pieces(_SIGNS.sub(b".", w)))
        for run in _SPACED.findall(part):
            found.update(_pieces(_SIGNS.sub(b".", run).strip(b".")))
    found.discard(b"")
    return found


def sentences(text: bytes) -> list[tuple[int, int]]:
    """(start, end) of the sentences of a text: they end at a line break, or at [.!?] before white space."""
    return [(m.start(), m.end()) for m in _SENTENCE.finditer(text) if m.group().strip()]


def _laid(items: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(codes, owner) of all items, each between two edges."""
    sizes = np.fromiter(map(len, items), np.int64, len(items))
    owner = np.repeat(np.arange(len(items)), sizes + 2)
    codes = np.full(len(owner), _EDGE, np.int64)
    inside = np.ones(len(owner), bool)
    ends = np.cumsum(sizes + 2)
    inside[ends - 1] = inside[ends - sizes - 2] = False
    codes[inside] = _CODE[np.frombuffer(b"".join(items), np.uint8)]
    return codes, owner


def _subsequences(codes: np.ndarray, owner: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
    """(owner, subsequence, weight) for each pair of gaps."""
    for gaps in _OFFSETS:
        n = len(codes) - sum(gaps)
        if n <= 0:
            continue
        key, at = codes[:n], 0
        for g in gaps:
            at += g
            key = key * _SIZE + codes[at : at + n]
        whole = owner[:n] == owner[at:]
        first = sum(_SIZE**m for m in LENGTHS if m <= len(gaps))
        yield owner[:n][whole], key[whole] + first, DECAY ** (at + 1)


def _norms() -> np.ndarray:
    """By length in bytes: the norm of a window in which no subsequence repeats."""
    out = np.ones(WIDTH + 1)
    for n in range(1, WIDTH + 1):
        out[n] = sum((n + 2 - sum(g)) * DECAY ** (2 * sum(g) + 2) for g in _OFFSETS if n + 2 > sum(g)) ** 0.5
    return out


_NORMS = _norms()


def _divide(values: np.ndarray, items: list[bytes]) -> None:
    sizes = np.fromiter(map(len, items), np.int64, len(items))
    values /= _NORMS[sizes].reshape(-1, *[1] * (values.ndim - 1))


class Kernel:
    """Kernel values against landmarks, from the landmarks' subsequences as sorted (subsequence, landmark, weight)."""

    def __init__(self, landmarks: list[bytes]) -> None:
        self.landmarks = landmarks
        scale = np.ones(len(landmarks))
        _divide(scale, landmarks)
        found = [(k * len(landmarks) + o, w * scale[o]) for o, k, w in _subsequences(*_laid(landmarks))]
        pairs, inverse = np.unique(np.concatenate([k for k, _ in found]) if found else np.zeros(0, np.int64), return_inverse=True)
        self.weight = np.bincount(inverse, np.concatenate([w for _, w in found]) if found else None, len(pairs))
        key, self.landmark = np.divmod(pairs, max(1, len(landmarks)))
        self.keys, self.place, counts = np.unique(key, return_inverse=True, return_counts=True)
        self.end = np.cumsum(counts)
        self.start = self.end - counts

    def __call__(self, items: list[bytes]) -> np.ndarray:
        width = len(self.landmarks)
        out = np.zeros((len(items), width), np.float32)
        for at in range(0, len(items), 1024):
            some = items[at : at + 1024]
            total = np.zeros(len(some) * width)
            for who, key, w in _subsequences(*_laid(some)):
                if not len(self.keys):
                    break
                near = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
                known = self.keys[near] == key
                who, near = who[known], near[known]
                counts = self.end[near] - self.start[near]
                entry = np.repeat(self.start[near] - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())
                total += np.bincount(np.repeat(who, counts) * width + self.landmark[entry], self.weight[entry] * w, len(total))
            block = total.reshape(len(some), width)
            _divide(block, some)
            out[at : at + len(some)] = block
        return out

    def folded(self, beta: np.ndarray) -> np.ndarray:
        """The weight of each of ``keys`` in the machine with the coefficient beta at each landmark."""
        return np.bincount(self.place, self.weight * beta[self.landmark], len(self.keys))


@dataclass
class Model:
    """Weights of subsequences, a bias, and the line from a text's evidence to a probability."""

    keys: np.ndarray
    values: np.ndarray
    bias: float
    line: tuple[float, ...] = (1.0, 0.0, 0.0, 0.0, 0.0)

    def table(self) -> np.ndarray:
        """The weight of every subsequence."""
        out = np.zeros(_KEYS, np.float32)
        out[self.keys] = self.values
        return out

    def margins(self, items: list[bytes], table: np.ndarray | None = None) -> np.ndarray:
        table = self.table() if table is None else table
        total = np.zeros(len(items))
        for at in range(0, len(items), 8192):
            some = items[at : at + 8192]
            here = total[at : at + len(some)]
            for who, key, w in _subsequences(*_laid(some)):
                here += np.bincount(who, table[key], len(some)) * w
        _divide(total, items)
        return total + self.bias

    def probability(self, top: list[list[float]]) -> np.ndarray:
        """Of each list of strongest margins, highest first."""
        x = np.array([_evidence(m, self.bias) for m in top], float).reshape(len(top), len(self.line) - 1)
        return 1 / (1 + np.exp(-np.clip(x @ self.line[:-1] + self.line[-1], -500, 500)))


def _evidence(margins: list[float], bias: float) -> list[float]:
    """The strongest margin, what it has above SURE, and what the next two have above zero."""
    m = [min(max(x, -1.0), 4.0) for x in (*margins[:3], *[min(bias, 0.0)] * (3 - len(margins)))]
    return [m[0], max(m[0] - SURE, 0.0), max(m[1], 0.0), max(m[2], 0.0)]


def _svm(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float, steps: int = 40) -> np.ndarray:
    """Squared hinge loss by Newton's method: ``y`` is a label times the margin wanted of the row.

    The last coefficient is the bias and has no ridge.  ``x`` is taken in slices, whatever its type.
    """
    sign, wanted = np.sign(y), np.abs(y)
    penalty = np.full(x.shape[1] + 1, ridge)
    penalty[-1] = 1e-6
    slices = [slice(i, i + 8192) for i in range(0, len(x), 8192)]

    def values(w: np.ndarray) -> np.ndarray:
        return np.concatenate([x[s] @ w[:-1] for s in slices]) + w[-1]

    def loss(f: np.ndarray, w: np.ndarray) -> float:
        return float((weight * np.maximum(0, wanted - sign * f) ** 2).sum() + (penalty * w * w).sum())

    w = np.zeros(len(penalty))
    f = values(w)
    value = loss(f, w)
    for _ in range(steps):
        gradient, slope = penalty * w, np.diag(penalty)
        for s in slices:
            on = sign[s] * f[s] < wanted[s]
            part = np.hstack([x[s][on].astype(np.float64), np.ones((int(on.sum()), 1))])
            heavy = part * weight[s][on, None]
            gradient += heavy.T @ (f[s][on] - y[s][on])
            slope += heavy.T @ part
        step = np.linalg.solve(slope, gradient)
        size = 1.0
        while (new := loss(moved := values(w - size * step), w - size * step)) > value and size > 1e-4:
            size /= 2
        if value - new < 1e-9 * max(value, 1):
            break
        w, f, value = w - size * step, moved, new
    return w


def _line(x: np.ndarray, y: np.ndarray) -> tuple[float, ...]:
    """Logistic regression on smoothed targets, as Platt's; no weight of evidence is negative."""
    n1, n0 = float(y.sum()), float(len(y) - y.sum())
    target = np.where(y > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -500, 500)))
        slope = (x * (p * (1 - p) + 1e-9)[:, None]).T @ x + 1e-3 * np.eye(len(w))
        w = w - np.linalg.solve(slope, x.T @ (p - target) + 1e-3 * w)
        w[:-1] = np.maximum(w[:-1], 0)
    return tuple(w.tolist())


def disturbed(window: bytes) -> list[bytes]:
    """A toxic window with characters between its letters, one repeated, and one put in."""
    middle = len(window) // 2
    return [
        b".".join(window[i : i + 1] for i in range(len(window)))[:WIDTH],
        b" ".join(window[i : i + 1] for i in range(len(window)))[:WIDTH],
        (window[:middle] + window[middle - 1 : middle] + window[middle:])[:WIDTH],
        (window[:middle] + b"*" + window[middle:])[:WIDTH],
    ]


def labelled(docs: DataFrame, labels: DataFrame, max_rows: int) -> DataFrame:
    """(doc_id, text, y) of at most ``max_rows`` ids outside fold 0, those of the smallest hash, one text an id."""
    known = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("y"))
        .where("doc_id is not null and y is not null")
        .where(fold(F.col("doc_id")) != 0)
        .groupBy("doc_id")
        .agg(F.max("y").alias("y"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(max_rows)
    )
    texts = id_and_text(docs).join(F.broadcast(known), "doc_id")
    return texts.groupBy("doc_id").agg(F.max("text").alias("text"), F.first("y").alias("y"))


def _odds(bad, n, prior: float, log=np.log, doubt: float = 2.0):
    """Smoothed log odds of a window's texts being toxic over those of all texts, less ``doubt`` standard errors."""
    return log((bad + 0.5) / (n - bad + 0.5)) - prior - doubt * (1 / (bad + 0.5) + 1 / (n - bad + 0.5)) ** 0.5


def _choose(sample: DataFrame, prior: float, toxic: int, common: int) -> tuple[dict[bytes, tuple[int, int]], list[bytes]]:
    """Windows that lean to toxic texts with their (toxic, all) texts, and the most common windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text, y in zip(batch.column("text").to_pylist(), batch.column("y").to_pylist(), strict=True):
                found = list(windows(text))
                yield pa.record_batch([pa.array(found, pa.binary()), pa.array([y] * len(found), pa.int32())], ["w", "y"])

    counts = store(
        map_batches(sample.select("text", "y"), run, "w binary, y int")
        .groupBy("w")
        .agg(F.sum("y").cast("double").alias("bad"), F.count("*").cast("double").alias("n"))
    )
    lean = counts.where("bad > 0").withColumn("odds", _odds(F.col("bad"), F.col("n"), prior, F.log))
    rows = lean.orderBy(F.desc("odds"), "w").limit(toxic).collect()
    sure = [r for r in rows if r.odds > LEAST_ODDS] or rows[:10]
    usual = counts.orderBy((F.col("n") - F.col("bad")).desc(), "w").limit(common).select("w").collect()
    return {bytes(r.w): (int(r.bad), int(r.n)) for r in sure}, [bytes(r.w) for r in usual]


def _strongest(sample: DataFrame, model: Model | None, most: int) -> list[tuple[int, int, bytes, float]]:
    """(doc_id, y, window, margin), highest first: the strongest windows of the ``most`` strongest sentences of
    each labelled text; without a model, windows by their hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = model.table() if model else None
        for batch in batches:
            for doc, text, y in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "y")), strict=True):
                bags = [windows(text[a:b]) for a, b in sentences(text)]
                every = sorted(windows(text).union(*bags))
                margins = model.margins(every, table) if model else [crc32(w) / 2**32 for w in every]
                value = dict(zip(every, map(float, margins), strict=True))
                tops = {max(sorted(bag), key=value.__getitem__) for bag in [*bags, every] if bag}
                found = sorted(tops, key=lambda w: (-value[w], w))[:most]
                cells = ([doc] * len(found), [y] * len(found), found, [value[w] for w in found])
                types = (pa.int64(), pa.int32(), pa.binary(), pa.float64())
                yield pa.record_batch([pa.array(c, t) for c, t in zip(cells, types, strict=True)], ["doc_id", "y", "w", "m"])

    found = map_batches(sample, run, "doc_id long, y int, w binary, m double").toArrow()
    rows = zip(*(found.column(c).to_pylist() for c in ("doc_id", "y", "w", "m")), strict=True)
    return sorted(rows, key=lambda r: (r[0], -r[3], r[2]))


def train(
    docs: DataFrame, labels: DataFrame, max_rows: int = 20_000, toxic: int = 224, common: int = 32, most: int = 8,
    rounds: int = 3, room: int = 40_000,
) -> Model:
    """Learn from at most ``max_rows`` labelled texts outside fold 0, ``most`` sentences of each a round.

    At most ``room`` clean windows teach at a time: those of the last round first, then the most frequent.
    Null ids and labels teach nothing.  With one label only, the score is its share.
    """
    sample = store(labelled(docs, labels, max_rows))
    n, bad = sample.agg(F.count("*"), F.sum("y")).first()
    if not n or not 0 < bad < n:
        share = (bad + 0.5) / (n + 1) if n else 0.5
        return Model(np.zeros(0, np.int64), np.zeros(0), 0.0, (0.0, 0.0, 0.0, 0.0, float(np.log(share / (1 - share)))))
    prior = float(np.log((bad + 0.5) / (n - bad + 0.5)))
    lean, usual = _choose(sample, prior, toxic, common)
    kernel = Kernel(list(dict.fromkeys([*lean, *usual])))
    values, vectors = np.linalg.eigh(kernel(kernel.landmarks).astype(np.float64))
    root = vectors / np.sqrt(np.maximum(values, 1e-3 * values.max()))
    wanted = {w: float(np.clip(_odds(float(b), float(m), prior), 1, 4)) for w, (b, m) in lean.items()}
    clean = Counter({w: m - b for w, (b, m) in lean.items() if m > b})
    model: Model | None = None
    for _ in range(rounds):
        guilty = Counter({w: b for w, (b, _) in lean.items()})
        innocent: Counter[bytes] = Counter()
        for _, group in groupby(_strongest(sample, model, most), key=lambda r: r[0]):
            rows = list(group)
            found = [w for _, _, w, _ in rows]
            if not rows[0][1]:
                innocent.update(found)
            elif model and rows[0][3] > 0 and not set(found) & lean.keys():
                guilty[found[0]] += 1
        clean |= innocent
        if len(clean) > room:
            first = sorted(clean, key=lambda w: (w not in lean, w not in innocent, -clean[w], w))[:room]
            clean = Counter({w: clean[w] for w in first})
        bent: Counter[bytes] = Counter()
        least: dict[bytes, float] = {}
        for w, m in guilty.items():
            for v in disturbed(w):
                bent[v] += m / 4
                least[v] = max(least.get(v, 0), 1 + 0.6 * (wanted.get(w, 1.0) - 1))
        x = kernel([*guilty, *bent, *clean]) @ root.astype(np.float32)
        y = np.array([*(wanted.get(w, 1.0) for w in guilty), *(least[w] for w in bent), *([-1.0] * len(clean))])
        weight = np.array([*guilty.values(), *bent.values(), *clean.values()], float)
        weight[y > 0] *= SHARE * weight[y < 0].sum() / weight[y > 0].sum()
        w = _svm(x, y, weight, 1e-5 * weight.sum())
        model = Model(kernel.keys, kernel.folded(root @ w[:-1]), float(w[-1]))
    texts = [list(g) for _, g in groupby(_strongest(sample, model, 3), key=lambda r: r[0])]
    evidence = [_evidence([m for *_, m in rows], model.bias) for rows in texts]
    model.line = _line(np.array(evidence), np.array([rows[0][1] for rows in texts]))
    return model


def _tops(texts: list[bytes], model: Model, table: np.ndarray, cache: dict[bytes, float], room: int = 500_000) -> list[list[float]]:
    """The three strongest margins of each text; margins of windows are kept while there is room."""
    bags = [windows(t) for t in texts]
    new = set().union(*bags).difference(cache)
    if len(cache) + len(new) > room:
        cache.clear()
        new = set().union(*bags)
    items = list(new)
    cache.update(zip(items, model.margins(items, table).tolist(), strict=True))
    return [nlargest(3, map(cache.__getitem__, bag)) for bag in bags]


def _few(texts: list[bytes], size: int = 4 << 20) -> Iterator[list[bytes]]:
    some: list[bytes] = []
    total = 0
    for t in texts:
        some.append(t)
        total += len(t)
        if total > size:
            yield some
            some, total = [], 0
    yield some


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, held_out, score, predicted), one row per document; held_out is false for a null id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache: dict[bytes, float] = {}
        table = model.table()
        for batch in batches:
            texts = batch.column("text").to_pylist()
            chance = model.probability([m for some in _few(texts) for m in _tops(some, model, table, cache)])
            yield pa.record_batch([batch.column("doc_id"), pa.array(chance, pa.float64())], ["doc_id", "score"])

    return map_batches(id_and_text(docs), run, "doc_id long, score double").select(
        "doc_id",
        F.coalesce(fold(F.col("doc_id")) == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def toxic_sentences(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, start, end, sentence, score) of the sentences that reach the threshold; places count UTF-8 bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache: dict[bytes, float] = {}
        table = model.table()
        for batch in batches:
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                places = sentences(text)
                chance = model.probability(_tops([text[a:b] for a, b in places], model, table, cache))
                rows = [(doc, a, b, text[a:b].decode(errors="replace"), s) for (a, b), s in zip(places, chance.tolist(), strict=True) if s >= threshold]
                cells = list(zip(*rows, strict=True)) or [[]] * 5
                types = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.float64())
                yield pa.record_batch([pa.array(c, t) for c, t in zip(cells, types, strict=True)], ["doc_id", "start", "end", "sentence", "score"])

    return map_batches(id_and_text(docs), run, "doc_id long, start long, end long, sentence string, score double")
