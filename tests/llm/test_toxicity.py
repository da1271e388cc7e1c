"""Toxicity: the kernel against brute force, folded weights, held-out accuracy, odd texts."""

import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from roadlake.llm import toxicity
from roadlake.llm.quality import fold


def brute(s, t):
    """Gap-weighted common subsequences of two windows between edges, divided by the norms of their lengths."""

    def features(w):
        codes = [toxicity._EDGE, *(int(toxicity._CODE[c]) for c in w), toxicity._EDGE]
        out = {}
        for n in toxicity.LENGTHS:
            for at in itertools.combinations(range(len(codes)), n):
                if at[-1] - at[0] < toxicity.SPAN:
                    key = tuple(codes[i] for i in at)
                    out[key] = out.get(key, 0) + toxicity.DECAY ** (at[-1] - at[0] + 1)
        return out

    def norm(w):
        n = len(w) + 2
        places = (at for m in toxicity.LENGTHS for at in itertools.combinations(range(n), m) if at[-1] - at[0] < toxicity.SPAN)
        return math.sqrt(sum(toxicity.DECAY ** (2 * (at[-1] - at[0] + 1)) for at in places)) or 1

    a, b = features(s), features(t)
    return sum(v * b.get(k, 0) for k, v in a.items()) / norm(s) / norm(t)


ITEMS = [b"idiot", b"i.d.i.o.t", b"a", b"", b"aaaaaa", b"moron0", "réeux".encode().translate(None, toxicity._LEADS), b"x" * 32]


def test_kernel_equals_brute_force():
    got = toxicity.Kernel(ITEMS)(ITEMS)
    assert np.allclose(got, [[brute(s, t) for t in ITEMS] for s in ITEMS])


def test_folded_weights_equal_the_kernel_machine():
    kernel = toxicity.Kernel(ITEMS)
    beta = np.random.default_rng(0).normal(size=len(ITEMS))
    model = toxicity.Model(kernel.keys, kernel.folded(beta), 0.5)
    words = [b"idiots", b"tidi", b"", b"moron.", b"q" * 20]
    assert np.allclose(model.margins(words), kernel(words) @ beta + 0.5, atol=1e-5)


def test_svm_reaches_the_least_loss():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(200, 3))
    y = np.sign(x[:, 0] + 0.3 * rng.normal(size=200)) * rng.choice([1.0, 3.0], 200)
    weight = rng.uniform(0.5, 2, 200)
    w = toxicity._svm(x, y, weight, 2.0)

    def loss(w):
        f = x @ w[:-1] + w[-1]
        return (weight * np.maximum(0, np.abs(y) - np.sign(y) * f) ** 2).sum() + 2 * (w[:-1] ** 2).sum()

    assert all(loss(w) <= loss(w + 1e-3 * rng.normal(size=4)) + 1e-9 for _ in range(200))


def test_windows():
    found = toxicity.windows("You, I-D-I-O-T! m o r o n; the 3rd É\té è\n***".encode())
    fold = lambda s: s.encode().translate(toxicity._FOLD, toxicity._LEADS)
    assert {b"you", b"i.d.i.o.t", b"idiot", b"m.o.r.o.n", b"moron", b"0rd", fold("é"), b"the"} <= found
    assert b"" not in found and not any(w.startswith(b".") for w in found)
    assert toxicity.windows(b"") == toxicity.windows(b" \n\t ...") == set()


def test_long_words_and_texts_lose_no_window():
    word = b"ab" * 40 + b"idiot" + b"cd" * 40
    assert any(b"idiot" in w for w in toxicity.windows(word))
    text = b"lorem ipsum " * 300_000 + b"moron " + b"dolor\n" * 400_000
    assert {b"moron", b"lorem", b"dolor"} <= toxicity.windows(text)
    solid = b"z" * 5_000_000
    assert toxicity.windows(solid) == {b"z" * 32}
    parts = list(toxicity.parts(text, 1 << 16))
    assert len(parts) > 10 and max(map(len, parts)) <= 3 << 16


def test_sentences():
    text = b"Go a.way. Now!\n\nOk"
    assert [text[a:b].strip() for a, b in toxicity.sentences(text)] == [b"Go a.way.", b"Now!", b"Ok"]


@pytest.fixture(scope="module")
def trained(spark, sf_small):
    docs, labels = (spark.read.parquet(f"{sf_small.replace('sf0.001', 'sf0.01')}/{t}.parquet") for t in ("documents", "labels"))
    return docs, labels, toxicity.train(docs, labels)


def test_held_out_accuracy(trained):
    docs, labels, model = trained
    rows = toxicity.score(docs, model).join(labels, "doc_id").where("held_out").collect()
    hits = sum(r.predicted == r.toxic for r in rows)
    assert len(rows) > 40 and hits / len(rows) > 0.9
    bad, good = ([r.score for r in rows if r.toxic == y] for y in (1, 0))
    assert sum(a > b for a in bad for b in good) / (len(bad) * len(good)) > 0.8  # some labels follow no word


def test_gapped_and_disturbed_insults(spark, trained, documents):
    _, _, model = trained
    plain = "The and attion to that nere {} of threing the. Ouea as onsh anst."
    words = ["i-d-i-o-t", "m o r o n", "path*etic", "idiot###", "STUPID", "disgusting, worthless"]
    rows = [(i, plain.format(w)) for i, w in enumerate(words)] + [(50, plain.format("thing"))]
    got = {r.doc_id: r.predicted for r in toxicity.score(documents(rows), model).collect()}
    assert sum(got[i] for i in range(len(words))) >= len(words) - 1 and not got[50]
    found = toxicity.toxic_sentences(documents([(1, plain.format("pathetic moron")), (2, None)]), model).collect()
    assert [(r.doc_id, "moron" in r.sentence, r.start) for r in found] == [(1, True, 0)]


def test_every_row_is_scored(documents, trained):
    _, _, model = trained
    rows = [(1, "idiot"), (1, "idiot"), (2, None), (3, ""), (None, "moron trash"), (4, "w " * 400_000)]
    df = documents(rows, score="x", toxic=1, w=0)
    got = toxicity.score(df, model).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    score = {r.doc_id: r.score for r in got}
    assert score[2] == score[3] <= min(score.values()) + 0.05 and [r.held_out for r in got if r.doc_id is None] == [False]
    assert toxicity.score(df.limit(0), model).count() == 0


def test_labels_of_one_kind_or_none(spark, documents):
    docs = documents([(i, f"some text {i}") for i in range(6)])
    labels = spark.createDataFrame([(i, 1, 0) for i in range(6)] + [(None, 1, 1), (3, 1, None)], "doc_id long, quality int, toxic int")
    model = toxicity.train(docs, labels)
    assert {r.predicted for r in toxicity.score(docs, model).collect()} == {0}
    model = toxicity.train(docs, labels.limit(0))
    assert {r.score for r in toxicity.score(docs, model).collect()} == {0.5}


def test_an_id_in_many_rows_teaches_once(spark, documents):
    docs = documents([(1, "a b c")]).crossJoin(spark.range(20_000)).drop("id").unionByName(documents([(2, "moron")]))
    labels = spark.createDataFrame([(1, 0, 0), (2, 0, 1), (2, 0, 0)], "doc_id long, quality int, toxic int")
    sample = toxicity.labelled(docs, labels, 100)
    assert sorted((r.doc_id, bytes(r.text), r.y) for r in sample.collect()) == [
        (i, t, y) for i, t, y in ((1, b"a b c", 0), (2, b"moron", 1)) if docs.select(fold(F.lit(i))).first()[0] != 0
    ]
