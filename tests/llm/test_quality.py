"""Quality classifier: statistics, trees and held-out accuracy."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from roadlake.llm import quality


def walk(forest, x):
    total = forest.base
    for f, t, v in zip(forest.feature, forest.threshold, forest.value, strict=True):
        node = 0
        while node < len(f):
            node = 2 * node + 1 + int(x[f[node]] > t[node])
        total += v[node - len(f)]
    return 1 / (1 + np.exp(-total))


def test_flat_trees_equal_a_walk_and_learn():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(900, 4))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.5)).astype(float)
    forest = quality.fit(x[:600], y[:600], trees=40)
    score = forest.score(x[600:])
    assert np.allclose(score[:25], [walk(forest, r) for r in x[600:625]])
    assert ((score > 0.5) == y[600:]).mean() > 0.93


@pytest.mark.parametrize("y", [[], [1.0, 1.0], [0.0]])
def test_without_two_labels_the_share_is_the_score(y):
    forest = quality.fit(np.zeros((len(y), 3)), np.array(y))
    s = forest.score(np.ones((2, 3)))
    want = sum(y) / len(y) if y else 0.5
    assert np.allclose(s, want, atol=0.01)


def test_statistics_of_edges():
    assert quality.statistics(b"") == [0.0] * len(quality.FEATURES)
    s = dict(zip(quality.FEATURES, quality.statistics(b"AA bb!! bb!!\nAA bb!! bb!!\n"), strict=True))
    assert s["distinct_lines"] == 0.5 and s["distinct_words"] == pytest.approx(1 / 3) and s["signs_a_word"] == pytest.approx(4 / 6)
    assert np.isfinite(quality.matrix([b" ", b"\n", b"\x00", "é".encode(), b"x" * 200_000])).all()


def test_fold_is_crc32_of_the_id_as_text(spark):
    rows = spark.range(40).select("id", quality.fold(F.col("id")).alias("f")).collect()
    assert all(r.f == zlib.crc32(str(r.id).encode()) % 5 for r in rows)


def test_query_on_driver_tables(spark, sf_small):
    docs, labels = (spark.read.parquet(f"{sf_small}/{t}.parquet") for t in ("documents", "labels"))
    out = {r.doc_id: r for r in quality.score(docs, quality.train(docs, labels)).collect()}
    assert len(out) == docs.count()
    truth = {r.doc_id: r.quality for r in labels.collect()}
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 5 == 0) for d, r in out.items())
    assert all(r.predicted == int(r.score >= 0.3) and 0 <= r.score <= 1 for r in out.values())
    held = [d for d in truth if out[d].held_out]
    assert sum(out[d].predicted == truth[d] for d in held) >= 0.85 * len(held)


def test_odd_rows(spark, documents):
    docs = documents([(1, None), (2, ""), (None, "Some text."), (3, "a"), (3, "a")], score=5, y=1)
    labels = spark.createDataFrame([(1, 1), (1, 0), (None, 1), (3, None), (9, 1), (2, 0), (3, 1)], "doc_id long, quality int")
    forest = quality.train(docs, labels)
    out = quality.score(docs, forest).collect()
    assert len(out) == 5 and len({r.score for r in out if r.doc_id in (1, 2)}) == 1
    assert [r.held_out for r in out if r.doc_id is None] == [False]
    none = labels.where("false")
    assert quality.score(documents([]), quality.train(documents([]), none)).count() == 0
    kept = quality.keep_accepted(docs, none)
    assert kept.columns == docs.columns and kept.count() == 5  # 0.5 for all


def test_an_id_in_many_rows_sends_one_text_to_the_driver(spark, documents, monkeypatch):
    i = next(i for i in range(20) if zlib.crc32(str(i).encode()) % 5)
    docs = documents([(i, "a b c")]).crossJoin(spark.range(100_000)).drop("id")
    labels = spark.createDataFrame([(i, 1, 0), (i, 1, 0)], "doc_id long, quality int, toxic int")
    seen = []
    monkeypatch.setattr(quality, "fit", lambda x, y: seen.append(len(x)))
    quality.train(docs, labels)
    assert seen == [2]
