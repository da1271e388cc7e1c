"""Decontamination against a brute-force scan of every window."""

import hashlib
import random
import re

import pytest

from roadlake.llm import decontamination

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))


def brute(docs, items, window=10):
    out = []
    for d, text in docs:
        w = words(text)
        hit, ids = set(), set()
        for item, t in items:
            v = words(t)
            n = min(window, len(v))
            for i in range(len(v) - n + 1 if v else 0):
                for j in range(len(w) - n + 1):
                    if w[j : j + n] == v[i : i + n]:
                        hit |= set(range(j, j + n))
                        ids |= {str(item)} if item is not None else set()
        names = sorted(ids)
        out.append((d, len(w), len(hit), len(names), hashlib.sha256(",".join(names).encode()).hexdigest()))
    return out


def key(r):
    return tuple(-1 if x is None else x for x in r)


@pytest.mark.parametrize("max_bytes", [512 << 10, 300])
def test_against_brute_force(spark, documents, max_bytes):
    rng = random.Random(2)
    vocabulary = ["a", "B", "ab", "Éx", "x1", "don't", "...", "the"]
    sentence = lambda n: " ".join(rng.choices(vocabulary, k=n))
    items = [(i, sentence(rng.randint(1, 30))) for i in range(2, 14)] + [(1, "a b-AB"), (None, "the the x1 x1 don't the"), (20, None), (21, ""), (22, "!!"), (2, "again the éx éx the")]
    docs = [(i, sentence(rng.randint(0, 80)) + ", " + (rng.choice(items)[1] or "")) for i in range(40)]
    docs += [(100, None), (101, ""), (None, items[3][1]), (205, items[0][1]), (205, items[0][1]), (102, "é" + (items[4][1] or ""))]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = decontamination.decontaminate(documents(docs, hits=1, items="x"), benchmark, max_bytes=max_bytes)
    rows = found.collect()
    assert sorted(key(tuple(r)[:5]) for r in rows) == sorted(map(key, brute(docs, items)))
    texts = {}
    for d, t in docs:
        texts.setdefault(d, t)
    for r in rows:
        covered = sum(len(words(texts[r.doc_id][s.start : s.end])) for s in r.spans) if r.spans else 0
        assert covered == r.n_hit


def test_empty_tables(spark, documents):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontamination.decontaminate(documents([]), none).count() == 0
    assert decontamination.decontaminate(documents([(1, "a b")]), none).first().n_hit == 0


def test_keep_clean(spark, documents):
    benchmark = spark.createDataFrame([(1, "one two three four")], "item_id long, text string")
    docs = documents([(1, "x one Two, three four"), (2, "one two"), (None, None), (2, "one two three four")], n_hit=7)
    kept = decontamination.keep_clean(docs, benchmark)
    assert kept.columns == docs.columns
    assert sorted((key((r.doc_id,)), r.text) for r in kept.collect()) == [((-1,), None), ((2,), "one two")]


def test_long_text_with_hits_throughout_takes_linear_time():
    import time

    import numpy as np

    text = "é hit, miss! ".encode() * 400_000  # 5 MB and more
    n = len(words(text.decode()))
    hit = np.arange(n) % 3 == 1
    began = time.process_time()
    found = decontamination.spans(text, hit)
    assert time.process_time() - began < 20 and len(found) == 400_000
    whole = text.decode()
    assert {whole[s["start"] : s["end"]] for s in found[:: 997]} == {"hit"}
