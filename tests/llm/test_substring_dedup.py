"""Substring dedup against a brute-force comparison of all windows."""

import hashlib
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from roadlake.llm import substring_dedup
from roadlake.llm.automaton import SuffixAutomaton


def split(text):
    return (text or "").encode().split()


def brute(docs, window):
    owner = {}
    for d, text in docs:
        w = split(text)
        for i in range(len(w) - window + 1):
            k = tuple(w[i : i + window])
            d_ = float("inf") if d is None else d
            owner[k] = min(owner.get(k, d_), d_)
    out = []
    for d, text in docs:
        w, gone = split(text), set()
        for i in range(len(w) - window + 1):
            if owner[tuple(w[i : i + window])] < (float("inf") if d is None else d):
                gone |= set(range(i, i + window))
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((d, len(w), len(gone), hashlib.sha256(kept).hexdigest(), kept.decode()))
    return sorted(out, key=lambda r: tuple(-1 if x is None else x for x in r))


def found(df, window, **kw):
    rows = [tuple(r) for r in substring_dedup.dedup(df, window, **kw).collect()]
    return sorted(rows, key=lambda r: tuple(-1 if x is None else x for x in r))


def corpus(seed, n=60, vocabulary=40):
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(vocabulary)}é" if rng.random() < 0.3 else f"w{rng.randrange(vocabulary)}"
    passages = [[word() for _ in range(rng.randint(13, 40))] for _ in range(5)]
    docs = []
    for i in range(n):
        w = []
        for _ in range(rng.randint(0, 5)):
            w += rng.choice(passages) if rng.random() < 0.5 else [word() for _ in range(rng.randint(1, 30))]
        docs.append((rng.randrange(2 * n), rng.choice([" ", "\n", "\t "]).join(w)))
    return docs


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(documents, seed):
    docs = corpus(seed)
    docs += [(500, None), (501, ""), (None, docs[0][1]), (None, "a b c " * 9), (None, "a b c " * 9), docs[5], docs[5]]
    docs += [(502, "same " * 400), (503, "same " * 13), (504, "same " * 12), (505, " ".join(f"u{i}" for i in range(13)))]
    assert found(documents(docs, t=1, owner=2), 13) == brute(docs, 13)


def test_hot_hashes_take_the_exact_way(documents, monkeypatch):
    monkeypatch.setattr(substring_dedup, "HOT", 3)
    docs = corpus(3)
    assert found(documents(docs), 13) == brute(docs, 13)


def test_shards_may_be_small(monkeypatch):
    rows = [(t, t, (0).to_bytes(8, "little"), b" ".join(b"%d" % (i + t % 3) for i in range(6))) for t in range(9)]
    hits = dict(substring_dedup.shard_hits(rows, 5))
    assert set(hits) == set(range(9)) - {0, 1, 2} | {1, 2}


def test_other_windows_and_digest_only(documents):
    docs = corpus(4, vocabulary=6)
    for window in (4, 20):
        assert found(documents(docs), window, texts=False) == sorted(
            (r[:4] for r in brute(docs, window)), key=lambda r: tuple(-1 if x is None else x for x in r)
        )
    with pytest.raises(ValueError):
        substring_dedup.dedup(documents(docs), 3)


def test_empty_table(documents):
    assert substring_dedup.dedup(documents([])).count() == 0


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), max_size=12), max_size=5), st.lists(st.integers(0, 3), max_size=15))
def test_automaton_matching(held, query):
    a = SuffixAutomaton()
    for s in held:
        a.add(s)
    inside = {tuple(s[i:j]) for s in held for i in range(len(s)) for j in range(i + 1, len(s) + 1)}
    want = [max((n for n in range(1, i + 2) if tuple(query[i + 1 - n : i + 1]) in inside), default=0) for i in range(len(query))]
    assert a.matching(query) == want
