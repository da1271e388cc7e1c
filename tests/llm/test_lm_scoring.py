"""LM scoring: the base against direct counts, the model against its definition."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from roadlake.llm import lm_scoring, recurrent

COUNTS = np.array([40, 25, 20, 9, 9, 5, 3, 2, 1, 1.0])


def model(hidden=4, classes=3, seed=1):
    starts = recurrent.class_starts(COUNTS, classes)
    p = recurrent.fresh(COUNTS, starts, hidden)
    rng = np.random.default_rng(seed)
    return recurrent.Model({k: (v + rng.standard_normal(v.shape) * 0.3).astype(np.float32) for k, v in p.items()}, starts)


def stepwise(m, doc, end):
    """The definition, one word at a time."""
    p, hid = m.p, m.hidden
    h, before, total = np.zeros(hid), end, 0.0
    sig = lambda x: 1 / (1 + np.exp(-x))
    soft = lambda x: np.exp(x - x.max()) / np.exp(x - x.max()).sum()
    for w in doc:
        x, a = p["x"][before], h @ p["u"]
        z, r = sig(x[:hid] + a[:hid]), sig(x[hid : 2 * hid] + a[hid : 2 * hid])
        n = np.tanh(x[2 * hid :] + r * a[2 * hid :])
        h = (1 - z) * n + z * h
        k = m.of[w]
        a, b = m.starts[k], m.starts[k + 1]
        words = soft(p["w"][a:b] @ h + p["wb"][a:b])
        assert soft(p["c"] @ h + p["cb"]).sum() == pytest.approx(1) and words.sum() == pytest.approx(1)
        total += math.log(soft(p["c"] @ h + p["cb"])[k]) + math.log(words[w - a])
        before = w
    return total


def docs_of(n=23):
    rng = np.random.default_rng(2)
    return [rng.integers(0, 10, rng.integers(1, 40)).astype(np.int32) for _ in range(n)] + [np.zeros(150, np.int32)]


@pytest.mark.parametrize("width,window", [(1, 7), (4, 16), (64, 3), (8, 500)])
def test_likelihood_is_of_whole_documents(width, window):
    m, docs = model(), docs_of()
    assert np.allclose(m.log_likelihood(docs, 2, width, window), [stepwise(m, d, 2) for d in docs], rtol=1e-4)


def test_gradients():
    m, docs = model(), docs_of(5)
    p = {k: v.astype(np.float64) for k, v in m.p.items()}
    n = sum(map(len, docs))
    memory = {k: np.zeros_like(v) for k, v in m.p.items()}
    start = {k: v.copy() for k, v in m.p.items()}
    m.learn(docs, 2, memory, 1e-12, 64, 1000)  # one window: no truncation; memory holds the squared gradient
    rng = np.random.default_rng(3)
    for name, g2 in memory.items():
        for _ in range(4):
            at = tuple(rng.integers(0, s) for s in g2.shape)
            loss = []
            for step in (1e-3, -1e-3):
                q = {k: v.copy() for k, v in p.items()}
                q[name][at] += step
                loss.append(sum(stepwise(recurrent.Model(q, m.starts), d, 2) for d in docs) / n)
            assert abs((loss[0] - loss[1]) / 2e-3) == pytest.approx(math.sqrt(g2[at]), rel=0.02, abs=2e-5), name
    assert all(np.allclose(start[k], m.p[k], atol=1e-9) for k in start)


def test_learning_finds_an_order():
    docs = [np.array([0, 1, 2, 3] * 10, np.int32) for _ in range(40)]
    m = model()
    before = m.log_likelihood(docs, 2).sum()
    memory = {k: np.full_like(v, 1e-8) for k, v in m.p.items()}
    for _ in range(12):
        m.learn(docs, 2, memory, 0.1, 16, 8)
    assert m.log_likelihood(docs, 2).sum() > before / 4


def text(rng, n):
    return " ".join(rng.choice(["the", "The", "of", f"r{rng.randrange(60)}", "é", "x,"]) for _ in range(n))


def test_base_score_against_direct_counts(documents):
    rng = random.Random(6)
    docs = [(i, text(rng, rng.randint(0, 60))) for i in range(80)] + [(90, None), (91, ""), (None, "the of"), (3, "dup"), (3, "dup")]
    docs += [(next(i for i in range(100, 200) if zlib.crc32(str(i).encode()) % 7 == 2), "unseen word the")]
    low = lambda t: (t or "").encode().lower().split()
    held = lambda d: d is not None and zlib.crc32(str(d).encode()) % 7 == 2
    c = Counter()
    for d, t in docs:
        if not held(d):
            c.update([*low(t), b"\n"])
    n, v = sum(c.values()), len(c)
    out = lm_scoring.score(documents(docs, rid=1, logp=2), vocabulary=3, head=8, share=0.5).collect()
    want = sorted(
        (-1 if d is None else d, held(d), len(low(t)) + 1, sum(c[w] > 0 for w in [*low(t), b"\n"]), n,
         round(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in [*low(t), b"\n"]), 6))
        for d, t in docs
    )
    assert want == sorted(
        (-1 if r.doc_id is None else r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in out
    )
    assert all(r.score < 0 for r in out)
    by = {(r.doc_id, round(r.score, 6)) for r in out if r.doc_id in (90, 91)}
    assert len({s for _, s in by}) == 1


def test_score_is_a_distribution(documents):
    """Over all one-word texts of the vocabulary and one unseen word, the probabilities stay below one."""
    train = [(i, t) for i, t in enumerate(["a b", "a c", "a d e", "b a"] * 30)]
    probe = [(i, w) for i, w in zip((1000 + k for k in range(300)), ["", "a", "b", "c", "d", "e", "unseen"])]
    rows = [(d, t) for d, t in train if zlib.crc32(str(d).encode()) % 7 != 2]
    ids = [i for i in range(1000, 3000) if zlib.crc32(str(i).encode()) % 7 == 2][: len(probe)]
    probe = [(i, w) for i, (_, w) in zip(ids, probe)]
    out = {r.doc_id: r.score for r in lm_scoring.score(documents(rows + probe), vocabulary=2, head=3, share=1.0).collect()}
    assert sum(10 ** out[i] for i in ids) < 1.0
    assert out[ids[1]] > out[ids[4]]  # a is likelier than d


def test_empty_table_and_no_training(documents):
    assert lm_scoring.score(documents([])).count() == 0
    i = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2)
    r = lm_scoring.score(documents([(i, "a b")])).first()
    assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) == (True, 3, 0, 0, 0.0)


def test_weights_learn_from_every_training_document_once(documents, monkeypatch):
    seen, learnt = [], lm_scoring._learnt

    def watched(training, *rest):
        seen.extend(bytes(r.text).decode() for r in training.collect())
        return learnt(training, *rest)

    monkeypatch.setattr(lm_scoring, "_learnt", watched)
    docs = [(i, f"w{i} of") for i in range(40)] + [(i, "a hot text") for i in range(40, 60)] + [(None, "no id"), (60, None)]
    assert lm_scoring.score(documents(docs)).count() == len(docs)
    assert sorted(seen) == sorted(t or "" for d, t in docs if d is None or zlib.crc32(str(d).encode()) % 7 != 2)


def test_vocabulary_and_classes_grow_with_the_corpus():
    head = [(b"w%d" % i, 10_000 - i) for i in range(9000)]
    assert len(lm_scoring.Vocabulary(head, 10**9, 10**6, 2000).ids) == 2000
    v = lm_scoring.Vocabulary(head, 10**10, 64 * 10**6, 2000)
    assert len(v.ids) == 8000 and len(lm_scoring.class_starts(v.counts)) - 1 > lm_scoring.CLASSES


def test_scores_do_not_depend_on_partitions(spark, sf_small, monkeypatch):
    monkeypatch.setattr(lm_scoring, "SHARD_TOKENS", 15_000)  # several shards a round
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    found = []
    for n in (2, 16, 64):
        rows = lm_scoring.score(docs.repartition(n)).collect()
        found.append({r.doc_id: (r.score, r.base_score, r.n_known) for r in rows})
    assert found[0].keys() == found[1].keys() == found[2].keys()
    for k, want in found[0].items():
        for other in found[1:]:
            assert other[k][0] == pytest.approx(want[0], rel=1e-6) and other[k][1] == pytest.approx(want[1]) and other[k][2] == want[2]


def test_one_long_document_needs_memory_for_itself_only():
    import tracemalloc

    docs = [np.zeros(5_000_000, np.int32), *[np.zeros(5, np.int32)] * 1000]
    m = model()
    tracemalloc.start()
    windows = recurrent._windows(docs, 1024, 32, 2)
    for _ in range(3):
        words, before, first, there, doc, k = next(windows)
        m._output(np.zeros((int(there.sum()), 4), np.float32), words[there], None)
    assert k == 1 and tracemalloc.get_traced_memory()[1] < 500e6
    tracemalloc.stop()


def test_pieces_of_long_documents_are_all_learnt():
    docs = [np.arange(10, dtype=np.int32).repeat(130), np.array([2], np.int32), np.zeros(0, np.int32)]
    m, seen = model(), []
    output = m._output
    m._output = lambda s, w, update: (seen.extend(w.tolist()), output(s, w, update))[1]
    m.learn(docs, 2, {k: np.full_like(v, 1e-8) for k, v in m.p.items()}, 0.1, 4, 16, piece=100)
    assert sorted(seen) == sorted(np.concatenate(docs).tolist())


def odd_model(scale, starts=(0, 1, 4, 10)):
    """Weights of some size; the first class has one word only."""
    m = model()
    m = recurrent.Model(m.p, np.array(starts))
    p = {k: v * scale if k in ("c", "w") else v for k, v in m.p.items()}
    p["c"] = p["c"][: len(starts) - 1]
    p["cb"] = p["cb"][: len(starts) - 1]
    return recurrent.Model(p, m.starts)


@pytest.mark.parametrize("scale", [1, 300])  # 300: logits that need a shift
def test_likelihood_of_large_logits_and_classes_of_one_word(scale):
    m, docs = odd_model(scale), docs_of()
    with np.errstate(all="raise", under="ignore"):
        found = m.log_likelihood(docs, 2, 4, 16)
    assert np.allclose(found, [stepwise(m, d, 2) for d in docs], rtol=1e-4)


@pytest.mark.parametrize("scale", [1, 40])
def test_gradients_of_large_logits_and_classes_of_one_word(scale):
    m, docs = odd_model(scale), [d[:6] for d in docs_of(4)]
    p = {k: v.astype(np.float64) for k, v in m.p.items()}
    n = sum(map(len, docs))
    memory = {k: np.zeros_like(v) for k, v in m.p.items()}
    m.learn(docs, 2, memory, 1e-12, 64, 1000)
    assert not memory["w"][0].any() and not memory["wb"][0]  # alone in its class
    loss = lambda q: sum(stepwise(recurrent.Model(q, m.starts), d, 2) for d in docs) / n
    rng = np.random.default_rng(4)
    for name, g2 in memory.items():
        for _ in range(4):
            at, two = tuple(rng.integers(0, s) for s in g2.shape), []
            for step in (1e-5, -1e-5):
                q = {k: v.copy() for k, v in p.items()}
                q[name][at] += step
                two.append(loss(q))
            assert abs(two[0] - two[1]) / 2e-5 == pytest.approx(math.sqrt(g2[at]), rel=0.02, abs=1e-4), name


def test_closed_gates_raise_no_warning():
    m = model()
    m.p["x"][:, :8] = -1000
    with np.errstate(all="raise", under="ignore"):
        found = m.log_likelihood(docs_of(3), 2)
    assert np.isfinite(found).all()


def test_learning_spends_nothing_on_likelihoods_and_sorts_short_numbers(monkeypatch):
    """The costs that took the query over its limit: logarithms nobody reads, and slow sorts of each window's words."""
    m, kinds, argsort = model(), set(), np.argsort
    monkeypatch.setattr(recurrent.np, "log", lambda *a, **b: pytest.fail("a logarithm in learning"))
    monkeypatch.setattr(recurrent.np, "argsort", lambda a, *x, **b: (kinds.add(a.dtype), argsort(a, *x, **b))[1])
    monkeypatch.setattr(recurrent, "lanes", lambda *a, f=recurrent.lanes: (f(*a), kinds.clear())[0])
    m.learn(docs_of(5), 2, {k: np.full_like(v, 1e-8) for k, v in m.p.items()}, 0.1, 4, 16)
    assert kinds == {np.dtype(np.uint16)}


@pytest.mark.parametrize("distinct", [10, 1 << 16, 1 << 17])
def test_words_are_ordered_by_number_at_any_vocabulary(distinct):
    words = np.random.default_rng(5).integers(0, distinct, 3000).astype(np.int32)
    words[:2] = distinct - 1, 0
    assert recurrent._by_word(words, distinct).tolist() == sorted(range(3000), key=words.__getitem__)
