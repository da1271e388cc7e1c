"""Encoder, token counts and packing against the tokenizers library and brute force."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest

from roadlake.llm import packing, token_counts
from roadlake.llm.tokens import encoder

TEXTS = [
    "", " ", "  ", "a", "One two  three\n\n four \n five.\tSix\r\n", "end \n", "end\n ", "x\n \ny", "   lead", "é ß ü  ö z",
    "it's we'll I'M <|endoftext|> done", "12345 67 a1b2", "日本語 テキスト", "<|endoftext|>", "a <|endoftext|> b", "a  <|endoftext|><|endoftext|>\n<|endoftext", " <|endoftext|> ", "tab\t tab", "a​b c", "\x1c x \x1f", "!!! ??? ...",
]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return lambda text: t.encode(text, add_special_tokens=False).ids


def test_encoder_equals_library(library):
    rng = random.Random(5)
    parts = [" ", "  ", "\n", " \n", "\n ", "\t", "word", "Éa", "42", "!", " ", "it's", "<|endoftext|>"]
    texts = TEXTS + ["".join(rng.choices(parts, k=rng.randint(1, 12))) for _ in range(1500)]
    enc = encoder(None)
    for text in texts:
        assert np.frombuffer(enc.encode(text), "<u4").tolist() == library(text), repr(text)


def test_token_counts_brute_force(documents, library):
    texts = [*TEXTS, None, "word " * 300, "word " * 300]
    out = token_counts.token_counts(documents(list(enumerate(texts)), n_tokens=1, band=2)).collect()
    n = [len(library(t or "")) for t in texts]
    assert sorted(r.context_limit for r in out) == sorted(set(n))
    for r in out:
        limit = r.context_limit
        assert r.n_docs == n.count(limit)
        assert r.docs_fitting == sum(x <= limit for x in n) == len(n) - r.docs_truncated
        assert r.total_tokens == sum(n)
        assert r.tokens_within == sum(x for x in n if x <= limit)
        assert r.truncated_total == sum(min(x, limit) for x in n)
        assert r.quantile == pytest.approx(r.docs_fitting / len(n))


def test_token_counts_over_bands(documents):
    out = token_counts.token_counts(documents([(i, " a" * (i * 900)) for i in range(12)])).collect()
    assert {r.context_limit: r.tokens_within for r in out}[9900] == 900 * sum(range(12))


def test_token_counts_empty(documents):
    assert token_counts.token_counts(documents([])).count() == 0


def _packed(df, capacity=1024):
    rows = df.collect()
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append(r)
    for group in by.values():
        at = 0
        for r in sorted(group, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= capacity
    return rows, by


def test_packing_pieces_and_offsets(documents, library):
    rng = random.Random(3)
    texts = [*TEXTS, None, "Long words here. " * 900, "b" * 9000]
    texts += [" ".join(rng.choices(["of", "thing", "Ab,", "ou"], k=rng.randint(0, 700))) for _ in range(150)]
    docs = [(i, t) for i, t in enumerate(texts)] + [(None, "no id"), (None, "no id"), (3, "a"), (3, "a")]
    rows, by = _packed(packing.pack(documents(docs, piece=9, place=1, shard=2), shard_pieces=64))
    want = []
    for d, t in docs:
        ids = library(t or "") + [2]
        n = -(-len(ids) // 1024)
        at, end = 0, len(ids) - 1024 * (n - 1)
        for k in range(n):
            want.append((d, k, at, end - at, zlib.crc32(np.array(ids[at:end], "<u4").tobytes())))
            at, end = end, end + 1024
    key = lambda r: tuple(-1 if x is None else x for x in r)
    assert sorted(map(key, want)) == sorted(key(tuple(r)[:5]) for r in rows)
    assert len(by) <= -(-sum(w[3] for w in want) // 1024) + 6


def test_packing_empty(documents):
    assert packing.pack(documents([])).count() == 0


def test_evolution_beats_or_equals_best_fit_decreasing():
    rng = np.random.default_rng(1)
    lengths = rng.integers(200, 500, 300).tolist()
    first = packing.Bins(lengths, 1024)
    first.best_fit(list(range(300)))
    best = packing.evolve(lengths, [], 1024, 1, 6, 60)
    assert sorted(i for b in best for i in b) == list(range(300))
    assert all(sum(lengths[i] for i in b) <= 1024 for b in best)
    assert len(best) <= len(first.bins)


def test_answers_for_any_limit_and_quantile(documents, library):
    rng = random.Random(8)
    texts = [" ".join(["word"] * rng.choice([0, 1, 5, 300, 513, rng.randrange(3000)])) for _ in range(90)] + [None, ""]
    n = sorted(len(library(t or "")) for t in texts)
    h = token_counts.length_histogram(documents(list(enumerate(texts))))
    limits, shares = [0, 1, 511, 512, 513, 1024, 2048, 131_072], [0.01, 0.25, 0.5, 0.9, 0.999, 1.0]
    rows = token_counts.answers(h, limits, shares).collect()
    by_limit = {r.context_limit: r for r in rows if r.quantile_wanted is None}
    assert sorted(by_limit) == limits
    for limit, r in by_limit.items():
        assert r.docs_fitting == sum(x <= limit for x in n) == len(n) - r.docs_truncated
        assert (r.tokens_within, r.truncated_total, r.total_tokens) == (sum(x for x in n if x <= limit), sum(min(x, limit) for x in n), sum(n))
        assert r.quantile == pytest.approx(r.docs_fitting / len(n))
    by_share = {r.quantile_wanted: r.context_limit for r in rows if r.quantile_wanted is not None}
    import math

    assert by_share == {q: n[math.ceil(q * len(n)) - 1] for q in shares}
    assert token_counts.answers(h.limit(0), limits, shares).count() == 0


def test_short_documents_of_many_shards_come_near_the_floor(documents):
    rng = random.Random(9)
    docs = [(i, " ".join(rng.choices(["of", "thing", "ou"], k=rng.randint(5, 60)))) for i in range(3000)]
    rows, by = _packed(packing.pack(documents(docs), shard_pieces=300))  # ten shards of some ten sequences
    floor = -(-sum(r.length for r in rows) // 1024)
    assert len(rows) == 3000 and len(by) <= floor + 1
