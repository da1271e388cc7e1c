"""SimHash fingerprints, links and groups against brute force."""

import random

import numpy as np
import xxhash

from roadlake.llm import simhash
from roadlake.llm.components import connected_components


def fingerprint(text):
    w = bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode()).split()
    shingles = [b" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))] if w else []
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def groups(ids, near):
    parent = list(range(len(ids)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(ids)):
        for j in range(i):
            if near(i, j):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    members = {}
    for i in range(len(ids)):
        members.setdefault(find(i), []).append(i)
    return [min((ids[k] for k in members[find(i)] if ids[k] is not None), default=None) for i in range(len(ids))]


def test_fingerprints_match_spark_xxhash64(spark):
    text = "Some words é here"
    h = spark.sql("select xxhash64('some words é') a, xxhash64('words é here') b").first()
    want = (h.a & h.b) % 2**64  # a bit set in over half of two
    assert int(simhash.fingerprint_batch([text.encode()])[0]) == want == fingerprint(text)


def test_groups_against_brute_force(documents):
    rng = random.Random(4)
    base = [rng.choices("abcdefghijklmnop", k=60) for _ in range(6)]
    docs = []
    for i in range(120):
        w = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 2])):
            w[rng.randrange(60)] = rng.choice("xyz")
        docs.append((1000 - i, " ".join(w)))
    docs += [(2000, None), (2001, ""), (2002, " \n"), (None, "a b"), (2003, "A  b"), (7, docs[3][1]), (7, docs[3][1]), (8, "word " * 5000)]
    docs += [(None, "alone without id here")]
    fp = [fingerprint(t) for _, t in docs]
    want = groups([d for d, _ in docs], lambda i, j: (fp[i] ^ fp[j]).bit_count() <= 2)
    out = simhash.simhash_groups(documents(docs, fp=1, component=2, least=3)).collect()
    key = lambda r: tuple(-1 if x is None else x for x in r)
    assert sorted(key((r.doc_id, int(r.fingerprint, 16), r.component_id)) for r in out) == sorted(
        key((d, f, c)) for (d, _), f, c in zip(docs, fp, want, strict=True)
    )


def test_empty_table(documents):
    assert simhash.simhash_groups(documents([])).count() == 0


def test_index_finds_every_near_pair():
    rng = np.random.default_rng(0)
    for n, limit in ((1, 2), (5, 0), (700, 2), (5000, 1)):
        centre = rng.integers(0, 2**64, 3, dtype=np.uint64)
        v = centre[rng.integers(0, 3, n)]
        for _ in range(3):
            v = v ^ (np.uint64(1) << rng.integers(0, 64, n).astype(np.uint64))
        v = np.unique(v)
        index = simhash.GrayIndex(v)
        got = {(int(a), int(b)) for i, j in index.pairs(limit, 512) for a, b in zip(i, j, strict=True)}
        s = index.values
        near = np.bitwise_count(s[:, None] ^ s[None, :]) <= limit
        assert got == set(zip(*map(np.ndarray.tolist, np.nonzero(np.triu(near, 1))), strict=True))


def test_components(spark):
    rng = random.Random(1)
    pairs = [(rng.randrange(400), rng.randrange(400)) for _ in range(230)] + [(900 + i, 901 + i) for i in range(60)]
    pairs += [(5000 + i, 5000) for i in range(300)] + [(3, 3), (7777, 7777)]
    ids = sorted({x for p in pairs for x in p})
    at = {x: i for i, x in enumerate(ids)}
    link = {(max(at[a], at[b]), min(at[a], at[b])) for a, b in pairs}
    want = {x: c for x, c in zip(ids, groups(ids, lambda i, j: (i, j) in link), strict=True)}
    linked = {x for p in pairs for x in p if p[0] != p[1]}
    out = connected_components(spark.createDataFrame(pairs + [(None, 4)], "a long, b long")).collect()
    assert {r.id: r.component for r in out} == {x: c for x, c in want.items() if x in linked}
    assert len(out) == len(linked)
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_keep_one(documents):
    docs = documents([(5, "a b c"), (2, "A b c"), (2, "a b c"), (None, "a b c"), (None, "zz"), (9, "zz top")], component_id=1)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    out = [(r.doc_id, r.text) for r in kept.collect()]
    assert len(out) == 3 and (None, "zz") in out and (9, "zz top") in out and sum(d == 2 for d, _ in out) == 1


def linked_groups(values, links):
    parent = {v: v for v in values}

    def find(v):
        while parent[v] != v:
            v = parent[v]
        return v

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {v: find(v) for v in values}


def spread_values(seed, n, centres, away):
    rng = np.random.default_rng(seed)
    v = rng.integers(0, 2**64, centres, dtype=np.uint64)[rng.integers(0, centres, n)]
    for _ in range(away):
        v = v ^ (np.uint64(1) << rng.integers(0, 64, n).astype(np.uint64))
    return np.unique(v)


def test_pages_connect_what_all_pairs_connect(spark):
    for limit, page in ((2, 16), (0, 16), (3, 64), (2, 100_000)):
        v = np.concatenate([spread_values(1, 900, 30, 3), spread_values(2, 300, 300, 0), np.array([0, 2**64 - 1], np.uint64)])
        v = np.unique(v)
        near = np.bitwise_count(v[:, None] ^ v[None, :]) <= limit
        want = linked_groups(v.tolist(), [(int(v[i]), int(v[j])) for i, j in zip(*np.nonzero(np.triu(near, 1)), strict=True)])
        df = spark.createDataFrame([(int(x),) for x in v.view(np.int64)], "fp long").repartition(3)
        links = [(a % 2**64, b % 2**64) for a, b in simhash.page_links(df, limit, page).collect()]
        assert linked_groups(v.tolist(), [(a % 2**64, b % 2**64) for a, b in simhash.near_links(df, limit).collect()]) == want
        assert linked_groups(v.tolist(), links) == want and len(links) < 12 * len(v)


def test_upper_nodes_drop_whole_groups():
    v = spread_values(3, 40_000, 40_000, 0)
    index = simhash.GrayIndex(v)
    list(index.pairs(2))
    groups = sum(index.dropped[:-1])
    leaves = index.dropped[-1]
    assert groups > 0 and leaves < len(v) ** 2 / 10  # all pairs would look at each leaf for each query
    rng = np.random.default_rng(4)
    pages = np.array_split(index.values, 64)
    every, some = (np.array([f.reduce(p) for p in pages]) for f in (np.bitwise_and, np.bitwise_or))
    roots = simhash.GrayIndex(every & ~(every ^ some), ~(every ^ some))
    q = rng.integers(0, 2**64, 500, dtype=np.uint64)
    visits = sum(len(i) for i, _ in roots.search(q, 2))
    assert sum(roots.dropped) > 0 and visits < 500 * 64 / 2


def test_crowded_values_stay_in_bounded_pages(spark):
    """A third of the values within a few bits: pages are cut by size."""
    v = np.unique(np.concatenate([spread_values(5, 3000, 1, 4), spread_values(6, 6000, 6000, 0)]))
    df = spark.createDataFrame([(int(x),) for x in v.view(np.int64)], "fp long")
    paged = simhash._paged(df, 100)
    assert max(r["count"] for r in paged.groupBy("page").count().collect()) <= 100 and paged.count() == len(v)
