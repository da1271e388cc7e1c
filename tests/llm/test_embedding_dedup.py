"""Embedding near-dedup against all pairs."""

import math

import numpy as np
import pytest

from roadlake.llm import embedding_dedup

SCHEMA = "vec_id long, embedding array<float>, label int, n_links int, rep int"


def brute(rows, threshold=0.9):
    def unit(e):
        if not e or any(x is None or not math.isfinite(x) for x in e) or not any(e):
            return None
        v = np.array(e, np.float32).astype(float)
        return v / np.linalg.norm(v)

    u = [unit(r[1]) for r in rows]
    n = len(rows)
    near = [
        [j for j in range(n) if j != i and u[i] is not None and u[j] is not None and len(u[i]) == len(u[j]) and u[i] @ u[j] >= threshold]
        for i in range(n)
    ]
    out = []
    for i in range(n):
        seen, todo = {i}, [i]
        while todo:
            for j in near[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        c = min((rows[k][0] for k in seen if rows[k][0] is not None), default=None)
        out.append((rows[i][0], len(near[i]), c, c is not None and rows[i][0] == c))
    return sorted(out, key=key)


def key(r):
    return tuple(-1 if x is None else x for x in r)


def table(spark, rows):
    return spark.createDataFrame([(i, e, 0, 5, 6) for i, e in rows], SCHEMA)


def found(df, **kw):
    return sorted((tuple(r) for r in embedding_dedup.near_duplicates(df, **kw).collect()), key=key)


def test_against_all_pairs(spark):
    rng = np.random.default_rng(1)
    base = rng.standard_normal((30, 16))
    e = np.vstack([base, base[rng.integers(0, 30, 200)] + 0.12 * rng.standard_normal((200, 16)), base[:5], 3 * base[5:8]])
    rows = [(int(i), [float(x) for x in v]) for i, v in zip(rng.permutation(len(e)), e, strict=True)]
    rows += [(900, None), (901, []), (902, [0.0] * 16), (903, [float("nan")] + [1.0] * 15), (904, [None] + [1.0] * 15)]
    rows += [(905, [float("inf")] + [1.0] * 15), (None, rows[0][1]), (None, [1.0, 2.0]), (906, [2.0, 4.0]), rows[3], (907, [1e-30] * 16), (908, [2e30] * 16)]
    df = table(spark, rows)
    assert found(df) == brute(rows)
    assert found(df, window=8, recall=0.9999, block=7) == brute(rows)


def test_empty(spark):
    assert found(table(spark, [])) == []
    assert found(table(spark, [(1, None)])) == [(1, 0, 1, True)]


def test_passes_grow_slowly():
    n = [embedding_dedup.passes_needed(10**k, 256, 0.9, 0.995) for k in range(2, 10)]
    assert n == sorted(n) and n[0] < 10 and n[-1] < 400


@pytest.mark.parametrize("size", [3000])
def test_large_group(spark, size):
    rng = np.random.default_rng(2)
    e = rng.standard_normal(24) + 0.05 * rng.standard_normal((size, 24))
    out = found(table(spark, [(i, [float(x) for x in v]) for i, v in enumerate(e)]))
    assert all(r[1:] == (size - 1, 0, r[0] == 0) for r in out)


@pytest.mark.parametrize("mean", [0.5, 0.8])
def test_pairs_among_crowded_vectors_are_found(spark, mean):
    """Vectors about a common direction, in pairs at a cosine little above the threshold."""
    rng = np.random.default_rng(4)
    size, dim, cosine = 1500, 256, 0.905
    away = rng.standard_normal((size, dim))
    away[:, 0] = 0
    away /= np.linalg.norm(away, axis=1, keepdims=True)
    unit = math.sqrt(1 - mean) * away
    unit[:, 0] = math.sqrt(mean)
    turn = rng.standard_normal((size, dim))
    turn -= (turn * unit).sum(axis=1, keepdims=True) * unit
    turn /= np.linalg.norm(turn, axis=1, keepdims=True)
    e = np.vstack([unit, cosine * unit + math.sqrt(1 - cosine**2) * turn])
    out = found(table(spark, [(i, [float(x) for x in v]) for i, v in enumerate(e)]), window=16, block=256)
    met = sum(r[2] == r[0] - size for r in out if r[0] >= size)
    assert met >= 0.99 * size


def test_passes_keep_the_recall():
    for bits in range(0, 40):
        n = embedding_dedup.passes_for(bits, 0.9, 0.995)
        assert 1 - (1 - (1 - math.acos(0.9) / math.pi) ** bits) ** n >= 0.995


@pytest.mark.parametrize("window", [8, 64])
def test_windows_cover_narrow_groups_and_name_the_rest(window):
    """Ties join what lies near in whole groups of equal leading bits no wider than the window; all rows of others come out."""
    import pyarrow as pa

    rng = np.random.default_rng(5)
    bits, rows = 4, []
    for tag in (3, 1 << 32 | 3):
        for prefix, n in enumerate(rng.permutation([1, 2, 5, 8, 9, 30, 64, 65, 100, 3, 7, 0, 1, 40, 6, 12])):
            low = np.sort(rng.integers(0, 2**59, int(n)))
            rows += [(tag, (prefix << 60) + int(k)) for k in low]
    tag, key = (np.array(c, np.uint64).view(np.int64) for c in zip(*rows, strict=True))
    base = rng.standard_normal((6, 3))
    e = base[rng.integers(0, 6, len(rows))] + 0.05 * rng.standard_normal((len(rows), 3))
    t = pa.table({"tag": tag, "key": key, "rep": np.arange(len(rows)), "embedding": pa.array(e.tolist(), pa.list_(pa.float64()))})
    out = pa.Table.from_batches(list(embedding_dedup._neighbours(bits, window, 0.9)(iter(t.to_batches(max_chunksize=37))))).to_pylist()
    groups = {}
    for i, (a, k) in enumerate(rows):
        groups.setdefault((a, k >> 60), []).append(i)
    ends = {(rows[0][0], rows[0][1] >> 60), (rows[-1][0], rows[-1][1] >> 60)}
    wide = {g for g, own in groups.items() if len(own) > window or g in ends}
    rest = sorted(r["rep"] for r in out if r["kind"] == 1)
    assert rest == sorted(i for g in wide for i in groups[g])
    assert all((r["tag"], r["key"]) in wide for r in out if r["kind"] == 1)
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    unit = e / np.linalg.norm(e, axis=1, keepdims=True)
    for r in out:
        if r["kind"] == 0:
            assert rows[r["a"]][0] == rows[r["b"]][0] and abs(r["a"] - r["b"]) < 2 * window
            parent[max(find(r["a"]), find(r["b"]))] = min(find(r["a"]), find(r["b"]))
    for g in groups.keys() - wide:
        own = groups[g]
        for x in own:
            for y in own:
                assert unit[x] @ unit[y] < 0.9 or find(x) == find(y)
