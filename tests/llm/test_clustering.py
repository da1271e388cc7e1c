"""Centroid clustering: the curve, the bounds, and the rounds against plain integers."""

import hashlib
import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from roadlake.llm import clustering

SCHEMA = "vec_id long, embedding array<double>, label int"


def brute(rows, k=8, rounds=10, dims=64, seed=3):
    whole = [
        (i, [max(-(2**62), min(2**62, math.floor(1024 * x))) for x in e])
        for i, e, _ in rows
        if e is not None and len(e) == dims and all(x is not None and math.isfinite(x) for x in e)
    ]
    first = sorted(whole, key=lambda r: (r[0] is None, hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1]))
    centroids = [v for _, v in first[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), n) for n, c in enumerate(centroids))

    for _ in range(rounds):
        at = [nearest(v)[1] for _, v in whole]
        for c in set(at):
            mine = [v for (_, v), a in zip(whole, at, strict=True) if a == c]
            centroids[c] = [sum(x) // len(mine) for x in zip(*mine, strict=True)]
    found = [(i, *nearest(v)) for i, v in whole]
    top = 2**63 - 1
    inertia = {c: sum(d for _, d, a in found if a == c) for c in range(k)}
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    total = sum(inertia.values())
    return sorted(((i, c, min(d, top), min(inertia[c], top), min(total, top), digest[c]) for i, d, c in found), key=str)


def got(df, **options):
    return sorted((tuple(r) for r in clustering.cluster(df, **options).collect()), key=str)


@pytest.mark.parametrize(("dims", "bits"), [(1, 3), (2, 4), (3, 3), (5, 2)])
def test_neighbours_on_the_curve_are_neighbouring_cells(dims, bits):
    cells = np.array(list(itertools.product(range(2**bits), repeat=dims)))
    keys = [k.tobytes() for k in clustering.hilbert_keys(cells, bits)]
    assert len(set(keys)) == len(cells)
    path = cells[sorted(range(len(cells)), key=keys.__getitem__)]
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def test_no_candidate_is_lost_and_boxes_prune():
    rng = np.random.default_rng(1)
    centroids = rng.integers(-500, 500, (6, 8))
    pruned = 0
    for _ in range(300):
        middle, width = rng.integers(-500, 500, 8), rng.integers(1, 300)
        v = middle + rng.integers(-width, width, (40, 8))
        open_ = clustering.candidates(v.min(axis=0)[None], v.max(axis=0)[None], centroids)[0]
        assert set(clustering.distances(v, centroids).argmin(axis=1)) <= set(np.flatnonzero(open_))
        pruned += (~open_).sum()
    assert pruned > 300


def test_ties_stay_candidates():
    assert clustering.candidates(np.array([[0]]), np.array([[0]]), np.array([[-2], [2], [2]])).all()


def test_far_integers_are_exact():
    v, c = np.array([[2**62, 3], [-(2**62), 0]]), np.array([[2**62, 0], [0, 0]], object)
    assert clustering.distances(v, c).tolist() == [[9, 2**124 + 9], [2**126, 2**124]]


def sample(seed, n, dims, centres=5):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(centres, dims))
    return [(int(i), (middle[rng.integers(centres)] + 0.02 * rng.normal(size=dims)).tolist(), 0) for i in range(n)]


@pytest.mark.parametrize("block", [1, 16, 256])
def test_rounds_equal_plain_integers(spark, block):
    rows = sample(2, 300, 6)
    rows += rows[:40] + [(500 + i, rows[0][1], 1) for i in range(60)]  # repeated rows, copies
    df = spark.createDataFrame(rows, SCHEMA).withColumn("key", F.lit("k")).withColumn("n", F.lit(1)).repartition(4)
    assert got(df, dims=6, block=block) == brute(rows, dims=6)


def test_odd_vectors(spark):
    good = [(i, [float(i), -i / 3, 0.1], 0) for i in range(9)]
    odd = [(20, None, 0), (21, [], 0), (22, [1.0, 2.0], 0), (23, [1.0, None, 2.0], 0), (24, [1.0, math.nan, 0.0], 0), (25, [math.inf, 0.0, 0.0], 0)]
    edge = [(None, [1.0, 1.0, 1.0], 0), (26, [0.0, -0.0, 0.0], 0), (27, [1e300, 0.0, 0.0], 0), (28, [-1e6, 5e5, 0.0], None)]
    rows = good + odd + edge
    assert got(spark.createDataFrame(rows, SCHEMA), dims=3, k=4) == brute(rows, dims=3, k=4)


@pytest.mark.parametrize("n", [0, 1, 3])
def test_fewer_vectors_than_centroids(spark, n):
    rows = [(i, [float(i), 0.5], 0) for i in range(n)]
    assert got(spark.createDataFrame(rows, SCHEMA), dims=2) == brute(rows, dims=2)


def test_only_null_ids_and_equal_vectors(spark):
    rows = [(None, [0.25, 0.5], 0)] * 12
    assert got(spark.createDataFrame(rows, SCHEMA), dims=2) == brute(rows, dims=2)


def test_blocks_of_one_candidate_are_not_opened(spark):
    rows = sample(3, 2000, 8, centres=3)
    whole = clustering.integers(spark.createDataFrame(rows, SCHEMA), 8)
    blocks = clustering.zone_maps(whole, 8, 32)
    centroids = clustering.start(whole, 3, 3)
    for _ in range(3):
        for c, (n, sums, _) in clustering._round(blocks, centroids).items():
            centroids[c] = [s // n for s in sums]
    shut = total = 0
    for batch in blocks.toArrow().to_batches():
        for _, v, _, _ in clustering._assigned(batch, centroids, False):
            total += 1
            shut += v is None
    assert total >= 2000 // 32 and shut > total / 2
