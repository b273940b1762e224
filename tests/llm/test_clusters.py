"""Centroid clustering against plain k-means in Python integers."""

import hashlib
import math
import random

import numpy as np
import pytest

from daybook.llm import clusters

KIND = "vec_id long, embedding array<float>, vector string, cluster string"


def plain(rows, k, rounds, dims, scale):
    """{(vec_id, vector): (cluster, distance, cluster_inertia, inertia, mark)} as the module's text says."""
    kept = [
        (i, tuple(math.floor(scale * x) for x in v))
        for i, v in rows
        if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)
    ]
    named = sorted((i is None, hashlib.sha256(f"1:{i}".encode()).hexdigest() if i is not None else "", v) for i, v in kept)
    centroids = [v for _, _, v in named[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centroids))

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(nearest(v)[1], []).append(v)
        centroids = [
            tuple(sum(x) // len(groups[j]) for x in zip(*groups[j])) if j in groups else c for j, c in enumerate(centroids)
        ]
    found = [(i, *nearest(v)) for i, v in kept]
    own = {j: sum(d for _, d, at in found if at == j) for _, _, j in found}
    marks = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted((str(i), j, d, own[j], sum(own.values()), marks[j]) for i, d, j in found)


def run(spark, rows, k=5, rounds=3, dims=4, scale=8):
    df = spark.createDataFrame([(i, v, "x", "y") for i, v in rows], KIND).repartition(3)
    return sorted((str(r[0]), *r[1:]) for r in clusters.clusters(clusters.grid(df, dims=dims, scale=scale), k, rounds).collect())


def test_equals_plain_on_random_vectors(spark):
    rng = random.Random(3)
    rows = [(i, [rng.choice([-2.0, -0.5, 0.0, 0.25, 3.0]) + rng.random() for _ in range(4)]) for i in range(160)]
    # ties (a grid of few values), copies of a third of the rows, repeated and null ids
    rows += [(200 + i, [float(i % 2), 0.0, 0.0, 0.0]) for i in range(40)] + [(7, rows[7][1])] * 30 + [(None, [1.0, 1.0, 1.0, 1.0])] * 3
    assert run(spark, rows) == plain(rows, 5, 3, 4, 8)
    assert run(spark, rows, k=16, rounds=1) == plain(rows, 16, 1, 4, 8)


def test_defined_cases(spark):
    bad = [(1, None), (2, []), (3, [1.0, None, 1.0, 1.0]), (4, [float("nan"), 0.0, 0.0, 0.0]), (5, [float("inf"), 0.0, 0.0, 0.0]), (6, [1.0])]
    assert run(spark, bad) == [] == run(spark, [])
    few = [(1, [1.0, 2.0, 3.0, 4.0]), (2, [-1.0, -0.01, 0.0, 9.0])]
    assert run(spark, [*few, *bad]) == plain(few, 5, 3, 4, 8) and len(run(spark, few)) == 2
    same = [(i, [0.5, 0.5, 0.5, 0.5]) for i in range(9)]  # all centroids equal: the smallest number, the others stay empty
    assert {r[1] for r in run(spark, same)} == {0}
    with pytest.raises(Exception, match="beyond 2"):
        run(spark, [(1, [1e9, 0.0, 0.0, 0.0])])


def test_bounds_skip_and_lose_nothing(spark):
    rng = np.random.default_rng(5)
    at = rng.integers(-4000, 4000, (16, 64))
    x = (at[rng.integers(0, 16, 3000)] + rng.integers(-60, 60, (3000, 64))).tolist()
    points = spark.createDataFrame([(i, v) for i, v in enumerate(x)], "vec_id long, vector array<int>").repartition(4)
    state, history = clusters.fit(points, 16, 4)
    assert len(history) == 5
    rows = {r.vec_id: r for r in state.collect()}
    c = history[-1]
    for i in range(0, 3000, 7):
        d = ((np.array(x[i]) - c) ** 2).sum(axis=1)
        assert (rows[i].cluster, rows[i].distance) == (int(d.argmin()), int(d.min()))
        bounds = np.frombuffer(rows[i].bounds, "<f8")
        assert (bounds - np.sqrt([((history[-1][j] - history[t][j]) ** 2).sum() for j, t in enumerate(np.frombuffer(rows[i].rounds, "<u2"))]) <= np.sqrt(d) + 1e-6).all()
    # the last round evaluates few of the 16 centroids a row
    assert sum(r.evaluated for r in rows.values()) < 3000 * 16 / 3


def test_total_displacement_is_tighter_than_summed_drifts():
    """A centroid that goes and comes back loosens nothing."""
    x = np.array([[0, 0]], np.int64)
    there, away = np.array([[1, 0], [100, 0]]), np.array([[1, 0], [60, 0]])
    bounds, rounds = np.zeros((1, 2)), np.zeros((1, 2), np.uint16)
    own = np.zeros(1, np.int64)
    for history in ([there], [there, away], [there, away, there]):
        own, d, n = clusters.evaluate(x, own, bounds, rounds, history)
    # the far centroid was never evaluated again: 100 - |back where it was| = 100
    assert (own[0], d[0], n) == (0, 1, 1) and rounds[0].tolist() == [2, 0] and bounds[0].tolist() == [1.0, 100.0]
