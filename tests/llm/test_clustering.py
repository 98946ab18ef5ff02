"""Centroid clustering against plain Python and against all exact distances."""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pytest

from weatherloom.llm import clustering as C

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows, clusters, rounds, size, scale=256, seed=2):
    """The contract in Python's integers."""
    kept = []
    for vec_id, v in rows:
        if v is not None and len(v) == size and all(x is not None and math.isfinite(x) for x in v):
            kept.append((vec_id, tuple(math.floor(scale * float(np.float32(x))) for x in v)))

    def by_hash(row):
        return (row[0] is None, hashlib.sha256(f"{seed}:{row[0]}".encode()).hexdigest() if row[0] is not None else "", row[1])

    centroids = [list(v) for _, v in sorted(kept, key=by_hash)[:clusters]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), i) for i, c in enumerate(centroids)) for _, v in kept]

    for _ in range(rounds):
        own = assign()
        for i in range(len(centroids)):
            members = [v for (_, v), (_, c) in zip(kept, own, strict=True) if c == i]
            if members:
                centroids[i] = [sum(m[j] for m in members) // len(members) for j in range(size)]
    own = assign()
    total = sum(d for d, _ in own)
    out = []
    for (vec_id, _), (d, c) in zip(kept, own, strict=True):
        digest = hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest()
        out.append((vec_id, c, d, sum(x for x, y in own if y == c), total, digest))
    return sorted(out, key=repr)


def found(spark, rows, **kw):
    df = spark.createDataFrame([(i, v, None) for i, v in rows], SCHEMA).repartition(3)
    return sorted((tuple(r) for r in C.clustered(df, **kw).collect()), key=repr)


def test_like_plain_python(spark):
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=6).round(1).tolist()) for i in range(150)]
    rows += [(i, rows[3][1]) for i in range(150, 200)]  # a frequent vector
    rows += [(7, rows[7][1]), (7, rows[8][1])]  # a row again, and its id with another vector
    rows += [(None, rows[1][1]), (900, None), (901, [1.0]), (902, []), (903, [None] + [0.0] * 5)]
    rows += [(904, [math.nan] + [0.0] * 5), (905, [math.inf] + [0.0] * 5), (906, [-math.inf] + [0.0] * 5), (907, [0.0] * 6)]
    kw = {"clusters": 7, "rounds": 4, "size": 6}
    assert found(spark, rows, pivots=3, **kw) == plain(rows, **kw) == found(spark, rows, pivots=1, **kw)


def test_ties_and_few_vectors(spark):
    rows = [(i, [float(x), float(y)]) for i, (x, y) in enumerate([(0, 0), (0, 2), (2, 0), (2, 2), (1, 1), (1, 1), (0, 0)])]
    for clusters in (2, 5, 40):
        kw = {"clusters": clusters, "rounds": 3, "size": 2}
        assert found(spark, rows, **kw) == plain(rows, **kw)


def test_empty_and_unusable_tables(spark):
    assert found(spark, []) == []
    assert found(spark, [(1, None), (2, [0.5])]) == []
    names = ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    empty = C.clustered(spark.createDataFrame([], SCHEMA))
    full = C.clustered(spark.createDataFrame([(1, [1.0] * 64, 0)], SCHEMA))
    assert empty.columns == names and empty.dtypes == full.dtypes


def test_other_columns_and_huge_components(spark):
    rows = [(1, [3e38, -3e38], 5, 6), (2, [1.0, 1.0], 5, 6), (3, [1.0, 1.0], 7, 8)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, d int, v int")
    got = {r.vec_id: r for r in C.clustered(df, clusters=2, rounds=1, size=2).collect()}
    assert len(got) == 3 and all(r.distance >= 0 for r in got.values())


@pytest.mark.parametrize("shape", ["spread", "line", "same", "close", "far", "grid"])
@pytest.mark.parametrize("pivots", [1, 2, 5, 20])
def test_bounds_leave_out_no_nearest(shape, pivots):
    rng = np.random.default_rng(len(shape) + pivots)
    v = rng.integers(-300, 300, (800, 12))
    if shape == "line":
        v = np.outer(rng.integers(-50, 50, 800), rng.integers(-3, 4, 12))
    if shape == "same":
        v[:] = v[0]
    if shape == "close":
        v = v[0] + rng.integers(0, 2, (800, 12))
    if shape == "far":
        v = v * 10**5
    if shape == "grid":
        v = rng.integers(0, 2, (800, 12))
    centroids = v[rng.choice(800, 20, replace=False)]
    centroids[3] = centroids[9]
    simplex = C.Simplex(centroids, pivots)
    apexes = simplex.apex(C.squared(centroids, simplex.pivots))
    number, best, exact = C.nearest(v, C.squared(v, simplex.pivots), centroids, simplex, apexes)
    every = ((v[:, None, :] - centroids) ** 2).sum(axis=2)
    assert (number == every.argmin(axis=1)).all() and (best == every.min(axis=1)).all()
    assert exact <= every.size


def test_bounds_are_bounds_and_spare_work():
    rng = np.random.default_rng(9)
    middles = rng.integers(-3000, 3000, (20, 16))
    v = middles[rng.integers(0, 20, 2000)] + rng.integers(-40, 40, (2000, 16))
    simplex = C.Simplex(middles, 12)
    distances = C.squared(v, simplex.pivots)
    inside, height = simplex.apex(distances)
    apexes = simplex.apex(C.squared(middles, simplex.pivots))
    flat = ((inside[:, None, :] - apexes[0]) ** 2).sum(axis=2)
    true = ((v[:, None, :] - middles) ** 2).sum(axis=2)
    assert (flat + (height[:, None] - apexes[1]) ** 2 <= true * (1 + 1e-6) + 1).all()
    assert (flat + (height[:, None] + apexes[1]) ** 2 >= true * (1 - 1e-6) - 1).all()
    assert C.nearest(v, distances, middles, simplex, apexes)[2] < 0.2 * true.size
