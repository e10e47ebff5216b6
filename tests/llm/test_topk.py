from __future__ import annotations

import math
import random

import numpy as np
from pyspark.sql import functions as F

from lendworks.llm import topk

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, k=5, every=5):
    usable = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            usable[i] = [math.floor(256 * float(np.float32(x))) for x in v]
    out = []
    for q, v in usable.items():
        if q % every == 0:
            scored = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in usable.items() if i != q)
            out += [(q, r, i, -s) for r, (s, i) in enumerate(scored[:k], 1)]
    return sorted(out)


def run(spark, rows, **options):
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)
    return sorted(map(tuple, topk.top_k(df, F.col("vec_id") % 5 == 0, **options).collect()))


def test_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK_ROWS", 32)
    monkeypatch.setattr(topk, "GROUP_QUERIES", 8)
    rng = random.Random(1)
    centres = [[rng.gauss(0, 1) for _ in range(6)] for _ in range(5)]
    rows = [(i, [c + rng.gauss(0, 0.05) for c in rng.choice(centres)]) for i in range(300)]
    assert run(spark, rows) == brute(rows)


def test_bounds_stop_the_expansion_without_loss():
    rng = np.random.default_rng(2)
    x = np.round(rng.normal(size=(400, 4)) * 100).astype(np.int64)
    sphere = topk.Sphere(x[:8], (x**2).sum(axis=1).max())
    angles = sphere.angles(x)
    for p in range(8):
        low, high = np.quantile(angles[:, p], [0.2, 0.6])
        inside = (angles[:, p] >= low) & (angles[:, p] <= high)
        bound = sphere.bounds(x, np.array([p]), np.array([low]), np.array([high]))[:, 0]
        best = (x @ x[inside].T).max(axis=1)
        assert (best <= bound + 1e-6).all() and (bound < (x.astype(float) ** 2).sum(axis=1).max() * 0.99).any()


def test_ties_and_one_vector_many_times(spark):
    rows = [(i, [1.0, 0.5]) for i in range(60)] + [(100, [-1.0, 0.0]), (101, [0.0, 0.0])]
    assert run(spark, rows) == brute(rows)


def test_awkward_vectors(spark):
    rows = [
        (0, [0.1, 0.2]),
        (5, None),
        (10, [float("nan"), 1.0]),
        (15, [None, 1.0]),
        (20, [float("inf"), 1.0]),
        (None, [1.0, 1.0]),
        (1, [0.3, -0.2]),
        (2, [0.0, 0.0]),
    ]
    found = run(spark, rows + [(1, [0.3, -0.2])])
    assert found == brute(rows) and [r[2] for r in found] == sorted((1, 2), key=lambda i: -dict((x[2], x[3]) for x in found)[i])
    assert run(spark, []) == [] and run(spark, [(0, [1.0])]) == []


def test_shorter_vectors_count_missing_components_as_zero(spark):
    assert run(spark, [(0, [1.0, 2.0]), (1, [3.0]), (2, [])]) == [(0, 1, 1, 768 * 256), (0, 2, 2, 0)]
