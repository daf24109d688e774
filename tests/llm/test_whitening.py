"""Whitening against exact fractions and a plain eigendecomposition."""

from __future__ import annotations

import math
from fractions import Fraction

import numpy as np
from pyspark.sql import functions as F

from strata.llm.whitening import LARGEST, SHIFT, fit_whitener, fixed_point, whitened

ROWS = "vec_id long, embedding array<float>"


def plain(vectors: dict) -> tuple[dict, list, list, np.ndarray]:
    """x per id, the fit list, its sums, and the covariance by fractions."""
    x = {k: tuple(math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v) for k, v in vectors.items()}
    fit = sorted(set(x.values()))
    n, dim = len(fit), len(fit[0])
    sums = [sum(v[a] for v in fit) for a in range(dim)]
    means = [Fraction(s, n) for s in sums]
    cov = np.array([[float(sum((v[a] - means[a]) * (v[b] - means[b]) for v in fit) / n) for b in range(dim)] for a in range(dim)])
    return x, fit, sums, cov


def random_vectors(n: int, dim: int, seed: int = 1) -> dict:
    rng = np.random.RandomState(seed)
    mixed = rng.normal(size=(n, dim)) @ rng.normal(size=(dim, dim)) / 4
    return {k: [float(c) for c in mixed[k]] for k in range(n)}


def test_whitening_equals_fractions(spark):
    vectors = random_vectors(300, 20)
    vectors |= {1000 + k: vectors[3] for k in range(100)}
    x, fit, sums, cov = plain(vectors)
    n = len(fit)
    docs = spark.createDataFrame(list(vectors.items()), ROWS).repartition(5)
    found = fit_whitener(fixed_point(docs).select("x").distinct())
    assert found.n == n and (found.covariance == cov).all()
    values, comps = np.linalg.eigh(cov)
    values, comps = values[::-1], comps[:, ::-1]
    rows = whitened(docs).collect()
    assert len(rows) == 16 * len(vectors)
    by_id = {}
    for r in rows:
        by_id.setdefault(r.vec_id, {})[r.component] = r
    signs = {}
    for k, own in by_id.items():
        assert sorted(own) == list(range(1, 17))
        deviation = sum((n * c - s) ** 2 for c, s in zip(x[k], sums))
        centred = np.array([float(Fraction(n * c - s, n)) for c, s in zip(x[k], sums)])
        for c, r in own.items():
            assert r.n == n and r.deviation == deviation
            assert abs(r.explained - values[c - 1] / np.trace(cov)) < 1e-9
            assert r.identity_error < 1e-6
            want = centred @ comps[:, c - 1] / math.sqrt(values[c - 1])
            assert abs(abs(r.whitened) - abs(want)) < 1e-8
            if abs(want) > 0.1:
                assert signs.setdefault(c, r.whitened * want > 0) == (r.whitened * want > 0)


def test_sums_stay_exact_for_large_entries(spark):
    big = {0: [1e30, 0.0, 5e9], 1: [-1e30, 1.0, -5e9], 2: [3e9, 2.0, 7e9], 3: [1e10, -3.0, 1.5]}
    docs = spark.createDataFrame(list(big.items()), ROWS)
    x = {r.vec_id: r.x for r in fixed_point(docs).collect()}
    assert x[0][0] == LARGEST + SHIFT and x[1][0] == SHIFT - LARGEST and x[2][0] == 64 * 3_000_000_000 + SHIFT
    found = fit_whitener(fixed_point(docs).select("x").distinct())
    means = [Fraction(sum(v[a] for v in x.values()), 4) for a in range(3)]
    want = [[float(sum((v[a] - means[a]) * (v[b] - means[b]) for v in x.values()) / 4) for b in range(3)] for a in range(3)]
    assert found.covariance.tolist() == want
    assert {r.deviation for r in whitened(docs).collect()} == {None}


def test_whitening_defined_cases(spark):
    odd = [(1, None), (2, []), (3, [1.0, None, 2.0]), (4, [1.0, float("nan"), 2.0]), (5, [float("inf"), 1.0, 2.0]), (6, [1.0] * 9)]
    good = [(k, [float(k % 7), float(k % 5), float(k % 3)]) for k in range(10, 60)] + [(10, [3.0, 0.0, 1.0]), (None, [0.0, 0.0, 0.0])]
    docs = spark.createDataFrame(odd + good, ROWS).withColumn("n", F.lit("mine")).withColumn("x", F.lit(0))
    rows = whitened(docs).collect()
    assert len(rows) == 3 * len(good) and {r.vec_id for r in rows} == {k for k, _ in good}
    assert max(r.identity_error for r in rows) < 1e-6
    assert whitened(docs.limit(0)).collect() == []
    assert whitened(docs.limit(0)).columns == whitened(docs).columns
    same = spark.createDataFrame([(k, [1.0, 2.0]) for k in range(5)], ROWS)
    assert whitened(same).collect() == []
    line = spark.createDataFrame([(k, [float(k), 2.0 * k]) for k in range(5)], ROWS)
    assert {r.component for r in whitened(line).collect()} == {1}
