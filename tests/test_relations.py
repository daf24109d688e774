"""Running totals, as-of matches and matches near in place and time, against all pairs."""

from __future__ import annotations

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from strata.operators.nearby import EARTH_KM, near_followers
from strata.operators.running import asof_join, running
from tests.helpers import plan_text

T0 = dt.datetime(2000, 1, 1)


def test_running_totals_cross_pieces(spark):
    rng = random.Random(1)
    rows = [(rng.choice(["a", "a", "a", "b", None]), rng.choice([None, *range(40)]), rng.choice([None, 1, 2, 5])) for _ in range(400)]
    rows = [(k, o, i, v) for i, (k, o, v) in enumerate(rows)]
    df = spark.createDataFrame(rows, "k string, o int, i int, v long").repartition(7)
    order = lambda r: (r[1] is not None, r[1] or 0, r[2])
    want = {}
    for key in ("a", "b", None):
        seen = []
        for r in sorted((r for r in rows if r[0] == key), key=order):
            if r[3] is not None:
                seen.append(r[3])
            want[r[2]] = (sum(seen), min(seen), max(seen)) if seen else (None, None, None)
    for ranges in (1, 3, 40):
        out = running(df, ["k"], ["o", "i"], {"s": ("sum", "v"), "low": ("min", "v"), "high": ("max", "v")}, ranges)
        assert out.columns == [*df.columns, "s", "low", "high"]
        assert {r.i: (r.s, r.low, r.high) for r in out.collect()} == want


def asof_brute(left, right, strict, within):
    out = []
    for row, key, at in left:
        fit = [
            (t, name)
            for name, k, t in right
            if None not in (k, t, key, at) and k == key and (t < at if strict else t <= at) and (within is None or (at - t).total_seconds() <= within)
        ]
        out.append((row, key, at, max(fit)[1] if fit else None))
    return out


@pytest.mark.parametrize("strict", [False, True])
@pytest.mark.parametrize("within", [None, 7200])
def test_asof_equals_all_pairs(spark, strict, within):
    rng = random.Random(2)

    def at():
        return rng.choice([None] + [T0 + dt.timedelta(minutes=30 * rng.randrange(200), microseconds=rng.randrange(3))] * 15)

    left = [(i, rng.choice([None, 1, 1, 1, 1, 2, 3]), at()) for i in range(300)]
    left += left[:20]
    right = [(f"r{i:03d}", rng.choice([None, 1, 1, 1, 2]), at()) for i in range(150)]
    a = spark.createDataFrame(left, "i int, k int, at timestamp_ntz").withColumn("__note", F.lit("x"))
    b = spark.createDataFrame(right, "name string, k long, at timestamp_ntz")
    out = asof_join(a, b, "k", "k", "at", "at", {"name": "last", "at": "last_at"}, ["name"], strict, within, ranges=11)
    got = [(r.i, r.k, r.at, r.last) for r in out.collect()]
    assert sorted(got, key=str) == sorted(asof_brute(left, right, strict, within), key=str)
    assert "CartesianProduct" not in plan_text(out) and "NestedLoop" not in plan_text(out)


def test_asof_of_empty_sides_and_clashing_names(spark):
    a = spark.createDataFrame([(1, T0)], "k int, at timestamp_ntz")
    none = a.limit(0)
    assert asof_join(a, none, "k", "k", "at", "at", {"at": "last"}).collect()[0].last is None
    assert asof_join(none, a, "k", "k", "at", "at", {"at": "last"}).collect() == []
    with pytest.raises(ValueError, match="at"):
        asof_join(a, a, "k", "k", "at", "at", {"at": "at"})


def km(a, b, c, d) -> float:
    a, b, c, d = map(math.radians, (a, b, c, d))
    half = math.sin((c - a) / 2) ** 2 + math.cos(a) * math.cos(c) * math.sin((d - b) / 2) ** 2
    return 2 * EARTH_KM * math.asin(min(1.0, math.sqrt(half)))


def near_brute(firsts, thens, radius, within):
    out = {}
    for i, at, lat, lon in firsts:
        found = []
        if None not in (at, lat, lon) and abs(lat) <= 90 and math.isfinite(lon):
            for t, y, x in thens:
                if None not in (t, y, x) and abs(y) <= 90 and 0 < (t - at).total_seconds() <= within:
                    found.append(km(lat, lon, y, x))
        found = [d for d in found if d <= radius]
        out[i] = (len(found), round(min(found), 3) if found else None)
    return out


def near(spark, firsts, thens, radius, within, **options):
    a = spark.createDataFrame(firsts, "i int, at timestamp_ntz, lat double, lon double").withColumn("n", F.lit("mine"))
    b = spark.createDataFrame(thens, "t timestamp_ntz, y double, x double")
    out = near_followers(a, b, ("at", "lat", "lon"), ("t", "y", "x"), radius, within, **options)
    assert out.columns == [*a.columns, "followers", "nearest_km"]
    return {r.i: (r.followers, r.nearest_km) for r in out.collect()}


def scattered(seed: int, n: int, spots: list[tuple[float, float]]):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        lat, lon = rng.choice(spots)
        lat = max(-90.0, min(90.0, lat + rng.gauss(0, 1.5)))
        out.append((i, T0 + dt.timedelta(minutes=rng.randrange(60 * 24 * 6)), lat, lon + rng.gauss(0, 3)))
    return out


@pytest.mark.parametrize("radius", [40.0, 250.0, 3000.0])
def test_near_equals_all_pairs(spark, radius):
    """Around the antimeridian, both poles, the equator and a busy spot."""
    spots = [(10, 179.5), (-15, -179.8), (89.5, 20), (-89.9, -100), (75, 179), (0, 0), (0, 0), (0, 0), (45, 361)]
    firsts, thens = scattered(3, 250, spots), [r[1:] for r in scattered(4, 250, spots)]
    firsts += [(1000 + k, T0 + dt.timedelta(hours=k), 5.0, 5.0) for k in range(60)]
    thens += [(T0 + dt.timedelta(hours=k), 5.0, 5.0) for k in range(60)] * 2
    got = near(spark, firsts, thens, radius, 6 * 3600, ranges=13)
    assert got == near_brute(firsts, thens, radius, 6 * 3600)
    assert sum(n > 0 for n, _ in got.values()) > 40


def test_near_splits_dense_cells(spark):
    rng = random.Random(5)
    firsts = [(i, T0 + dt.timedelta(minutes=i), 50 + rng.random(), 8 + rng.random()) for i in range(120)]
    thens = [(T0 + dt.timedelta(minutes=7 * i), 50 + rng.random(), 8 + rng.random()) for i in range(60)]
    want = near_brute(firsts, thens, 60, 3600)
    assert near(spark, firsts, thens, 60, 3600) == near(spark, firsts, thens, 60, 3600, dense=3) == want


def test_near_defined_cases(spark):
    nan, inf = float("nan"), float("inf")
    firsts = [(1, T0, 1.0, 2.0), (1, T0, 1.0, 2.0), (2, None, 1.0, 2.0), (3, T0, None, 2.0), (4, T0, nan, 2.0), (5, T0, 91.0, 2.0), (6, T0, 1.0, inf)]
    soon = T0 + dt.timedelta(hours=1)
    thens = [(soon, 1.0, 362.0), (soon, 1.0, 2.0), (T0, 1.0, 2.0), (None, 1.0, 2.0), (soon, None, 2.0), (soon, nan, 2.0), (soon, 1.0, nan)]
    got = near(spark, firsts, thens, 10, 3600)
    assert got == {1: (2, 0.0), **{i: (0, None) for i in range(2, 7)}}
    assert near(spark, firsts, [], 10, 3600)[1] == (0, None)
    assert near(spark, [], thens, 10, 3600) == {}
    with pytest.raises(ValueError):
        near(spark, firsts, thens, 0, 3600)
