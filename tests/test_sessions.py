"""Gaps-and-islands: FIXTURES.md meter values, splits, brute force on random data."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from strata.operators.filters import filter_measurand
from strata.operators.sessions import charging_boundaries, group_bounds, idle_time, running_group_id

BASE = datetime(2023, 1, 1, 10, 0, 0)
P = "Power.Active.Import"

# (transaction, seconds, value, phase, tie-break)
READINGS = [
    (1, 0, 0.0, None, 0), (1, 10, 5.0, None, 0), (1, 20, 0.0, None, 0), (1, 30, 0.0, None, 0), (1, 40, 2.0, None, 0),
    (2, 0, 0.0, None, 0), (2, 60, 0.0, None, 0),
    (3, 5, None, None, 0), (3, 9, -1.0, None, 0),
    (4, 0, 3.0, None, 0), (4, 60, 4.0, None, 0),
    (5, 0, 0.0, "L1", 0), (5, 3600, 0.0, "L1", 0),
    (6, 30, 0.0, None, 0), (6, 30, 3.0, None, 1), (6, 40, 0.0, None, 0),
]

SCHEMA = "transaction_id int, timestamp timestamp_ntz, value double, measurand string, phase string, seq int"


@pytest.fixture
def readings(spark):
    rows = [(t, BASE + timedelta(seconds=s), v, P, ph, q) for t, s, v, ph, q in READINGS]
    return filter_measurand(spark.createDataFrame(rows, SCHEMA))


ORDER = ("timestamp", "seq")


@pytest.mark.parametrize("split,bucket", [("time", 86400), ("time", 15), ("rows", 86400)])
def test_idle_time_fixture(readings, split, bucket):
    out = idle_time(readings, order=ORDER, split=split, bucket_seconds=bucket).collect()
    got = {r.transaction_id: r.total_parking_time for r in out}
    # 1: 0 + 10 s; 2: 60 s -> 0.02 h; 3: null/negative are idle, 4 s; 4: never idle, absent;
    # 5: phase L1 filtered out; 6: the tie at t=30 is ordered by seq: groups 0 1 2, 0 s.
    assert got == {1: 0.0, 2: 0.02, 3: 0.0, 6: 0.0}


@pytest.mark.parametrize("split,bucket", [("time", 86400), ("time", 15), ("rows", 86400)])
def test_flags_and_groups_fixture(readings, split, bucket):
    g = running_group_id(readings, order=ORDER, split=split, bucket_seconds=bucket)
    rows = sorted(g.collect(), key=lambda r: (r.transaction_id, r.timestamp, r.seq))
    by_tx: dict[int, list] = {}
    for r in rows:
        by_tx.setdefault(r.transaction_id, []).append((r.charging, r.boundary, r.charging_group))
    assert by_tx[1] == [(0, 0, 0), (1, 1, 1), (0, 1, 2), (0, 0, 2), (1, 1, 3)]
    assert by_tx[2] == [(0, 0, 0), (0, 0, 0)]
    assert by_tx[3] == [(0, 0, 0), (0, 0, 0)]
    assert by_tx[4] == [(1, 1, 1), (1, 0, 1)]
    assert by_tx[6] == [(0, 0, 0), (1, 1, 1), (0, 1, 2)]
    b = charging_boundaries(readings, order=ORDER, split=split, bucket_seconds=bucket)
    assert b.count() == len(rows) and "charging_group" not in b.columns


def test_group_bounds_fixture(readings):
    out = {(r.transaction_id, r.charging_group): r for r in group_bounds(readings, order=ORDER).collect()}
    g = out[(1, 2)]
    assert (g.charging, g.first, g.last, g.readings) == (0, BASE + timedelta(seconds=20), BASE + timedelta(seconds=30), 2)
    assert out[(4, 1)].charging == 1


def _brute_force(rows, threshold):
    """Idle seconds per key, straight from the definition (sorted per key)."""
    by_key: dict[int, list] = {}
    for k, ts, tb, v in rows:
        by_key.setdefault(k, []).append((ts, tb, v))
    result = {}
    for k, items in by_key.items():
        items.sort()
        prev, group, groups = 0, 0, {}
        for ts, tb, v in items:
            c = 1 if (v is not None and v > threshold) else 0
            group += abs(c - prev)
            prev = c
            groups.setdefault(group, [c, [], ])[1].append(int(ts.timestamp()))
        idle = [max(s) - min(s) for c, s in groups.values() if c == 0]
        if idle:
            result[k] = round(sum(idle) / 3600 + 1e-12, 2)
    return result


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_idle_time_matches_brute_force_on_random_readings(spark, seed):
    rnd = random.Random(seed)
    rows = []
    for _ in range(600):
        key = rnd.choice([1, 1, 1, 1, 2, 3, 4])  # key 1 holds most rows
        ts = datetime(2024, 1, 1) + timedelta(seconds=rnd.randrange(0, 5 * 86400, 7))
        value = rnd.choice([None, -1.0, 0.0, 0.0, 1.0, 2.0, 3.0])
        rows.append((key, ts, rnd.randrange(1_000_000), value))
    df = spark.createDataFrame(rows, "k int, ts timestamp_ntz, tb int, v double")
    expected = _brute_force(rows, 0.0)
    for split, bucket in [("time", 86400), ("time", 3600), ("rows", 86400)]:
        got = {r.k: r.idle for r in idle_time(df, "k", ("ts", "tb"), "v", 0.0, bucket, "idle", split=split).collect()}
        assert got == expected, (split, bucket)
    # idle time never exceeds the span of a key's readings
    spans = {r.k: (r.hi - r.lo).total_seconds() / 3600 for r in df.groupBy("k").agg(F.min("ts").alias("lo"), F.max("ts").alias("hi")).collect()}
    assert all(hours <= spans[k] + 0.005 for k, hours in expected.items())


def test_results_do_not_depend_on_partition_count(spark, readings, shuffle_partitions):
    results = []
    for n in (1, 2, 17):
        shuffle_partitions(n)
        results.append(sorted(running_group_id(readings, order=ORDER, split="rows").collect()))
    assert results[0] == results[1] == results[2]


def test_idle_time_plan_has_no_python_and_shuffles_pieces(readings):
    from tests.helpers import plan_text

    text = plan_text(idle_time(readings, order=ORDER))
    assert "hashpartitioning(transaction_id" in text and "_b" in text
    assert "BatchEvalPython" not in text and "ArrowEvalPython" not in text


def test_readings_without_a_key_form_one_group(spark):
    rows = [(None, BASE, 0.0, 0), (None, BASE + timedelta(seconds=30), 0.0, 1), (7, BASE, 1.0, 0)]
    df = spark.createDataFrame(rows, "k int, ts timestamp_ntz, v double, tb int")
    groups = running_group_id(df, "k", ("ts", "tb"), "v").collect()
    assert sorted((r.k is None, r.charging_group) for r in groups) == [(False, 1), (True, 0), (True, 0)]
    idle = {r.k: r.idle for r in idle_time(df, "k", ("ts", "tb"), "v", output="idle").collect()}
    assert idle == {None: 0.01}


TIED = [(1, datetime(2024, 1, 1), 0.0), (1, datetime(2024, 1, 2), 5.0), (1, datetime(2024, 1, 2), 0.0), (1, datetime(2024, 1, 2, 1), 0.0)]
SPLITS = [dict(split="rows"), dict(split="rows", ranges=2), dict(split="time"), dict(split="time", bucket_seconds=10 * 86400), dict(split="time", bucket_seconds=600)]


@pytest.mark.parametrize("how", SPLITS)
def test_tied_times_have_one_answer(spark, how):
    """Without a tie-break column, the state orders readings of one instant."""
    df = spark.createDataFrame(TIED, "transaction_id int, timestamp timestamp_ntz, value double")
    assert [r.total_parking_time for r in idle_time(df, **how).collect()] == [24.0]


@pytest.mark.parametrize("how", SPLITS)
def test_readings_without_a_time_are_kept_first(spark, how):
    rows = [(1, None, 3.0), (1, BASE, 0.0), (1, BASE + timedelta(hours=2), 0.0), (2, None, 0.0), (2, BASE, 0.0), (3, None, 0.0)]
    df = spark.createDataFrame(rows, "transaction_id int, timestamp timestamp_ntz, value double")
    groups = sorted((r.transaction_id, r.timestamp is not None, r.boundary, r.charging_group) for r in running_group_id(df, **how).collect())
    assert groups == [(1, False, 1, 1), (1, True, 0, 2), (1, True, 1, 2), (2, False, 0, 0), (2, True, 0, 0), (3, False, 0, 0)]
    assert {r.transaction_id: r.total_parking_time for r in idle_time(df, **how).collect()} == {1: 2.0, 2: 0.0, 3: 0.0}
    assert sum(r.readings for r in group_bounds(df, **how).collect()) == 6
