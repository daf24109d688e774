"""Incremental idle time, co-located charge records and the break of a trend."""

from __future__ import annotations

import datetime as dt
import random
import uuid

import pytest

from strata.operators.ranking import trend_break
from strata.operators.sessions import idle_time
from strata.plans import charge
from strata.plans import driver_tables as t
from strata.session import scratch_path
from strata.streaming.idle_state import add_readings, idle_from_state
from tests.conftest import SF_SMALL
from tests.helpers import plan_text

T0 = dt.datetime(2024, 3, 1)
READINGS = "transaction_id long, timestamp timestamp_ntz, value double"


def readings(seed: int, n: int):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        at = None if rng.random() < 0.03 else T0 + dt.timedelta(minutes=rng.randrange(6 * 24 * 60))
        out.append((rng.choice([None, 1, 1, 1, 1, 2, 3]), at, rng.choice([0.0, 0.0, 5.0, None])))
    return out


def table(spark, rows):
    return spark.createDataFrame(rows, READINGS)


def hours(df):
    return {r.transaction_id: r.total_parking_time for r in df.collect()}


@pytest.mark.parametrize("bucket_seconds", [86_400, 7 * 86_400])
def test_batches_in_any_order_equal_one_pass(spark, bucket_seconds):
    rows = readings(1, 700)
    by_time = sorted(rows, key=lambda r: (r[1] is not None, r[1] or T0))
    in_order = [by_time[:300], by_time[300:500], by_time[500:]]
    mixed = [rows[k::3] for k in range(3)]
    want = hours(idle_time(table(spark, rows)))
    assert len(want) == 4
    for parts in (in_order, in_order[::-1], mixed):
        base = scratch_path(spark, "test-idle-state")
        for k, part in enumerate(parts):
            add_readings(table(spark, part), base, f"b{k}", bucket_seconds=bucket_seconds)
        assert hours(idle_from_state(spark, base)) == want


def test_later_readings_need_no_old_ones(spark):
    base = scratch_path(spark, "test-idle-append")
    one = [(1, T0 + dt.timedelta(minutes=k), 0.0) for k in range(10)]
    later = [(1, T0 + dt.timedelta(minutes=30 + k), 0.0) for k in range(5)] + [(2, T0, 0.0)]
    earlier = [(1, T0 - dt.timedelta(minutes=5), 0.0)]
    between = [(1, T0 + dt.timedelta(minutes=3, seconds=30), 4.0)]
    seen = []
    for k, (batch, again) in enumerate([(one, 0), (later, 0), (earlier, 0), (between, 1)]):
        seen += batch
        assert add_readings(table(spark, batch), base, str(k)) == again
        assert hours(idle_from_state(spark, base)) == hours(idle_time(table(spark, seen)))


def test_a_batch_that_comes_again_changes_nothing(spark):
    rows = readings(2, 200)
    base = scratch_path(spark, "test-idle-again")
    for name, part in (("a", rows[:100]), ("b", rows[100:]), ("a", rows[:100]), ("b", rows[100:])):
        add_readings(table(spark, part), base, name)
    assert hours(idle_from_state(spark, base)) == hours(idle_time(table(spark, rows)))
    add_readings(table(spark, []), base, "none")
    assert hours(idle_from_state(spark, base)) == hours(idle_time(table(spark, rows)))


def test_colocated_records_join_without_an_exchange(spark):
    frames = (t.start_requests(spark, SF_SMALL), t.start_responses(spark, SF_SMALL), t.stop_requests(spark, SF_SMALL))
    meters = t.meter_values(spark, SF_SMALL)
    idle = charge.parking_time(meters, order=t.METER_ORDER)
    tables = charge.colocate_messages(spark, scratch_path(spark, "test-colocated"), f"test_{uuid.uuid4().hex}", 4, *frames, idle)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = charge.colocated_charge_records(tables)
        plan = plan_text(out)
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        direct = charge.charge_records(*frames, meters, order=t.METER_ORDER)
        assert "Exchange" in plan_text(direct)
        assert out.count() == direct.count() > 0
        assert out.exceptAll(direct).count() == 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def break_brute(years: list[int]):
    first, last = min(years), max(years)
    n = [years.count(y) for y in range(first, last + 1)]
    sse = lambda part: sum((x - sum(part) / len(part)) ** 2 for x in part)
    found = min(((round(sse(n[:k]) + sse(n[k:]), 6), first + k) for k in range(1, len(n))), default=(None, None))
    return first, last, found[1], found[0], round(sse(n), 6)


def test_trend_break_equals_all_splits(spark):
    rng = random.Random(7)
    years = {
        "step": [y for y in range(1990, 2010) for _ in range(2 if y < 2001 else 9)],
        "gap": [1990, 1990, 1990, 1999, 2005, 2005],
        "one": [2000, 2000],
        "two": [2000, 2001, 2001],
        "even": list(range(1990, 2000)),
        None: [rng.randrange(1980, 2020) for _ in range(200)],
    }
    rows = [(k, dt.datetime(y, rng.randrange(1, 13), 5)) for k, ys in years.items() for y in ys] + [("one", None), ("never", None)]
    df = spark.createDataFrame(rows, "c string, at timestamp_ntz").repartition(5)
    got = {r.c: (r.first_year, r.last_year, r.break_year, r.error, r.error_without) for r in trend_break(df, "c", "at").collect()}
    assert got == {k: break_brute(ys) for k, ys in years.items()}
    step = next(r for r in trend_break(df, "c", "at").collect() if r.c == "step")
    assert (step.break_year, step.mean_before, step.mean_after) == (2001, 2.0, 9.0)
    assert trend_break(df.limit(0), "c", "at").collect() == []
