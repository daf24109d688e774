"""Derived questions: followed-within (against brute force), correlation, JSON."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest

from strata.operators.nested import json_flatten
from strata.operators.relate import event_correlation, followed_within

DAY = 86400


def _brute_force(rows, within):
    firsts: dict[int, list] = {}
    thens: dict[int, list] = {}
    for k, ts, kind in rows:
        (firsts if kind == "error" else thens if kind == "purchase" else {}).setdefault(k, []).append(ts)
    out = {}
    for k, times in firsts.items():
        hits = sum(
            1 for t in times if any(t < p <= t + timedelta(seconds=within) for p in thens.get(k, []))
        )
        out[k] = (len(times), hits)
    return out


@pytest.mark.parametrize("seed", [7, 8])
def test_followed_within_matches_brute_force(spark, seed):
    rnd = random.Random(seed)
    rows = []
    for _ in range(400):
        k = rnd.choice([1, 1, 1, 2, 3])
        ts = datetime(2024, 1, 1) + timedelta(seconds=rnd.randrange(0, 6 * DAY, 600))
        rows.append((k, ts, rnd.choice(["error", "purchase", "view"])))
    # exact edges: a purchase exactly 24 h later counts, one at the same instant does not
    edge = datetime(2024, 2, 1)
    rows += [(9, edge, "error"), (9, edge + timedelta(days=1), "purchase"), (10, edge, "error"), (10, edge, "purchase")]
    df = spark.createDataFrame(rows, "user_id long, ts timestamp_ntz, event_type string")
    expected = _brute_force(rows, DAY)
    for split, bucket in (("time", DAY), ("time", 3600), ("time", 7 * 3600), ("time", 3 * DAY), ("rows", DAY)):
        got = {
            r.user_id: (r.first_events, r.followed)
            for r in followed_within(
                df, "user_id", "ts", "event_type", "error", "purchase", DAY, bucket, split=split
            ).collect()
        }
        assert got == expected, (split, bucket)
        assert got[9] == (1, 1) and got[10] == (1, 0)


def test_followed_within_hot_instant_and_hot_key(spark, shuffle_partitions):
    """A third of all events share one key and one instant."""
    shuffle_partitions(8)
    base = datetime(2024, 3, 1)
    rows = [(1, base, "error")] * 300 + [(1, base, "purchase")] * 100
    rows += [(1, base + timedelta(minutes=m), "purchase" if m % 5 == 0 else "error") for m in range(1, 400)]
    rows += [(k, base + timedelta(hours=k), "error") for k in range(2, 300)]
    rows += [(k, base + timedelta(hours=k, minutes=30), "purchase") for k in range(2, 300, 2)]
    df = spark.createDataFrame(rows, "user_id long, ts timestamp_ntz, event_type string")
    expected = _brute_force(rows, 3600)
    for split, ranges in (("time", None), ("rows", None), ("rows", 3)):
        got = {
            r.user_id: (r.first_events, r.followed)
            for r in followed_within(
                df, "user_id", "ts", "event_type", "error", "purchase", 3600, 3600, split, ranges
            ).collect()
        }
        assert got == expected, (split, ranges)
    with pytest.raises(ValueError):
        followed_within(df, "user_id", "ts", "event_type", "error", "purchase", 3600, 3600, "bogus")
    # 300 errors share the instant of 100 purchases, which do not count (not
    # strictly later); the purchase 5 minutes later does. 320 more errors
    # follow at minutes 1..399 that are not multiples of 5.
    assert expected[1][0] == 300 + 320
    assert got[1][1] > 300


def test_event_correlation(spark):
    rows = [(0, 1.0, 2.0), (0, 2.0, 4.0), (0, 3.0, 6.0), (1, 1.0, 3.0), (1, 2.0, 2.0), (1, 3.0, 1.0)]
    df = spark.createDataFrame(rows, "flag int, x double, y double")
    got = {r.flag: (r.events, r.avg_x, r.corr_x_y) for r in event_correlation(df, "flag", "x", "y").collect()}
    assert got == {0: (3, 2.0, 1.0), 1: (3, 2.0, -1.0)}


def test_json_flatten_and_explode(spark):
    df = spark.createDataFrame([(1, '{"k": 3, "tags": ["a", "b"]}'), (2, "not json"), (3, '{"k": 5}')], "id int, j string")
    out = json_flatten(df, "j", "k INT, tags ARRAY<STRING>", keep=["id"], explode="tags").collect()
    assert sorted((r.id, r.k, r.tags) for r in out) == [(1, 3, "a"), (1, 3, "b"), (2, None, None), (3, 5, None)]
    with pytest.raises(ValueError):
        json_flatten(df, "j", "k INT", explode="k")


def test_events_without_a_key_are_counted_but_never_matched(spark):
    t0 = datetime(2024, 1, 1)
    rows = [(None, t0, "error"), (None, t0 + timedelta(hours=1), "purchase"), (1, t0, "error"), (1, t0 + timedelta(hours=1), "purchase")]
    df = spark.createDataFrame(rows, "user_id long, ts timestamp_ntz, event_type string")
    got = {r.user_id: (r.first_events, r.followed) for r in followed_within(df, "user_id", "ts", "event_type", "error", "purchase", DAY).collect()}
    assert got == {None: (1, 0), 1: (1, 1)}


@pytest.mark.parametrize("split", ["rows", "time"])
def test_first_events_without_a_time_are_not_followed(spark, split):
    t0 = datetime(2024, 1, 1)
    rows = [(1, None, "error"), (1, t0, "error"), (1, None, "purchase"), (1, t0 + timedelta(hours=1), "purchase"), (2, None, "error")]
    df = spark.createDataFrame(rows, "user_id long, ts timestamp_ntz, event_type string")
    out = followed_within(df, "user_id", "ts", "event_type", "error", "purchase", DAY, split=split)
    assert {r.user_id: (r.first_events, r.followed) for r in out.collect()} == {1: (2, 1), 2: (1, 0)}
