"""Wall-clock inputs give the same results whatever the session time zone."""

from __future__ import annotations

from datetime import datetime, timedelta

import pytest

import __spark_entry__ as entry
from strata.functions.time import epoch_micros, epoch_seconds, parse_timestamp
from tests.conftest import SF_SMALL

KEYS = [
    "parse_timestamp",
    "timestamp_from_parts",
    "filter_year_range",
    "duration_hours",
    "charge_record",
    "idle_time",
    "running_group_id",
    "interval_match",
    "topk_trend",
]


@pytest.fixture
def zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")

    def set_zone(name: str) -> None:
        spark.conf.set("spark.sql.session.timeZone", name)

    yield set_zone
    spark.conf.set("spark.sql.session.timeZone", old)


@pytest.mark.parametrize("key", KEYS)
def test_same_rows_in_any_zone(spark, zone, key):
    rows = {}
    for name in ("UTC", "America/New_York", "Asia/Kolkata"):
        zone(name)
        rows[name] = sorted(map(tuple, entry.queries()[key](spark, SF_SMALL).collect()), key=repr)
    assert rows["UTC"] == rows["America/New_York"] == rows["Asia/Kolkata"]


def test_daylight_saving_gap_is_not_moved(spark, zone):
    zone("America/New_York")
    df = spark.createDataFrame([("12-03-2023 02:30",), ("12-03-2023 03:10",)], "d string")
    out = df.select(parse_timestamp("d", "dd-MM-yyyy HH:mm").alias("t"))
    out = out.select("t", epoch_seconds("t", out.schema["t"].dataType).alias("s")).collect()
    assert [r.t for r in out] == [datetime(2023, 3, 12, 2, 30), datetime(2023, 3, 12, 3, 10)]
    assert out[1].s - out[0].s == 40 * 60


def test_wall_clock_epoch_values(spark, zone):
    zone("America/New_York")
    values = [
        datetime(1970, 1, 1, 0, 0, 0),
        datetime(1970, 1, 1, 0, 0, 1, 250000),
        datetime(1969, 12, 31, 23, 59, 59, 500000),
        datetime(1969, 12, 31, 23, 59, 59),
        datetime(2023, 3, 12, 2, 30, 5, 900000),
    ]
    df = spark.createDataFrame([(v,) for v in values], "t timestamp_ntz")
    dtype = df.schema["t"].dataType
    out = df.select(epoch_seconds("t", dtype).alias("s"), epoch_micros("t", dtype).alias("us")).collect()
    epoch = datetime(1970, 1, 1)
    for v, r in zip(values, out):
        us = (v - epoch) // timedelta(microseconds=1)
        assert r.us == us and r.s == us // 1_000_000, (v, r)
