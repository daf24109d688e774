"""Charge records on FIXTURES.md section 2 (start/stop rows)."""

from __future__ import annotations

from datetime import datetime

import pytest

from strata.plans.charge import RECORD_COLUMNS, charge_records, matched_transactions


def _t(h, m, s=0):
    return datetime(2023, 1, 1, h, m, s)


@pytest.fixture
def frames(spark):
    requests = spark.createDataFrame(
        [("m1", 0, _t(10, 0)), ("m2", 100, _t(10, 0)), ("m3", 0, _t(10, 0)), ("m4", 0, _t(10, 0))],
        "message_id string, meter_start int, timestamp timestamp_ntz",
    )
    responses = spark.createDataFrame(
        [("m1", "CP-1", 1), ("m2", "CP-2", 2), ("m4", "CP-4", 4)],
        "message_id string, charge_point_id string, transaction_id int",
    )
    stops = spark.createDataFrame(
        [(1, 2500, _t(11, 30)), (2, 100, _t(10, 0, 30)), (3, 50, _t(10, 10))],
        "transaction_id int, meter_stop int, timestamp timestamp_ntz",
    )
    meter = spark.createDataFrame(
        [(2, _t(10, 0), 0.0, "Power.Active.Import", None), (2, _t(10, 1), 0.0, "Power.Active.Import", None)],
        "transaction_id int, timestamp timestamp_ntz, value double, measurand string, phase string",
    )
    return requests, responses, stops, meter


def test_charge_record_fixture(frames):
    out = charge_records(*frames).collect()
    assert [c for c in out[0].asDict()] == RECORD_COLUMNS
    by_stop = {r.meter_stop: r for r in out}
    assert len(out) == 3  # transaction 4 never stopped
    r1, r2, r3 = by_stop[2500], by_stop[100], by_stop[50]
    assert (r1.charge_point_id, r1.transaction_id, r1.total_time, r1.total_energy) == ("CP-1", 1, 1.5, 2.5)
    assert (r2.total_time, r2.total_energy, r2.total_parking_time) == (0.01, 0.0, 0.02)
    assert r1.total_parking_time is None  # no readings: null after the left join
    # stop without a start: kept, ids and start measures null (ids come from the start side)
    assert (r3.charge_point_id, r3.transaction_id, r3.meter_start, r3.start_timestamp, r3.total_time) == (
        None, None, None, None, None,
    )


def test_ids_from_stop_option(frames):
    requests, responses, stops, _ = frames
    out = matched_transactions(requests, responses, stops, ids_from_stop=True)
    assert sorted(r.transaction_id for r in out.collect()) == [1, 2, 3]
