"""Gold charge records: one row per stop request with durations, energy and idle time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from strata.operators.charge import (
    attach_idle_time,
    match_start_messages,
    match_stop_with_start,
    with_total_energy,
    with_total_time,
)
from strata.operators.filters import filter_measurand
from strata.operators.sessions import DEFAULT_BUCKET_SECONDS, idle_time
from strata.sources.files import write_colocated

RECORD_COLUMNS = [
    "charge_point_id",
    "transaction_id",
    "meter_start",
    "meter_stop",
    "start_timestamp",
    "stop_timestamp",
    "total_time",
    "total_energy",
    "total_parking_time",
]


def matched_transactions(
    start_requests: DataFrame,
    start_responses: DataFrame,
    stop_requests: DataFrame,
    ids_from_stop: bool = False,
    keep_stop_id: str | None = None,
) -> DataFrame:
    starts = match_start_messages(start_responses, start_requests)
    return match_stop_with_start(stop_requests, starts, ids_from_stop=ids_from_stop, keep_stop_id=keep_stop_id)


def parking_time(
    meter_values: DataFrame,
    order: Sequence[str] = ("timestamp",),
    bucket_seconds: int = DEFAULT_BUCKET_SECONDS,
    split: str = "rows",
    ranges: int | None = None,
) -> DataFrame:
    """Idle hours per transaction from power readings over all phases."""
    power = filter_measurand(meter_values)
    return idle_time(
        power, "transaction_id", order, "value", 0.0, bucket_seconds, "total_parking_time", split=split, ranges=ranges
    )


def charge_records(
    start_requests: DataFrame,
    start_responses: DataFrame,
    stop_requests: DataFrame,
    meter_values: DataFrame,
    order: Sequence[str] = ("timestamp",),
    bucket_seconds: int = DEFAULT_BUCKET_SECONDS,
    ids_from_stop: bool = False,
    split: str = "rows",
    ranges: int | None = None,
) -> DataFrame:
    records = matched_transactions(start_requests, start_responses, stop_requests, ids_from_stop, "__stop_id")
    records = with_total_energy(with_total_time(records))
    idle = parking_time(meter_values, order, bucket_seconds, split, ranges)
    return attach_idle_time(records, idle, stop_id="__stop_id").select(*RECORD_COLUMNS)


def colocate_messages(
    spark: SparkSession,
    base: str,
    prefix: str,
    buckets: int,
    start_requests: DataFrame,
    start_responses: DataFrame,
    stop_requests: DataFrame,
    idle: DataFrame,
) -> dict[str, DataFrame]:
    """The inputs of a charge record as bucketed tables: ``starts`` (matched),
    ``stops`` and ``idle`` by transaction id. Written once, then joined as
    often as records are asked for, without an exchange."""
    parts = {
        "starts": match_start_messages(start_responses, start_requests),
        "stops": stop_requests,
        "idle": idle,
    }
    return {
        name: write_colocated(part, f"{prefix}_{name}", f"{base.rstrip('/')}/{name}", "transaction_id", buckets)
        for name, part in parts.items()
    }


def colocated_charge_records(tables: dict[str, DataFrame]) -> DataFrame:
    """``charge_records`` of tables from ``colocate_messages``."""
    records = match_stop_with_start(tables["stops"], tables["starts"], keep_stop_id="__stop_id")
    records = with_total_energy(with_total_time(records))
    return attach_idle_time(records, tables["idle"], stop_id="__stop_id").select(*RECORD_COLUMNS)
