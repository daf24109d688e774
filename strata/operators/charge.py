"""Charge records: match start/stop messages, durations, energy, idle time.

All matches are equi-joins on message or transaction ids; Spark shuffles both
sides on the id (or broadcasts a side AQE measures as small at run time), and
AQE splits a skewed id partition of the larger side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.measures import unit_delta
from strata.functions.time import hours_between


def match_start_messages(
    responses: DataFrame,
    requests: DataFrame,
    message_id: str = "message_id",
) -> DataFrame:
    """Start responses matched to start requests on the message id (inner).

    Ids come from the response, meter reading and time from the request:
    ``charge_point_id, transaction_id, meter_start, start_timestamp``.
    """
    resp = responses.select(
        F.col(message_id).alias("__mid"),
        F.col("charge_point_id"),
        F.col("transaction_id"),
    )
    req = requests.select(
        F.col(message_id).alias("__rid"),
        F.col("meter_start"),
        F.col("timestamp").alias("start_timestamp"),
    )
    return resp.join(req, F.col("__mid") == F.col("__rid"), "inner").select(
        "charge_point_id", "transaction_id", "meter_start", "start_timestamp"
    )


def match_stop_with_start(
    stops: DataFrame, starts: DataFrame, ids_from_stop: bool = False, keep_stop_id: str | None = None
) -> DataFrame:
    """Stop requests left-joined with matched starts on the transaction id.

    By default the ids come from the start side, so a stop without a start
    keeps its row with null ``charge_point_id`` and ``transaction_id``;
    ``ids_from_stop=True`` keeps the stop's own transaction id instead.
    ``keep_stop_id`` also keeps the stop's id under that name: the result is
    hash-partitioned on it, so a later join on it needs no new shuffle.
    """
    stop = stops.select(
        F.col("transaction_id").alias("__stop_tid"),
        F.col("meter_stop"),
        F.col("timestamp").alias("stop_timestamp"),
    )
    start = starts.select(
        F.col("charge_point_id"),
        F.col("transaction_id").alias("__start_tid"),
        F.col("meter_start"),
        F.col("start_timestamp"),
    )
    joined = stop.join(start, F.col("__stop_tid") == F.col("__start_tid"), "left")
    tid = F.col("__stop_tid") if ids_from_stop else F.col("__start_tid")
    extra = [F.col("__stop_tid").alias(keep_stop_id)] if keep_stop_id else []
    return joined.select(
        F.col("charge_point_id"),
        tid.alias("transaction_id"),
        F.col("meter_start"),
        F.col("meter_stop"),
        F.col("start_timestamp"),
        F.col("stop_timestamp"),
        *extra,
    )


def with_total_time(df: DataFrame, start: str = "start_timestamp", stop: str = "stop_timestamp") -> DataFrame:
    """Add ``total_time``: hours from start to stop, 2 decimals."""
    types = df.schema
    return df.withColumn(
        "total_time", hours_between(start, stop, 2, types[start].dataType, types[stop].dataType)
    )


def with_total_energy(df: DataFrame, start: str = "meter_start", stop: str = "meter_stop") -> DataFrame:
    """Add ``total_energy``: (stop - start) Wh as kWh, 2 decimals."""
    return df.withColumn("total_energy", unit_delta(stop, start))


def attach_idle_time(
    records: DataFrame, idle: DataFrame, output: str = "total_parking_time", stop_id: str | None = None
) -> DataFrame:
    """Left join of charge records with idle hours per transaction.

    Transactions that never idle, and records without a transaction id, get
    null. With ``stop_id`` (the stop's id kept by ``match_stop_with_start``)
    the join runs on that column, on which the records are already
    partitioned; wherever ``transaction_id`` is set it equals the stop's id,
    and where it is null the hours are nulled, so the rows are the same as a
    join on ``transaction_id``, without shuffling the records again.
    """
    right = idle.select(F.col("transaction_id").alias("__idle_tid"), F.col(output).alias("__idle_value"))
    on = stop_id or "transaction_id"
    joined = records.join(right, F.col(on) == F.col("__idle_tid"), "left")
    value = F.when(F.col("transaction_id").isNotNull(), F.col("__idle_value"))
    kept = [c for c in records.columns if c != stop_id]
    return joined.select(*kept, value.alias(output))
