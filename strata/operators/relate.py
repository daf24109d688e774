"""Relations between event kinds: grouped statistics and 'followed within'."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.functions.time import epoch_micros
from strata.sources.files import materialize


def event_correlation(df: DataFrame, flag: str, x: str, y: str, decimals: int = 6) -> DataFrame:
    """Per flag value: row count, mean of ``x`` and Pearson correlation of x and y.

    Plain aggregates with partial (map-side) aggregation; no row is shuffled.
    """
    return df.groupBy(flag).agg(
        F.count(F.lit(1)).alias("events"),
        F.round(F.avg(x), decimals).alias(f"avg_{x}"),
        F.round(F.corr(x, y), decimals).alias(f"corr_{x}_{y}"),
    )


def followed_within(
    events: DataFrame,
    key: str,
    ts: str,
    kind: str,
    first_kind: str,
    then_kind: str,
    within_seconds: int,
    bucket_seconds: int = 86_400,
    split: str = "rows",
    ranges: int | None = None,
) -> DataFrame:
    """Per key: how many ``first_kind`` events are followed by a ``then_kind``
    event of the same key within ``(t, t + within_seconds]``.

    No pairs are formed, and no task holds a whole key:

    1. Events are counted per (key, instant) with partial aggregation: the
       number of first events and whether a then-event happened there. Any
       number of events at one instant becomes one row.
    2. The instants of a key are cut into ordered pieces (``split="rows"``, the
       default: ``ranges`` range partitions of equal size, or
       ``spark.sql.shuffle.partitions`` of them; ``split="time"``: buckets of
       ``bucket_seconds``, a caller's choice for keys known to be even). Inside
       a piece, the earliest then-instant strictly after each instant is a
       running minimum in descending time order. Across pieces, it is the
       minimum over all later pieces, from one row per piece. Joined back on
       (key, piece), an instant's first events are followed when that earliest
       then-instant is at most ``within_seconds`` after it.

    Output: ``key, first_events, followed``; keys without ``first_kind``
    events are absent. A first event without a time counts as not followed; a
    then-event without a time follows nothing.
    """
    if split not in ("rows", "time"):
        raise ValueError(f"split must be 'rows' or 'time', not {split!r}")
    within_us = int(within_seconds) * 1_000_000
    e = events.filter(F.col(kind).isin(first_kind, then_kind)).select(
        F.col(key),
        epoch_micros(ts, events.schema[ts].dataType).alias("_m"),
        (F.col(kind) == F.lit(first_kind)).cast("long").alias("_first"),
        # A then-event without a key is no one's partner (null never equals null).
        ((F.col(kind) == F.lit(then_kind)) & F.col(key).isNotNull()).cast("int").alias("_then"),
    )
    # Keyed by struct(key), never null: events without a key stay one group and
    # every join below keeps plain equality on the window's partitioning.
    instants = e.groupBy(F.struct(F.col(key)).alias("_k"), "_m").agg(
        F.sum("_first").alias("_firsts"), F.max("_then").alias("_has_then")
    )
    bucket_us = int(bucket_seconds) * 1_000_000
    if split == "time":
        bucket = F.floor(F.col("_m") / F.lit(bucket_us)).cast("long")
        instants = instants.withColumn("_p", F.coalesce(bucket, F.lit(-(1 << 62)).cast("long")))
        # Read twice below (piece summaries and the join back), computed once.
        instants = materialize(instants, "instants")
    else:
        n = ranges or int(instants.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        ranged = instants.repartitionByRange(n, F.col("_k").asc(), F.col("_m").asc())
        # Range ids are placed by sampling: written once, both reads see the same
        # ids. The sample is drawn from the grouped rows, whose shuffle is reused.
        instants = materialize(ranged.withColumn("_p", F.spark_partition_id().cast("long")), "instant-pieces")
    then_time = F.when(F.col("_has_then") == 1, F.col("_m"))
    # Instants are distinct within a key, so ROWS ending 1 before the current
    # row (in descending time) are exactly the strictly later instants.
    later_in_piece = (
        Window.partitionBy("_k", "_p").orderBy(F.col("_m").desc()).rowsBetween(Window.unboundedPreceding, -1)
    )
    instants = instants.withColumn("_next", F.min(then_time).over(later_in_piece))
    pieces = instants.groupBy(F.col("_k").alias("__k"), F.col("_p").alias("__p")).agg(
        F.min(then_time).alias("_piece_then")
    )
    later_pieces = Window.partitionBy("__k").orderBy(F.col("__p").desc()).rowsBetween(Window.unboundedPreceding, -1)
    pieces = pieces.select("__k", "__p", F.min("_piece_then").over(later_pieces).alias("_after"))
    firsts = instants.filter(F.col("_firsts") > 0)
    joined = firsts.join(pieces, (F.col("_k") == F.col("__k")) & (F.col("_p") == F.col("__p")), "inner")
    nxt = F.least(F.col("_next"), F.col("_after"))
    hit = F.when(nxt.isNotNull() & (nxt <= F.col("_m") + F.lit(within_us)), F.col("_firsts")).otherwise(F.lit(0))
    return joined.groupBy(F.col("_k").getField(key).alias(key)).agg(
        F.sum("_firsts").cast("long").alias("first_events"),
        F.sum(hit).cast("long").alias("followed"),
    )
