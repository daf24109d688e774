"""Gaps-and-islands over ordered readings: charging state, groups, idle time.

Readings of one key (a charging transaction) are ordered by a time column
plus tie-break columns that make the order total. A reading is *charging*
when its value exceeds a threshold. A *boundary* is a change of that state
against the previous reading (the reading before the first counts as not
charging). The running sum of boundaries numbers the groups of equal state;
the idle time of a key is the sum, over its non-charging groups, of last minus
first time of the group, in whole epoch seconds.

Scale design. A per-key window would put every reading of a key into one
task, and one key may hold a large share of all rows. The readings are
therefore cut into ordered pieces: every window runs inside a (key, piece),
and only a few summary rows per piece (first row, last row, inner sums) cross
pieces. Stitching the pieces is a second, small window over one row per
non-empty piece. Idle time needs no group numbers at all: it is the sum of
time gaps between consecutive readings that are both idle, and a gap that
crosses two pieces is found from the pieces' summaries.

Ways to cut pieces (``split``):

``"rows"``  (default) range partitioning on (key, order columns, state) into
            ``ranges`` ranges (``spark.sql.shuffle.partitions`` if not given);
            the range id is the piece. Spark samples the data to place the
            range bounds, so each piece holds about the same number of rows
            whatever the skew. Costs a sampling pass and one more shuffle. For
            many terabytes choose ``ranges`` so that a range is some 256 MB.
``"time"``  buckets of ``bucket_seconds``. One shuffle on (key, bucket), but a
            piece holds all of one key's readings of one bucket: a caller's
            choice for keys known to be even.

The state takes part in the order after the order columns, so readings with
equal order columns have one defined order, and results depend on neither the
split nor the bucket width. Readings without a time come first, in the first
piece of their key; they add no idle time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.functions.measures import active_flag
from strata.functions.time import epoch_seconds
from strata.schemas import SECONDS_PER_HOUR
from strata.sources.files import materialize

DEFAULT_BUCKET_SECONDS = 86_400
# Piece of the readings without a time, before all buckets.
NO_TIME = -(1 << 62)


def _prepare(
    readings: DataFrame,
    key: str,
    order: Sequence[str],
    value: str,
    threshold: float,
    bucket_seconds: int,
    split: str = "rows",
    ranges: int | None = None,
) -> DataFrame:
    """Readings with ``_c`` (charging 0/1), ``_s`` (epoch seconds) and ``_b`` (piece id).

    Piece ids grow with the reading order inside a key, for both splits.
    """
    columns = list(dict.fromkeys([key, *order, value]))
    ts = order[0]
    r = readings.select(*columns).withColumns(
        {"_c": active_flag(value, threshold), "_s": epoch_seconds(ts, readings.schema[ts].dataType)}
    )
    if split == "time":
        bucket = F.floor(F.col("_s") / F.lit(bucket_seconds)).cast("long")
        return r.withColumn("_b", F.coalesce(bucket, F.lit(NO_TIME).cast("long")))
    if split == "rows":
        n = ranges or int(r.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        ranged = r.repartitionByRange(n, *[F.col(c).asc() for c in [key, *order, "_c"]])
        return ranged.withColumn("_b", F.spark_partition_id().cast("long"))
    raise ValueError(f"split must be 'rows' or 'time', not {split!r}")


def _piece_window(key: str, order: Sequence[str]) -> Window:
    return Window.partitionBy(key, "_b").orderBy(*[F.col(c).asc() for c in order], F.col("_c").asc())


def _at(edge: Column, c: str) -> Column:
    """The value of ``c`` in the one reading of a piece where ``edge`` holds."""
    return F.max(F.when(edge, F.col(c)))


def idle_time(
    readings: DataFrame,
    key: str = "transaction_id",
    order: Sequence[str] = ("timestamp",),
    value: str = "value",
    threshold: float = 0.0,
    bucket_seconds: int = DEFAULT_BUCKET_SECONDS,
    output: str = "total_parking_time",
    decimals: int = 2,
    split: str = "rows",
    ranges: int | None = None,
) -> DataFrame:
    """Idle hours per key, rounded half up to ``decimals``.

    Only keys with at least one idle reading appear; a key whose idle
    readings are all isolated gets 0.0. Time between groups is not counted.
    """
    r = _prepare(readings, key, order, value, threshold, bucket_seconds, split, ranges)
    return idle_of_pieces(idle_pieces(r, key, order), key, output, decimals)


def idle_pieces(r: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """One summary row per (key, piece) of prepared readings: the idle seconds
    inside, state and time of the first and the last reading, whether any is idle."""
    w = _piece_window(key, order)
    r = r.withColumns({"_pc": F.lag("_c").over(w), "_ps": F.lag("_s").over(w), "_nc": F.lead("_c").over(w)})
    both_idle = (F.col("_c") == 0) & (F.col("_pc") == 0)
    # A gap from a reading without a time is unknown and counts as none.
    r = r.withColumn("_gap", F.when(both_idle, F.coalesce(F.col("_s") - F.col("_ps"), F.lit(0))).otherwise(F.lit(0)))
    first, last = F.col("_pc").isNull(), F.col("_nc").isNull()
    return r.groupBy(key, "_b").agg(
        F.sum("_gap").alias("_inner"),
        _at(first, "_c").alias("_fc"),
        _at(first, "_s").alias("_fs"),
        _at(last, "_c").alias("_lc"),
        _at(last, "_s").alias("_ls"),
        F.max(1 - F.col("_c")).alias("_has_idle"),
    )


def idle_of_pieces(pieces: DataFrame, key: str, output: str, decimals: int = 2) -> DataFrame:
    """Idle hours per key from the summaries of its pieces in order."""
    wk = Window.partitionBy(key).orderBy("_b")
    pieces = pieces.withColumns({"_plc": F.lag("_lc").over(wk), "_pls": F.lag("_ls").over(wk)})
    edge_idle = (F.col("_fc") == 0) & (F.col("_plc") == 0)
    edge = F.when(edge_idle, F.coalesce(F.col("_fs") - F.col("_pls"), F.lit(0))).otherwise(F.lit(0))
    per_key = pieces.groupBy(key).agg(
        F.sum(F.col("_inner") + edge).alias("_idle_seconds"),
        F.max("_has_idle").alias("_has_idle"),
    )
    hours = (F.col("_idle_seconds") / F.lit(SECONDS_PER_HOUR)).cast("double")
    return per_key.filter(F.col("_has_idle") == 1).select(key, F.round(hours, decimals).alias(output))


def _with_groups(
    readings: DataFrame,
    key: str,
    order: Sequence[str],
    value: str,
    threshold: float,
    bucket_seconds: int,
    split: str = "rows",
    ranges: int | None = None,
) -> DataFrame:
    """Readings with ``charging``, ``boundary`` and ``charging_group`` columns.

    Two branches read the pieces: their summaries give each piece the number
    of groups before it (a prefix sum over one row per piece), and the rows,
    joined to that offset, take a running sum inside the piece.

    Pieces are keyed by ``struct(key)``, which is never null: readings without
    a key stay one group (as in a window), and the join keeps plain equality.
    The pieces are written once to the shared folder for both branches, which
    also fixes the range piece ids (placed by sampling).
    """
    columns = list(dict.fromkeys([key, *order, value]))
    r = _prepare(readings, key, order, value, threshold, bucket_seconds, split, ranges)
    r = materialize(r.withColumn("_k", F.struct(F.col(key))), "pieces")
    w = Window.partitionBy("_k", "_b").orderBy(*[F.col(c).asc() for c in order], F.col("_c").asc())
    r = r.withColumns({"_pc": F.lag("_c").over(w), "_nc": F.lead("_c").over(w)})
    inner_change = F.when(F.col("_pc").isNotNull(), F.abs(F.col("_c") - F.col("_pc"))).otherwise(F.lit(0))
    pieces = r.groupBy("_k", "_b").agg(
        F.sum(inner_change).alias("_inner"),
        _at(F.col("_pc").isNull(), "_c").alias("_fc"),
        _at(F.col("_nc").isNull(), "_c").alias("_lc"),
    )
    wk = Window.partitionBy("_k").orderBy("_b")
    # State before the piece: last state of the previous piece, 0 before the first.
    pieces = pieces.withColumn("_plc", F.coalesce(F.lag("_lc").over(wk), F.lit(0)))
    head_change = F.abs(F.col("_fc") - F.col("_plc"))
    before = F.sum(F.col("_inner") + head_change).over(wk.rowsBetween(Window.unboundedPreceding, -1))
    offsets = pieces.select(
        F.col("_k").alias("__k"), F.col("_b").alias("__b"), "_plc", F.coalesce(before, F.lit(0)).alias("_offset")
    )
    joined = r.join(offsets, (F.col("_k") == F.col("__k")) & (F.col("_b") == F.col("__b")), "inner")
    boundary = F.abs(F.col("_c") - F.coalesce(F.col("_pc"), F.col("_plc")))
    joined = joined.withColumn("boundary", boundary)
    running = F.sum("boundary").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return joined.select(
        *columns,
        F.col("_c").alias("charging"),
        "boundary",
        (F.col("_offset") + running).alias("charging_group"),
    )


def charging_boundaries(
    readings: DataFrame,
    key: str = "transaction_id",
    order: Sequence[str] = ("timestamp",),
    value: str = "value",
    threshold: float = 0.0,
    bucket_seconds: int = DEFAULT_BUCKET_SECONDS,
    split: str = "rows",
    ranges: int | None = None,
) -> DataFrame:
    """Per reading: ``charging`` (0/1) and ``boundary`` = |charging - previous|."""
    g = _with_groups(readings, key, order, value, threshold, bucket_seconds, split, ranges)
    columns = list(dict.fromkeys([key, *order, value]))
    return g.select(*columns, "charging", "boundary")


def running_group_id(
    readings: DataFrame,
    key: str = "transaction_id",
    order: Sequence[str] = ("timestamp",),
    value: str = "value",
    threshold: float = 0.0,
    bucket_seconds: int = DEFAULT_BUCKET_SECONDS,
    split: str = "rows",
    ranges: int | None = None,
) -> DataFrame:
    """Per reading: ``charging``, ``boundary`` and ``charging_group`` (running sum)."""
    g = _with_groups(readings, key, order, value, threshold, bucket_seconds, split, ranges)
    columns = list(dict.fromkeys([key, *order, value]))
    return g.select(*columns, "charging", "boundary", F.col("charging_group").cast("long").alias("charging_group"))


def group_bounds(
    readings: DataFrame,
    key: str = "transaction_id",
    order: Sequence[str] = ("timestamp",),
    value: str = "value",
    threshold: float = 0.0,
    bucket_seconds: int = DEFAULT_BUCKET_SECONDS,
    split: str = "rows",
    ranges: int | None = None,
) -> DataFrame:
    """Per (key, group): state, first and last time, number of readings.

    Plain minimum and maximum of the time, with partial aggregation, so a long
    group doesn't concentrate in one task. A group of readings without a time
    has neither first nor last.
    """
    g = _with_groups(readings, key, order, value, threshold, bucket_seconds, split, ranges)
    ts = order[0]
    return g.groupBy(key, F.col("charging_group").cast("long").alias("charging_group")).agg(
        F.max("charging").alias("charging"),
        F.min(ts).alias("first"),
        F.max(ts).alias("last"),
        F.count(F.lit(1)).alias("readings"),
    )
