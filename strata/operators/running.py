"""Running totals over the rows of a key, and as-of matches built from them.

A window per key would put every row of a key into one task, and one key may
hold a large share of all rows. Here the rows are range-partitioned by (key,
order) into pieces of about equal size; a window runs inside each (key, piece),
and what earlier pieces of the key add up to comes from one summary row per
piece. Rows that tie in the order are told apart by a number of their own, so
that any number of them spreads over pieces too.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.functions.time import epoch_micros
from strata.sources.files import materialize

# Per kind: how values are gathered, and how two partial results are merged.
_GATHER = {"sum": F.sum, "min": F.min, "max": F.max}


def _merged(kind: str, a: Column, b: Column) -> Column:
    if kind == "sum":
        return F.coalesce(a + b, a, b)
    # Both skip nulls.
    return F.least(a, b) if kind == "min" else F.greatest(a, b)


def running(
    df: DataFrame,
    key: Sequence[str],
    order: Sequence[str],
    totals: dict[str, tuple[str, str]],
    ranges: int | None = None,
) -> DataFrame:
    """``df`` with a running total per entry of ``totals`` (``name: (kind, column)``,
    kind ``sum``, ``min`` or ``max``), from the first row of the row's key up to
    the row itself by ``order`` (ascending, nulls first).

    A null key column is a value like others. Rows that tie in ``order`` come
    in any order among themselves: add columns that tell them apart where it
    matters. Nulls are skipped, and a total of nulls only is null. ``max`` of a
    struct whose first field is the order gives the last non-null struct.
    ``ranges`` is the number of pieces (``spark.sql.shuffle.partitions``).
    """
    n = ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keyed = df.withColumns({"__key": F.struct(*key), "__tie": F.monotonically_increasing_id()})
    ordered = [*[F.col(c).asc() for c in order], F.col("__tie").asc()]
    ranged = keyed.repartitionByRange(n, F.col("__key").asc(), *ordered)
    # Range bounds are placed by sampling: written once, all reads see the same pieces.
    rows = materialize(ranged.withColumn("__piece", F.spark_partition_id()), "running-pieces")
    inside = Window.partitionBy("__key", "__piece").orderBy(*ordered).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    earlier = Window.partitionBy("__k").orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)
    pieces = rows.groupBy(F.col("__key").alias("__k"), F.col("__piece").alias("__p")).agg(
        *[_GATHER[kind](column).alias(name) for name, (kind, column) in totals.items()]
    )
    before = pieces.select(
        "__k", "__p", *[_GATHER[kind](name).over(earlier).alias(f"__{name}") for name, (kind, _) in totals.items()]
    )
    rows = rows.withColumns({name: _GATHER[kind](column).over(inside) for name, (kind, column) in totals.items()})
    joined = rows.join(before, (F.col("__key") == F.col("__k")) & (F.col("__piece") == F.col("__p")))
    joined = joined.withColumns({name: _merged(kind, F.col(name), F.col(f"__{name}")) for name, (kind, _) in totals.items()})
    return joined.select(*df.columns, *totals)


def asof_join(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    left_time: str,
    right_time: str,
    columns: dict[str, str],
    ties: Sequence[str] = (),
    strict: bool = False,
    within_seconds: int | None = None,
    ranges: int | None = None,
) -> DataFrame:
    """Each row of ``left`` with the last row of ``right`` of its key at or before
    its time (``strict``: before it; ``within_seconds``: not longer ago).

    ``columns`` names what to take from the matched row (``right column: output
    name``). Of rows of ``right`` at the same instant, the one with the largest
    ``ties``, then ``columns``, counts. Rows of ``left`` without a key, a time
    or a match get nulls; rows of ``right`` without a key or time match nothing.

    No pairs are formed: both sides are laid into one order by (key, time), and
    the last row of ``right`` is carried along as a struct (see ``running``).
    """
    clash = set(columns.values()) & set(left.columns)
    if clash:
        raise ValueError(f"output names {sorted(clash)} are columns of the left side")
    ordering = list(dict.fromkeys([*ties, *columns]))
    at = epoch_micros(right_time, right.schema[right_time].dataType)
    events = right.select(F.col(right_key).alias("__on"), at.alias("__at"), F.struct(*ordering).alias("__seen"))
    events = events.filter(F.col("__on").isNotNull() & F.col("__at").isNotNull())
    # One row per instant, by partial aggregation.
    events = events.groupBy("__on", "__at").agg(F.max("__seen").alias("__seen"))
    seen = F.struct(F.col("__at").alias("at"), F.col("__seen").alias("row"))
    row = F.struct(*left.columns)
    asked = left.select(
        F.col(left_key).cast(right.schema[right_key].dataType).alias("__on"),
        epoch_micros(left_time, left.schema[left_time].dataType).alias("__at"),
        row.alias("__row"),
        F.lit(0 if strict else 1).alias("__side"),
    )
    events = events.select("__on", "__at", seen.alias("__seen"), F.lit(1 if strict else 0).alias("__side"))
    both = asked.unionByName(events, allowMissingColumns=True)
    carried = running(both, ["__on"], ["__at", "__side"], {"__last": ("max", "__seen")}, ranges).filter(F.col("__row").isNotNull())
    known = F.col("__on").isNotNull() & F.col("__at").isNotNull()
    if within_seconds is not None:
        known = known & (F.col("__at") - F.col("__last.at") <= int(within_seconds) * 1_000_000)
    return carried.select("__row.*", *[F.when(known, F.col(f"__last.row.{c}")).alias(name) for c, name in columns.items()])
