"""Idle time kept up to date batch by batch.

The state is two Parquet datasets below one folder:

``readings/batch=<id>/piece=<n>``  the readings, as they came
``pieces/piece=<n>``               one summary row per (key, piece of time): first and
                                   last reading, idle seconds between them

Pieces are buckets of time. Two summaries whose readings don't interleave make
one by addition: the seconds inside both, and the gap between the last reading
of the earlier and the first of the later one if both are idle. So a batch reads
no old reading where its own come after (or before) those of their piece, and
only the readings of that key and piece where they fall between. Summaries of
pieces without new readings aren't read or written at all.

A batch is known by its id: running it again, after a failure at any point,
gives the state it would have given at once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from strata.operators.sessions import DEFAULT_BUCKET_SECONDS, _prepare, idle_of_pieces, idle_pieces
from strata.session import scratch_scope
from strata.sources.files import materialize, overwrite_partitions

# Of two summaries, the fields that stand for one reading at an end.
_FIRST, _LAST = ("_first", "_fc", "_fs"), ("_last", "_lc", "_ls")


def _summaries(prepared: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """``idle_pieces`` and the first and last reading's place in the order."""
    place = F.struct(*order, "_c")
    ends = prepared.groupBy(key, "_b").agg(F.min(place).alias("_first"), F.max(place).alias("_last"))
    ends = ends.select(F.struct(key).alias("_k"), F.col("_b").alias("_piece"), "_first", "_last")
    pieces = idle_pieces(prepared, key, order).withColumn("_key", F.struct(key))
    return pieces.join(ends, (F.col("_key") == F.col("_k")) & (F.col("_b") == F.col("_piece"))).drop("_key", "_k", "_piece")


def _added(key: str) -> list[Column]:
    """The summary of an old (``o``) and a new (``n``) one that don't interleave."""
    old_first = F.col("o._last") <= F.col("n._first")
    one = lambda name, early: F.when(old_first == early, F.col(f"o.{name}")).otherwise(F.col(f"n.{name}"))
    gap = F.when(
        (one("_lc", True) == 0) & (one("_fc", False) == 0), F.coalesce(one("_fs", False) - one("_ls", True), F.lit(0))
    ).otherwise(F.lit(0))
    return [
        F.col(f"n.{key}"),
        F.col("n._b"),
        (F.col("o._inner") + F.col("n._inner") + gap).alias("_inner"),
        *[one(name, True).alias(name) for name in _FIRST],
        *[one(name, False).alias(name) for name in _LAST],
        F.greatest("o._has_idle", "n._has_idle").alias("_has_idle"),
    ]


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place)


def _stored(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    """A dataset of the state, in the columns of ``like``; ``_b`` is its partition."""
    fields = [StructField("piece", LongType()) if f.name == "_b" else f for f in like.schema.fields]
    return spark.read.schema(StructType(fields)).parquet(path).withColumnRenamed("piece", "_b")


def add_readings(
    readings: DataFrame,
    base: str,
    batch: str,
    key: str = "transaction_id",
    order: Sequence[str] = ("timestamp",),
    value: str = "value",
    threshold: float = 0.0,
    bucket_seconds: int = DEFAULT_BUCKET_SECONDS,
) -> int:
    """Add a batch of readings, in whatever order of time, to the state at
    ``base``. Returns the number of (key, piece) groups whose old readings had
    to be read again."""
    spark = readings.sparkSession
    order = list(order)
    stored, state = f"{base.rstrip('/')}/readings", f"{base.rstrip('/')}/pieces"
    with scratch_scope(spark):
        prepared = materialize(_prepare(readings, key, order, value, threshold, bucket_seconds, "time"), "idle-batch")
        before = _exists(spark, state)
        kept = prepared.withColumns({"batch": F.lit(batch), "piece": F.col("_b")}).drop("_b")
        overwrite_partitions(kept, stored, ["batch", "piece"])
        fresh = _summaries(prepared, key, order)
        again = 0
        if before:
            touched = prepared.select("_b").distinct()
            # Only the touched pieces' folders are read (dynamic partition pruning).
            old = _stored(spark, state, fresh).join(touched, "_b", "left_semi")
            old = materialize(old.select(*fresh.columns), "idle-old")
            fresh = materialize(fresh, "idle-new")
            same = F.col(f"o.{key}").eqNullSafe(F.col(f"n.{key}")) & (F.col("o._b") == F.col("n._b"))
            both = old.alias("o").join(fresh.alias("n"), same)
            apart = (F.col("o._last") <= F.col("n._first")) | (F.col("n._last") <= F.col("o._first"))
            # A batch that comes again must not be added to itself.
            equal_ends = (F.col("o._first") == F.col("n._first")) | (F.col("o._last") == F.col("n._last"))
            added = both.filter(apart & ~equal_ends).select(*_added(key))
            mixed = materialize(both.filter(~apart | equal_ends).select(F.struct(f"n.{key}").alias("_k"), F.col("n._b").alias("_b")), "idle-mixed")
            again = mixed.count()
            untouched = old.alias("o").join(fresh.alias("n"), same, "left_anti")
            alone = fresh.alias("n").join(old.alias("o"), same, "left_anti")
            fresh = untouched.unionByName(alone).unionByName(added.select(*fresh.columns))
            if again:
                every = _stored(spark, stored, prepared).withColumn("_k", F.struct(key)).join(mixed, ["_k", "_b"], "left_semi")
                every = every.select(*prepared.columns)
                fresh = fresh.unionByName(_summaries(materialize(every, "idle-again"), key, order).select(*fresh.columns))
        overwrite_partitions(fresh.withColumnRenamed("_b", "piece"), state, ["piece"])
    return again


def idle_from_state(
    spark: SparkSession, base: str, key: str = "transaction_id", output: str = "total_parking_time", decimals: int = 2
) -> DataFrame:
    """Idle hours per key from the summaries alone, as ``idle_time`` over all
    readings added so far."""
    pieces = spark.read.parquet(f"{base.rstrip('/')}/pieces").withColumn("_b", F.col("piece").cast("long"))
    return idle_of_pieces(pieces, key, output, decimals)
