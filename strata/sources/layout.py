"""Datasets laid out for skipping, and datasets whose layout changes with time."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    ByteType,
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    MapType,
    NumericType,
    ShortType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

from strata.functions.time import epoch_micros
from strata.sources.files import publish_parquet

# ---- clustering and skipping ----------------------------------------------------------

# Bits of a column's place in the Z-order: 2^BITS parts of about equal size.
BITS = 8


def _number(name: str, kind: DataType) -> Column:
    """A number that grows with the column's values (text: with its first six bytes)."""
    c = F.col(f"`{name}`")
    if isinstance(kind, StringType):
        head = F.rpad(F.hex(F.substring(c.cast("binary"), 1, 6)), 12, "0")
        return F.conv(head, 16, 10).cast("double")
    if isinstance(kind, NumericType):
        return c.cast("double")
    if isinstance(kind, DateType):
        return F.unix_date(c).cast("double")
    return epoch_micros(c, kind).cast("double")


def with_z_order(df: DataFrame, by: Sequence[str], name: str = "__z", bits: int = BITS) -> DataFrame:
    """``df`` with ``name``, a row's place in the Z-order over ``by``: each column
    is cut at its own quantiles into at most 2^bits parts (one job; 2^bits numbers
    a column reach the driver), and the bits of the parts are interleaved. Nulls
    come first."""
    cuts = [k / (1 << bits) for k in range(1, 1 << bits)]
    numbers = [_number(c, df.schema[c].dataType) for c in by]
    found = df.agg(*[F.percentile_approx(n, cuts, 10_000).alias(f"c{k}") for k, n in enumerate(numbers)]).first()
    parts = {}
    for k, n in enumerate(numbers):
        bounds = sorted(set(found[f"c{k}"] or []))
        # Few distinct values are spread over all parts, or their high bits would say nothing.
        place = _place(F.col(f"__number{k}"), bounds) * (1 << bits) / (len(bounds) + 1)
        parts[f"__part{k}"] = F.when(n.isNull(), 0).otherwise(F.floor(place).cast("int"))
    # Each is used more than once: columns of their own are computed once.
    placed = df.withColumns({f"__number{k}": n for k, n in enumerate(numbers)}).withColumns(parts)
    z = F.lit(0).cast("long")
    for k, part in enumerate(parts):
        for bit in range(bits):
            one = F.shiftright(F.col(part), bit).bitwiseAND(F.lit(1)).cast("long")
            z = z.bitwiseOR(F.shiftleft(one, bit * len(numbers) + k))
    return placed.withColumn(name, z).drop(*parts, *[f"__number{k}" for k in range(len(numbers))])


# Bounds are looked up in two steps, in every STEP-th and then among STEP of them.
STEP = 16


def _place(value: Column, bounds: list[float]) -> Column:
    """The number of ascending bounds not above the value."""
    if not bounds:
        return F.lit(0)
    every = F.array(*[F.lit(b) for b in bounds])
    firsts = F.array(*[F.lit(b) for b in bounds[::STEP]])
    block = F.greatest(F.size(F.filter(firsts, lambda b: b <= value)) - 1, F.lit(0))
    return block * STEP + F.size(F.filter(F.slice(every, block * STEP + 1, F.lit(STEP)), lambda b: b <= value))


def zones_path(path: str) -> str:
    return f"{path.rstrip('/')}.zones"


def write_clustered(df: DataFrame, path: str, by: Sequence[str], files: int, bloom: Sequence[str] = ()) -> str:
    """Publish ``df`` in ``files`` files along the Z-order over ``by``, each with
    a narrow range of all of these columns, and beside it the ranges by file
    (``zones_path``) for ``read_clustered``.

    ``bloom`` names columns that get Parquet bloom filters: a lookup by id skips
    the row groups that can't hold it. Rows with equal values of all columns may
    lie in several files.
    """
    spark = df.sparkSession
    placed = with_z_order(df, by).withColumn("__tie", F.monotonically_increasing_id())
    ranged = placed.repartitionByRange(files, "__z", "__tie").sortWithinPartitions("__z").drop("__z", "__tie")
    options = {f"parquet.bloom.filter.enabled#{c}": "true" for c in bloom}
    publish_parquet(ranged, path, options=options)
    written = spark.read.schema(df.schema).parquet(path)
    ends = [f(F.col(f"`{c}`")).alias(f"{c}.{name}") for c in by for f, name in ((F.min, "min"), (F.max, "max"))]
    nulls = [F.count_if(F.col(f"`{c}`").isNull()).alias(f"{c}.nulls") for c in by]
    zones = written.groupBy(F.col("_metadata.file_name").alias("file")).agg(F.count(F.lit(1)).alias("rows"), *ends, *nulls)
    publish_parquet(zones, zones_path(path))
    return path


def read_clustered(spark: SparkSession, path: str, ranges: Mapping[str, tuple], schema: StructType | None = None) -> DataFrame:
    """Rows of a clustered dataset whose columns lie in ``ranges`` (``column: (low,
    high)``, both ends included, None for open).

    Files whose zones exclude the ranges aren't opened; the names of the others
    go through the driver. The rows are filtered as well, and row groups are
    skipped by Parquet's own statistics.
    """
    zones = spark.read.parquet(zones_path(path))

    def within(low: object, high: object, least: Column, most: Column) -> Column:
        out = F.lit(True)
        if low is not None:
            out = out & (most >= F.lit(low))
        if high is not None:
            out = out & (least <= F.lit(high))
        return out

    may = F.lit(True)
    for c, (low, high) in ranges.items():
        may = may & within(low, high, F.col(f"`{c}.min`"), F.col(f"`{c}.max`"))
    names = [r["file"] for r in zones.filter(may).select("file").collect()]
    reader = spark.read.schema(schema) if schema is not None else spark.read
    # With no file left, any of the dataset's schema and no row will do.
    rows = reader.parquet(*[f"{path.rstrip('/')}/{n}" for n in names]) if names else reader.parquet(path).filter(F.lit(False))
    for c, (low, high) in ranges.items():
        rows = rows.filter(within(low, high, F.col(f"`{c}`"), F.col(f"`{c}`")))
    return rows


# ---- layouts that change ---------------------------------------------------------------


@dataclass(frozen=True)
class Difference:
    """How a field of a dataset differs from the contract: ``added`` (not in the
    contract), ``missing``, ``widened`` (read in the contract's wider type) or
    ``refused`` (no lossless reading)."""

    field: str
    kind: str
    found: str | None
    wanted: str | None


_WHOLE = [ByteType, ShortType, IntegerType, LongType]


def _widens(found: DataType, wanted: DataType) -> bool:
    """Whether every value of one type is one of the other, and Parquet reads it so."""
    kinds = type(found), type(wanted)
    if kinds[0] in _WHOLE and kinds[1] in _WHOLE:
        return _WHOLE.index(kinds[0]) < _WHOLE.index(kinds[1])
    if isinstance(found, DecimalType) and isinstance(wanted, DecimalType):
        return wanted.scale >= found.scale and wanted.precision - wanted.scale >= found.precision - found.scale
    return kinds in {
        (FloatType, DoubleType),
        *((whole, DoubleType) for whole in _WHOLE[:3]),
        (DateType, TimestampNTZType),
    }


def schema_differences(found: StructType, contract: StructType, prefix: str = "") -> list[Difference]:
    """Differences of a layout from the contract, at every depth, by name."""
    out: list[Difference] = []
    here = {f.name: f for f in found.fields}
    for want in contract.fields:
        name = prefix + want.name
        have = here.pop(want.name, None)
        if have is None:
            out.append(Difference(name, "missing", None, want.dataType.simpleString()))
        else:
            out += _type_differences(have.dataType, want.dataType, name)
    return out + [Difference(prefix + f.name, "added", f.dataType.simpleString(), None) for f in here.values()]


def _type_differences(found: DataType, wanted: DataType, name: str) -> list[Difference]:
    if isinstance(found, StructType) and isinstance(wanted, StructType):
        return schema_differences(found, wanted, f"{name}.")
    if isinstance(found, ArrayType) and isinstance(wanted, ArrayType):
        return _type_differences(found.elementType, wanted.elementType, f"{name}[]")
    if isinstance(found, MapType) and isinstance(wanted, MapType):
        key = _type_differences(found.keyType, wanted.keyType, f"{name}.key")
        return key + _type_differences(found.valueType, wanted.valueType, f"{name}.value")
    if found == wanted:
        return []
    kind = "widened" if _widens(found, wanted) else "refused"
    return [Difference(name, kind, found.simpleString(), wanted.simpleString())]


def generation_differences(spark: SparkSession, paths: Sequence[str], contract: StructType) -> dict[str, list[Difference]]:
    """Per dataset its differences from the contract. The files of a dataset are
    merged (``mergeSchema``), so a field that only some of them have counts."""
    return {p: schema_differences(spark.read.option("mergeSchema", True).parquet(p).schema, contract) for p in paths}


def read_generations(spark: SparkSession, paths: Sequence[str], contract: StructType, added: bool = False) -> DataFrame:
    """Datasets of one kind, written under different layouts, as one frame in the
    contract's columns, in one scan.

    A field that a dataset lacks is null, one of a narrower type is read in the
    contract's. A type that can't be read without loss is refused with all its
    places, before any row is read. Fields that the contract doesn't know are
    left out; with ``added`` they follow it, if all datasets that have one agree
    on its type.
    """
    found = generation_differences(spark, paths, contract)
    refused = [f"{p}: {d.field} is {d.found}, not {d.wanted}" for p, ds in found.items() for d in ds if d.kind == "refused"]
    if refused:
        raise ValueError("layouts can't be read as the contract says:\n " + "\n ".join(refused))
    more: dict[str, DataType] = {}
    if added:
        for path in paths:
            for f in spark.read.option("mergeSchema", True).parquet(path).schema.fields:
                if f.name not in contract.names and more.setdefault(f.name, f.dataType) != f.dataType:
                    raise ValueError(f"added field {f.name} is {f.dataType.simpleString()} in {path}, {more[f.name].simpleString()} elsewhere")
    schema = StructType([*contract.fields, *[StructField(n, k, True) for n, k in more.items()]])
    return spark.read.schema(schema).parquet(*paths)
