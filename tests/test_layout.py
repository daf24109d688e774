"""Clustered datasets and datasets of several layouts."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata.session import scratch_path
from strata.sources.files import publish_parquet
from strata.sources.layout import (
    Difference,
    generation_differences,
    read_clustered,
    read_generations,
    schema_differences,
    with_z_order,
    write_clustered,
    zones_path,
)

T0 = dt.datetime(2000, 1, 1)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    names = ["Chile", "China", "Fiji", "Indonesia", "Japan", "Peru", "Tonga", None]
    return [
        (i, rng.choice(names), None if rng.random() < 0.02 else T0 + dt.timedelta(hours=rng.randrange(200_000)), rng.gauss(0, 50))
        for i in range(4000)
    ]


@pytest.fixture
def events(spark, rows):
    return spark.createDataFrame(rows, "id long, country string, at timestamp_ntz, x double").repartition(6)


RANGES = [
    {"country": ("Fiji", "Fiji"), "at": (T0, T0 + dt.timedelta(days=700))},
    {"country": ("Japan", None)},
    {"at": (None, T0 + dt.timedelta(days=100))},
    {"x": (-5.0, 5.0), "country": ("China", "Indonesia")},
    {"country": ("Zz", None)},
    {},
]


def test_clustered_reads_equal_a_filter_and_open_fewer_files(spark, rows, events):
    path = write_clustered(events, scratch_path(spark, "test-clustered"), ["country", "at", "x"], 32, bloom=["id"])
    opened = []
    for ranges in RANGES:
        got = read_clustered(spark, path, ranges, events.schema)

        def fits(row):
            values = dict(zip(events.columns, row))
            return all(
                values[c] is not None and (lo is None or values[c] >= lo) and (hi is None or values[c] <= hi) for c, (lo, hi) in ranges.items()
            )

        assert sorted(r.id for r in got.collect()) == [r[0] for r in rows if fits(r)]
        opened.append(len(got.inputFiles()))
    # Selective in two columns: a third of the files; in one of three: two thirds.
    assert opened[0] <= 11 and max(opened[1:3]) <= 21 and opened[-2] <= 1 and opened[-1] == 32, opened
    assert spark.read.parquet(zones_path(path)).agg(F.sum("rows")).first()[0] == len(rows)


def test_z_order_of_few_and_no_values(spark, events):
    flat = events.withColumns({"country": F.lit("one"), "at": F.lit(None).cast("timestamp_ntz")})
    assert with_z_order(flat, ["country", "at"]).select("__z").distinct().count() == 1
    assert with_z_order(events.limit(0), ["country", "at"]).count() == 0
    path = write_clustered(events.limit(0), scratch_path(spark, "test-empty"), ["country"], 4)
    assert read_clustered(spark, path, {"country": ("a", "b")}, events.schema).count() == 0
    few = with_z_order(events, ["x"], bits=2)
    by_part = few.groupBy("__z").agg(F.min("x").alias("low"), F.max("x").alias("high"), F.count(F.lit(1)).alias("n")).orderBy("__z").collect()
    assert len(by_part) == 4 and all(a.high <= b.low for a, b in zip(by_part, by_part[1:])) and min(r.n for r in by_part) > 900


@pytest.fixture
def contract(spark):
    return StructType.fromDDL("id bigint, at timestamp_ntz, amount double, tags array<string>, place struct<lat: double, code: bigint>")


def test_differences_at_every_depth(contract):
    found = StructType.fromDDL("id int, at date, tags array<int>, place struct<lat: float, code: string, more: int>, extra string")
    assert schema_differences(found, contract) == [
        Difference("id", "widened", "int", "bigint"),
        Difference("at", "widened", "date", "timestamp_ntz"),
        Difference("amount", "missing", None, "double"),
        Difference("tags[]", "refused", "int", "string"),
        Difference("place.lat", "widened", "float", "double"),
        Difference("place.code", "refused", "string", "bigint"),
        Difference("place.more", "added", "int", None),
        Difference("extra", "added", "string", None),
    ]
    assert schema_differences(contract, contract) == []
    narrow = schema_differences(StructType.fromDDL("n bigint, d decimal(10,2), e decimal(10,2)"), StructType.fromDDL("n int, d decimal(12,3), e decimal(10,3)"))
    assert [d.kind for d in narrow] == ["refused", "widened", "refused"]


def test_generations_read_as_one(spark, contract):
    base = scratch_path(spark, "test-generations")
    old = spark.sql("select 1 as id, date'2001-02-03' as at, cast(1.5 as float) as amount")
    new = spark.sql("select 5000000000L as id, timestamp_ntz'2011-02-03 04:05:06' as at, 2.5D as amount, array('t') as tags, 'x' as extra")
    paths = [publish_parquet(f, f"{base}/{k}") for k, f in enumerate((old, new))]
    flat = StructType([f for f in contract.fields if f.name != "place"])
    rows = sorted(tuple(r) for r in read_generations(spark, paths, flat).collect())
    assert rows == [(1, dt.datetime(2001, 2, 3), 1.5, None), (5_000_000_000, dt.datetime(2011, 2, 3, 4, 5, 6), 2.5, ["t"])]
    assert read_generations(spark, paths, flat, added=True).filter("extra = 'x'").count() == 1
    assert [d.kind for d in generation_differences(spark, paths, flat)[paths[0]]] == ["widened", "widened", "widened", "missing"]
    narrow = StructType.fromDDL("id int, at timestamp_ntz")
    with pytest.raises(ValueError, match="id is bigint, not int"):
        read_generations(spark, paths, narrow)
    paths.append(publish_parquet(spark.sql("select 7L as id, 8 as extra"), f"{base}/2"))
    with pytest.raises(ValueError, match="added field extra"):
        read_generations(spark, paths, flat, added=True)
