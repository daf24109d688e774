"""Sources and sinks: typed CSV (H1-H3), overwrite, manifest, incremental ingest."""

from __future__ import annotations

import os

import pytest
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from strata.session import scratch_path, shared_root
from strata.sources.files import (
    corrupt_counts,
    header_mismatches,
    output_manifest,
    read_csv_typed,
    read_parquet,
    write_parquet,
)
from strata.streaming.ingest import ingest_csv_incremental
from tests.conftest import SF_SMALL

AB = StructType([StructField("A", IntegerType(), True), StructField("B", StringType(), True)])

CSV_TEXT = "\n".join(
    [
        "B,A",
        "1,x",
        "2.0,y",
        "zz,z",
        "3",
        '"4","q ""in"" q, r"',
        '5,"e \\"in\\" e, r"',
    ]
)


def _write_text(path: str, name: str, text: str) -> str:
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w") as fh:
        fh.write(text + "\n")
    return path


def test_csv_declared_schema_maps_by_position(spark, tmp_path):
    path = _write_text(str(tmp_path / "ab"), "part-0.csv", CSV_TEXT)
    rows = read_csv_typed(spark, path, AB).collect()
    got = [(r.A, r.B) for r in rows]
    assert got == [
        (1, "x"),
        (None, "y"),  # 2.0 is not an int: null, silently
        (None, "z"),
        (3, None),
        (4, '"q ""in"" q'),  # doubled quotes with escape "\": cut at the comma
        (5, 'e "in" e, r'),
    ]


def test_csv_corrupt_column_and_counts(spark, tmp_path):
    path = _write_text(str(tmp_path / "ab2"), "part-0.csv", CSV_TEXT)
    df = read_csv_typed(spark, path, AB, corrupt_column="_corrupt")
    # Selecting B alone still parses A, whose values are bad.
    corrupt = {r.B for r in df.select("B", "_corrupt").filter("_corrupt is not null").collect()}
    assert {"y", "z"} <= corrupt
    counts = corrupt_counts(df, "_corrupt").first()
    assert counts.rows == 6 and counts.corrupt_rows >= 2


def test_header_check_during_the_scan(spark, tmp_path):
    good = _write_text(str(tmp_path / "good"), "part-0.csv", "A,B\n7,w\nx,v")
    read = read_csv_typed(spark, good, AB, check_header=True, corrupt_column="_corrupt")
    assert corrupt_counts(read, "_corrupt").first().corrupt_rows == 1
    bad = _write_text(str(tmp_path / "bad"), "part-0.csv", CSV_TEXT)
    with pytest.raises(Exception, match="header"):
        read_csv_typed(spark, bad, AB, check_header=True).collect()


def test_bronze_job_limits_corrupt_rows(spark, tmp_path):
    from strata.plans.layers import bronze_job

    path = _write_text(str(tmp_path / "ab5"), "part-0.csv", "A,B\n1,x\nq,y")
    out = scratch_path(spark, "test-bronze-corrupt")
    wide = dict(corrupt_column="_corrupt", check_header=True)
    assert bronze_job(spark, path, AB, out, max_corrupt_rows=1, **wide) == out
    with pytest.raises(ValueError, match="unparsable"):
        bronze_job(spark, path, AB, out, max_corrupt_rows=0, **wide)


def test_csv_escape_is_a_parameter(spark, tmp_path):
    path = _write_text(str(tmp_path / "ab3"), "part-0.csv", 'A,B\n4,"q ""in"" q, r"')
    row = read_csv_typed(spark, path, AB, escape='"').first()
    assert (row.A, row.B) == (4, 'q "in" q, r')


def test_header_check_finds_reordered_columns(spark, tmp_path):
    path = _write_text(str(tmp_path / "ab4"), "part-0.csv", CSV_TEXT)
    _write_text(path, "part-1.csv", "A,B\n7,w")
    bad = header_mismatches(spark, path, AB).collect()
    assert len(bad) == 1 and bad[0].header == "B,A" and bad[0].file_path.endswith("part-0.csv")


def test_csv_round_trip_of_a_driver_table(spark):
    orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    path = scratch_path(spark, "test-orders-csv")
    orders.write.option("header", True).csv(path)
    back = read_csv_typed(spark, path, orders.schema)
    assert back.exceptAll(orders).count() == 0 and orders.exceptAll(back).count() == 0


def test_overwrite_twice_equals_once(spark):
    nation = spark.read.parquet(f"{SF_SMALL}/nation.parquet")
    path = scratch_path(spark, "test-overwrite")
    write_parquet(nation, path)
    write_parquet(nation, path)
    back = read_parquet(spark, path)
    assert back.count() == 25 and back.exceptAll(nation).count() == 0


def test_output_manifest_counts_rows_per_file(spark):
    orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    path = write_parquet(orders.repartition(3), scratch_path(spark, "test-manifest"))
    files = output_manifest(spark, path).collect()
    assert len(files) == 3
    assert sum(f.rows for f in files) == orders.count()
    assert all(f.file_name.endswith(".parquet") and f.file_size > 0 for f in files)


def test_output_manifest_keeps_equal_and_empty_files(spark):
    df = spark.createDataFrame([("a b", 1), ("a b", 2), ("c", 1), ("c", 2)], "p string, v int")
    path = write_parquet(df.coalesce(1), scratch_path(spark, "test-manifest-parts"), partition_by=["p"])
    files = output_manifest(spark, path).collect()
    assert sorted(f.rows for f in files) == [2, 2] and len({f.file_path for f in files}) == 2
    empty = write_parquet(df.limit(0), scratch_path(spark, "test-manifest-empty"))
    assert [f.rows for f in output_manifest(spark, empty).collect()] == [0]


def test_partitioned_write_prunes(spark):
    orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    path = write_parquet(orders, scratch_path(spark, "test-partitioned"), partition_by=["o_orderstatus"])
    df = read_parquet(spark, path).filter("o_orderstatus = 'F'")
    from tests.helpers import plan_text

    assert "PartitionFilters: [isnotnull(o_orderstatus" in plan_text(df)
    assert df.count() == orders.filter("o_orderstatus = 'F'").count()


def test_scratch_paths_live_in_the_shared_folder(spark):
    root = shared_root(spark)
    assert scratch_path(spark, "x").startswith(root)
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def test_incremental_ingest_picks_up_only_new_files(spark):
    source = scratch_path(spark, "test-landing")
    target = scratch_path(spark, "test-bronze")
    checkpoint = scratch_path(spark, "test-bronze-ckpt")
    local = source.replace("file:", "")
    _write_text(local, "a.csv", "A,B\n1,x\n2,y")
    ingest_csv_incremental(spark, source, AB, target, checkpoint)
    assert read_parquet(spark, target).count() == 2
    _write_text(local, "b.csv", "A,B\n3,z")
    ingest_csv_incremental(spark, source, AB, target, checkpoint)
    got = sorted((r.A, r.B) for r in read_parquet(spark, target).collect())
    assert got == [(1, "x"), (2, "y"), (3, "z")]


def test_silver_layer_as_a_stream_equals_the_batch(spark):
    from strata.plans import disaster as d
    from strata.plans import driver_tables as t
    from strata.streaming.layers import stream_layer

    bronze = t.bronze_tsunamis(spark, SF_SMALL)
    landing = scratch_path(spark, "test-stream-bronze")
    bronze.repartition(3).write.parquet(landing)
    target = scratch_path(spark, "test-stream-silver")
    checkpoint = scratch_path(spark, "test-stream-silver-ckpt")
    schema = read_parquet(spark, landing).schema
    stream_layer(spark, landing, schema, lambda df: d.silver_tsunami(df, 1996, 1999), target, checkpoint)
    streamed = read_parquet(spark, target)
    batch = d.silver_tsunami(read_parquet(spark, landing), 1996, 1999)
    assert streamed.count() == batch.count() > 0
    assert streamed.exceptAll(batch).count() == 0 and batch.exceptAll(streamed).count() == 0
    # a second run finds no new files and adds nothing
    stream_layer(spark, landing, schema, lambda df: d.silver_tsunami(df, 1996, 1999), target, checkpoint)
    assert read_parquet(spark, target).count() == batch.count()
