"""Publishing, partition overwrite, quarantine and scratch folders."""

from __future__ import annotations

import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StringType, StructField, StructType

from strata.plans import layers
from strata.session import scratch_path
from strata.sources import files
from tests.conftest import ROOT

ABC = StructType([StructField("a", IntegerType()), StructField("b.x", StringType()), StructField("c", DoubleType())])


def _values(spark, path):
    return sorted(r.id for r in spark.read.parquet(path).collect())


def _siblings(path):
    folder = os.path.dirname(path).removeprefix("file://")
    return sorted(n for n in os.listdir(folder) if n.startswith(os.path.basename(path)))


@pytest.fixture
def dataset(spark):
    path = scratch_path(spark, "test-published") + "/set"
    files.publish_parquet(spark.range(5), path)
    return path


def test_a_job_that_fails_half_way_leaves_the_old_dataset(spark, dataset):
    failing = spark.range(0, 1000, 1, 8).select(F.when(F.col("id") == 777, F.raise_error(F.lit("broken row"))).otherwise(F.col("id")).cast("long").alias("id"))
    with pytest.raises(Exception, match="broken row"):
        files.publish_parquet(failing, dataset)
    assert _values(spark, dataset) == [0, 1, 2, 3, 4] and _siblings(dataset) == ["set"]
    with pytest.raises(ValueError, match="contract"):
        files.publish_parquet(spark.range(3), dataset, contract=ABC)
    assert _values(spark, dataset) == [0, 1, 2, 3, 4]
    files.publish_parquet(spark.range(2), dataset + "/")
    assert _values(spark, dataset) == [0, 1] and _siblings(dataset) == ["set"]


def test_a_dataset_may_be_replaced_from_itself(spark, dataset):
    files.publish_parquet(spark.read.parquet(dataset).filter("id > 1"), dataset)
    assert _values(spark, dataset) == [2, 3, 4]


def test_a_replacement_stopped_between_its_renames_is_put_back(spark, dataset):
    here = dataset.removeprefix("file://")
    os.rename(here, here + ".replaced-1")
    assert files.recover(spark, dataset) and not files.recover(spark, dataset)
    assert _values(spark, dataset) == [0, 1, 2, 3, 4]
    os.rename(here, here + ".replaced-2")
    files.publish_parquet(spark.range(1), dataset)
    assert _values(spark, dataset) == [0] and _siblings(dataset) == ["set"]


def test_only_partitions_with_rows_are_overwritten(spark):
    path = scratch_path(spark, "test-partitions") + "/set"
    rows = spark.range(9).withColumn("p", F.col("id") % 3)
    files.publish_parquet(rows, path, partition_by=["p"])
    files.overwrite_partitions(spark.sql("select 100L as id, 1L as p"), path, ["p"], contract=rows.schema)
    assert _values(spark, path) == [0, 2, 3, 5, 6, 8, 100]
    failing = spark.range(0, 100, 1, 4).select(F.when(F.col("id") == 77, F.raise_error(F.lit("broken row"))).otherwise(F.col("id")).cast("long").alias("id"), F.lit(2).cast("long").alias("p"))
    with pytest.raises(Exception, match="broken row"):
        files.overwrite_partitions(failing, path, ["p"])
    assert _values(spark, path) == [0, 2, 3, 5, 6, 8, 100]
    with pytest.raises(ValueError, match="contract"):
        files.overwrite_partitions(spark.range(1), path, ["p"], contract=rows.schema)


def _csv(tmp_path, *lines):
    folder = tmp_path / "csv"
    folder.mkdir()
    (folder / "part.csv").write_text("a,b.x,c\n" + "\n".join(lines) + "\n")
    return str(folder)


BAD = ["x,q,1.5", "7,q", "7,q,1.5,9", "1.0,q,no", '8,"say \\"hi\\", you",z']
GOOD = ["1,one,0.5", "2,,", ",,", '3,"a, b",2']


def test_quarantine_in_one_pass(spark, tmp_path):
    source = _csv(tmp_path, *GOOD, *BAD)
    base = scratch_path(spark, "test-quarantine")
    counts = files.ingest_csv(spark, source, ABC, f"{base}/ok", f"{base}/apart")
    assert counts == {"rows": 9, "rejects": 5}
    kept = files.read_ingested(spark, f"{base}/ok", ABC)
    assert sorted(tuple(r) for r in kept.filter("a is not null").collect()) == [(1, "one", 0.5), (2, None, None), (3, "a, b", 2.0)]
    assert kept.count() == 4 and kept.schema == ABC
    reasons = {r.line: r.reason for r in files.read_quarantine(spark, f"{base}/apart").collect()}
    assert reasons == {
        BAD[0]: "a is not int",
        BAD[1]: "number of fields",
        BAD[2]: "number of fields",
        BAD[3]: "a is not int, c is not double",
        BAD[4]: "c is not double",
    }


def test_too_many_rejects_leave_the_former_rows(spark, tmp_path):
    base = scratch_path(spark, "test-too-many")
    (tmp_path / "one").mkdir()
    (tmp_path / "two").mkdir()
    clean, bad = _csv(tmp_path / "one", *GOOD), _csv(tmp_path / "two", *BAD)
    assert files.ingest_csv(spark, clean, ABC, f"{base}/ok", f"{base}/apart", max_rejects=0)["rejects"] == 0
    assert files.read_quarantine(spark, f"{base}/apart").count() == 0
    with pytest.raises(ValueError, match="5 unparsable rows"):
        layers.bronze_job(spark, bad, ABC, f"{base}/ok", 4, f"{base}/apart", corrupt_column="unused")
    assert files.read_ingested(spark, f"{base}/ok", ABC).count() == 4
    assert files.read_quarantine(spark, f"{base}/apart").count() == 5
    assert files.ingest_csv(spark, bad, ABC, f"{base}/ok", f"{base}/apart")["rows"] == 5
    assert files.read_ingested(spark, f"{base}/ok", ABC).count() == 0


def test_layers_hold_contracts_and_keep_rejects_apart(spark, tmp_path):
    (tmp_path / "country").mkdir()
    (tmp_path / "country" / "p.csv").write_text("City,Latitude,Longitude,Country,Continent\nTokyo,35.7,139.7,Japan,Asia\nLima,south,-77,Peru,America\n")
    base = scratch_path(spark, "test-cli")
    argv = ["--base", base, "--country", str(tmp_path / "country"), "--check-header", "--quarantine"]
    out = layers.main([*argv, "--max-corrupt-rows", "1"])
    assert [r.reason for r in files.read_quarantine(spark, out["quarantine/country"]).collect()] == ["Latitude is not double"]
    assert spark.read.parquet(out["silver/country"]).select("City").collect()[0][0] == "Tokyo"
    with pytest.raises(ValueError, match="unparsable"):
        layers.main([*argv, "--max-corrupt-rows", "0"])
    with pytest.raises(ValueError, match="contract"):
        layers.silver_country_job(spark, out["bronze/country"], f"{base}/silver/country", contract=ABC)
    assert spark.read.parquet(out["silver/country"]).count() == 1


def test_scratch_goes_when_the_driver_ends(tmp_path):
    code = (
        "from strata.session import build_session, scratch_path\n"
        "from strata.sources import materialize\n"
        f"spark = build_session('local[1]', conf={{'spark.checkpoint.dir': 'file://{tmp_path}'}})\n"
        "print('rows', materialize(spark.range(3), 'left').count())\n"
        "spark.stop()\n"
    )
    done = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert "rows 3" in done.stdout
    for _ in range(50):
        left = [f for _, _, names in os.walk(tmp_path) for f in names if "part-" in f]
        if not left:
            break
        __import__("time").sleep(0.2)
    assert not left
