"""Scale properties: shuffle counts of large-table plans and skew splitting."""

from __future__ import annotations

import re
from contextlib import contextmanager
from datetime import datetime

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from strata.operators.sessions import _prepare, idle_time, running_group_id
from tests.conftest import SF_SMALL
from tests.helpers import plan_text


@contextmanager
def large_table_planning(spark):
    """Plan as for tables too large to broadcast, without run-time changes."""
    keys = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled"]
    old = {k: spark.conf.get(k) for k in keys}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def _hash_exchanges(text: str) -> list[str]:
    return re.findall(r"Exchange hashpartitioning\(([^)]*)\)", text)


def test_charge_record_shuffles(spark):
    with large_table_planning(spark):
        text = plan_text(entry.queries()["charge_record"](spark, SF_SMALL), "simple")
    exchanges = _hash_exchanges(text)
    # stops aggregate, response and request sides, starts by transaction id,
    # readings by (transaction, piece), piece summaries: the records are not
    # shuffled again for the idle-time join.
    assert len(exchanges) == 6, exchanges


def test_topk_detail_reads_the_written_facts_once(spark):
    with large_table_planning(spark):
        text = plan_text(entry.queries()["topk_detail"](spark, SF_SMALL), "simple")
    # The partial count per country, and the sort-merge join that planning
    # without any broadcast has to take for the k keys.
    assert len(_hash_exchanges(text)) == 3 and "orders.parquet" not in text
    assert "TakeOrderedAndProject" in text and "LeftSemi" in text


def test_idle_time_shuffles_pieces_not_keys(spark):
    with large_table_planning(spark):
        text = plan_text(entry.queries()["idle_time"](spark, SF_SMALL), "simple")
    exchanges = [re.sub(r"#\d+L?", "", e) for e in _hash_exchanges(text)]
    assert any("user_id, _b" in e for e in exchanges)
    # Pieces, and one row per piece by key, after the range split of the readings.
    assert len(exchanges) == 2 and text.count("Exchange rangepartitioning") == 1
    assert "SortAggregate" not in text


@pytest.fixture(scope="module")
def skewed(spark):
    """Key 0 holds a third of all readings, all at the same instant."""
    base = datetime(2024, 1, 1)
    hot = spark.range(6000).select(
        F.lit(0).alias("k"), F.lit(base).cast("timestamp_ntz").alias("ts"), F.col("id").alias("tb"),
        (F.col("id") % 3 - 1).cast("double").alias("v"),
    )
    cold = spark.range(12000).select(
        (F.col("id") % 50 + 1).alias("k"),
        (F.lit(base).cast("timestamp_ntz") + F.make_interval(secs=F.col("id") * 37)).alias("ts"),
        F.col("id").alias("tb"),
        (F.col("id") % 5 - 2).cast("double").alias("v"),
    )
    return hot.unionByName(cold)


def test_row_split_breaks_up_a_hot_key(spark, skewed, shuffle_partitions):
    shuffle_partitions(16)
    time_pieces = _prepare(skewed, "k", ("ts", "tb"), "v", 0.0, 86400, "time").groupBy("k", "_b").count()
    row_pieces = _prepare(skewed, "k", ("ts", "tb"), "v", 0.0, 86400, "rows").groupBy("k", "_b").count()
    assert time_pieces.agg(F.max("count")).first()[0] == 6000  # one piece holds the whole hot key
    default = _prepare(skewed, "k", ("ts", "tb"), "v", 0.0, 86400, ranges=16).groupBy("k", "_b").count()
    assert default.agg(F.max("count")).first()[0] <= 2 * 18000 / 16
    largest = row_pieces.agg(F.max("count")).first()[0]
    assert largest <= 2 * 18000 / 16, largest
    assert row_pieces.filter("k = 0").count() >= 4


def test_hot_key_results_agree_across_splits(spark, skewed):
    args = dict(key="k", order=("ts", "tb"), value="v")
    a = idle_time(skewed, split="time", output="idle", **args)
    b = idle_time(skewed, split="rows", output="idle", **args)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    g1 = running_group_id(skewed, split="time", **args)
    g2 = running_group_id(skewed, split="rows", **args)
    assert g1.exceptAll(g2).count() == 0 and g2.exceptAll(g1).count() == 0
    hot = g2.filter("k = 0").agg(F.max("charging_group")).first()[0]
    assert hot > 1000  # value pattern -1, 0, 1 repeats: a new group every third reading


@pytest.mark.parametrize(
    "key", ["topk_detail", "idle_time", "interval_match", "charge_record", "group_bounds"]
)
def test_catalog_results_do_not_depend_on_partition_count(spark, shuffle_partitions, key):
    results = []
    for n in (1, 3, 17):
        shuffle_partitions(n)
        rows = entry.queries()[key](spark, SF_SMALL).collect()
        results.append(sorted(map(tuple, rows), key=repr))
    assert results[0] == results[1] == results[2]


@pytest.mark.parametrize("key", ["running_group_id", "group_bounds"])
def test_group_numbering_reads_the_written_pieces(spark, key):
    with large_table_planning(spark):
        text = plan_text(entry.queries()[key](spark, SF_SMALL), "simple")
    assert "events.parquet" not in text and "SortAggregate" not in text


def test_written_keys_are_broadcast_by_size(spark):
    from strata.operators.joins import match_dimension

    facts = spark.range(1000).selectExpr("cast(id % 50 as string) as country")
    cities = spark.range(20).selectExpr("cast(id as string) as Country")
    small = match_dimension(facts, cities, "country", "Country")
    with large_table_planning(spark):
        large = match_dimension(facts, cities, "country", "Country")
        assert "SortMergeJoin" in plan_text(large, "simple")
        rows = large.count()
    assert "BroadcastHashJoin" in plan_text(small) and small.count() == rows == 400


def test_scratch_has_an_owner_and_is_removed(spark):
    import os

    from strata.session import application_folder, release_scratch, scratch_scope, shared_root

    release_scratch(spark)
    root = os.path.join(shared_root(spark).removeprefix("file://").removeprefix("file:"), "strata")
    folder = application_folder(spark).removeprefix("file://").removeprefix("file:")
    # Nothing is written outside the application's own folder, which is empty.
    assert os.listdir(root) == [os.path.basename(folder)] and os.listdir(folder) == []
    with scratch_scope(spark):
        assert entry.queries()["topk_detail"](spark, SF_SMALL).count() > 0
        assert os.listdir(folder)
    assert os.listdir(folder) == []


def test_a_cluster_needs_a_shared_folder():
    from strata.session import shared_root

    class Context:
        master = "spark://host:7077"

        def getConf(self):
            return {}

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_root(Session())


def test_keys_beyond_32_bits(spark, tmp_path):
    import os
    import shutil

    folder = tmp_path / "wide"
    folder.mkdir()
    for name in os.listdir(SF_SMALL):
        if not name.startswith(("orders", "customer")):
            shutil.copy(os.path.join(SF_SMALL, name), folder / name)
    shift = 3_000_000_000
    for name, column in (("orders", "o_custkey"), ("customer", "c_custkey")):
        wide = spark.read.parquet(f"{SF_SMALL}/{name}.parquet").withColumn(column, F.col(column) + shift)
        wide.write.parquet(str(folder / f"{name}.parquet"))
    for key in ("unit_delta", "stop_start_match", "request_response_match", "charge_record"):
        rows = entry.queries()[key](spark, str(folder))
        assert rows.agg(F.max("meter_start")).first()[0] > shift
    assert entry.queries()["pipeline_layers"](spark, str(folder)).count() > 0
