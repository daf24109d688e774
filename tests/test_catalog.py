"""Driver contract: every key against its DuckDB oracle, entry, plan checks."""

from __future__ import annotations

import re

import pytest

import __spark_entry__ as entry
from strata.plans.catalog import QUERIES
from strata.plans.oracle import ORACLE_SQL
from tools.oracle_check import compare_key, duckdb_connection
from tests.conftest import SF_SMALL
from tests.helpers import plan_text

# The library's own keys; those of the optional subpackage have tests of their own.
KEYS = sorted(QUERIES)


@pytest.fixture(scope="module")
def con():
    return duckdb_connection(SF_SMALL)


def test_every_key_has_an_oracle():
    assert set(ORACLE_SQL) == set(QUERIES) and set(QUERIES) <= set(entry.queries())
    assert set(ORACLE_SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("key", KEYS)
def test_key_matches_oracle(spark, con, key):
    out = compare_key(spark, con, key, SF_SMALL, entry.queries()[key], entry.oracle_sql()[key])
    assert out.ok, out.detail
    assert out.spark_rows > 0


def test_entry_runs_the_flagship(spark):
    df = entry.entry(spark)
    assert df.columns == ["Country", "Timestamp", "Deaths", "Missing", "Injuries", "HousesDestroyed", "HousesDamaged"]
    assert df.count() > 0


PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas", "PythonUDF")


@pytest.mark.parametrize("key", KEYS)
def test_plans_stay_in_the_jvm(spark, key):
    text = plan_text(entry.queries()[key](spark, SF_SMALL))
    assert not any(node in text for node in PYTHON_NODES)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_orders_scan_prunes_columns_and_pushes_the_range(spark):
    text = plan_text(entry.queries()["filter_year_range"](spark, SF_SMALL))
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThanOrEqual(o_orderdate,1996-01-01T00:00)" in text


@pytest.mark.parametrize(
    "key,pushed",
    [
        ("filter_equals", "EqualTo(o_orderstatus,F)"),
        ("filter_int_range", "GreaterThanOrEqual(l_linenumber,2), LessThanOrEqual(l_linenumber,4)"),
        ("filter_complete_rows", "IsNotNull(ts), IsNotNull(value), IsNotNull(props)"),
    ],
)
def test_filters_reach_the_scan(spark, key, pushed):
    text = plan_text(entry.queries()[key](spark, SF_SMALL))
    assert pushed in text.split("PushedFilters: ")[1].split("\n")[0] and "Exchange" not in text


def test_one_year_is_read_from_the_partitions(spark):
    text = plan_text(entry.queries()["silver_by_year"](spark, SF_SMALL))
    assert re.search(r"PartitionFilters: \[isnotnull\(year#\d+\), \(year#\d+ = 1997\)\]", text)


def test_two_bronze_shapes_scan_the_orders_once(spark):
    text = plan_text(entry.queries()["quake_tsunami_match"](spark, SF_SMALL))
    assert "orders.parquet" not in text and "customer.parquet" not in text


def test_topk_uses_take_ordered(spark):
    text = plan_text(entry.queries()["topk"](spark, SF_SMALL))
    assert "TakeOrderedAndProject" in text


def test_declared_table_schemas_match_the_files(spark):
    from strata.plans.driver_tables import TABLE_SCHEMAS, table

    for name in TABLE_SCHEMAS:
        inferred = spark.read.parquet(f"{SF_SMALL}/{name}.parquet").schema
        declared = table(spark, SF_SMALL, name).schema
        assert [(f.name, f.dataType) for f in inferred] == [(f.name, f.dataType) for f in declared], name


def test_output_contracts(spark):
    from strata.schemas import CHARGE_RECORD_SCHEMA, assert_contract

    assert_contract(entry.queries()["charge_record"](spark, SF_SMALL).schema, CHARGE_RECORD_SCHEMA)
    detail = entry.queries()["topk_detail"](spark, SF_SMALL)
    assert detail.columns == ["Country", "Timestamp", "Deaths", "Missing", "Injuries", "HousesDestroyed", "HousesDamaged"]
    impact = entry.queries()["dim_match_impact"](spark, SF_SMALL)
    assert impact.columns == [
        "Country", "TsunamiCauseCode", "Deaths", "Missing", "Injuries", "HousesDestroyed", "HousesDamaged", "Timestamp",
    ]
    quakes = entry.queries()["dim_match_numeric"](spark, SF_SMALL)
    assert quakes.columns == ["Country", "Title", "Magnitude", "Depth", "Tsunami", "Timestamp"]
