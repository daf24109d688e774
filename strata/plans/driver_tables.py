"""Bronze-shaped inputs derived from the driver's star-schema tables.

The reference works on three CSV datasets (cities, earthquakes, tsunamis) and
four charge-point message streams. The driver provides TPC-H-like tables
instead; the functions here derive frames of the same shape from them with
plain projections and joins, so every query's work grows with the tables.

Mapping (each rule is a column expression, also written out as DuckDB SQL in
``strata.plans.catalog``):

cities       one row per nation: City = nation name, Country = its display
             name ("NATION_3" -> "Nation 3"), Continent = display name of the
             region ("ASIA" -> "Asia")
earthquakes  one row per order, located by its customer's nation; the date is
             text "dd-MM-yyyy HH:mm" (orders of priority 5-LOW carry an
             unpadded date, which does not parse); some locations and original
             countries are null
tsunamis     one row per order with date parts, upper-case country spelled
             with "Nan" for the space ("NATIONNan3") and impact counts
start / stop charge messages: orders are start requests, line 1 of an order
             the start response, the lines of an order its stop request
             (last ship date, quantity-based meter) and its meter readings
supplier_cities  per-city dimension: one row per supplier, in its nation
event_readings   events as readings of one user ordered by (ts, event_id)
places       placed earthquakes stand at a spot of their customer, placed tsunamis
             up to some 60 km from their customer's, beyond 180 degrees east or
             west too
order_documents  one JSON text per order with its lines as an array of objects;
             notes and discounts are left out of some, some texts are cut short
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.sources.files import materialize

# Declared schemas of the driver tables: a declared schema spares the footer
# read of schema inference on every scan (as the bronze CSVs, these inputs
# have a fixed contract).
TABLE_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    ddl = TABLE_SCHEMAS.get(name)
    return spark.read.schema(ddl).parquet(path) if ddl else spark.read.parquet(path)


def display_name(c: Column | str) -> Column:
    """'NATION_3' -> 'Nation 3', 'MIDDLE EAST' -> 'Middle East'."""
    col = F.col(c) if isinstance(c, str) else c
    return F.initcap(F.lower(F.regexp_replace(col, "_", " ")))


def _nations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nation with its region.

    Both are raw Parquet tables, joined without a hint: the planner broadcasts
    a side whose file statistics are below ``autoBroadcastJoinThreshold`` and
    falls back to a shuffle join beyond it, so no counting job is needed.
    """
    region = table(spark, sf_dir, "region")
    return table(spark, sf_dir, "nation").join(region, F.col("n_regionkey") == F.col("r_regionkey"), "inner")


def _located_orders(spark: SparkSession, sf_dir: str, columns: list[str]) -> DataFrame:
    """Orders with the customer's segment and nation/region. Orders x customer
    is the one large join (shuffled on the customer key; AQE splits a skewed
    customer); nation/region are joined to the customers first."""
    nations = _nations(spark, sf_dir).select("n_nationkey", "n_name", "r_name")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    located = customer.join(nations, F.col("c_nationkey") == F.col("n_nationkey"), "inner")
    orders = table(spark, sf_dir, "orders").select(*columns)
    return orders.join(located, F.col("o_custkey") == F.col("c_custkey"), "inner")


def bronze_cities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _nations(spark, sf_dir).select(
        F.col("n_name").alias("City"),
        F.col("n_nationkey").cast("double").alias("Latitude"),
        F.col("n_regionkey").cast("double").alias("Longitude"),
        display_name("n_name").alias("Country"),
        display_name("r_name").alias("Continent"),
    )


_ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


def located_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The projection that both bronze shapes are made of, for a query that
    needs the two: written once, orders x customer is joined once."""
    return materialize(_located_orders(spark, sf_dir, _ORDER_COLUMNS), "located-orders")


def _latitude() -> Column:
    return (F.col("o_custkey") * 37 % 14000) / F.lit(100.0) - F.lit(70.0)


def _longitude() -> Column:
    return (F.col("o_custkey") * 91 % 36000) / F.lit(100.0) - F.lit(180.0)


def bronze_earthquakes(
    spark: SparkSession, sf_dir: str, located: DataFrame | None = None, placed: bool = False
) -> DataFrame:
    place = [_latitude().alias("latitude"), _longitude().alias("longitude")] if placed else []
    o = located if located is not None else _located_orders(spark, sf_dir, _ORDER_COLUMNS)
    unpadded = F.col("o_orderpriority") == F.lit("5-LOW")
    return o.select(
        F.concat(F.lit("order "), F.col("o_orderkey").cast("string")).alias("title"),
        (F.col("o_totalprice") / F.lit(100000)).alias("magnitude"),
        F.when(unpadded, F.date_format("o_orderdate", "d-M-yyyy H:m"))
        .otherwise(F.date_format("o_orderdate", "dd-MM-yyyy HH:mm"))
        .alias("date_time"),
        F.when(F.col("o_orderstatus") == F.lit("F"), F.lit(1)).otherwise(F.lit(0)).alias("tsunami"),
        F.floor(F.col("o_totalprice") / F.lit(1000)).cast("int").alias("sig"),
        (F.col("o_custkey") % 700).cast("string").alias("depth"),
        F.when((F.col("c_mktsegment") == F.lit("BUILDING")) & (F.col("o_orderstatus") == F.lit("P")), F.lit(None))
        .otherwise(F.concat(F.col("c_mktsegment"), F.lit(", "), display_name("n_name")))
        .alias("location"),
        display_name("r_name").alias("continent"),
        F.when(F.col("o_orderpriority") == F.lit("4-NOT SPECIFIED"), F.lit(None))
        .otherwise(F.col("n_name"))
        .alias("country"),
        *place,
    )


def bronze_tsunamis(
    spark: SparkSession, sf_dir: str, located: DataFrame | None = None, placed: bool = False
) -> DataFrame:
    place = [
        (_latitude() + (F.col("o_orderkey") % 11 - 5) / F.lit(10.0)).alias("Latitude"),
        (_longitude() + (F.col("o_orderkey") % 7 - 3) / F.lit(5.0)).alias("Longitude"),
    ]
    o = located if located is not None else _located_orders(spark, sf_dir, _ORDER_COLUMNS[:-1])
    return o.select(
        F.col("o_orderkey").alias("Sr.no"),
        F.year("o_orderdate").alias("Year"),
        F.month("o_orderdate").alias("Mo"),
        F.dayofmonth("o_orderdate").alias("Dy"),
        F.when(F.col("o_orderstatus") == F.lit("O"), F.lit(None)).otherwise((F.col("o_custkey") % 24).cast("int")).alias("Hr"),
        F.when(F.col("o_orderstatus") == F.lit("P"), F.lit(None)).otherwise((F.col("o_orderkey") % 60).cast("int")).alias("Mn"),
        F.lit(None).cast("double").alias("Sec"),
        (F.col("o_custkey") % 12).cast("int").alias("TsunamiNanCauseNanCode"),
        F.regexp_replace("n_name", "_", "Nan").alias("Country"),
        F.floor(F.col("o_totalprice") / F.lit(10000)).cast("int").alias("Deaths"),
        F.when(F.col("o_orderstatus") == F.lit("F"), F.lit(None)).otherwise((F.col("o_custkey") % 7).cast("int")).alias("Missing"),
        (F.col("o_orderkey") % 13).cast("int").alias("Injuries"),
        F.floor(F.col("o_totalprice") / F.lit(50000)).cast("int").alias("HousesNanDestroyed"),
        (F.col("o_custkey") % 100).cast("int").alias("HousesNanDamaged"),
        *(place if placed else []),
    )


def order_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``l_orderkey, doc``: an order and its lines as JSON text."""
    line = F.struct(
        F.col("l_linenumber").alias("no"),
        F.col("l_quantity").alias("quantity"),
        # A field that some lines lack: nulls aren't written.
        F.when(F.col("l_discount") > 0.02, F.col("l_discount")).alias("discount"),
        F.array("l_partkey", "l_suppkey").alias("ids"),
        F.struct(F.col("l_returnflag").alias("flag"), F.col("l_linestatus").alias("status")).alias("state"),
    )
    key = F.col("l_orderkey")
    orders = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.sort_array(F.collect_list(line)).alias("lines"))
    note = F.when(key % 3 == 0, F.concat(F.lit("no. "), key.cast("string")))
    text = F.to_json(F.struct(key.alias("order"), note.alias("note"), F.col("lines")))
    # Some texts were cut short on their way.
    return orders.select("l_orderkey", F.when(key % 17 == 0, F.left(text, F.length(text) - 2)).otherwise(text).alias("doc"))


def supplier_cities(spark: SparkSession, sf_dir: str) -> DataFrame:
    nations = _nations(spark, sf_dir).select("n_nationkey", "n_name", "r_name")
    return (
        table(spark, sf_dir, "supplier")
        .join(nations, F.col("s_nationkey") == F.col("n_nationkey"), "inner")
        .select(
            F.col("s_name").alias("City"),
            F.col("s_acctbal").alias("Latitude"),
            F.col("s_suppkey").cast("double").alias("Longitude"),
            display_name("n_name").alias("Country"),
            display_name("r_name").alias("Continent"),
        )
    )


def start_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("message_id"),
        F.col("o_custkey").alias("meter_start"),
        F.col("o_orderdate").alias("timestamp"),
    )


def start_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "lineitem")
        .filter(F.col("l_linenumber") == F.lit(1))
        .select(
            F.col("l_orderkey").alias("message_id"),
            F.concat(F.lit("CP-"), F.col("l_suppkey").cast("string")).alias("charge_point_id"),
            F.col("l_orderkey").alias("transaction_id"),
        )
    )


def stop_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_orderkey").alias("transaction_id"))
        .agg(
            (F.sum("l_quantity") * F.lit(250)).cast("long").alias("meter_stop"),
            F.max("l_shipdate").alias("timestamp"),
        )
    )


METER_ORDER = ("timestamp", "l_linenumber", "l_partkey", "l_suppkey")


def meter_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("transaction_id"),
        F.col("l_shipdate").alias("timestamp"),
        (F.col("l_quantity") - F.lit(25)).alias("value"),
        F.when(F.col("l_returnflag") == F.lit("R"), F.lit("Energy.Active.Import.Register"))
        .otherwise(F.lit("Power.Active.Import"))
        .alias("measurand"),
        F.when((F.col("l_returnflag") == F.lit("A")) & (F.col("l_linestatus") == F.lit("F")), F.lit("L1"))
        .otherwise(F.lit(None).cast("string"))
        .alias("phase"),
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
    )


EVENT_ORDER = ("ts", "event_id")
EVENT_THRESHOLD = 20.0


def event_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("user_id", "ts", "event_id", "value")
