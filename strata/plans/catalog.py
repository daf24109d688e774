"""Query catalog on the driver tables: Spark plans and DuckDB oracle SQL.

Every key maps to ``(spark, sf_dir) -> DataFrame``. The oracle SQL computes
the same rows independently, in the reference's own formulation (for example
per-transaction windows for idle time, where the Spark plan uses bucketed
pieces), over the pre-registered views of the same Parquet tables.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from strata.operators.filters import (
    filter_complete_rows,
    filter_equals,
    filter_int_range,
    filter_year_range,
)
from strata.operators.charge import match_start_messages, with_total_energy, with_total_time
from strata.operators.joins import match_all_cities
from strata.operators.nearby import near_followers
from strata.operators.nested import json_flatten
from strata.operators.ranking import trend_break
from strata.operators.relate import event_correlation, followed_within
from strata.operators.running import asof_join
from strata.operators.sessions import charging_boundaries, group_bounds, idle_time, running_group_id
from strata.operators.shaping import (
    capitalize_country,
    distinct_keys,
    make_country,
    make_timestamp,
    make_timestamp_from_parts,
)
from strata.operators.variant import json_unpack
from strata.plans import charge as charge_plans
from strata.plans import disaster as d
from strata.plans import driver_tables as t
from strata.plans import layers
from strata.schemas import CHARGE_RECORD_SCHEMA, COUNTRY_SCHEMA, EARTHQUAKE_SCHEMA, TSUNAMI_SCHEMA
from strata.session import scratch_path
from strata.sources.files import (
    corrupt_counts,
    ingest_csv,
    materialize,
    output_manifest,
    overwrite_partitions,
    publish_parquet,
    read_csv_typed,
    read_ingested,
    read_parquet,
    read_quarantine,
    write_parquet,
)
from strata.sources.layout import read_clustered, read_generations, write_clustered
from strata.streaming.idle_state import add_readings, idle_from_state
from strata.streaming.ingest import ingest_csv_incremental

Query = Callable[[SparkSession, str], DataFrame]

# Parameters of the driver-table mapping.
YEARS = (1996, 1999)
TOP_K = 3
INTERVAL_SECONDS = 24 * 3600
BUCKETS, CLUSTER_FILES = 8, 16
NEAR_KM, NEAR_SECONDS = 100.0, 48 * 3600


# ---- shared building blocks -----------------------------------------------------------


def _silver_earthquakes(spark: SparkSession, sf: str, located: DataFrame | None = None) -> DataFrame:
    return d.silver_earthquake(t.bronze_earthquakes(spark, sf, located), d.CONTINENT, *YEARS)


def _asia(spark: SparkSession, sf: str) -> DataFrame:
    return d.countries_of(d.silver_country(t.bronze_cities(spark, sf)))


def _tsunamis_in_asia(spark: SparkSession, sf: str, located: DataFrame | None = None) -> DataFrame:
    silver = d.silver_tsunami(t.bronze_tsunamis(spark, sf, located), *YEARS)
    return d.tsunamis_in(d.gold_tsunami(silver), _asia(spark, sf))


def _matched_transactions(spark: SparkSession, sf: str) -> DataFrame:
    return charge_plans.matched_transactions(
        t.start_requests(spark, sf), t.start_responses(spark, sf), t.stop_requests(spark, sf)
    )


def _charge_records(spark: SparkSession, sf: str) -> DataFrame:
    return charge_plans.charge_records(
        t.start_requests(spark, sf),
        t.start_responses(spark, sf),
        t.stop_requests(spark, sf),
        t.meter_values(spark, sf),
        order=t.METER_ORDER,
    )


def _events_args() -> dict:
    return {"key": "user_id", "order": t.EVENT_ORDER, "value": "value", "threshold": t.EVENT_THRESHOLD}


# ---- sources and sinks ----------------------------------------------------------------


def q_csv_typed_ingest(spark: SparkSession, sf: str) -> DataFrame:
    orders = t.table(spark, sf, "orders")
    path = scratch_path(spark, "orders-csv")
    orders.write.mode("overwrite").option("header", True).option("escape", "\\").csv(path)
    return read_csv_typed(spark, path, orders.schema)


def q_csv_incremental_ingest(spark: SparkSession, sf: str) -> DataFrame:
    orders = t.table(spark, sf, "orders")
    source = scratch_path(spark, "orders-csv-landing")
    orders.write.mode("overwrite").option("header", True).option("escape", "\\").csv(source)
    target = scratch_path(spark, "orders-bronze")
    ingest_csv_incremental(spark, source, orders.schema, target, scratch_path(spark, "orders-bronze-checkpoint"))
    return read_parquet(spark, target)


def q_parquet_scan(spark: SparkSession, sf: str) -> DataFrame:
    return read_parquet(spark, f"{sf.rstrip('/')}/orders.parquet")


def q_parquet_overwrite(spark: SparkSession, sf: str) -> DataFrame:
    orders = t.table(spark, sf, "orders")
    path = scratch_path(spark, "orders-overwrite")
    write_parquet(orders, path)
    write_parquet(orders, path)
    return read_parquet(spark, path)


def q_csv_corrupt_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as CSV in which every seventh key's price isn't a number."""
    bad = F.when(F.col("o_orderkey") % 7 == 0, F.lit("n/a")).otherwise(F.col("o_totalprice").cast("string"))
    path = scratch_path(spark, "orders-corrupt-csv")
    orders = t.table(spark, sf, "orders")
    orders.withColumn("o_totalprice", bad).write.option("header", True).option("escape", "\\").csv(path)
    read = read_csv_typed(spark, path, orders.schema, corrupt_column="_corrupt", check_header=True)
    return corrupt_counts(read, "_corrupt")


def q_csv_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as CSV with prices that are no numbers and lines cut short: the rows
    that parse, and the others with their reason, from one pass."""
    orders = t.table(spark, sf, "orders")
    key = F.col("o_orderkey")
    bad = F.when(key % 7 == 0, F.lit("n/a")).otherwise(F.col("o_totalprice").cast("string"))
    line = F.to_csv(F.struct(*orders.withColumn("o_totalprice", bad).columns), {"escape": "\\"})
    lines = orders.withColumn("o_totalprice", bad).select(
        F.when(key % 11 == 0, F.substring_index(line, ",", len(orders.columns) - 1)).otherwise(line).alias("value")
    )
    source = scratch_path(spark, "orders-quarantine-csv")
    lines.write.text(source)
    target, apart = scratch_path(spark, "orders-ingested"), scratch_path(spark, "orders-quarantine")
    ingest_csv(spark, source, orders.schema, target, apart, header=False)
    kept = read_ingested(spark, target, orders.schema).select("o_orderkey", "o_totalprice", F.lit(None).cast("string").alias("reason"))
    rejected = read_quarantine(spark, apart).select(
        F.substring_index("line", ",", 1).cast("long").alias("o_orderkey"), F.lit(None).cast("double").alias("o_totalprice"), "reason"
    )
    return kept.unionByName(rejected)


def q_parquet_partition_overwrite(spark: SparkSession, sf: str) -> DataFrame:
    """Orders by status, published, then the finished ones written anew at half price."""
    orders = t.table(spark, sf, "orders")
    path = scratch_path(spark, "orders-by-status")
    publish_parquet(orders, path, contract=orders.schema, partition_by=["o_orderstatus"])
    cheaper = orders.filter("o_orderstatus = 'F'").withColumn("o_totalprice", F.col("o_totalprice") / 2)
    overwrite_partitions(cheaper, path, ["o_orderstatus"], contract=orders.schema)
    return read_parquet(spark, path).select(*orders.columns)


def q_clustered_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Orders along the Z-order over customer and date: one range of both, from
    the files that may hold it."""
    orders = t.table(spark, sf, "orders")
    path = scratch_path(spark, "orders-clustered")
    write_clustered(orders, path, ["o_custkey", "o_orderdate"], CLUSTER_FILES, bloom=["o_orderkey"])
    dates = (datetime(YEARS[0], 1, 1), datetime(YEARS[0], 12, 31))
    return read_clustered(spark, path, {"o_custkey": (100, 400), "o_orderdate": dates}, orders.schema)


def q_evolving_layouts(spark: SparkSession, sf: str) -> DataFrame:
    """Orders of three generations as one: in the first, dates without a time and
    no priority; in the second, narrow numbers; in the third, a field more."""
    orders = t.table(spark, sf, "orders")
    year = F.year("o_orderdate")
    old = orders.filter(year < YEARS[0]).withColumn("o_orderdate", F.col("o_orderdate").cast("date")).drop("o_orderpriority")
    middle = orders.filter(year.between(*YEARS)).withColumn("o_custkey", F.col("o_custkey").cast("int"))
    new = orders.filter(year > YEARS[1]).withColumn("o_clerk", F.lit("c"))
    paths = [publish_parquet(part, scratch_path(spark, "orders-generation")) for part in (old, middle, new)]
    return read_generations(spark, paths, orders.schema, added=True)


def q_output_manifest(spark: SparkSession, sf: str) -> DataFrame:
    """One row per written file: orders, one file per status."""
    orders = t.table(spark, sf, "orders").repartition("o_orderstatus")
    path = write_parquet(orders, scratch_path(spark, "orders-manifest"), partition_by=["o_orderstatus"])
    status = F.regexp_extract("file_path", "o_orderstatus=([^/]*)/", 1).alias("o_orderstatus")
    return output_manifest(spark, path).select(status, "rows")


# ---- filters and scalar steps ------------------------------------------------------------


def q_filter_equals(spark: SparkSession, sf: str) -> DataFrame:
    return filter_equals(t.table(spark, sf, "orders"), "o_orderstatus", "F")


def q_filter_year_range(spark: SparkSession, sf: str) -> DataFrame:
    return filter_year_range(t.table(spark, sf, "orders"), "o_orderdate", *YEARS)


def q_filter_int_range(spark: SparkSession, sf: str) -> DataFrame:
    return filter_int_range(t.table(spark, sf, "lineitem"), "l_linenumber", 2, 4)


def q_filter_complete_rows(spark: SparkSession, sf: str) -> DataFrame:
    return filter_complete_rows(t.table(spark, sf, "events"), ["ts", "value", "props"])


def q_distinct_keys(spark: SparkSession, sf: str) -> DataFrame:
    normalised = capitalize_country(t.bronze_tsunamis(spark, sf), "Country")
    return distinct_keys(normalised, ["Country"])


def q_parse_timestamp(spark: SparkSession, sf: str) -> DataFrame:
    return make_timestamp(t.bronze_earthquakes(spark, sf)).select("title", "time_stamp")


def q_timestamp_from_parts(spark: SparkSession, sf: str) -> DataFrame:
    return make_timestamp_from_parts(t.bronze_tsunamis(spark, sf)).select("`Sr.no`", "time_stamp")


def q_last_token(spark: SparkSession, sf: str) -> DataFrame:
    return make_country(t.bronze_earthquakes(spark, sf)).select("title", "location", "country")


def q_normalize_name(spark: SparkSession, sf: str) -> DataFrame:
    return capitalize_country(t.bronze_tsunamis(spark, sf), "Country").select("`Sr.no`", "Country")


# ---- dimension matches, ranking ----------------------------------------------------------


def q_dim_match_numeric(spark: SparkSession, sf: str) -> DataFrame:
    return d.earthquakes_in(_silver_earthquakes(spark, sf), _asia(spark, sf))


def q_dim_match_impact(spark: SparkSession, sf: str) -> DataFrame:
    return _tsunamis_in_asia(spark, sf)


def q_dim_match_fanout(spark: SparkSession, sf: str) -> DataFrame:
    facts = _silver_earthquakes(spark, sf).select("title", "country")
    return match_all_cities(facts, t.supplier_cities(spark, sf), "country", "Country", "City")


def q_group_count_ranked(spark: SparkSession, sf: str) -> DataFrame:
    return d.hits_ranked(_tsunamis_in_asia(spark, sf))


def q_topk(spark: SparkSession, sf: str) -> DataFrame:
    return d.top_countries(_tsunamis_in_asia(spark, sf), TOP_K)


def q_topk_detail(spark: SparkSession, sf: str) -> DataFrame:
    return d.top_detail(_tsunamis_in_asia(spark, sf), TOP_K, reuse=True)


def q_topk_by_measure(spark: SparkSession, sf: str) -> DataFrame:
    return d.top_by_impact(_tsunamis_in_asia(spark, sf), TOP_K)


def q_topk_trend(spark: SparkSession, sf: str) -> DataFrame:
    return d.top_trend(_tsunamis_in_asia(spark, sf), TOP_K, reuse=True)


def q_trend_break(spark: SparkSession, sf: str) -> DataFrame:
    """Per country: the year in which its yearly number of tsunamis changes level."""
    return trend_break(_tsunamis_in_asia(spark, sf), "Country", "Timestamp")


# ---- charge records ---------------------------------------------------------------------


def q_request_response_match(spark: SparkSession, sf: str) -> DataFrame:
    return match_start_messages(t.start_responses(spark, sf), t.start_requests(spark, sf))


def q_stop_start_match(spark: SparkSession, sf: str) -> DataFrame:
    return _matched_transactions(spark, sf)


def q_duration_hours(spark: SparkSession, sf: str) -> DataFrame:
    return with_total_time(_matched_transactions(spark, sf)).select(
        "charge_point_id", "transaction_id", "start_timestamp", "stop_timestamp", "total_time"
    )


def q_unit_delta(spark: SparkSession, sf: str) -> DataFrame:
    return with_total_energy(_matched_transactions(spark, sf)).select(
        "charge_point_id", "transaction_id", "meter_start", "meter_stop", "total_energy"
    )


def q_parking_time(spark: SparkSession, sf: str) -> DataFrame:
    return charge_plans.parking_time(t.meter_values(spark, sf), order=t.METER_ORDER)


def q_charge_record_colocated(spark: SparkSession, sf: str) -> DataFrame:
    """Charge records from tables bucketed by transaction, joined where they lie."""
    tables = charge_plans.colocate_messages(
        spark,
        scratch_path(spark, "colocated"),
        f"colocated_{uuid.uuid4().hex}",
        BUCKETS,
        t.start_requests(spark, sf),
        t.start_responses(spark, sf),
        t.stop_requests(spark, sf),
        charge_plans.parking_time(t.meter_values(spark, sf), order=t.METER_ORDER),
    )
    return charge_plans.colocated_charge_records(tables)


def q_charge_record(spark: SparkSession, sf: str) -> DataFrame:
    return _charge_records(spark, sf)


# ---- sessionization on events -------------------------------------------------------------


def q_lag_change_flag(spark: SparkSession, sf: str) -> DataFrame:
    return charging_boundaries(t.event_readings(spark, sf), **_events_args())


def q_running_group_id(spark: SparkSession, sf: str) -> DataFrame:
    return running_group_id(t.event_readings(spark, sf), **_events_args())


def q_group_bounds(spark: SparkSession, sf: str) -> DataFrame:
    return group_bounds(t.event_readings(spark, sf), **_events_args())


def q_idle_time(spark: SparkSession, sf: str) -> DataFrame:
    return idle_time(t.event_readings(spark, sf), output="idle_hours", **_events_args())


def q_idle_time_incremental(spark: SparkSession, sf: str) -> DataFrame:
    """Idle time from a state to which the events came in three batches: the
    later half of the time, the earlier half, and what came late to either."""
    readings = t.event_readings(spark, sf)
    middle = readings.agg(F.expr("percentile_approx(unix_micros(cast(ts as timestamp)), 0.5)")).first()[0]
    late = F.col("event_id") % 9 == 0
    later = F.coalesce(F.unix_micros(F.col("ts").cast("timestamp")) > F.lit(middle), F.lit(False))
    base = scratch_path(spark, "idle-state")
    for name, part in (("later", ~late & later), ("earlier", ~late & ~later), ("late", late)):
        add_readings(readings.filter(part), base, name, **_events_args())
    return idle_from_state(spark, base, "user_id", "idle_hours")


# ---- pipelines ---------------------------------------------------------------------------


def q_pipeline_dimension(spark: SparkSession, sf: str) -> DataFrame:
    """Q1 on the per-city dimension (one row per supplier, so it grows with the data)."""
    return materialize(d.silver_country(t.supplier_cities(spark, sf)), "silver-country")


def q_pipeline_facts_text_time(spark: SparkSession, sf: str) -> DataFrame:
    return materialize(_silver_earthquakes(spark, sf), "silver-earthquake")


def q_pipeline_facts_part_time(spark: SparkSession, sf: str) -> DataFrame:
    silver = d.silver_tsunami(t.bronze_tsunamis(spark, sf), *YEARS)
    return materialize(silver, "silver-tsunami")


def q_pipeline_topk_impact(spark: SparkSession, sf: str) -> DataFrame:
    return d.pipeline_topk_impact(
        t.bronze_tsunamis(spark, sf), t.bronze_cities(spark, sf), TOP_K, d.CONTINENT, *YEARS
    )


# Order keys take the place of the tsunamis' serial number, which is wider here.
WIDE_TSUNAMI_SCHEMA = StructType(
    [StructField(f.name, LongType(), True) if f.name == "Sr.no" else f for f in TSUNAMI_SCHEMA.fields]
)


def q_pipeline_layers(spark: SparkSession, sf: str) -> DataFrame:
    """Bronze CSV in the declared full-width layouts -> bronze -> silver -> gold
    jobs; the rows of both gold datasets."""
    landing = layers.Layout(scratch_path(spark, "landing"))
    located = t.located_orders(spark, sf)
    frames = {
        "country": (t.bronze_cities(spark, sf), COUNTRY_SCHEMA),
        "earthquake": (t.bronze_earthquakes(spark, sf, located), EARTHQUAKE_SCHEMA),
        "tsunami": (t.bronze_tsunamis(spark, sf, located), WIDE_TSUNAMI_SCHEMA),
    }
    sources, schemas = {}, {}
    for name, (frame, schema) in frames.items():
        path = landing.path("csv", name)
        layers.to_declared(frame, schema).write.option("header", True).option("escape", "\\").csv(path)
        sources[name], schemas[name] = path, schema
    base = layers.Layout(scratch_path(spark, "layers"))
    out = layers.run_disaster_layers(
        spark, sources, base, d.CONTINENT, *YEARS, k=TOP_K, schemas=schemas, check_header=True
    )
    tsunamis = read_parquet(spark, out["gold/top_tsunami"]).select(
        F.lit("top_tsunami").alias("dataset"), "Country", "Timestamp", F.col("Deaths").cast("double").alias("measure"),
        F.lit(None).cast("string").alias("title"),
    )
    quakes = read_parquet(spark, out["gold/earthquake"]).select(
        F.lit("earthquake"), "Country", "Timestamp", "Magnitude", "Title"
    )
    return tsunamis.union(quakes)


def q_silver_by_year(spark: SparkSession, sf: str) -> DataFrame:
    """One year of silver tsunamis written by year: the others aren't read."""
    bronze = scratch_path(spark, "bronze-tsunami")
    write_parquet(t.bronze_tsunamis(spark, sf), bronze)
    out = layers.silver_tsunami_job(spark, bronze, scratch_path(spark, "silver-by-year"), *YEARS, by_year=True)
    return read_parquet(spark, out).filter(F.col("year") == YEARS[0] + 1)


def q_pipeline_charge_record(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "gold-charge-records")
    return read_parquet(spark, publish_parquet(_charge_records(spark, sf), path, contract=CHARGE_RECORD_SCHEMA))


# ---- derived questions --------------------------------------------------------------------


def q_event_correlation(spark: SparkSession, sf: str) -> DataFrame:
    quakes = t.bronze_earthquakes(spark, sf).withColumn("depth_km", F.col("depth").cast("double"))
    return event_correlation(quakes, "tsunami", "magnitude", "depth_km")


def q_interval_match(spark: SparkSession, sf: str) -> DataFrame:
    events = t.table(spark, sf, "events")
    return followed_within(events, "user_id", "ts", "event_type", "error", "purchase", INTERVAL_SECONDS)


def q_quake_tsunami_match(spark: SparkSession, sf: str) -> DataFrame:
    """Per country: earthquakes, and those followed by a tsunami within 24 h."""
    located = t.located_orders(spark, sf)
    quakes = _silver_earthquakes(spark, sf, located).select(
        F.col("country").alias("Country"), F.col("time_stamp").alias("ts"), F.lit("earthquake").alias("kind")
    )
    waves = _tsunamis_in_asia(spark, sf, located).select(
        "Country", F.col("Timestamp").alias("ts"), F.lit("tsunami").alias("kind")
    )
    events = quakes.unionByName(waves)
    return followed_within(events, "Country", "ts", "kind", "earthquake", "tsunami", INTERVAL_SECONDS)


def q_quake_tsunami_near(spark: SparkSession, sf: str) -> DataFrame:
    """Per earthquake: tsunamis within 100 km and the next 48 h, the nearest one's distance."""
    located = t.located_orders(spark, sf)
    quakes = d.silver_earthquake(t.bronze_earthquakes(spark, sf, located, placed=True), d.CONTINENT, *YEARS)
    waves = d.silver_tsunami(t.bronze_tsunamis(spark, sf, located, placed=True), *YEARS)
    return near_followers(
        quakes.select("title", "time_stamp", "latitude", "longitude"),
        waves,
        ("time_stamp", "latitude", "longitude"),
        ("time_stamp", "Latitude", "Longitude"),
        NEAR_KM,
        NEAR_SECONDS,
        count_as="tsunamis",
    ).select("title", "tsunamis", "nearest_km")


def q_tsunami_last_quake(spark: SparkSession, sf: str) -> DataFrame:
    """Per tsunami: the last earthquake of its country before it."""
    located = t.located_orders(spark, sf)
    waves = d.gold_tsunami(d.silver_tsunami(t.bronze_tsunamis(spark, sf, located), *YEARS))
    waves = waves.select(F.col("`Sr.no`").alias("serial"), "country", F.col("time_stamp").alias("at"))
    quakes = _silver_earthquakes(spark, sf, located)
    taken = {"title": "quake", "magnitude": "magnitude", "time_stamp": "quake_at"}
    return asof_join(waves, quakes, "country", "country", "at", "time_stamp", taken, ties=["title"])


def q_json_explode(spark: SparkSession, sf: str) -> DataFrame:
    """One JSON text per order, with its line numbers as an array, back to one row per line."""
    lines = t.table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.collect_list("l_linenumber").alias("line"))
    text = lines.select("l_orderkey", F.to_json(F.struct("line")).alias("doc"))
    return json_flatten(text, "doc", "line ARRAY<INT>", keep=["l_orderkey"], explode="line")


def q_json_flatten(spark: SparkSession, sf: str) -> DataFrame:
    return json_flatten(t.table(spark, sf, "events"), "props", "k INT", keep=["event_id"])


def q_json_variant(spark: SparkSession, sf: str) -> DataFrame:
    """The lines of each order's JSON text, by the schema found in the texts;
    a text cut short has one row without values."""
    docs = t.order_documents(spark, sf)
    docs = materialize(docs, "order-documents")
    lines = json_unpack(docs, "doc", keep=["l_orderkey"], explode="lines")
    place = {f"lines_{name}": F.try_element_at("lines_ids", F.lit(k)) for k, name in ((1, "part"), (2, "supplier"))}
    return lines.withColumns(place).drop("lines_ids")


QUERIES: dict[str, Query] = {
    "csv_typed_ingest": q_csv_typed_ingest,
    "csv_incremental_ingest": q_csv_incremental_ingest,
    "parquet_scan": q_parquet_scan,
    "parquet_overwrite": q_parquet_overwrite,
    "csv_corrupt_counts": q_csv_corrupt_counts,
    "csv_quarantine": q_csv_quarantine,
    "parquet_partition_overwrite": q_parquet_partition_overwrite,
    "clustered_scan": q_clustered_scan,
    "evolving_layouts": q_evolving_layouts,
    "output_manifest": q_output_manifest,
    "filter_equals": q_filter_equals,
    "filter_year_range": q_filter_year_range,
    "filter_int_range": q_filter_int_range,
    "filter_complete_rows": q_filter_complete_rows,
    "distinct_keys": q_distinct_keys,
    "parse_timestamp": q_parse_timestamp,
    "timestamp_from_parts": q_timestamp_from_parts,
    "last_token": q_last_token,
    "normalize_name": q_normalize_name,
    "dim_match_numeric": q_dim_match_numeric,
    "dim_match_impact": q_dim_match_impact,
    "dim_match_fanout": q_dim_match_fanout,
    "group_count_ranked": q_group_count_ranked,
    "topk": q_topk,
    "topk_detail": q_topk_detail,
    "topk_by_measure": q_topk_by_measure,
    "topk_trend": q_topk_trend,
    "trend_break": q_trend_break,
    "request_response_match": q_request_response_match,
    "stop_start_match": q_stop_start_match,
    "duration_hours": q_duration_hours,
    "unit_delta": q_unit_delta,
    "parking_time": q_parking_time,
    "charge_record": q_charge_record,
    "charge_record_colocated": q_charge_record_colocated,
    "lag_change_flag": q_lag_change_flag,
    "running_group_id": q_running_group_id,
    "group_bounds": q_group_bounds,
    "idle_time": q_idle_time,
    "idle_time_incremental": q_idle_time_incremental,
    "pipeline_dimension": q_pipeline_dimension,
    "pipeline_facts_text_time": q_pipeline_facts_text_time,
    "pipeline_facts_part_time": q_pipeline_facts_part_time,
    "pipeline_topk_impact": q_pipeline_topk_impact,
    "pipeline_layers": q_pipeline_layers,
    "silver_by_year": q_silver_by_year,
    "pipeline_charge_record": q_pipeline_charge_record,
    "event_correlation": q_event_correlation,
    "interval_match": q_interval_match,
    "quake_tsunami_match": q_quake_tsunami_match,
    "quake_tsunami_near": q_quake_tsunami_near,
    "tsunami_last_quake": q_tsunami_last_quake,
    "json_explode": q_json_explode,
    "json_flatten": q_json_flatten,
    "json_variant": q_json_variant,
}
