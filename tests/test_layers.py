"""Layer jobs end to end: CSV in the declared layouts -> bronze -> silver -> gold."""

from __future__ import annotations

from datetime import datetime

from strata.plans import layers
from strata.schemas import COUNTRY_SCHEMA, EARTHQUAKE_SCHEMA, TSUNAMI_SCHEMA
from strata.session import scratch_path
from strata.sources.files import read_parquet


def _csv(df, schema, path):
    layers.to_declared(df, schema).write.option("header", True).option("escape", "\\").csv(path)
    return path


def test_disaster_layers(spark):
    landing = layers.Layout(scratch_path(spark, "test-landing"))
    cities = spark.createDataFrame(
        [
            ("Tokyo", 35.7, 139.7, "Japan", "Asia"),
            ("Osaka", 34.7, 135.5, "Japan", "Asia"),
            ("Jakarta", -6.2, 106.8, "Indonesia", "Asia"),
            ("Tehran", 35.7, 51.4, "Iran", "Asia"),
            ("Manila", 14.6, 121.0, "Philippines", "Asia"),
            ("Lima", -12.0, -77.0, "Peru", "South America"),
        ],
        COUNTRY_SCHEMA,
    )
    hits = [("JAPAN", 3), ("INDONESIA", 2), ("PHILIPPINES", 1), ("IRAN", 1), ("PERU", 4)]
    tsunamis = spark.createDataFrame(
        [(country, 2000 + i, 1, 1 + i, 5, 7, 10 * i) for country, n in hits for i in range(n)],
        "Country string, Year int, Mo int, Dy int, Hr int, Mn int, Deaths int",
    )
    quakes = spark.createDataFrame(
        [
            ("q1", 7.0, "22-11-2022 02:03", 1, "14", "off coast, Japan", "Asia", "x"),
            ("q2", 6.0, "1-1-2022 2:3", 0, "10", "a, Japan", "Asia", "x"),
            ("q3", 6.1, "22-11-2022 02:03", 0, "10", "a, Peru", "South America", "x"),
        ],
        "title string, magnitude double, date_time string, tsunami int, depth string, location string, "
        "continent string, country string",
    )
    sources = {
        "country": _csv(cities, COUNTRY_SCHEMA, landing.path("csv", "country")),
        "tsunami": _csv(tsunamis, TSUNAMI_SCHEMA, landing.path("csv", "tsunami")),
        "earthquake": _csv(quakes, EARTHQUAKE_SCHEMA, landing.path("csv", "earthquake")),
    }
    out = layers.run_disaster_layers(spark, sources, layers.Layout(scratch_path(spark, "test-layers")))
    assert len(read_parquet(spark, out["bronze/tsunami"]).columns) == len(TSUNAMI_SCHEMA.fields)
    top = read_parquet(spark, out["gold/top_tsunami"]).collect()
    assert sorted({r.Country for r in top}) == ["Indonesia", "Iran", "Japan"]
    assert len(top) == 6
    quake = read_parquet(spark, out["gold/earthquake"]).collect()
    assert [(r.Country, r.Title, r.Depth, r.Timestamp) for r in quake] == [
        ("Japan", "q1", "14", datetime(2022, 11, 22, 2, 3))
    ]
    # rerunning a job overwrites its dataset
    again = layers.silver_country_job(spark, out["bronze/country"], out["silver/country"])
    assert read_parquet(spark, again).count() == 5


def test_gold_charge_job_equals_the_in_plan_records(spark):
    from strata.plans import driver_tables as t
    from strata.plans.charge import charge_records
    from tests.conftest import SF_SMALL

    frames = [
        t.start_requests(spark, SF_SMALL),
        t.start_responses(spark, SF_SMALL),
        t.stop_requests(spark, SF_SMALL),
        t.meter_values(spark, SF_SMALL),
    ]
    silver = layers.Layout(scratch_path(spark, "test-charge-silver"))
    paths = []
    for i, frame in enumerate(frames):
        path = silver.path("silver", f"part{i}")
        frame.write.parquet(path)
        paths.append(path)
    out = layers.gold_charge_job(spark, *paths, scratch_path(spark, "test-charge-gold"), order=t.METER_ORDER)
    written = read_parquet(spark, out)
    direct = charge_records(*frames, order=t.METER_ORDER)
    assert written.count() == direct.count() > 0
    assert written.exceptAll(direct).count() == 0 and direct.exceptAll(written).count() == 0


def test_layers_command_line(spark):
    cities = spark.createDataFrame([("Tokyo", 35.7, 139.7, "Japan", "Asia")], COUNTRY_SCHEMA)
    tsunamis = spark.createDataFrame([("JAPAN", 2000, 1, 1, 5, 7, 10)], "Country string, Year int, Mo int, Dy int, Hr int, Mn int, Deaths int")
    landing = layers.Layout(scratch_path(spark, "test-cli-landing"))
    country = _csv(cities, COUNTRY_SCHEMA, landing.path("csv", "country"))
    tsunami = _csv(tsunamis, TSUNAMI_SCHEMA, landing.path("csv", "tsunami"))
    out = layers.main(["--base", scratch_path(spark, "test-cli"), "--country", country, "--tsunami", tsunami])
    rows = read_parquet(spark, out["gold/top_tsunami"]).collect()
    assert [(r.Country, r.Deaths) for r in rows] == [("Japan", 10)]


def test_silver_facts_by_year_and_contract(spark):
    import pytest

    rows = [("JAPAN", y, 1, 1, 5, 7, 10) for y in (2000, 2001, 2001)]
    bronze = scratch_path(spark, "test-year-bronze")
    frame = spark.createDataFrame(rows, "Country string, Year int, Mo int, Dy int, Hr int, Mn int, Deaths int")
    layers.to_declared(frame, TSUNAMI_SCHEMA).write.parquet(bronze)
    out = layers.silver_tsunami_job(spark, bronze, scratch_path(spark, "test-year-silver"), by_year=True)
    assert {r.year: r["count"] for r in read_parquet(spark, out).groupBy("year").count().collect()} == {2000: 1, 2001: 2}
    zoned = layers.silver_tsunami_job(spark, bronze, scratch_path(spark, "test-zoned"), ntz=False)
    schema = read_parquet(spark, zoned).schema
    assert schema["time_stamp"].dataType.simpleString() == "timestamp"
    with pytest.raises(ValueError, match="contract"):
        layers.silver_tsunami_job(spark, bronze, scratch_path(spark, "test-contract"), contract=schema)
