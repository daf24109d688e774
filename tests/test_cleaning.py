"""Silver cleaning steps on the edge rows of FIXTURES.md section 1."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from strata.functions.text import last_token, normalize_name
from strata.plans import disaster as d
from strata.schemas import COUNTRY_SCHEMA, EARTHQUAKE_SCHEMA, TSUNAMI_SCHEMA
from tests.helpers import plan_text


def _earthquakes(spark):
    def row(title, date_time, location, continent, country, tsunami=0, magnitude=6.5):
        values = {f.name: None for f in EARTHQUAKE_SCHEMA.fields}
        values.update(
            title=title, magnitude=magnitude, date_time=date_time, tsunami=tsunami, depth="10",
            location=location, continent=continent, country=country,
        )
        return tuple(values[f.name] for f in EARTHQUAKE_SCHEMA.fields)

    rows = [
        row("q1", "22-11-2022 02:03", "off coast, Japan", "Asia", "x", 1, 7.0),
        row("q2", "01-01-1995 00:00", "Japan", "Asia", "x"),
        row("q3", "31-12-1994 23:59", "a, Japan", "Asia", "x"),
        row("q4", "31-12-2023 23:59", "a, Japan", "Asia", "x"),
        row("q5", "1-1-2022 2:3", "a, Japan", "Asia", "x"),
        row("q6", "22-11-2022 02:03", "a, Japan", "Asia", None),
        row("q7", "22-11-2022 02:03", None, "Asia", "x"),
        row("q8", "22-11-2022 02:03", "a, b, ", "Asia", "x"),
        row("q9", "22-11-2022 02:03", "a, Peru", "South America", "x"),
    ]
    return spark.createDataFrame(rows, EARTHQUAKE_SCHEMA)


def test_silver_earthquake_edge_rows(spark):
    out = d.silver_earthquake(_earthquakes(spark))
    got = {r.title: (r.country, r.time_stamp) for r in out.collect()}
    assert got == {
        "q1": ("Japan", datetime(2022, 11, 22, 2, 3)),
        "q2": ("Japan", datetime(1995, 1, 1, 0, 0)),
        "q4": ("Japan", datetime(2023, 12, 31, 23, 59)),
        "q8": ("", datetime(2022, 11, 22, 2, 3)),
    }
    assert "date_time" not in out.columns
    assert dict(out.dtypes)["time_stamp"] == "timestamp_ntz"


def test_year_range_is_pushed_to_the_scan(spark, tmp_path):
    path = str(tmp_path / "quakes")
    d.make_timestamp(_earthquakes(spark)).write.parquet(path)
    from strata.operators.filters import filter_year_range

    df = filter_year_range(spark.read.parquet(path), "time_stamp", 1995, 2023)
    text = plan_text(df)
    assert "GreaterThanOrEqual(time_stamp,1995-01-01T00:00)" in text
    assert "LessThan(time_stamp,2024-01-01T00:00)" in text
    assert sorted(r.title for r in df.collect()) == ["q1", "q2", "q4", "q6", "q7", "q8", "q9"]


def _tsunamis(spark, rows):
    def row(year, mo, dy, hr, mn, sec, country):
        values = {f.name: None for f in TSUNAMI_SCHEMA.fields}
        values.update({"Year": year, "Mo": mo, "Dy": dy, "Hr": hr, "Mn": mn, "Sec": sec, "Country": country})
        return tuple(values[f.name] for f in TSUNAMI_SCHEMA.fields)

    return spark.createDataFrame([row(*r) for r in rows], TSUNAMI_SCHEMA)


def test_silver_tsunami_timestamps(spark):
    rows = [
        (2011, 3, 11, 5, 46, 24.1, "JAPAN"),
        (2004, 12, 26, None, None, None, "INDONESIA"),
        (1995, None, 3, None, None, None, "JAPAN"),
        (1994, 1, 1, 0, 0, 0.0, "JAPAN"),
        (2023, 1, 1, 123, 0, 0.0, "JAPAN"),
        (None, 1, 1, 0, 0, 0.0, "JAPAN"),
    ]
    out = d.silver_tsunami(_tsunamis(spark, rows)).collect()
    got = sorted((r.time_stamp for r in out), key=lambda t: (t is None, t))
    assert got == [
        datetime(2004, 12, 26, 0, 0),
        datetime(2011, 3, 11, 5, 46),
        datetime(2023, 1, 1, 12, 0),  # hour 123 is cut to "12"
        None,  # missing month: the text does not parse, no exception
    ]
    assert all(c not in out[0].asDict() for c in ["Year", "Mo", "Dy", "Hr", "Mn", "Sec"])


def test_normalize_name_fixed_and_legacy(spark):
    df = spark.createDataFrame(
        [("PAPUANanNEWNanGUINEA",), ("CHINANanSEA",), ("GUINEA-BISSAU",), ("JAPAN",), (None,)], "c string"
    )
    out = df.select(normalize_name("c").alias("fixed"), normalize_name("c", legacy=True).alias("legacy")).collect()
    assert [(r.fixed, r.legacy) for r in out] == [
        ("Papua New Guinea", "Papua New Guinea"),
        ("China Sea", "Chi Ansea"),
        ("Guinea-bissau", "Guinea-bissau"),
        ("Japan", "Japan"),
        (None, None),
    ]


def test_last_token(spark):
    df = spark.createDataFrame([("off coast, Japan",), ("Japan",), ("a, b, ",), (None,), ("a.b, c|d",)], "l string")
    assert [r.t for r in df.select(last_token("l").alias("t")).collect()] == ["Japan", "Japan", "", None, "c|d"]
    assert [r.t for r in df.select(last_token("l", ".").alias("t")).collect()][4] == "b, c|d"


def test_silver_country_is_case_sensitive(spark):
    rows = [
        ("Tokyo", 35.7, 139.7, "Japan", "Asia"),
        ("Lima", -12.0, -77.0, "Peru", "South America"),
        ("Lower", 0.0, 0.0, "Iran", "asia"),
    ]
    out = d.silver_country(spark.createDataFrame(rows, COUNTRY_SCHEMA))
    assert [r.City for r in out.collect()] == ["Tokyo"]


def test_tsunami_country_rename_and_normalise(spark):
    df = _tsunamis(spark, [(2000, 1, 1, 0, 0, 0.0, "PAPUANanNEWNanGUINEA")])
    out = d.gold_tsunami(d.silver_tsunami(df))
    assert "country" in out.columns
    assert out.select(F.col("country")).first()[0] == "Papua New Guinea"


def test_depth_stays_text_unless_asked(spark):
    out = d.silver_earthquake(_earthquakes(spark), depth_as_double=True)
    assert dict(out.dtypes)["depth"] == "double"
    assert dict(d.silver_earthquake(_earthquakes(spark)).dtypes)["depth"] == "string"


def test_both_sides_normalised_on_request(spark):
    dim = spark.createDataFrame([("Tokyo", 0.0, 0.0, "JAPAN", "Asia")], COUNTRY_SCHEMA)
    quakes = d.silver_earthquake(_earthquakes(spark)).filter("title = 'q1'")
    assert d.earthquakes_in(quakes, d.countries_of(dim)).count() == 0
    both = d.earthquakes_in(quakes, d.countries_of(dim, normalize=True), normalize=True)
    assert [r.Country for r in both.collect()] == ["Japan"]
