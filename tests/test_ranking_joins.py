"""Dimension matching, ranked counts and top-k (FIXTURES.md 'ranking')."""

from __future__ import annotations

from datetime import datetime

import pytest

from strata.operators.joins import match_all_cities, match_dimension
from strata.operators.ranking import hit_summary, top_k_by_measure, top_k_detail, top_k_keys, top_k_trend
from strata.schemas import COUNTRY_SCHEMA
from tests.helpers import plan_text

CITIES = [
    ("Tokyo", 35.7, 139.7, "Japan", "Asia"),
    ("Osaka", 34.7, 135.5, "Japan", "Asia"),
    ("Manila", 14.6, 121.0, "Philippines", "Asia"),
    ("Jakarta", -6.2, 106.8, "Indonesia", "Asia"),
    ("Tehran", 35.7, 51.4, "Iran", "Asia"),
    ("Nowhere", 0.0, 0.0, None, "Asia"),
]

HITS = (
    [("Japan", 1995 + i, 10 * i, None) for i in range(3)]
    + [("Indonesia", 2000 + i, 5, 1) for i in range(2)]
    + [("Philippines", 2001, 7, 2), ("Iran", 2002, 1, 0), ("Peru", 2003, 100, 0), (None, 2004, 1, 1)]
)


@pytest.fixture
def facts(spark):
    rows = [(c, datetime(y, 1, 1), deaths, missing) for c, y, deaths, missing in HITS]
    return spark.createDataFrame(rows, "country string, Timestamp timestamp_ntz, Deaths int, Missing int")


@pytest.fixture
def cities(spark):
    return spark.createDataFrame(CITIES, COUNTRY_SCHEMA)


def test_match_dimension_keeps_each_fact_once(facts, cities):
    out = match_dimension(facts, cities, "country", "Country", key_alias="Country")
    got = sorted(r.Country for r in out.collect())
    # Osaka doubles Japan in the dimension, but each fact matches once; null and Peru drop.
    assert got == ["Indonesia"] * 2 + ["Iran"] + ["Japan"] * 3 + ["Philippines"]


def test_match_never_exceeds_the_facts(spark):
    import __spark_entry__ as entry
    from tests.conftest import SF_SMALL

    matched = entry.queries()["dim_match_impact"](spark, SF_SMALL).count()
    facts = entry.queries()["pipeline_facts_part_time"](spark, SF_SMALL).count()
    assert 0 < matched <= facts


def test_match_dimension_is_case_sensitive(spark, cities):
    facts = spark.createDataFrame([("japan",), ("Japan",)], "country string")
    assert match_dimension(facts, cities, "country", "Country").count() == 1


def test_match_all_cities_reports_the_fanout_without_pairs(facts, cities):
    out = {r.country: (r.n_cities, r.first_city, r.last_city) for r in match_all_cities(facts, cities, "country").collect()}
    assert out["Japan"] == (2, "Osaka", "Tokyo")
    assert out["Iran"] == (1, "Tehran", "Tehran")
    assert "Peru" not in out and None not in out
    # The plain per-city join has one row per (fact, city): the sum of n_cities.
    plain = facts.join(cities, facts.country == cities.Country).count()
    total = match_all_cities(facts, cities, "country").groupBy().sum("n_cities").first()[0]
    assert total == plain


def test_ranked_counts_and_top3_tie_break(facts, cities):
    matched = match_dimension(facts, cities, "country", "Country", key_alias="Country")
    ranked = [(r.Country, r.hits) for r in hit_summary(matched).collect()]
    assert ranked == [("Japan", 3), ("Indonesia", 2), ("Iran", 1), ("Philippines", 1)]
    top = [(r.Country, r.hits) for r in top_k_keys(matched, k=3).collect()]
    assert top == [("Japan", 3), ("Indonesia", 2), ("Iran", 1)]


def test_top3_detail_has_six_rows_and_no_philippines(facts, cities):
    matched = match_dimension(facts, cities, "country", "Country", key_alias="Country")
    detail = top_k_detail(matched, "Country", 3)
    assert detail.count() == 6
    assert "Philippines" not in {r.Country for r in detail.collect()}
    text = plan_text(detail)
    assert "TakeOrderedAndProject" in text and "LeftSemi" in text


def test_top_by_measure_counts_null_as_zero(facts, cities):
    matched = match_dimension(facts, cities, "country", "Country", key_alias="Country")
    out = top_k_by_measure(matched, "Country", ["Deaths", "Missing"], 2, "impact", ["deaths", "missing"]).collect()
    assert [(r.Country, r.deaths, r.missing, r.impact, r.events) for r in out] == [
        ("Japan", 30, 0, 30, 3),
        ("Indonesia", 10, 2, 12, 2),
    ]


def test_trend_of_top_keys(facts, cities):
    matched = match_dimension(facts, cities, "country", "Country", key_alias="Country")
    out = top_k_trend(matched, "Country", "Timestamp", ["Deaths"], 1, ["deaths"]).orderBy("year").collect()
    assert [(r.year, r.deaths, r.deaths_change) for r in out] == [(1995, 0, None), (1996, 10, 10), (1997, 20, 10)]


def test_fractional_measures_are_not_truncated(spark):
    df = spark.createDataFrame([("A", 0.4), ("A", 0.4), ("B", 0.5)], "Country string, damage double")
    out = top_k_by_measure(df, "Country", ["damage"], 1, "impact").collect()
    assert [(r.Country, round(r.impact, 9)) for r in out] == [("A", 0.8)]


def test_trend_change_is_against_the_previous_calendar_year(spark):
    rows = [("A", datetime(y, 1, 1), y) for y in (2000, 2001, 2003, 2004)]
    df = spark.createDataFrame(rows, "Country string, Timestamp timestamp_ntz, Deaths int")
    out = top_k_trend(df, k=1, aliases=["deaths"]).orderBy("year").collect()
    assert [(r.year, r.deaths_change) for r in out] == [(2000, None), (2001, 1), (2003, None), (2004, 1)]


def test_missing_keys_take_no_place_among_the_top(spark):
    rows = [(None,)] * 9 + [("A",)] * 3 + [("B",)] * 2 + [("C",)]
    df = spark.createDataFrame(rows, "Country string")
    assert sorted({r.Country for r in top_k_detail(df, "Country", 3).collect()}) == ["A", "B", "C"]
