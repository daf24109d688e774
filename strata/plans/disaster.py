"""Bronze -> silver -> gold pipelines of the disaster datasets.

Each layer is a function of DataFrames. Run in one plan (``materialize`` off)
Catalyst prunes the unused bronze columns down to the scan and pushes filters
across layers; with ``materialize`` the silver output is written as Parquet
below the shared folder and read back, as separate layer jobs would do.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators.filters import filter_complete_rows, filter_equals, filter_int_range, filter_year_range
from strata.operators.joins import match_dimension
from strata.operators.ranking import hit_summary, top_k_by_measure, top_k_detail, top_k_keys, top_k_trend
from strata.operators.shaping import (
    capitalize_country,
    distinct_keys,
    make_country,
    make_timestamp,
    make_timestamp_from_parts,
)
from strata.sources.files import materialize

FIRST_YEAR, LAST_YEAR = 1995, 2023
CONTINENT = "Asia"


# ---- silver -------------------------------------------------------------------------


def silver_country(bronze: DataFrame, continent: str = CONTINENT) -> DataFrame:
    return filter_equals(bronze, "Continent", continent)


def silver_earthquake(
    bronze: DataFrame,
    continent: str = CONTINENT,
    first_year: int = FIRST_YEAR,
    last_year: int = LAST_YEAR,
    depth_as_double: bool = False,
    ntz: bool = True,
) -> DataFrame:
    """Complete rows -> country from location -> continent -> timestamp -> years.

    The completeness check runs on the original ``country`` before it is
    rebuilt from ``location``, so rows with a null original country go.
    ``depth`` is text in the bronze schema and stays text unless
    ``depth_as_double`` (then text that is not a number becomes null).
    ``ntz=False`` gives the zoned ``timestamp`` type.
    """
    df = filter_complete_rows(bronze, ["location", "continent", "country"])
    df = make_country(df)
    df = filter_equals(df, "continent", continent)
    df = make_timestamp(df, ntz=ntz)
    if depth_as_double:
        df = df.withColumn("depth", F.col("depth").try_cast("double"))
    return filter_year_range(df, "time_stamp", first_year, last_year)


def silver_tsunami(
    bronze: DataFrame, first_year: int = FIRST_YEAR, last_year: int = LAST_YEAR, ntz: bool = True
) -> DataFrame:
    """Year range on the integer year first (pushed to the scan), then the timestamp."""
    return make_timestamp_from_parts(filter_int_range(bronze, "Year", first_year, last_year), ntz=ntz)


# ---- gold ---------------------------------------------------------------------------


def gold_tsunami(silver: DataFrame, legacy_names: bool = False) -> DataFrame:
    """Silver tsunamis with ``Country`` renamed to ``country`` and normalised."""
    return capitalize_country(silver.withColumnRenamed("Country", "country"), "country", legacy=legacy_names)


def countries_of(dimension: DataFrame, normalize: bool = False) -> DataFrame:
    """Distinct country names of a dimension; ``normalize`` puts them in the
    display form used for the tsunami names (by default they are used as is)."""
    keys = distinct_keys(dimension, ["Country"])
    return distinct_keys(capitalize_country(keys, "Country"), ["Country"]) if normalize else keys


def earthquakes_in(earthquakes: DataFrame, dimension: DataFrame, normalize: bool = False) -> DataFrame:
    """Earthquakes of the dimension's countries, in gold shape (6 columns).

    Names are compared as they are, case-sensitively; ``normalize`` brings the
    earthquake names into display form first (pass a dimension normalised with
    ``countries_of(..., normalize=True)`` too).
    """
    if normalize:
        earthquakes = capitalize_country(earthquakes, "country")
    return match_dimension(
        earthquakes,
        dimension,
        "country",
        "Country",
        key_alias="Country",
        output=[
            F.col("title").alias("Title"),
            F.col("magnitude").alias("Magnitude"),
            F.col("depth").alias("Depth"),
            F.col("tsunami").alias("Tsunami"),
            F.col("time_stamp").alias("Timestamp"),
        ],
    )


def tsunamis_in(tsunamis: DataFrame, dimension: DataFrame) -> DataFrame:
    """Normalised tsunamis of the dimension's countries, in gold shape (8 columns)."""
    return match_dimension(
        tsunamis,
        dimension,
        "country",
        "Country",
        key_alias="Country",
        output=[
            F.col("TsunamiNanCauseNanCode").alias("TsunamiCauseCode"),
            F.col("Deaths"),
            F.col("Missing"),
            F.col("Injuries"),
            F.col("HousesNanDestroyed").alias("HousesDestroyed"),
            F.col("HousesNanDamaged").alias("HousesDamaged"),
            F.col("time_stamp").alias("Timestamp"),
        ],
    )


DETAIL_COLUMNS = ["Country", "Timestamp", "Deaths", "Missing", "Injuries", "HousesDestroyed", "HousesDamaged"]
IMPACT_MEASURES = ["Deaths", "Missing", "Injuries", "HousesDestroyed", "HousesDamaged"]
IMPACT_ALIASES = ["deaths", "missing", "injuries", "houses_destroyed", "houses_damaged"]


def hits_ranked(matched: DataFrame) -> DataFrame:
    return hit_summary(matched, "Country", "hits")


def top_countries(matched: DataFrame, k: int = 3) -> DataFrame:
    return top_k_keys(matched, "Country", k, "hits")


def shared_input(matched: DataFrame, reuse: bool, name: str) -> DataFrame:
    """The matched facts, written once when two branches read them.

    Ranking and detail both read the matched facts. Without ``reuse`` each
    branch recomputes them, with its own scans and join shuffles, because
    column pruning makes the two branches' plans differ, so Spark cannot
    share an exchange between them. With ``reuse`` they are written once as
    Parquet in the shared folder (which also cuts the lineage), and both
    branches scan that.
    """
    return materialize(matched, name) if reuse else matched


def top_detail(matched: DataFrame, k: int = 3, reuse: bool = False) -> DataFrame:
    return top_k_detail(shared_input(matched, reuse, "gold-matched"), "Country", k, DETAIL_COLUMNS)


def top_by_impact(matched: DataFrame, k: int = 3) -> DataFrame:
    return top_k_by_measure(matched, "Country", IMPACT_MEASURES, k, "impact", IMPACT_ALIASES)


def top_trend(matched: DataFrame, k: int = 3, reuse: bool = False) -> DataFrame:
    facts = shared_input(matched, reuse, "gold-matched")
    return top_k_trend(facts, "Country", "Timestamp", IMPACT_MEASURES, k, IMPACT_ALIASES)


def pipeline_topk_impact(
    bronze_tsunamis: DataFrame,
    bronze_cities: DataFrame,
    k: int = 3,
    continent: str = CONTINENT,
    first_year: int = FIRST_YEAR,
    last_year: int = LAST_YEAR,
    legacy_names: bool = False,
    reuse: bool = True,
) -> DataFrame:
    """Rows of the k countries of a continent hit most often (gold detail)."""
    silver_ts = silver_tsunami(bronze_tsunamis, first_year, last_year)
    dimension = silver_country(bronze_cities, continent)
    matched = tsunamis_in(gold_tsunami(silver_ts, legacy_names), countries_of(dimension))
    return top_detail(matched, k, reuse)
