"""Frame-level cleaning steps: build timestamps, rebuild and normalise names."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.text import last_token, normalize_name
from strata.functions.time import parse_timestamp, timestamp_from_parts
from strata.schemas import EARTHQUAKE_TIME_FORMAT, LOCATION_SEPARATOR, SPACE_TOKEN, TSUNAMI_TIME_PARTS


def make_timestamp(
    df: DataFrame,
    source: str = "date_time",
    target: str = "time_stamp",
    fmt: str = EARTHQUAKE_TIME_FORMAT,
    ntz: bool = True,
) -> DataFrame:
    """Parse ``source`` into ``target`` and drop ``source``; unparsable -> null."""
    return df.withColumn(target, parse_timestamp(source, fmt, ntz=ntz)).drop(source)


def make_timestamp_from_parts(
    df: DataFrame,
    year: str = "Year",
    month: str = "Mo",
    day: str = "Dy",
    hour: str = "Hr",
    minute: str = "Mn",
    target: str = "time_stamp",
    drop: Sequence[str] = tuple(TSUNAMI_TIME_PARTS),
    ntz: bool = True,
) -> DataFrame:
    """Minute-resolution timestamp from integer parts; the parts are dropped."""
    built = timestamp_from_parts(year, month, day, hour, minute, ntz=ntz)
    return df.withColumn(target, built).drop(*[c for c in drop if c in df.columns])


def make_country(
    df: DataFrame, location: str = "location", target: str = "country", sep: str = LOCATION_SEPARATOR
) -> DataFrame:
    """Replace ``target`` with the last ``sep``-separated token of ``location``."""
    return df.withColumn(target, last_token(location, sep))


def capitalize_country(
    df: DataFrame, column: str = "country", space_token: str = SPACE_TOKEN, legacy: bool = False
) -> DataFrame:
    """Normalise an upper-case name column in place (see ``normalize_name``)."""
    return df.withColumn(column, normalize_name(column, space_token, legacy))


def distinct_keys(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct combinations of ``columns`` (partial aggregation before the shuffle)."""
    return df.select(*[F.col(c) for c in columns]).distinct()
