"""Row filters. All are plain predicates, so Catalyst pushes them to the scan
whenever the column exists there."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from strata.functions.time import year_range
from strata.schemas import POWER_MEASURAND


def filter_equals(df: DataFrame, column: str, value: object) -> DataFrame:
    """Rows whose ``column`` equals ``value`` (case-sensitive for strings)."""
    return df.filter(F.col(column) == F.lit(value))


def filter_year_range(df: DataFrame, column: str, first_year: int, last_year: int) -> DataFrame:
    """Rows with ``first_year <= year(column) <= last_year``; null dropped.

    Written as ``column >= Y1-01-01 and column < (Y2+1)-01-01`` in the column's
    own type, so both bounds reach the Parquet reader as pushed filters.
    """
    return df.filter(year_range(column, first_year, last_year, df.schema[column].dataType))


def filter_int_range(df: DataFrame, column: str, low: int, high: int) -> DataFrame:
    """Rows with ``low <= column <= high``; null dropped."""
    return df.filter(F.col(column).between(F.lit(low), F.lit(high)))


def filter_complete_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows where every column in ``columns`` is non-null (and no NaN).

    One predicate per column, as ``dropna``'s own expression isn't pushed to
    the scan.
    """
    kept = F.lit(True)
    for name in columns:
        column = F.col(name)
        kept = kept & column.isNotNull()
        if isinstance(df.schema[name].dataType, (FloatType, DoubleType)):
            kept = kept & ~F.isnan(column)
    return df.filter(kept)


def filter_measurand(
    df: DataFrame,
    measurand: str = POWER_MEASURAND,
    measurand_column: str = "measurand",
    phase_column: str = "phase",
) -> DataFrame:
    """Readings of one measurand taken over all phases (phase is null)."""
    return df.filter((F.col(measurand_column) == F.lit(measurand)) & F.col(phase_column).isNull())
