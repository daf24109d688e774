"""Measure expressions: unit conversion of meter deltas and state flags."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from strata.schemas import WH_PER_KWH


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def unit_delta(stop: Column | str, start: Column | str, divisor: float = WH_PER_KWH, decimals: int = 2) -> Column:
    """``(stop - start) / divisor`` as double, rounded half up (Wh -> kWh)."""
    return F.round(((_col(stop) - _col(start)) / F.lit(divisor)).cast("double"), decimals)


def active_flag(value: Column | str, threshold: float = 0.0) -> Column:
    """1 when ``value > threshold``, else 0; null and lower values count as 0."""
    return F.when(_col(value) > F.lit(threshold), F.lit(1)).otherwise(F.lit(0))
