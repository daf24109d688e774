"""Column expressions built from Spark's built-in functions."""

from strata.functions.measures import active_flag, unit_delta
from strata.functions.text import last_token, normalize_name
from strata.functions.time import (
    epoch_micros,
    epoch_seconds,
    hours_between,
    parse_timestamp,
    timestamp_from_parts,
    year_range,
)

__all__ = [
    "active_flag",
    "epoch_micros",
    "epoch_seconds",
    "hours_between",
    "last_token",
    "normalize_name",
    "parse_timestamp",
    "timestamp_from_parts",
    "unit_delta",
    "year_range",
]
