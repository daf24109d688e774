"""DataFrame operators (each returns a DataFrame; compose with ``transform``)."""

from strata.operators.charge import (
    attach_idle_time,
    match_start_messages,
    match_stop_with_start,
    with_total_energy,
    with_total_time,
)
from strata.operators.filters import (
    filter_complete_rows,
    filter_equals,
    filter_int_range,
    filter_measurand,
    filter_year_range,
)
from strata.operators.joins import match_all_cities, match_dimension, semi_join
from strata.operators.nearby import great_circle_km, near_followers
from strata.operators.nested import json_flatten
from strata.operators.ranking import (
    hit_summary,
    top_k,
    top_k_by_measure,
    top_k_detail,
    top_k_keys,
    top_k_trend,
    trend_break,
)
from strata.operators.relate import event_correlation, followed_within
from strata.operators.running import asof_join, running
from strata.operators.sessions import charging_boundaries, group_bounds, idle_time, running_group_id
from strata.operators.shaping import (
    capitalize_country,
    distinct_keys,
    make_country,
    make_timestamp,
    make_timestamp_from_parts,
)

__all__ = [
    "asof_join",
    "attach_idle_time",
    "capitalize_country",
    "charging_boundaries",
    "distinct_keys",
    "event_correlation",
    "filter_complete_rows",
    "filter_equals",
    "filter_int_range",
    "filter_measurand",
    "filter_year_range",
    "followed_within",
    "great_circle_km",
    "group_bounds",
    "hit_summary",
    "idle_time",
    "json_flatten",
    "make_country",
    "make_timestamp",
    "make_timestamp_from_parts",
    "match_all_cities",
    "match_dimension",
    "match_start_messages",
    "match_stop_with_start",
    "near_followers",
    "running",
    "running_group_id",
    "semi_join",
    "top_k",
    "top_k_by_measure",
    "top_k_detail",
    "top_k_keys",
    "top_k_trend",
    "with_total_energy",
    "with_total_time",
]
