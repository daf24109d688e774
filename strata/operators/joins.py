"""Dimension matching.

The reduced dimension is written once and joined without a hint: Spark knows
the written size in bytes and broadcasts it below
``autoBroadcastJoinThreshold``; beyond that the join is sort-merge, where AQE
splits skewed keys. So the dimension is computed once, whatever its size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.sources.files import materialize


def match_dimension(
    facts: DataFrame,
    dimension: DataFrame,
    fact_key: str,
    dim_key: str,
    output: Sequence[Column] | None = None,
    key_alias: str | None = None,
) -> DataFrame:
    """Facts whose ``fact_key`` is one of the dimension's ``dim_key`` values.

    The dimension is reduced to its distinct keys, so each fact matches at
    most once (an inner join against distinct keys is a left-semi join).
    ``output`` selects and names the result columns; ``key_alias`` adds the
    matched key under that name first.
    """
    keys = materialize(dimension.select(F.col(dim_key).alias("__dim_key")).distinct(), "dimension-keys")
    matched = facts.join(keys, F.col(fact_key) == F.col("__dim_key"), "left_semi")
    columns: list[Column] = []
    if key_alias:
        columns.append(F.col(fact_key).alias(key_alias))
    if output is None:
        # With a key alias the key is not repeated under its own name: names
        # differing only in case would be ambiguous and could not be written.
        output = [F.col(c) for c in facts.columns if not (key_alias and c == fact_key)]
    columns.extend(output)
    return matched.select(*columns)


def match_all_cities(
    facts: DataFrame,
    cities: DataFrame,
    fact_key: str,
    dim_key: str = "Country",
    city: str = "City",
) -> DataFrame:
    """Match facts against a per-city dimension without multiplying them.

    A plain join with a per-city table repeats each fact once per city of its
    country. Here the dimension is first aggregated per country (partial
    aggregation, one row per country), so each matching fact appears once,
    with ``n_cities`` (the repetition a plain join would produce) and the
    first and last city name in sort order. Facts of a country absent from
    the dimension, or with a null key, are dropped as in an inner join.
    """
    per_key = cities.groupBy(F.col(dim_key).alias("__dim_key")).agg(
        F.count(F.lit(1)).alias("n_cities"),
        F.min(city).alias("first_city"),
        F.max(city).alias("last_city"),
    )
    per_key = materialize(per_key.filter(F.col("__dim_key").isNotNull()), "dimension-cities")
    joined = facts.join(per_key, F.col(fact_key) == F.col("__dim_key"), "inner")
    return joined.drop("__dim_key")


def semi_join(facts: DataFrame, keys: DataFrame, fact_key: str, key: str) -> DataFrame:
    """Facts whose ``fact_key`` appears in ``keys[key]``; Spark picks the join by
    the size of ``keys``, which it knows for a limit or a written frame."""
    right = keys.select(F.col(key).alias("__semi_key"))
    return facts.join(right, F.col(fact_key) == F.col("__semi_key"), "left_semi")
