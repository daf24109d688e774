"""Ranked counts, top-k and the detail and trend of the top keys.

Counting uses partial aggregation, so a key holding a large share of the rows
costs one pre-aggregated row per map task, never a skewed task. Top-k is
``orderBy().limit(k)``, which Spark runs as a per-partition heap merged in one
task of at most k rows per partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from strata.operators.joins import semi_join


def _summable(df: DataFrame, column: str) -> Column:
    """A measure ready to sum with nulls as 0: integral types widened to long
    (exact sums), fractional types kept as they are (never truncated)."""
    dtype = df.schema[column].dataType
    col = F.col(column).cast("long") if isinstance(dtype, IntegralType) else F.col(column)
    return F.coalesce(col, F.lit(0))


def hit_summary(df: DataFrame, key: str = "Country", count_alias: str = "hits") -> DataFrame:
    """Rows per key, most frequent first; equal counts ordered by key."""
    return (
        df.groupBy(key)
        .agg(F.count(F.lit(1)).alias(count_alias))
        .orderBy(F.col(count_alias).desc(), F.col(key).asc())
    )


def top_k(ranked: DataFrame, k: int = 3) -> DataFrame:
    """First ``k`` rows of an ordered frame (a top-k, not a sample)."""
    return ranked.limit(k)


def top_k_keys(df: DataFrame, key: str = "Country", k: int = 3, count_alias: str = "hits") -> DataFrame:
    """The ``k`` most frequent keys with their counts (ties broken by key)."""
    return top_k(hit_summary(df, key, count_alias), k)


def top_k_detail(
    df: DataFrame,
    key: str = "Country",
    k: int = 3,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """All rows of the ``k`` most frequent keys.

    A left-semi join by name against the k keys, not a self-join of the frame
    with a frame derived from it. Rows without a key take no place among the k.
    """
    top = top_k_keys(df.filter(F.col(key).isNotNull()), key, k).select(key)
    detail = semi_join(df, top, key, key)
    return detail.select(*(columns or df.columns))


def top_k_by_measure(
    df: DataFrame,
    key: str,
    measures: Sequence[str],
    k: int = 3,
    total_alias: str = "impact",
    aliases: Sequence[str] | None = None,
) -> DataFrame:
    """Keys ranked by the sum of several measures; nulls count as 0.

    Integral measures are summed as long; fractional ones keep their type.

    Returns per key the sum of each measure, their total and the row count,
    for the ``k`` keys with the largest total (ties by key).
    """
    names = list(aliases or measures)
    sums = [F.sum(_summable(df, m)).alias(n) for m, n in zip(measures, names)]
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("events"), *sums)
    total = sum((F.col(n) for n in names[1:]), F.col(names[0]))
    ranked = per_key.withColumn(total_alias, total).orderBy(F.col(total_alias).desc(), F.col(key).asc())
    return ranked.limit(k)


def top_k_trend(
    df: DataFrame,
    key: str = "Country",
    ts: str = "Timestamp",
    measures: Sequence[str] = ("Deaths",),
    k: int = 3,
    aliases: Sequence[str] | None = None,
) -> DataFrame:
    """Yearly totals of measures for the top-k keys, with the change per year.

    The change is against the previous calendar year: it is null where that
    year has no rows of the key (``lag`` over at most one row per year and
    key, so that window is small whatever the data volume).
    """
    names = list(aliases or measures)
    detail = top_k_detail(df, key, k)
    sums = [F.sum(_summable(detail, m)).alias(n) for m, n in zip(measures, names)]
    yearly = detail.groupBy(F.col(key), F.year(ts).alias("year")).agg(F.count(F.lit(1)).alias("events"), *sums)
    w = Window.partitionBy(key).orderBy("year")
    follows = F.lag("year").over(w) == F.col("year") - 1
    changes = {f"{n}_change": F.when(follows, F.col(n) - F.lag(n).over(w)) for n in names}
    return yearly.withColumns(changes)


def trend_break(df: DataFrame, key: str, ts: str, decimals: int = 6) -> DataFrame:
    """Per key, the year in which its yearly number of events changes level.

    The years from a key's first to its last event form a series (years without
    events are 0). Each split of it into years before and from some year on has
    an error, the sum of squared deviations from either part's mean; the year
    with the least error (rounded to ``decimals``; ties: the earliest) is
    ``break_year``. Also given: ``first_year``, ``last_year``, the means
    ``mean_before`` and ``mean_after``, ``error``, and ``error_without``, that of
    one mean for all years. A key with one year has null for the split.

    Sums of counts and of their squares up to each year give all errors at once,
    so a key costs time in proportion to its years. Events are counted with
    partial aggregation before any window; rows without a time don't count.
    """
    counts = df.filter(F.col(ts).isNotNull()).groupBy(F.struct(key).alias("_k"), F.year(ts).alias("_y")).agg(
        F.count(F.lit(1)).alias("_n")
    )
    span = counts.groupBy("_k").agg(F.min("_y").alias("_first"), F.max("_y").alias("_last"))
    years = span.withColumn("_y", F.explode(F.sequence("_first", "_last")))
    series = years.join(counts, ["_k", "_y"], "left").withColumn("_n", F.coalesce("_n", F.lit(0)).cast("double"))
    earlier = Window.partitionBy("_k").orderBy("_y").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("_k")
    series = series.withColumns({
        "_s": F.sum("_n").over(earlier),
        "_q": F.sum(F.col("_n") * F.col("_n")).over(earlier),
        "_ts": F.sum("_n").over(whole),
        "_tq": F.sum(F.col("_n") * F.col("_n")).over(whole),
    })
    before, after = (F.col("_y") - F.col("_first")).cast("double"), (F.col("_last") - F.col("_y") + 1).cast("double")
    rest = F.col("_ts") - F.col("_s")
    error = F.col("_q") - F.col("_s") * F.col("_s") / before + (F.col("_tq") - F.col("_q")) - rest * rest / after
    length = (F.col("_last") - F.col("_first") + 1).cast("double")
    plain = F.col("_tq") - F.col("_ts") * F.col("_ts") / length
    # The first year splits nothing.
    split = F.when(
        F.col("_y") > F.col("_first"),
        F.struct(
            F.round(error, decimals).alias("error"),
            F.col("_y").alias("year"),
            F.round(F.col("_s") / before, decimals).alias("mean_before"),
            F.round(rest / after, decimals).alias("mean_after"),
        ),
    )
    best = series.groupBy("_k").agg(
        F.min("_first").alias("first_year"),
        F.max("_last").alias("last_year"),
        F.min(split).alias("_best"),
        F.max(F.round(plain, decimals)).alias("error_without"),
    )
    return best.select(
        F.col("_k").getField(key).alias(key),
        "first_year",
        "last_year",
        F.col("_best.year").alias("break_year"),
        "_best.mean_before",
        "_best.mean_after",
        "_best.error",
        "error_without",
    )
