"""Events followed by others near in place and time.

For each event of a first kind: how many events of a second kind happen within
a distance of it and within a time after it, and the nearest one's distance. It
is not computed by pairs of events:

1. Both sides are reduced to distinct (place, instant), so events at one spot
   and moment are one row with a count.
2. Time is cut into blocks as long as the time window; a window beginning in a
   block ends in the next one. Distinct places active in a block are joined with
   the other side's places of that block and the next, by grid cell: a place is
   in one cell, and asks all cells that its circle touches. Cells are as high
   as the radius and as wide as it at their latitude, so a circle touches a few
   cells in each of three bands; wrapping at 180 degrees and circles over a pole are
   covered. The exact great-circle distance decides.
3. A cell with more asking places than ``dense`` is split by a hash of the
   place, its other side repeated for each part.
4. Each asking place now has a timeline per block: the instants of its near
   places, with counts and least distance. The part of a window in its own block
   is a running total backwards in time, the part in the next block one forwards
   (see ``running``), so a spot with many events costs time in proportion to
   them, not to their pairs.

The join makes one row per pair of near places in neighbouring blocks of time.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.time import epoch_micros
from strata.operators.running import running
from strata.sources.files import materialize

EARTH_KM = 6371.0088
# Places asking in one cell and block, above which the cell is split.
DENSE = 10_000
# Margin for rounding in degrees, some 0.1 mm.
_MARGIN = 1e-9


def great_circle_km(lat: Column, lon: Column, lat2: Column, lon2: Column) -> Column:
    """Haversine distance of two places in degrees."""
    a, b = F.radians(lat), F.radians(lat2)
    half = F.pow(F.sin((b - a) / 2), 2) + F.cos(a) * F.cos(b) * F.pow(F.sin((F.radians(lon2) - F.radians(lon)) / 2), 2)
    return F.asin(F.least(F.lit(1.0), F.sqrt(half))) * (2 * EARTH_KM)


def _spot(df: DataFrame, time: str, lat: str, lon: str) -> list[Column]:
    """``lat, lon, t`` of a row, null where they aren't on the globe; longitudes
    from -180 up to 180. NaN is larger than all numbers, so it goes too."""
    y, x = F.col(lat).cast("double"), F.col(lon).cast("double")
    x = F.when(F.abs(x) < 1e9, x)
    return [
        F.when((y >= -90) & (y <= 90), y).alias("lat"),
        (x - F.floor((x + 180) / 360) * 360).alias("lon"),
        epoch_micros(time, df.schema[time].dataType).alias("t"),
    ]


def _places(df: DataFrame, time: str, lat: str, lon: str) -> DataFrame:
    """The spots of the rows that have one."""
    return df.select(*_spot(df, time, lat, lon)).dropna()


def _n_cells(band: Column, step: float) -> Column:
    """Number of cells of a band of latitude, each at least as wide as high."""
    edge = F.greatest(F.abs(band * step - 90), F.abs((band + 1) * step - 90))
    return F.greatest(F.floor(F.cos(F.radians(F.least(edge, F.lit(90.0)))) * 360 / step), F.lit(1).cast("long"))


def _cell(lon: Column, n: Column) -> Column:
    return F.floor((lon + 180) / 360 * n)


def _in_cell(places: DataFrame, step: float) -> DataFrame:
    placed = places.withColumn("band", F.floor((F.col("lat") + 90) / step))
    n = _n_cells(F.col("band"), step)
    return placed.withColumn("cell", F.least(_cell(F.col("lon"), n), n - 1))


def _asking_cells(places: DataFrame, step: float, radius: float) -> DataFrame:
    """One row per cell that the circle around a place touches."""
    first = F.greatest(F.floor((F.col("lat") - step + 90 - _MARGIN) / step), F.lit(0).cast("long"))
    last = F.floor((F.col("lat") + step + 90 + _MARGIN) / step)
    rows = places.withColumn("band", F.explode(F.sequence(first, last)))
    over_pole = F.abs("lat") + step + _MARGIN >= 90
    wide = F.degrees(F.asin(F.least(F.lit(1.0), F.lit(math.sin(radius)) / F.cos(F.radians("lat"))))) + _MARGIN
    rows = rows.withColumns({"n": _n_cells(F.col("band"), step), "wide": F.when(over_pole, F.lit(360.0)).otherwise(wide)})
    low, high = _cell(F.col("lon") - F.col("wide"), F.col("n")), _cell(F.col("lon") + F.col("wide"), F.col("n"))
    every = F.sequence(F.lit(0).cast("long"), F.col("n") - 1)
    some = F.transform(F.sequence(low, high), lambda c: F.pmod(c, F.col("n")))
    cells = F.when(high - low + 1 >= F.col("n"), every).otherwise(some)
    return rows.withColumn("cell", F.explode(cells)).drop("n", "wide")


def near_followers(
    firsts: DataFrame,
    thens: DataFrame,
    first: tuple[str, str, str],
    then: tuple[str, str, str],
    radius_km: float,
    within_seconds: int,
    count_as: str = "followers",
    nearest_as: str = "nearest_km",
    decimals: int = 3,
    dense: int = DENSE,
    ranges: int | None = None,
) -> DataFrame:
    """``firsts`` with the number of ``thens`` at most ``radius_km`` away and
    later by at most ``within_seconds`` (and by more than nothing), and the
    distance of the nearest of them, rounded; null without any.

    ``first`` and ``then`` name each side's time, latitude and longitude (in
    degrees; longitudes are taken modulo 360). Rows without a time, or with a
    place that is null, not finite or beyond a pole, keep their row with 0 and
    null, and follow nothing.
    """
    if not 0 < radius_km <= EARTH_KM * math.pi:
        raise ValueError(f"radius_km must be above 0 and at most half the globe's girth, not {radius_km!r}")
    window = int(within_seconds) * 1_000_000
    if window <= 0:
        raise ValueError("within_seconds must be positive")
    radius = radius_km / EARTH_KM
    step = math.degrees(radius)
    block = F.floor(F.col("t") / F.lit(window))
    asked = materialize(_places(firsts, *first).distinct().withColumn("block", block), "near-firsts")
    given = _places(thens, *then).groupBy("lat", "lon", "t").agg(F.count(F.lit(1)).alias("n"))
    given = materialize(given.withColumn("block", block), "near-thens")

    asking = _asking_cells(asked.select("lat", "lon", "block").distinct(), step, radius)
    asking = asking.withColumn("half", F.explode(F.array(F.lit(0), F.lit(1)))).withColumn("then_block", F.col("block") + F.col("half"))
    asking = materialize(asking, "near-asking")
    spot = ["band", "cell", "then_block"]
    crowds = asking.groupBy(*spot).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > dense)
    parts = materialize(crowds.select(*spot, F.ceil(F.col("n") / dense).cast("int").alias("parts")), "near-dense")
    one = F.coalesce("parts", F.lit(1))
    asking = asking.join(parts, spot, "left").withColumn("part", F.pmod(F.xxhash64("lat", "lon", "block"), one.cast("long")).cast("int"))
    there = _in_cell(given.select("lat", "lon", "block").distinct(), step)
    there = there.select("band", "cell", F.col("block").alias("then_block"), F.col("lat").alias("then_lat"), F.col("lon").alias("then_lon"))
    there = there.join(parts, spot, "left").withColumn("part", F.explode(F.sequence(F.lit(0), one - 1)))
    near = asking.drop("parts").join(there.drop("parts"), [*spot, "part"])
    near = near.withColumn("km", great_circle_km(F.col("lat"), F.col("lon"), F.col("then_lat"), F.col("then_lon")))
    line = ["lat", "lon", "block", "half"]
    near = near.filter(F.col("km") <= radius_km).select(*line, "then_lat", "then_lon", "then_block", "km")
    near = materialize(near, "near-places")

    # Backwards in the window's own block, forwards in the next; an instant asks
    # before equal times there (it isn't followed by them) and after them here.
    back = F.col("half") == 0
    instants = given.select(F.col("lat").alias("then_lat"), F.col("lon").alias("then_lon"), F.col("block").alias("then_block"), "t", "n")
    times = near.join(instants, ["then_lat", "then_lon", "then_block"]).groupBy(*line, "t").agg(
        F.sum("n").alias("n"), F.min("km").alias("km")
    )
    times = times.select(*line, F.when(back, -F.col("t")).otherwise(F.col("t")).alias("at"), F.when(back, 1).otherwise(0).alias("turn"), "n", "km")
    asks = asked.withColumn("half", F.explode(F.array(F.lit(0), F.lit(1)))).join(near.select(*line).distinct(), line, "left_semi")
    asks = asks.select(
        *line,
        F.when(back, -F.col("t")).otherwise(F.col("t") + window).alias("at"),
        F.when(back, 0).otherwise(1).alias("turn"),
        F.lit(0).cast("long").alias("n"),
        F.lit(None).cast("double").alias("km"),
        F.col("t").alias("asked"),
    )
    events = times.withColumn("asked", F.lit(None).cast("long")).unionByName(asks)
    seen = running(events, line, ["at", "turn"], {"many": ("sum", "n"), "least": ("min", "km")}, ranges)
    found = seen.filter(F.col("asked").isNotNull()).groupBy("lat", "lon", "asked").agg(
        F.sum("many").alias("__many"), F.min("least").alias("__least")
    )
    found = found.select(F.struct("lat", "lon", F.col("asked").alias("t")).alias("__spot"), "__many", "__least")
    rows = firsts.withColumn("__own", F.struct(*_spot(firsts, *first))).join(found, F.col("__own") == F.col("__spot"), "left")
    return rows.select(
        *firsts.columns, F.coalesce("__many", F.lit(0)).cast("long").alias(count_as), F.round("__least", decimals).alias(nearest_as)
    )
