"""Timestamp expressions: parsing, building from parts, epoch seconds, ranges."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, TimestampNTZType

from strata.schemas import PARTS_TIME_FORMAT, SECONDS_PER_HOUR


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


_NTZ_EPOCH = "1970-01-01 00:00:00"


def _ntz_epoch() -> Column:
    return F.lit(_NTZ_EPOCH).cast(TimestampNTZType())


def parse_timestamp(c: Column | str, fmt: str, ntz: bool = True) -> Column:
    """Parse text with a datetime pattern; text that does not match gives null.

    Patterns are strict about widths (``dd`` needs two digits, so ``1-1-2022``
    is null). ``try_to_timestamp`` keeps this null under ANSI mode instead of
    failing the job. The text has no zone, so by default the result is the
    wall-clock ``timestamp_ntz`` it spells, whatever the session zone: the
    text is read with an explicit UTC offset and its epoch microseconds are
    laid onto the wall-clock epoch (a cast from a zoned timestamp would move
    times inside a daylight-saving gap of the session zone). ``ntz=False``
    returns the session-zone instant instead. ``fmt`` must not contain a zone.
    """
    col = _col(c)
    if not ntz:
        return F.try_to_timestamp(col, F.lit(fmt))
    instant = F.try_to_timestamp(F.concat(col, F.lit(" +0000")), F.lit(f"{fmt} Z"))
    return F.timestamp_add("MICROSECOND", F.unix_micros(instant), _ntz_epoch())


def timestamp_from_parts(
    year: Column | str,
    month: Column | str,
    day: Column | str,
    hour: Column | str,
    minute: Column | str,
    ntz: bool = True,
) -> Column:
    """Build ``yyyy-MM-dd HH:mm`` text from integer parts and parse it.

    Month, day, hour and minute are left-padded to two characters (longer
    values are cut to two, e.g. 123 -> 12); a missing hour or minute becomes
    ``00``. A missing year, month or day leaves a gap in the text, which then
    does not parse: the result is null. Seconds are not used.
    """

    def two(c: Column | str) -> Column:
        return F.lpad(_col(c).cast("string"), 2, "0")

    date_text = F.concat_ws("-", _col(year).cast("string"), two(month), two(day))
    time_text = F.concat_ws(":", F.coalesce(two(hour), F.lit("00")), F.coalesce(two(minute), F.lit("00")))
    return parse_timestamp(F.concat_ws(" ", date_text, time_text), PARTS_TIME_FORMAT, ntz=ntz)


def _wall_clock_seconds_and_micros(col: Column) -> tuple[Column, Column]:
    """Whole seconds (rounded down) and the microsecond fraction of a wall-clock value.

    ``unix_timestamp`` reads a ``timestamp_ntz`` as it is, with no zone, but
    rounds toward zero; ``date_part('SECOND')`` gives the fraction. Functions
    that go through the session zone (casts, ``date_trunc``,
    ``timestamp_diff``) would move wall-clock times inside a daylight-saving
    gap of that zone.
    """
    whole = F.unix_timestamp(col)
    fraction = (F.date_part(F.lit("SECOND"), col) * F.lit(1_000_000)).cast("long") % F.lit(1_000_000)
    before_epoch = (col < _ntz_epoch()) & (fraction > 0)
    seconds = whole - F.when(before_epoch, F.lit(1)).otherwise(F.lit(0))
    return seconds, fraction


def epoch_seconds(c: Column | str, dtype: DataType | None = None) -> Column:
    """Whole seconds since the epoch, rounded down.

    For wall-clock input (``dtype`` is ``timestamp_ntz``) the count is taken
    on the wall clock itself, with no zone, so differences are exact and the
    value grows with the time; zoned input is an instant (``unix_seconds``).
    """
    col = _col(c)
    if isinstance(dtype, TimestampNTZType):
        return _wall_clock_seconds_and_micros(col)[0]
    return F.unix_seconds(col.cast("timestamp"))


def epoch_micros(c: Column | str, dtype: DataType | None = None) -> Column:
    """Microseconds since the epoch (wall clock for ``timestamp_ntz``, see above)."""
    col = _col(c)
    if isinstance(dtype, TimestampNTZType):
        seconds, fraction = _wall_clock_seconds_and_micros(col)
        return seconds * F.lit(1_000_000) + fraction
    return F.unix_micros(col.cast("timestamp"))


def hours_between(
    start: Column | str,
    stop: Column | str,
    decimals: int = 2,
    start_type: DataType | None = None,
    stop_type: DataType | None = None,
) -> Column:
    """``stop - start`` in hours from whole epoch seconds, rounded half up."""
    seconds = epoch_seconds(stop, stop_type) - epoch_seconds(start, start_type)
    return F.round((seconds / F.lit(SECONDS_PER_HOUR)).cast("double"), decimals)


def year_range(c: Column | str, first_year: int, last_year: int, dtype: DataType | None = None) -> Column:
    """``first_year <= year(c) <= last_year`` written as a half-open range.

    ``year(c)`` hides the column from the Parquet reader; two comparisons with
    literals of the column's own type are pushed to the scan. Null is dropped.
    """
    col = _col(c)
    target = dtype if dtype is not None else TimestampNTZType()
    low = F.lit(f"{first_year:04d}-01-01 00:00:00").cast(target)
    high = F.lit(f"{last_year + 1:04d}-01-01 00:00:00").cast(target)
    return (col >= low) & (col < high)
