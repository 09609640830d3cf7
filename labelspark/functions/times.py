"""Time conversions.  Times in the data are integer milliseconds, UTC."""

from __future__ import annotations

from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EPOCH = datetime(1970, 1, 1)
DAY_MS = 86_400_000

# The bounds of a 64-bit time, and of what a timestamp or day can hold.
LEAST, MOST = -(2**63), 2**63 - 1
FIRST_MS, LAST_MS = ((t - EPOCH) // timedelta(milliseconds=1) for t in (datetime.min, datetime.max))


def from_millis(ms: Column) -> Column:
    return F.timestamp_millis(ms)


def from_seconds(seconds: Column) -> Column:
    return F.timestamp_seconds(seconds)


def to_millis(ts: Column) -> Column:
    """Milliseconds of a TIMESTAMP_NTZ, rounded down, whatever the session time zone."""
    since = ts - ntz(0)
    return floor_div(F.call_function("div", since, F.expr("interval '0.000001' second")), 1000)


def ntz(ms: int) -> Column:
    """A TIMESTAMP_NTZ literal, for filters that reach a scan."""
    moment = EPOCH + timedelta(milliseconds=ms)
    return F.lit(moment.isoformat(sep=" ", timespec="milliseconds")).cast("timestamp_ntz")


def day_of(ms: Column) -> Column:
    """The UTC day of a millisecond time."""
    return F.date_from_unix_date(floor_div(ms, DAY_MS).cast("int"))


def floor_div(value: Column, by: int | Column) -> Column:
    """Integer division rounded down, also below zero."""
    by = F.lit(by).cast("bigint") if isinstance(by, int) else by
    return F.call_function("div", value - F.pmod(value, by), by)


def ceil_div(value: Column, by: int | Column) -> Column:
    return -floor_div(-value, by)


def bounded(df: DataFrame, after: int | None, until: int | None) -> DataFrame:
    """Samples with a time in ``(after, until]``; an end that is None or at the bound of a 64-bit number is open.

    The same is said of a raw timestamp column ``ts`` and of a partition column
    ``day`` if the table has them, so that the scan can skip the rest.
    """
    start = None if after is None or after < LEAST else after + 1
    end = None if until is None or until >= MOST else until
    inside = []
    if start is not None:
        inside.append(F.col("ts_ms") >= start if start <= MOST else F.lit(False))
    if end is not None:
        inside.append(F.col("ts_ms") <= end if end >= LEAST else F.lit(False))
    if "ts" in df.columns:
        if start is not None and FIRST_MS <= start <= LAST_MS:
            inside.append(F.col("ts") >= ntz(start))
        if end is not None and FIRST_MS <= end < LAST_MS:
            inside.append(F.col("ts") < ntz(end + 1))
    if "day" in df.columns:
        inside += days(start, end)
    return df.filter(reduce(Column.__and__, inside)) if inside else df


def days(start: int | None, end: int | None) -> list[Column]:
    """The days of a range, both ends included, as conditions on the column ``day``; open ends have none."""
    day, found = F.col("day"), []
    if start is not None and FIRST_MS <= start <= LAST_MS:
        found.append(day >= F.lit(EPOCH.date() + timedelta(days=start // DAY_MS)))
    if end is not None and FIRST_MS <= end <= LAST_MS:
        found.append(day <= F.lit(EPOCH.date() + timedelta(days=end // DAY_MS)))
    return found
