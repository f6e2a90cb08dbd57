"""Elapsed time and time buckets on timestamps without a zone."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

ColumnOrName = Column | str
DAYS_PER_YEAR = 365.242


def col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def elapsed_seconds(start: ColumnOrName, end: ColumnOrName) -> Column:
    """Seconds from start to end with microseconds kept."""
    return F.timestamp_diff("MICROSECOND", col(start), col(end)) / F.lit(1e6)


def elapsed_hours(start: ColumnOrName, end: ColumnOrName) -> Column:
    return elapsed_seconds(start, end) / F.lit(3600.0)


def elapsed_days(start: ColumnOrName, end: ColumnOrName) -> Column:
    return elapsed_seconds(start, end) / F.lit(86400.0)


def elapsed_years(start: ColumnOrName, end: ColumnOrName) -> Column:
    return elapsed_days(start, end) / F.lit(DAYS_PER_YEAR)


def within_days(start: ColumnOrName, end: ColumnOrName, days: int) -> Column:
    """1 when end - start is below the interval (an end before the start counts), else 0; an unknown side gives 0."""
    near = (col(end) - col(start)) < F.make_dt_interval(F.lit(days))
    return F.when(near, F.lit(1)).otherwise(F.lit(0))


def bucket_index(ts: ColumnOrName, width_s: int) -> Column:
    """Number of the nearest bucket of `width_s` seconds; a tie goes to the even bucket."""
    return F.rint(elapsed_seconds(epoch(), ts) / F.lit(float(width_s))).cast("bigint")


def bucket_start(index: ColumnOrName, width_s: int) -> Column:
    zero = F.lit(0)
    return epoch() + F.make_dt_interval(zero, zero, zero, (col(index) * F.lit(width_s)).cast("decimal(18,6)"))


def micros(ts: ColumnOrName) -> Column:
    return F.timestamp_diff("MICROSECOND", epoch(), col(ts))
