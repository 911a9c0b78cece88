"""Date functions as Spark columns. The end of a date window is always a parameter."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import vocab


def spread_date(index: Column, total: Column, end_date: str, offset: int = 0, start_date: str = vocab.DATE_START) -> Column:
    """The date of the ``index``-th of ``total`` rows spread evenly over the window.

    Half days go to the even day.
    """
    start = F.lit(start_date).cast("date")
    span = F.datediff(F.lit(end_date).cast("date"), start)
    position = F.pmod(index + F.lit(offset), F.greatest(total, F.lit(1)))
    # the product can pass the 32-bit range long before the table is large
    days = F.bround(position.cast("double") * span / F.greatest(total - 1, F.lit(1)).cast("double"))
    return F.date_add(start, days.cast("int"))


def month_text(date: Column) -> Column:
    """``YYYY-MM`` of a date, timestamp or ISO date text."""
    return F.substring(date.cast("string"), 1, 7)


def in_month(date: Column, dtype: str, month: str) -> Column:
    """Half-open range for one month, comparable with the stored type so that the scan can skip."""
    year, number = (int(part) for part in month.split("-"))
    following = f"{year + number // 12:04d}-{number % 12 + 1:02d}-01"
    return (date >= F.lit(f"{month}-01").cast(dtype)) & (date < F.lit(following).cast(dtype))


def seconds_between(earlier: Column, later: Column) -> Column:
    """Seconds with microseconds. Taken from the interval, so that no time zone is involved."""
    gap = later - earlier
    part = lambda unit, size: F.extract(F.lit(unit), gap) * F.lit(size)
    return (part("DAY", 86400) + part("HOUR", 3600) + part("MINUTE", 60) + part("SECOND", 1)).cast("double")


def seconds_left(gap_seconds: Column, wait: int = vocab.COOLDOWN_SECONDS) -> Column:
    """Whole seconds until the wait is over, 0 if it is."""
    return F.when(gap_seconds < wait, F.floor(F.lit(wait) - gap_seconds)).otherwise(F.lit(0)).cast("long")


def is_expired(created: Column, as_of: Column, minutes: int = vocab.EXPIRY_MINUTES) -> Column:
    return as_of > created + F.expr(f"INTERVAL {minutes} MINUTES")
