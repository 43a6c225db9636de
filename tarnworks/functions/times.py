"""Calendar helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def month_of(day: Column) -> Column:
    return F.trunc(day, "month")


def day_of(ts: Column) -> Column:
    return F.to_date(ts)


def is_weekend(day: Column) -> Column:
    """Saturday or Sunday (weekday() counts Monday as 0)."""
    return F.weekday(day) >= 5


def to_second(ts: Column) -> Column:
    return F.date_trunc("second", ts)


def or_now(moment: Column | None) -> Column:
    """The load time handed in, or the time the query starts."""
    return F.current_timestamp() if moment is None else moment
