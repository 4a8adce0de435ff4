"""Day arithmetic and day filters that a Parquet scan can push down."""

from __future__ import annotations

from datetime import date, datetime
from zoneinfo import ZoneInfo

from pyspark.sql import Column, functions as F

LOCAL_ZONE = "Europe/Prague"


def local_today() -> date:
    """Calendar day in the zone the shops live in."""
    return datetime.now(ZoneInfo(LOCAL_ZONE)).date()


def as_day(as_of: date | Column | None) -> Column:
    """`as_of` as a date column: a given day, a scalar subquery, or today."""
    if as_of is None:
        as_of = local_today()
    return as_of if isinstance(as_of, Column) else F.lit(as_of)


def days_before(as_of: date | Column | None, days: int) -> Column:
    return F.date_sub(as_day(as_of), days)


def loaded_from(day: Column, name: str = "_timestamp") -> Column:
    """Load time on `day` or later. The column itself stays bare, so the scan gets the filter."""
    return F.col(name) >= day.cast("timestamp_ntz")


def loaded_after(day: Column, name: str = "_timestamp") -> Column:
    """Load day strictly after `day`."""
    return loaded_from(F.date_add(day, 1), name)


def text_day_from(day: Column, name: str = "date") -> Column:
    """ISO date text on `day` or later: comparing the whole text equals comparing its first ten characters."""
    return F.col(name) >= day.cast("string")
