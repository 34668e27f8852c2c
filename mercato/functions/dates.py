"""Date arithmetic with the three meanings of "whole days between" kept apart."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS_PER_DAY = 86_400_000_000


def as_date(as_of: str | dt.date | Column | None) -> Column:
    """The report date as a DATE column; today when none is given."""
    if as_of is None:
        return F.current_date()
    if isinstance(as_of, Column):
        return as_of
    return F.lit(str(as_of)).cast("date")


def as_timestamp(day: str | dt.date | dt.datetime | Column) -> Column:
    """A constant point in time without time zone, foldable so it can be pushed to the scan."""
    if isinstance(day, Column):
        return day.cast("timestamp_ntz")
    return F.lit(str(day)).cast("timestamp_ntz")


def days_trunc(later: Column, earlier: Column) -> Column:
    """Day field of the interval ``later - earlier``: truncates towards zero."""
    return F.extract(F.lit("DAY"), later - earlier)


def days_calendar(later: Column, earlier: Column) -> Column:
    """Difference of the two calendar dates, times of day ignored."""
    return F.datediff(later, earlier)


def days_floor(later: Column, earlier: Column) -> Column:
    """Whole days rounded down, so minus two days and one hour gives -3."""
    return F.floor(F.timestamp_diff("MICROSECOND", earlier, later) / F.lit(MICROS_PER_DAY)).cast("int")


def month_start(ts: Column) -> Column:
    """First instant of the month, still without time zone."""
    return F.date_trunc("month", ts).cast("timestamp_ntz")


def month_label(ts: Column) -> Column:
    """``yyyy_MM``, the value of the month partition column."""
    return F.date_format(ts, "yyyy_MM")
