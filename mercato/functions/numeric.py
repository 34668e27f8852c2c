"""Averages, shares and rounding with one fixed meaning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half_up(value: Column, digits: int) -> Column:
    """Round half away from zero on a decimal, never on a binary double."""
    return F.round(value.cast("decimal(30,10)"), digits)


def mean(value: Column, digits: int = 6) -> Column:
    """Average of the non-NULL values: exact sum first, one division at the end."""
    return round_half_up(F.sum(value).cast("double") / F.count(value), digits)


def percent(part: Column, whole: Column, digits: int) -> Column:
    """``100 * part / whole``; NULL when there is nothing to divide by."""
    return round_half_up(F.lit(100.0) * part.cast("double") / F.nullif(whole.cast("double"), F.lit(0.0)), digits)


def count_where(condition: Column) -> Column:
    """Rows on which the condition is true; false and NULL do not count."""
    return F.count(F.when(condition, F.lit(1)))
