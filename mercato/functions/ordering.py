"""Orderings that spell out where NULLs go, and top-k with a full tie-break."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def newest_first(name: str) -> Column:
    """Descending with NULLs first, the relational default for DESC."""
    return F.col(name).desc_nulls_first()


def largest_first(name: str) -> Column:
    """Descending with NULLs last, the document-store order for DESC."""
    return F.col(name).desc_nulls_last()


def smallest_first(name: str) -> Column:
    """Ascending with NULLs last, the relational default for ASC."""
    return F.col(name).asc_nulls_last()


def top_k(df: DataFrame, n: int, order: list[Column], ties: list[str]) -> DataFrame:
    """First ``n`` rows under ``order``; ``ties`` makes the choice deterministic.

    Planned as TakeOrderedAndProject: each task keeps ``n`` rows.
    """
    return df.orderBy(*order, *[F.col(t).asc_nulls_last() for t in ties]).limit(n)
