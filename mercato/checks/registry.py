"""Collects the registered queries and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mercato.checks.market import Market
from mercato.checks.sql import over
from mercato.session import configure

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def plain(df: DataFrame) -> DataFrame:
    """Exchange types: decimals as doubles, dates as text."""
    columns = []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DecimalType):
            column = column.cast("double").alias(field.name)
        elif isinstance(field.dataType, T.DateType):
            column = column.cast("string").alias(field.name)
        columns.append(column)
    return df.select(*columns)


def check(name: str, views: str = "", sql: str | None = None):
    """Register a function of the marketplace views under a name."""

    def add(build: Callable[[Market], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return plain(build(Market(configure(spark), folder)))

        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = over(views, sql)
        return build

    return add
