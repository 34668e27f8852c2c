"""Counting and unpivoting helpers behind the exploratory jobs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mercato.functions.numeric import percent
from mercato.functions.ordering import top_k


def literal_rows(spark: SparkSession, names: list[str], rows: list[tuple]) -> DataFrame:
    """A small table of constants whose size the optimizer knows."""
    structs = [F.struct(*[F.lit(v).alias(n) for n, v in zip(names, row)]) for row in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))


def value_counts(df: DataFrame, *columns: str, name: str = "n") -> DataFrame:
    """Rows per distinct value, NULL values left out."""
    kept = df
    for column in columns:
        kept = kept.where(F.col(column).isNotNull())
    return kept.groupBy(*columns).agg(F.count("*").alias(name))


def top_values(df: DataFrame, column: str, n: int | None = None) -> DataFrame:
    """Value counts, most frequent first; ``n`` keeps the head."""
    counts = value_counts(df, column)
    if n is None:
        return counts.orderBy(F.col("n").desc(), F.col(column).asc())
    return top_k(counts, n, [F.col("n").desc()], [column])


def with_share(counts: DataFrame, digits: int, name: str = "share_pct", count: str = "n") -> DataFrame:
    """Add each row's percentage of the total; the total is a scalar subquery."""
    total = counts.agg(F.sum(count)).scalar()
    return counts.withColumn(name, percent(F.col(count), total, digits))


def as_text(df: DataFrame, column: str) -> Column:
    """A column as text, timestamps in a fixed format."""
    kind = df.schema[column].dataType
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.date_format(F.col(column), "yyyy-MM-dd HH:mm:ss")
    if isinstance(kind, T.VariantType):
        return F.to_json(F.col(column))
    return F.col(column).cast("string")


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def unpivot(values: dict[str, Column], df: DataFrame, name: str = "column", value: str = "value") -> DataFrame:
    """One row per source row and named column."""
    pairs = F.array(*[F.struct(F.lit(k).alias(name), v.alias(value)) for k, v in values.items()])
    return df.select(F.inline(pairs).alias(name, value))


def unpivot_row(row: DataFrame, names: list[str], label: str, **measures: str) -> DataFrame:
    """Turn a one-row aggregate with ``<prefix><name>`` columns into one row per name."""
    structs = [
        F.struct(F.lit(n).alias(label), *[F.col(f"{prefix}{n}").alias(out) for out, prefix in measures.items()])
        for n in names
    ]
    return row.select(F.inline(F.array(*structs)))
