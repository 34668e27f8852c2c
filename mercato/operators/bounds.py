"""Partitions by FROM and TO bounds of any width: which one a row is in, and what the bounds leave out.

A bound table has ``name``, ``low`` (included) and ``high`` (excluded).  A null ``low`` or
``high`` is open.  Rows in no range are in ``default``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mercato.operators.ranks import order_number

DEFAULT = "default"
#: Up to so many bounds become one sorted array beside the rows; more are joined.
SMALL = 10_000
#: Buckets that the joined bounds are cut into.
BUCKETS = 4096


def bound_problems(bounds: DataFrame) -> DataFrame:
    """Gaps and overlaps between neighbouring ranges, and ranges that hold nothing: ``problem``, ``name``, ``next_name``, ``low``, ``high``.

    A gap is reported with its own ends, an overlap with the ends that both ranges share.
    The bounds are one row per partition of a table, so one task orders them.
    """
    order = Window.orderBy(F.col("low").asc_nulls_first(), "name")
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    holds = bounds.where("low IS NULL OR high IS NULL OR low < high")
    # The furthest end so far, not the last one: a short range may lie inside a long one.
    ends = holds.withColumn("_open", F.bool_or(F.col("high").isNull()).over(so_far)).withColumn("_end", F.max("high").over(so_far))
    pairs = ends.select(
        "name", "_open", "_end", F.lead("name").over(order).alias("next_name"), F.lead("low").over(order).alias("_next"),
        F.lead("high").over(order).alias("_next_high"),
    ).where("next_name IS NOT NULL")
    overlap = F.col("_open") | F.col("_next").isNull() | (F.col("_next") < F.col("_end"))
    shared = F.when(F.col("_open"), F.col("_next_high")).otherwise(F.least("_end", F.coalesce("_next_high", "_end")))
    found = pairs.select(
        F.when(overlap, "overlap").when(F.col("_next") > F.col("_end"), "gap").alias("problem"), "name", "next_name",
        F.when(overlap, F.col("_next")).otherwise(F.col("_end")).alias("low"), F.when(overlap, shared).otherwise(F.col("_next")).alias("high"),
    ).where("problem IS NOT NULL")
    empty = bounds.where("low >= high").select(F.lit("empty").alias("problem"), "name", F.lit(None).cast("string").alias("next_name"), "low", "high")
    return found.unionByName(empty)


def assign_ranges(df: DataFrame, column: str, bounds: DataFrame, name: str = "part", small: int = SMALL) -> DataFrame:
    """``df`` with the ``name`` of the range that holds each row's value; NULL values and values in no range get ``default``.

    Overlapping ranges are an error, as a row would be in two partitions.  Up to ``small``
    bounds travel as one sorted array that each row searches by halves; beyond, ranges
    and rows meet by bucket in a join, so the number of bounds is open.
    """
    holds = bounds.where("low IS NULL OR high IS NULL OR low < high")
    clash = bound_problems(holds).where("problem = 'overlap'").first()
    if clash is not None:
        raise ValueError(f"ranges {clash['name']} and {clash['next_name']} overlap")
    n = holds.limit(small + 1).count()
    found = _searched(df, column, holds, n) if n <= small else _joined(df, column, holds)
    return found.select(*df.columns, F.coalesce("_range_name", F.lit(DEFAULT)).alias(name))


def _searched(df: DataFrame, column: str, bounds: DataFrame, n: int) -> DataFrame:
    one = F.struct(F.col("low").isNotNull().alias("from"), "low", F.col("high").isNotNull().alias("to"), "high", "name")
    table = bounds.agg(F.sort_array(F.collect_list(one)).alias("b")).scalar()
    value, at = F.col(column), lambda i: F.get("_range_all", i)
    steps = F.array(*[F.lit(1 << b) for b in reversed(range(max(1, n).bit_length()))])
    begun = lambda i: (i < n) & (~at(i)["from"] | (at(i)["low"] <= value))
    last = F.aggregate(steps, F.lit(-1), lambda i, half: F.when(begun(i + half), i + half).otherwise(i))
    placed = df.withColumn("_range_all", table).withColumn("_range_at", last)
    found = placed.withColumn("_range", F.when(F.col("_range_at") >= 0, at(F.col("_range_at"))))
    inside = value.isNotNull() & (~F.col("_range.to") | (value < F.col("_range.high")))
    return found.withColumn("_range_name", F.when(inside, F.col("_range.name")))


def _joined(df: DataFrame, column: str, bounds: DataFrame) -> DataFrame:
    kind = bounds.schema["low"].dataType
    ends = bounds.select(F.explode(F.array("low", "high")).alias("v")).agg(
        F.min(order_number("v", kind)).alias("first"), F.max(order_number("v", kind)).alias("last")
    )
    first, last = ends.select("first").scalar(), ends.select("last").scalar()
    place = lambda c: F.floor((order_number(c, kind) - first) / F.nullif(last - first, F.lit(0.0)) * BUCKETS)
    bucket = lambda c: F.least(F.greatest(F.coalesce(place(c), F.lit(0)), F.lit(-1)), F.lit(BUCKETS + 1))
    # Ranges share no value, so together they cover their number and BUCKETS buckets at most.
    covered = F.sequence(
        F.when(F.col("low").isNull(), -1).otherwise(bucket("low")), F.when(F.col("high").isNull(), BUCKETS + 1).otherwise(bucket("high"))
    )
    ranges = bounds.select(
        F.col("low").alias("_range_low"), F.col("high").alias("_range_high"), F.col("name").alias("_range_name"), F.explode(covered).alias("_range_bucket")
    )
    rows = df.withColumn("_range_key", F.when(F.col(column).isNotNull(), bucket(column)))
    value, low, high = F.col(column), F.col("_range_low"), F.col("_range_high")
    inside = (F.col("_range_key") == F.col("_range_bucket")) & (low.isNull() | (low <= value)) & (high.isNull() | (value < high))
    # The rows are on the outer side, where a hot bucket can be split.
    return rows.join(ranges, inside, "left")


def range_counts(df: DataFrame, column: str, bounds: DataFrame) -> DataFrame:
    """Rows in each range, ranges without rows and ``default`` included."""
    counts = assign_ranges(df.select(column), column, bounds).groupBy("part").agg(F.count("*").alias("row_count"))
    parts = bounds.select(F.col("name").alias("part")).unionByName(bounds.sparkSession.range(1).select(F.lit(DEFAULT).alias("part")))
    return parts.join(counts, "part", "left").select("part", F.coalesce("row_count", F.lit(0)).alias("row_count"))
