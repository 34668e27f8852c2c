"""Distinct counts kept as state: one sketch per month and key, merged for any span of months.

A month is read once, when its sketch is made.  A sketch is a few kilobytes whatever
it counts; two of them merge into that of both months, so a span costs a row per month
and key.  Estimates are within about 2 % at the default sizes; exact counts
(`explore.relationship_cardinality`) stay the default elsewhere.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.operators.layout import MONTH, with_month

#: Base-2 logarithm of the registers of a sketch, and of the hashes that one for overlaps keeps.
REGISTERS, HASHES = 14, 14


def monthly_sketches(df: DataFrame, ts_col: str, keys: list[str]) -> DataFrame:
    """One row per month and key: ``rows`` that have the key, ``hll`` and ``theta`` sketches of its values.

    Values of a key column count by their text, so keys of two tables can be compared
    whatever their types.  Map tasks sketch before the shuffle.
    """
    rows = with_month(df, ts_col)
    pairs = F.array(*[F.struct(F.lit(k).alias("key"), F.col(k).cast("string").alias("value")) for k in keys])
    long = rows.select(MONTH, F.inline(pairs)).where("value IS NOT NULL")
    return long.groupBy(MONTH, "key").agg(
        F.count("*").alias("rows"), F.hll_sketch_agg("value", REGISTERS).alias("hll"), F.theta_sketch_agg("value", HASHES).alias("theta")
    )


def distinct_in(sketches: DataFrame, first: str, last: str) -> DataFrame:
    """Rows and estimated distinct values of each key over the months ``first`` to ``last``, from the sketches alone."""
    span = sketches.where(F.col(MONTH).between(first, last))
    return span.groupBy("key").agg(
        F.sum("rows").alias("rows"), F.hll_sketch_estimate(F.hll_union_agg("hll")).alias("distinct_values"), F.count("*").alias("months")
    )


def overlap(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """Estimated distinct values of two keys, how many they share and how many each has alone; one row.

    ``left`` and ``right`` are sketch tables, filtered to the months wanted.
    """
    whole = lambda t, key, name: t.where(F.col("key") == key).agg(F.expr(f"theta_union_agg(theta, {HASHES})").alias(name))
    both = whole(left, left_key, "a").select("a", whole(right, right_key, "b").scalar().alias("b"))
    size = F.theta_sketch_estimate
    sizes = {
        "left_values": size("a"), "right_values": size("b"), "shared": size(F.expr("theta_intersection(a, b)")),
        "left_alone": size(F.expr("theta_difference(a, b)")), "right_alone": size(F.expr("theta_difference(b, a)")),
    }
    return reduce(lambda df, c: df.withColumn(*c), sizes.items(), both).drop("a", "b")
