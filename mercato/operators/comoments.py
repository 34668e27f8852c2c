"""Correlation as a state that merges: count, means and central sums of two numbers.

A state describes any set of rows; the states of two sets give the state of their
union, so runs of a file, files and tables need one pass over the rows and can be
kept and extended.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STATE = "struct<n:bigint,mean_x:double,mean_y:double,m2_x:double,m2_y:double,c_xy:double>"


def co_moments(df: DataFrame, keys: list[str], x: Column, y: Column) -> DataFrame:
    """One ``state`` per group over the rows that have both numbers."""
    both = df.select(*keys, x.cast("double").alias("_x"), y.cast("double").alias("_y")).where("_x IS NOT NULL AND _y IS NOT NULL")
    n = F.count(F.lit(1))
    state = F.struct(
        n.alias("n"), F.avg("_x").alias("mean_x"), F.avg("_y").alias("mean_y"),
        (F.var_pop("_x") * n).alias("m2_x"), (F.var_pop("_y") * n).alias("m2_y"), (F.covar_pop("_x", "_y") * n).alias("c_xy"),
    )
    return both.groupBy(*keys).agg(state.alias("state"))


def merged(a: Column, b: Column) -> Column:
    """The state of two disjoint sets of rows together."""
    n = a["n"] + b["n"]
    share = F.when(n > 0, b["n"] / n).otherwise(F.lit(0.0))
    dx, dy = b["mean_x"] - a["mean_x"], b["mean_y"] - a["mean_y"]
    weight = a["n"] * share
    return F.struct(
        n.alias("n"), (a["mean_x"] + dx * share).alias("mean_x"), (a["mean_y"] + dy * share).alias("mean_y"),
        (a["m2_x"] + b["m2_x"] + dx * dx * weight).alias("m2_x"), (a["m2_y"] + b["m2_y"] + dy * dy * weight).alias("m2_y"),
        (a["c_xy"] + b["c_xy"] + dx * dy * weight).alias("c_xy"),
    )


def merge_states(states: DataFrame, keys: list[str], order: str) -> DataFrame:
    """One state per group from those of its parts, which are few; ``order`` makes the result repeatable."""
    empty = F.struct(F.lit(0).cast("long").alias("n"), *[F.lit(0.0).alias(c) for c in ("mean_x", "mean_y", "m2_x", "m2_y", "c_xy")])
    parts = F.sort_array(F.collect_list(F.struct(F.col(order).alias("at"), "state")))
    whole = states.groupBy(*keys).agg(parts.alias("_parts"))
    return whole.select(*keys, F.aggregate("_parts", empty.cast(STATE), lambda a, p: merged(a, p["state"]).cast(STATE)).alias("state"))


def correlation(state: Column) -> Column:
    """Pearson's correlation; NULL where a side does not vary."""
    scale = F.sqrt(state["m2_x"]) * F.sqrt(state["m2_y"])
    return F.when(scale > 0, F.greatest(F.least(state["c_xy"] / scale, F.lit(1.0)), F.lit(-1.0)))
