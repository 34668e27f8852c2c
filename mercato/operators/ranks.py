"""Ranks and running numbers within groups, without sorting a group in one task.

Both work on two levels.  Each group is cut into slots whose order is that of the
rows; the rows of all earlier slots are counted, one number per slot, and only
within a slot are rows sorted.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mercato.session import settled

#: Slots that a group of values is cut into.
SLOTS = 256
#: Rows in one slot of a numbered group, about.
SLOT_ROWS = 100_000


def order_number(column: str, kind: T.DataType) -> Column:
    """A double that never falls where the value rises; equal values have equal ones, and so may close ones."""
    value = F.col(column)
    if isinstance(kind, (T.StringType, T.BinaryType)):
        # The first six bytes as one number, in the binary order in which texts compare.
        first = F.substring(value.cast("binary"), 1, 6)
        return F.conv(F.rpad(F.hex(first), 12, "0"), 16, 10).cast("double")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(value.cast("timestamp")).cast("double")
    if isinstance(kind, T.DateType):
        return F.unix_date(value).cast("double")
    if isinstance(kind, T.BooleanType):
        return value.cast("int").cast("double")
    return value.cast("double")


def cuts_below(cuts: Column, n: int, value: Column) -> Column:
    """How many of up to ``n`` sorted cuts are smaller than the value, by halves."""
    steps = F.array(*[F.lit(1 << b) for b in reversed(range(n.bit_length()))])
    below = lambda at: (at <= F.size(cuts)) & (F.get(cuts, at - 1) < value)
    return F.aggregate(steps, F.lit(0), lambda at, half: F.when(below(at + half), at + half).otherwise(at))


def _same(df: DataFrame, keys: list[str], prefix: str) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(prefix + k)) for k in keys])


def counts_before(df: DataFrame, keys: list[str], column: str) -> DataFrame:
    """Each distinct value of each group with its rows (``n``) and the rows of smaller values (``before``).

    Exact for any sortable type; NULL values are left out.  Copies of one value
    collapse before the shuffle, and approximate quantiles of the distinct values cut
    the group into `SLOTS` slots, so they decide how much is sorted but not the result.
    """
    kind = df.select(column).schema[0].dataType
    counts = df.where(F.col(column).isNotNull()).groupBy(*keys, column).agg(F.count("*").alias("n"))
    edges = [i / SLOTS for i in range(1, SLOTS)]
    cuts = counts.groupBy(*keys).agg(F.percentile_approx(order_number(column, kind), edges, 10 * SLOTS).alias("_cuts"))
    # Used twice below, and both uses must see the same cuts.
    ranges = settled(cuts.select(*[F.col(k).alias(f"_c_{k}") for k in keys], "_cuts"), "cuts")
    at = order_number(column, kind)
    placed = counts.join(ranges, _same(counts, keys, "_c_")).withColumn("_slot", cuts_below(F.col("_cuts"), SLOTS, at)).select(*keys, column, "n", "_slot")
    earlier = Window.partitionBy(*keys).orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        placed.groupBy(*keys, "_slot").agg(F.sum("n").alias("_size"))
        .withColumn("_start", F.coalesce(F.sum("_size").over(earlier), F.lit(0)))
        .select(*[F.col(k).alias(f"_s_{k}") for k in keys], F.col("_slot").alias("_s_slot"), "_start")
    )
    within = Window.partitionBy(*keys, "_slot").orderBy(column).rowsBetween(Window.unboundedPreceding, -1)
    before = F.col("_start") + F.coalesce(F.sum("n").over(within), F.lit(0))
    return placed.join(starts, _same(placed, keys, "_s_") & (F.col("_slot") == F.col("_s_slot"))).select(*keys, column, "n", before.alias("before"))


def running_numbers(df: DataFrame, keys: list[str], order: list[str], slot_rows: int = SLOT_ROWS) -> DataFrame:
    """``df`` with ``number``, 1, 2, 3 ... within each group.

    The order is that of a hash of ``order`` and then ``order`` itself: the same on every
    run, but of no meaning.  A group of more than ``slot_rows`` rows is dealt into
    slots by that hash, so one that holds a third of all rows is numbered by many tasks.
    Rows equal in ``order`` share a slot; name columns that tell rows apart.
    """
    sizes = df.groupBy(*keys).agg(F.ceil(F.count("*") / slot_rows).alias("_slots"))
    large = sizes.where("_slots > 1").select(*[F.col(k).alias(f"_c_{k}") for k in keys], "_slots")
    # Few groups are large: at most all rows over slot_rows.
    mixed = F.xxhash64(*order)
    placed = df.join(large, _same(df, keys, "_c_"), "left").withColumn("_slot", F.coalesce(F.pmod(mixed, F.col("_slots")), F.lit(0)))
    earlier = Window.partitionBy(*keys).orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        placed.where("_slots IS NOT NULL").groupBy(*keys, "_slot").agg(F.count("*").alias("_size"))
        .withColumn("_start", F.coalesce(F.sum("_size").over(earlier), F.lit(0)))
        .select(*[F.col(k).alias(f"_s_{k}") for k in keys], F.col("_slot").alias("_s_slot"), "_start")
    )
    row = F.row_number().over(Window.partitionBy(*keys, "_slot").orderBy(mixed, *order))
    numbered = placed.withColumn("_row", row).join(starts, _same(placed, keys, "_s_") & (F.col("_slot") == F.col("_s_slot")), "left")
    return numbered.select(*df.columns, (F.coalesce("_start", F.lit(0)) + F.col("_row")).alias("number"))
