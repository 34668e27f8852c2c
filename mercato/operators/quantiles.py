"""Exact, linearly interpolated quantiles that never gather a group in one task.

The built-in exact percentile keeps a value-to-count map of the whole group in
one buffer.  Here the values are counted first (copies of one value collapse
before the shuffle), approximate quantiles cut each group into a few ranges,
each range is divided into equal slots, and only the slot that holds the wanted
rank is sorted.  The result is exact however good the cuts are; they only decide
how much is sorted.  The plan uses the cuts twice and both must be the same, so
they are written to the shared folder first.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mercato.session import settled

ACCURACY = 10_000
SLOTS = 512


def exact_quantiles(
    df: DataFrame,
    keys: list[str],
    value: str,
    probs: list[float],
    approx: bool = False,
    few_groups: bool = False,
    accuracy: int = ACCURACY,
) -> DataFrame:
    """One row per group and probability: keys, ``prob``, ``quantile`` (double).

    NULL values are ignored; a group without values has no rows.  ``approx``
    answers with ``percentile_approx`` in one pass.  ``few_groups`` is the
    caller's promise that the number of groups is fixed and small (such as the
    columns of a table): the cuts, a few numbers per group, are then broadcast.
    """
    base = df.select(*keys, F.col(value).cast("double").alias("_v")).where(F.col("_v").isNotNull())
    if approx:
        found = base.groupBy(*keys).agg(F.percentile_approx("_v", probs, accuracy).alias("_q"))
        pairs = F.arrays_zip(F.array(*[F.lit(float(p)) for p in probs]).alias("prob"), F.col("_q").alias("quantile"))
        return found.select(*keys, F.inline(pairs).alias("prob", "quantile"))

    margin = 2.0 / accuracy
    edges = sorted({round(min(max(p + d, 0.0), 1.0), 9) for p in probs for d in (-margin, margin)})
    cuts = base.groupBy(*keys).agg(
        F.percentile_approx("_v", edges, accuracy).alias("_cuts"), F.count("*").alias("_total")
    )
    counts = base.groupBy(*keys, "_v").agg(F.count("*").alias("_n"))

    ranges = settled(cuts.select(*[F.col(k).alias(f"_c_{k}") for k in keys], "_cuts", "_total"), "cuts")
    if few_groups:
        ranges = F.broadcast(ranges)
    on_key = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_c_{k}")) for k in keys])
    # Slots rise with the value inside a range; the open ranges at both ends,
    # which hold a wanted rank only if the cuts missed it, are one slot each.
    low, high = F.get("_cuts", F.col("_range") - 1), F.get("_cuts", F.col("_range"))
    slot = F.least(F.floor((F.col("_v") - low) / F.nullif(high - low, F.lit(0.0)) * SLOTS), F.lit(SLOTS - 1))
    placed = (
        counts.join(ranges, on_key)
        .withColumn("_range", F.size(F.filter("_cuts", lambda c: c < F.col("_v"))))
        .withColumn("_slot", F.col("_range") * SLOTS + F.coalesce(slot.cast("int"), F.lit(0)))
        .select(*keys, "_v", "_n", "_total", "_slot")
    )

    # At most SLOTS * (2 * len(probs) + 1) slots per group, so this window is small.
    before = Window.partitionBy(*keys).orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    ranks = F.array(
        *[F.struct(F.lit(float(p)).alias("prob"), (F.lit(float(p)) * (F.col("_total") - 1)).alias("rank")) for p in probs]
    )
    wanted = (
        placed.groupBy(*keys, "_slot")
        .agg(F.sum("_n").alias("_size"), F.max("_total").alias("_total"))
        .withColumn("_start", F.coalesce(F.sum("_size").over(before), F.lit(0)))
        .withColumn(
            "_ranks",
            F.filter(
                ranks,
                lambda r: ((F.floor(r["rank"]) >= F.col("_start")) & (F.floor(r["rank"]) < F.col("_start") + F.col("_size")))
                | ((F.ceil(r["rank"]) >= F.col("_start")) & (F.ceil(r["rank"]) < F.col("_start") + F.col("_size"))),
            ),
        )
        .where(F.size("_ranks") > 0)
        .select(*[F.col(k).alias(f"_w_{k}") for k in keys], F.col("_slot").alias("_w_slot"), "_start", "_ranks")
    )

    if few_groups:
        wanted = F.broadcast(wanted)
    on_range = reduce(
        lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_w_{k}")) for k in keys], F.col("_slot") == F.col("_w_slot")
    )
    upto = Window.partitionBy(*keys, "_slot").orderBy("_v")
    located = (
        placed.join(wanted, on_range)
        .withColumn("_last", F.col("_start") + F.sum("_n").over(upto.rowsBetween(Window.unboundedPreceding, 0)) - 1)
        .withColumn("_first", F.col("_last") - F.col("_n") + 1)
        .select(*keys, "_v", "_first", "_last", F.inline("_ranks"))
    )
    low, high = F.floor("rank"), F.ceil("rank")
    return (
        located.groupBy(*keys, "prob")
        .agg(
            F.max(F.when(low.between(F.col("_first"), F.col("_last")), F.col("_v"))).alias("_low"),
            F.max(F.when(high.between(F.col("_first"), F.col("_last")), F.col("_v"))).alias("_high"),
            F.max(F.col("rank") - low).alias("_part"),
        )
        .select(*keys, "prob", (F.col("_low") + (F.col("_high") - F.col("_low")) * F.col("_part")).alias("quantile"))
    )


def quantile_columns(quantiles: DataFrame, keys: list[str], names: dict[float, str]) -> DataFrame:
    """Turn the long result into one column per probability."""
    return quantiles.groupBy(*keys).agg(
        *[F.max(F.when(F.col("prob") == F.lit(float(p)), F.col("quantile"))).alias(n) for p, n in names.items()]
    )
