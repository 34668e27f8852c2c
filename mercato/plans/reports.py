"""Report jobs on measured runs and on requirement checklists."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.functions.numeric import percent, round_half_up
from mercato.functions.ordering import largest_first
from mercato.operators.ranks import running_numbers


SPACE = "disk_space_used_mb"
#: Runs whose times share one array, at most.
ARRAY_RUNS = 1000
# Where a plan in JSON has its times.
PLAN_TIMES = {"planning_times": "$[0]['Planning Time']", "execution_times": "$[0]['Execution Time']"}


def before_after(runs: DataFrame, keys: list[str]) -> DataFrame:
    """Average time before and after a change and the improvement in percent."""
    time = F.col("execution_ms")

    def average(phase: str):
        chosen = F.when(F.col("phase") == phase, time)
        return round_half_up(F.sum(chosen).cast("double") / F.count(chosen), 3)

    both = runs.groupBy(*keys).agg(
        F.count("*").alias("runs"), average("before").alias("time_before"), average("after").alias("time_after")
    )
    gain = percent(F.col("time_before") - F.col("time_after"), F.col("time_before"), 2)
    return both.withColumn("improvement_percentage", gain)


def optimization_summary(runs: DataFrame) -> DataFrame:
    """One row per category and technique with its effect, from measured runs.

    Space is not part of a timed run; a sheet that has it carries ``disk_space_used_mb``.
    """
    gains = before_after(runs, ["query_name", "technique"])
    return gains.select(
        F.col("query_name").alias("optimization_category"),
        F.col("technique").alias("technique_applied"),
        F.col("runs").alias("queries_affected"),
        F.col("improvement_percentage").alias("avg_improvement_pct"),
    )


def optimization_rollup(summary: DataFrame) -> DataFrame:
    """Techniques, queries, average improvement and, where the sheet has it, space per category."""
    gain = F.col("avg_improvement_pct")
    space = [F.round(F.sum(SPACE), 2).alias("total_space_mb")] if SPACE in summary.columns else []
    rollup = summary.groupBy("optimization_category").agg(
        F.count("*").alias("techniques_count"),
        F.sum("queries_affected").alias("total_queries_optimized"),
        round_half_up(F.sum(gain).cast("double") / F.count(gain), 2).alias("avg_improvement"),
        *space,
    )
    return rollup.orderBy(largest_first("avg_improvement"), "optimization_category")


def optimization_detail(summary: DataFrame) -> DataFrame:
    """One line per technique with units written out, best improvement first."""
    ordered = summary.orderBy(
        F.col("avg_improvement_pct").desc_nulls_first(), "optimization_category", "technique_applied"
    )
    space = F.concat(F.col(SPACE).cast("decimal(12,2)").cast("string"), F.lit(" MB")).alias("space_cost") if SPACE in summary.columns else None
    return ordered.select(
        "optimization_category",
        "technique_applied",
        "queries_affected",
        F.concat(F.col("avg_improvement_pct").cast("decimal(12,2)").cast("string"), F.lit("%")).alias("improvement"),
        *([space] if space is not None else []),
    )


def completion_rate(checklist: DataFrame, done: str) -> DataFrame:
    """Requirements, how many have the status ``done``, and the percentage."""
    met = F.sum(F.when(F.col("status") == done, 1).otherwise(0))
    return checklist.agg(
        F.count("*").alias("total_requirements"),
        met.alias("completed"),
        percent(met, F.count("*"), 2).alias("completion_percentage"),
    )


def checklist_detail(checklist: DataFrame) -> DataFrame:
    """The checklist in requirement order."""
    return checklist.orderBy("requirement_id")


def timing_stats(runs: DataFrame, keys: list[str], value: str = "execution_ms") -> DataFrame:
    """Average, minimum, maximum and sample deviation of run times."""
    time = F.col(value)
    return runs.groupBy(*keys).agg(
        F.count(time).alias("runs"),
        round_half_up(F.sum(time).cast("double") / F.count(time), 3).alias("avg_time"),
        F.round(F.min(time), 3).alias("min_time"),
        F.round(F.max(time), 3).alias("max_time"),
        round_half_up(F.stddev_samp(time.cast("double")), 3).alias("stddev_time"),
    )


def timing_arrays(plans: DataFrame, keys: list[str], run: str, plan: str = "plan", array_runs: int = ARRAY_RUNS) -> DataFrame:
    """Times of repeated runs as arrays: one row per key and ``part`` of at most ``array_runs`` runs, in order of ``run``.

    ``plan`` is a VARIANT, an array whose first element has the times.  A key with very many runs has several parts.
    """
    numbered = running_numbers(plans, keys, [run], max(array_runs, 100_000)).withColumn("part", F.floor((F.col("number") - 1) / array_runs))
    times = [F.try_variant_get(plan, path, "double").alias(name) for name, path in PLAN_TIMES.items()]
    lists = numbered.groupBy(*keys, "part").agg(F.sort_array(F.collect_list(F.struct(run, *times))).alias("runs"))
    return lists.select(*keys, "part", *[F.col(f"runs.{name}").alias(name) for name in PLAN_TIMES])


def append_timings(arrays: DataFrame, plans: DataFrame, keys: list[str], plan: str = "plan") -> DataFrame:
    """``arrays`` with the times of one more run per key appended to the key's last part; ``plans`` has one row per key.

    A key without arrays gets its first part.
    """
    last = arrays.groupBy(*keys).agg(F.max("part").alias("part"))
    new = plans.select(*keys, *[F.try_variant_get(plan, path, "double").alias(f"_new_{name}") for name, path in PLAN_TIMES.items()], F.lit(True).alias("_has"))
    placed = new.join(last, keys, "left").withColumn("part", F.coalesce("part", F.lit(0).cast("long")))
    joined = arrays.join(placed, [*keys, "part"], "full_outer")
    longer = [
        F.when(F.col("_has"), F.array_append(F.coalesce(name, F.array().cast("array<double>")), F.col(f"_new_{name}"))).otherwise(F.col(name)).alias(name)
        for name in PLAN_TIMES
    ]
    return joined.select(*keys, "part", *longer)


def array_timing_stats(arrays: DataFrame, keys: list[str]) -> DataFrame:
    """Average planning time and average, least, greatest and deviation of execution times, from the unnested arrays."""
    unnested = arrays.select(*keys, F.inline(F.arrays_zip(*PLAN_TIMES)).alias("planning", "execution"))
    mean = lambda c: round_half_up(F.sum(F.col(c).cast("decimal(20,6)")).cast("double") / F.count(c), 3)
    return unnested.groupBy(*keys).agg(
        F.count("execution").alias("runs"), mean("planning").alias("avg_planning"), mean("execution").alias("avg_execution"),
        F.round(F.min("execution"), 3).alias("min_execution"), F.round(F.max("execution"), 3).alias("max_execution"),
        round_half_up(F.stddev_samp("execution"), 3).alias("stddev_execution"),
    )
