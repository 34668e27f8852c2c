"""Registered report queries over timed runs taken from the event table."""

from __future__ import annotations

from pyspark.sql import functions as F

from mercato.checks.registry import check
from mercato.checks.sql import big, dbl, half_up, pct
from mercato.functions import jsonq
from mercato.plans import reports


def _mean(phase: str) -> str:
    time = f"CASE WHEN phase = '{phase}' THEN execution_ms END"
    return half_up(f"CAST(sum({time}) AS DOUBLE) / count({time})", 3)


def _gains(keys: str) -> str:
    return f"""SELECT *, {pct("(CAST(time_before AS DECIMAL(30,3)) - CAST(time_after AS DECIMAL(30,3)))", "time_before", 2)}
        AS improvement_percentage
    FROM (SELECT {keys}, count(*) AS runs, {_mean("before")} AS time_before, {_mean("after")} AS time_after
        FROM s_runs GROUP BY ALL)"""


@check("before_after", "s_runs", _gains("query_name"))
def _(m):
    return reports.before_after(m.runs, ["query_name"])


SUMMARY = f"""SELECT query_name AS optimization_category, technique AS technique_applied, runs AS queries_affected,
    improvement_percentage AS avg_improvement_pct
    FROM ({_gains("query_name, technique")})"""


@check("optimization_summary", "s_runs", SUMMARY)
def _(m):
    return reports.optimization_summary(m.runs)


@check(
    "optimization_rollup",
    "s_runs",
    f"""SELECT optimization_category, count(*) AS techniques_count, {big("sum(queries_affected)")} AS total_queries_optimized,
        {half_up("CAST(sum(CAST(avg_improvement_pct AS DECIMAL(20,2))) AS DOUBLE) / count(avg_improvement_pct)", 2)} AS avg_improvement
    FROM ({SUMMARY}) GROUP BY 1""",
)
def _(m):
    return reports.optimization_rollup(reports.optimization_summary(m.runs))


@check(
    "optimization_detail",
    "s_runs",
    f"""SELECT optimization_category, technique_applied, queries_affected,
        CAST(CAST(avg_improvement_pct AS DECIMAL(12,2)) AS VARCHAR) || '%' AS improvement FROM ({SUMMARY})""",
)
def _(m):
    return reports.optimization_detail(reports.optimization_summary(m.runs))


@check(
    "timing_stats",
    "s_runs",
    f"""SELECT query_name, phase, count(execution_ms) AS runs, {half_up("CAST(sum(execution_ms) AS DOUBLE) / count(execution_ms)", 3)}
        AS avg_time, {dbl("min(execution_ms)")} AS min_time, {dbl("max(execution_ms)")} AS max_time,
        {half_up("stddev_samp(CAST(execution_ms AS DOUBLE))", 3)} AS stddev_time FROM s_runs GROUP BY 1, 2""",
)
def _(m):
    return reports.timing_stats(m.runs, ["query_name", "phase"])


def _plans(m):
    """Each event as the plan of a run, its value as the execution time."""
    text = F.concat(F.lit('[{"Planning Time": '), F.col("value") / 8, F.lit(', "Execution Time": '), F.col("value"), F.lit(', "Plan": {}}]'))
    return m.table("events").select("event_type", "user_id", "event_id", jsonq.parsed(text).alias("plan"))


@check(
    "timing_arrays",
    "",
    """SELECT event_type, user_id, count(*) AS runs, CAST(list_extract(list(value ORDER BY event_id), 1) AS DOUBLE) AS first_time,
        CAST(max(value) AS DOUBLE) AS longest FROM events GROUP BY 1, 2""",
)
def _(m):
    arrays = reports.timing_arrays(_plans(m), ["event_type", "user_id"], "event_id")
    times = F.col("execution_times")
    return arrays.select("event_type", "user_id", F.size(times).cast("long").alias("runs"), F.get(times, F.lit(0)).alias("first_time"), F.array_max(times).alias("longest"))


@check(
    "append_timings",
    "",
    f"""SELECT event_type, count(value) AS runs, {half_up("CAST(sum(CAST(value / 8 AS DECIMAL(20,6))) AS DOUBLE) / count(value)", 3)} AS avg_planning,
        {half_up("CAST(sum(CAST(value AS DECIMAL(20,6))) AS DOUBLE) / count(value)", 3)} AS avg_execution, round(min(value), 3) AS min_execution,
        round(max(value), 3) AS max_execution, {half_up("stddev_samp(value)", 3)} AS stddev_execution FROM events GROUP BY 1""",
)
def _(m):
    """Arrays of all runs but the last of each event type and user, the last one appended, then unnested."""
    keys = ["event_type", "user_id"]
    plans = _plans(m)
    last = plans.groupBy(*keys).agg(F.max("event_id").alias("event_id"))
    arrays = reports.timing_arrays(plans.join(last, [*keys, "event_id"], "left_anti"), keys, "event_id", array_runs=5)
    whole = reports.append_timings(arrays, plans.join(last, [*keys, "event_id"], "left_semi"), keys)
    return reports.array_timing_stats(whole, ["event_type"])
