import pytest
from pyspark.sql import functions as F

from mercato.plans import reports


@pytest.fixture(scope="module")
def summary(spark):
    # An example sheet of techniques.
    data = [
        ("rewriting", "common table expressions", 5, 45.00, 0.0),
        ("rewriting", "exists", 2, 38.00, 0.0),
        ("rewriting", "no functions in predicates", 3, 32.00, 0.0),
        ("inverted", "attribute search", 2, 88.00, 25.5),
        ("partial", "delivered orders", 5, 65.00, 18.3),
        ("partial", "premium items", 1, 55.00, 5.2),
        ("block range", "purchase time", 3, 42.00, 0.8),
        ("composite", "several columns", 4, 52.00, 35.0),
        ("partitioning", "months", 8, 68.00, 15.0),
    ]
    schema = """optimization_category STRING, technique_applied STRING, queries_affected INT, avg_improvement_pct DECIMAL(5,2),
        disk_space_used_mb DECIMAL(10,2)"""
    from decimal import Decimal

    return spark.createDataFrame([(a, b, c, Decimal(str(d)), Decimal(str(e))) for a, b, c, d, e in data], schema)


def test_rollup(summary):
    found = [tuple(r) for r in reports.optimization_rollup(summary).collect()]
    assert [(r[0], r[1], r[2], float(r[3]), float(r[4])) for r in found] == [
        ("inverted", 1, 2, 88.0, 25.5),
        ("partitioning", 1, 8, 68.0, 15.0),
        ("partial", 2, 6, 60.0, 23.5),
        ("composite", 1, 4, 52.0, 35.0),
        ("block range", 1, 3, 42.0, 0.8),
        ("rewriting", 3, 10, 38.33, 0.0),
    ]


def test_detail_formats(summary):
    first = reports.optimization_detail(summary).first()
    assert (first["improvement"], first["space_cost"]) == ("88.00%", "25.50 MB")


def test_before_after_has_no_zero_divisor(spark):
    runs = spark.createDataFrame(
        [("q", "before", 10.0), ("q", "before", 30.0), ("q", "after", 5.0), ("z", "before", 0.0), ("z", "after", 1.0)],
        "query_name STRING, phase STRING, execution_ms DOUBLE",
    )
    found = {r["query_name"]: r["improvement_percentage"] for r in reports.before_after(runs, ["query_name"]).collect()}
    assert float(found["q"]) == 75.0 and found["z"] is None


def test_completion(spark):
    checklist = spark.createDataFrame([(2, "b", "open"), (1, "a", "met"), (3, "c", "met")], "requirement_id INT, requirement_description STRING, status STRING")
    row = reports.completion_rate(checklist, "met").first()
    assert (row["total_requirements"], row["completed"], float(row["completion_percentage"])) == (3, 2, 66.67)
    assert [r["requirement_id"] for r in reports.checklist_detail(checklist).collect()] == [1, 2, 3]


def test_timing(spark):
    runs = spark.createDataFrame([("q", t) for t in (1.0, 2.0, 4.5)], "query_name STRING, execution_ms DOUBLE")
    row = reports.timing_stats(runs, ["query_name"]).first()
    assert [float(row[c]) for c in ("avg_time", "min_time", "max_time", "stddev_time")] == [2.5, 1.0, 4.5, 1.803]


def test_sheet_without_space(summary):
    bare = summary.drop("disk_space_used_mb")
    assert "space_cost" not in reports.optimization_detail(bare).columns
    assert "total_space_mb" not in reports.optimization_rollup(bare).columns


def test_timings_are_appended_and_unnested(spark):
    def plans(rows):
        df = spark.createDataFrame(rows, "q STRING, run INT, text STRING")
        return df.select("q", "run", F.parse_json("text").alias("plan"))

    text = '[{{"Planning Time": {}, "Execution Time": {}}}, {{"Execution Time": 99}}]'.format
    first = plans([("a", i, text(i / 10, i)) for i in range(1, 8)] + [("b", 1, "[]")])
    arrays = reports.timing_arrays(first, ["q"], "run", array_runs=3)
    assert sorted((r.q, len(r.execution_times)) for r in arrays.collect()) == [("a", 1), ("a", 3), ("a", 3), ("b", 1)]
    longer = reports.append_timings(arrays, plans([("a", 8, text(0.8, 8)), ("c", 1, text(1, 5))]), ["q"])
    assert sorted((r.q, r.part, len(r.planning_times)) for r in longer.collect()) == [("a", 0, 3), ("a", 1, 3), ("a", 2, 2), ("b", 0, 1), ("c", 0, 1)]
    found = {r.q: r for r in reports.array_timing_stats(longer, ["q"]).collect()}
    a = found["a"]
    assert (a.runs, float(a.avg_execution), float(a.avg_planning), a.max_execution) == (8, 4.5, 0.45, 8)
    assert found["b"].runs == 0 and found["b"].avg_execution is None and found["c"].min_execution == 5
