"""Bounds, frequent values and sketches against plain Python."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from mercato.operators import bounds, frequent, sketches


def table(spark, rows, kind="INT"):
    return spark.createDataFrame(rows, "name STRING, low INT, high INT").select("name", *[F.col(c).cast(kind).alias(c) for c in ("low", "high")])


UNEVEN = [("p1", None, 10), ("p2", 10, 20), ("p3", 25, 100), ("none", 5, 5), ("p4", 100, 101), ("p5", 101, None)]
CLOSED = [("q1", -4, 0), ("q2", 7, 8)]


def plain(value, rows):
    for name, low, high in rows:
        if value is not None and (low is None or low <= value) and (high is None or value < high):
            return name
    return "default"


@pytest.mark.parametrize("small", [0, 10_000])
@pytest.mark.parametrize("rows", [UNEVEN, CLOSED, UNEVEN[:1], [], [("all", None, None)]], ids=["uneven", "closed", "open", "none", "all"])
def test_rows_find_their_range(spark, rows, small):
    values = [None, *range(-8, 130)]
    df = spark.createDataFrame([(v, i) for i, v in enumerate(values)], "x INT, low INT")
    for kind in ("INT", "DOUBLE"):
        found = bounds.assign_ranges(df.withColumn("x", F.col("x").cast(kind)), "x", table(spark, rows, kind), small=small)
        assert found.columns == ["x", "low", "part"] and {(r.x, r.part) for r in found.collect()} == {(v, plain(v, rows)) for v in values}


@pytest.mark.parametrize("small", [0, 10_000])
def test_many_ranges_and_a_hot_value(spark, small):
    rows = [(f"r{i}", 10 * i, 10 * i + 9) for i in range(3000)]
    draw = random.Random(3)
    values = [draw.randrange(-100, 31_000) for _ in range(2000)] + [12_345] * 1000
    found = bounds.assign_ranges(spark.createDataFrame([(v,) for v in values], "x INT"), "x", table(spark, rows), small=small)
    wanted = Counter(f"r{v // 10}" if 0 <= v < 30_000 and v % 10 < 9 else "default" for v in values)
    assert {r.part: r["count"] for r in found.groupBy("part").count().collect()} == wanted


def test_texts_have_ranges_too(spark):
    ranges = spark.createDataFrame([("a-m", "a", "n"), ("n-z", "n", None)], "name STRING, low STRING, high STRING")
    words = spark.createDataFrame([("apple",), ("nut",), ("Zoo",), (None,), ("mzzzzzzzzz",), ("n",)], "x STRING")
    for small in (0, 10):
        found = {r.x: r.part for r in bounds.assign_ranges(words, "x", ranges, small=small).collect()}
        assert found == {"apple": "a-m", "mzzzzzzzzz": "a-m", "n": "n-z", "nut": "n-z", "Zoo": "default", None: "default"}


def test_problems_of_bounds(spark):
    rows = [*UNEVEN, ("long", 30, 60), ("inner", 40, 41), ("after", 50, 110)]
    found = {tuple(r) for r in bounds.bound_problems(table(spark, rows)).collect()}
    assert found == {
        ("gap", "p2", "p3", 20, 25), ("overlap", "p3", "long", 30, 60), ("overlap", "long", "inner", 40, 41), ("overlap", "inner", "after", 50, 100),
        ("overlap", "after", "p4", 100, 101), ("overlap", "p4", "p5", 101, 110), ("empty", "none", None, 5, 5),
    }
    with pytest.raises(ValueError, match="p3 and long overlap"):
        bounds.assign_ranges(spark.range(3), "id", table(spark, rows))
    assert bounds.bound_problems(table(spark, [])).count() == 0


def test_counts_show_empty_ranges(spark):
    found = {r.part: r.row_count for r in bounds.range_counts(spark.range(-3, 30).select(F.col("id").cast("int").alias("x")), "x", table(spark, UNEVEN)).collect()}
    assert found == {"p1": 13, "p2": 10, "p3": 5, "none": 0, "p4": 0, "p5": 0, "default": 5}


@pytest.mark.parametrize("buckets", [1, 3, 50, 1 << 16])
def test_most_frequent_is_exact_at_any_size(spark, buckets):
    draw = random.Random(buckets)
    rows = [(draw.choice("abc") if draw.random() < 0.9 else None, f"u{i}", min(draw.randrange(400), draw.randrange(400)), None) for i in range(1500)] + [("b", "hot", 7, None)] * 500
    df = spark.createDataFrame(rows, "few STRING, many STRING, number INT, nothing STRING")
    found = {r.column: r for r in frequent.most_frequent(df, df.columns, buckets).collect()}
    for i, name in enumerate(("few", "many", "number")):
        counts = Counter(str(r[i]) for r in rows if r[i] is not None)
        best = min(counts, key=lambda v: (-counts[v], v))
        assert (found[name].top, found[name].freq) == (best, counts[best])
    assert (found["nothing"].top, found["nothing"].freq) == (None, 0)
    if buckets > 1000:
        # One value leads, so the others' buckets are not counted by value.
        assert found["many"].counted == 500
    for k in (1, 5, 5000):
        counts = Counter(str(r[2]) for r in rows)
        wanted = sorted(counts.items(), key=lambda c: (-c[1], c[0]))[:k]
        assert [(r.number, r.n) for r in frequent.frequent_values(df, "number", k, buckets).orderBy("place").collect()] == wanted


def test_most_frequent_of_nothing(spark):
    empty = spark.createDataFrame([], "a STRING")
    assert [tuple(r) for r in frequent.most_frequent(empty, ["a"]).collect()] == [("a", None, 0, 0)]
    assert frequent.frequent_values(empty, "a", 3).count() == 0


def test_sketches_of_months_merge(spark, tmp_path):
    day = "TIMESTAMP_NTZ '2020-01-01' + make_interval(0, 0, 0, CAST(id % 366 AS INT))"
    df = spark.range(60_000).select(F.expr(day).alias("at"), (F.col("id") % 9000).alias("user"), F.when(F.col("id") % 2 == 0, F.col("id")).alias("visit"))
    sketches.monthly_sketches(df, "at", ["user", "visit"]).write.parquet(str(tmp_path / "s"))
    stored = spark.read.parquet(str(tmp_path / "s"))
    assert stored.count() == 24
    span = df.where("at >= '2020-03-01' AND at < '2020-09-01'")
    exact = span.agg(F.count_distinct("user"), F.count_distinct("visit"), F.count("visit")).first()
    found = {r.key: r for r in sketches.distinct_in(stored, "2020_03", "2020_08").collect()}
    assert found["user"].distinct_values == pytest.approx(exact[0], rel=0.03) and found["visit"].distinct_values == pytest.approx(exact[1], rel=0.03)
    assert found["visit"].rows == exact[2] and found["user"].months == 6
    both = sketches.overlap(stored, stored, "user", "visit").first()
    assert both.left_values == 9000 and both.right_values == pytest.approx(30_000, rel=0.03)
    assert both.shared == pytest.approx(4500, rel=0.06) and both.left_alone == pytest.approx(4500, rel=0.06)
