"""Ranks, running numbers and merging correlations against plain Python."""

import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from mercato.operators import comoments, layout, ranks


def numbers(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("slot_rows", [1, 7, 100, 100_000])
def test_running_numbers_are_gapless(spark, slot_rows):
    rows = [(k, f"v{i}") for k, n in (("hot", 400), ("cold", 3), (None, 60)) for i in range(n)]
    df = spark.createDataFrame(rows, "k STRING, v STRING").repartition(6)
    found = ranks.running_numbers(df, ["k"], ["v"], slot_rows).collect()
    assert sorted((r.k or "", r.v) for r in found) == sorted((k or "", v) for k, v in rows)
    for key, n in (("hot", 400), ("cold", 3), (None, 60)):
        assert sorted(r.number for r in found if r.k == key) == list(range(1, n + 1))
    same = ranks.running_numbers(df.repartition(3), ["k"], ["v"], slot_rows).collect()
    assert {tuple(r) for r in same} == {tuple(r) for r in found}


def test_counts_before_are_exact(spark):
    draw = random.Random(5)
    words = [draw.choice(["", "a", "ab", "abcdefg", "abcdefh", "\u00e9", "zz", "abcdef" + str(draw.randrange(300))]) for _ in range(3000)]
    rows = [(draw.choice(["x", "y", None]), w if draw.random() < 0.95 else None) for w in words]
    found = ranks.counts_before(spark.createDataFrame(rows, "k STRING, v STRING"), ["k"], "v").collect()
    wanted = set()
    for k in ("x", "y", None):
        counts, before = Counter(v for g, v in rows if g == k and v is not None), 0
        for v in sorted(counts, key=lambda t: t.encode()):
            wanted.add((k, v, counts[v], before))
            before += counts[v]
    assert {tuple(r) for r in found} == wanted


@pytest.mark.parametrize("kind", ["INT", "DOUBLE", "DATE", "TIMESTAMP_NTZ", "BOOLEAN", "DECIMAL(12,2)"])
def test_order_numbers_rise_with_values(spark, kind):
    cast = {"BOOLEAN": "v % 2 = 0", "DATE": "date_add(DATE '2020-01-01', v)", "TIMESTAMP_NTZ": "timestamp_ntz'2020-01-01' + make_interval(0, 0, 0, 0, v)"}
    df = spark.createDataFrame([(v,) for v in (-5, 3, 0, 12, 7, 3)], "v INT").select(F.expr(cast.get(kind, f"CAST(v AS {kind})")).alias("v"))
    found = sorted(((r.n, r.v) for r in df.select("v", ranks.order_number("v", df.schema[0].dataType).alias("n")).collect()))
    assert [v for _, v in found] == sorted(v for _, v in found)


def plain_corr(pairs):
    n = len(pairs)
    mx, my = sum(x for x, _ in pairs) / n, sum(y for _, y in pairs) / n
    sxy = sum((x - mx) * (y - my) for x, y in pairs)
    scale = math.sqrt(sum((x - mx) ** 2 for x, _ in pairs) * sum((y - my) ** 2 for _, y in pairs))
    return sxy / scale if scale else None


def test_states_merge(spark):
    draw = random.Random(2)
    rows = [(g, i % 7, 1e9 + i, 1e9 + 3 * i + draw.gauss(0, 400)) for g in ("a", "b") for i in range(500)] + [("c", 1, 2.0, 3.0), ("c", 2, None, 4.0), ("d", 1, 5.0, None)]
    df = spark.createDataFrame(rows, "g STRING, part INT, x DOUBLE, y DOUBLE")
    states = comoments.co_moments(df, ["g", "part"], F.col("x"), F.col("y"))
    found = {r.g: r for r in comoments.merge_states(states, ["g"], "part").select("g", "state.n", comoments.correlation(F.col("state")).alias("c")).collect()}
    for g in ("a", "b"):
        assert found[g].n == 500 and found[g].c == pytest.approx(plain_corr([(x, y) for h, _, x, y in rows if h == g]), abs=1e-9)
    assert found["c"].n == 1 and found["c"].c is None and "d" not in found


def test_physical_correlation_by_file(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(layout, "RUN_ROWS", 50)
    path = str(tmp_path / "t")
    draw = random.Random(1)
    # Band edges by construction: in order, in falling order, shuffled, constant.
    for name, values in (("up", list(range(400))), ("down", list(range(400))[::-1]), ("mixed", draw.sample(range(400), 400)), ("flat", [1] * 400)):
        rows = [(v, f"{v:05d}" if v % 9 else None) for v in values]
        spark.createDataFrame(rows, "v INT, t STRING").coalesce(1).write.parquet(f"{path}/{name}")
    table = spark.read.parquet(*(f"{path}/{n}" for n in ("up", "down", "mixed", "flat")))
    for column in ("v", "t"):
        found = {r.file.split("/")[-2]: r for r in layout.physical_correlation(table, column).collect()}
        assert found["up"].correlation == pytest.approx(1, abs=1e-3) and found["down"].correlation == pytest.approx(-1, abs=1e-3)
        assert found["up"].suitability == found["down"].suitability == "excellent"
        assert abs(found["mixed"].correlation) < 0.3 and found["mixed"].suitability == "not recommended"
        assert found["flat"].correlation is None and found["flat"].suitability == "not recommended"
    assert found["up"].row_count == 400 - len(range(0, 400, 9))


def test_cuts_of_counts_are_computed_once(spark):
    found = ranks.counts_before(spark.createDataFrame([("x", w) for w in "abcb"], "k STRING, v STRING"), ["k"], "v")
    assert "percentile_approx" not in found._jdf.queryExecution().toString()
    assert {tuple(r) for r in found.collect()} == {("x", "a", 1, 0), ("x", "b", 2, 1), ("x", "c", 1, 3)}
