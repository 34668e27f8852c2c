"""Exact quantiles against a brute-force computation."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from mercato.operators.quantiles import exact_quantiles, quantile_columns

PROBS = [0.0, 0.25, 0.5, 0.9, 0.99, 1.0]


def quantiles(df, keys=("k",), **options):
    found = exact_quantiles(df, list(keys), "v", PROBS, **options).collect()
    return {(*[r[k] for k in keys], r["prob"]): r["quantile"] for r in found}


def brute(values):
    return {p: float(np.quantile(np.array(values, dtype=float), p)) for p in PROBS}


@pytest.mark.parametrize("accuracy", [10_000, 10, 2])
@pytest.mark.parametrize("few_groups", [True, False])
def test_exact_whatever_the_cuts(spark, accuracy, few_groups):
    rng = np.random.default_rng(accuracy)
    groups = {
        "skewed": list(np.round(rng.exponential(100, 3000), 2)),
        "hot": [5.0] * 1500 + list(np.round(rng.normal(0, 3, 1500), 1)),
        "tiny": [1.0, 2.0, 4.0, 8.0],
        "single": [7.5],
        None: [3.0, 1.0],
    }
    data = [(k, float(v)) for k, values in groups.items() for v in values] + [("tiny", None), ("empty", None)]
    df = spark.createDataFrame(data, "k STRING, v DOUBLE").repartition(7)
    found = quantiles(df, accuracy=accuracy, few_groups=few_groups)
    assert {k for k, _ in found} == set(groups)
    for key, values in groups.items():
        for p, wanted in brute(values).items():
            assert found[(key, p)] == pytest.approx(wanted, abs=1e-9), (key, p)


def test_median_of_four(spark):
    df = spark.createDataFrame([("a", v) for v in (1, 2, 4, 8)], "k STRING, v INT")
    wide = quantile_columns(exact_quantiles(df, ["k"], "v", [0.25, 0.5]), ["k"], {0.25: "p25", 0.5: "p50"}).first()
    assert (wide["p25"], wide["p50"]) == (1.75, 3.0)


def test_two_keys(spark):
    df = spark.range(1000).select((F.col("id") % 2).alias("a"), (F.col("id") % 3).alias("b"), F.col("id").alias("v"))
    found = quantiles(df, keys=("a", "b"))
    assert found[(0, 0, 0.5)] == float(np.median([i for i in range(1000) if i % 6 == 0]))


def test_approximate_switch(spark):
    df = spark.range(101).select(F.lit("a").alias("k"), F.col("id").alias("v"))
    assert quantiles(df, approx=True)[("a", 0.5)] == 50.0


def test_cuts_are_computed_once(spark):
    """Both uses of the cuts must see the same ones, and approximate quantiles may differ between two evaluations."""
    df = spark.createDataFrame([("a", float(i)) for i in range(100)], "k STRING, v DOUBLE")
    found = exact_quantiles(df, ["k"], "v", [0.5], few_groups=True)
    assert "percentile_approx" not in found._jdf.queryExecution().toString()
    assert [r["quantile"] for r in found.collect()] == [49.5]
