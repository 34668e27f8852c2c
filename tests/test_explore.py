import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from mercato.operators.profile import top_values, with_share, value_counts
from mercato.plans import explore


def rows(df):
    return [r.asDict() for r in df.collect()]


@pytest.fixture(scope="module")
def mixed(spark):
    data = [("x", 1, 1.5), ("y", 2, None), ("x", 4, 2.5), (None, 8, 2.5), ("y", 8, 9.0)]
    return spark.createDataFrame(data, "t STRING, i INT, d DOUBLE")


def test_describe_matches_pandas(mixed):
    found = {r["column"]: r for r in rows(explore.describe_all(mixed))}
    pdf = mixed.toPandas()
    for column in ("i", "d"):
        want = pdf[column].describe()
        for ours, theirs in (("count", "count"), ("mean", "mean"), ("std", "std"), ("min", "min"), ("p25", "25%"), ("p50", "50%"), ("p75", "75%"), ("max", "max")):
            assert float(found[column][ours]) == pytest.approx(want[theirs], abs=1e-4)
    assert (found["t"]["count"], found["t"]["unique"], found["t"]["top"], found["t"]["freq"]) == (4, 2, "x", 2)
    assert found["t"]["mean"] is None and found["i"]["top"] is None


def test_info_nulls_duplicates(spark, mixed):
    assert {r["column"]: (r["non_null"], r["dtype"]) for r in rows(explore.column_info(mixed))} == {
        "t": (4, "string"),
        "i": (5, "int"),
        "d": (4, "double"),
    }
    assert {r["column"]: float(r["null_pct"]) for r in rows(explore.null_profile(mixed, "m"))} == {"t": 20.0, "d": 20.0}
    twice = mixed.unionByName(mixed.where(F.col("t").isNull()))
    assert rows(explore.duplicate_profile(twice, "m"))[0]["duplicates"] == 1
    sheet = explore.quality_profile(mixed, "m")
    assert set(sheet) == {"columns", "types", "nulls", "duplicates"}
    assert {r["dtype"]: r["n"] for r in rows(sheet["types"])} == {"string": 1, "int": 1, "double": 1}


def test_duplicates_of_an_empty_table(mixed):
    assert rows(explore.duplicate_profile(mixed.where("1 = 0"), "m"))[0] == {
        "table": "m", "rows": 0, "duplicates": 0, "duplicate_pct": None,
    }


def test_top_values_ties_and_shares(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("c",), (None,)], "s STRING")
    assert [(r["s"], r["n"]) for r in rows(top_values(df, "s", 2))] == [("c", 2), ("a", 1)]
    assert {r["s"]: float(r["share_pct"]) for r in rows(with_share(value_counts(df, "s"), 1))} == {"a": 25.0, "b": 25.0, "c": 50.0}


def test_missing_weekday_keeps_its_row(spark, shop):
    some = shop.orders.where("order_id IN ('a00', 'a01')")  # a Sunday and a Monday
    found = rows(explore.orders_by_weekday(some))
    assert [(r["weekday"], r["n"]) for r in found] == [
        ("Monday", 1), ("Tuesday", None), ("Wednesday", None), ("Thursday", None), ("Friday", None), ("Saturday", None), ("Sunday", 1),
    ]
    months = rows(explore.orders_by_month_name(shop.orders))
    assert len(months) == 12 and months[0]["n"] == 27 and months[5]["n"] is None


def test_date_features_from_text(spark, shop):
    text = shop.orders.withColumn("order_approved_at", F.lit(None).cast("string"))
    text = text.withColumn("order_purchase_timestamp", F.date_format("order_purchase_timestamp", "yyyy-MM-dd HH:mm:ss"))
    row = explore.date_features(text.where("order_id = 'a00'")).first()
    assert (row["year"], row["month_name"], row["dayofweek"], row["dayofweek_name"], row["quarter"]) == (2017, "January", 6, "Sunday", 1)


def test_delay_is_a_difference_of_floored_days(shop):
    found = {r["order_id"]: r for r in rows(explore.delivery_time_features(shop.orders))}
    assert (found["early"]["delivery_time"], found["early"]["estimated_delivery_time"], found["early"]["delivery_delay"]) == (6, 8, -2)
    assert found["open0"]["delivery_delay"] is None


def test_delivery_summary_shares_are_of_all_delivered(spark, shop):
    row = rows(explore.delivery_time_summary(shop.orders))[0]
    assert (row["delivered_orders"], row["on_time_orders"], row["late_orders"]) == (22, 9, 13)
    none = shop.orders.withColumn("order_estimated_delivery_date", F.lit(None).cast("timestamp_ntz"))
    row = rows(explore.delivery_time_summary(none))[0]
    assert (row["on_time_orders"], row["late_orders"], float(row["late_pct"])) == (0, 0, 0.0)


def test_trimmed_histogram_matches_numpy(spark):
    rng = np.random.default_rng(3)
    values = np.round(rng.gamma(2.0, 50.0, 2000), 2)
    df = spark.createDataFrame([(float(v), 4) for v in values] + [(None, 4)], "v DOUBLE, flat INT")
    found = rows(explore.trimmed_histogram(df, ["v", "flat"]))
    kept = values[values <= np.quantile(values, 0.99)]
    counts, edges = np.histogram(kept, bins=50)
    ours = sorted((r["bin"], r["n"], float(r["bin_start"])) for r in found if r["column"] == "v")
    assert [n for _, n, _ in ours] == list(counts)
    assert [s for _, _, s in ours] == pytest.approx(list(edges[:-1]), abs=1e-5)
    flat = {r["bin"]: r["n"] for r in found if r["column"] == "flat"}
    assert flat[25] == 2001 and sum(flat.values()) == 2001


def test_value_stats(shop):
    found = {r["payment_type"]: r for r in rows(explore.payment_value_by_type(shop.payments))}
    pdf = shop.payments.toPandas().astype({"payment_value": float})
    want = pdf.groupby("payment_type")["payment_value"].agg(["mean", "median", "sum"]).round(2)
    for kind, figures in want.iterrows():
        assert [float(found[kind][c]) for c in ("mean", "median", "sum")] == list(figures)


def test_sample_is_repeatable_and_bounded(spark):
    df = spark.range(1000).repartition(5)
    first = {r["id"] for r in rows(explore.geo_sample(df, ["id"], n=50))}
    again = {r["id"] for r in rows(explore.geo_sample(df.repartition(3), ["id"], n=50))}
    assert first == again and len(first) == 50
    assert {r["id"] for r in rows(explore.geo_sample(df, ["id"], n=50, seed=1))} != first


def test_orphans_and_cardinality(spark, shop):
    child = spark.createDataFrame([("s1",), ("zz",), ("zz",), (None,)], "seller_id STRING")
    assert rows(explore.orphan_keys(child, shop.sellers, "seller_id", "r"))[0]["orphans"] == 1
    found = rows(explore.relationship_cardinality({"items": shop.items}, {"items": ["order_id", "seller_id"]}))
    assert {r["metric"]: r["value"] for r in found} == {"rows": 27, "distinct order_id": 23, "distinct seller_id": 2}


def test_pandas_agrees_on_value_counts(shop):
    pdf: pd.DataFrame = shop.orders.toPandas()
    assert {r["order_status"]: r["n"] for r in rows(explore.order_status_distribution(shop.orders))} == pdf["order_status"].value_counts().to_dict()


def test_geo_sample_chooses_among_equal_keys_by_all_columns(spark):
    rows = [(1, name) for name in ("d", "b", "e", "a", "c")]
    for order in (rows, rows[::-1]):
        df = spark.createDataFrame(order, "zip INT, city STRING").coalesce(1)
        assert [r["city"] for r in explore.geo_sample(df, ["zip"], n=2).collect()] == ["a", "b"]
