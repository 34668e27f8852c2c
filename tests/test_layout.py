import glob
import os

import pytest
from pyspark.sql import functions as F
from shop_data import at

from mercato.operators import layout
from mercato.session import new_table_path, shared_folder
from mercato.sources import io


@pytest.fixture(scope="module")
def monthly(spark, shop, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("monthly"))
    layout.write_monthly(shop.orders, path, first="2017_01", last="2017_12")
    return path


def months(path):
    return sorted(os.path.basename(p).split("=")[1] for p in glob.glob(f"{path}/order_month=*"))


def test_rows_outside_the_range_go_to_default(spark, shop, monthly):
    assert months(monthly) == ["2017_01", "2017_03", "default"]
    table = layout.read_monthly(spark, monthly)
    assert table.count() == shop.orders.count()
    assert {r["order_month"]: r["row_count"] for r in layout.partition_distribution(table).collect()} == {"2017_01": 22, "2017_03": 2, "default": 5}
    assert layout.default_rows(table).first()["default_rows"] == 5


def test_null_timestamp_goes_to_default(spark):
    df = spark.createDataFrame([("a", None), ("b", at("2017-01-05"))], "order_id STRING, order_purchase_timestamp TIMESTAMP_NTZ")
    found = {r["order_id"]: r["order_month"] for r in layout.with_month(df, layout.PURCHASE).collect()}
    assert found == {"a": "default", "b": "2017_01"}


def test_pruned_read(spark, monthly):
    rows = layout.read_pruned(spark, monthly, "2017-03-01", "2018-01-03")
    assert sorted(r["order_id"] for r in rows.collect()) == ["early", "fan", "late", "open1"]
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan
    read = {os.path.basename(os.path.dirname(f)) for f in rows.inputFiles()}
    assert read <= {"order_month=2017_03", "order_month=default", "order_month=2017_01"}


def test_only_present_months_are_overwritten(spark, shop, tmp_path):
    path = str(tmp_path / "t")
    layout.write_monthly(shop.orders, path)
    before = layout.read_monthly(spark, path).count()
    layout.write_monthly(shop.orders.where("order_id = 'early'"), path)
    assert layout.read_monthly(spark, path).count() == before - 1
    layout.append_rows(shop.orders.where("order_id = 'late'"), path)
    assert layout.read_monthly(spark, path).count() == before


def test_tiers(spark):
    labels = ["2018_01", "2017_02", "2017_01", "2016_02", "2016_01", "2015_02", "2015_01", "default"]
    df = spark.createDataFrame([(m,) for m in labels], "order_month STRING")
    found = {r["order_month"]: (r["age_months"], r["tier"]) for r in layout.retention_tiers(df, "2018-01-20").collect()}
    assert [found[m] for m in labels] == [
        (1, "active-hot"), (12, "active-hot"), (13, "active-warm"), (24, "active-warm"), (25, "archive"), (36, "archive"), (37, "purge"), (None, None),
    ]


def test_archive_refuses_recent_months(spark, monthly, tmp_path):
    archive = str(tmp_path / "archive")
    assert "too recent" in layout.archive_month(spark, monthly, archive, "2017_03", "2020-02-28")
    assert "does not exist" in layout.archive_month(spark, monthly, archive, "2010_03", "2020-03-01")
    assert "archived: 2 rows" in layout.archive_month(spark, monthly, archive, "2017_03", "2020-03-01")
    assert layout.read_monthly(spark, archive).count() == 2
    live = layout.without_months(layout.read_monthly(spark, monthly), ["2017_03"])
    assert live.count() == 27


def test_archive_split(spark, monthly, tmp_path):
    row = layout.archive_partitions(spark, monthly, str(tmp_path / "live"), str(tmp_path / "old"), "2020-02-01").first()
    assert (row["total_rows"], row["live_rows"], row["archived_rows"], row["result"]) == (29, 7, 22, "OK")
    assert months(str(tmp_path / "old")) == ["2017_01"]


def test_archive_again_and_with_nothing_to_move(spark, shop, monthly, tmp_path):
    live, old = str(tmp_path / "live"), str(tmp_path / "old")
    moved = lambda day: tuple(layout.archive_partitions(spark, monthly, live, old, day).first())
    assert moved("2015-01-01") == (29, 29, 0, "OK")
    assert moved("2020-02-01") == (29, 7, 22, "OK")
    # The second run finds the month archived already and must not leave it in the live table.
    assert moved("2020-02-01") == (29, 7, 22, "OK") and months(live) == ["2017_03", "default"]
    assert moved("2030-01-01") == (29, 5, 24, "OK") and months(old) == ["2017_01", "2017_03"]
    everything = str(tmp_path / "all")
    layout.write_monthly(shop.orders.where("order_id = 'early'"), everything)
    assert tuple(layout.archive_partitions(spark, everything, live, str(tmp_path / "old2"), "2030-01-01").first()) == (1, 0, 1, "OK")


def test_gaps_before_the_first_month(spark, monthly):
    assert layout.partition_gaps(layout.read_monthly(spark, monthly), "2010-01-15").count() == 0


def test_clustering_goes_by_order_not_by_distance(spark, tmp_path):
    path = str(tmp_path / "t")
    skewed = spark.range(1, 2001).select(F.pow(F.lit(1.01), F.col("id")).alias("v"), F.format_string("%06d", "id").alias("name"), (F.hash("id") % 97).alias("mixed"))
    skewed.repartitionByRange(4, "v").sortWithinPartitions("v").write.parquet(path)
    table = spark.read.parquet(path)
    for column in ("v", "name"):
        files = layout.clustering_report(table, column).collect()
        assert len(files) == 4 and sum(r["row_count"] for r in files) == 2000
        assert all((r["ascending_share"], r["overlapping_files"], r["suitability"]) == (1.0, 0, "excellent") for r in files)
    mixed = layout.clustering_report(table, "mixed").collect()
    assert all(r["suitability"] == "not recommended" and r["overlapping_files"] == 3 for r in mixed)


def test_clustering_runs_lose_no_neighbours(spark, tmp_path, monkeypatch):
    spark.createDataFrame([(v,) for v in [1, 2, 3, 2, 5, 6, 1, 8, None, 9]], "v INT").coalesce(1).write.parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    whole = layout.clustering_report(table, "v").first()
    monkeypatch.setattr(layout, "RUN_ROWS", 2)
    cut = layout.clustering_report(table, "v").first()
    assert whole["row_count"] == cut["row_count"] == 9 and whole["ascending_share"] == 0.75


def test_lookup_opens_only_the_months_of_the_period(spark, monthly):
    from mercato.plans import retail

    found = retail.order_lookup_in_month(layout.read_monthly(spark, monthly), "early", "2017-03-01", "2017-04-01")
    assert [r["order_id"] for r in found.collect()] == ["early"]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "2017_03" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_gaps(spark, monthly):
    gaps = [r["order_month"] for r in layout.partition_gaps(layout.read_monthly(spark, monthly), "2017-03-15").collect()]
    assert gaps == ["2017_02", "2017_04", "2017_05"]


def test_subsets_and_derived_columns(shop):
    assert layout.named_subset(shop.orders, "pending").count() == 4
    assert layout.named_subset(shop.orders, "analytics_states").count() == 26
    assert layout.named_subset(shop.items, "premium_items").count() == 2
    assert layout.named_subset(shop.customers, "top_states").count() == 1
    # A JSON null still counts as a key.
    assert sorted(r["product_id"] for r in layout.named_subset(shop.products, "has_warranty").collect()) == ["p2", "p3", "p4"]
    found = {r["product_id"]: r["warranty_months"] for r in layout.derived_columns(shop.products).collect()}
    assert found == {"p1": None, "p2": 24, "p3": None, "p4": None, "p5": None}
    item = layout.derived_columns(shop.items).where("order_id = 'early'").first()
    assert float(item["item_total"]) == 5.5


def test_clustered_write_splits_a_hot_value(spark, tmp_path):
    df = spark.range(60_000).select("id", F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 1000).alias("v"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        layout.clustered_write(df, str(tmp_path / "t"), "v")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    table = spark.read.parquet(str(tmp_path / "t"))
    files = layout.clustering_report(table, "v").collect()
    assert sum(r["row_count"] for r in files) == 60_000
    # A third of the rows has one value; no file holds that third.
    assert max(r["row_count"] for r in files) < 15_000
    assert min(r["ascending_share"] for r in files) == 1.0


def test_snapshot_and_csv(spark, shop, tmp_path):
    assert layout.snapshot_table(shop.orders, str(tmp_path / "copy")).first()["row_count"] == 29
    io.export_csv(shop.payments, str(tmp_path / "payments"))
    back = io.read_csv_table(spark, str(tmp_path / "payments"), "order_payments")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, shop.payments.collect()))
    io.insert_rows(shop.payments, str(tmp_path / "rows"))
    io.insert_rows(shop.payments, str(tmp_path / "rows"))
    assert io.read_table(spark, str(tmp_path / "rows")).count() == 10


def test_views(spark):
    io.register_tables(spark, "/root/testdata/sf0.001", ["nation", "region"])
    assert spark.sql("SELECT count(*) AS n FROM nation JOIN region ON n_regionkey = r_regionkey").first()["n"] == 25


def test_shared_folder_comes_from_the_session(spark):
    folder = shared_folder(spark)
    assert folder == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    assert new_table_path(spark, "x").startswith(folder) and new_table_path(spark, "x") != new_table_path(spark, "x")


def test_interleaving_takes_the_highest_bits_first(spark):
    df = spark.createDataFrame([(a, b) for a in range(8) for b in range(8)], "a INT, b INT")
    for r in df.select("a", "b", layout.interleaved([F.col("a"), F.col("b")], 3).alias("z")).collect():
        assert r.z == int("".join(f"{r.a:03b}"[i] + f"{r.b:03b}"[i] for i in range(3)), 2)


def test_ranges_of_either_column_meet_few_files(spark, tmp_path):
    # The second column is skewed and has nulls; neither follows the other.
    df = spark.range(20_000).select(
        (F.col("id") * 7919 % 10007).alias("a"), F.when(F.col("id") % 50 != 0, F.pow(F.col("id") * 104729 % 1009, 3)).alias("b"), F.lit("x").alias("_z")
    )
    layout.clustered_write_by(df, str(tmp_path / "z"), ["a", "b"], files=64)
    table = spark.read.parquet(str(tmp_path / "z"))
    assert table.count() == 20_000 and table.columns == ["a", "b", "_z"] and table.where("b IS NULL").count() == 400
    by_a = layout.files_met(table, "a", 4000, 4500).first()
    by_b = layout.files_met(table, "b", 500.0**3, 550.0**3).first()
    assert by_a.files == by_b.files == 64 and by_a.files_met <= 32 and by_b.files_met <= 32
    # In order of one column a range of the other meets them all.
    layout.clustered_write(df, str(tmp_path / "one"), "a", files=64)
    assert layout.files_met(spark.read.parquet(str(tmp_path / "one")), "b", 500.0**3, 550.0**3).first().files_met > 60


def test_files_end_where_a_block_of_places_does():
    even = [(cell, 10 + (cell * 7919) % 3) for cell in range(256)]
    assert layout.file_borders(even, 16, 8) == [(16 * i, i, 1) for i in range(16)]
    # A cell with most rows is dealt over several files; no file is left without cells.
    hot = [(c, 1000 if c == 5 else 1) for c in range(64)]
    runs = layout.file_borders(hot, 8, 6)
    assert [r[1] for r in runs] == [sum(q[2] for q in runs[:i]) for i in range(len(runs))] and sum(r[2] for r in runs) == 8
    assert next(r for r in reversed(runs) if r[0] <= 5)[2] > 4
    assert layout.file_borders([(3, 100)], 4, 6) == [(3, 0, 4)] and layout.file_borders([], 4, 6) == []


@pytest.mark.parametrize("low", [0.0, 0.4, 0.45])
def test_a_tenth_of_either_column_meets_at_most_half_of_the_files(spark, tmp_path, low):
    n = 50_000
    df = spark.range(n).repartition(8).select((F.col("id") * 7919 % 50021).alias("a"), (F.col("id") * 104729 % 50023).alias("b"))
    layout.clustered_write_by(df, str(tmp_path / "z"), ["a", "b"], files=16)
    table = spark.read.parquet(str(tmp_path / "z"))
    for column in ("a", "b"):
        met = layout.files_met(table, column, int(low * n), int((low + 0.1) * n)).first()
        assert met.files == 16 and met.files_met <= 8
