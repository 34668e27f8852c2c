"""Registered layout and lifecycle queries.

Tables are written below the shared folder named by the session, each run under
a name of its own.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.checks.market import AS_OF
from mercato.checks.registry import check
from mercato.checks.sql import dbl, half_up
from mercato.functions import jsonq
from mercato.functions.numeric import round_half_up
from mercato.operators import batches, layout, quality
from mercato.plans.retail import status_counts
from mercato.session import new_table_path
from mercato.sources.io import export_csv

FIRST, LAST = "1995_06", "2001_03"
MONTH_LABEL = f"""CASE WHEN strftime(order_purchase_timestamp, '%Y_%m') BETWEEN '{FIRST}' AND '{LAST}'
    THEN strftime(order_purchase_timestamp, '%Y_%m') ELSE 'default' END"""
MONTHLY = f"(SELECT *, {MONTH_LABEL} AS order_month FROM s_orders)"


def _written(m) -> str:
    path = new_table_path(m.spark, "orders_monthly")
    layout.write_monthly(m.orders, path, first=FIRST, last=LAST)
    return path


@check("write_monthly", "s_orders", f"SELECT order_month, count(*) AS row_count FROM {MONTHLY} GROUP BY 1")
def _(m):
    return layout.partition_distribution(layout.read_monthly(m.spark, _written(m)))


@check("partition_distribution", "s_orders", f"SELECT order_month, count(*) AS row_count FROM {MONTHLY} GROUP BY 1")
def _(m):
    return layout.partition_distribution(layout.with_month(m.orders, layout.PURCHASE, FIRST, LAST))


@check(
    "read_pruned",
    "s_orders",
    f"""SELECT order_id, customer_id, order_status, order_purchase_timestamp, order_month FROM {MONTHLY}
    WHERE order_purchase_timestamp >= TIMESTAMP '1997-05-10' AND order_purchase_timestamp < TIMESTAMP '1997-07-03'""",
)
def _(m):
    rows = layout.read_pruned(m.spark, _written(m), "1997-05-10", "1997-07-03")
    return rows.select("order_id", "customer_id", "order_status", "order_purchase_timestamp", "order_month")


@check(
    "retention_tiers",
    "s_orders",
    f"""SELECT order_month, row_count, age_months, CASE WHEN age_months <= 12 THEN 'active-hot'
        WHEN age_months <= 24 THEN 'active-warm' WHEN age_months <= 36 THEN 'archive' WHEN age_months > 36 THEN 'purge' END AS tier
    FROM (SELECT order_month, row_count, CASE WHEN order_month <> 'default' THEN CAST((2001 - CAST(order_month[1:4] AS INTEGER)) * 12
            + 8 - CAST(order_month[6:7] AS INTEGER) + 1 AS INTEGER) END AS age_months
        FROM (SELECT order_month, count(*) AS row_count FROM {MONTHLY} GROUP BY 1))""",
)
def _(m):
    months = layout.partition_distribution(layout.with_month(m.orders, layout.PURCHASE, FIRST, LAST))
    return layout.retention_tiers(months, AS_OF)


ARCHIVED = f"""SELECT count(*) AS total_rows, count(*) FILTER (WHERE NOT old) AS live_rows, count(*) FILTER (WHERE old) AS archived_rows,
    'OK' AS result FROM (SELECT order_month <> 'default' AND order_month <= '1998_08' AS old FROM {MONTHLY})"""


@check("archive_partitions", "s_orders", ARCHIVED)
def _(m):
    live, archive = new_table_path(m.spark, "orders_live"), new_table_path(m.spark, "orders_archive")
    return layout.archive_partitions(m.spark, _written(m), live, archive, AS_OF)


@check(
    "partition_gaps",
    "s_orders",
    """SELECT order_month FROM (SELECT strftime(unnest(generate_series((SELECT date_trunc('month', min(order_purchase_timestamp))
        FROM s_orders), TIMESTAMP '2001-10-01', INTERVAL 1 MONTH)), '%Y_%m') AS order_month)
    WHERE order_month NOT IN (SELECT strftime(order_purchase_timestamp, '%Y_%m') FROM s_orders)""",
)
def _(m):
    return layout.partition_gaps(layout.with_month(m.orders, layout.PURCHASE), AS_OF)


@check("default_rows", "s_orders", f"SELECT count(*) FILTER (WHERE order_month = 'default') AS default_rows FROM {MONTHLY}")
def _(m):
    return layout.default_rows(layout.with_month(m.orders, layout.PURCHASE, FIRST, LAST))


@check("snapshot_table", "s_orders", "SELECT count(*) AS row_count FROM s_orders")
def _(m):
    return layout.snapshot_table(m.orders, new_table_path(m.spark, "orders_backup"))


@check(
    "migration_count_check",
    "s_orders",
    "SELECT count(*) AS old_rows, count(*) AS new_rows, 'OK' AS result FROM s_orders",
)
def _(m):
    return quality.migration_count_check(m.orders, layout.read_monthly(m.spark, _written(m)))


def _subset(name: str, view: str, key: str, where: str, pick, **options) -> None:
    @check(f"named_subset_{name}", view, f"SELECT {key} FROM {view} WHERE {where}")
    def _(m):
        return layout.named_subset(pick(m), name, **options).select(*key.split(", "))


_subset("delivered", "s_orders", "order_id", "order_status = 'delivered'", lambda m: m.orders)
_subset("analytics_states", "s_orders", "order_id", "order_status IN ('delivered', 'shipped', 'invoiced')", lambda m: m.orders)
_subset(
    "pending",
    "s_orders",
    "order_id",
    "order_status IN ('processing', 'shipped') AND order_delivered_customer_date IS NULL",
    lambda m: m.orders,
)
_subset("premium_items", "s_items", "order_id, order_item_id, product_id", "price > 100", lambda m: m.items)
_subset(
    "top_states",
    "s_customers",
    "customer_id",
    "customer_state IN ('ASIA', 'EUROPE')",
    lambda m: m.customers,
    states=("ASIA", "EUROPE"),
)
_subset(
    "has_warranty",
    "s_products",
    "product_id",
    "list_contains(json_keys(CAST(product_attributes AS JSON)), 'warranty_months')",
    lambda m: m.products,
)


@check(
    "derived_columns",
    "s_orders s_items s_products",
    f"""SELECT 'order' AS kind, order_id AS id, strftime(date_trunc('month', order_purchase_timestamp), '%Y-%m-%d') AS purchase_month,
        NULL AS item_total, NULL AS warranty_months FROM s_orders
    UNION ALL SELECT 'item', order_id, NULL, {dbl("price + freight_value")}, NULL FROM s_items
    UNION ALL SELECT 'product', product_id, NULL, NULL, CAST(product_attributes ->> '$.warranty_months' AS INTEGER) FROM s_products""",
)
def _(m):
    orders = layout.derived_columns(m.orders).select(
        F.lit("order").alias("kind"), F.col("order_id").alias("id"), F.date_format("purchase_month", "yyyy-MM-dd").alias("purchase_month")
    )
    items = layout.derived_columns(m.items).select(F.lit("item").alias("kind"), F.col("order_id").alias("id"), "item_total")
    products = layout.derived_columns(m.products).select(F.lit("product").alias("kind"), F.col("product_id").alias("id"), "warranty_months")
    return orders.unionByName(items, allowMissingColumns=True).unionByName(products, allowMissingColumns=True)


def _clustering(path: str, order: str, column: str) -> str:
    """The report on one file whose rows come in the given order."""
    return f"""SELECT '{column}' AS "column", row_count, {half_up("share", 6)} AS ascending_share, low, high, 0 AS overlapping_files,
        CASE WHEN share > 0.9 THEN 'excellent' WHEN share > 0.7 THEN 'good' WHEN share > 0.6 THEN 'acceptable'
            ELSE 'not recommended' END AS suitability
    FROM (SELECT count(*) AS row_count, CAST(greatest(count(*) FILTER (b <= v), count(*) FILTER (b >= v)) AS DOUBLE) / count(b) AS share,
            CAST(min(v) AS VARCHAR) AS low, CAST(max(v) AS VARCHAR) AS high
        FROM (SELECT v, lag(v) OVER (ORDER BY pos) AS b FROM (SELECT {column} AS v, row_number() OVER ({order}) AS pos FROM {path})))"""


CLUSTERED = [("orders", "", "o_orderkey"), ("orders", "", "o_custkey"), ("orders", "", "o_orderstatus")]


@check("clustering_report", "", " UNION ALL ".join(_clustering(*c) for c in CLUSTERED))
def _(m):
    parts = []
    for name, _, column in CLUSTERED:
        report = layout.clustering_report(m.table(name), column)
        shown = report.withColumn("ascending_share", round_half_up(F.col("ascending_share"), 6)).withColumn("column", F.lit(column))
        texts = {c: F.col(c).cast("string") for c in ("low", "high")}
        parts.append(shown.withColumns(texts | {"overlapping_files": F.col("overlapping_files").cast("int")}).drop("file"))
    return reduce(DataFrame.unionByName, parts)


def _correlated(table: str, column: str, value: str) -> str:
    return f"""SELECT '{table}' AS "table", '{column}' AS "column", row_count, correlation, CASE WHEN abs(c) > 0.9 THEN 'excellent'
            WHEN abs(c) > 0.7 THEN 'good' WHEN abs(c) > 0.5 THEN 'acceptable' ELSE 'not recommended' END AS suitability
    FROM (SELECT count(v) AS row_count, corr(v, pos) AS c, {half_up("corr(v, pos)", 6)} AS correlation
        FROM (SELECT {value} AS v, pos FROM (SELECT {column}, row_number() OVER () AS pos FROM {table})))"""


_MEAN_RANK = "rank() OVER (ORDER BY {0}) + (count(*) OVER (PARTITION BY {0}) - 1) / 2.0"
CORRELATED = [
    ("orders", "o_orderkey", "o_orderkey"), ("orders", "o_orderdate", "epoch_us(o_orderdate)"), ("orders", "o_totalprice", "o_totalprice"),
    ("orders", "o_orderpriority", _MEAN_RANK.format("o_orderpriority")), ("lineitem", "l_orderkey", "l_orderkey"),
    ("customer", "c_name", _MEAN_RANK.format("c_name")), ("documents", "text", _MEAN_RANK.format("text")), ("events", "ts", "epoch_us(ts)"),
]


@check("physical_correlation", "", " UNION ALL ".join(_correlated(*c) for c in CORRELATED))
def _(m):
    parts = []
    for name, column, _ in CORRELATED:
        found = layout.physical_correlation(m.table(name), column).withColumn("correlation", round_half_up(F.col("correlation"), 6))
        parts.append(found.select(F.lit(name).alias("table"), F.lit(column).alias("column"), "row_count", "correlation", "suitability"))
    return reduce(DataFrame.unionByName, parts)


def _sorted_table(column: str) -> str:
    return f"""SELECT count(*) AS row_count, CAST(min({column}) AS VARCHAR) AS low, CAST(max({column}) AS VARCHAR) AS high,
        CAST(1.0 AS DOUBLE) AS lowest_share, TRUE AS several_files FROM s_orders"""


def _clustered(m, column: str):
    """The orders written in order of a column to several files; every file must be sorted."""
    path = new_table_path(m.spark, "orders_clustered")
    layout.clustered_write(m.orders, path, column, files=4)
    table = m.spark.read.parquet(path)
    files = layout.clustering_report(table, column)
    found = files.agg(F.min("ascending_share").alias("lowest_share"), (F.count("*") > 1).alias("several_files"))
    totals = table.agg(F.count("*").alias("row_count"), F.min(column).cast("string").alias("low"), F.max(column).cast("string").alias("high"))
    return totals.select("*", found.select("lowest_share").scalar().alias("lowest_share"), found.select("several_files").scalar().alias("several_files"))


@check("clustered_write", "s_orders", _sorted_table("order_id"))
def _(m):
    return _clustered(m, "order_id")


@check("clustered_write_text", "s_orders", _sorted_table("order_status"))
def _(m):
    return _clustered(m, "order_status")


NOTHING_OLD = "SELECT count(*) AS total_rows, count(*) AS live_rows, 0 AS archived_rows, 'OK' AS result FROM s_orders"


@check("archive_nothing", "s_orders", NOTHING_OLD)
def _(m):
    live, archive = new_table_path(m.spark, "orders_live"), new_table_path(m.spark, "orders_archive")
    return layout.archive_partitions(m.spark, _written(m), live, archive, "1990-01-01")


@check("archive_again", "s_orders", ARCHIVED)
def _(m):
    """A second run with the same targets, after a first one that moved fewer months."""
    path, live, archive = _written(m), new_table_path(m.spark, "orders_live"), new_table_path(m.spark, "orders_archive")
    layout.archive_partitions(m.spark, path, live, archive, "1999-08-02")
    return layout.archive_partitions(m.spark, path, live, archive, AS_OF)


@check(
    "archive_month",
    "s_orders",
    f"SELECT 'partition 1996_03 archived: ' || count(*) || ' rows' AS message, count(*) AS archived FROM {MONTHLY} WHERE order_month = '1996_03'",
)
def _(m):
    archive = new_table_path(m.spark, "orders_archive")
    message = layout.archive_month(m.spark, _written(m), archive, "1996_03", AS_OF)
    return layout.read_monthly(m.spark, archive).agg(F.lit(message).alias("message"), F.count("*").alias("archived"))


@check("export_csv", "s_orders", "SELECT order_status, count(*) AS total_orders FROM s_orders GROUP BY 1")
def _(m):
    path = new_table_path(m.spark, "status_counts_csv")
    export_csv(status_counts(m.orders), path)
    return m.spark.read.schema("order_status STRING, total_orders BIGINT").option("header", True).csv(path)


@check(
    "prim_json_any_all",
    "s_products",
    """SELECT product_id, list_contains(k, 'warranty_months') OR list_contains(k, 'size') AS has_any,
        list_contains(k, 'warranty_months') AND list_contains(k, 'color') AS has_all
    FROM (SELECT product_id, json_keys(CAST(product_attributes AS JSON)) AS k FROM s_products)""",
)
def _(m):
    value = jsonq.parsed(F.col("product_attributes"))
    return m.products.select(
        "product_id",
        jsonq.has_any_key(value, ["warranty_months", "size"]).alias("has_any"),
        jsonq.has_all_keys(value, ["warranty_months", "color"]).alias("has_all"),
    )


@check(
    "prim_json_contains_number",
    "",
    "SELECT event_id, user_id FROM events WHERE json_contains(CAST(props AS JSON), '{\"k\": 9}')",
)
def _(m):
    return m.table("events").where(jsonq.contains(jsonq.parsed(F.col("props")), {"k": 9})).select("event_id", "user_id")


@check(
    "prim_json_keys",
    "s_products",
    """SELECT k AS "key", count(*) AS n FROM (SELECT unnest(json_keys(CAST(product_attributes AS JSON))) AS k FROM s_products)
    GROUP BY 1""",
)
def _(m):
    keys = m.products.select(F.explode(jsonq.keys_of(F.col("product_attributes"))).alias("key"))
    return keys.groupBy("key").agg(F.count("*").alias("n"))


HALF = "order_id % 2 = 0"


def _batched(m) -> str:
    """The orders in two batches, the second of which is loaded twice."""
    path = new_table_path(m.spark, "orders_batches")
    batches.append_batch(m.orders.where(HALF), path, "even", first=FIRST, last=LAST)
    for _ in range(2):
        batches.append_batch(m.orders.where(f"NOT {HALF}"), path, "odd", first=FIRST, last=LAST)
    return path


@check(
    "append_batch",
    "s_orders",
    f"SELECT order_month, count(*) AS row_count, count(DISTINCT order_id) AS orders FROM {MONTHLY} GROUP BY 1",
)
def _(m):
    rows = batches.read_batches(m.spark, _batched(m), m.orders.schema)
    return rows.groupBy(layout.MONTH).agg(F.count("*").alias("row_count"), F.count_distinct("order_id").alias("orders"))


@check(
    "archive_old",
    "s_orders",
    f"""SELECT order_month, row_count, CASE WHEN order_month <= '1998_08' THEN 'partition ' || order_month || ' archived: ' || row_count || ' rows'
            ELSE 'partition ' || order_month || ' is too recent to archive' END AS message
    FROM (SELECT order_month, count(*) AS row_count FROM {MONTHLY} WHERE order_month <> 'default' GROUP BY 1)""",
)
def _(m):
    return batches.archive_old(m.spark, _batched(m), new_table_path(m.spark, "orders_old"), m.orders.schema, AS_OF)


@check(
    "archive_old_tiers",
    "s_orders",
    f"""SELECT CASE WHEN order_month <> 'default' AND order_month <= '1998_08' THEN 'archive' ELSE 'live' END AS tier, order_month, count(*) AS row_count,
        CAST(sum(order_id) AS BIGINT) AS id_sum FROM {MONTHLY} GROUP BY ALL""",
)
def _(m):
    """What both tiers hold after months were moved in two runs."""
    path, archive = _batched(m), new_table_path(m.spark, "orders_old")
    for day in ("1999-08-02", AS_OF):
        batches.archive_old(m.spark, path, archive, m.orders.schema, day)
    tiers = [batches.read_batches(m.spark, path, m.orders.schema, tier=t).withColumn("tier", F.lit(t)) for t in (batches.LIVE, batches.ARCHIVE)]
    return tiers[0].unionByName(tiers[1]).groupBy("tier", layout.MONTH).agg(F.count("*").alias("row_count"), F.sum("order_id").alias("id_sum"))


@check(
    "batch_report",
    "s_orders",
    f"""SELECT order_month, 'live' AS tier, count(DISTINCT {HALF}) AS batches, count(*) AS row_count FROM {MONTHLY} GROUP BY 1""",
)
def _(m):
    return batches.batch_report(m.spark, _batched(m))


@check(
    "prim_json_contains_column",
    "s_products",
    """SELECT product_id, json_contains(CAST(product_attributes AS JSON), CAST(pattern AS JSON)) AS fits
    FROM (SELECT product_id, product_attributes, '{"color": "' || ['Black', 'White', 'Silver'][product_id % 3 + 1] || '"'
        || CASE WHEN product_id % 5 = 0 THEN ', "warranty_months": 12' ELSE '' END || '}' AS pattern FROM s_products)""",
)
def _(m):
    """Each product against a pattern of its own."""
    key = F.col("product_id")
    color = F.element_at(F.array(*[F.lit(c) for c in ("Black", "White", "Silver")]), (key % 3 + 1).cast("int"))
    more = F.when(key % 5 == 0, ', "warranty_months": 12').otherwise("")
    pattern = F.concat(F.lit('{"color": "'), color, F.lit('"'), more, F.lit("}"))
    return m.products.select("product_id", jsonq.contains_column(jsonq.parsed(F.col("product_attributes")), jsonq.parsed(pattern)).alias("fits"))


@check(
    "clustered_write_by",
    "s_orders",
    """SELECT count(*) AS row_count, count(DISTINCT order_id) AS orders, CAST(16 AS BIGINT) AS files, TRUE AS customers_skip_half, TRUE AS times_skip_half
    FROM s_orders""",
)
def _(m):
    """Orders in order of customer and time at once: a tenth of either range meets at most half of the files."""
    path = new_table_path(m.spark, "orders_interleaved")
    layout.clustered_write_by(m.orders, path, ["customer_id", "order_purchase_timestamp"], files=16)
    table = m.spark.read.parquet(path)
    ends = m.orders.agg(*[F.percentile_approx("customer_id", p).alias(n) for p, n in ((0.4, "a"), (0.5, "b"))]).first()
    times = m.orders.agg(*[F.percentile_approx(F.unix_micros(F.col("order_purchase_timestamp").cast("timestamp")), p).alias(n) for p, n in ((0.4, "a"), (0.5, "b"))])
    time = times.select(*[F.timestamp_micros(c).cast("timestamp_ntz").alias(c) for c in ("a", "b")]).first()
    by_customer = layout.files_met(table, "customer_id", ends["a"], ends["b"])
    by_time = layout.files_met(table, "order_purchase_timestamp", time["a"], time["b"])
    half = lambda met: met.select(F.col("files_met") * 2 <= F.col("files")).scalar()
    totals = table.agg(F.count("*").alias("row_count"), F.count_distinct("order_id").alias("orders"))
    return totals.select("*", by_time.select("files").scalar().alias("files"), half(by_customer).alias("customers_skip_half"), half(by_time).alias("times_skip_half"))
