"""Registered queries over bounds, frequent values and stored sketches."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.checks.registry import check
from mercato.operators import bounds, frequent, sketches
from mercato.operators.profile import literal_rows
from mercato.session import new_table_path

# Uneven FROM and TO bounds with a gap, an open end and one range without rows.
SPANS = [
    ("first", None, "1995-03-01"), ("spring", "1995-03-01", "1995-06-15"), ("one_day", "1995-06-15", "1995-06-16"),
    ("later", "1996-01-01", "1999-07-09"), ("tail", "1999-07-09", "2010-01-01"), ("future", "2010-01-01", None),
]


def _spans(m) -> DataFrame:
    rows = literal_rows(m.spark, ["name", "low", "high"], SPANS)
    return rows.select("name", *[F.col(c).cast("timestamp_ntz").alias(c) for c in ("low", "high")])


def _case(column: str) -> str:
    within = lambda low, high: " AND ".join([f"{column} >= TIMESTAMP '{low}'"] * (low is not None) + [f"{column} < TIMESTAMP '{high}'"] * (high is not None))
    return "CASE " + " ".join(f"WHEN {within(low, high)} THEN '{name}'" for name, low, high in SPANS) + " ELSE 'default' END"


@check("assign_ranges", "s_orders", f"SELECT order_id, {_case('order_purchase_timestamp')} AS part FROM s_orders")
def _(m):
    return bounds.assign_ranges(m.orders.select("order_id", "order_purchase_timestamp"), "order_purchase_timestamp", _spans(m)).select("order_id", "part")


@check(
    "assign_ranges_joined",
    "s_orders",
    f"SELECT order_id, {_case('order_delivered_customer_date')} AS part FROM s_orders",
)
def _(m):
    """The join that many bounds take, on a column with NULL values."""
    rows = m.orders.select("order_id", "order_delivered_customer_date")
    return bounds.assign_ranges(rows, "order_delivered_customer_date", _spans(m), small=0).select("order_id", "part")


@check(
    "range_counts",
    "",
    f"""SELECT part, CAST(coalesce(row_count, 0) AS BIGINT) AS row_count
    FROM (SELECT unnest([{", ".join(f"'{n}'" for n, _, _ in SPANS)}, 'default']) AS part)
    LEFT JOIN (SELECT {_case("l_shipdate")} AS part, count(*) AS row_count FROM lineitem GROUP BY 1) USING (part)""",
)
def _(m):
    return bounds.range_counts(m.table("lineitem"), "l_shipdate", _spans(m))


def _own_ranges(high: str) -> str:
    return f"""(SELECT strftime(order_purchase_timestamp, '%Y_%m') AS name, min(order_purchase_timestamp) AS low, max({high}) + INTERVAL 12 HOUR AS high
        FROM s_orders GROUP BY 1)"""


def _problems(kind: str, high: str) -> str:
    return f"""SELECT '{kind}' AS kind, CASE WHEN nlow < e THEN 'overlap' ELSE 'gap' END AS problem, name, next_name,
        CASE WHEN nlow < e THEN nlow ELSE e END AS low, CASE WHEN nlow < e THEN least(e, nhigh) ELSE nlow END AS high
    FROM (SELECT name, max(high) OVER w AS e, lead(name) OVER w AS next_name, lead(low) OVER w AS nlow, lead(high) OVER w AS nhigh
        FROM {_own_ranges(high)} WINDOW w AS (ORDER BY low, name)) WHERE next_name IS NOT NULL AND nlow <> e"""


@check(
    "bound_problems",
    "s_orders",
    _problems("bought", "order_purchase_timestamp") + " UNION ALL " + _problems("due", "order_estimated_delivery_date"),
)
def _(m):
    """The months as they are: from first to last purchase they leave gaps, to the last due date they overlap."""
    month = F.date_format("order_purchase_timestamp", "yyyy_MM").alias("name")
    found = []
    for kind, high in (("bought", "order_purchase_timestamp"), ("due", "order_estimated_delivery_date")):
        own = m.orders.groupBy(month).agg(F.min("order_purchase_timestamp").alias("low"), F.timestamp_add("HOUR", F.lit(12), F.max(high)).alias("high"))
        found.append(bounds.bound_problems(own).select(F.lit(kind).alias("kind"), "*"))
    return found[0].unionByName(found[1])


def _top(table: str, column: str) -> str:
    return f"""SELECT '{table}' AS "table", '{column}' AS "column", CAST({column} AS VARCHAR) AS top, count(*) AS freq FROM {table} WHERE {column} IS NOT NULL
        GROUP BY {column} QUALIFY row_number() OVER (ORDER BY count(*) DESC, CAST({column} AS VARCHAR)) = 1"""


FREQUENT = {"documents": ["lang", "source", "text"], "lineitem": ["l_partkey", "l_linenumber", "l_returnflag"], "events": ["user_id", "event_type"]}


@check("most_frequent", "", " UNION ALL ".join(f"({_top(t, c)})" for t, columns in FREQUENT.items() for c in columns))
def _(m):
    parts = [frequent.most_frequent(m.table(t), columns).select(F.lit(t).alias("table"), "column", "top", "freq") for t, columns in FREQUENT.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@check(
    "frequent_values",
    "",
    """SELECT CAST(row_number() OVER (ORDER BY count(*) DESC, CAST(l_partkey AS VARCHAR)) AS INTEGER) AS place, CAST(l_partkey AS VARCHAR) AS l_partkey, count(*) AS n
    FROM lineitem GROUP BY l_partkey QUALIFY place <= 10""",
)
def _(m):
    return frequent.frequent_values(m.table("lineitem"), "l_partkey", 10)


SPAN = ("1996_02", "1997_11")


@check(
    "sketch_distinct",
    "s_orders",
    f"""WITH o AS (SELECT * FROM s_orders WHERE strftime(order_purchase_timestamp, '%Y_%m') BETWEEN '{SPAN[0]}' AND '{SPAN[1]}')
    SELECT key, count(*) AS "rows", count(DISTINCT m) AS months, TRUE AS within_3_percent
    FROM (SELECT 'customer_id' AS key, strftime(order_purchase_timestamp, '%Y_%m') AS m FROM o UNION ALL
        SELECT 'order_id', strftime(order_purchase_timestamp, '%Y_%m') FROM o) GROUP BY 1""",
)
def _(m):
    """Estimates from stored sketches of months against exact counts of the same months."""
    path = new_table_path(m.spark, "order_sketches")
    sketches.monthly_sketches(m.orders, "order_purchase_timestamp", ["customer_id", "order_id"]).write.parquet(path)
    found = sketches.distinct_in(m.spark.read.parquet(path), *SPAN)
    inside = m.orders.where(F.date_format("order_purchase_timestamp", "yyyy_MM").between(*SPAN))
    exact = inside.agg(*[F.count_distinct(k).alias(k) for k in ("customer_id", "order_id")])
    long = exact.select(F.inline(F.array(*[F.struct(F.lit(k).alias("key"), F.col(k).alias("exact")) for k in exact.columns])))
    near = F.abs(F.col("distinct_values") - F.col("exact")) <= 0.03 * F.col("exact")
    return found.join(long, "key").select("key", "rows", "months", near.alias("within_3_percent"))


@check(
    "sketch_overlap",
    "",
    """SELECT TRUE AS left_near, TRUE AS right_near, TRUE AS shared_near""",
)
def _(m):
    """Customers who have orders, by sketches of orders and of customers, against exact counts."""
    orders = sketches.monthly_sketches(m.orders, "order_purchase_timestamp", ["customer_id"])
    customers = sketches.monthly_sketches(m.customers.withColumn("at", F.lit("2000-01-01").cast("timestamp_ntz")), "at", ["customer_id"])
    found = sketches.overlap(orders, customers, "customer_id", "customer_id")
    used, known = m.orders.select("customer_id").distinct(), m.customers.select("customer_id").distinct()
    exact = {"left": used, "right": known, "shared": used.join(known, "customer_id", "left_semi")}
    near = lambda name, value: (F.abs(F.col(name) - exact[value].agg(F.count("*")).scalar()) <= 0.03 * F.col(name)).alias(f"{value}_near")
    return found.select(near("left_values", "left"), near("right_values", "right"), near("shared", "shared"))
