"""Retail query pack over orders, items, payments, customers, sellers and products.

No join is forced to broadcast without a count of its rows: Catalyst broadcasts a side when its size (known
from the files or measured at run time) is under the session's threshold, and
uses a shuffle join with skew splitting beyond it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercato.functions import jsonq
from mercato.functions.dates import as_date, as_timestamp, days_calendar, days_trunc
from mercato.functions.numeric import count_where, mean, percent, round_half_up
from mercato.functions.ordering import newest_first, smallest_first, top_k
from mercato.operators.layout import MONTH, months_of
from mercato.session import settled

PURCHASE = "order_purchase_timestamp"
DELIVERED_AT = "order_delivered_customer_date"
ESTIMATE = "order_estimated_delivery_date"
#: Rows of one order that are broadcast, at most.
POINT_ROWS = 10_000


def purchased_between(start: str | None = None, end: str | None = None) -> Column:
    """Half-open range on the purchase time, written so the scan can use it."""
    kept = F.lit(True)
    if start is not None:
        kept = kept & (F.col(PURCHASE) >= as_timestamp(start))
    if end is not None:
        kept = kept & (F.col(PURCHASE) < as_timestamp(end))
    return kept


def delivered(orders: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """Delivered orders of a period."""
    return orders.where((F.col("order_status") == "delivered") & purchased_between(start, end))


# -- customer history -------------------------------------------------------

HISTORY = ["order_id", PURCHASE, "order_status", DELIVERED_AT]


def _with_item_totals(orders: DataFrame, items: DataFrame) -> DataFrame:
    totals = F.sum(F.col("price") + F.col("freight_value")).alias("total_value")
    return (
        orders.select(*HISTORY)
        .join(items.select("order_id", "order_item_id", "price", "freight_value"), "order_id")
        .groupBy(*HISTORY)
        .agg(F.count("order_item_id").alias("total_items"), totals)
    )


def customer_order_history(orders: DataFrame, items: DataFrame, customer_id: object, n: int = 20) -> DataFrame:
    """A customer's newest ``n`` orders that have items."""
    mine = orders.where(F.col("customer_id") == customer_id)
    return top_k(_with_item_totals(mine, items), n, [newest_first(PURCHASE)], ["order_id"])


def customer_order_history_limit_first(
    orders: DataFrame, items: DataFrame, customer_id: object, n: int = 20
) -> DataFrame:
    """The newest ``n`` orders first, then their items: an order without items drops out."""
    mine = top_k(orders.where(F.col("customer_id") == customer_id).select(*HISTORY), n, [newest_first(PURCHASE)], ["order_id"])
    return _with_item_totals(mine, items).orderBy(newest_first(PURCHASE), "order_id")


def customer_status_history(orders: DataFrame, customer_id: object, status: str, n: int = 10) -> DataFrame:
    """A customer's newest orders in one status."""
    mine = orders.where((F.col("customer_id") == customer_id) & (F.col("order_status") == status))
    return top_k(mine.select("order_id", PURCHASE, DELIVERED_AT), n, [newest_first(PURCHASE)], ["order_id"])


# -- sales ------------------------------------------------------------------


def _category_sales(
    items: DataFrame, products: DataFrame, translation: DataFrame, orders: DataFrame, start: str, end: str
) -> DataFrame:
    # Products are translated before they meet the items: joining all items on
    # the category would put a popular category into one partition.
    named = products.select("product_id", "product_category_name").join(translation, "product_category_name", "left")
    sold = (
        items.select("order_id", "order_item_id", "product_id", "price", "freight_value")
        .join(delivered(orders, start, end).select("order_id"), "order_id")
        .join(named.select("product_id", "product_category_name_english"), "product_id")
    )
    # One row per category and order first: the distinct count becomes a plain
    # count and a category with a third of all items is spread over its orders.
    per_order = sold.groupBy(F.col("product_category_name_english").alias("category"), "order_id").agg(
        F.count("order_item_id").alias("items"),
        F.count("price").alias("prices"),
        F.sum("price").alias("revenue"),
        F.min("price").alias("low"),
        F.max("price").alias("high"),
        F.sum("freight_value").alias("freight"),
    )
    return per_order.groupBy("category").agg(
        F.count("*").alias("total_orders"),
        F.sum("items").alias("total_items_sold"),
        F.sum("revenue").alias("total_revenue"),
        round_half_up(F.sum("revenue").cast("double") / F.sum("prices"), 6).alias("avg_price"),
        F.min("low").alias("min_price"),
        F.max("high").alias("max_price"),
        F.sum("freight").alias("total_freight"),
    )


def category_sales(
    items: DataFrame, products: DataFrame, translation: DataFrame, orders: DataFrame, start: str, end: str, n: int = 20
) -> DataFrame:
    """Sales of delivered orders per category; untranslated categories form one NULL group."""
    sales = _category_sales(items, products, translation, orders, start, end)
    return top_k(sales, n, [newest_first("total_revenue")], ["category"])


def category_sales_labelled(
    items: DataFrame,
    products: DataFrame,
    translation: DataFrame,
    orders: DataFrame,
    start: str,
    end: str,
    n: int = 20,
    null_label: str = "Uncategorized",
) -> DataFrame:
    """As :func:`category_sales` with a label on the NULL group.

    The label is put on after grouping, so a category that really has this
    name stays a row of its own.
    """
    sales = _category_sales(items, products, translation, orders, start, end)
    head = top_k(sales, n, [newest_first("total_revenue")], ["category"])
    return head.withColumn("category", F.coalesce("category", F.lit(null_label)))


def state_sales(orders: DataFrame, customers: DataFrame, items: DataFrame, start: str, end: str) -> DataFrame:
    """Orders and sales of delivered orders per customer state."""
    sold = (
        delivered(orders, start, end)
        .select("order_id", "customer_id")
        .join(customers.select("customer_id", "customer_state"), "customer_id")
        .join(items.select("order_id", "price"), "order_id")
    )
    by_state = sold.groupBy("customer_state").agg(
        F.count_distinct("order_id").alias("total_orders"), F.sum("price").alias("total_sales")
    )
    return by_state.orderBy(newest_first("total_sales"), "customer_state")


# -- payments ---------------------------------------------------------------


def _payment_totals(recent: DataFrame, payments: DataFrame) -> DataFrame:
    # The period is applied before the payments are aggregated.  The set of
    # types holds at most the handful of payment types there are.
    paid = recent.select("order_id", "customer_id", "order_status").join(payments, "order_id")
    return paid.groupBy("order_id", "customer_id", "order_status").agg(
        F.count("payment_sequential").alias("payment_methods_count"),
        F.coalesce(F.sum("payment_value"), F.lit(0)).alias("total_paid"),
        F.max("payment_installments").alias("max_installments"),
        F.nullif(F.array_join(F.sort_array(F.collect_set("payment_type")), ", "), F.lit("")).alias("payment_types"),
    )


def order_payment_summary(
    orders: DataFrame, payments: DataFrame, as_of: str | None = None, days: int = 30, min_total: float = 500
) -> DataFrame:
    """Payments per order of the last ``days`` days, above a minimum."""
    since = F.date_sub(as_date(as_of), days).cast("timestamp_ntz")
    # The minimum drops orders without payments, so the outer join is an inner one.
    summary = _payment_totals(orders.where(F.col(PURCHASE) >= since), payments)
    return summary.where(F.col("total_paid") > min_total).orderBy(newest_first("total_paid"), "order_id")


def order_payment_summary_bounded(
    orders: DataFrame, payments: DataFrame, as_of: str | None = None, days: int = 30, min_total: float = 500
) -> DataFrame:
    """As above with an upper time bound; unpaid orders count as zero, so a negative minimum keeps them."""
    day = as_date(as_of)
    since, until = F.date_sub(day, days).cast("timestamp_ntz"), F.date_add(day, 1).cast("timestamp_ntz")
    recent = orders.where((F.col(PURCHASE) >= since) & (F.col(PURCHASE) < until))
    summary = _payment_totals(recent, payments)
    if min_total < 0:
        unpaid = recent.join(payments.select("order_id").distinct(), "order_id", "left_anti")
        blank = unpaid.select(
            "order_id", "customer_id", "order_status", F.lit(0).alias("payment_methods_count"), F.lit(0).alias("total_paid")
        )
        summary = summary.unionByName(blank, allowMissingColumns=True)
    return summary.where(F.col("total_paid") > min_total).orderBy(newest_first("total_paid"), "order_id")


# -- products ---------------------------------------------------------------


def _best_products(
    products: DataFrame, items: DataFrame, orders: DataFrame, how: str, units: Column, revenue: Column, min_orders: int, n: int, digits: int
) -> DataFrame:
    """The ``n`` products with most revenue over the items joined to arrived orders by ``how``.

    Items are summed per product and order first, so a popular product is spread over
    its orders and the second step only counts rows.  Sellers are counted for the
    winners alone, at most ``n`` keys, which may be broadcast at any size of the data.
    The winners are written, so finding them is not repeated for their sellers.  The
    orders of a partition are hashed, which leaves the items unsorted: the sums need
    the memory.
    """
    arrived = _arrived(orders)
    sold = items.join(arrived.hint("shuffle_hash"), "order_id", how)
    per_order = sold.groupBy("product_id", "order_id").agg(
        units.alias("units"),
        revenue.alias("revenue"),
        F.sum("price").alias("prices"),
        F.count("price").alias("priced"),
        F.sum("freight_value").alias("freight"),
    )
    per_product = per_order.groupBy("product_id").agg(
        F.count("order_id").alias("orders_count"),
        F.sum("units").alias("total_items_sold"),
        F.sum("revenue").alias("total_revenue"),
        (F.sum("prices").cast("double") / F.sum("priced")).alias("avg_unit_price"),
        F.sum("freight").alias("total_freight_cost"),
    )
    frequent = per_product.where(F.col("orders_count") >= min_orders).join(
        products.select("product_id", "product_category_name"), "product_id"
    )
    order, ties = [newest_first("total_revenue")], ["product_id"]
    best = settled(top_k(frequent, n, order, ties), "best_products")
    winners = F.broadcast(best.select("product_id"))
    theirs = items.select("order_id", "product_id", "seller_id").join(winners, "product_id", "left_semi")
    sellers = theirs.join(arrived, "order_id", "left_semi").select("product_id", "seller_id").distinct()
    counted = sellers.groupBy("product_id").agg(F.count("seller_id").alias("sellers_count"))
    ranked = best.join(F.broadcast(counted), "product_id").withColumn("avg_unit_price", round_half_up(F.col("avg_unit_price"), digits))
    columns = ["product_id", "product_category_name", "orders_count", "total_items_sold", "total_revenue", "avg_unit_price"]
    return top_k(ranked.select(*columns, "total_freight_cost", "sellers_count"), n, order, ties)


def _arrived(orders: DataFrame) -> DataFrame:
    return delivered(orders).where(F.col(DELIVERED_AT).isNotNull()).select("order_id")


LINE_UNITS = "order_item_id"


def top_products(
    products: DataFrame, items: DataFrame, orders: DataFrame, min_orders: int = 10, n: int = 50
) -> DataFrame:
    """Best products by revenue with the line number taken as the quantity."""
    units, revenue = F.sum(LINE_UNITS), F.sum(F.col("price") * F.col(LINE_UNITS))
    return _best_products(products, items, orders, "inner", units, revenue, min_orders, n, 6)


def top_products_exists(
    products: DataFrame, items: DataFrame, orders: DataFrame, min_orders: int = 10, n: int = 50
) -> DataFrame:
    """As :func:`top_products` through a semi join, so a repeated order does not multiply its items."""
    units, revenue = F.sum(LINE_UNITS), F.sum(F.col("price") * F.col(LINE_UNITS))
    return _best_products(products, items, orders, "left_semi", units, revenue, min_orders, n, 2)


def top_products_corrected(
    products: DataFrame, items: DataFrame, orders: DataFrame, min_orders: int = 10, n: int = 50
) -> DataFrame:
    """One unit per item line, revenue as the sum of prices."""
    return _best_products(products, items, orders, "left_semi", F.count("*"), F.sum("price"), min_orders, n, 2)


def product_attr_contains(products: DataFrame, pattern: object, category: str, n: int = 100) -> DataFrame:
    """Products of a category whose attributes contain the pattern."""
    attributes = jsonq.parsed(F.col("product_attributes"))
    found = (
        products.where(F.col("product_category_name") == category)
        .withColumn("_attributes", attributes)
        .where(jsonq.contains(F.col("_attributes"), pattern))
        .select(
            "product_id",
            "product_category_name",
            "product_weight_g",
            jsonq.text_at(F.col("_attributes"), "voltage").alias("voltage"),
            jsonq.text_at(F.col("_attributes"), "color").alias("color"),
            "product_attributes",
        )
    )
    return top_k(found, n, [], ["product_id"])


def product_attr_min(products: DataFrame, key: str, low: int, n: int = 100, safe: bool = False) -> DataFrame:
    """Products that have an attribute of at least ``low``."""
    found = (
        products.withColumn("_attributes", jsonq.parsed(F.col("product_attributes")))
        .where(jsonq.has_key(F.col("_attributes"), key))
        .where(jsonq.int_at(F.col("_attributes"), key, safe) >= low)
        .select("product_id", "product_category_name", "product_attributes")
    )
    return top_k(found, n, [], ["product_id"])


# -- logistics --------------------------------------------------------------


def _pending(orders: DataFrame, customers: DataFrame, as_of: str | None, days: int, urgent: int) -> DataFrame:
    day = as_date(as_of)
    waiting = (
        F.col("order_status").isin("processing", "shipped")
        & F.col(DELIVERED_AT).isNull()
        & (F.col(PURCHASE) >= F.date_sub(day, days).cast("timestamp_ntz"))
    )
    level = (
        F.when(F.col(ESTIMATE) < day.cast("timestamp_ntz"), 1)
        .when(F.col(ESTIMATE) <= F.date_add(day, urgent).cast("timestamp_ntz"), 2)
        .otherwise(3)
    )
    label = F.when(F.col("_level") == 1, "DELAYED").when(F.col("_level") == 2, "URGENT").otherwise("ON_TIME")
    return (
        orders.where(waiting)
        .withColumn("_level", level)
        .join(customers.select("customer_id", "customer_state", "customer_city"), "customer_id")
        .withColumn("delivery_priority", label)
    )


def _pending_columns(pending: DataFrame, age: Column) -> DataFrame:
    return (
        pending.withColumn("days_since_purchase", age)
        .orderBy("_level", smallest_first(ESTIMATE), "order_id")
        .select(
            "order_id",
            "customer_id",
            "customer_state",
            "customer_city",
            "order_status",
            PURCHASE,
            ESTIMATE,
            "order_delivered_carrier_date",
            "days_since_purchase",
            "delivery_priority",
        )
    )


def pending_deliveries(
    orders: DataFrame, customers: DataFrame, as_of: str | None = None, days: int = 60, urgent: int = 2
) -> DataFrame:
    """Open orders by urgency, with the whole days from purchase to the report time, now by default."""
    now = F.localtimestamp() if as_of is None else as_timestamp(as_of)
    age = days_trunc(now, F.col(PURCHASE))
    return _pending_columns(_pending(orders, customers, as_of, days, urgent), age)


def pending_deliveries_prioritised(
    orders: DataFrame, customers: DataFrame, as_of: str | None = None, days: int = 60, urgent: int = 2
) -> DataFrame:
    """As above with calendar days since purchase."""
    age = days_calendar(as_date(as_of), F.col(PURCHASE))
    return _pending_columns(_pending(orders, customers, as_of, days, urgent), age)


def delivery_delay_stats(orders: DataFrame, start: str) -> DataFrame:
    """Late share per status; the average delay covers all delivered rows."""
    arrived = orders.where(F.col(DELIVERED_AT).isNotNull() & purchased_between(start))
    late = count_where(F.col(DELIVERED_AT) > F.col(ESTIMATE))
    stats = arrived.groupBy("order_status").agg(
        F.count("*").alias("total_orders"),
        late.alias("delayed_orders"),
        percent(late, F.count("*"), 2).alias("delay_percentage"),
        mean(days_trunc(F.col(DELIVERED_AT), F.col(ESTIMATE))).alias("avg_delay_days"),
    )
    return stats.orderBy(newest_first("delay_percentage"), "order_status")


def delivery_delay_stats_delayed_only(orders: DataFrame, start: str) -> DataFrame:
    """Late share per status; the average covers late rows only, in calendar days."""
    arrived = orders.where(F.col(DELIVERED_AT).isNotNull() & purchased_between(start))
    is_late = F.col(DELIVERED_AT) > F.col(ESTIMATE)
    delay = days_calendar(F.col(DELIVERED_AT), F.col(ESTIMATE))
    late = F.sum(F.when(is_late, 1).otherwise(0))
    stats = arrived.groupBy("order_status").agg(
        F.count("*").alias("total_orders"),
        late.alias("delayed_orders"),
        percent(late, F.count("*"), 2).alias("delay_percentage"),
        mean(F.when(is_late, delay), 1).alias("avg_delay_days"),
    )
    return stats.orderBy(newest_first("delay_percentage"), "order_status")


# -- sellers and geography --------------------------------------------------


def _seller_totals(items: DataFrame, orders: DataFrame, start: str, end: str, min_revenue: float) -> DataFrame:
    sold = items.join(delivered(orders, start, end).select("order_id"), "order_id")
    per_order = sold.groupBy("seller_id", "order_id").agg(
        F.count("order_item_id").alias("items"),
        F.sum("price").alias("gross"),
        F.sum("freight_value").alias("freight"),
        F.sum(F.col("price") + F.col("freight_value")).alias("total"),
        F.count("price").alias("prices"),
        F.max("price").alias("high"),
    )
    totals = per_order.groupBy("seller_id").agg(
        F.count("*").alias("total_orders"),
        F.sum("items").alias("total_items"),
        F.sum("gross").alias("gross_revenue"),
        F.sum("freight").alias("freight_revenue"),
        F.sum("total").alias("total_revenue"),
        (F.sum("gross").cast("double") / F.sum("prices")).alias("avg_item_price"),
        F.max("high").alias("max_item_price"),
    )
    return totals.where(F.col("gross_revenue") > min_revenue)


def seller_revenue(
    sellers: DataFrame, items: DataFrame, orders: DataFrame, start: str, end: str, min_rev: float = 1000, n: int = 100
) -> DataFrame:
    """Best sellers of a period, place first."""
    totals = _seller_totals(items, orders, start, end, min_rev)
    totals = totals.withColumn("avg_item_price", round_half_up(F.col("avg_item_price"), 6))
    ranked = sellers.select("seller_id", "seller_state", "seller_city").join(totals, "seller_id")
    return top_k(ranked, n, [newest_first("total_revenue")], ["seller_id"])


def seller_revenue_preagg(
    sellers: DataFrame, items: DataFrame, orders: DataFrame, start: str, end: str, min_rev: float = 1000, n: int = 100
) -> DataFrame:
    """Best sellers of a period, metrics first and the average rounded to cents."""
    totals = _seller_totals(items, orders, start, end, min_rev)
    totals = totals.withColumn("avg_item_price", round_half_up(F.col("avg_item_price"), 2))
    ranked = totals.join(sellers.select("seller_id", "seller_state", "seller_city"), "seller_id")
    return top_k(ranked.select(*totals.columns, "seller_state", "seller_city"), n, [newest_first("total_revenue")], ["seller_id"])


SUMS = ("prices", "priced", "days", "timed")


def _geo_matrix(
    orders: DataFrame, customers: DataFrame, items: DataFrame, sellers: DataFrame, start: str, days: Column, min_orders: int
) -> DataFrame:
    arrived = (
        delivered(orders, start)
        .where(F.col(DELIVERED_AT).isNotNull())
        .select("order_id", "customer_id", days.alias("_days"))
    )
    placed = arrived.join(customers.select("customer_id", "customer_state"), "customer_id")
    lines = placed.join(items.select("order_id", "seller_id", "price"), "order_id").join(
        sellers.select("seller_id", "seller_state"), "seller_id"
    )
    states = ["customer_state", "seller_state"]
    # One row per order and seller with partial sums; every distinct count then groups those rows once more.
    parts = lines.groupBy(*states, "order_id", "customer_id", "seller_id").agg(
        F.sum("price").alias("prices"), F.count("price").alias("priced"), F.sum("_days").alias("days"), F.count("_days").alias("timed")
    )
    # An order has one customer, so orders nest in customers.
    per_order = parts.groupBy(*states, "customer_id", "order_id").agg(*[F.sum(c).alias(c) for c in SUMS])
    per_customer = per_order.groupBy(*states, "customer_id").agg(F.count("*").alias("orders"), *[F.sum(c).alias(c) for c in SUMS])
    totals = per_customer.groupBy(*states).agg(
        F.sum("orders").alias("total_orders"), F.count("*").alias("unique_customers"), *[F.sum(c).alias(c) for c in SUMS]
    )
    sellers_seen = parts.select(*states, "seller_id").distinct().groupBy(*states).agg(F.count("*").alias("unique_sellers"))
    same = [totals[c].eqNullSafe(sellers_seen[c]) for c in states]
    matrix = totals.join(sellers_seen, same).select(
        totals["customer_state"],
        totals["seller_state"],
        "total_orders",
        "unique_customers",
        "unique_sellers",
        F.col("prices").alias("total_sales"),
        (F.col("prices").cast("double") / F.nullif(F.col("priced"), F.lit(0))).alias("avg_order_value"),
        (F.col("days").cast("double") / F.nullif(F.col("timed"), F.lit(0))).alias("avg_delivery_days"),
    )
    return matrix.where(F.col("total_orders") >= min_orders)


def geo_sales_matrix(
    orders: DataFrame, customers: DataFrame, items: DataFrame, sellers: DataFrame, start: str, min_orders: int = 100
) -> DataFrame:
    """Sales from seller state to customer state; averages are per item."""
    days = days_trunc(F.col(DELIVERED_AT), F.col(PURCHASE))
    matrix = _geo_matrix(orders, customers, items, sellers, start, days, min_orders)
    for name in ("avg_order_value", "avg_delivery_days"):
        matrix = matrix.withColumn(name, round_half_up(F.col(name), 6))
    return matrix.orderBy(newest_first("total_sales"), "customer_state", "seller_state")


def geo_sales_matrix_rounded(
    orders: DataFrame, customers: DataFrame, items: DataFrame, sellers: DataFrame, start: str, min_orders: int = 100
) -> DataFrame:
    """As above with calendar days and rounded figures."""
    days = days_calendar(F.col(DELIVERED_AT), F.col(PURCHASE))
    matrix = _geo_matrix(orders, customers, items, sellers, start, days, min_orders)
    for name, digits in (("total_sales", 2), ("avg_order_value", 2), ("avg_delivery_days", 1)):
        matrix = matrix.withColumn(name, round_half_up(F.col(name), digits))
    return matrix.orderBy(newest_first("total_sales"), "customer_state", "seller_state")


# -- single orders and periods ----------------------------------------------


def order_detail(
    orders: DataFrame,
    customers: DataFrame,
    items: DataFrame,
    products: DataFrame,
    sellers: DataFrame,
    payments: DataFrame,
    order_id: object,
) -> DataFrame:
    """Everything about one order: each item next to each payment.

    An order with few rows is broadcast to the dimensions, which are then scanned in place
    and never shuffled.  Whether it has few is counted first, up to `POINT_ROWS` of each
    table; a larger one is joined as Spark sees fit.
    """
    one = F.col("order_id") == order_id
    sides = {name: table.where(one) for name, table in (("orders", orders), ("items", items), ("payments", payments))}
    counted = reduce(DataFrame.unionAll, [side.select(F.lit(name).alias("side")).limit(POINT_ROWS + 1) for name, side in sides.items()])
    found = {r["side"]: r["count"] for r in counted.groupBy("side").count().collect()}
    few = {name: found.get(name, 0) for name in sides}
    small = lambda df, rows: F.broadcast(df) if rows <= POINT_ROWS else df
    placed = customers.join(small(sides["orders"], few["orders"]), "customer_id")
    lines = placed.join(small(sides["items"], few["items"]), "order_id")
    # An order joins one customer and each of its items one product and seller.
    width = few["orders"] * few["items"]
    described = products.select("product_id", "product_category_name").join(small(lines, width), "product_id")
    return (
        sellers.join(small(described, width), "seller_id")
        .join(small(sides["payments"], few["payments"]), "order_id", "left")
        .orderBy(smallest_first("order_item_id"), smallest_first("payment_sequential"))
        .select(
            "order_id",
            PURCHASE,
            "order_status",
            DELIVERED_AT,
            "customer_unique_id",
            "customer_city",
            "customer_state",
            "order_item_id",
            "product_category_name",
            "price",
            "freight_value",
            "seller_city",
            "seller_state",
            "payment_type",
            "payment_installments",
            "payment_value",
        )
    )


def period_delivery_summary(orders: DataFrame, start: str, end: str) -> DataFrame:
    """Orders, delivered orders and average delivery days of a period."""
    return orders.where(purchased_between(start, end)).agg(
        F.count("*").alias("total_orders"),
        F.sum(F.when(F.col("order_status") == "delivered", 1).otherwise(0)).alias("delivered_orders"),
        mean(days_trunc(F.col(DELIVERED_AT), F.col(PURCHASE))).alias("avg_delivery_days"),
    )


def period_avg_interval(orders: DataFrame, start: str, end: str) -> DataFrame:
    """Delivered orders of a period and their average delivery time as an interval and in seconds."""
    took = F.col(DELIVERED_AT) - F.col(PURCHASE)
    seconds = F.timestamp_diff("SECOND", F.col(PURCHASE), F.col(DELIVERED_AT))
    return delivered(orders, start, end).agg(
        F.count("*").alias("total_orders"),
        F.avg(took).alias("avg_delivery_time"),
        mean(seconds, 3).alias("avg_delivery_seconds"),
    )


def status_counts(orders: DataFrame) -> DataFrame:
    """Orders per status."""
    return orders.groupBy("order_status").agg(F.count("*").alias("total_orders"))


def order_lookup_in_month(orders: DataFrame, order_id: object, start: str, end: str) -> DataFrame:
    """One order of a period.

    On the monthly table (see ``operators.layout``) the months of the period become
    partition filters, so the scan opens only their folders and ``default``.
    """
    found = orders.where((F.col("order_id") == order_id) & purchased_between(start, end))
    return found.where(months_of(start, end)) if MONTH in orders.columns else found
