"""Registered retail queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from mercato.checks.market import AS_OF, YEAR_END, YEAR_START
from mercato.checks.registry import check
from mercato.checks.sql import avg, big, calendar_days, dbl, half_up, pct, trunc_days
from mercato.plans import retail

TIMES = "order_purchase_timestamp"
IN_YEAR = f"o.order_purchase_timestamp >= TIMESTAMP '{YEAR_START}' AND o.order_purchase_timestamp < TIMESTAMP '{YEAR_END}'"
HALF_YEAR = f"o.order_purchase_timestamp >= TIMESTAMP '{YEAR_START}' AND o.order_purchase_timestamp < TIMESTAMP '1997-07-01'"
MONTH = f"o.order_purchase_timestamp >= TIMESTAMP '1997-06-01' AND o.order_purchase_timestamp < TIMESTAMP '1997-07-01'"
CUSTOMER = 7


def _history(source: str, limit: str) -> str:
    return f"""SELECT o.order_id, o.order_purchase_timestamp, o.order_status, o.order_delivered_customer_date,
        count(i.order_item_id) AS total_items, {dbl("sum(i.price + i.freight_value)")} AS total_value
    FROM {source} o JOIN s_items i ON o.order_id = i.order_id
    GROUP BY ALL ORDER BY o.order_purchase_timestamp DESC NULLS FIRST, o.order_id {limit}"""


@check("customer_order_history", "s_orders s_items", _history(f"(SELECT * FROM s_orders WHERE customer_id = {CUSTOMER})", "LIMIT 20"))
def _(m):
    return retail.customer_order_history(m.orders, m.items, CUSTOMER)


@check(
    "customer_order_history_first_customer",
    "s_orders s_items s_customers",
    _history("(SELECT * FROM s_orders WHERE customer_id = (SELECT min(customer_id) FROM s_customers))", "LIMIT 20"),
)
def _(m):
    return retail.customer_order_history(m.orders, m.items, m.customers.agg(F.min("customer_id")).scalar())


@check(
    "customer_order_history_limit_first",
    "s_orders s_items",
    _history(
        f"""(SELECT * FROM s_orders WHERE customer_id = {CUSTOMER}
        ORDER BY order_purchase_timestamp DESC NULLS FIRST, order_id LIMIT 20)""",
        "",
    ),
)
def _(m):
    return retail.customer_order_history_limit_first(m.orders, m.items, CUSTOMER)


@check(
    "customer_status_history",
    "s_orders",
    f"""SELECT order_id, order_purchase_timestamp, order_delivered_customer_date FROM s_orders
    WHERE customer_id = {CUSTOMER} AND order_status = 'delivered'
    ORDER BY order_purchase_timestamp DESC NULLS FIRST, order_id LIMIT 10""",
)
def _(m):
    return retail.customer_status_history(m.orders, CUSTOMER, "delivered")


def _categories(label: str) -> str:
    return f"""SELECT {label} AS category, total_orders, total_items_sold, total_revenue, avg_price, min_price, max_price,
        total_freight FROM (
        SELECT t.product_category_name_english AS raw, count(DISTINCT i.order_id) AS total_orders,
            count(i.order_item_id) AS total_items_sold, {dbl("sum(i.price)")} AS total_revenue, {avg("i.price")} AS avg_price,
            {dbl("min(i.price)")} AS min_price, {dbl("max(i.price)")} AS max_price,
            {dbl("sum(i.freight_value)")} AS total_freight
        FROM s_items i JOIN s_products p ON i.product_id = p.product_id
        LEFT JOIN s_translation t ON p.product_category_name = t.product_category_name
        JOIN s_orders o ON i.order_id = o.order_id
        WHERE o.order_status = 'delivered' AND {IN_YEAR}
        GROUP BY 1 ORDER BY total_revenue DESC NULLS FIRST, raw LIMIT 20)"""


@check("category_sales", "s_items s_products s_translation s_orders", _categories("raw"))
def category_sales(m):
    return retail.category_sales(m.items, m.products, m.translation, m.orders, YEAR_START, YEAR_END)


@check(
    "category_sales_labelled",
    "s_items s_products s_translation s_orders",
    _categories("coalesce(raw, 'Uncategorized')"),
)
def _(m):
    return retail.category_sales_labelled(m.items, m.products, m.translation, m.orders, YEAR_START, YEAR_END)


def _payments(upper: str) -> str:
    return f"""SELECT o.order_id, o.customer_id, o.order_status, count(p.payment_sequential) AS payment_methods_count,
        {dbl("sum(p.payment_value)")} AS total_paid, max(p.payment_installments) AS max_installments,
        string_agg(DISTINCT p.payment_type, ', ' ORDER BY p.payment_type) AS payment_types
    FROM s_orders o LEFT JOIN s_payments p ON o.order_id = p.order_id
    WHERE o.order_purchase_timestamp >= TIMESTAMP '{AS_OF}' - INTERVAL 30 DAY {upper}
    GROUP BY 1, 2, 3 HAVING sum(p.payment_value) > 500"""


@check("order_payment_summary", "s_orders s_payments", _payments(""))
def _(m):
    return retail.order_payment_summary(m.orders, m.payments, AS_OF)


@check(
    "order_payment_summary_bounded",
    "s_orders s_payments",
    _payments(f"AND o.order_purchase_timestamp < TIMESTAMP '{AS_OF}' + INTERVAL 1 DAY"),
)
def _(m):
    return retail.order_payment_summary_bounded(m.orders, m.payments, AS_OF)


def _products(units: str, revenue: str, digits: int) -> str:
    return f"""SELECT p.product_id, p.product_category_name, count(DISTINCT i.order_id) AS orders_count,
        {big(units)} AS total_items_sold, {dbl(revenue)} AS total_revenue, {avg("i.price", digits)} AS avg_unit_price,
        {dbl("sum(i.freight_value)")} AS total_freight_cost, count(DISTINCT i.seller_id) AS sellers_count
    FROM s_products p JOIN s_items i ON p.product_id = i.product_id
    WHERE EXISTS (SELECT 1 FROM s_orders o WHERE o.order_id = i.order_id AND o.order_status = 'delivered'
        AND o.order_delivered_customer_date IS NOT NULL)
    GROUP BY 1, 2 HAVING count(DISTINCT i.order_id) >= 10
    ORDER BY total_revenue DESC NULLS FIRST, p.product_id LIMIT 50"""


@check("top_products", "s_products s_items s_orders", _products("sum(i.order_item_id)", "sum(i.price * i.order_item_id)", 6))
def _(m):
    return retail.top_products(m.products, m.items, m.orders)


@check("top_products_exists", "s_products s_items s_orders", _products("sum(i.order_item_id)", "sum(i.price * i.order_item_id)", 2))
def _(m):
    return retail.top_products_exists(m.products, m.items, m.orders)


@check("top_products_corrected", "s_products s_items s_orders", _products("count(*)", "sum(i.price)", 2))
def _(m):
    return retail.top_products_corrected(m.products, m.items, m.orders)


def _pending(days: str) -> str:
    return f"""SELECT o.order_id, o.customer_id, c.customer_state, c.customer_city, o.order_status,
        o.order_purchase_timestamp, o.order_estimated_delivery_date, o.order_delivered_carrier_date,
        {days} AS days_since_purchase,
        CASE WHEN o.order_estimated_delivery_date < TIMESTAMP '{AS_OF}' THEN 'DELAYED'
            WHEN o.order_estimated_delivery_date <= TIMESTAMP '{AS_OF}' + INTERVAL 2 DAY THEN 'URGENT'
            ELSE 'ON_TIME' END AS delivery_priority
    FROM s_orders o JOIN s_customers c ON o.customer_id = c.customer_id
    WHERE o.order_status IN ('processing', 'shipped') AND o.order_delivered_customer_date IS NULL
        AND o.order_purchase_timestamp >= TIMESTAMP '{AS_OF}' - INTERVAL 60 DAY"""


@check("pending_deliveries", "s_orders s_customers", _pending(trunc_days(f"TIMESTAMP '{AS_OF}'", "o.order_purchase_timestamp")))
def _(m):
    return retail.pending_deliveries(m.orders, m.customers, AS_OF)


@check(
    "pending_deliveries_prioritised",
    "s_orders s_customers",
    _pending(calendar_days(f"TIMESTAMP '{AS_OF}'", "o.order_purchase_timestamp")),
)
def _(m):
    return retail.pending_deliveries_prioritised(m.orders, m.customers, AS_OF)


def _sellers(digits: int) -> str:
    return f"""SELECT s.seller_id, s.seller_state, s.seller_city, count(DISTINCT i.order_id) AS total_orders,
        count(i.order_item_id) AS total_items, {dbl("sum(i.price)")} AS gross_revenue,
        {dbl("sum(i.freight_value)")} AS freight_revenue, {dbl("sum(i.price + i.freight_value)")} AS total_revenue,
        {avg("i.price", digits)} AS avg_item_price, {dbl("max(i.price)")} AS max_item_price
    FROM s_sellers s JOIN s_items i ON s.seller_id = i.seller_id JOIN s_orders o ON i.order_id = o.order_id
    WHERE o.order_status = 'delivered' AND {IN_YEAR}
    GROUP BY 1, 2, 3 HAVING sum(i.price) > 1000
    ORDER BY total_revenue DESC NULLS FIRST, s.seller_id LIMIT 100"""


@check("seller_revenue", "s_sellers s_items s_orders", _sellers(6))
def _(m):
    return retail.seller_revenue(m.sellers, m.items, m.orders, YEAR_START, YEAR_END)


@check("seller_revenue_preagg", "s_sellers s_items s_orders", _sellers(2))
def _(m):
    return retail.seller_revenue_preagg(m.sellers, m.items, m.orders, YEAR_START, YEAR_END)


def _geo(days: str, digits: tuple[int, int, int]) -> str:
    sales, value, duration = digits
    return f"""SELECT c.customer_state, s.seller_state, count(DISTINCT o.order_id) AS total_orders,
        count(DISTINCT o.customer_id) AS unique_customers, count(DISTINCT i.seller_id) AS unique_sellers,
        {half_up("sum(i.price)", sales)} AS total_sales, {avg("i.price", value)} AS avg_order_value,
        {avg(days, duration)} AS avg_delivery_days
    FROM s_orders o JOIN s_customers c ON o.customer_id = c.customer_id JOIN s_items i ON o.order_id = i.order_id
    JOIN s_sellers s ON i.seller_id = s.seller_id
    WHERE o.order_status = 'delivered' AND o.order_delivered_customer_date IS NOT NULL
        AND o.order_purchase_timestamp >= TIMESTAMP '{YEAR_START}'
    GROUP BY 1, 2 HAVING count(DISTINCT o.order_id) >= 100"""


@check(
    "geo_sales_matrix",
    "s_orders s_customers s_items s_sellers",
    _geo(trunc_days("o.order_delivered_customer_date", "o.order_purchase_timestamp"), (2, 6, 6)),
)
def _(m):
    return retail.geo_sales_matrix(m.orders, m.customers, m.items, m.sellers, YEAR_START)


@check(
    "geo_sales_matrix_rounded",
    "s_orders s_customers s_items s_sellers",
    _geo(calendar_days("o.order_delivered_customer_date", "o.order_purchase_timestamp"), (2, 2, 1)),
)
def _(m):
    return retail.geo_sales_matrix_rounded(m.orders, m.customers, m.items, m.sellers, YEAR_START)


@check(
    "product_attr_contains",
    "s_products",
    """SELECT product_id, product_category_name, product_weight_g, product_attributes ->> '$.voltage' AS voltage,
        product_attributes ->> '$.color' AS color, product_attributes FROM s_products
    WHERE product_category_name = 'PROMO' AND json_contains(CAST(product_attributes AS JSON), '{"voltage": "220V"}')
    ORDER BY product_id LIMIT 100""",
)
def _(m):
    return retail.product_attr_contains(m.products, {"voltage": "220V"}, "PROMO")


@check(
    "product_attr_min",
    "s_products",
    """SELECT product_id, product_category_name, product_attributes FROM s_products
    WHERE list_contains(json_keys(CAST(product_attributes AS JSON)), 'warranty_months')
        AND CAST(product_attributes ->> '$.warranty_months' AS INTEGER) >= 12
    ORDER BY product_id LIMIT 100""",
)
def _(m):
    return retail.product_attr_min(m.products, "warranty_months", 12)


@check(
    "delivery_delay_stats",
    "s_orders",
    f"""SELECT order_status, count(*) AS total_orders,
        count(CASE WHEN order_delivered_customer_date > order_estimated_delivery_date THEN 1 END) AS delayed_orders,
        {pct("count(CASE WHEN order_delivered_customer_date > order_estimated_delivery_date THEN 1 END)", "count(*)", 2)}
            AS delay_percentage,
        {avg(trunc_days("order_delivered_customer_date", "order_estimated_delivery_date"))} AS avg_delay_days
    FROM s_orders WHERE order_delivered_customer_date IS NOT NULL
        AND order_purchase_timestamp >= TIMESTAMP '{YEAR_START}' GROUP BY 1""",
)
def _(m):
    return retail.delivery_delay_stats(m.orders, YEAR_START)


@check(
    "delivery_delay_stats_delayed_only",
    "s_orders",
    f"""SELECT order_status, count(*) AS total_orders, {big("sum(late)")} AS delayed_orders,
        {pct("sum(late)", "count(*)", 2)} AS delay_percentage,
        {avg("CASE WHEN late = 1 THEN days END", 1)} AS avg_delay_days
    FROM (SELECT order_status,
            CASE WHEN order_delivered_customer_date > order_estimated_delivery_date THEN 1 ELSE 0 END AS late,
            {calendar_days("order_delivered_customer_date", "order_estimated_delivery_date")} AS days
        FROM s_orders WHERE order_delivered_customer_date IS NOT NULL
            AND order_purchase_timestamp >= TIMESTAMP '{YEAR_START}') GROUP BY 1""",
)
def _(m):
    return retail.delivery_delay_stats_delayed_only(m.orders, YEAR_START)


@check(
    "order_detail",
    "s_orders s_customers s_items s_products s_sellers s_payments",
    f"""SELECT o.order_id, o.order_purchase_timestamp, o.order_status, o.order_delivered_customer_date,
        c.customer_unique_id, c.customer_city, c.customer_state, i.order_item_id, p.product_category_name,
        {dbl("i.price")} AS price, {dbl("i.freight_value")} AS freight_value, s.seller_city, s.seller_state,
        y.payment_type, y.payment_installments, {dbl("y.payment_value")} AS payment_value
    FROM s_orders o JOIN s_customers c ON o.customer_id = c.customer_id JOIN s_items i ON o.order_id = i.order_id
    JOIN s_products p ON i.product_id = p.product_id JOIN s_sellers s ON i.seller_id = s.seller_id
    LEFT JOIN s_payments y ON o.order_id = y.order_id WHERE o.order_id = {CUSTOMER}""",
)
def _(m):
    return retail.order_detail(m.orders, m.customers, m.items, m.products, m.sellers, m.payments, CUSTOMER)


@check(
    "state_sales",
    "s_orders s_customers s_items",
    f"""SELECT c.customer_state, count(DISTINCT o.order_id) AS total_orders, {dbl("sum(i.price)")} AS total_sales
    FROM s_orders o JOIN s_customers c ON o.customer_id = c.customer_id JOIN s_items i ON o.order_id = i.order_id
    WHERE o.order_status = 'delivered' AND {HALF_YEAR} GROUP BY 1""",
)
def _(m):
    return retail.state_sales(m.orders, m.customers, m.items, YEAR_START, "1997-07-01")


@check(
    "period_delivery_summary",
    "s_orders",
    f"""SELECT count(*) AS total_orders,
        {big("sum(CASE WHEN order_status = 'delivered' THEN 1 ELSE 0 END)")} AS delivered_orders,
        {avg(trunc_days("order_delivered_customer_date", "order_purchase_timestamp"))} AS avg_delivery_days
    FROM s_orders o WHERE {MONTH}""",
)
def _(m):
    return retail.period_delivery_summary(m.orders, "1997-06-01", "1997-07-01")


@check(
    "period_avg_interval",
    "s_orders",
    f"""SELECT count(*) AS total_orders,
        {avg("date_diff('second', order_purchase_timestamp, order_delivered_customer_date)", 3)} AS avg_delivery_seconds
    FROM s_orders o WHERE order_status = 'delivered' AND {MONTH}""",
)
def _(m):
    # The interval itself has no common exchange type; the seconds carry the value.
    return retail.period_avg_interval(m.orders, "1997-06-01", "1997-07-01").drop("avg_delivery_time")


@check("status_counts", "s_orders", "SELECT order_status, count(*) AS total_orders FROM s_orders GROUP BY 1")
def _(m):
    return retail.status_counts(m.orders)


@check(
    "order_lookup_in_month",
    "s_orders",
    "SELECT o.* FROM s_orders o WHERE order_id = 1 AND o.order_purchase_timestamp >= TIMESTAMP '1995-01-01' "
    "AND o.order_purchase_timestamp < TIMESTAMP '2001-09-01'",
)
def _(m):
    return retail.order_lookup_in_month(m.orders, 1, "1995-01-01", "2001-09-01")
