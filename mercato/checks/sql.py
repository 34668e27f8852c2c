"""SQL text of the marketplace views and small expression helpers for the oracles."""

from __future__ import annotations

from mercato.checks.market import CATEGORY_NAMES


def half_up(expression: str, digits: int) -> str:
    return f"CAST(round(CAST({expression} AS DECIMAL(30,10)), {digits}) AS DOUBLE)"


def avg(expression: str, digits: int = 6) -> str:
    return half_up(f"CAST(sum({expression}) AS DOUBLE) / count({expression})", digits)


def pct(part: str, whole: str, digits: int) -> str:
    return half_up(f"CAST(100.0 AS DOUBLE) * CAST({part} AS DOUBLE) / nullif(CAST({whole} AS DOUBLE), 0)", digits)


def dbl(expression: str) -> str:
    return f"CAST({expression} AS DOUBLE)"


def big(expression: str) -> str:
    return f"CAST({expression} AS BIGINT)"


def trunc_days(later: str, earlier: str) -> str:
    return f"CAST(extract(day FROM ({later} - {earlier})) AS INTEGER)"


def calendar_days(later: str, earlier: str) -> str:
    return f"CAST(date_diff('day', CAST({earlier} AS DATE), CAST({later} AS DATE)) AS INTEGER)"


def floor_days(later: str, earlier: str) -> str:
    return f"CAST(floor(date_diff('microsecond', {earlier}, {later}) / CAST(86400000000 AS DOUBLE)) AS INTEGER)"


_translation = ", ".join(f"('{k}', '{v}')" for k, v in CATEGORY_NAMES.items())

# Each view lists the views it needs; the names differ from the table names.
VIEWS: dict[str, tuple[tuple[str, ...], str]] = {
    "s_customers": (
        (),
        """SELECT c_custkey AS customer_id, c_name AS customer_unique_id,
            CAST(c_custkey * 37 % 100000 AS VARCHAR) AS customer_zip_code_prefix,
            n_name AS customer_city, r_name AS customer_state
        FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    ),
    "s_sellers": (
        (),
        """SELECT s_suppkey AS seller_id, s_name AS seller_name,
            CAST(s_suppkey * 411 % 100000 AS VARCHAR) AS seller_zip_code_prefix,
            n_name AS seller_city, r_name AS seller_state
        FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    ),
    "s_orders": (
        (),
        """SELECT order_id, customer_id, order_status, order_purchase_timestamp,
            CASE WHEN order_id % 41 <> 0 THEN order_purchase_timestamp + to_hours(CAST(order_id % 5 AS INTEGER)) END
                AS order_approved_at,
            CASE WHEN order_status <> 'processing'
                THEN order_purchase_timestamp + to_days(CAST(1 + order_id % 3 AS INTEGER)) END
                AS order_delivered_carrier_date,
            CASE WHEN order_status IN ('delivered', 'canceled')
                THEN order_purchase_timestamp + to_days(CAST(3 + order_id % 25 AS INTEGER))
                    + to_hours(CAST(order_id % 24 AS INTEGER)) END AS order_delivered_customer_date,
            CASE WHEN order_id % 97 <> 0 THEN order_purchase_timestamp + to_days(CAST(10 + order_id % 13 AS INTEGER)) END
                AS order_estimated_delivery_date
        FROM (SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderdate AS order_purchase_timestamp,
                CASE WHEN o_orderstatus = 'F' THEN 'delivered' WHEN o_orderstatus = 'O' THEN 'processing'
                    WHEN o_orderkey % 10 = 0 THEN 'canceled' ELSE 'shipped' END AS order_status
            FROM orders)""",
    ),
    "s_items": (
        (),
        """SELECT l_orderkey AS order_id, l_linenumber AS order_item_id, l_partkey AS product_id,
            l_suppkey AS seller_id, l_shipdate AS shipping_limit_date,
            CAST(l_extendedprice AS DECIMAL(12,2)) AS price,
            CAST(round(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_tax AS DECIMAL(4,2)), 2) AS DECIMAL(12,2))
                AS freight_value
        FROM lineitem""",
    ),
    "s_payments": (
        (),
        """SELECT l_orderkey AS order_id, l_linenumber AS payment_sequential,
            CASE WHEN l_returnflag = 'A' THEN 'boleto' WHEN l_returnflag = 'N' THEN 'credit_card' ELSE 'voucher' END
                AS payment_type,
            1 + CAST(l_quantity AS INTEGER) % 24 AS payment_installments,
            CAST(round(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))), 2)
                AS DECIMAL(12,2)) AS payment_value
        FROM lineitem""",
    ),
    "s_products": (
        (),
        """SELECT p_partkey AS product_id, p_name AS product_name,
            CASE WHEN p_partkey % 50 <> 0 THEN p_type END AS product_category_name,
            length(p_name) AS product_name_length,
            CASE WHEN p_size > 2 THEN p_size * 12 END AS product_description_length,
            p_size % 6 AS product_photos_qty, p_size AS product_weight_g,
            CAST(10 + p_partkey % 30 AS INTEGER) AS product_length_cm,
            CAST(2 + p_partkey % 17 AS INTEGER) AS product_height_cm,
            CAST(5 + p_partkey % 23 AS INTEGER) AS product_width_cm,
            CAST(p_retailprice AS DECIMAL(12,2)) AS product_price,
            CASE WHEN p_size % 4 <> 0 THEN 'in_stock' ELSE 'out_of_stock' END AS stock_status,
            '{' || concat_ws(', ',
                '"voltage": "' || ['110V', '220V', 'Bivolt'][p_partkey % 3 + 1] || '"',
                '"color": "' || ['Black', 'White', 'Silver', 'Gray'][p_partkey % 4 + 1] || '"',
                CASE WHEN p_size <= 45 THEN '"warranty_months": ' || CAST(12 * (p_partkey % 4) AS VARCHAR) END)
                || '}' AS product_attributes
        FROM part""",
    ),
    "s_translation": (
        (),
        "SELECT * FROM (VALUES " + _translation + ") AS t(product_category_name, product_category_name_english)",
    ),
    "s_stock": (
        (),
        """SELECT DISTINCT l_partkey AS product_id, l_suppkey AS seller_id,
            CAST((l_partkey * 31 + l_suppkey * 17) % 201 AS INTEGER) AS stock FROM lineitem""",
    ),
    "s_geolocation": (
        ("s_customers",),
        """SELECT customer_zip_code_prefix AS geolocation_zip_code_prefix,
            CAST(-1 - (customer_id * 7919 % 300000) / 10000.0 AS DECIMAL(10,8)) AS geolocation_lat,
            CAST(-35 - (customer_id * 104729 % 300000) / 10000.0 AS DECIMAL(10,8)) AS geolocation_lng,
            customer_city AS geolocation_city, customer_state AS geolocation_state FROM s_customers""",
    ),
    "s_reviews": (
        (),
        """SELECT doc_id AS review_id, doc_id AS order_id, CAST(1 + doc_id % 5 AS INTEGER) AS review_score,
            source || ' ' || lang AS review_comment_title, text AS review_comment_message,
            TIMESTAMP '1999-01-01' + to_days(CAST(doc_id % 900 AS INTEGER)) AS review_creation_date,
            TIMESTAMP '1999-01-01' + to_days(CAST(doc_id % 900 AS INTEGER)) + to_hours(CAST(doc_id % 72 AS INTEGER))
                AS review_answer_timestamp
        FROM documents""",
    ),
    "s_review_documents": (
        (),
        """SELECT d.doc_id AS _id, CAST(1 + d.doc_id % 5 AS INTEGER) AS score, source || ' ' || lang AS title,
            text AS message, TIMESTAMP '1999-01-01' + to_days(CAST(d.doc_id % 900 AS INTEGER)) AS created_at,
            (d.doc_id % 5 - 2) / 2.0 AS polarity, CAST(quality AS DOUBLE) AS subjectivity,
            ['very_negative', 'negative', 'neutral', 'positive', 'very_positive'][d.doc_id % 5 + 1] AS classification,
            list_filter([source, lang, CASE WHEN toxic = 1 THEN 'complaint' END, CASE WHEN quality = 1 THEN 'praise' END],
                lambda t: t IS NOT NULL) AS topics,
            CAST(n_chars % 50 AS INTEGER) AS helpful_votes
        FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
    ),
    "s_offers": (
        ("s_items", "s_sellers", "s_stock"),
        """SELECT product_id, seller_id, seller_name, CAST(price AS DOUBLE) AS price,
            CAST(shipping_cost AS DOUBLE) AS shipping_cost, stock
        FROM (SELECT product_id, seller_id, min(price) AS price, min(freight_value) AS shipping_cost
            FROM s_items GROUP BY ALL)
        JOIN s_sellers USING (seller_id) LEFT JOIN s_stock USING (product_id, seller_id)""",
    ),
    "s_catalog": (
        ("s_products", "s_translation", "s_items", "s_orders", "s_reviews", "s_offers"),
        """SELECT product_id AS _id, product_name AS name, product_category_name AS name_pt,
            product_category_name_english AS name_en, CAST(product_price AS DOUBLE) AS price,
            CAST(coalesce(units, 0) AS BIGINT) AS total_units_sold,
            CAST(round(CAST(CAST(score_sum AS DOUBLE) / reviews AS DECIMAL(30,10)), 2) AS DOUBLE) AS average_rating,
            CAST(coalesce(revenue, 0) AS DOUBLE) AS total_revenue, last_sale AS last_sale_date,
            product_attributes AS specifications, CAST(coalesce(reviews, 0) AS BIGINT) AS total_reviews,
            latest_review_id, CAST(coalesce(seller_count, 0) AS BIGINT) AS seller_count, stock_status
        FROM s_products LEFT JOIN s_translation USING (product_category_name)
        LEFT JOIN (SELECT product_id, count(*) AS units, sum(price) AS revenue, max(order_purchase_timestamp) AS last_sale
            FROM s_items JOIN s_orders USING (order_id) GROUP BY 1) USING (product_id)
        LEFT JOIN (SELECT product_id, count(*) AS reviews, sum(review_score) AS score_sum,
                arg_max(review_id, (review_creation_date, review_id)) AS latest_review_id
            FROM (SELECT DISTINCT order_id, product_id FROM s_items) JOIN s_reviews USING (order_id) GROUP BY 1)
            USING (product_id)
        LEFT JOIN (SELECT product_id, count(*) AS seller_count FROM s_offers GROUP BY 1) USING (product_id)""",
    ),
    "s_runs": (
        (),
        """SELECT event_type AS query_name, 'user ' || CAST(user_id AS VARCHAR) AS technique,
            CASE WHEN ts < TIMESTAMP '2024-01-16' THEN 'before' ELSE 'after' END AS phase,
            CAST(value AS DECIMAL(12,3)) AS execution_ms
        FROM events""",
    ),
}


def over(views: str, body: str) -> str:
    """``body`` with the named views, and those they need, as common table expressions."""
    ordered: list[str] = []

    def need(name: str) -> None:
        for other in VIEWS[name][0]:
            need(other)
        if name not in ordered:
            ordered.append(name)

    for name in views.split():
        need(name)
    parts = [f"{name} AS ({VIEWS[name][1]})" for name in ordered]
    if not parts:
        return body
    stripped = body.lstrip()
    if stripped.upper().startswith("WITH "):
        return "WITH " + ", ".join(parts) + ", " + stripped[5:]
    return "WITH " + ", ".join(parts) + " " + stripped
