"""Registered exploration and profiling queries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.checks.registry import check
from mercato.checks.sql import avg, big, dbl, floor_days, half_up, pct
from mercato.plans import explore
from mercato.sources.schemas import FOREIGN_KEYS

ORDER_COLUMNS = [
    ("order_id", "bigint"),
    ("customer_id", "bigint"),
    ("order_status", "string"),
    ("order_purchase_timestamp", "timestamp_ntz"),
    ("order_approved_at", "timestamp_ntz"),
    ("order_delivered_carrier_date", "timestamp_ntz"),
    ("order_delivered_customer_date", "timestamp_ntz"),
    ("order_estimated_delivery_date", "timestamp_ntz"),
]
TABLES = {
    "customers": "s_customers",
    "sellers": "s_sellers",
    "products": "s_products",
    "orders": "s_orders",
    "order_items": "s_items",
    "order_payments": "s_payments",
    "order_reviews": "s_reviews",
    "geolocation": "s_geolocation",
    "product_category_name_translation": "s_translation",
}


def _tables(m) -> dict[str, DataFrame]:
    return {
        "customers": m.customers,
        "sellers": m.sellers,
        "products": m.products,
        "orders": m.orders,
        "order_items": m.items,
        "order_payments": m.payments,
        "order_reviews": m.reviews,
        "geolocation": m.geolocation,
        "product_category_name_translation": m.translation,
    }


def _ids_as_text(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(c).cast("string").alias(c) if c.endswith("_id") else F.col(c) for c in df.columns])


def _text_stats(view: str, columns: list[str], expression=lambda c: f"CAST({c} AS VARCHAR)") -> str:
    parts = []
    for c in columns:
        parts.append(
            f"""SELECT '{c}' AS "column", {big("coalesce(sum(n), 0)")} AS "count", count(*) AS "unique",
            arg_min(v, (-n, v)) AS top, max(n) AS freq, CAST(NULL AS DOUBLE) AS mean, CAST(NULL AS DOUBLE) AS std,
            CAST(NULL AS DOUBLE) AS min, CAST(NULL AS DOUBLE) AS p25, CAST(NULL AS DOUBLE) AS p50,
            CAST(NULL AS DOUBLE) AS p75, CAST(NULL AS DOUBLE) AS max
            FROM (SELECT {expression(c)} AS v, count(*) AS n FROM {view} WHERE {c} IS NOT NULL GROUP BY 1)"""
        )
    return " UNION ALL ".join(parts)


def _number_stats(view: str, columns: list[str]) -> str:
    parts = []
    for c in columns:
        v = dbl(c)
        parts.append(
            f"""SELECT '{c}' AS "column", count({c}) AS "count", {half_up(f"avg({v})", 4)} AS mean,
            {half_up(f"stddev_samp({v})", 4)} AS std, min({v}) AS min, {half_up(f"quantile_cont({v}, 0.25)", 6)} AS p25,
            {half_up(f"quantile_cont({v}, 0.5)", 6)} AS p50, {half_up(f"quantile_cont({v}, 0.75)", 6)} AS p75, max({v}) AS max FROM {view}"""
        )
    return " UNION ALL ".join(parts)


def _time_or_text(c: str) -> str:
    dated = c.endswith(("_timestamp", "_at", "_date"))
    return f"strftime({c}, '%Y-%m-%d %H:%M:%S')" if dated else f"CAST({c} AS VARCHAR)"


@check("describe_orders", "s_orders", _text_stats("s_orders", [c for c, _ in ORDER_COLUMNS], _time_or_text))
def _(m):
    return explore.describe_all(_ids_as_text(m.orders))


@check(
    "describe_customers",
    "s_customers",
    _text_stats("s_customers", ["customer_id", "customer_unique_id", "customer_zip_code_prefix", "customer_city", "customer_state"]),
)
def _(m):
    return explore.describe_all(_ids_as_text(m.customers))


@check(
    "describe_sellers",
    "s_sellers",
    _text_stats("s_sellers", ["seller_id", "seller_name", "seller_zip_code_prefix", "seller_city", "seller_state"]),
)
def _(m):
    return explore.describe_all(_ids_as_text(m.sellers))


REVIEW_TEXTS = ["review_id", "order_id", "review_comment_title", "review_comment_message", "review_creation_date", "review_answer_timestamp"]


@check(
    "describe_reviews",
    "s_reviews",
    _text_stats("s_reviews", REVIEW_TEXTS, _time_or_text)
    + """ UNION ALL SELECT "column", "count", NULL, NULL, NULL, mean, std, min, p25, p50, p75, max FROM ("""
    + _number_stats("s_reviews", ["review_score"])
    + ")",
)
def _(m):
    return explore.describe_all(_ids_as_text(m.reviews))


def _register_numeric(name: str, view: str, columns: list[str], pick) -> None:
    @check(name, view, _number_stats(view, columns))
    def _(m):
        return explore.describe_numeric(pick(m), columns)


_register_numeric("describe_items", "s_items", ["order_item_id", "price", "freight_value"], lambda m: m.items)
_register_numeric(
    "describe_products",
    "s_products",
    ["product_name_length", "product_description_length", "product_photos_qty"],
    lambda m: m.products,
)
_register_numeric(
    "describe_dimensions",
    "s_products",
    ["product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm"],
    lambda m: m.products,
)
_register_numeric(
    "describe_payments",
    "s_payments",
    ["payment_sequential", "payment_installments", "payment_value"],
    lambda m: m.payments,
)
_register_numeric("describe_geolocation", "s_geolocation", ["geolocation_lat", "geolocation_lng"], lambda m: m.geolocation)


@check("describe_items_approx")
def _(m):
    return explore.describe_numeric(m.items, ["price", "freight_value"], approx=True)


def _info(view: str, columns) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count({c}) AS non_null, '{kind}' AS dtype FROM {view}""" for c, kind in columns
    )


@check("column_info", "s_orders", _info("s_orders", ORDER_COLUMNS))
def _(m):
    return explore.column_info(m.orders)


@check("dtype_counts", "s_orders", f"SELECT dtype, count(*) AS n FROM ({_info('s_orders', ORDER_COLUMNS)}) GROUP BY 1")
def _(m):
    return explore.dtype_counts(m.orders)


CARDINALITY = {
    "orders": ["order_id", "customer_id"],
    "customers": ["customer_unique_id", "customer_id"],
    "order_items": ["product_id", "seller_id", "order_id"],
    "products": ["product_id", "product_category_name"],
    "sellers": ["seller_id"],
    "order_payments": ["order_id", "payment_type"],
    "order_reviews": ["order_id"],
    "geolocation": ["geolocation_zip_code_prefix"],
}


@check(
    "relationship_cardinality",
    " ".join(TABLES[t] for t in CARDINALITY),
    " UNION ALL ".join(
        f"SELECT '{t}' AS \"table\", 'rows' AS metric, count(*) AS value FROM {TABLES[t]} UNION ALL "
        + " UNION ALL ".join(f"SELECT '{t}', 'distinct {c}', count(DISTINCT {c}) FROM {TABLES[t]}" for c in columns)
        for t, columns in CARDINALITY.items()
    ),
)
def _(m):
    tables = _tables(m)
    return explore.relationship_cardinality({t: tables[t] for t in CARDINALITY}, CARDINALITY)


RELATIONS = [(t, c, p) for t, links in FOREIGN_KEYS.items() for c, p, _ in links if t != "products"] + [
    ("orders", "order_id", "order_items"),
    ("orders", "order_id", "order_reviews"),
    ("products", "product_category_name", "product_category_name_translation"),
]


@check(
    "orphan_keys",
    " ".join(TABLES.values()),
    " UNION ALL ".join(
        f"""SELECT '{t}.{c} in {p}' AS relation, count(*) AS orphans FROM (SELECT DISTINCT {c} FROM {TABLES[t]}
        WHERE {c} IS NOT NULL AND {c} NOT IN (SELECT {c} FROM {TABLES[p]} WHERE {c} IS NOT NULL))"""
        for t, c, p in RELATIONS
    ),
)
def _(m):
    tables = _tables(m)
    parts = [explore.orphan_keys(tables[t], tables[p], c, f"{t}.{c} in {p}") for t, c, p in RELATIONS]
    return reduce(DataFrame.unionByName, parts)


NULLABLE = {
    "orders": [c for c, _ in ORDER_COLUMNS],
    "products": ["product_id", "product_category_name", "product_description_length", "product_attributes"],
}


@check(
    "null_profile",
    "s_orders s_products",
    "SELECT * FROM ("
    + " UNION ALL ".join(
        f"""SELECT '{t}' AS "table", '{c}' AS "column", count(*) - count({c}) AS nulls,
        {pct(f"(count(*) - count({c}))", "count(*)", 4)} AS null_pct FROM {TABLES[t]}"""
        for t, columns in NULLABLE.items()
        for c in columns
    )
    + ") WHERE nulls > 0",
)
def _(m):
    tables = _tables(m)
    return reduce(DataFrame.unionByName, [explore.null_profile(tables[t], t) for t in NULLABLE])


def _duplicates(name: str, view: str, columns: str) -> str:
    return f"""SELECT '{name}' AS "table", {big("sum(n)")} AS "rows", {big("sum(n - 1)")} AS duplicates,
        {pct("sum(n - 1)", "sum(n)", 2)} AS duplicate_pct FROM (SELECT {columns}, count(*) AS n FROM {view} GROUP BY ALL)"""


@check(
    "duplicate_profile",
    "s_items s_geolocation",
    _duplicates("order_items", "s_items", "*")
    + " UNION ALL "
    + _duplicates("item keys", "s_items", "order_id, order_item_id")
    + " UNION ALL "
    + _duplicates("review texts", "documents", "text")
    + " UNION ALL "
    + _duplicates("geolocation", "s_geolocation", "*"),
)
def _(m):
    parts = [
        explore.duplicate_profile(m.items, "order_items"),
        explore.duplicate_profile(m.items.select("order_id", "order_item_id"), "item keys"),
        explore.duplicate_profile(m.table("documents").select("text"), "review texts"),
        explore.duplicate_profile(m.geolocation, "geolocation"),
    ]
    return reduce(DataFrame.unionByName, parts)


TS = "order_purchase_timestamp"


@check(
    "date_features",
    "s_orders",
    f"""SELECT *, CAST(year({TS}) AS INTEGER) AS year, CAST(month({TS}) AS INTEGER) AS month, monthname({TS}) AS month_name,
        CAST(day({TS}) AS INTEGER) AS day, CAST(isodow({TS}) - 1 AS INTEGER) AS dayofweek, dayname({TS}) AS dayofweek_name,
        CAST(quarter({TS}) AS INTEGER) AS quarter FROM s_orders""",
)
def _(m):
    return explore.date_features(m.orders)


@check(
    "date_range",
    "s_orders",
    f"""SELECT "first", "last", {floor_days('"last"', '"first"')} AS days FROM (SELECT min({TS}) AS "first", max({TS}) AS "last"
    FROM s_orders)""",
)
def _(m):
    return explore.date_range(m.orders)


@check("orders_by_month", "s_orders", f"SELECT strftime({TS}, '%Y-%m') AS year_month, count(*) AS num_orders FROM s_orders GROUP BY 1")
def _(m):
    return explore.orders_by_month(m.orders)


@check("orders_by_year", "s_orders", f"SELECT CAST(year({TS}) AS INTEGER) AS year, count(*) AS total_orders FROM s_orders GROUP BY 1")
def _(m):
    return explore.orders_by_year(m.orders)


def _domain(names: list[str], name: str, function: str) -> str:
    rows = ", ".join(f"({i}, '{v}')" for i, v in enumerate(names))
    return f"""SELECT d.{name}, d.position, c.n FROM (VALUES {rows}) AS d(position, {name})
    LEFT JOIN (SELECT {function}({TS}) AS {name}, count(*) AS n FROM s_orders GROUP BY 1) c ON d.{name} = c.{name}"""


@check("orders_by_weekday", "s_orders", _domain(explore.WEEKDAYS, "weekday", "dayname"))
def _(m):
    return explore.orders_by_weekday(m.orders)


@check("orders_by_month_name", "s_orders", _domain(explore.MONTHS, "month_name", "monthname"))
def _(m):
    return explore.orders_by_month_name(m.orders)


ACTUAL = floor_days("order_delivered_customer_date", TS)
PLANNED = floor_days("order_estimated_delivery_date", TS)
TIMED = f"(SELECT *, {ACTUAL} AS delivery_time, {PLANNED} AS estimated_delivery_time, {ACTUAL} - {PLANNED} AS delivery_delay FROM s_orders)"


@check("delivery_time_features", "s_orders", f"SELECT * FROM {TIMED}")
def _(m):
    return explore.delivery_time_features(m.orders)


@check(
    "delivery_time_summary",
    "s_orders",
    f"""SELECT count(*) AS delivered_orders, {avg("delivery_time", 1)} AS mean_delivery_days,
        {dbl("median(CAST(delivery_time AS DOUBLE))")} AS median_delivery_days, {avg("delivery_delay", 1)} AS mean_delay_days,
        count(*) FILTER (WHERE delivery_delay <= 0) AS on_time_orders,
        {pct("count(*) FILTER (WHERE delivery_delay <= 0)", "count(*)", 1)} AS on_time_pct,
        count(*) FILTER (WHERE delivery_delay > 0) AS late_orders,
        {pct("count(*) FILTER (WHERE delivery_delay > 0)", "count(*)", 1)} AS late_pct
    FROM {TIMED} WHERE order_status = 'delivered'""",
)
def _(m):
    return explore.delivery_time_summary(m.orders)


@check(
    "delivery_time_histogram",
    "s_orders",
    " UNION ALL ".join(
        f"""SELECT '{series}' AS series, {column} AS days, count(*) AS n FROM {TIMED}
        WHERE order_status = 'delivered' AND {column} IS NOT NULL GROUP BY 2"""
        for series, column in (("actual", "delivery_time"), ("estimated", "estimated_delivery_time"))
    ),
)
def _(m):
    return explore.delivery_time_histogram(m.orders)


def _top(view: str, column: str, n: int | None) -> str:
    limit = f"LIMIT {n}" if n else ""
    return f"SELECT {column}, count(*) AS n FROM {view} WHERE {column} IS NOT NULL GROUP BY 1 ORDER BY n DESC, {column} {limit}"


@check("top_customer_states", "s_customers", _top("s_customers", "customer_state", 15))
def _(m):
    return explore.top_customer_states(m.customers)


@check("top_seller_states", "s_sellers", _top("s_sellers", "seller_state", 15))
def _(m):
    return explore.top_seller_states(m.sellers)


@check("top_cities", "s_customers", _top("s_customers", "customer_city", 20))
def _(m):
    return explore.top_cities(m.customers)


@check(
    "geo_sample",
    "s_geolocation",
    f"""SELECT geolocation_zip_code_prefix, {dbl("geolocation_lat")} AS geolocation_lat, {dbl("geolocation_lng")} AS geolocation_lng,
        geolocation_city, geolocation_state FROM s_geolocation
    ORDER BY md5('42:' || geolocation_zip_code_prefix || ':' || geolocation_lat || ':' || geolocation_lng),
        geolocation_zip_code_prefix, s_geolocation.geolocation_lat, s_geolocation.geolocation_lng LIMIT 5000""",
)
def _(m):
    return explore.geo_sample(m.geolocation, ["geolocation_zip_code_prefix", "geolocation_lat", "geolocation_lng"])


@check(
    "geo_sample_small",
    "s_geolocation",
    f"""SELECT geolocation_zip_code_prefix, {dbl("geolocation_lat")} AS geolocation_lat, {dbl("geolocation_lng")} AS geolocation_lng,
        geolocation_city, geolocation_state FROM s_geolocation
    ORDER BY md5('42:' || geolocation_zip_code_prefix || ':' || geolocation_lat || ':' || geolocation_lng),
        geolocation_zip_code_prefix, s_geolocation.geolocation_lat, s_geolocation.geolocation_lng LIMIT 100""",
)
def _(m):
    return explore.geo_sample(m.geolocation, ["geolocation_zip_code_prefix", "geolocation_lat", "geolocation_lng"], n=100)


@check(
    "geo_cardinality",
    "s_geolocation",
    """SELECT count(DISTINCT geolocation_zip_code_prefix) AS unique_zips, count(DISTINCT geolocation_state) AS unique_states,
        count(DISTINCT geolocation_city) AS unique_cities FROM s_geolocation""",
)
def _(m):
    return explore.geo_cardinality(m.geolocation)


@check(
    "top_categories",
    "s_items s_products s_translation",
    """SELECT t.product_category_name_english AS category, count(*) AS n FROM s_items i
    LEFT JOIN s_products p ON i.product_id = p.product_id
    LEFT JOIN s_translation t ON p.product_category_name = t.product_category_name
    WHERE t.product_category_name_english IS NOT NULL GROUP BY 1 ORDER BY n DESC, category LIMIT 20""",
)
def _(m):
    return explore.top_categories(m.items, m.products, m.translation)


@check(
    "product_summary",
    "s_products",
    """SELECT count(DISTINCT product_id) AS unique_products, count(DISTINCT product_category_name) AS unique_categories,
        count(*) - count(product_category_name) AS uncategorised FROM s_products""",
)
def _(m):
    return explore.product_summary(m.products)


def _histogram(view: str, columns: list[str]) -> str:
    long = " UNION ALL ".join(f"SELECT '{c}' AS c, {dbl(c)} AS v FROM {view} WHERE {c} IS NOT NULL" for c in columns)
    return f"""WITH l AS ({long}), k AS (SELECT l.* FROM l JOIN (SELECT c, quantile_cont(v, 0.99) AS lim FROM l GROUP BY 1) q
        ON l.c = q.c AND v <= lim),
    e AS (SELECT c, CASE WHEN min(v) = max(v) THEN min(v) - 0.5 ELSE min(v) END AS low,
        CASE WHEN min(v) = max(v) THEN max(v) + 0.5 ELSE max(v) END AS high FROM k GROUP BY 1),
    f AS (SELECT k.c, CAST(least(floor((v - low) / (high - low) * 50), 49) AS INTEGER) AS bin, count(*) AS n
        FROM k JOIN e ON k.c = e.c GROUP BY 1, 2)
    SELECT e.c AS "column", g.bin, {half_up("low + g.bin * ((high - low) / 50)", 6)} AS bin_start, coalesce(f.n, 0) AS n
    FROM e CROSS JOIN (SELECT CAST(range AS INTEGER) AS bin FROM range(50)) g LEFT JOIN f ON e.c = f.c AND g.bin = f.bin"""


@check("trimmed_histogram", "s_items", _histogram("s_items", ["price", "freight_value"]))
def _(m):
    return explore.trimmed_histogram(m.items, ["price", "freight_value"])


DIMENSIONS = ["product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm"]


@check("trimmed_histogram_dimensions", "s_products", _histogram("s_products", DIMENSIONS))
def _(m):
    return explore.trimmed_histogram(m.products, DIMENSIONS)


@check(
    "payment_type_distribution",
    "s_payments",
    f"""SELECT payment_type, count(*) AS n, {pct("count(*)", "(SELECT count(*) FROM s_payments)", 1)} AS share_pct
    FROM s_payments GROUP BY 1""",
)
def _(m):
    return explore.payment_type_distribution(m.payments)


@check(
    "payment_value_by_type",
    "s_payments",
    f"""SELECT payment_type, {avg("payment_value", 2)} AS mean, {half_up("median(CAST(payment_value AS DOUBLE))", 2)} AS median,
        {dbl("sum(payment_value)")} AS sum FROM s_payments GROUP BY 1""",
)
def _(m):
    return explore.payment_value_by_type(m.payments)


@check("review_score_distribution", "s_reviews", "SELECT review_score, count(*) AS n FROM s_reviews GROUP BY 1")
def _(m):
    return explore.review_score_distribution(m.reviews)


@check(
    "review_score_summary",
    "s_reviews",
    f"""SELECT {avg("review_score", 2)} AS mean_score, median(CAST(review_score AS DOUBLE)) AS median_score,
        {pct("count(*) FILTER (WHERE review_score >= 4)", "count(*)", 1)} AS positive_pct,
        {pct("count(*) FILTER (WHERE review_score <= 2)", "count(*)", 1)} AS negative_pct,
        {pct("count(*) FILTER (WHERE review_score = 3)", "count(*)", 1)} AS neutral_pct FROM s_reviews""",
)
def _(m):
    return explore.review_score_summary(m.reviews)


@check("order_status_distribution", "s_orders", _top("s_orders", "order_status", None))
def _(m):
    return explore.order_status_distribution(m.orders)


@check(
    "key_metrics",
    "s_orders s_customers s_products s_sellers s_items s_reviews",
    f"""SELECT 'total orders' AS metric, CAST(count(*) AS VARCHAR) AS value FROM s_orders
    UNION ALL SELECT 'date range', strftime(min({TS}), '%Y-%m-%d') || ' to ' || strftime(max({TS}), '%Y-%m-%d') FROM s_orders
    UNION ALL SELECT 'delivery success rate', CAST(CAST({pct("count(*) FILTER (WHERE order_status = 'delivered')", "count(*)", 1)}
        AS DECIMAL(5,1)) AS VARCHAR) || '%' FROM s_orders
    UNION ALL SELECT 'unique customers', CAST(count(DISTINCT customer_unique_id) AS VARCHAR) FROM s_customers
    UNION ALL SELECT 'states covered', CAST(count(DISTINCT customer_state) AS VARCHAR) FROM s_customers
    UNION ALL SELECT 'total products', CAST(count(DISTINCT product_id) AS VARCHAR) FROM s_products
    UNION ALL SELECT 'total sellers', CAST(count(DISTINCT seller_id) AS VARCHAR) FROM s_sellers
    UNION ALL SELECT 'items sold', CAST(count(*) AS VARCHAR) FROM s_items
    UNION ALL SELECT 'average score', CAST(CAST({avg("review_score", 2)} AS DECIMAL(5,2)) AS VARCHAR) FROM s_reviews""",
)
def _(m):
    return explore.key_metrics(m.orders, m.customers, m.products, m.sellers, m.items, m.reviews)
