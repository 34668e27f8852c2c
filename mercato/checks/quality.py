"""Registered data-quality queries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.checks.registry import check
from mercato.checks.sql import dbl
from mercato.operators import filters, quality
from mercato.plans import reports
from mercato.session import new_table_path
from mercato.sources.schemas import (
    CATALOG_RULES,
    ORDER_STATUSES,
    PAYMENT_TYPES,
    REVIEW_RULES,
    STATE_PATTERN,
    ZIP_PATTERN,
)


def _bad(table: str, rule: str, view: str, key: str, observed: str, where: str) -> str:
    seen = f"CAST({observed} AS VARCHAR)"
    return f"""SELECT '{table}' AS "table", '{rule}' AS "rule", CAST({key} AS VARCHAR) AS "key", {seen} AS observed
        FROM {view} WHERE {where}"""


def _union(*parts: str) -> str:
    return " UNION ALL ".join(parts)


REGEX = _union(
    _bad("customers", "customer_zip_code_prefix regex", "s_customers", "customer_id", "customer_zip_code_prefix",
         f"NOT regexp_matches(customer_zip_code_prefix, '{ZIP_PATTERN}')"),
    _bad("sellers", "seller_zip_code_prefix regex", "s_sellers", "seller_id", "seller_zip_code_prefix",
         f"NOT regexp_matches(seller_zip_code_prefix, '{ZIP_PATTERN}')"),
    _bad("customers", "customer_state regex", "s_customers", "customer_id", "customer_state",
         f"NOT regexp_matches(customer_state, '{STATE_PATTERN}')"),
)


def _all(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _regex_reports(m) -> list[DataFrame]:
    return [
        quality.rule_regex(m.customers, "customers", ["customer_id"], "customer_zip_code_prefix", ZIP_PATTERN),
        quality.rule_regex(m.sellers, "sellers", ["seller_id"], "seller_zip_code_prefix", ZIP_PATTERN),
        quality.rule_regex(m.customers, "customers", ["customer_id"], "customer_state", STATE_PATTERN),
    ]


@check("rule_regex", "s_customers s_sellers", REGEX)
def _(m):
    return _all(_regex_reports(m))




@check(
    "rule_min",
    "s_products",
    _union(
        _bad("customer", "c_acctbal min", "customer", "c_custkey", "CAST(c_acctbal AS DECIMAL(12,2))", "c_acctbal < 500"),
        _bad("products", "product_photos_qty min", "s_products", "product_id", "product_photos_qty", "product_photos_qty <= 0"),
    ),
)
def _(m):
    customer = m.table("customer").withColumn("c_acctbal", F.col("c_acctbal").cast("decimal(12,2)"))
    return _all(
        [
            quality.rule_min(customer, "customer", ["c_custkey"], "c_acctbal", 500),
            quality.rule_min(m.products, "products", ["product_id"], "product_photos_qty", 0, strict=True),
        ]
    )


@check(
    "rule_between",
    "s_items s_reviews",
    _union(
        _bad("order_items", "price between", "s_items", "order_id || '|' || order_item_id", "price",
             "price NOT BETWEEN 1000 AND 100000"),
        _bad("order_reviews", "review_score between", "s_reviews", "review_id", "review_score", "review_score NOT BETWEEN 1 AND 4"),
    ),
)
def _(m):
    return _all(
        [
            quality.rule_between(m.items, "order_items", ["order_id", "order_item_id"], "price", 1000, 100000),
            quality.rule_between(m.reviews, "order_reviews", ["review_id"], "review_score", 1, 4),
        ]
    )


@check(
    "rule_in_set",
    "s_orders",
    _union(
        _bad("documents", "lang in set", "documents", "doc_id", "lang", "lang NOT IN ('en', 'fr', 'de')"),
        _bad("orders", "order_status in set", "s_orders", "order_id", "order_status",
             "order_status NOT IN (" + ", ".join(f"'{s}'" for s in ORDER_STATUSES) + ")"),
    ),
)
def _(m):
    return _all(
        [
            quality.rule_in_set(m.table("documents"), "documents", ["doc_id"], "lang", ["en", "fr", "de"]),
            quality.rule_in_set(m.orders, "orders", ["order_id"], "order_status", ORDER_STATUSES),
        ]
    )


@check(
    "rule_not_null",
    "s_orders s_products",
    _union(
        _bad("orders", "order_approved_at not null", "s_orders", "order_id", "NULL", "order_approved_at IS NULL"),
        _bad("products", "product_category_name not null", "s_products", "product_id", "NULL", "product_category_name IS NULL"),
    ),
)
def _(m):
    return _all(
        [
            quality.rule_not_null(m.orders, "orders", ["order_id"], "order_approved_at"),
            quality.rule_not_null(m.products, "products", ["product_id"], "product_category_name"),
        ]
    )


UNIQUE = """SELECT 'order_items' AS "table", 'order_id,order_item_id unique' AS "rule", order_id || '|' || order_item_id AS "key",
    CAST(count(*) AS VARCHAR) AS observed FROM s_items GROUP BY order_id, order_item_id HAVING count(*) > 1
    UNION ALL SELECT 'orders', 'order_id unique', CAST(order_id AS VARCHAR), CAST(count(*) AS VARCHAR) FROM s_orders
    GROUP BY order_id HAVING count(*) > 1"""


def _unique_reports(m) -> list[DataFrame]:
    return [
        quality.rule_unique(m.items, "order_items", ["order_id", "order_item_id"]),
        quality.rule_unique(m.orders, "orders", ["order_id"]),
    ]


@check("rule_unique", "s_items s_orders", UNIQUE)
def _(m):
    return _all(_unique_reports(m))


@check(
    "rule_foreign_key",
    "s_orders s_items s_products s_translation",
    """SELECT 'orders' AS "table", 'order_id foreign key' AS "rule", CAST(order_id AS VARCHAR) AS "key",
        CAST(count(*) AS VARCHAR) AS observed FROM s_orders WHERE order_id NOT IN (SELECT order_id FROM s_items) GROUP BY order_id
    UNION ALL SELECT 'products', 'product_category_name foreign key', product_category_name, CAST(count(*) AS VARCHAR)
    FROM s_products WHERE product_category_name NOT IN (SELECT product_category_name FROM s_translation)
    GROUP BY product_category_name""",
)
def _(m):
    return _all(
        [
            quality.rule_foreign_key(m.orders, "orders", "order_id", m.items, "order_id"),
            quality.rule_foreign_key(m.products, "products", "product_category_name", m.translation, "product_category_name"),
        ]
    )


LATE = "order_delivered_customer_date > order_estimated_delivery_date"


@check(
    "rule_order",
    "s_orders",
    _union(
        _bad("orders", "order_estimated_delivery_date >= order_delivered_customer_date", "s_orders", "order_id",
             "strftime(order_estimated_delivery_date, '%Y-%m-%d %H:%M:%S')", LATE),
        _bad("orders", "order_delivered_customer_date >= order_purchase_timestamp", "s_orders", "order_id",
             "order_delivered_customer_date", "order_delivered_customer_date < order_purchase_timestamp"),
    ),
)
def _(m):
    key = ["order_id"]
    return _all(
        [
            quality.rule_order(m.orders, "orders", key, "order_delivered_customer_date", "order_estimated_delivery_date"),
            quality.rule_order(m.orders, "orders", key, "order_purchase_timestamp", "order_delivered_customer_date"),
        ]
    )


@check(
    "rule_length",
    "s_products s_customers",
    _union(
        _bad("products", "product_name length", "s_products", "product_id", "length(product_name)",
             "length(product_name) NOT BETWEEN 1 AND 10"),
        _bad("customers", "customer_state length", "s_customers", "customer_id", "length(customer_state)",
             "length(customer_state) <> 4"),
    ),
)
def _(m):
    return _all(
        [
            quality.rule_length(m.products, "products", ["product_id"], "product_name", 1, 10),
            quality.rule_length(m.customers, "customers", ["customer_id"], "customer_state", 4, 4),
        ]
    )


@check(
    "violation_counts",
    "s_customers s_sellers s_items s_orders",
    f'SELECT "table", "rule", count(*) AS violations FROM ({REGEX} UNION ALL {UNIQUE}) GROUP BY ALL',
)
def _(m):
    return quality.violation_counts(_regex_reports(m) + _unique_reports(m))


ORDERS_IN_ONE = _union(
    _bad("orders", "order_status in set", "s_orders", "order_id", "order_status", "order_status NOT IN ('delivered', 'shipped')"),
    _bad("orders", "order_approved_at not null", "s_orders", "order_id", "NULL", "order_approved_at IS NULL"),
    _bad("orders", "order_estimated_delivery_date >= order_delivered_customer_date", "s_orders", "order_id",
         "strftime(order_estimated_delivery_date, '%Y-%m-%d %H:%M:%S')", LATE),
    """SELECT 'orders', 'customer_id,order_status unique', customer_id || '|' || order_status, CAST(count(*) AS VARCHAR) FROM s_orders
    GROUP BY customer_id, order_status HAVING count(*) > 1""",
    """SELECT 'orders', 'order_id foreign key', CAST(order_id AS VARCHAR), CAST(count(*) AS VARCHAR) FROM s_orders
    WHERE order_id NOT IN (SELECT order_id FROM s_items) GROUP BY order_id""",
)
PRODUCTS_IN_ONE = _union(
    _bad("products", "product_photos_qty min", "s_products", "product_id", "product_photos_qty", "product_photos_qty <= 0"),
    _bad("products", "product_weight_g between", "s_products", "product_id", "product_weight_g", "product_weight_g NOT BETWEEN 5 AND 40"),
    _bad("products", "product_name length", "s_products", "product_id", "length(product_name)", "length(product_name) NOT BETWEEN 1 AND 10"),
    _bad("products", "product_attributes regex", "s_products", "product_id", "product_attributes", "NOT regexp_matches(product_attributes, 'warranty')"),
    """SELECT 'products', 'product_category_name foreign key', product_category_name, CAST(count(*) AS VARCHAR) FROM s_products
    WHERE product_category_name NOT IN (SELECT product_category_name FROM s_translation) GROUP BY product_category_name""",
)


def _checked_in_one(m) -> list[DataFrame]:
    order, product = ["order_id"], ["product_id"]
    orders = [
        quality.one_of(order, "order_status", ["delivered", "shipped"]), quality.present(order, "order_approved_at"),
        quality.in_order(order, "order_delivered_customer_date", "order_estimated_delivery_date"),
        quality.unique(["customer_id", "order_status"]), quality.known("order_id", m.items, "order_id"),
    ]
    products = [
        quality.at_least(product, "product_photos_qty", 0, strict=True), quality.between(product, "product_weight_g", 5, 40),
        quality.long_between(product, "product_name", 1, 10), quality.matches(product, "product_attributes", "warranty"),
        quality.known("product_category_name", m.translation, "product_category_name"),
    ]
    return [quality.check_rules(m.orders, "orders", orders), quality.check_rules(m.products, "products", products)]


@check("check_rules", "s_orders s_items s_products s_translation", _union(ORDERS_IN_ONE, PRODUCTS_IN_ONE))
def _(m):
    """Five rules a table, rows and keys, one scan of each table."""
    return _all(_checked_in_one(m))


@check(
    "check_rules_counts",
    "s_orders s_items s_products s_translation",
    f'SELECT "table", "rule", count(*) AS violations FROM ({ORDERS_IN_ONE} UNION ALL {PRODUCTS_IN_ONE}) GROUP BY ALL',
)
def _(m):
    return quality.violation_counts(_checked_in_one(m))


@check(
    "observe_rules",
    "s_customers",
    f"""SELECT count(*) AS checked, count(*) FILTER (WHERE zip) AS bad_zips, count(*) FILTER (WHERE state) AS bad_states,
        CAST(sum(CASE WHEN zip OR state THEN 1 ELSE 0 END) AS BIGINT) AS bad_rows
    FROM (SELECT NOT regexp_matches(customer_zip_code_prefix, '{ZIP_PATTERN}') AS zip, NOT regexp_matches(customer_state, '^[A-M]') AS state FROM s_customers)""",
)
def _(m):
    """Counts that came with the one write of the marked rows."""
    key = ["customer_id"]
    rules = [quality.matches(key, "customer_zip_code_prefix", ZIP_PATTERN), quality.matches(key, "customer_state", "^[A-M]")]
    marked, counts = quality.observe_rules(m.customers, rules)
    path = new_table_path(m.spark, "customers_marked")
    marked.write.parquet(path)
    found = counts.get
    bad = m.spark.read.parquet(path).agg(F.count(F.when(F.size("_violations") > 0, 1)).alias("bad_rows"))
    names = {"rows": "checked", "customer_zip_code_prefix regex": "bad_zips", "customer_state regex": "bad_states"}
    return bad.select(*[F.lit(found[k]).cast("long").alias(v) for k, v in names.items()], "bad_rows")


@check(
    "payment_reconciliation",
    "s_items s_payments",
    f"""SELECT order_id, {dbl("due")} AS due, {dbl("paid")} AS paid, {dbl("coalesce(paid, 0) - coalesce(due, 0)")} AS difference
    FROM (SELECT order_id, sum(price + freight_value) AS due FROM s_items GROUP BY 1)
    FULL OUTER JOIN (SELECT order_id, sum(payment_value) AS paid FROM s_payments GROUP BY 1) USING (order_id)
    WHERE abs(coalesce(paid, 0) - coalesce(due, 0)) > 0.01""",
)
def _(m):
    return quality.payment_reconciliation(m.items, m.payments)


CATALOG_PROBLEMS = """concat_ws('; ', CASE WHEN name_pt IS NULL THEN 'category.name_pt: required' END,
    CASE WHEN name_en IS NULL THEN 'category.name_en: required' END)"""


@check("validate_catalog_warn", "s_catalog", f"SELECT _id, {CATALOG_PROBLEMS} AS violations FROM s_catalog")
def _(m):
    checked = quality.validate_documents(m.catalog, CATALOG_RULES)
    return checked.select("_id", F.array_join("_violations", "; ").alias("violations"))


@check("validate_catalog_error", "s_catalog", f"SELECT _id, name FROM s_catalog WHERE {CATALOG_PROBLEMS} = ''")
def _(m):
    return quality.validate_documents(m.catalog, CATALOG_RULES, mode="error").select("_id", "name")


@check("validate_reviews", "s_review_documents", "SELECT _id, '' AS violations FROM s_review_documents")
def _(m):
    checked = quality.validate_documents(m.review_documents, REVIEW_RULES)
    return checked.select("_id", F.array_join("_violations", "; ").alias("violations"))


def _rule_reports(m) -> dict[str, DataFrame]:
    item_key, payment_key = ["order_id", "order_item_id"], ["order_id", "payment_sequential"]
    return {
        "zip prefixes have five digits": _all(_regex_reports(m)[:2]),
        "item keys are unique": quality.rule_unique(m.items, "order_items", item_key),
        "order keys are unique": quality.rule_unique(m.orders, "orders", ["order_id"]),
        "prices are not negative": quality.rule_min(m.items, "order_items", item_key, "price", 0),
        "payments are positive": quality.rule_min(m.payments, "order_payments", payment_key, "payment_value", 0, strict=True),
        "installments are 1 to 24": quality.rule_between(m.payments, "order_payments", payment_key, "payment_installments", 1, 24),
        "payment types are known": quality.rule_in_set(m.payments, "order_payments", payment_key, "payment_type", PAYMENT_TYPES),
        "orders are approved": quality.rule_not_null(m.orders, "orders", ["order_id"], "order_approved_at"),
        "orders have a customer": quality.rule_foreign_key(m.orders, "orders", "customer_id", m.customers, "customer_id"),
        "items have a product": quality.rule_foreign_key(m.items, "order_items", "product_id", m.products, "product_id"),
    }


ZIPS_BAD = f"""(SELECT count(*) FROM s_customers WHERE NOT regexp_matches(customer_zip_code_prefix, '{ZIP_PATTERN}'))
    + (SELECT count(*) FROM s_sellers WHERE NOT regexp_matches(seller_zip_code_prefix, '{ZIP_PATTERN}'))"""
CHECKLIST = f"""SELECT requirement_id, requirement_description, CAST(violations AS BIGINT) AS violations,
    CASE WHEN violations = 0 THEN 'met' ELSE 'open' END AS status FROM (VALUES
    (1, 'zip prefixes have five digits', {ZIPS_BAD}),
    (2, 'item keys are unique', (SELECT count(*) FROM (SELECT 1 FROM s_items GROUP BY order_id, order_item_id HAVING count(*) > 1))),
    (3, 'order keys are unique', (SELECT count(*) - count(DISTINCT order_id) FROM s_orders)),
    (4, 'prices are not negative', (SELECT count(*) FROM s_items WHERE price < 0)),
    (5, 'payments are positive', (SELECT count(*) FROM s_payments WHERE payment_value <= 0)),
    (6, 'installments are 1 to 24', (SELECT count(*) FROM s_payments WHERE payment_installments NOT BETWEEN 1 AND 24)),
    (7, 'payment types are known', (SELECT count(*) FROM s_payments WHERE payment_type NOT IN ('credit_card', 'boleto', 'voucher'))),
    (8, 'orders are approved', (SELECT count(*) FROM s_orders WHERE order_approved_at IS NULL)),
    (9, 'orders have a customer', (SELECT count(*) FROM s_orders WHERE customer_id NOT IN (SELECT customer_id FROM s_customers))),
    (10, 'items have a product', (SELECT count(*) FROM s_items WHERE product_id NOT IN (SELECT product_id FROM s_products)))
    ) AS t(requirement_id, requirement_description, violations)"""
RULE_VIEWS = "s_customers s_sellers s_items s_orders s_payments s_products"


@check("checklist_detail", RULE_VIEWS, CHECKLIST)
def _(m):
    return reports.checklist_detail(quality.rule_checklist(_rule_reports(m)))


@check(
    "completion_rate",
    RULE_VIEWS,
    f"""SELECT count(*) AS total_requirements, CAST(sum(CASE WHEN status = 'met' THEN 1 ELSE 0 END) AS BIGINT) AS completed,
        CAST(round(100.0 * sum(CASE WHEN status = 'met' THEN 1 ELSE 0 END) / count(*), 2) AS DOUBLE) AS completion_percentage
    FROM ({CHECKLIST})""",
)
def _(m):
    return reports.completion_rate(quality.rule_checklist(_rule_reports(m)), "met")


@check(
    "prim_like_any",
    "",
    """SELECT p_partkey, p_name FROM part WHERE p_name LIKE '%widget%' OR p_name LIKE 'red%' OR p_name LIKE '%ring'""",
)
def _(m):
    return filters.like_any(m.table("part"), "p_name", ["%widget%", "red%", "%ring"]).select("p_partkey", "p_name")


@check(
    "prim_not_in",
    "s_products",
    """SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)
    UNION ALL SELECT s_suppkey FROM supplier WHERE s_name NOT IN (SELECT product_category_name FROM s_products)""",
)
def _(m):
    unlabelled = filters.not_in(m.table("documents").select("doc_id"), "doc_id", m.table("labels"), "doc_id")
    # The category column holds NULLs, so this half is empty.
    none = filters.not_in(m.table("supplier"), "s_name", m.products, "product_category_name")
    return unlabelled.unionByName(none.select(F.col("s_suppkey").alias("doc_id")))
