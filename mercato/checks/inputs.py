"""Registered checks of bad input: given tables written as CSV or JSON with broken values, read back and reported."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercato.checks.registry import check
from mercato.operators import filters, quality
from mercato.session import new_table_path
from mercato.sources import io
from mercato.sources.schemas import CATALOG_DOCUMENT, REVIEW_DOCUMENT, REVIEW_RULES, SHELL_CATALOG_RULES

PAYMENTS = """order_id || ',' || payment_sequential || ',' || payment_type || ',' || payment_installments || ',abc'"""


def _payments_csv(m) -> str:
    """The payments as CSV; every seventh order has a value that is no number."""
    path = new_table_path(m.spark, "payments_csv")
    value = F.when(F.col("order_id") % 7 == 0, "abc").otherwise(F.col("payment_value").cast("string"))
    io.export_csv(m.payments.withColumn("payment_value", value), path)
    return path


@check("csv_bad_records", "s_payments", f"SELECT CAST(order_id AS VARCHAR) AS order_id, {PAYMENTS} AS line FROM s_payments WHERE order_id % 7 = 0")
def _(m):
    return io.bad_records(io.read_csv_table(m.spark, _payments_csv(m), "order_payments", keep_bad=True))


@check(
    "csv_good_records",
    "s_payments",
    """SELECT CAST(order_id AS VARCHAR) AS order_id, payment_sequential, CAST(payment_value AS DOUBLE) AS payment_value
    FROM s_payments WHERE order_id % 7 <> 0""",
)
def _(m):
    table = io.read_csv_table(m.spark, _payments_csv(m), "order_payments", keep_bad=True)
    return table.where(F.coalesce(io.BAD_RECORD, F.lit("")) == "").select("order_id", "payment_sequential", "payment_value")


def _broken(document: Column, breaks: list[tuple[Column, str, str]]) -> Column:
    """JSON text with the value of a field replaced where a condition holds; the old value moves to a field nobody reads."""
    for where, field, value in breaks:
        document = F.when(where, F.replace(document, F.lit(f'"{field}":'), F.lit(f'"{field}":{value},"old_{field}":'))).otherwise(document)
    return document


def _reported(m, name: str, documents: DataFrame, schema: str, rules) -> DataFrame:
    path = new_table_path(m.spark, name)
    documents.write.text(path)
    checked = quality.validate_documents(io.read_documents(m.spark, path, schema), rules)
    return checked.select("_id", F.array_join("_violations", "; ").alias("violations"))


@check(
    "validate_broken_reviews",
    "s_review_documents",
    """SELECT CAST(_id AS VARCHAR) AS _id, concat_ws('; ', CASE WHEN _id % 31 = 0 THEN '_id: not string' END,
        CASE WHEN _id % 17 = 0 THEN 'order_id: required' END,
        CASE WHEN _id % 11 = 0 THEN 'review.score: not int' WHEN _id % 23 = 0 THEN 'review.score: above 5' END,
        CASE WHEN _id % 19 = 0 THEN 'review.created_at: not date' END,
        CASE WHEN _id % 29 = 0 THEN 'sentiment_analysis.polarity: not double' END,
        CASE WHEN _id % 13 = 0 THEN 'helpful_votes: not int' END) AS violations FROM s_review_documents""",
)
def _(m):
    key = F.col("_id")
    shaped = m.review_documents.withColumns({"order_id": F.when(key % 17 != 0, key.cast("string")), "number": key, "_id": key.cast("string")})
    text = F.to_json(F.struct(*[c for c in shaped.columns if c != "number"]))
    n = F.col("number")
    breaks = [
        (n % 11 == 0, "score", "4.5"),
        ((n % 23 == 0) & (n % 11 != 0), "score", "9"),
        (n % 19 == 0, "created_at", '"soon"'),
        (n % 29 == 0, "polarity", '"high"'),
        (n % 13 == 0, "helpful_votes", '"many"'),
    ]
    numbered = F.when(n % 31 == 0, F.regexp_replace(_broken(text, breaks), r'"_id":"(\d+)"', r'"_id":$1')).otherwise(_broken(text, breaks))
    return _reported(m, "reviews_json", shaped.select(numbered.alias("value")), REVIEW_DOCUMENT, REVIEW_RULES)


@check(
    "validate_shell_catalog",
    "s_products s_translation",
    """SELECT CAST(product_id AS VARCHAR) AS _id, concat_ws('; ', CASE WHEN product_category_name IS NULL THEN 'category.name_pt: required' END,
        CASE WHEN product_category_name_english IS NULL THEN 'category.name_en: required' END,
        CASE WHEN product_id % 11 = 0 THEN 'price: not double' END,
        CASE WHEN product_id % 7 = 0 THEN 'dimensions.weight_g: below 1' END,
        CASE WHEN product_id % 13 = 0 THEN 'attributes: not object' END,
        CASE WHEN product_id % 9 = 0 THEN 'ratings.avg_score: below 1' END,
        CASE WHEN product_id % 10 = 0 THEN 'availability.stock_quantity: below 0' END) AS violations
    FROM s_products LEFT JOIN s_translation USING (product_category_name)""",
)
def _(m):
    key = F.col("product_id")
    rows = m.products.join(m.translation, "product_category_name", "left")
    shell = rows.select(
        key.alias("number"),
        F.to_json(
            F.struct(
                key.cast("string").alias("_id"),
                F.col("product_name").alias("name"),
                F.struct(F.col("product_category_name").alias("name_pt"), F.col("product_category_name_english").alias("name_en")).alias("category"),
                F.col("product_price").cast("double").alias("price"),
                F.struct(
                    F.when(key % 7 == 0, 0).otherwise(F.col("product_weight_g")).alias("weight_g"),
                    F.col("product_length_cm").alias("length_cm"),
                    F.col("product_height_cm").alias("height_cm"),
                    F.col("product_width_cm").alias("width_cm"),
                ).alias("dimensions"),
                F.from_json("product_attributes", "map<string,string>").alias("attributes"),
                F.struct(F.when(key % 9 == 0, 0.5).otherwise(4.5).alias("avg_score"), (key % 40).alias("total_reviews")).alias("ratings"),
                F.struct(F.when(key % 10 == 0, -1).otherwise(key % 90).alias("stock_quantity")).alias("availability"),
            )
        ).alias("text"),
    )
    n = F.col("number")
    text = _broken(F.col("text"), [(n % 11 == 0, "price", '"free"'), (n % 13 == 0, "attributes", "[]")])
    return _reported(m, "catalog_json", shell.select(text.alias("value")), CATALOG_DOCUMENT, SHELL_CATALOG_RULES)


@check("insert_rows", "s_payments", "SELECT payment_type, count(*) * 2 AS n FROM s_payments GROUP BY 1")
def _(m):
    path = new_table_path(m.spark, "payments")
    for _ in range(2):
        io.insert_rows(m.payments, path)
    return io.read_table(m.spark, path).groupBy("payment_type").agg(F.count("*").alias("n"))


@check("temp_views", "", "SELECT n_name, count(*) AS customers FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1")
def _(m):
    io.register_tables(m.spark, m.folder, ["customer", "nation"])
    return m.spark.sql("SELECT n_name, count(*) AS customers FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name")


@check(
    "prim_unless_exists",
    "",
    """SELECT r_name FROM region WHERE NOT EXISTS (SELECT 1 FROM part WHERE p_retailprice < 0)
    UNION ALL SELECT n_name FROM nation WHERE NOT EXISTS (SELECT 1 FROM part)""",
)
def _(m):
    part = m.table("part")
    all_regions = filters.unless_exists(m.table("region").select("r_name"), part.where("p_retailprice < 0"))
    return all_regions.unionAll(filters.unless_exists(m.table("nation").select("n_name"), part))
