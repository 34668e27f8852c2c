"""Declared schemas, keys and allowed values of the marketplace tables."""

from __future__ import annotations

from mercato.operators.quality import Field

# Column names and types of the nine relational tables.
TABLES = {
    "customers": """customer_id STRING NOT NULL, customer_unique_id STRING NOT NULL,
        customer_zip_code_prefix STRING NOT NULL, customer_city STRING NOT NULL, customer_state STRING NOT NULL""",
    "sellers": """seller_id STRING NOT NULL, seller_zip_code_prefix STRING NOT NULL, seller_city STRING NOT NULL,
        seller_state STRING NOT NULL""",
    "product_category_name_translation": """product_category_name STRING NOT NULL,
        product_category_name_english STRING NOT NULL""",
    "products": """product_id STRING NOT NULL, product_category_name STRING, product_name_length INT,
        product_description_length INT, product_photos_qty INT, product_weight_g INT, product_length_cm INT,
        product_height_cm INT, product_width_cm INT, product_attributes STRING""",
    "orders": """order_id STRING NOT NULL, customer_id STRING NOT NULL, order_status STRING NOT NULL,
        order_purchase_timestamp TIMESTAMP_NTZ NOT NULL, order_approved_at TIMESTAMP_NTZ,
        order_delivered_carrier_date TIMESTAMP_NTZ, order_delivered_customer_date TIMESTAMP_NTZ,
        order_estimated_delivery_date TIMESTAMP_NTZ""",
    "order_items": """order_id STRING NOT NULL, order_item_id INT NOT NULL, product_id STRING NOT NULL,
        seller_id STRING NOT NULL, shipping_limit_date TIMESTAMP_NTZ, price DECIMAL(10,2) NOT NULL,
        freight_value DECIMAL(10,2)""",
    "order_payments": """order_id STRING NOT NULL, payment_sequential INT NOT NULL, payment_type STRING NOT NULL,
        payment_installments INT NOT NULL, payment_value DECIMAL(10,2) NOT NULL""",
    "geolocation": """geolocation_zip_code_prefix STRING NOT NULL, geolocation_lat DECIMAL(10,8) NOT NULL,
        geolocation_lng DECIMAL(10,8) NOT NULL, geolocation_city STRING, geolocation_state STRING""",
    "order_reviews": """review_id STRING NOT NULL, order_id STRING NOT NULL, review_score INT NOT NULL,
        review_comment_title STRING, review_comment_message STRING, review_creation_date TIMESTAMP_NTZ NOT NULL,
        review_answer_timestamp TIMESTAMP_NTZ""",
}

# Nested documents.
REVIEW_DOCUMENT = """_id STRING, order_id STRING,
    customer STRUCT<customer_id: STRING, customer_city: STRING, customer_state: STRING>,
    review STRUCT<score: INT, title: STRING, message: STRING, created_at: TIMESTAMP,
        answer: STRUCT<message: STRING, answered_at: TIMESTAMP, answered_by: STRING>>,
    sentiment_analysis STRUCT<polarity: DOUBLE, subjectivity: DOUBLE, classification: STRING,
        keywords: ARRAY<STRING>, topics: ARRAY<STRING>, model_version: STRING, analyzed_at: TIMESTAMP>,
    helpful_votes INT, metadata STRUCT<synced_from_postgres_at: TIMESTAMP>"""

CATALOG_DOCUMENT = """_id STRING, name STRING, description STRING, category STRUCT<name_pt: STRING, name_en: STRING>,
    price DOUBLE, dimensions STRUCT<weight_g: INT, length_cm: INT, height_cm: INT, width_cm: INT>,
    images ARRAY<STRING>, attributes VARIANT,
    ratings STRUCT<avg_score: DOUBLE, total_reviews: INT, distribution: MAP<STRING, INT>>,
    availability STRUCT<in_stock: BOOLEAN, stock_quantity: INT, sellers: ARRAY<STRUCT<seller_id: STRING,
        seller_name: STRING, price: DOUBLE, stock: INT, shipping_estimate_days: INT>>>,
    computed_metrics STRUCT<total_units_sold: INT, average_rating: DOUBLE, total_revenue: DOUBLE,
        last_sale_date: TIMESTAMP>,
    specifications VARIANT, reviews_summary STRUCT<total_reviews: INT, latest_review_id: STRING>,
    sellers ARRAY<STRUCT<seller_id: STRING, seller_name: STRING, price: DOUBLE, stock: INT, shipping_cost: DOUBLE>>,
    stock_status STRING,
    metadata STRUCT<created_at: TIMESTAMP, updated_at: TIMESTAMP, views_count: INT, sales_count: INT>,
    created_at TIMESTAMP, updated_at TIMESTAMP"""

# Allowed sets.
ORDER_STATUSES = ("created", "approved", "invoiced", "processing", "shipped", "delivered", "unavailable", "canceled")
PAYMENT_TYPES = ("credit_card", "boleto", "voucher", "debit_card", "not_defined")
SENTIMENTS = ("very_negative", "negative", "neutral", "positive", "very_positive")
STOCK_STATES = ("in_stock", "out_of_stock", "preorder", "discontinued")

ZIP_PATTERN = "^[0-9]{5}$"
STATE_PATTERN = "^[A-Z]{2}$"

# Primary or unique keys, and (child column, parent table, parent column).
KEYS = {
    "customers": [["customer_id"], ["customer_unique_id"]],
    "sellers": [["seller_id"]],
    "product_category_name_translation": [["product_category_name"], ["product_category_name_english"]],
    "products": [["product_id"]],
    "orders": [["order_id"]],
    "order_items": [["order_id", "order_item_id"]],
    "order_payments": [["order_id", "payment_sequential"]],
    "geolocation": [["geolocation_zip_code_prefix", "geolocation_lat", "geolocation_lng"]],
    "order_reviews": [["review_id"], ["order_id"]],
}
FOREIGN_KEYS = {
    "products": [("product_category_name", "product_category_name_translation", "product_category_name")],
    "orders": [("customer_id", "customers", "customer_id")],
    "order_items": [
        ("order_id", "orders", "order_id"),
        ("product_id", "products", "product_id"),
        ("seller_id", "sellers", "seller_id"),
    ],
    "order_payments": [("order_id", "orders", "order_id")],
    "order_reviews": [("order_id", "orders", "order_id")],
}

REVIEW_RULES = [
    Field("_id", required=True, kind="string"),
    Field("order_id", required=True, kind="string"),
    Field("review", required=True, kind="object"),
    Field("review.score", required=True, within="review", low=1, high=5, kind="int"),
    Field("review.created_at", required=True, within="review", kind="date"),
    Field("review.title", max_length=100, kind="string"),
    Field("sentiment_analysis.polarity", low=-1, high=1, kind="double"),
    Field("sentiment_analysis.subjectivity", low=0, high=1, kind="double"),
    Field("sentiment_analysis.classification", allowed=SENTIMENTS),
    Field("sentiment_analysis.keywords", item_low_length=0, kind="array"),
    Field("sentiment_analysis.topics", item_low_length=0, kind="array"),
    Field("helpful_votes", low=0, kind="int"),
]
CATALOG_RULES = [
    Field("_id", required=True, kind="string"),
    Field("name", required=True, min_length=1, max_length=200, kind="string"),
    Field("category", required=True, kind="object"),
    Field("category.name_pt", required=True, within="category"),
    Field("category.name_en", required=True, within="category"),
    Field("price", required=True, low=0, kind="double"),
    Field("computed_metrics.total_units_sold", low=0, kind="int"),
    Field("computed_metrics.average_rating", low=0, high=5, kind="double"),
    Field("specifications", kind="object"),
    Field("stock_status", allowed=STOCK_STATES),
]
SHELL_CATALOG_RULES = CATALOG_RULES[:6] + [
    Field("dimensions.weight_g", low=1, kind="double"),
    Field("dimensions.length_cm", low=1, kind="double"),
    Field("dimensions.height_cm", low=1, kind="double"),
    Field("dimensions.width_cm", low=1, kind="double"),
    Field("images", item_low_length=0, kind="array"),
    Field("attributes", kind="object"),
    Field("ratings.avg_score", low=1, high=5, kind="double"),
    Field("ratings.total_reviews", low=0, kind="int"),
    Field("availability.stock_quantity", low=0, kind="int"),
]
