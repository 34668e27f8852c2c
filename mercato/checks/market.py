"""Marketplace views over the supplied star-schema tables.

The supplied tables have other names and fewer columns, so the missing ones are
computed from the row itself.  Nothing is filtered or sampled: every view has
all rows of its table.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato.operators.profile import literal_rows
from mercato.plans.documents import build_product_documents, product_offers
from mercato.session import new_table_path
from mercato.sources.io import read_table

AS_OF = "2001-08-02"

# Where the catalog of an application and folder has been written.
_CATALOGS: dict[tuple[str, str], str] = {}
YEAR_START, YEAR_END = "1997-01-01", "1998-01-01"

# Category translation; STANDARD has none on purpose.
CATEGORY_NAMES = {"ECONOMY": "economy", "LARGE": "large", "MEDIUM": "medium", "PROMO": "promotion", "SMALL": "small"}


# Columns of the supplied tables.
SUPPLIED = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE",
    "orders": """o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, o_orderdate TIMESTAMP_NTZ,
        o_orderpriority STRING""",
    "lineitem": """l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE,
        l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, l_linestatus STRING,
        l_shipdate TIMESTAMP_NTZ""",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
    "documents": "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT",
    "labels": "doc_id BIGINT, quality INT, toxic INT",
}


def _shifted(ts: str, unit: str, amount: Column) -> Column:
    return F.timestamp_add(unit, amount, F.col(ts))


def _pick(key: Column, options: list[str]) -> Column:
    chosen = F.lit(options[-1])
    for i, option in reversed(list(enumerate(options[:-1]))):
        chosen = F.when(key == i, F.lit(option)).otherwise(chosen)
    return chosen


class Market:
    """The marketplace views of one data folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def table(self, name: str) -> DataFrame:
        return read_table(self.spark, f"{self.folder}/{name}.parquet", SUPPLIED.get(name))

    @cached_property
    def _places(self) -> DataFrame:
        nation, region = self.table("nation"), self.table("region")
        return nation.join(region, nation.n_regionkey == region.r_regionkey).select("n_nationkey", "n_name", "r_name")

    @cached_property
    def customers(self) -> DataFrame:
        c = self.table("customer").join(self._places, F.col("c_nationkey") == F.col("n_nationkey"))
        return c.select(
            F.col("c_custkey").alias("customer_id"),
            F.col("c_name").alias("customer_unique_id"),
            (F.col("c_custkey") * 37 % 100000).cast("string").alias("customer_zip_code_prefix"),
            F.col("n_name").alias("customer_city"),
            F.col("r_name").alias("customer_state"),
        )

    @cached_property
    def sellers(self) -> DataFrame:
        s = self.table("supplier").join(self._places, F.col("s_nationkey") == F.col("n_nationkey"))
        return s.select(
            F.col("s_suppkey").alias("seller_id"),
            F.col("s_name").alias("seller_name"),
            (F.col("s_suppkey") * 411 % 100000).cast("string").alias("seller_zip_code_prefix"),
            F.col("n_name").alias("seller_city"),
            F.col("r_name").alias("seller_state"),
        )

    @cached_property
    def orders(self) -> DataFrame:
        key = F.col("o_orderkey")
        status = (
            F.when(F.col("o_orderstatus") == "F", "delivered")
            .when(F.col("o_orderstatus") == "O", "processing")
            .when(key % 10 == 0, "canceled")
            .otherwise("shipped")
        )
        base = self.table("orders").withColumn("_status", status)
        sent = F.col("_status") != "processing"
        arrived = F.col("_status").isin("delivered", "canceled")
        delivered = F.timestamp_add("HOUR", key % 24, _shifted("o_orderdate", "DAY", 3 + key % 25))
        return base.select(
            key.alias("order_id"),
            F.col("o_custkey").alias("customer_id"),
            F.col("_status").alias("order_status"),
            F.col("o_orderdate").alias("order_purchase_timestamp"),
            F.when(key % 41 != 0, _shifted("o_orderdate", "HOUR", key % 5)).alias("order_approved_at"),
            F.when(sent, _shifted("o_orderdate", "DAY", 1 + key % 3)).alias("order_delivered_carrier_date"),
            F.when(arrived, delivered).alias("order_delivered_customer_date"),
            F.when(key % 97 != 0, _shifted("o_orderdate", "DAY", 10 + key % 13)).alias("order_estimated_delivery_date"),
        )

    @cached_property
    def items(self) -> DataFrame:
        price = F.col("l_extendedprice").cast("decimal(12,2)")
        freight = F.round(price * F.col("l_tax").cast("decimal(4,2)"), 2).cast("decimal(12,2)")
        return self.table("lineitem").select(
            F.col("l_orderkey").alias("order_id"),
            F.col("l_linenumber").alias("order_item_id"),
            F.col("l_partkey").alias("product_id"),
            F.col("l_suppkey").alias("seller_id"),
            F.col("l_shipdate").alias("shipping_limit_date"),
            price.alias("price"),
            freight.alias("freight_value"),
        )

    @cached_property
    def payments(self) -> DataFrame:
        price = F.col("l_extendedprice").cast("decimal(12,2)")
        value = F.round(price * (1 - F.col("l_discount").cast("decimal(4,2)")), 2).cast("decimal(12,2)")
        kind = F.when(F.col("l_returnflag") == "A", "boleto").when(F.col("l_returnflag") == "N", "credit_card").otherwise("voucher")
        return self.table("lineitem").select(
            F.col("l_orderkey").alias("order_id"),
            F.col("l_linenumber").alias("payment_sequential"),
            kind.alias("payment_type"),
            (1 + F.col("l_quantity").cast("int") % 24).alias("payment_installments"),
            value.alias("payment_value"),
        )

    @cached_property
    def products(self) -> DataFrame:
        key = F.col("p_partkey")
        pairs = [
            F.concat(F.lit('"voltage": "'), _pick(key % 3, ["110V", "220V", "Bivolt"]), F.lit('"')),
            F.concat(F.lit('"color": "'), _pick(key % 4, ["Black", "White", "Silver", "Gray"]), F.lit('"')),
            F.when(F.col("p_size") <= 45, F.concat(F.lit('"warranty_months": '), (12 * (key % 4)).cast("string"))),
        ]
        return self.table("part").select(
            key.alias("product_id"),
            F.col("p_name").alias("product_name"),
            F.when(key % 50 != 0, F.col("p_type")).alias("product_category_name"),
            F.char_length("p_name").alias("product_name_length"),
            F.when(F.col("p_size") > 2, F.col("p_size") * 12).alias("product_description_length"),
            (F.col("p_size") % 6).alias("product_photos_qty"),
            F.col("p_size").alias("product_weight_g"),
            (10 + key % 30).cast("int").alias("product_length_cm"),
            (2 + key % 17).cast("int").alias("product_height_cm"),
            (5 + key % 23).cast("int").alias("product_width_cm"),
            F.col("p_retailprice").cast("decimal(12,2)").alias("product_price"),
            F.when(F.col("p_size") % 4 != 0, "in_stock").otherwise("out_of_stock").alias("stock_status"),
            F.concat(F.lit("{"), F.concat_ws(", ", *pairs), F.lit("}")).alias("product_attributes"),
        )

    @cached_property
    def translation(self) -> DataFrame:
        names = ["product_category_name", "product_category_name_english"]
        return literal_rows(self.spark, names, list(CATEGORY_NAMES.items()))

    @cached_property
    def stock(self) -> DataFrame:
        """Units on hand per offer of a product by a seller."""
        offers = self.table("lineitem").select("l_partkey", "l_suppkey").distinct()
        return offers.select(
            F.col("l_partkey").alias("product_id"),
            F.col("l_suppkey").alias("seller_id"),
            ((F.col("l_partkey") * 31 + F.col("l_suppkey") * 17) % 201).cast("int").alias("stock"),
        )

    @cached_property
    def geolocation(self) -> DataFrame:
        key = F.col("customer_id")
        return self.customers.select(
            F.col("customer_zip_code_prefix").alias("geolocation_zip_code_prefix"),
            (-1 - F.lit(1).cast("decimal(10,4)") * (key * 7919 % 300000) / 10000).cast("decimal(10,8)").alias("geolocation_lat"),
            (-35 - F.lit(1).cast("decimal(10,4)") * (key * 104729 % 300000) / 10000).cast("decimal(10,8)").alias("geolocation_lng"),
            F.col("customer_city").alias("geolocation_city"),
            F.col("customer_state").alias("geolocation_state"),
        )

    @cached_property
    def reviews(self) -> DataFrame:
        key = F.col("doc_id")
        created = F.timestamp_add("DAY", key % 900, F.lit("1999-01-01").cast("timestamp_ntz"))
        return self.table("documents").select(
            key.alias("review_id"),
            key.alias("order_id"),
            (1 + key % 5).cast("int").alias("review_score"),
            F.concat_ws(" ", "source", "lang").alias("review_comment_title"),
            F.col("text").alias("review_comment_message"),
            created.alias("review_creation_date"),
            F.timestamp_add("HOUR", key % 72, created).alias("review_answer_timestamp"),
        )

    @cached_property
    def review_documents(self) -> DataFrame:
        key = F.col("doc_id")
        score = (1 + key % 5).cast("int")
        created = F.timestamp_add("DAY", key % 900, F.lit("1999-01-01").cast("timestamp_ntz"))
        docs = self.table("documents").join(self.table("labels"), "doc_id", "left")
        topics = F.array_compact(
            F.array(
                F.col("source"),
                F.col("lang"),
                F.when(F.col("toxic") == 1, F.lit("complaint")),
                F.when(F.col("quality") == 1, F.lit("praise")),
            )
        )
        return docs.select(
            key.alias("_id"),
            key.alias("order_id"),
            F.struct(
                score.alias("score"),
                F.concat_ws(" ", "source", "lang").alias("title"),
                F.col("text").alias("message"),
                created.alias("created_at"),
            ).alias("review"),
            F.struct(
                ((score - 3) / 2.0).alias("polarity"),
                F.col("quality").cast("double").alias("subjectivity"),
                _pick(score - 1, ["very_negative", "negative", "neutral", "positive", "very_positive"]).alias("classification"),
                F.array(F.col("lang"), F.col("source")).alias("keywords"),
                topics.alias("topics"),
            ).alias("sentiment_analysis"),
            (F.col("n_chars") % 50).cast("int").alias("helpful_votes"),
        )

    @cached_property
    def offers(self) -> DataFrame:
        return product_offers(self.items, self.sellers, self.stock)

    @cached_property
    def catalog(self) -> DataFrame:
        """The product documents, written once per application and folder and read by every catalog query."""
        built = build_product_documents(self.products, self.translation, self.items, self.orders, self.reviews)
        key = (self.spark.sparkContext.applicationId, self.folder)
        if key not in _CATALOGS:
            path = new_table_path(self.spark, "catalog")
            built.write.parquet(path)
            _CATALOGS[key] = path
        return self.spark.read.schema(built.schema).parquet(_CATALOGS[key])

    @cached_property
    def runs(self) -> DataFrame:
        """Timed runs: one per event, phase by half of the month."""
        middle = F.lit("2024-01-16").cast("timestamp_ntz")
        return self.table("events").select(
            F.col("event_type").alias("query_name"),
            F.concat(F.lit("user "), F.col("user_id").cast("string")).alias("technique"),
            F.when(F.col("ts") < middle, "before").otherwise("after").alias("phase"),
            F.col("value").cast("decimal(12,3)").alias("execution_ms"),
        )
