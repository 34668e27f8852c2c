"""Document jobs: nested catalog and review documents as DataFrames."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mercato.functions.jsonq import parsed
from mercato.functions.numeric import mean, round_half_up
from mercato.functions.ordering import largest_first, top_k
from mercato.functions.text import mentions, text_score
from mercato.operators.filters import may_be_in
from mercato.operators.profile import with_share
from mercato.operators.ranks import running_numbers

#: Offers that a product document embeds, and reviews on a page of a product, at most.
EMBEDDED_OFFERS = 10
PAGE_REVIEWS = 50
#: Sellers that are joined to the offers by broadcast, at most.
BROADCAST_SELLERS = 500_000

# -- building documents -----------------------------------------------------


def _product_sales(items: DataFrame, orders: DataFrame) -> DataFrame:
    sold = items.select("order_id", "product_id", "price").join(
        orders.select("order_id", "order_purchase_timestamp"), "order_id"
    )
    return sold.groupBy("product_id").agg(
        F.count("*").alias("units"),
        F.sum("price").alias("revenue"),
        F.max("order_purchase_timestamp").alias("last_sale"),
    )


def _product_ratings(items: DataFrame, reviews: DataFrame) -> DataFrame:
    # A review counts once per product however many items of it the order had.
    review = ["review_id", "review_score", "review_creation_date"]
    # Most orders have no review.
    reviewed = may_be_in(items.select("order_id", "product_id"), "order_id", reviews)
    once = reviewed.join(reviews.select("order_id", *review), "order_id")
    once = once.select("product_id", *review).distinct()
    return once.groupBy("product_id").agg(
        F.count("*").alias("reviews"),
        F.sum("review_score").alias("score_sum"),
        F.max(F.struct("review_creation_date", "review_id")).alias("latest"),
    )


def _seller_counts(items: DataFrame) -> DataFrame:
    return items.select("product_id", "seller_id").distinct().groupBy("product_id").agg(F.count("*").alias("seller_count"))


def product_offers(items: DataFrame, sellers: DataFrame, stock: DataFrame) -> DataFrame:
    """One row per product and seller: best price, cheapest shipping, units on hand."""
    offers = items.groupBy("product_id", "seller_id").agg(
        F.min("price").alias("price"), F.min("freight_value").alias("shipping_cost")
    )
    names = sellers.select("seller_id", "seller_name")
    # Counted first: a broadcast saves a shuffle of all offers by seller.
    if names.limit(BROADCAST_SELLERS + 1).count() <= BROADCAST_SELLERS:
        names = F.broadcast(names)
    return offers.join(stock, ["product_id", "seller_id"], "left").join(names, "seller_id")


def _placed_offers(offers: DataFrame) -> DataFrame:
    # The filter on the place lets every map task keep its own first rows only, so a product with very many offers stays small.
    best = Window.partitionBy("product_id").orderBy(F.col("price").asc_nulls_last(), "seller_id")
    return offers.withColumn("_place", F.row_number().over(best))


def embed_offers(catalog: DataFrame, offers: DataFrame, k: int = EMBEDDED_OFFERS) -> DataFrame:
    """Documents with ``sellers``, the ``k`` best offers of each by price and then seller, as an array in that order.

    Any product has at most ``k`` of them, so the document has one shape at any size;
    ``seller_count`` tells how many there are and :func:`referenced_offers` has the rest.
    A product without offers has an empty array.
    """
    seller = F.struct("seller_id", "seller_name", F.col("price").cast("double").alias("price"), "stock", F.col("shipping_cost").cast("double").alias("shipping_cost"))
    best = _placed_offers(offers).where(F.col("_place") <= k).groupBy("product_id").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("_place", seller.alias("s")))), lambda o: o["s"]).alias("sellers")
    )
    joined = catalog.join(best.withColumnRenamed("product_id", "_id"), "_id", "left")
    return joined.withColumn("sellers", F.coalesce("sellers", F.array().cast(best.schema["sellers"].dataType)))


def referenced_offers(offers: DataFrame, k: int = EMBEDDED_OFFERS) -> DataFrame:
    """The offers that :func:`embed_offers` leaves in the table of offers."""
    return _placed_offers(offers).where(F.col("_place") > k).drop("_place")


def build_product_documents(
    products: DataFrame, translation: DataFrame, items: DataFrame, orders: DataFrame, reviews: DataFrame, offers: DataFrame | None = None
) -> DataFrame:
    """Fold the relational tables into one nested document per product.

    Metrics are precomputed; reviews and offers are referenced.  An offer list grows
    without bound, so offers are a table of their own (:func:`product_offers`) keyed
    by ``_id``, and the document carries how many there are: one shape at any size.
    With ``offers`` the best of them are embedded too (:func:`embed_offers`).
    """
    base = (
        products.join(translation, "product_category_name", "left")
        .join(_product_sales(items, orders), "product_id", "left")
        .join(_product_ratings(items, reviews), "product_id", "left")
        .join(_seller_counts(items), "product_id", "left")
    )
    documents = base.select(
        F.col("product_id").alias("_id"),
        F.col("product_name").alias("name"),
        F.struct(
            F.col("product_category_name").alias("name_pt"), F.col("product_category_name_english").alias("name_en")
        ).alias("category"),
        F.col("product_price").cast("double").alias("price"),
        F.struct(
            F.coalesce("units", F.lit(0)).alias("total_units_sold"),
            round_half_up(F.col("score_sum").cast("double") / F.col("reviews"), 2).cast("double").alias("average_rating"),
            F.coalesce(F.col("revenue").cast("double"), F.lit(0.0)).alias("total_revenue"),
            F.col("last_sale").alias("last_sale_date"),
        ).alias("computed_metrics"),
        parsed(F.col("product_attributes")).alias("specifications"),
        F.struct(
            F.coalesce("reviews", F.lit(0)).alias("total_reviews"), F.col("latest.review_id").alias("latest_review_id")
        ).alias("reviews_summary"),
        F.coalesce("seller_count", F.lit(0)).alias("seller_count"),
        "stock_status",
    )
    return documents if offers is None else embed_offers(documents, offers)


def catalog_with_reviews(catalog: DataFrame, product_reviews: DataFrame) -> DataFrame:
    """Each product next to each of its reviews; products without reviews stay.

    The result is one row per pair, not an array per product, so a product with
    very many reviews stays spread over tasks.  It is an inner join plus the
    products without reviews, because a hot key on the inner side of an outer
    join cannot be split.
    """
    reviews = product_reviews.withColumnRenamed("product_id", "_id")
    products = catalog.select("_id", "name", F.col("category.name_en").alias("category"))
    reviewed = products.join(reviews, "_id")
    bare = products.join(reviews.select("_id").distinct(), "_id", "left_anti")
    return reviewed.unionByName(bare, allowMissingColumns=True)


def catalog_review_pages(catalog: DataFrame, product_reviews: DataFrame, key: str = "review_id", page_rows: int = PAGE_REVIEWS) -> DataFrame:
    """Each product with its reviews looked up as arrays, ``page_rows`` at most in one: a row per product and ``page``.

    Pages count from 1; all but a product's last one are full, and a product without
    reviews has one empty page.  ``key`` tells the reviews of a product apart.  Which page
    a review is on follows from its key and the other keys alone (:func:`running_numbers`);
    within a page reviews come by key.
    """
    numbered = running_numbers(product_reviews, ["product_id"], [key])
    columns = [c for c in product_reviews.columns if c != "product_id"]
    review = F.struct(key, *[c for c in columns if c != key])
    pages = numbered.withColumn("page", F.floor((F.col("number") - 1) / page_rows) + 1).groupBy("product_id", "page").agg(
        F.sort_array(F.collect_list(review)).alias("reviews")
    )
    empty = F.array().cast(pages.schema["reviews"].dataType)
    products = catalog.select("_id", "name", F.col("category.name_en").alias("category"))
    # Pages of one product are spread over tasks; a product's row goes to each of them.
    paged = products.join(pages.withColumnRenamed("product_id", "_id"), "_id", "left")
    return paged.select("_id", "name", "category", F.coalesce("page", F.lit(1)).alias("page"), F.coalesce("reviews", empty).alias("reviews"))


# -- catalog queries --------------------------------------------------------

RATING = "computed_metrics.average_rating"
UNITS = "computed_metrics.total_units_sold"


def catalog_by_category(catalog: DataFrame, category: str, n: int = 5) -> DataFrame:
    """Best rated products of a category."""
    found = catalog.where(F.col("category.name_en") == category)
    found = found.select("_id", "name", "price", F.col(RATING).alias("average_rating"))
    return top_k(found, n, [largest_first("average_rating")], ["_id"])


def text_search(docs: DataFrame, fields: Mapping[str, float], query: str, n: int, columns: list) -> DataFrame:
    """Documents with at least one query word, best weighted match first."""
    mentioned = docs.where(mentions(fields, query))
    scored = mentioned.withColumn("score", text_score(fields, query))
    return top_k(scored.select("_id", *columns, "score"), n, [F.col("score").desc()], ["_id"])


def catalog_text_search(catalog: DataFrame, fields: Mapping[str, float], query: str, n: int = 5) -> DataFrame:
    """Products whose text fields match the query."""
    return text_search(catalog, fields, query, n, ["name", "price"])


def catalog_cheap_in_stock(catalog: DataFrame, max_price: float, n: int = 5) -> DataFrame:
    """Products below a price that can be bought now."""
    found = catalog.where((F.col("price") < max_price) & (F.col("stock_status") == "in_stock"))
    return top_k(found.select("_id", "name", "price"), n, [], ["_id"])


def catalog_price_band(catalog: DataFrame, category: str, lo: float, hi: float, n: int = 5) -> DataFrame:
    """Best rated products of a category in a closed price range, in stock."""
    found = catalog.where(
        (F.col("category.name_en") == category) & F.col("price").between(lo, hi) & (F.col("stock_status") == "in_stock")
    )
    found = found.select("_id", "name", "price", F.col(RATING).alias("average_rating"))
    return top_k(found, n, [largest_first("average_rating")], ["_id"])


def catalog_top_selling(catalog: DataFrame, n: int = 5) -> DataFrame:
    """Products with the most units sold, without their id."""
    found = catalog.where(F.col(UNITS) > 0)
    flat = found.select(
        "_id", "name", F.col(UNITS).alias("sales_count"), F.col(RATING).alias("avg_rating"), "price"
    )
    return top_k(flat, n, [largest_first("sales_count")], ["_id"]).drop("_id")


def catalog_top_selling_in_stock(catalog: DataFrame, n: int = 5) -> DataFrame:
    """Products in stock with the most units sold."""
    found = catalog.where(F.col("stock_status") == "in_stock")
    flat = found.select(
        "_id", "name", F.col("category.name_en").alias("category"), F.col(UNITS).alias("total_units_sold")
    )
    return top_k(flat, n, [largest_first("total_units_sold")], ["_id"])


def catalog_category_overview(catalog: DataFrame) -> DataFrame:
    """Products, average price and revenue per category."""
    groups = catalog.groupBy(F.col("category.name_en").alias("category")).agg(
        F.count("*").alias("count"),
        mean(F.col("price").cast("decimal(18,4)")).alias("avg_price"),
        F.coalesce(F.sum(F.col("computed_metrics.total_revenue").cast("decimal(24,4)")), F.lit(0)).alias("total_revenue"),
    )
    return groups.orderBy(largest_first("count"), F.col("category").asc_nulls_first())


def catalog_category_stats(catalog: DataFrame) -> DataFrame:
    """Price range, rating and units per category."""
    price, rating = F.col("price").cast("decimal(18,4)"), F.col(RATING).cast("decimal(18,4)")
    groups = catalog.groupBy(F.col("category.name_en").alias("category")).agg(
        F.count("*").alias("total_products"),
        mean(price, 2).alias("avg_price"),
        F.round(F.min(price), 2).alias("min_price"),
        F.round(F.max(price), 2).alias("max_price"),
        mean(rating, 2).alias("avg_rating"),
        F.coalesce(F.sum(UNITS), F.lit(0)).alias("total_units_sold"),
    )
    return groups.orderBy(largest_first("total_products"), F.col("category").asc_nulls_first())


def low_stock_offers(catalog: DataFrame, offers: DataFrame, max_stock: int = 10, n: int = 10) -> DataFrame:
    """Offers about to run out, of products in stock."""
    scarce = offers.where((F.col("stock") < max_stock) & (F.col("stock") > 0)).select(
        F.col("product_id").alias("_id"), "seller_id", "seller_name", "stock"
    )
    products = catalog.where(F.col("stock_status") == "in_stock").select("_id", "name", F.col("category.name_en").alias("category"))
    found = scarce.join(products, "_id").select("_id", "name", "category", "seller_id", "seller_name", "stock")
    return top_k(found, n, [F.col("stock").asc_nulls_first()], ["_id", "seller_id"])


def flatten_catalog(catalog: DataFrame, n: int | None = 100) -> DataFrame:
    """Eight flat columns per product, ready for CSV; ``n=None`` keeps all."""
    flat = catalog.select(
        F.col("_id").alias("product_id"),
        "name",
        F.col("category.name_en").alias("category"),
        "price",
        F.col(RATING).alias("rating"),
        F.col(UNITS).alias("units_sold"),
        "stock_status",
        F.col("seller_count").alias("total_sellers"),
    )
    return flat if n is None else top_k(flat, n, [], ["product_id"])


def catalog_summary(catalog: DataFrame) -> DataFrame:
    """Number of documents and of distinct categories."""
    return catalog.agg(
        F.count("*").alias("total_documents"), F.count_distinct("category.name_en").alias("distinct_categories")
    )


def catalog_categories(catalog: DataFrame) -> DataFrame:
    """The distinct category names."""
    return catalog.select(F.col("category.name_en").alias("category")).where(F.col("category").isNotNull()).distinct()


def category_shares(df: DataFrame, key: str) -> DataFrame:
    """Rows and percentage of all rows per value."""
    return with_share(df.groupBy(F.col(key).alias("category")).agg(F.count("*").alias("n")), 1)


def category_concentration(df: DataFrame, key: str, threshold: float = 35) -> DataFrame:
    """Largest share, share of the three largest, and whether the largest is a hotspot."""
    head = top_k(category_shares(df, key), 3, [F.col("n").desc()], ["category"])
    summary = head.agg(F.max("share_pct").alias("max_share_pct"), F.sum("share_pct").alias("top3_share_pct"))
    return summary.withColumn("hotspot", F.col("max_share_pct") > threshold)


def document_size_report(df: DataFrame, parts: Sequence[DataFrame] = ()) -> DataFrame:
    """Size of the documents as JSON, with a verdict on the average.

    ``parts`` are tables that belong to the documents, such as their offers: their
    rows count into the size, not as documents.
    """

    def sized(rows: DataFrame, documents: int) -> DataFrame:
        return rows.select(F.lit(documents).alias("d"), F.octet_length(F.to_json(F.struct(*rows.columns))).alias("b"))

    sizes = reduce(DataFrame.unionAll, [sized(p, 0) for p in parts], sized(df, 1))
    report = sizes.agg(F.coalesce(F.sum("d"), F.lit(0)).alias("documents"), F.sum("b").alias("total_bytes"))
    average = round_half_up(F.col("total_bytes").cast("double") / F.nullif(F.col("documents"), F.lit(0)) / 1024, 2)
    verdict = F.when(F.col("avg_kb") < 50, "optimal").when(F.col("avg_kb") < 100, "acceptable").otherwise("too large")
    return report.withColumn("avg_kb", average).withColumn("verdict", verdict)


# -- review queries ---------------------------------------------------------

REVIEW_TEXT = {"review.title": 10.0, "review.message": 5.0}


def reviews_by_score(reviews: DataFrame, score: int, n: int = 3) -> DataFrame:
    """Newest reviews with a score, with the review sub-document and its sentiment."""
    found = reviews.where(F.col("review.score") == score).select(
        "_id", "review", F.col("sentiment_analysis.classification").alias("classification")
    )
    return top_k(found, n, [F.col("review.created_at").desc_nulls_last()], ["_id"])


def review_text_search(reviews: DataFrame, query: str, n: int = 3) -> DataFrame:
    """Reviews that mention a query word, titles counting twice as much as messages."""
    columns = [F.col("review.title").alias("title"), F.col("review.score").alias("review_score")]
    return text_search(reviews, REVIEW_TEXT, query, n, columns)


def reviews_by_sentiment(reviews: DataFrame, classification: str, n: int = 3) -> DataFrame:
    """Reviews of one sentiment class."""
    found = reviews.where(F.col("sentiment_analysis.classification") == classification).select(
        "_id", F.col("review.title").alias("title"), F.col("sentiment_analysis.polarity").alias("polarity")
    )
    return top_k(found, n, [], ["_id"])


def score_distribution(reviews: DataFrame) -> DataFrame:
    """Reviews and average polarity per score, best score first."""
    polarity = F.col("sentiment_analysis.polarity").cast("decimal(18,6)")
    groups = reviews.groupBy(F.col("review.score").alias("score")).agg(
        F.count("*").alias("count"), mean(polarity).alias("avg_polarity")
    )
    return groups.orderBy(largest_first("score"))


def topic_frequency(reviews: DataFrame, n: int = 5) -> DataFrame:
    """Most frequent topics."""
    topics = reviews.select(F.explode("sentiment_analysis.topics").alias("topic"))
    return top_k(topics.groupBy("topic").agg(F.count("*").alias("count")), n, [F.col("count").desc()], ["topic"])
