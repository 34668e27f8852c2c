"""Registered document queries.

Nested results are flattened here because the two engines print structs and
arrays differently; the jobs themselves return nested documents.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from mercato.checks.registry import check
from mercato.checks.sql import avg, big, dbl, half_up
from mercato.functions.text import WORD_BREAK, word_forms
from mercato.operators.filters import may_be_in
from mercato.plans import documents

PRODUCT_QUERY = "red widgets bolt"
REVIEW_QUERY = "worthless src5"


def _matches(column: str, query: str) -> str:
    forms = ", ".join(f"'{f}'" for f in word_forms(query))
    words = f"string_split_regex(strip_accents(lower(coalesce({column}, ''))), '{WORD_BREAK}')"
    return f"len(list_filter({words}, lambda w: w IN ({forms})))"


def _score(fields: dict[str, float], query: str) -> str:
    return dbl(" + ".join(f"{w} * {_matches(c, query)}" for c, w in fields.items()))


@check(
    "catalog_by_category",
    "s_catalog",
    """SELECT _id, name, price, average_rating FROM s_catalog WHERE name_en = 'promotion'
    ORDER BY average_rating DESC NULLS LAST, _id LIMIT 5""",
)
def _(m):
    return documents.catalog_by_category(m.catalog, "promotion")


@check(
    "catalog_text_search",
    "s_catalog",
    f"""SELECT * FROM (SELECT _id, name, price, {_score({"name": 10, "name_pt": 5}, PRODUCT_QUERY)} AS score FROM s_catalog)
    WHERE score > 0 ORDER BY score DESC, _id LIMIT 5""",
)
def _(m):
    return documents.catalog_text_search(m.catalog, {"name": 10, "category.name_pt": 5}, PRODUCT_QUERY)


@check(
    "catalog_cheap_in_stock",
    "s_catalog",
    "SELECT _id, name, price FROM s_catalog WHERE price < 950 AND stock_status = 'in_stock' ORDER BY _id LIMIT 5",
)
def _(m):
    return documents.catalog_cheap_in_stock(m.catalog, 950)


@check(
    "catalog_price_band",
    "s_catalog",
    """SELECT _id, name, price, average_rating FROM s_catalog
    WHERE name_en = 'medium' AND price BETWEEN 910 AND 980 AND stock_status = 'in_stock'
    ORDER BY average_rating DESC NULLS LAST, _id LIMIT 5""",
)
def _(m):
    return documents.catalog_price_band(m.catalog, "medium", 910, 980)


@check(
    "catalog_top_selling",
    "s_catalog",
    """SELECT name, total_units_sold AS sales_count, average_rating AS avg_rating, price FROM s_catalog
    WHERE total_units_sold > 0 ORDER BY total_units_sold DESC NULLS LAST, _id LIMIT 5""",
)
def _(m):
    return documents.catalog_top_selling(m.catalog)


@check(
    "catalog_top_selling_in_stock",
    "s_catalog",
    """SELECT _id, name, name_en AS category, total_units_sold FROM s_catalog WHERE stock_status = 'in_stock'
    ORDER BY total_units_sold DESC NULLS LAST, _id LIMIT 5""",
)
def _(m):
    return documents.catalog_top_selling_in_stock(m.catalog)


@check(
    "catalog_category_overview",
    "s_catalog",
    f"""SELECT name_en AS category, count(*) AS "count", {avg("CAST(price AS DECIMAL(18,4))")} AS avg_price,
        {dbl("sum(CAST(total_revenue AS DECIMAL(24,4)))")} AS total_revenue FROM s_catalog GROUP BY 1""",
)
def _(m):
    return documents.catalog_category_overview(m.catalog)


@check(
    "catalog_category_stats",
    "s_catalog",
    f"""SELECT name_en AS category, count(*) AS total_products, {avg("CAST(price AS DECIMAL(18,4))", 2)} AS avg_price,
        {half_up("min(price)", 2)} AS min_price, {half_up("max(price)", 2)} AS max_price,
        {avg("CAST(average_rating AS DECIMAL(18,4))", 2)} AS avg_rating, {big("sum(total_units_sold)")} AS total_units_sold
    FROM s_catalog GROUP BY 1""",
)
def _(m):
    return documents.catalog_category_stats(m.catalog)


@check(
    "low_stock_offers",
    "s_offers s_products s_translation",
    """SELECT o.product_id AS _id, p.product_name AS name, t.product_category_name_english AS category, o.seller_id,
        o.seller_name, o.stock FROM s_offers o JOIN s_products p ON o.product_id = p.product_id
    LEFT JOIN s_translation t ON p.product_category_name = t.product_category_name
    WHERE p.stock_status = 'in_stock' AND o.stock < 10 AND o.stock > 0
    ORDER BY o.stock NULLS FIRST, o.product_id, o.seller_id LIMIT 10""",
)
def _(m):
    return documents.low_stock_offers(m.catalog, m.offers)


@check(
    "reviews_by_score",
    "s_review_documents",
    """SELECT _id, score, title, message, created_at, classification FROM s_review_documents WHERE score = 5
    ORDER BY created_at DESC NULLS LAST, _id LIMIT 3""",
)
def _(m):
    return documents.reviews_by_score(m.review_documents, 5).select("_id", "review.*", "classification")


@check(
    "review_text_search",
    "s_review_documents",
    f"""SELECT * FROM (SELECT _id, title, score AS review_score, {_score({"title": 10, "message": 5}, REVIEW_QUERY)} AS score
        FROM s_review_documents) t WHERE t.score > 0 ORDER BY t.score DESC, _id LIMIT 3""",
)
def _(m):
    return documents.review_text_search(m.review_documents, REVIEW_QUERY)


@check(
    "reviews_by_sentiment",
    "s_review_documents",
    f"""SELECT _id, title, {dbl("polarity")} AS polarity FROM s_review_documents WHERE classification = 'very_positive'
    ORDER BY _id LIMIT 3""",
)
def _(m):
    return documents.reviews_by_sentiment(m.review_documents, "very_positive")


@check(
    "score_distribution",
    "s_review_documents",
    f"""SELECT score, count(*) AS "count", {avg("CAST(polarity AS DECIMAL(18,6))")} AS avg_polarity
    FROM s_review_documents GROUP BY 1""",
)
def _(m):
    return documents.score_distribution(m.review_documents)


@check(
    "topic_frequency",
    "s_review_documents",
    """SELECT topic, count(*) AS "count" FROM (SELECT unnest(topics) AS topic FROM s_review_documents) GROUP BY 1
    ORDER BY 2 DESC, 1 LIMIT 5""",
)
def _(m):
    return documents.topic_frequency(m.review_documents)


@check(
    "flatten_catalog",
    "s_catalog",
    """SELECT _id AS product_id, name, name_en AS category, price, average_rating AS rating, total_units_sold AS units_sold,
        stock_status, seller_count AS total_sellers FROM s_catalog ORDER BY _id LIMIT 100""",
)
def _(m):
    return documents.flatten_catalog(m.catalog)


SHARES = f"""WITH shares AS (SELECT product_category_name AS category, count(*) AS n,
    {half_up("CAST(100.0 AS DOUBLE) * count(*) / (SELECT count(*) FROM s_products)", 1)} AS share_pct
    FROM s_products GROUP BY 1)"""


@check("category_shares", "s_products", SHARES + " SELECT category, n, share_pct FROM shares")
def _(m):
    return documents.category_shares(m.products, "product_category_name")


@check(
    "category_concentration",
    "s_products",
    SHARES
    + """ SELECT max(share_pct) AS max_share_pct, CAST(sum(CAST(share_pct AS DECIMAL(10,1))) AS DOUBLE) AS top3_share_pct,
        max(share_pct) > 35 AS hotspot FROM (SELECT * FROM shares ORDER BY n DESC, category NULLS LAST LIMIT 3)""",
)
def _(m):
    return documents.category_concentration(m.products, "product_category_name")


@check(
    "document_size_report",
    "",
    f"""SELECT *, CASE WHEN avg_kb < 50 THEN 'optimal' WHEN avg_kb < 100 THEN 'acceptable' ELSE 'too large' END AS verdict
    FROM (SELECT documents, total_bytes, {half_up("CAST(total_bytes AS DOUBLE) / documents / 1024", 2)} AS avg_kb
        FROM (SELECT count(*) AS documents, {big("sum(strlen(CAST(to_json(d) AS VARCHAR)))")} AS total_bytes FROM documents d))""",
)
def _(m):
    return documents.document_size_report(m.table("documents"))


# Sizes of fields that both engines print alike: a product with its category and units, and each of its offers.
SIZED = """SELECT _id, strlen(CAST(to_json(d) AS VARCHAR)) AS bytes FROM (SELECT _id, name, coalesce(name_pt, '') AS name_pt, coalesce(name_en, '') AS name_en, total_units_sold,
    total_reviews, seller_count, stock_status FROM s_catalog) d"""
SIZED_OFFERS = """SELECT product_id AS _id, strlen(CAST(to_json(o) AS VARCHAR)) AS bytes
    FROM (SELECT product_id, seller_id, seller_name, stock FROM s_offers) o"""


@check(
    "catalog_document_size",
    "s_catalog s_offers",
    f"""SELECT *, CASE WHEN avg_kb < 50 THEN 'optimal' WHEN avg_kb < 100 THEN 'acceptable' ELSE 'too large' END AS verdict
    FROM (SELECT documents, total_bytes, {half_up("CAST(total_bytes AS DOUBLE) / documents / 1024", 2)} AS avg_kb
        FROM (SELECT (SELECT count(*) FROM s_catalog) AS documents,
            CAST((SELECT sum(bytes) FROM ({SIZED})) + (SELECT coalesce(sum(bytes), 0) FROM ({SIZED_OFFERS})) AS BIGINT) AS total_bytes))""",
)
def _(m):
    names = [F.coalesce(f"category.{c}", F.lit("")).alias(c) for c in ("name_pt", "name_en")]  # the engines write NULL fields differently
    flat = m.catalog.select("_id", "name", *names, "computed_metrics.total_units_sold", "reviews_summary.total_reviews", "seller_count", "stock_status")
    return documents.document_size_report(flat, [m.offers.select("product_id", "seller_id", "seller_name", "stock")])


@check(
    "catalog_summary",
    "s_catalog",
    "SELECT count(*) AS total_documents, count(DISTINCT name_en) AS distinct_categories FROM s_catalog",
)
def _(m):
    return documents.catalog_summary(m.catalog)


@check("catalog_categories", "s_catalog", "SELECT DISTINCT name_en AS category FROM s_catalog WHERE name_en IS NOT NULL")
def _(m):
    return documents.catalog_categories(m.catalog)


@check(
    "build_product_documents",
    "s_catalog s_offers",
    """SELECT c._id, c.name, c.name_pt, c.name_en, c.price, c.total_units_sold, c.average_rating, c.total_revenue,
        c.last_sale_date, c.specifications ->> '$.voltage' AS voltage, c.total_reviews, c.latest_review_id, c.seller_count,
        c.stock_status, o.seller_id, o.seller_name, o.price AS offer_price, o.stock, o.shipping_cost
    FROM s_catalog c LEFT JOIN s_offers o ON c._id = o.product_id""",
)
def _(m):
    catalog = documents.build_product_documents(m.products, m.translation, m.items, m.orders, m.reviews)
    offers = m.offers.select(F.col("product_id").alias("_id"), F.struct("*").alias("offer"))
    return catalog.join(offers, "_id", "left").select(
        "_id",
        "name",
        "category.name_pt",
        "category.name_en",
        "price",
        "computed_metrics.*",
        F.try_variant_get("specifications", "$.voltage", "string").alias("voltage"),
        "reviews_summary.*",
        "seller_count",
        "stock_status",
        "offer.seller_id",
        "offer.seller_name",
        F.col("offer.price").cast("double").alias("offer_price"),
        "offer.stock",
        F.col("offer.shipping_cost").cast("double").alias("shipping_cost"),
    )


@check(
    "catalog_with_reviews",
    "s_products s_translation s_items s_reviews",
    """SELECT p.product_id AS _id, p.product_name AS name, t.product_category_name_english AS category, r.review_id,
        r.review_score FROM s_products p LEFT JOIN s_translation t ON p.product_category_name = t.product_category_name
    LEFT JOIN (SELECT DISTINCT product_id, review_id, review_score FROM s_items JOIN s_reviews USING (order_id)) r
        ON p.product_id = r.product_id""",
)
def _(m):
    return documents.catalog_with_reviews(m.catalog, _product_reviews(m))


def _product_reviews(m):
    bought = may_be_in(m.items.select("order_id", "product_id"), "order_id", m.reviews).distinct()
    return m.reviews.select("order_id", "review_id", "review_score").join(bought, "order_id").drop("order_id")


EMBEDDED = 4  # fewer than many products have offers here


@check(
    "catalog_embedded_sellers",
    "s_catalog s_offers",
    f"""SELECT _id, name, seller_count, place, seller_id, seller_name, offer_price, stock, shipping_cost
    FROM (SELECT c._id, c.name, c.seller_count, o.seller_id, o.seller_name, o.price AS offer_price, o.stock, o.shipping_cost,
            CAST(row_number() OVER (PARTITION BY c._id ORDER BY o.price NULLS LAST, o.seller_id) AS INTEGER) AS place
        FROM s_catalog c JOIN s_offers o ON c._id = o.product_id) WHERE place <= {EMBEDDED}""",
)
def _(m):
    documented = documents.embed_offers(m.catalog, m.offers, EMBEDDED)
    sellers = documented.select("_id", "name", "seller_count", F.posexplode("sellers").alias("at", "s"))
    return sellers.select("_id", "name", "seller_count", (F.col("at") + 1).alias("place"), "s.seller_id", "s.seller_name", F.col("s.price").alias("offer_price"), "s.stock", "s.shipping_cost")


@check(
    "catalog_embedded_counts",
    "s_catalog",
    f"""SELECT _id, CAST(least(seller_count, {EMBEDDED}) AS INTEGER) AS embedded, seller_count - least(seller_count, {EMBEDDED}) AS referenced
    FROM s_catalog""",
)
def _(m):
    built = documents.embed_offers(m.catalog, m.offers, EMBEDDED)
    rest = documents.referenced_offers(m.offers, EMBEDDED).groupBy(F.col("product_id").alias("_id")).agg(F.count("*").alias("referenced"))
    return built.join(rest, "_id", "left").select("_id", F.size("sellers").alias("embedded"), F.coalesce("referenced", F.lit(0)).alias("referenced"))


PAGE = 3


@check(
    "catalog_review_pages",
    "s_catalog s_items s_reviews",
    f"""WITH r AS (SELECT product_id, review_id, review_score FROM (SELECT DISTINCT order_id, product_id FROM s_items) JOIN s_reviews USING (order_id)),
    n AS (SELECT c._id, c.name, count(review_id) AS reviews, coalesce(sum(review_score), 0) AS score_sum FROM s_catalog c LEFT JOIN r ON c._id = r.product_id GROUP BY ALL),
    p AS (SELECT *, unnest(range(1, greatest(1, (reviews + {PAGE - 1}) // {PAGE}) + 1)) AS page FROM n)
    SELECT _id, name, CAST(page AS BIGINT) AS page, CAST(least({PAGE}, reviews - {PAGE} * (page - 1)) AS INTEGER) AS on_page,
        CAST(reviews AS BIGINT) AS reviews, CAST(score_sum AS BIGINT) AS score_sum FROM p""",
)
def _(m):
    """Which review is on which page is a matter of hashes, so the products' totals over their pages are compared."""
    pages = documents.catalog_review_pages(m.catalog, _product_reviews(m), page_rows=PAGE)
    scores = F.aggregate("reviews", F.lit(0).cast("long"), lambda a, r: a + r["review_score"])
    sized = pages.select("_id", "name", "page", F.size("reviews").alias("on_page"), scores.alias("scores"))
    totals = sized.groupBy("_id").agg(F.sum("on_page").alias("reviews"), F.sum("scores").alias("score_sum"))
    return sized.drop("scores").join(totals, "_id")


@check(
    "catalog_review_page_rows",
    "s_catalog s_items s_reviews",
    """SELECT product_id AS _id, review_id, review_score FROM (SELECT DISTINCT order_id, product_id FROM s_items)
    JOIN s_reviews USING (order_id) WHERE product_id IN (SELECT _id FROM s_catalog)""",
)
def _(m):
    pages = documents.catalog_review_pages(m.catalog, _product_reviews(m), page_rows=PAGE)
    return pages.select("_id", F.inline("reviews"))
