import json

import pytest
from pyspark.sql import functions as F
from shop_data import at

from mercato.operators import quality
from mercato.plans import documents
from mercato.sources import io
from mercato.sources.schemas import CATALOG_DOCUMENT, CATALOG_RULES, REVIEW_DOCUMENT, REVIEW_RULES


def rows(df):
    return [r.asDict(recursive=True) for r in df.collect()]


REVIEWS = [
    {
        "_id": "r1", "order_id": "o1", "customer": {"customer_id": "c1", "customer_city": "São Paulo", "customer_state": "SP"},
        "review": {"score": 5, "title": "Excelente produto!", "message": "Ótima qualidade, recomendo", "created_at": "2026-05-10T10:30:00Z",
                   "answer": {"message": "Obrigado", "answered_at": "2026-05-11T09:15:00Z", "answered_by": "s1"}},
        "sentiment_analysis": {"polarity": 0.92, "subjectivity": 0.75, "classification": "very_positive",
                               "keywords": ["ótima"], "topics": ["product_quality", "packaging"]},
        "helpful_votes": 24,
    },
    {
        "_id": "r2", "order_id": "o2", "review": {"score": 2, "title": "Produto com defeito", "message": "Qualidade ruim. Sem qualidades",
                                                    "created_at": "2026-05-12T15:45:00Z"},
        "sentiment_analysis": {"polarity": -0.68, "classification": "negative", "topics": ["product_quality"]},
    },
    {
        "_id": "r3", "order_id": "o3", "review": {"score": 5, "created_at": "2026-05-15T12:20:00Z"},
        "sentiment_analysis": {"classification": "neutral", "topics": []},
    },
    {
        "_id": "bad", "review": {"score": 6, "title": "x" * 101}, "sentiment_analysis": {"polarity": -2.0, "classification": "odd",
                                                                                          "keywords": [None]}, "helpful_votes": -1,
    },
]


@pytest.fixture(scope="module")
def reviews(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("docs") / "reviews.json"
    path.write_text("\n".join(json.dumps(d) for d in REVIEWS))
    return io.read_documents(spark, str(path), REVIEW_DOCUMENT)


def test_review_queries(reviews):
    good = reviews.where("_id <> 'bad'")
    assert [r["_id"] for r in rows(documents.reviews_by_score(good, 5))] == ["r3", "r1"]
    assert [r["_id"] for r in rows(documents.reviews_by_sentiment(good, "negative"))] == ["r2"]
    assert [(r["score"], r["count"], r["avg_polarity"] and float(r["avg_polarity"])) for r in rows(documents.score_distribution(good))] == [
        (5, 2, 0.92),
        (2, 1, -0.68),
    ]
    # Missing and empty topic lists add nothing.
    assert [(r["topic"], r["count"]) for r in rows(documents.topic_frequency(good))] == [("product_quality", 2), ("packaging", 1)]


def test_review_text_search_orders_by_weight(reviews):
    found = rows(documents.review_text_search(reviews, "qualidade"))
    assert [(r["_id"], r["score"]) for r in found] == [("r2", 10.0), ("r1", 5.0)]


def test_validator_warns_or_rejects(reviews):
    checked = {r["_id"]: r["_violations"] for r in rows(quality.validate_documents(reviews, REVIEW_RULES))}
    assert checked["r1"] == checked["r2"] == checked["r3"] == []
    assert checked["bad"] == [
        "order_id: required",
        "review.score: above 5",
        "review.created_at: required",
        "review.title: too long",
        "sentiment_analysis.polarity: below -1",
        "sentiment_analysis.classification: not allowed",
        "sentiment_analysis.keywords: bad item",
        "helpful_votes: below 0",
    ]
    assert quality.validate_documents(reviews, REVIEW_RULES, mode="error").count() == 3
    with pytest.raises(ValueError):
        quality.validate_documents(reviews, REVIEW_RULES, mode="drop")


def test_variant_type_is_checked(spark, tmp_path):
    docs = [
        {"_id": "1", "name": "a", "category": {"name_pt": "p", "name_en": "e"}, "price": 1.0, "specifications": {"k": 1}},
        {"_id": "2", "name": "", "category": {"name_pt": "p"}, "price": -1.0, "specifications": ["k"]},
    ]
    (tmp_path / "c.json").write_text("\n".join(json.dumps(d) for d in docs))
    catalog = io.read_documents(spark, str(tmp_path / "c.json"), CATALOG_DOCUMENT)
    checked = {r["_id"]: r["_violations"] for r in rows(quality.validate_documents(catalog, CATALOG_RULES).select("_id", "_violations"))}
    assert checked == {
        "1": [],
        "2": ["name: too short", "category.name_en: required", "price: below 0", "specifications: not object"],
    }


def test_wrong_types_are_reported_not_lost(spark, tmp_path):
    docs = [
        {"_id": 7, "order_id": "o", "review": {"score": 4.5, "created_at": "soon"}, "helpful_votes": "many", "sentiment_analysis": {"polarity": "high"}},
        {"_id": "b", "order_id": None, "review": "none"},
    ]
    (tmp_path / "r.json").write_text("\n".join(json.dumps(d) for d in docs))
    checked = rows(quality.validate_documents(io.read_documents(spark, str(tmp_path / "r.json"), REVIEW_DOCUMENT), REVIEW_RULES).select("_violations"))
    assert checked[0]["_violations"] == [
        "_id: not string", "review.score: not int", "review.created_at: not date", "sentiment_analysis.polarity: not double", "helpful_votes: not int",
    ]
    assert checked[1]["_violations"] == ["order_id: required", "review: not object"]


def test_csv_values_that_do_not_fit(spark, tmp_path):
    (tmp_path / "p.csv").write_text("order_id,payment_sequential,payment_type,payment_installments,payment_value\na,1,voucher,1,abc\nb,1,voucher,1,2.50\n")
    with pytest.raises(Exception, match="(?i)malformed|abc|NumberFormat|FAILED_READ"):
        io.read_csv_table(spark, str(tmp_path / "p.csv"), "order_payments").collect()
    kept = io.read_csv_table(spark, str(tmp_path / "p.csv"), "order_payments", keep_bad=True)
    assert [tuple(r) for r in io.bad_records(kept).collect()] == [("a", "a,1,voucher,1,abc")] and kept.count() == 2


@pytest.fixture(scope="module")
def parts(spark, shop):
    products = shop.products.select(
        "*", F.col("product_id").alias("product_name"), F.lit(10).alias("product_price"), F.lit("in_stock").alias("stock_status")
    )
    reviews = spark.createDataFrame(
        [("v1", "fan", 5, at("2018-02-01")), ("v2", "a00", 2, at("2018-03-01"))],
        "review_id STRING, order_id STRING, review_score INT, review_creation_date TIMESTAMP_NTZ",
    )
    return products, shop.translation, shop.items, shop.orders, reviews


@pytest.fixture(scope="module")
def offers(spark, shop):
    stock = spark.createDataFrame([("p1", "s1", 3), ("p4", "s2", 0)], "product_id STRING, seller_id STRING, stock INT")
    return documents.product_offers(shop.items, shop.sellers, stock)


def test_product_documents(parts):
    found = {r["_id"]: r for r in rows(documents.build_product_documents(*parts).drop("specifications"))}
    assert len(found) == 5
    p1 = found["p1"]
    assert p1["computed_metrics"]["total_units_sold"] == 11 and p1["computed_metrics"]["total_revenue"] == 400.0
    assert p1["reviews_summary"] == {"total_reviews": 1, "latest_review_id": "v1"}
    assert p1["seller_count"] == 1
    assert found["p3"]["seller_count"] == 2 and found["p3"]["computed_metrics"]["average_rating"] == 2.0
    assert found["p5"]["reviews_summary"]["total_reviews"] == 0


def test_review_counts_once_per_product(spark, parts):
    products, translation, items, orders, reviews = parts
    twice = items.unionByName(items.where("order_id = 'fan' AND product_id = 'p1'"))
    found = {r["_id"]: r for r in rows(documents.build_product_documents(products, translation, twice, orders, reviews).drop("specifications"))}
    assert found["p1"]["reviews_summary"]["total_reviews"] == 1
    assert found["p1"]["computed_metrics"]["total_units_sold"] == 12


def test_a_product_with_thousands_of_sellers_is_one_document(spark, parts):
    products, translation, _, orders, reviews = parts
    sellers = spark.range(3000).select(F.concat(F.lit("s"), "id").alias("seller_id"), F.concat(F.lit("n"), "id").alias("seller_name"))
    items = sellers.select(
        F.lit("a00").alias("order_id"), F.lit(1).alias("order_item_id"), F.lit("p1").alias("product_id"), "seller_id",
        F.lit(1).alias("price"), F.lit(0).alias("freight_value"),
    )
    stock = items.select("product_id", "seller_id", F.lit(5).alias("stock"))
    catalog = documents.build_product_documents(products, translation, items, orders, reviews)
    offers = documents.product_offers(items, sellers, stock)
    one = catalog.where("_id = 'p1'")
    assert one.count() == 1 and one.first()["seller_count"] == 3000 and offers.count() == 3000
    assert documents.catalog_summary(catalog).first()["total_documents"] == 5
    report = documents.document_size_report(one.drop("specifications"), [offers]).first()
    assert report["documents"] == 1 and report["verdict"] == "too large"
    whole = one.drop("specifications").unionByName(one.drop("specifications"))
    bytes_of = lambda df: df.agg(F.sum(F.octet_length(F.to_json(F.struct(*df.columns))))).first()[0]
    assert report["total_bytes"] == bytes_of(one.drop("specifications")) + bytes_of(offers) and whole.count() == 2
    assert quality.validate_documents(one, CATALOG_RULES).count() == 1


def test_catalog_with_reviews_keeps_products_without(spark, parts):
    catalog = documents.build_product_documents(*parts)
    reviews = spark.createDataFrame([("p1", "v1"), ("p1", "v9")], "product_id STRING, review_id STRING")
    found = rows(documents.catalog_with_reviews(catalog, reviews))
    assert sorted((r["_id"], r["review_id"] or "") for r in found) == [
        ("p1", "v1"), ("p1", "v9"), ("p2", ""), ("p3", ""), ("p4", ""), ("p5", ""),
    ]


def test_low_stock_needs_an_offer(parts, offers):
    catalog = documents.build_product_documents(*parts)
    assert documents.low_stock_offers(catalog, offers.limit(0)).count() == 0
    assert [(r["_id"], r["stock"]) for r in rows(documents.low_stock_offers(catalog, offers))] == [("p1", 3)]


def test_concentration(spark):
    df = spark.createDataFrame([("a",)] * 4 + [("b",)] * 3 + [("c",)] * 2 + [("d",)], "k STRING")
    row = documents.category_concentration(df, "k").first()
    assert (float(row["max_share_pct"]), float(row["top3_share_pct"]), row["hotspot"]) == (40.0, 90.0, True)


def test_documents_round_trip(reviews, spark, tmp_path):
    reviews = reviews.drop("_document")
    io.insert_documents(reviews, str(tmp_path / "reviews"))
    io.insert_documents(reviews, str(tmp_path / "reviews"))
    back = io.read_documents(spark, str(tmp_path / "reviews"), REVIEW_DOCUMENT).drop("_document")
    assert back.count() == 2 * reviews.count()
    assert sorted(map(str, back.distinct().collect())) == sorted(map(str, reviews.collect()))


def test_search_filter_agrees_with_the_score(spark):
    texts = ["Excelentes produtos", "excelente", "EXCELÊNTE!", "excel", "não excelenteX", "os produtos", "", None, "pre-excelente fim"]
    df = spark.createDataFrame(list(enumerate(texts)), "_id INT, t STRING")
    from mercato.functions.text import mentions, text_score

    found = df.select("_id", mentions({"t": 1.0}, "excelente produto").alias("m"), text_score({"t": 1.0}, "excelente produto").alias("s")).collect()
    assert all(r["m"] == (r["s"] > 0) for r in found)
    assert [r["_id"] for r in found if r["m"]] == [0, 1, 2, 5, 8]


def test_documents_embed_the_best_offers_only(spark, parts):
    products, translation, _, orders, reviews = parts
    sellers = spark.range(3000).select(F.concat(F.lit("s"), "id").alias("seller_id"), F.concat(F.lit("n"), "id").alias("seller_name"))
    items = sellers.select(
        F.lit("a00").alias("order_id"), F.lit(1).alias("order_item_id"), F.lit("p1").alias("product_id"), "seller_id",
        (F.length("seller_id") * 10).alias("price"), F.lit(0).alias("freight_value"),
    )
    offers = documents.product_offers(items, sellers, items.select("product_id", "seller_id", F.lit(5).alias("stock")))
    built = documents.build_product_documents(products, translation, items, orders, reviews, offers).drop("specifications")
    found = {r["_id"]: r for r in rows(built)}
    assert [s["seller_id"] for s in found["p1"]["sellers"]] == [f"s{i}" for i in range(10)]
    assert found["p1"]["sellers"][0] == {"seller_id": "s0", "seller_name": "n0", "price": 20.0, "stock": 5, "shipping_cost": 0.0}
    assert found["p1"]["seller_count"] == 3000 and documents.referenced_offers(offers).count() == 2990
    assert all(found[p]["sellers"] == [] for p in ("p2", "p3", "p4", "p5"))


def test_map_tasks_keep_their_best_offers_only(parts, offers, capsys):
    documents.embed_offers(documents.build_product_documents(*parts), offers).explain()
    limits = [line for line in capsys.readouterr().out.splitlines() if "WindowGroupLimit" in line]
    assert len(limits) == 2 and "Final" in limits[0] and "Partial" in limits[1]


def test_review_pages_of_a_hot_product(spark, parts):
    catalog = documents.build_product_documents(*parts)
    many = spark.range(6000).select(
        F.when(F.col("id") % 3 == 0, "p1").otherwise(F.concat(F.lit("q"), (F.col("id") % 500).cast("string"))).alias("product_id"),
        F.concat(F.lit("v"), "id").alias("review_id"), F.lit(4).alias("review_score"),
    )
    pages = documents.catalog_review_pages(catalog, many, page_rows=7)
    found = rows(pages)
    hot = sorted((r for r in found if r["_id"] == "p1"), key=lambda r: r["page"])
    assert [r["page"] for r in hot] == list(range(1, 287)) and [len(r["reviews"]) for r in hot] == [7] * 285 + [5]
    assert sorted(v["review_id"] for r in hot for v in r["reviews"]) == sorted(f"v{i}" for i in range(0, 6000, 3))
    assert sorted((r["_id"], r["page"], r["reviews"]) for r in found if r["_id"] != "p1") == [(p, 1, []) for p in ("p2", "p3", "p4", "p5")]
    again = {(r["_id"], r["page"], v["review_id"]) for r in rows(documents.catalog_review_pages(catalog, many.repartition(5), page_rows=7)) for v in r["reviews"]}
    assert again == {(r["_id"], r["page"], v["review_id"]) for r in found for v in r["reviews"]}


def test_items_without_reviews_stay_out_of_the_shuffle(spark, parts, capsys):
    """The ratings drop most items before the join; the filter is a broadcast, also where joins are not."""
    products, translation, items, orders, reviews = parts
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        documents._product_ratings(items, reviews).explain()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "bit_or" in (plan := capsys.readouterr().out) and "BroadcastHashJoin" in plan


def test_counted_sellers_are_broadcast_to_offers(spark, shop, monkeypatch, capsys):
    stock = spark.createDataFrame([("p1", "s1", 3), ("p4", "s2", 0)], "product_id STRING, seller_id STRING, stock INT")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        few = documents.product_offers(shop.items, shop.sellers, stock)
        few.explain()
        assert "BroadcastHashJoin" in capsys.readouterr().out
        monkeypatch.setattr(documents, "BROADCAST_SELLERS", 0)
        many = documents.product_offers(shop.items, shop.sellers, stock)
        many.explain()
        assert "BroadcastHashJoin" not in capsys.readouterr().out
        assert sorted(map(str, few.collect())) == sorted(map(str, many.collect())) != []
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
