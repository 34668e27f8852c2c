import datetime as dt
from decimal import Decimal

import pytest

from mercato.plans import retail


def rows(df):
    return [r.asDict() for r in df.collect()]


def test_history_and_limit_first_differ(shop):
    base = rows(retail.customer_order_history(shop.orders, shop.items, "c1"))
    first = rows(retail.customer_order_history_limit_first(shop.orders, shop.items, "c1"))
    # The newest order has no items: the base query replaces it, the other loses it.
    assert [r["order_id"] for r in base] == [f"a{i:02d}" for i in range(20, 0, -1)]
    assert [r["order_id"] for r in first] == [f"a{i:02d}" for i in range(20, 1, -1)]
    assert base[0]["total_items"] == 1 and base[0]["total_value"] == Decimal("11.00")


def test_status_history(shop):
    found = rows(retail.customer_status_history(shop.orders, "c1", "delivered"))
    assert [r["order_id"] for r in found] == [f"a{i:02d}" for i in range(21, 11, -1)]


def test_null_category_and_real_label_stay_apart(shop):
    sales = retail.category_sales_labelled(shop.items, shop.products, shop.translation, shop.orders, "2017-01-01", "2018-01-01")
    found = sorted((r["category"], r["total_orders"], r["total_items_sold"], r["total_revenue"]) for r in rows(sales))
    assert found == [
        ("Uncategorized", 1, 1, Decimal("7.00")),
        ("Uncategorized", 2, 2, Decimal("70.00")),
        ("beauty", 10, 10, Decimal("100.00")),
        ("books", 11, 11, Decimal("110.00")),
    ]


def test_category_sales_keeps_one_null_group(shop):
    sales = rows(retail.category_sales(shop.items, shop.products, shop.translation, shop.orders, "2017-01-01", "2018-01-01"))
    assert [r["category"] for r in sales] == ["books", "beauty", None, "Uncategorized"]
    assert float(sales[2]["avg_price"]) == 35.0 and sales[2]["min_price"] == Decimal("20.00")


def test_payment_summary(shop):
    found = rows(retail.order_payment_summary(shop.orders, shop.payments, "2018-01-10"))
    # 500 is not above the minimum, unpaid orders drop out, equal types appear once.
    assert [(r["order_id"], r["payment_types"], r["max_installments"], r["payment_methods_count"]) for r in found] == [
        ("fan", "voucher", 3, 2),
        ("open2", "boleto, credit_card", 2, 2),
    ]


def test_bounded_summary_has_an_upper_end_and_can_keep_unpaid(shop):
    found = rows(retail.order_payment_summary_bounded(shop.orders, shop.payments, "2018-01-03", min_total=-1))
    assert {r["order_id"]: (r["total_paid"], r["payment_types"]) for r in found} == {
        "fan": (Decimal("700.00"), "voucher"),
        "open1": (Decimal("500.00"), "credit_card"),
        "open2": (Decimal("600.00"), "boleto, credit_card"),
    }


def test_top_products_variants_agree_while_orders_are_unique(shop):
    base = rows(retail.top_products(shop.products, shop.items, shop.orders))
    semi = rows(retail.top_products_exists(shop.products, shop.items, shop.orders))
    keys = [k for k in base[0] if k != "avg_unit_price"]
    assert [{k: r[k] for k in keys} for r in base] == [{k: r[k] for k in keys} for r in semi]
    assert [(r["product_id"], r["orders_count"]) for r in base] == [("p2", 11), ("p1", 10)]


def test_repeated_order_multiplies_only_the_join(shop):
    twice = shop.orders.unionByName(shop.orders)
    base = rows(retail.top_products(shop.products, shop.items, twice))
    semi = rows(retail.top_products_exists(shop.products, shop.items, twice))
    assert base[0]["total_revenue"] == 2 * semi[0]["total_revenue"]


def test_line_number_as_quantity_and_corrected(shop):
    literal = rows(retail.top_products(shop.products, shop.items, shop.orders, min_orders=1))
    fixed = rows(retail.top_products_corrected(shop.products, shop.items, shop.orders, min_orders=1))
    p4 = [next(r for r in found if r["product_id"] == "p4") for found in (literal, fixed)]
    assert [(r["total_items_sold"], r["total_revenue"]) for r in p4] == [(2, Decimal("40.00")), (1, Decimal("20.00"))]


def test_pending_deliveries(shop):
    found = rows(retail.pending_deliveries(shop.orders, shop.customers, "2018-01-10"))
    assert [(r["order_id"], r["delivery_priority"], r["days_since_purchase"]) for r in found] == [
        ("open1", "DELAYED", 7),
        ("open2", "URGENT", 7),
        ("open3", "ON_TIME", 6),
        ("open0", "ON_TIME", 4),
    ]
    calendar = rows(retail.pending_deliveries_prioritised(shop.orders, shop.customers, "2018-01-10"))
    assert [r["days_since_purchase"] for r in calendar] == [8, 7, 6, 5]


def test_delay_stats_are_not_equivalent(shop):
    base = {r["order_status"]: r for r in rows(retail.delivery_delay_stats(shop.orders, "2017-01-01"))}
    late_only = {r["order_status"]: r for r in rows(retail.delivery_delay_stats_delayed_only(shop.orders, "2017-01-01"))}
    assert float(base["shipped"]["avg_delay_days"]) == -2 and late_only["shipped"]["avg_delay_days"] is None
    assert float(base["invoiced"]["avg_delay_days"]) == 0 and float(late_only["invoiced"]["avg_delay_days"]) == 1
    assert base["delivered"]["delayed_orders"] == late_only["delivered"]["delayed_orders"] == 13


def test_seller_revenue_variants(shop):
    base = rows(retail.seller_revenue(shop.sellers, shop.items, shop.orders, "2017-01-01", "2018-01-01", min_rev=76))
    pre = retail.seller_revenue_preagg(shop.sellers, shop.items, shop.orders, "2017-01-01", "2018-01-01", min_rev=76)
    assert [(r["seller_id"], r["total_orders"], r["total_revenue"]) for r in base] == [
        ("s1", 21, Decimal("231.00")),
        ("s2", 3, Decimal("77.00")),
    ]
    assert pre.columns[0] == "seller_id" and pre.columns[-2:] == ["seller_state", "seller_city"]


def test_geo_matrix_counts_and_weights(shop):
    found = rows(retail.geo_sales_matrix(shop.orders, shop.customers, shop.items, shop.sellers, "2017-01-01", min_orders=1))
    top = found[0]
    assert (top["customer_state"], top["seller_state"], top["total_orders"], top["unique_customers"]) == ("RJ", "RJ", 21, 1)
    assert float(top["avg_order_value"]) == 10 and float(top["avg_delivery_days"]) == 31


def test_attributes(shop):
    strict = retail.product_attr_contains(shop.products, {"voltage": "220V"}, "beleza")
    assert [(r["product_id"], r["color"]) for r in rows(strict)] == [("p1", "Black")]
    safe = retail.product_attr_min(shop.products, "warranty_months", 12, safe=True)
    assert [r["product_id"] for r in rows(safe)] == ["p2"]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        retail.product_attr_min(shop.products, "warranty_months", 12).collect()


def test_order_detail_fans_out(shop):
    found = rows(
        retail.order_detail(shop.orders, shop.customers, shop.items, shop.products, shop.sellers, shop.payments, "fan")
    )
    assert [(r["order_item_id"], r["payment_installments"]) for r in found] == [(1, 1), (1, 3), (2, 1), (2, 3)]
    unpaid = retail.order_detail(shop.orders, shop.customers, shop.items, shop.products, shop.sellers, shop.payments, "a00")
    assert [r["payment_type"] for r in rows(unpaid)] == [None, None]


def test_interval_average(shop):
    row = rows(retail.period_avg_interval(shop.orders, "2017-01-01", "2017-02-01"))[0]
    assert row["avg_delivery_time"] == dt.timedelta(days=31) and float(row["avg_delivery_seconds"]) == 31 * 86400


def test_period_and_lookup(shop):
    row = rows(retail.period_delivery_summary(shop.orders, "2017-03-01", "2017-04-01"))[0]
    assert (row["total_orders"], row["delivered_orders"], float(row["avg_delivery_days"])) == (2, 0, 7.5)
    assert retail.order_lookup_in_month(shop.orders, "early", "2017-03-01", "2017-04-01").count() == 1
    assert retail.order_lookup_in_month(shop.orders, "early", "2017-04-01", "2017-05-01").count() == 0


def test_state_sales_and_status(shop):
    found = rows(retail.state_sales(shop.orders, shop.customers, shop.items, "2017-01-01", "2017-07-01"))
    assert [(r["customer_state"], r["total_orders"], r["total_sales"]) for r in found] == [("RJ", 21, Decimal("287.00"))]
    counts = {r["order_status"]: r["total_orders"] for r in rows(retail.status_counts(shop.orders))}
    assert counts["delivered"] == 22 and counts["created"] == 1


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_heavy_queries_expand_no_rows(shop):
    assert "Expand" not in plan_of(retail.top_products(shop.products, shop.items, shop.orders))
    assert "Expand" not in plan_of(retail.geo_sales_matrix(shop.orders, shop.customers, shop.items, shop.sellers, "2017-01-01", 1))


def test_one_order_shuffles_no_dimension(spark, shop):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(retail.order_detail(shop.orders, shop.customers, shop.items, shop.products, shop.sellers, shop.payments, "fan"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "SortMergeJoin" not in plan and plan.count("BroadcastHashJoin") == 5


def test_report_time_counts_hours(shop):
    # open1 was bought at 18:00; at 17:00 sixteen days later fifteen whole days have passed.
    def age(as_of):
        found = retail.pending_deliveries(shop.orders, shop.customers, as_of=as_of)
        return {r["order_id"]: r["days_since_purchase"] for r in found.collect()}

    assert age("2018-01-18 17:00:00")["open1"] == 15 and age("2018-01-18 18:00:00")["open1"] == 16


def test_a_huge_order_is_not_broadcast(spark, shop, monkeypatch):
    monkeypatch.setattr(retail, "POINT_ROWS", 1)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = retail.order_detail(shop.orders, shop.customers, shop.items, shop.products, shop.sellers, shop.payments, "fan")
        plan = plan_of(found)
        assert plan.count("BroadcastHashJoin") == 1 and "SortMergeJoin" in plan
        huge = found.collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    monkeypatch.setattr(retail, "POINT_ROWS", 100)
    assert huge == retail.order_detail(shop.orders, shop.customers, shop.items, shop.products, shop.sellers, shop.payments, "fan").collect() and len(huge) == 4


def test_best_products_are_found_once(spark, shop):
    """The winners are read back, not found again for their sellers: the plan of the answer sums nothing."""
    for build in (retail.top_products, retail.top_products_exists, retail.top_products_corrected):
        found = build(shop.products, shop.items, shop.orders, min_orders=1)
        assert "sum(" not in plan_of(found) and found.count() > 0
