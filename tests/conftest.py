from __future__ import annotations

import os
import sys
from types import SimpleNamespace

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from shop_data import ITEM_SCHEMA, ORDER_SCHEMA, PAYMENT_SCHEMA, at, money  # noqa: E402

from mercato.session import configure  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield configure(session)
    session.stop()


@pytest.fixture(scope="session")
def shop(spark):
    """A hand-made shop whose rows sit on the edges of the rules."""

    def order(key, customer, status, bought, sent=None, arrived=None, due=None):
        return (key, customer, status, at(bought), at(sent), at(arrived), at(due))

    orders = [
        # 22 orders of one customer; the newest has no items.
        *[order(f"a{i:02d}", "c1", "delivered", f"2017-01-{i + 1:02d}T10:00:00", None, f"2017-02-{i + 1:02d}T10:00:00", "2017-02-10T00:00:00") for i in range(22)],
        # Delivered two days and one hour early; and one hour after midnight of the next day.
        order("early", "c2", "shipped", "2017-03-01T12:00:00", None, "2017-03-07T23:00:00", "2017-03-10T00:00:00"),
        order("late", "c2", "invoiced", "2017-03-01T12:00:00", None, "2017-03-11T01:00:00", "2017-03-10T23:00:00"),
        # Open orders: no estimate, overdue, due soon, due later.
        order("open0", "c2", "processing", "2018-01-05T06:00:00"),
        order("open1", "c2", "shipped", "2018-01-02T18:00:00", "2018-01-03T00:00:00", None, "2018-01-09T00:00:00"),
        order("open2", "c3", "shipped", "2018-01-03T00:00:00", None, None, "2018-01-12T00:00:00"),
        order("open3", "c3", "processing", "2018-01-04T00:00:00", None, None, "2018-01-12T00:00:01"),
        # Two items, two payments of one type.
        order("fan", "c3", "created", "2018-01-01T00:00:00"),
    ]
    items = [(f"a{i:02d}", 1, "p1" if i % 2 else "p2", "s1", money("10.00"), money("1.00")) for i in range(21)]
    items += [
        ("early", 1, "p3", "s1", money("5.00"), money("0.50")),
        ("fan", 1, "p1", "s1", money("300.00"), money("0.00")),
        ("fan", 2, "p4", "s2", money("400.00"), money("2.00")),
        ("a00", 2, "p3", "s2", money("50.00"), money("0.00")),
        ("a01", 2, "p4", "s2", money("20.00"), money("0.00")),
        ("a02", 2, "p5", "s2", money("7.00"), money("0.00")),
    ]
    payments = [
        ("fan", 1, "voucher", 1, money("300.00")),
        ("fan", 2, "voucher", 3, money("400.00")),
        ("open1", 1, "credit_card", 2, money("500.00")),
        ("open2", 1, "credit_card", 2, money("400.00")),
        ("open2", 2, "boleto", 1, money("200.00")),
    ]
    products = [
        ("p1", "beleza", 100, '{"voltage": "220V", "color": "Black"}'),
        ("p2", "livros", 200, '{"voltage": 220, "warranty_months": 24}'),
        ("p3", None, None, '{"warranty_months": null}'),
        ("p4", "sem_nome", 50, '{"warranty_months": "soon", "a": ["x", "y"]}'),
        ("p5", "outros", 10, None),
    ]
    translation = [("beleza", "beauty"), ("livros", "books"), ("outros", "Uncategorized")]
    customers = [("c1", "u1", "Rio", "RJ"), ("c2", "u2", "Natal", "RN"), ("c3", "u3", "Natal", "RN")]
    sellers = [("s1", "One", "Rio", "RJ"), ("s2", "Two", "Recife", "PE")]
    frame = spark.createDataFrame
    return SimpleNamespace(
        orders=frame(orders, ORDER_SCHEMA),
        items=frame(items, ITEM_SCHEMA),
        payments=frame(payments, PAYMENT_SCHEMA),
        products=frame(products, "product_id STRING, product_category_name STRING, product_weight_g INT, product_attributes STRING"),
        translation=frame(translation, "product_category_name STRING, product_category_name_english STRING"),
        customers=frame(customers, "customer_id STRING, customer_unique_id STRING, customer_city STRING, customer_state STRING"),
        sellers=frame(sellers, "seller_id STRING, seller_name STRING, seller_city STRING, seller_state STRING"),
    )
