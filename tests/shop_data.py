"""Schemas and small value helpers of the hand-made shop that the tests share."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal


def at(text: str | None) -> dt.datetime | None:
    return None if text is None else dt.datetime.fromisoformat(text)


def money(value: str) -> Decimal:
    return Decimal(value)


ORDER_SCHEMA = """order_id STRING, customer_id STRING, order_status STRING, order_purchase_timestamp TIMESTAMP_NTZ,
    order_delivered_carrier_date TIMESTAMP_NTZ, order_delivered_customer_date TIMESTAMP_NTZ,
    order_estimated_delivery_date TIMESTAMP_NTZ"""
ITEM_SCHEMA = """order_id STRING, order_item_id INT, product_id STRING, seller_id STRING, price DECIMAL(10,2),
    freight_value DECIMAL(10,2)"""
PAYMENT_SCHEMA = """order_id STRING, payment_sequential INT, payment_type STRING, payment_installments INT,
    payment_value DECIMAL(10,2)"""
