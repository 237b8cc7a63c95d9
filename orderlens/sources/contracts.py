"""Logical order tables: their columns, their types and how they hang together."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import types as T

ORDERS = T.StructType([
    T.StructField("order_id", T.StringType()),
    T.StructField("customer_id", T.StringType()),
    T.StructField("order_status", T.StringType()),
    T.StructField("order_purchase_timestamp", T.TimestampType()),
    T.StructField("order_delivered_customer_date", T.TimestampType()),
    T.StructField("order_estimated_delivery_date", T.TimestampType()),
])
CUSTOMERS = T.StructType([
    T.StructField("customer_id", T.StringType()),
    T.StructField("customer_unique_id", T.StringType()),
    T.StructField("customer_state", T.StringType()),
])
ITEMS = T.StructType([
    T.StructField("order_id", T.StringType()),
    T.StructField("order_item_id", T.IntegerType()),
    T.StructField("product_id", T.StringType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("freight_value", T.DoubleType()),
])
PAYMENTS = T.StructType([
    T.StructField("order_id", T.StringType()),
    T.StructField("payment_type", T.StringType()),
    T.StructField("payment_installments", T.IntegerType()),
    T.StructField("payment_value", T.DoubleType()),
])
REVIEWS = T.StructType([
    T.StructField("order_id", T.StringType()),
    T.StructField("review_score", T.IntegerType()),
])
PRODUCTS = T.StructType([
    T.StructField("product_id", T.StringType()),
    T.StructField("product_category_name", T.StringType()),
])
CATEGORIES = T.StructType([
    T.StructField("product_category_name", T.StringType()),
    T.StructField("product_category_name_english", T.StringType()),
])

SCHEMAS = {
    "orders": ORDERS,
    "customers": CUSTOMERS,
    "items": ITEMS,
    "payments": PAYMENTS,
    "reviews": REVIEWS,
    "products": PRODUCTS,
    "categories": CATEGORIES,
}


@dataclass(frozen=True)
class OrderTables:
    """One dataset.

    ``regions`` maps ``customer_state`` to ``region``. ``lines`` is set when
    items, payments and reviews live in one physical table: it then holds their
    measures side by side, so that one scan and one shuffle serve all three.
    ``delivered`` is the status of finished orders, in the source's own codes so
    that the filter reaches its scan.
    """

    orders: DataFrame
    customers: DataFrame
    items: DataFrame
    payments: DataFrame
    reviews: DataFrame
    products: DataFrame
    categories: DataFrame
    regions: DataFrame
    lines: DataFrame | None = None
    delivered: str = "delivered"
