"""Line-level tables to one row per order, and the overview reports on orders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from orderlens.functions.numbers import exact_sum, percent
from orderlens.sources.contracts import OrderTables

VOUCHER = "voucher"
# Bits of the filter on order ids; its words hold 2^6 bits each, so at most a million words are broadcast.
FILTER_BITS = 2 ** 26
WORD_SHIFT = 6


def _item_measures() -> dict[str, Column]:
    return {
        "total_price": exact_sum("price"),
        "total_freight": exact_sum("freight_value"),
        "item_count": F.count(F.lit(1)),
    }


def _payment_measures() -> dict[str, Column]:
    voucher = F.when(F.col("payment_type") == VOUCHER, 1).otherwise(0)
    return {
        "payment_value": exact_sum("payment_value"),
        "max_installments": F.max("payment_installments"),
        "used_voucher": F.max(voucher),
    }


def _review_measures() -> dict[str, Column]:
    return {"avg_review_score": F.avg("review_score")}


def _per_order(df: DataFrame, measures: dict[str, Column]) -> DataFrame:
    return df.groupBy("order_id").agg(*[m.alias(name) for name, m in measures.items()])


def order_items(items: DataFrame) -> DataFrame:
    """Price, freight and number of items per order."""
    return _per_order(items, _item_measures())


def order_payments(payments: DataFrame) -> DataFrame:
    """Paid value, longest instalment plan and voucher flag per order."""
    return _per_order(payments, _payment_measures())


def order_reviews(reviews: DataFrame) -> DataFrame:
    """Mean review score per order."""
    return _per_order(reviews, _review_measures())


def likely_in(rows: DataFrame, orders: DataFrame, bits: int = FILTER_BITS) -> DataFrame:
    """``rows`` without most of those whose ``order_id`` is not in ``orders``; all others stay, once each.

    Every order sets one of ``bits`` bits by the hash of its id. The words that hold a set bit are broadcast,
    at most ``bits`` / 64 however many orders there are, so rows are dropped before any shuffle. Ids that
    share a bit pass as well: an exact join must follow.
    """
    def place(ids: DataFrame) -> Column:
        return F.pmod(F.xxhash64(ids["order_id"]), F.lit(bits))

    def word(at: Column) -> Column:
        return F.shiftright(at, WORD_SHIFT)

    def bit(at: Column) -> Column:
        return at.bitwiseAND(2 ** WORD_SHIFT - 1).cast("int")

    at = place(orders)
    words = (orders.filter(F.col("order_id").isNotNull())
             .select(word(at).alias("_word"), F.call_function("shiftleft", F.lit(1).cast("long"), bit(at)).alias("_bit"))
             .groupBy("_word").agg(F.bit_or("_bit").alias("_bits")))
    seen = rows.filter(F.col("order_id").isNotNull())
    at = place(seen)
    return seen.join(F.broadcast(words), (word(at) == F.col("_word"))
                     & (F.bit_get("_bits", bit(at)) == 1), "left_semi")


def order_measures(t: OrderTables, orders: DataFrame | None = None) -> DataFrame:
    """All child measures per order, aggregated before any join so that sums cannot fan out.

    With ``orders``, lines of most other orders are left out before they are added up.
    """
    if t.lines is not None:
        lines = t.lines if orders is None else likely_in(t.lines, orders)
        return _per_order(lines, _item_measures() | _payment_measures() | _review_measures())
    # Paid orders are the only ones the facts keep, so payments lead the join.
    return (order_payments(t.payments)
            .join(order_items(t.items), "order_id", "left")
            .join(order_reviews(t.reviews), "order_id", "left"))


def order_facts(t: OrderTables, early: bool = False) -> DataFrame:
    """One row per delivered, dated and paid order, with its customer and child measures.

    The order-keyed joins come first and share one shuffle on ``order_id``; the
    customer lookup sees only the rows that survive the filters. ``early`` leaves out
    lines of other orders before that shuffle, for one more scan of the orders.
    """
    kept = t.orders.filter(
        (F.col("order_status") == t.delivered) & F.col("order_purchase_timestamp").isNotNull())
    paid = kept.join(order_measures(t, kept if early else None).filter(F.col("payment_value").isNotNull()), "order_id")
    return paid.join(t.customers, "customer_id", "left")


def order_status(orders: DataFrame) -> DataFrame:
    """Orders per status with their share of all orders."""
    counts = orders.groupBy("order_status").count()
    total = F.sum("count").over(W.partitionBy())
    return counts.withColumn("pct", percent(F.col("count"), total, 2)).orderBy(
        F.desc("count"), "order_status")


def kpi_summary(facts: DataFrame) -> DataFrame:
    """Orders, persons, revenue and average order value in one pass."""
    return facts.agg(
        F.count(F.lit(1)).alias("total_orders"),
        F.count_distinct("customer_unique_id").alias("unique_customers"),
        exact_sum("payment_value").alias("total_revenue"),
    ).withColumn("avg_order_value", F.try_divide("total_revenue", "total_orders"))


def monthly_trend(facts: DataFrame) -> DataFrame:
    """Orders per calendar month."""
    month = F.date_format("order_purchase_timestamp", "yyyy-MM")
    return facts.groupBy(month.alias("month")).count().orderBy("month")


def _category_names(t: OrderTables) -> DataFrame:
    return t.products.join(t.categories, "product_category_name", "left").select(
        "product_id", F.col("product_category_name_english").alias("category"))


def top_categories(t: OrderTables, k: int = 10, keep_null: bool = True) -> DataFrame:
    """The k categories with most items; items without a category form a group of their own.

    Items are counted per product before the lookup, so a best-seller reaches
    the join as one row.
    """
    per_product = t.items.groupBy("product_id").agg(F.count(F.lit(1)).alias("_items"))
    counts = (per_product.join(_category_names(t), "product_id", "left")
              .groupBy("category").agg(F.sum("_items").alias("count")))
    if not keep_null:
        counts = counts.dropna(subset=["category"])
    return counts.orderBy(F.desc("count"), F.asc_nulls_first("category")).limit(k)


def main_category(t: OrderTables, unknown: str = "unknown", orders: DataFrame | None = None) -> DataFrame:
    """Category of the dearest item of each order, or of the ``order_id`` rows of ``orders`` only.

    The items of other orders are dropped before they are compared; the window and the
    semi join share one shuffle.
    """
    items = t.items.select("order_id", "order_item_id", "product_id", "price")
    if orders is not None:
        items = items.join(orders.select("order_id"), "order_id", "left_semi")
    dearest = W.partitionBy("order_id").orderBy(F.desc_nulls_last("price"), "order_item_id", "product_id")
    top_item = items.withColumn("_place", F.row_number().over(dearest)).filter("_place = 1")
    return top_item.join(_category_names(t), "product_id", "left").select(
        "order_id", F.coalesce("category", F.lit(unknown)).alias("category"))
