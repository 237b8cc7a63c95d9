"""Recency, frequency and monetary value per customer, and their quantile scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.functions.numbers import exact_sum
from orderlens.operators.rank import ntile_ends, qcut_ends, scores
from orderlens.sources.contracts import OrderTables
from orderlens.stages import stage


def customer_totals(facts: DataFrame) -> DataFrame:
    """Last order, number of orders and money spent per customer."""
    return facts.groupBy("customer_unique_id").agg(
        F.max("order_purchase_timestamp").alias("last_ts"),
        F.count("order_id").alias("Frequency"),
        exact_sum("payment_value").alias("Monetary"))


def _with_recency(totals: DataFrame, as_of: Column) -> DataFrame:
    return (totals.withColumn("Recency", F.datediff(as_of, "last_ts"))
            .filter(F.col("Monetary") > 0))


def rfm(facts: DataFrame) -> DataFrame:
    """RFM as of the day after the last order of ``facts``.

    The totals are staged, so that the reference day and the table come from
    one pass over the orders.
    """
    totals = stage(customer_totals(facts), "totals")
    as_of = totals.agg(F.date_add(F.max("last_ts").cast("date"), 1)).scalar()
    return _with_recency(totals, as_of).select(
        "customer_unique_id", "Recency", "Frequency", "Monetary")


def rfm_task(orders: DataFrame, customers: DataFrame, payments: DataFrame,
             status: str = "delivered") -> DataFrame:
    """RFM straight from orders, customers and payments; the reference day spans all orders.

    Orders are summed per ``customer_id`` before the customer lookup, so a
    customer with very many orders reaches the join as one row.
    """
    paid = payments.groupBy("order_id").agg(exact_sum("payment_value").alias("payment_value"))
    kept = (orders.filter(F.col("order_status") == status)
            .join(paid.filter(F.col("payment_value").isNotNull()), "order_id"))
    per_id = kept.groupBy("customer_id").agg(
        F.max("order_purchase_timestamp").alias("last_ts"),
        F.count("order_id").alias("Frequency"),
        exact_sum("payment_value").alias("Monetary"))
    totals = (per_id.join(customers.select("customer_id", "customer_unique_id"), "customer_id")
              .groupBy("customer_unique_id")
              .agg(F.max("last_ts").alias("last_ts"),
                   F.sum("Frequency").alias("Frequency"),
                   exact_sum("Monetary").alias("Monetary")))
    as_of = orders.agg(F.date_add(F.max("order_purchase_timestamp").cast("date"), 1)).scalar()
    return _with_recency(totals, as_of)


def rfm_task_of(t: OrderTables) -> DataFrame:
    return rfm_task(t.orders, t.customers, t.payments, t.delivered)


def rfm_scores(table: DataFrame, k: int = 5) -> DataFrame:
    """R, F and M scores 1..k and their sum; a recent purchase scores high."""
    scored = scores(table, "customer_unique_id", {
        "R_score": -F.col("Recency"), "F_score": F.col("Frequency"),
        "M_score": F.col("Monetary")}, k, ntile_ends)
    return scored.withColumn("RFM_Score", F.col("R_score") + F.col("F_score") + F.col("M_score"))


def _ascending(table: DataFrame, k: int, ends) -> DataFrame:
    names = ("Recency", "Frequency", "Monetary")
    return scores(table, "customer_unique_id", {f"{c}_score": F.col(c) for c in names}, k, ends)


def ntile_scores(table: DataFrame, k: int = 5) -> DataFrame:
    """``ntile(k)`` of each measure, all ascending."""
    return _ascending(table, k, ntile_ends)


def qcut_scores(table: DataFrame, k: int = 5) -> DataFrame:
    """Equal-frequency bins 0..k-1 of each measure's rank."""
    binned = _ascending(table, k, qcut_ends)
    return binned.withColumns({f"{c}_score": F.col(f"{c}_score") - 1
                               for c in ("Recency", "Frequency", "Monetary")})
