"""Outcome drill-downs by place, category, delivery experience and instalments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.functions.buckets import (
    DELAY_BUCKETS, DELIVERY_BUCKETS, INSTALLMENT_BUCKETS, REVIEW_BUCKETS, delay_bucket,
    delivery_bucket, installment_bucket, position_in, review_bucket)
from orderlens.functions.numbers import exact_avg, exact_sum, share

EXPERIENCE = {
    "delivery": DELIVERY_BUCKETS,
    "delay": DELAY_BUCKETS,
    "review": REVIEW_BUCKETS,
}


def group_table(cust: DataFrame, by: str) -> DataFrame:
    """Ten measures per group; repurchase only counts customers old enough to be observed."""
    return cust.groupBy(by).agg(
        F.count(F.lit(1)).alias("Customers"),
        exact_sum("churn").alias("Churned"),
        share("churn = 1").alias("Churn_Rate"),
        F.count_if("mature").alias("Mature_Customers"),
        share("CASE WHEN mature THEN repeat_180 = 1 END").alias("Repeat180_Mature"),
        exact_sum("Monetary").alias("Revenue"),
        exact_avg("Monetary").alias("Avg_Monetary"),
        exact_avg("avg_review_score").alias("Avg_Review"),
        exact_avg("delivery_days").alias("Avg_Delivery_Days"),
        share("delay_days > 0").alias("Late_Rate"))


def large_groups(table: DataFrame, min_mature: int) -> DataFrame:
    """Groups with enough observed customers for a stable rate."""
    return table.filter(F.col("Mature_Customers") >= min_mature)


def busiest(table: DataFrame, name: str, k: int) -> DataFrame:
    """The k groups with most customers."""
    return table.orderBy(F.desc("Customers"), name).limit(k)


def best_worst(table: DataFrame, name: str, rate: str) -> DataFrame:
    """Groups with the highest and lowest rate, and how many times apart they are."""
    up = F.struct(F.col(rate), F.col(name))
    down = F.struct(-F.col(rate), F.col(name))
    return table.filter(F.col(rate).isNotNull()).agg(
        F.max_by(name, up).alias("best"), F.max(rate).alias("best_rate"),
        F.max_by(name, down).alias("worst"), F.min(rate).alias("worst_rate"),
    ).withColumn("ratio", F.try_divide("best_rate", "worst_rate"))


def observed(cust: DataFrame) -> DataFrame:
    """Customers old enough whose first order has a delivery date."""
    return cust.filter(F.col("delivery_days").isNotNull() & F.col("mature"))


def experience_columns() -> dict[str, Column]:
    return {
        "delivery": delivery_bucket(F.col("delivery_days")),
        "delay": delay_bucket(F.col("delay_days")),
        "review": review_bucket(F.col("avg_review_score")),
    }


def long_groups(table: DataFrame, dimensions: dict[str, Column], keep: tuple[str, ...]) -> DataFrame:
    """One row per (customer, dimension) with the group's name; rows without a group drop out."""
    pairs = F.array(*[F.struct(F.lit(d).alias("Dimension"), g.alias("Bucket"))
                      for d, g in dimensions.items()])
    return (table.select(*keep, F.explode(pairs).alias("_g"))
            .select("_g.*", *keep)
            .dropna(subset=["Bucket"]))


def drill_experience(cust: DataFrame) -> DataFrame:
    """Outcomes per delivery, delay and review bucket; buckets nobody is in stay as null rows."""
    rows = long_groups(observed(cust), experience_columns(),
                       ("repeat_180", "churn", "avg_review_score"))
    found = rows.groupBy("Dimension", "Bucket").agg(
        F.count(F.lit(1)).alias("Customers"),
        share("repeat_180 = 1").alias("Repeat180"),
        share("churn = 1").alias("Churn_Rate_Raw"),
        exact_avg("avg_review_score").alias("Avg_Review"))
    listed = [(d, i, b) for d, names in EXPERIENCE.items() for i, b in enumerate(names, start=1)]
    order = cust.sparkSession.createDataFrame(
        listed, "Dimension string, Bucket_Order int, Bucket string")
    return order.join(found, ["Dimension", "Bucket"], "left").select(
        "Dimension", "Bucket_Order", "Bucket", "Customers", "Repeat180", "Churn_Rate_Raw",
        "Avg_Review")


def installments_repeat(cust: DataFrame) -> DataFrame:
    """Repurchase rate per instalment bin of the first order; empty bins are left out."""
    binned = cust.filter("mature").withColumn(
        "Installments", installment_bucket(F.col("max_installments")))
    return binned.dropna(subset=["Installments"]).groupBy("Installments").agg(
        F.count(F.lit(1)).alias("Customers"),
        share("repeat_180 = 1").alias("Repeat180"),
    ).withColumn("Bin_Order", position_in(F.col("Installments"), INSTALLMENT_BUCKETS))


def rate_ci95(table: DataFrame, rate: str, n: str) -> DataFrame:
    """Half-width and bounds of the 95 % normal interval of a rate."""
    p = F.col(rate)
    half = 1.96 * F.sqrt(F.try_divide(p * (1 - p), F.col(n)))
    return table.withColumn("ci95", half).withColumns({
        "ci95_low": p - F.col("ci95"), "ci95_high": p + F.col("ci95")})


def weighted_rate(table: DataFrame, rate: str, n: str) -> DataFrame:
    """Mean of group rates weighted by group size.

    Stacked dimensions count a person once per dimension; use ``overall_rates``
    for the rate over persons.
    """
    hits = F.rint(F.col(rate) * F.col(n))
    weight = F.when(F.col(rate).isNotNull(), F.col(n))
    return table.agg(F.try_divide(F.sum(hits), F.sum(weight)).alias("weighted_rate"))
