"""Physical plans: no single-task step over rows, early cuts, pruned scans."""

import dataclasses
import pathlib
import re

import pytest
from pyspark.sql import functions as F

from orderlens.operators import customers, facts, rank, rfm
from orderlens.plans.analysis import Analysis
from orderlens.plans.queries import QUERIES, STAR
from orderlens.sources.star import star_tables

FOLDER = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def tables(spark):
    return star_tables(spark, FOLDER)


def test_ranked_rows_never_meet_in_one_partition(spark):
    ranked = rank.range_ranked(spark.range(100).withColumn("v", F.col("id") % 3), "v", "id")
    text = plan(ranked)
    window = text[text.index("Window"):]
    assert "HashAggregate(keys=[_part" in window, "only the per-part totals are windowed"
    assert text.count("SinglePartition") == 1
    assert "rangepartitioning" not in text, "the sorted rows come from the stage table"


def test_first_orders_cut_before_the_shuffle(tables):
    text = plan(customers.first_orders(facts.order_facts(tables)))
    assert text.count("WindowGroupLimit") == 2 and "Partial" in text
    after = text[: text.index("WindowGroupLimit")]
    assert "Exchange" not in after, "both windows share one shuffle"


def test_main_category_cuts_before_the_shuffle(tables):
    """One row an order is left before the exchange, and lines are not aggregated by sorting."""
    text = plan(facts.main_category(tables))
    assert text.count("WindowGroupLimit") == 2 and "SortAggregate" not in text
    some = plan(facts.main_category(tables, orders=tables.orders))
    assert "LeftSemi" in some and "SortAggregate" not in some


def test_order_facts_scan_lines_once_with_pruned_columns(tables):
    text = plan(facts.order_facts(tables))
    assert len(re.findall(r"Scan parquet|FileScan parquet", text)) == 4
    assert "EqualTo(o_orderstatus,F)" in text and "IsNotNull(o_orderdate)" in text
    assert "l_shipdate" not in text and "o_totalprice" not in text
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_rfm_task_aggregates_before_the_customer_join(tables):
    text = plan(rfm.rfm_task_of(tables))
    assert "BroadcastNestedLoopJoin" not in text and "SinglePartition" not in text.split(
        "Subquery")[0]


@pytest.mark.parametrize("name", ["customer_table", "drill_state", "association_tests",
                                  "segment_value", "pareto", "roc_points", "auc_exact"])
def test_no_cross_joins_and_no_python(spark, name):
    text = plan(QUERIES[name](spark, FOLDER))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas"):
        assert operator not in text, operator


def test_hot_customer_is_split_in_the_lookup_join(spark, tables, tmp_path):
    """A third of all orders belong to one customer: the join splits that partition."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1KB",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    many = spark.range(30000, numPartitions=8)
    hot = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 150)
    orders = many.select(
        F.col("id").alias("order_id"), hot.cast("long").alias("customer_id"),
        F.lit("F").alias("order_status"),
        F.expr("TIMESTAMP_NTZ'2020-01-01' + MAKE_DT_INTERVAL(CAST(id % 900 AS INT))")
        .alias("order_purchase_timestamp"),
        F.lit(None).cast("timestamp_ntz").alias("order_delivered_customer_date"),
        F.lit(None).cast("timestamp_ntz").alias("order_estimated_delivery_date"))
    lines = many.select(
        F.col("id").alias("order_id"), (F.col("id") * 7919 % 100003 / 7).alias("price"),
        (F.col("id") * 104729 % 100019 / 11).alias("freight_value"), F.lit("boleto").alias("payment_type"),
        F.lit(1).alias("payment_installments"), F.lit(11.0).alias("payment_value"),
        F.lit(None).cast("int").alias("review_score"))
    t = dataclasses.replace(tables, orders=orders, lines=lines)
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        result = facts.order_facts(t)
        result.write.parquet(str(tmp_path / "facts"))
        df = facts.order_facts(t)
        assert len(df.collect()) == 30000
        text = plan(df)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
    assert "SortMergeJoin(skew=true)" in text
    totals = rfm.customer_totals(spark.read.parquet(str(tmp_path / "facts")))
    assert totals.agg(F.sum("Frequency")).first()[0] == 30000
    first = customers.first_orders(spark.read.parquet(str(tmp_path / "facts")))
    assert first.filter("customer_unique_id = 7").first()["order_id"] == 0


def test_library_collects_only_bounded_results():
    root = pathlib.Path(__file__).parent.parent / "orderlens"
    found = [(p.name, line.strip()) for p in root.rglob("*.py") if p.parent.name != "llm"
             for line in p.read_text().splitlines()
             if re.search(r"\.(collect|toPandas|toLocalIterator|localCheckpoint)\(", line)]
    # Regions; the nodes of a forest whose size is a parameter; medians, regions and two lift rows; k - 1 cuts a metric.
    assert sorted(f for f, _ in found) == ["analysis.py", "attribution.py", "models.py", "models.py", "models.py",
                                           "rank.py", "rank.py"]


def test_first_orders_are_found_once(spark):
    """The customer table reads one window over the facts: its features are a stage of their own."""
    a = Analysis(star_tables(spark, FOLDER), STAR)
    made = plan(customers.first_order_features(a.facts, a.tables.regions, STAR))
    assert made.count("Window ") >= 1
    text = plan(a.customers) + plan(a.features)
    assert "Window" not in text and "first-orders" in plan(a.features)
    joined = plan(customers.customer_table(a.segmented, a.features, facts.main_category(a.tables, orders=a.features), a.facts, STAR))
    assert "order_purchase_timestamp ASC" not in joined
