"""Order facts, RFM, first orders and labels on hand-made tables."""

import datetime as dt
import statistics

import pytest
from pyspark.sql import functions as F

from orderlens import Settings
from orderlens.operators import customers, facts, features, rfm
from orderlens.sources import star
from orderlens.sources.contracts import SCHEMAS, OrderTables

DAY = dt.datetime(2020, 1, 1)


def on(day, hour=0):
    return DAY + dt.timedelta(days=day, hours=hour)


ROWS = {
    "orders": [
        ("o1", "k1", "delivered", on(0, 9), on(7), on(8)),
        ("o2", "k2", "delivered", on(0, 9), on(22), on(10)),
        ("o3", "k3", "delivered", on(400, 1), None, on(410)),
        ("o4", "k4", "canceled", on(1), None, None),
        ("o5", "k3", "delivered", None, None, None),
        ("o6", "k3", "delivered", on(5), None, None),
    ],
    "customers": [("k1", "A", "SP"), ("k2", "A", "RJ"), ("k3", "B", "AM"), ("k4", "C", "XX")],
    "items": [("o1", 1, "p1", 10.0, 1.5), ("o1", 2, "p2", 30.0, 2.5), ("o2", 1, "p3", 0.0, 3.0),
              ("o3", 1, "p1", 5.0, 50.0), ("o4", 1, "p1", 9.0, 1.0), ("o6", 1, "p1", 9.0, 1.0)],
    "payments": [("o1", "voucher", 1, 4.0), ("o1", "credit_card", 6, 40.0),
                 ("o2", "boleto", 0, 3.0), ("o3", "credit_card", 10, 55.0),
                 ("o4", "boleto", 1, 10.0), ("o5", "boleto", 1, 10.0)],
    "reviews": [("o1", 1), ("o1", 2), ("o3", 5)],
    "products": [("p1", "beleza"), ("p2", "moveis"), ("p3", None)],
    "categories": [("beleza", "beauty"), ("moveis", "furniture")],
}


@pytest.fixture(scope="module")
def tables(spark):
    regions = spark.createDataFrame([("SP", "Southeast"), ("RJ", "Southeast"), ("AM", "North")],
                                    "customer_state string, region string")
    loaded = {n: spark.createDataFrame(ROWS[n], schema) for n, schema in SCHEMAS.items()}
    return OrderTables(regions=regions, **loaded)


@pytest.fixture(scope="module")
def facts_df(tables):
    return facts.order_facts(tables).cache()


def by(df, key):
    return {r[key]: r for r in df.collect()}


def test_children_do_not_fan_out(facts_df):
    rows = by(facts_df, "order_id")
    assert set(rows) == {"o1", "o2", "o3"}
    one = rows["o1"]
    assert (one["total_price"], one["total_freight"], one["item_count"]) == (40.0, 4.0, 2)
    assert (one["payment_value"], one["max_installments"], one["used_voucher"]) == (44.0, 6, 1)
    assert one["avg_review_score"] == 1.5
    assert rows["o2"]["avg_review_score"] is None


def test_status_share_and_kpi(tables, facts_df):
    status = by(facts.order_status(tables.orders), "order_status")
    assert (status["delivered"]["count"], status["delivered"]["pct"]) == (5, 83.33)
    kpi = facts.kpi_summary(facts_df).first()
    assert tuple(kpi) == (3, 2, 102.0, 34.0)


def test_category_null_group_and_dearest_item(tables):
    top = by(facts.top_categories(tables), "category")
    assert {k: r["count"] for k, r in top.items()} == {"beauty": 4, "furniture": 1, None: 1}
    assert None not in by(facts.top_categories(tables, keep_null=False), "category")
    main = by(facts.main_category(tables), "order_id")
    assert main["o1"]["category"] == "furniture"
    assert main["o2"]["category"] == "unknown"


def test_rfm_uses_the_person_and_the_day_after_the_last_order(facts_df):
    rows = by(rfm.rfm(facts_df), "customer_unique_id")
    assert tuple(rows["A"])[1:] == (401, 2, 47.0)
    assert tuple(rows["B"])[1:] == (1, 1, 55.0)


def test_rfm_task_reference_day_covers_every_order(tables):
    rows = by(rfm.rfm_task_of(tables), "customer_unique_id")
    assert rows["B"]["Recency"] == 1 and rows["A"]["Frequency"] == 2


def test_first_order_tie_break_and_features(tables, facts_df):
    rows = by(customers.first_order_features(facts_df, tables.regions, Settings()),
              "customer_unique_id")
    a, b = rows["A"], rows["B"]
    assert (a["order_id"], a["days_to_second"], a["first_day"]) == ("o1", 0.0, 0.0)
    assert (a["freight_ratio"], a["delivery_days"], a["delay_days"]) == (0.1, 7.0, -1.0)
    assert (b["days_to_second"], b["delivery_days"], b["has_review"]) == (None, None, 1.0)
    assert (b["freight_ratio"], b["region"]) == (2.0, "North")


def test_undefined_freight_ratio(tables, facts_df):
    free = facts_df.filter("order_id = 'o2'")
    kept = customers.first_order_features(free, tables.regions, Settings()).first()
    assert kept["freight_ratio"] == 2.0
    null = customers.first_order_features(
        free, tables.regions, Settings(), null_ratio_is_cap=False).first()
    assert null["freight_ratio"] is None


def test_labels(tables, facts_df):
    s = Settings()
    feats = customers.first_order_features(facts_df, tables.regions, s)
    rows = by(customers.with_repeat(feats, facts_df, s), "customer_unique_id")
    assert (rows["A"]["mature"], rows["A"]["repeat_180"]) == (True, 1.0)
    assert (rows["B"]["mature"], rows["B"]["repeat_180"]) == (False, 0.0)
    churn = by(customers.with_churn(rfm.rfm(facts_df), s), "customer_unique_id")
    assert (churn["A"]["churn"], churn["B"]["churn"]) == (0.0, 0.0)


def test_one_pass_and_three_pass_measures_agree(spark):
    t = star.star_tables(spark, "/root/testdata/sf0.001")
    import dataclasses
    split = dataclasses.replace(t, lines=None)
    fused, joined = facts.order_facts(t), facts.order_facts(split)
    assert fused.exceptAll(joined.select(fused.columns)).count() == 0
    assert fused.count() == joined.count()


@pytest.mark.parametrize("bits", [64, 2 ** 26])
def test_lines_of_other_orders_go_before_they_are_added_up(spark, bits):
    orders = spark.createDataFrame([(1,), (1,), (64,), (-7,), (None,)], "order_id long")
    lines = spark.createDataFrame([(i, v) for i in (1, 2, 64, -7, None, *range(100, 400)) for v in (1.0, 2.0)],
                                  "order_id long, v double")
    left = [tuple(r) for r in facts.likely_in(lines, orders, bits).collect()]
    assert sorted(r for r in left if r[0] in (1, 64, -7)) == [(i, v) for i in (-7, 1, 64) for v in (1.0, 2.0)]
    assert len(left) < 100 and None not in {r[0] for r in left}
    text = spark.createDataFrame([("a",), ("b",)], "order_id string")
    assert "a" in {r[0] for r in facts.likely_in(text, text.filter("order_id = 'a'"), bits).collect()}


def test_early_facts_are_the_same_and_shuffle_fewer_lines(spark):
    t = star.star_tables(spark, "/root/testdata/sf0.001")
    late, early = facts.order_facts(t), facts.order_facts(t, early=True)
    assert late.exceptAll(early).count() == 0 == early.exceptAll(late).count()
    text = early._jdf.queryExecution().executedPlan().toString()
    lines = text[:text.index("l_orderkey")]
    assert "LeftSemi" in lines[lines.rindex("partial_sum"):], "before the first sums"


def test_impute_and_dummies(spark):
    df = spark.createDataFrame([(1, 1.0, "N"), (2, None, "S"), (3, 4.0, "N"), (4, 8.0, None)],
                               "id long, v double, region string")
    rows = by(features.impute_median(df, ("v",), "id"), "id")
    assert rows[2]["v"] == 4.0
    wide = by(features.dummies(df, "region", ("N", "S")), "id")
    assert tuple(wide[1])[-2:] == (1, 0) and tuple(wide[4])[-2:] == (0, 0)


@pytest.mark.parametrize("n, accuracy", [(1, 10_000), (2, 10_000), (999, 10_000), (1000, 10_000), (1000, 10 ** 7), (1001, 4)])
def test_medians_are_exact_and_do_not_sort_the_table(spark, monkeypatch, n, accuracy):
    columns = {"even": lambda i: i / 7, "ties": lambda i: float(i % 3), "gaps": lambda i: -i / 3 if i % 4 else None,
               "none": lambda i: None, "one": lambda i: 5.0}
    rows = [(i, *(f(i * 7919 % n) for f in columns.values())) for i in range(n)]
    df = spark.createDataFrame(rows, "id long, " + ", ".join(f"{c} double" for c in columns)).repartition(3)

    def refuse(*args):
        raise AssertionError("ranked")

    monkeypatch.setattr(features, "group_percentiles", refuse)
    found = {r["feature"]: r["median"] for r in features.medians(df, tuple(columns), "id", accuracy).collect()}
    known = {c: sorted(r[j + 1] for r in rows if r[j + 1] is not None) for j, c in enumerate(columns)}
    assert found == {c: pytest.approx(statistics.median(v)) for c, v in known.items() if v}


def test_medians_that_the_sketch_misses_are_ranked(spark, monkeypatch):
    df = spark.range(100).select("id", F.col("id").cast("double").alias("v"), F.lit(2.0).alias("w"))
    wrong = F.percentile_approx
    monkeypatch.setattr(features.F, "percentile_approx", lambda c, shares, accuracy: wrong(c, [0.9, 0.95], accuracy))
    assert {tuple(r) for r in features.medians(df, ("v", "w"), "id").collect()} == {("v", 49.5), ("w", 2.0)}


def test_splits_depend_on_ids_only(spark):
    df = spark.range(2000).withColumn("y", (F.col("id") % 10 == 0).cast("double"))
    a = by(features.with_split(df, "id", 42), "id")
    b = by(features.with_split(df.repartition(7), "id", 42), "id")
    assert all(a[i]["split"] == b[i]["split"] for i in a)
    assert 0.77 < sum(r["split"] == "train" for r in a.values()) / 2000 < 0.83
    strat = features.with_stratified_split(df, "id", "y", 42)
    counts = {(r["y"], r["split"]): r["count"] for r in
              strat.groupBy("y", "split").count().collect()}
    assert counts == {(0.0, "train"): 1440, (0.0, "test"): 360, (1.0, "train"): 160,
                      (1.0, "test"): 40}
    sample = {r["id"] for r in features.seeded_sample(df, "id", 1, 50).collect()}
    again = {r["id"] for r in features.seeded_sample(df.repartition(5), "id", 1, 50).collect()}
    assert sample == again and len(sample) == 50


def test_class_weights_guard(spark):
    none = spark.createDataFrame([(0.0,), (0.0,)], "y double")
    assert tuple(customers.class_weights(none, "y").first()) == (2, 0, 2.0)
