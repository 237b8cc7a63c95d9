"""The batch run from CSV files, and the limits that sums, tests and scans must not have."""

import math
from decimal import Decimal
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from orderlens import Settings, stages
from orderlens.functions.labels import effect_size
from orderlens.functions.numbers import exact_sum
from orderlens.operators import customers, decide, drill, features, segments, stats
from orderlens.plans.queries import STAR
from orderlens.plans.reports import REPORTS, TABLES, run_reports
from orderlens.sources import files
from orderlens.sources.contracts import PAYMENTS
from orderlens.sources.star import star_tables


def test_reports_from_seven_csv_files(spark, tmp_path):
    t = star_tables(spark, "/root/testdata/sf0.001")
    paths = {}
    for name in ("orders", "customers", "items", "payments", "reviews", "products", "categories"):
        table = getattr(t, name)
        if name == "orders":
            table = table.withColumn("order_status", F.when(F.col("order_status") == "F", "delivered")
                                     .otherwise(F.col("order_status")))
        paths[name] = str(tmp_path / name)
        table.coalesce(1).write.options(header=True, timestampFormat="yyyy-MM-dd HH:mm:ss",
                                        timestampNTZFormat="yyyy-MM-dd HH:mm:ss").csv(paths[name])
    settings = Settings(**{**STAR.__dict__, "min_state_mature": 1, "min_category_mature": 1, "min_test_group": 1,
                           "k_range": (2, 3), "forest_trees": 5, "boosted_rounds": 3, "logistic_rounds": 10})
    written = run_reports(spark, paths, str(tmp_path / "out"), settings)
    assert written == [*REPORTS, *TABLES]
    for name in REPORTS:
        assert spark.read.option("header", True).csv(str(tmp_path / "out" / name)).count() > 0, name
    segmented = spark.read.parquet(str(tmp_path / "out" / "segmented_customers"))
    assert {"R_score", "F_score", "M_score", "RFM_Score", "Segment_Label"} <= set(segmented.columns)


@pytest.mark.parametrize("values", [
    [1e15] * 30, [1.2e13, 1.2e13], [4e-7, 4e-7, 4e-7], [1e20, 0.1, -1e20], [-0.1, -5e5, -3e12 - 0.25], [2.0**60, 0.5]])
def test_exact_sum_has_no_range(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x double").repartition(3)
    want = float(sum(Decimal(round(v * 1e6)) if abs(v) < 1e9 else Decimal(v) * 1000000 for v in values) / 1000000)
    assert df.agg(exact_sum("x")).first()[0] == want
    fine = spark.createDataFrame([(1e-9,)] * 5 + [(1e15,)], "x double")
    assert fine.agg(exact_sum("x", 9)).first()[0] == 1e15 + 5e-9
    assert fine.filter("x < 1").agg(exact_sum("x", 9)).first()[0] == 5e-9


@pytest.mark.parametrize("digits", [0, 2, 6, 9])
def test_exact_sum_uses_decimals_for_large_totals_only(spark, digits):
    """Totals on either side of what a double holds, negative and null ones; small ones take the first branch."""
    edge = Fraction(2 ** 53, 10 ** digits)
    fine = [0.1, 0.7, 1e-5] if digits else [3.0, 4.0]
    groups = [[float(edge * k // 10), *fine] for k in (-12, -8, -4, -3, 3, 4, 8, 9, 12)] + [[-0.3, 0.2], [-0.0], [None, 2.5], [None]]
    rows = [(i, x) for i, values in enumerate(groups) for x in values]
    got = dict(spark.createDataFrame(rows, "g int, x double").groupBy("g").agg(exact_sum("x", digits)).collect())

    def rounded(x):
        low = math.floor(Fraction(x) / 2 ** 20) * 2 ** 20
        return low * 10 ** digits + round((x - low) * 10.0 ** digits)

    for i, values in enumerate(groups):
        known = [x for x in values if x is not None]
        assert got[i] == (float(Fraction(sum(map(rounded, known)), 10 ** digits)) if known else None)
    assert str(exact_sum("x", digits)).startswith("Column<'CASE WHEN")


def test_reports_at_very_large_revenue(spark):
    rows = [(i, 1 + i % 5, 100 * (i % 7), s, 1e15, 1.0, True, 0.0, 4.0, 5.0, 1.0, f"S{i % 3}", f"c{i % 2}")
            for i, s in enumerate(["Recent Buyers", "At-Risk Buyers", "Lost Customers", "Repeat Buyers"] * 10)]
    cust = spark.createDataFrame(rows, "customer_unique_id long, Frequency int, Recency int, Segment_Label string, "
                                 "Monetary double, churn double, mature boolean, repeat_180 double, "
                                 "avg_review_score double, delivery_days double, delay_days double, "
                                 "customer_state string, category string")
    value = segments.segment_value(cust, Settings()).collect()
    assert {(r["Revenue"], r["Revenue_Share_pct"]) for r in value} == {(1e16, 25.0)}
    economics = decide.segment_economics(cust)
    assert decide.impact_scenarios(economics, Settings()).filter("Revenue_pct IS NULL").count() == 0
    facts = cust.select(F.col("customer_unique_id").alias("order_id"), F.col("Monetary").alias("payment_value"))
    items = facts.select("order_id", F.col("payment_value").alias("price"), F.lit(0.0).alias("freight_value"))
    checks = decide.consistency_checks(facts, items, cust, cust, Settings()).collect()
    by = {(r["metric"], r["source_b"]): r["matched"] for r in checks}
    assert len(checks) == 15 and by["revenue", "sum over states"] and by["revenue", "items (price + freight)"]
    settings = Settings(uplift_points=(0.005, 0.02, 0.07), uplift_spend=(0.1, 1.0))
    rates, tests = customers.overall_rates(cust), stats.association_tests(cust, 1)
    instalments = spark.createDataFrame([], "Installments string, Repeat180 double")
    table = decide.action_evidence(
        economics, decide.impact_scenarios(economics, settings), drill.group_table(cust, "category"), rates,
        instalments, tests, drill.drill_experience(cust), tests, uplift_point=0.02)
    topics = [r["Topic"] for r in table.collect()]
    assert sorted(topics[:4]) == ["At-Risk Buyers", "Lost Customers", "Recent Buyers", "Repeat Buyers"]
    assert len(topics) == 6


def test_p_values_at_any_degree_of_freedom(spark):
    """Against the published limits: median of chi-square, and small cases in closed form."""
    rows = [(2.0, 2), (9.0, 2), (40.0, 2), (4.0, 4), (200000.0, 200000), (2e6, 2000000), (2e6 + 6000, 2000000)]
    df = spark.createDataFrame(rows, "c double, d int")
    p = [r[0] for r in df.select(stats.chi2_p_value(F.col("c"), F.col("d"))).collect()]
    assert p[:4] == pytest.approx([math.exp(-1), math.exp(-4.5), math.exp(-20), 3 * math.exp(-2)], rel=1e-12)
    # Q(a, a) = 1/2 - 1/(3 sqrt(2 pi a)) + ..., from Temme's expansion.
    for value, a in ((p[4], 1e5), (p[5], 1e6)):
        assert value == pytest.approx(0.5 - 1 / (3 * math.sqrt(2 * math.pi * a)) - 1 / (540 * a * math.sqrt(2 * math.pi * a)),
                                      abs=1e-8)
    assert 0 < p[6] < 0.002


def test_no_test_has_no_effect_and_is_not_significant(spark):
    assert spark.range(1).select(effect_size(F.lit(None).cast("double"))).first()[0] is None
    tests = spark.createDataFrame([("a", None), ("b", 0.01), ("c", 0.5)], "Dimension string, p_value double")
    got = {r["Dimension"]: r["significant"] for r in stats.significant(tests).collect()}
    assert got == {"a": False, "b": True, "c": False}


def test_csv_folder_with_mixed_headers_or_bad_values_is_refused(spark, tmp_path):
    (tmp_path / "p").mkdir()
    (tmp_path / "p" / "a.csv").write_text("order_id,payment_type,payment_installments,payment_value\no,voucher,2,20.5\n")
    (tmp_path / "p" / "b.csv").write_text("order_id,payment_type,payment_value,payment_installments\nq,voucher,20.5,3\n")
    with pytest.raises(Exception, match="header"):
        files.read_csv(spark, str(tmp_path / "p"), PAYMENTS).collect()
    (tmp_path / "bad.csv").write_text("order_id,payment_type,payment_installments,payment_value\no,voucher,2,oops\n")
    with pytest.raises(Exception, match="MALFORMED|oops"):
        files.read_csv(spark, str(tmp_path / "bad.csv"), PAYMENTS).collect()
    assert files.read_csv(spark, str(tmp_path / "bad.csv"), PAYMENTS, mode="PERMISSIVE").first()["payment_value"] is None


def test_stages_can_be_removed(spark):
    path = stages.new_path(spark, "gone")
    spark.range(3).write.parquet(path)
    stages.remove(spark, path)
    assert files.load_if_present(spark, path) is None


def test_sample_smaller_than_the_table(spark):
    df = spark.range(1000).withColumnRenamed("id", "k")
    a, b = (features.seeded_sample(df.repartition(n), "k", 42, 100).collect() for n in (1, 7))
    assert len(a) == 100 and sorted(a) == sorted(b)
