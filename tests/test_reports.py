"""Drill-downs, tests, evaluation and decision tables against hand-made and published numbers."""

import pytest
from pyspark.sql import functions as F

from orderlens import Settings
from orderlens.functions import buckets
from orderlens.functions.numbers import exact_sum, round_even
from orderlens.functions.regions import region_of
from orderlens.operators import decide, drill, evaluate, segments, stats


def column(spark, values, expression, kind="double"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("x"))).collect()]


def test_bucket_edges(spark):
    assert column(spark, [7.0, 8.0, 14.0, 15.0, 21.0, 22.0], buckets.delivery_bucket) == [
        "<=7 days", "8-14 days", "8-14 days", "15-21 days", "15-21 days", ">21 days"]
    assert column(spark, [-1.0, 0.0, 1.0, 7.0, 8.0, None], buckets.delay_bucket) == [
        "on time or early", "on time or early", "1-7 days late", "1-7 days late", ">7 days late",
        None]
    assert column(spark, [1.5, 2.5, 3.5, 4.5, 1.2, None], buckets.review_bucket) == [
        "2 stars", "2 stars", "4 stars", "4 stars", "1 star", "no review"]
    counts = [0.0, 1.0, 2.0, 3.0, 4.0, 6.0, 7.0, 10.0, 11.0, 100.0, 101.0, None]
    assert column(spark, counts, buckets.installment_bucket) == [
        None, "1", "2-3", "2-3", "4-6", "4-6", "7-10", "7-10", ">10", ">10", None, None]


def test_regions_and_half_even(spark):
    assert column(spark, ["SP", "AC", "ZZ", None], region_of, "string") == [
        "Southeast", "North", "Other", "Other"]
    assert column(spark, [0.5, 1.5, 2.5, -0.5], round_even) == [0.0, 2.0, 2.0, 0.0]
    assert column(spark, [0.125, 0.375], lambda c: round_even(c, 2)) == [0.12, 0.38]


@pytest.mark.parametrize("values", [
    [0.1, 0.2, -0.3], [7000000001.123456, 0.000001, 8000000002.654321], [-9007199300.5, 0.25],
    [1e12] * 40 + [0.000001], [None, None]])
def test_exact_sum_is_the_nearest_double(spark, values):
    from decimal import Decimal
    df = spark.createDataFrame([(v,) for v in values], "x double").repartition(3)
    got = df.agg(exact_sum("x")).first()[0]
    known = [round(Decimal(v), 6) for v in values if v is not None]
    assert got == (float(sum(known)) if known else None)


# Size and repurchase rate per bucket in the published report.
PUBLISHED = {
    "delivery": [(13980, 0.0328), (23243, 0.0317), (10909, 0.0302), (7901, 0.0280)],
    "delay": [(52211, 0.0314), (2025, 0.0281), (1797, 0.0267)],
    "review": [(5589, 0.0302), (1800, 0.0344), (4866, 0.0321), (11185, 0.0293), (32174, 0.0316),
               (419, 0.0310)],
    "installments": [(26803, 0.028355034884154758), (12863, 0.030008551659799425),
                     (9336, 0.03299057412167952), (6837, 0.04153868655843206),
                     (196, 0.04081632653061224)],
}


def published_counts(spark):
    rows = [(d, str(i), n, round(n * p)) for d, groups in PUBLISHED.items()
            for i, (n, p) in enumerate(groups)]
    return spark.createDataFrame(rows, "Dimension string, Bucket string, n long, hits long")


def test_chi_square_of_the_published_report(spark):
    rows = {r["Dimension"]: r for r in stats.chi_square(published_counts(spark)).collect()}
    assert rows["installments"]["Chi2"] == pytest.approx(33.588, abs=1e-3)
    assert rows["installments"]["p_value"] == pytest.approx(9.05e-7, rel=1e-2)
    assert round(rows["installments"]["Cramers_V"], 4) == 0.0245
    for name, chi2, p in (("delivery", 4.6, 0.208), ("delay", 1.9, 0.384), ("review", 2.4, 0.788)):
        assert rows[name]["Chi2"] == pytest.approx(chi2, abs=0.1)
        assert rows[name]["p_value"] == pytest.approx(p, abs=0.02)
        assert rows[name]["Effect"] == "weak"


def test_yates_only_at_one_degree_of_freedom(spark):
    counts = spark.createDataFrame(
        [("a", "x", 30, 10), ("a", "y", 30, 20), ("b", "x", 30, 10), ("b", "y", 30, 20),
         ("b", "z", 30, 15), ("one", "x", 30, 3), ("same", "x", 9, 0), ("same", "y", 9, 0),
         ("tiny", "x", 30, 10), ("tiny", "y", 5, 5)],
        "Dimension string, Bucket string, n long, hits long")
    rows = {r["Dimension"]: r for r in stats.chi_square(counts, 6).collect()}
    assert rows["a"]["Chi2"] == pytest.approx(5.4)
    assert rows["b"]["Chi2"] == pytest.approx(6.6666667)
    assert rows["one"]["Chi2"] is None and rows["one"]["p_value"] is None
    assert rows["same"]["Chi2"] is None
    assert rows["tiny"]["Groups"] == 1


def test_spearman_ties_and_nulls(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 6.0), (2.0, 7.0), (4.0, 7.0), (None, 1.0)],
                               "a double, b double").withColumn("g", F.monotonically_increasing_id())
    row = stats.spearman(df, "a", "b", "g").first()
    assert row["groups"] == 4
    assert row["rho"] == pytest.approx(0.8333333)
    assert stats.spearman(df, "a", "b", "g", negate_b=True).first()["rho"] == pytest.approx(-0.8333333)


def people(spark):
    cols = ("customer_state string, delivery_days double, delay_days double, "
            "avg_review_score double, max_installments double, churn double, mature boolean, "
            "repeat_180 double, Monetary double")
    return spark.createDataFrame([
        ("S", 3.0, -2.0, 1.5, 1.0, 1.0, True, 0.0, 10.0),
        ("S", 9.0, None, None, 2.0, 0.0, True, 1.0, 20.0),
        ("T", None, None, 4.0, 2.0, 0.0, True, 1.0, 30.0),
        ("T", 30.0, 9.0, 5.0, 12.0, 0.0, False, 0.0, 40.0),
    ], cols)


def test_group_table_and_buckets(spark):
    rows = {r["customer_state"]: r for r in
            drill.group_table(people(spark), "customer_state").collect()}
    assert (rows["S"]["Customers"], rows["S"]["Repeat180_Mature"], rows["S"]["Late_Rate"]) == (
        2, 0.5, 0.0)
    assert (rows["T"]["Mature_Customers"], rows["T"]["Repeat180_Mature"]) == (1, 1.0)
    seen = {r["Bucket"]: r for r in drill.drill_experience(people(spark)).collect()}
    assert len(seen) == 13
    assert seen[">21 days"]["Customers"] is None
    assert (seen["8-14 days"]["Repeat180"], seen["no review"]["Customers"]) == (1.0, 1)
    inst = {r["Installments"]: r["Customers"]
            for r in drill.installments_repeat(people(spark)).collect()}
    assert inst == {"1": 1, "2-3": 2}


def scored(spark, rows):
    return spark.createDataFrame(rows, "id long, label double, score double")


def brute_roc(rows):
    """Curve points kept by the usual rule: drop points in the middle of straight pieces."""
    levels = sorted({s for _, _, s in rows}, reverse=True)
    tps = [sum(y for _, y, s in rows if s >= t) for t in levels]
    fps = [sum(1 - y for _, y, s in rows if s >= t) for t in levels]
    keep = [i for i in range(len(levels))
            if i in (0, len(levels) - 1)
            or tps[i + 1] - 2 * tps[i] + tps[i - 1] or fps[i + 1] - 2 * fps[i] + fps[i - 1]]
    return [(0.0, 0.0)] + [(fps[i] / fps[-1], tps[i] / tps[-1]) for i in keep]


def test_roc_matches_brute_force(spark):
    rows = [(i, float((i * 7) % 5 == 0), float((i * 13) % 29) / 10) for i in range(150)]
    got = [(r["FPR"], r["TPR"]) for r in
           evaluate.roc_points(scored(spark, rows)).orderBy("place").collect()]
    assert got == brute_roc(rows)


def test_curves_are_thinned_to_300_points(spark):
    rows = [(i, float(i % 3 == 0), float((i * 7919) % 1009)) for i in range(1000)]
    roc = evaluate.roc_points(scored(spark, rows))
    assert roc.count() == 300
    ends = roc.orderBy("place").collect()
    assert (ends[0]["FPR"], ends[-1]["TPR"]) == (0.0, 1.0)
    gains = evaluate.cumulative_gains(scored(spark, rows)).orderBy("Selected_pct").collect()
    assert len(gains) == 300 and gains[-1]["Captured_pct"] == 100.0


def test_auc_with_ties(spark):
    same = scored(spark, [(i, float(i % 2), 0.5) for i in range(10)])
    assert evaluate.auc_exact(same).first()["auc"] == 0.5
    assert evaluate.roc_points(same).count() == 2
    rows = [(0, 0.0, 0.1), (1, 1.0, 0.4), (2, 0.0, 0.4), (3, 1.0, 0.9)]
    assert evaluate.auc_exact(scored(spark, rows)).first()["auc"] == 0.875


def test_lift_and_deciles(spark):
    rows = [(i, float(i < 10), 100.0 - i) for i in range(100)]
    lift = {r["fraction"]: r for r in evaluate.lift_at_k(scored(spark, rows)).collect()}
    assert (lift[0.1]["captured"], lift[0.1]["recall"], lift[0.1]["lift"]) == (10, 1.0, 10.0)
    assert lift[0.2]["lift"] == 5.0
    deciles = evaluate.score_deciles(scored(spark, rows)).orderBy("Decile").collect()
    assert [r["Customers"] for r in deciles] == [10] * 10
    assert [r["Lift"] for r in deciles] == [10.0] + [0.0] * 9
    ci = evaluate.lift_ci(evaluate.score_deciles(scored(spark, rows))).first()
    assert ci["Lift_Low"] == ci["Lift_High"] == 10.0


# Published confusion counts (TN, FP, FN, TP) and the metrics shown with them
# (accuracy, weighted F1, precision, recall).
CONFUSION = {
    "Logistic Regression": ((2847, 5036, 1594, 8991), (0.6410, 0.6160, 0.6410, 0.8494)),
    "Random Forest": ((2516, 5367, 1013, 9572), (0.6545, 0.6181, 0.6407, 0.9043)),
    "Gradient Boosted Trees": ((3797, 4086, 1501, 9084), (0.6975, 0.6843, 0.6897, 0.8582)),
}


@pytest.mark.parametrize("model", list(CONFUSION))
def test_confusion_metrics_of_the_published_models(spark, model):
    (tn, fp, fn, tp), want = CONFUSION[model]
    cells = ((0.0, 0.0, tn), (0.0, 1.0, fp), (1.0, 0.0, fn), (1.0, 1.0, tp))
    rows = spark.createDataFrame(cells, "label double, prediction double, n int").select(
        "label", "prediction", F.explode(F.sequence(F.lit(1), F.col("n"))))
    got = evaluate.confusion_matrix(rows).first()
    assert (got["TN"], got["FP"], got["FN"], got["TP"]) == (tn, fp, fn, tp)
    measures = (got["accuracy"], got["f1_weighted"], got["precision"], got["recall"])
    assert [round(m, 4) for m in measures] == list(want)


# Published segment sizes, revenue and orders, and the scenario rows they imply.
SEGMENTS = [("Recent Buyers", 32301, 6667012.34, 32301), ("At-Risk Buyers", 35244, 3827106.11, 35244),
            ("Lost Customers", 23007, 4029391.18, 23007), ("Repeat Buyers", 2805, 898952.14, 5925)]
SCENARIOS = {
    ("Recent Buyers", "+0.5 pp second order"): (162, 33335, 0.22, 1.03),
    ("Recent Buyers", "+1.0 pp second order"): (323, 66670, 0.43, 2.06),
    ("Recent Buyers", "+2.0 pp second order"): (646, 133340, 0.86, 4.13),
    ("At-Risk Buyers", "+0.5 pp second order"): (176, 19136, 0.12, 0.54),
    ("At-Risk Buyers", "+1.0 pp second order"): (352, 38271, 0.25, 1.09),
    ("At-Risk Buyers", "+2.0 pp second order"): (705, 76542, 0.5, 2.17),
    ("Lost Customers", "+0.5 pp second order"): (115, 20147, 0.13, 0.88),
    ("Lost Customers", "+1.0 pp second order"): (230, 40294, 0.26, 1.75),
    ("Lost Customers", "+2.0 pp second order"): (460, 80588, 0.52, 3.5),
    ("Repeat Buyers", "+5% spending"): (296, 44948, 0.29, 16.02),
    ("Repeat Buyers", "+10% spending"): (592, 89895, 0.58, 32.05),
    ("Repeat Buyers", "+20% spending"): (1185, 179790, 1.17, 64.1),
}


def economics(spark):
    return spark.createDataFrame(
        SEGMENTS, "Segment_Label string, Customers long, Revenue double, Orders long"
    ).withColumn("AOV", F.col("Revenue") / F.col("Orders"))


def test_scenarios_of_the_published_report(spark):
    got = {(r["Segment_Label"], r["Uplift"]): (r["Extra_Orders"], r["Extra_Revenue"],
                                               r["Revenue_pct"], r["Break_Even_Per_Customer"])
           for r in decide.impact_scenarios(economics(spark), Settings()).collect()}
    assert got == SCENARIOS


def test_missing_segment_has_no_scenarios(spark):
    some = economics(spark).filter("Segment_Label <> 'Lost Customers'")
    assert decide.impact_scenarios(some, Settings()).count() == 9


def test_break_even_grid(spark):
    rows = decide.break_even_grid(economics(spark), (1.0,), (0.0, 1.0), (20.0,)).filter(
        "Segment_Label = 'Recent Buyers'").orderBy("cost_per_customer").collect()
    assert rows[0]["roi_pct"] is None
    assert rows[1]["spend"] == 32301.0
    assert rows[1]["net"] == pytest.approx(66670.1234 * 0.2 - 32301)
    assert rows[1]["max_cost_per_customer"] == pytest.approx(0.01 * 206.4027 * 0.2, rel=1e-5)


def test_pareto_empty_top_set_is_zero(spark):
    df = spark.createDataFrame([(i, float(i + 1)) for i in range(10)],
                               "customer_unique_id long, Monetary double")
    rows = {r["Top_pct"]: r["Revenue_pct_1d"] for r in
            segments.pareto(df, (1, 10, 20, 50)).collect()}
    assert rows == {1: 0.0, 10: 18.2, 20: 34.5, 50: 72.7}


def test_histogram_of_a_constant(spark):
    df = spark.createDataFrame([(5.0, 1.0), (5.0, 2.0)], "a double, b double")
    rows = {(r["metric"], r["bin"]): r["customers"] for r in
            segments.histogram(df, ("a", "b"), 4).collect()}
    assert len(rows) == 8
    assert {k: n for k, n in rows.items() if n} == {("a", 0): 2, ("b", 0): 1, ("b", 3): 1}


def test_histogram_counts_nulls_beside_the_bins(spark):
    df = spark.createDataFrame([(1.0, 0.0), (None, 3.0), (9.0, 1.0)], "a double, b double")
    rows = {(r["metric"], r["bin"]): (r["customers"], r["bin_start"]) for r in segments.histogram(df, ("a", "b"), 2).collect()}
    assert rows == {("a", -1): (1, None), ("a", 0): (1, 1.0), ("a", 1): (1, 5.0), ("b", 0): (2, 0.0), ("b", 1): (1, 1.5)}


def test_rate_ci_and_weighted_rate(spark):
    df = spark.createDataFrame([("a", 0.5, 100), ("b", 0.1, 300)], "g string, r double, n long")
    rows = {x["g"]: x["ci95"] for x in drill.rate_ci95(df, "r", "n").collect()}
    assert rows["a"] == pytest.approx(0.098)
    assert drill.weighted_rate(df, "r", "n").first()[0] == 0.2
    best = drill.best_worst(df, "g", "r").first()
    assert (best["best"], best["worst"], best["ratio"]) == ("a", "b", 5.0)
