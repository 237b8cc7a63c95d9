"""Registered queries over the star-schema test tables.

Each takes a session and a folder of Parquet files and returns a DataFrame.
Thresholds are set for that data: its customers order about four times over
several years, so the retail defaults would put them all in one segment.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from orderlens.functions.labels import segment_label
from orderlens.operators import (
    attribution, customers, decide, drill, evaluate, facts, features, models, rank, rfm, segments,
    stats)
from orderlens.plans.analysis import Analysis
from orderlens.settings import Settings
from orderlens.sources import files, replicate
from orderlens.sources.star import star_tables
from orderlens.stages import at_once, new_path, stage

Query = Callable[[SparkSession, str], DataFrame]

STAR = Settings(
    repeat_frequency=4, lost_recency=900, recent_recency=300, freight_cap=0.05,
    min_state_mature=50, min_category_mature=100, min_test_group=20)
REGIONS = ("AFRICA", "AMERICA", "ASIA", "EUROPE", "Other")
BREAK_EVEN = {"uplifts": (0.5, 1.0, 2.5), "costs": (0.0, 100.0), "margins": (20.0, 50.0)}
COPIES = 3
SAMPLE = 500
EXPERIENCE_FEATURES = ("delivery", "delay")

RANKED_FEATURES = ("item_count", "avg_review_score", "delivery_days", "max_installments")

QUERIES: dict[str, Query] = {}


def query(build: Callable[[Analysis], DataFrame]) -> Callable[[Analysis], DataFrame]:
    """Register a report of the rule-segmented analysis under its function name."""
    QUERIES[build.__name__] = lambda spark, folder: build(
        Analysis(star_tables(spark, folder), STAR))
    return build


def clustered(build: Callable[[Analysis], DataFrame]) -> Callable[[Analysis], DataFrame]:
    """Register a report of the K-Means-segmented analysis under its function name."""
    QUERIES[build.__name__] = lambda spark, folder: build(
        Analysis(star_tables(spark, folder), STAR, clusters=True))
    return build


# Orders

@query
def order_items_agg(a: Analysis) -> DataFrame:
    return facts.order_items(a.tables.items)


@query
def order_payments_agg(a: Analysis) -> DataFrame:
    return facts.order_payments(a.tables.payments)


@query
def order_reviews_agg(a: Analysis) -> DataFrame:
    return facts.order_reviews(a.tables.reviews)


@query
def order_facts(a: Analysis) -> DataFrame:
    return facts.order_facts(a.tables)


@query
def order_status(a: Analysis) -> DataFrame:
    return facts.order_status(a.tables.orders)


@query
def kpi_summary(a: Analysis) -> DataFrame:
    return facts.kpi_summary(facts.order_facts(a.tables))


@query
def monthly_trend(a: Analysis) -> DataFrame:
    return facts.monthly_trend(facts.order_facts(a.tables))


@query
def top_categories(a: Analysis) -> DataFrame:
    return facts.top_categories(a.tables)


@query
def top_categories_nonnull(a: Analysis) -> DataFrame:
    return facts.top_categories(a.tables, keep_null=False)


@query
def main_category(a: Analysis) -> DataFrame:
    return facts.main_category(a.tables)


# Recency, frequency, monetary value

@query
def rfm_table(a: Analysis) -> DataFrame:
    return a.rfm_direct


QUERIES["rfm"] = QUERIES.pop("rfm_table")


@query
def rfm_scores(a: Analysis) -> DataFrame:
    return rfm.rfm_scores(a.rfm_direct)


@query
def rfm_task(a: Analysis) -> DataFrame:
    return rfm.rfm_task_of(a.tables)


@query
def ntile_task(a: Analysis) -> DataFrame:
    return rfm.ntile_scores(a.rfm_direct)


@query
def qcut_quintiles(a: Analysis) -> DataFrame:
    return rfm.qcut_scores(a.rfm_direct)


@query
def standardize(a: Analysis) -> DataFrame:
    scaled = features.standardize(a.rfm_direct, segments.MEASURES)
    return scaled.select("customer_unique_id", *[
        F.round(F.col(f"{c}_z"), 6).alias(f"{c}_z") for c in segments.MEASURES])


@query
def rfm_histogram(a: Analysis) -> DataFrame:
    return segments.histogram(a.rfm_direct, segments.MEASURES, 40)


# First orders, labels, customer table

def _rounded(table: DataFrame) -> DataFrame:
    return table.withColumn("log_order_value", F.round("log_order_value", 9))


@query
def first_order(a: Analysis) -> DataFrame:
    return customers.first_orders(facts.order_facts(a.tables)).select(
        "customer_unique_id", "order_id", "order_purchase_timestamp", "next_ts")


@query
def days_to_second(a: Analysis) -> DataFrame:
    return customers.days_to_second(customers.first_orders(facts.order_facts(a.tables)))


@query
def first_order_features(a: Analysis) -> DataFrame:
    return _rounded(a.features)


@query
def churn_features(a: Analysis) -> DataFrame:
    return _rounded(customers.churn_features(a.labelled, a.features))


@query
def churn_label(a: Analysis) -> DataFrame:
    return customers.with_churn(a.rfm_direct, STAR).select("customer_unique_id", "churn")


@query
def churn_summary(a: Analysis) -> DataFrame:
    return customers.churn_summary(customers.with_churn(a.rfm_direct, STAR))


@query
def repeat_label(a: Analysis) -> DataFrame:
    return customers.with_repeat(a.features, a.facts, STAR).select(
        "customer_unique_id", "first_day", "days_to_second", "mature", "repeat_180")


@query
def customer_table(a: Analysis) -> DataFrame:
    return _rounded(a.customers)


@query
def overall_rates(a: Analysis) -> DataFrame:
    return customers.overall_rates(a.model_table)


@query
def class_weights(a: Analysis) -> DataFrame:
    return customers.class_weights(a.mature, "repeat_180")


@query
def impute_median(a: Analysis) -> DataFrame:
    filled = features.impute_median(
        a.features, customers.IMPUTED_FEATURES, "customer_unique_id")
    return filled.select("customer_unique_id", *customers.IMPUTED_FEATURES)


@query
def region_dummies(a: Analysis) -> DataFrame:
    return features.dummies(a.features.select("customer_unique_id", "region"), "region", REGIONS)


# Segments and value

@query
def segmented_scores(a: Analysis) -> DataFrame:
    return a.segmented_scores


@query
def segment_value(a: Analysis) -> DataFrame:
    values = segments.segment_value(a.segment(a.rfm_direct), STAR)
    return values.withColumns({c: F.round(c, 6) for c in ("P25", "Median", "P75", "P95")})


@query
def segment_value_approx(a: Analysis) -> DataFrame:
    return segments.segment_value_approx(a.segment(a.rfm_direct), STAR)


@query
def segment_share_long(a: Analysis) -> DataFrame:
    return segments.segment_share_long(segments.segment_value(a.segment(a.rfm_direct), STAR))


@query
def segment_economics(a: Analysis) -> DataFrame:
    return decide.segment_economics(a.segment(a.rfm_direct))


@query
def pareto(a: Analysis) -> DataFrame:
    return segments.pareto(a.rfm_direct, STAR.pareto_points)


# Drill-downs and tests

@query
def drill_state(a: Analysis) -> DataFrame:
    return drill.group_table(a.customers, "customer_state")


@query
def drill_state_top(a: Analysis) -> DataFrame:
    return drill.busiest(drill.group_table(a.customers, "customer_state"), "customer_state", 10)


@query
def drill_category(a: Analysis) -> DataFrame:
    return drill.large_groups(
        drill.group_table(a.customers, "category"), STAR.min_category_mature)


@query
def best_worst_category(a: Analysis) -> DataFrame:
    table = drill.large_groups(
        drill.group_table(a.customers, "category"), STAR.min_category_mature)
    return drill.best_worst(table, "category", "Repeat180_Mature")


@query
def drill_delivery(a: Analysis) -> DataFrame:
    return drill.drill_experience(a.customers)


@query
def installments_repeat(a: Analysis) -> DataFrame:
    return drill.installments_repeat(a.customers)


def _rounded_test(tests: DataFrame) -> DataFrame:
    return tests.withColumns({c: F.round(c, 8) for c in ("Chi2", "p_value", "Cramers_V")})


@query
def installments_test(a: Analysis) -> DataFrame:
    return _rounded_test(stats.installments_test(a.customers))


@query
def association_tests(a: Analysis) -> DataFrame:
    return _rounded_test(stats.association_tests(a.customers, STAR.min_test_group))


@query
def significant_dimensions(a: Analysis) -> DataFrame:
    tests = stats.association_tests(a.customers, STAR.min_test_group)
    return stats.significant(_rounded_test(tests))


def _large_states(a: Analysis) -> DataFrame:
    return drill.large_groups(
        drill.group_table(a.customers, "customer_state"), STAR.min_state_mature)


@query
def spearman_state(a: Analysis) -> DataFrame:
    found = stats.spearman(_large_states(a), "Avg_Delivery_Days", "Repeat180_Mature",
                           "customer_state")
    return found.withColumn("rho", F.round("rho", 9))


@query
def spearman_label_check(a: Analysis) -> DataFrame:
    found = stats.spearman(_large_states(a), "Churn_Rate", "Repeat180_Mature", "customer_state", True)
    return found.withColumn("rho", F.round("rho", 9))


@query
def spearman_category_check(a: Analysis) -> DataFrame:
    table = drill.large_groups(drill.group_table(a.customers, "category"), STAR.min_category_mature)
    found = stats.spearman(table, "Churn_Rate", "Repeat180_Mature", "category", True)
    return found.withColumn("rho", F.round("rho", 9))


def _rounded_ci(table: DataFrame, *names: str) -> DataFrame:
    return table.select(*names, *[F.round(c, 9).alias(c) for c in ("ci95", "ci95_low", "ci95_high")])


@query
def category_ci95(a: Analysis) -> DataFrame:
    table = drill.rate_ci95(drill.group_table(a.customers, "category"), "Repeat180_Mature", "Mature_Customers")
    return _rounded_ci(table, "category", "Repeat180_Mature", "Mature_Customers")


@query
def experience_ci95(a: Analysis) -> DataFrame:
    table = drill.rate_ci95(drill.drill_experience(a.customers), "Repeat180", "Customers")
    return _rounded_ci(table, "Dimension", "Bucket", "Repeat180", "Customers")


@query
def rate_ci95(a: Analysis) -> DataFrame:
    table = drill.rate_ci95(drill.group_table(a.customers, "customer_state"),
                            "Repeat180_Mature", "Mature_Customers")
    return table.select("customer_state", "Repeat180_Mature", "Mature_Customers", *[
        F.round(c, 9).alias(c) for c in ("ci95", "ci95_low", "ci95_high")])


@query
def weighted_rate(a: Analysis) -> DataFrame:
    return drill.weighted_rate(drill.drill_experience(a.customers), "Repeat180", "Customers")


# Reconciliation and decisions

@query
def consistency_checks(a: Analysis) -> DataFrame:
    return decide.consistency_checks(
        a.facts, a.tables.items, a.segmented, a.customers, STAR)


@query
def check_summary(a: Analysis) -> DataFrame:
    return decide.check_summary(decide.consistency_checks(
        a.facts, a.tables.items, a.segmented, a.customers, STAR))


@query
def items_revenue_check(a: Analysis) -> DataFrame:
    return decide.items_revenue_check(a.tables.items, a.facts, STAR)


@query
def impact_scenarios(a: Analysis) -> DataFrame:
    economics = decide.segment_economics(a.segment(a.rfm_direct))
    return decide.impact_scenarios(economics, STAR)


@query
def break_even_grid(a: Analysis) -> DataFrame:
    economics = decide.segment_economics(a.segment(a.rfm_direct))
    return decide.break_even_grid(economics, **BREAK_EVEN)


@query
def action_evidence(a: Analysis) -> DataFrame:
    economics = decide.segment_economics(a.segmented)
    category_rates = drill.large_groups(
        drill.group_table(a.customers, "category"), STAR.min_category_mature)
    return decide.action_evidence(
        economics, decide.impact_scenarios(economics, STAR), category_rates,
        customers.overall_rates(a.customers), drill.installments_repeat(a.customers),
        stats.installments_test(a.customers), drill.drill_experience(a.customers),
        stats.association_tests(a.customers, STAR.min_test_group))


# Evaluation of scores

@query
def confusion_matrix(a: Analysis) -> DataFrame:
    predicted = evaluate.with_threshold(a.scored, evaluate.median_score(a.scored))
    return evaluate.confusion_matrix(predicted)


@query
def auc_exact(a: Analysis) -> DataFrame:
    return evaluate.auc_exact(a.scored)


@query
def pr_auc(a: Analysis) -> DataFrame:
    return evaluate.pr_auc(a.scored).withColumn("pr_auc", F.round("pr_auc", 9))


@query
def roc_points(a: Analysis) -> DataFrame:
    return evaluate.roc_points(a.scored)


@query
def lift_at_k(a: Analysis) -> DataFrame:
    return evaluate.lift_at_k(a.scored)


@query
def score_deciles(a: Analysis) -> DataFrame:
    return evaluate.score_deciles(a.scored)


@query
def lift_ci(a: Analysis) -> DataFrame:
    found = evaluate.lift_ci(evaluate.score_deciles(a.scored))
    return found.withColumns({c: F.round(c, 9) for c in ("Lift_Low", "Lift_High")})


@query
def cumulative_gains(a: Analysis) -> DataFrame:
    return evaluate.cumulative_gains(a.scored)


@query
def value_pct_rank(a: Analysis) -> DataFrame:
    long = a.features.unpivot(
        ["customer_unique_id"], list(RANKED_FEATURES), "Feature", "Value")
    return evaluate.value_pct_rank(long, "Feature", "Value", "customer_unique_id")


@query
def importance_share(a: Analysis) -> DataFrame:
    table = drill.drill_experience(a.customers).select(
        F.col("Dimension").alias("Feature"), F.col("Repeat180").alias("Mean_Abs"))
    share = attribution.importance_share(table, EXPERIENCE_FEATURES)
    return share.select(*[F.round(c, 9).alias(c) for c in share.columns])


@query
def metrics_long(a: Analysis) -> DataFrame:
    predicted = evaluate.with_threshold(a.scored, evaluate.median_score(a.scored))
    wide = evaluate.confusion_matrix(predicted).withColumn("Model", F.lit("median rule"))
    names = ["accuracy", "precision", "recall", "f1_weighted"]
    return wide.unpivot(["Model"], names, "Metric", "Score")


# Sources, sinks, sampling

@query
def hash_split(a: Analysis) -> DataFrame:
    return features.with_split(
        a.rfm_direct.select("customer_unique_id"), "customer_unique_id", STAR.seed,
        STAR.train_share)


@query
def stratified_split(a: Analysis) -> DataFrame:
    labelled = customers.with_churn(a.rfm_direct, STAR).select("customer_unique_id", "churn")
    return features.with_stratified_split(
        labelled, "customer_unique_id", "churn", STAR.seed, STAR.train_share)


@query
def seeded_sample(a: Analysis) -> DataFrame:
    return features.seeded_sample(a.rfm_direct, "customer_unique_id", STAR.seed, SAMPLE)


@query
def replicate_scale(a: Analysis) -> DataFrame:
    copies = replicate.replicate(a.tables.orders, COPIES, ["order_id", "customer_id"])
    label = F.lit(f"×{COPIES}")
    return copies.select("order_id", "customer_id", "order_status", label.alias("scale")
                         ).withColumn("scale_n", replicate.scale_factor("scale"))


@query
def csv_roundtrip(a: Analysis) -> DataFrame:
    table = facts.order_facts(a.tables)
    path = new_path(table.sparkSession, "facts-csv")
    files.write_csv(table, path)
    return files.read_csv(table.sparkSession, path, table.schema, "yyyy-MM-dd'T'HH:mm:ss.SSS").select(
        "order_id", "customer_unique_id", "order_purchase_timestamp", "payment_value",
        "avg_review_score")


@query
def stage_parquet(a: Analysis) -> DataFrame:
    table = facts.order_facts(a.tables)
    path = new_path(table.sparkSession, "facts-parquet")
    files.write_parquet(table, path)
    return files.load_if_present(table.sparkSession, path)


# K-Means, models, attribution

@query
def kmeans_selection(a: Analysis) -> DataFrame:
    return segments.kmeans_selection(a.rfm_direct, STAR)


@query
def kmeans_segments(a: Analysis) -> DataFrame:
    return segments.kmeans_segments(a.rfm_direct, STAR)


@clustered
def segment_assign(a: Analysis) -> DataFrame:
    return a.segment(a.rfm_direct)


@query
def segment_profile(a: Analysis) -> DataFrame:
    return segments.segment_profile(segments.kmeans_segments(a.rfm_direct, STAR), STAR)


@query
def churn_model(a: Analysis) -> DataFrame:
    return models.churn_metrics(a.model_table, STAR)


@query
def repeat_model(a: Analysis) -> DataFrame:
    return models.repeat_metrics(a.mature, STAR)


@query
def model_compare(a: Analysis) -> DataFrame:
    metrics = models.churn_metrics(a.model_table, STAR)
    return evaluate.best_by(metrics, "Model", "AUC_ROC")


@query
def churn_curves(a: Analysis) -> DataFrame:
    return models.all_curves(models.churn_predictions(a.model_table, STAR, models.model_curves))


@query
def repeat_curves(a: Analysis) -> DataFrame:
    return models.all_curves(models.repeat_predictions(a.mature, STAR, models.model_curves))


@query
def repeat_deciles(a: Analysis) -> DataFrame:
    return models.deciles_of_best(models.repeat_predictions(a.mature, STAR, models.with_area))


@query
def score_customers(a: Analysis) -> DataFrame:
    return models.score_customers(a.model_table, STAR)


@query
def feature_attribution(a: Analysis) -> DataFrame:
    values, _ = attribution.feature_attribution(a.mature, REGIONS, STAR)
    return attribution.mean_absolute(values, attribution.feature_names(REGIONS))


@query
def attribution_values(a: Analysis) -> DataFrame:
    values, _ = attribution.feature_attribution(a.mature, REGIONS, STAR)
    return attribution.top_values(values, attribution.feature_names(REGIONS))


# What can be said of the fitted results in SQL: certificates that turn false when a result is wrong

def rank_auc(scored: DataFrame) -> float:
    """Area under the ROC curve from the mean ranks of the positive rows."""
    ranks = rank.average_rank(scored.select("id", "label", "score"), "score", "id")
    p, n = F.count_if(F.col("label") == 1), F.count_if(F.col("label") == 0)
    total = F.sum(F.when(F.col("label") == 1, F.col("avg_rank")))
    return ranks.agg(F.try_divide(total - p * (p + 1) / 2, (p * n).cast("double")).alias("auc")).first()["auc"] or 0.0


def areas_agree(metrics: DataFrame, scores: dict[str, DataFrame]) -> F.Column:
    """Is a model's area the one that the ranks of its scores give (the evaluator bins scores)?"""
    found = at_once(metrics.sparkSession, rank_auc, scores.values())
    areas = F.create_map(*[F.lit(x) for pair in zip(scores, found) for x in pair])
    return F.abs(metrics["AUC_ROC"] - areas[metrics["Model"]]) < 2e-3


@query
def churn_model_check(a: Analysis) -> DataFrame:
    """Per model: test rows and positives by its confusion counts; measures follow from counts and ranks."""
    m = models.classification_metrics(a.churn_predictions)
    n = F.col("TN") + F.col("FP") + F.col("FN") + F.col("TP")
    agrees = F.abs(F.col("Accuracy") - (F.col("TN") + F.col("TP")) / n) < 1e-9
    return m.select("Model", n.alias("test_rows"), (F.col("FN") + F.col("TP")).alias("positives"),
                    (agrees & areas_agree(m, a.churn_predictions) & F.col("PR_AUC").between(0, 1)).alias("agrees"))


@query
def repeat_model_check(a: Analysis) -> DataFrame:
    m = models.ranking_metrics(a.repeat_predictions)
    lift = F.abs(F.col("Recall_top20") / 0.2 - F.col("Lift_top20")) < 1e-9
    return m.select("Model", F.round("Base_rate", 9).alias("base_rate"),
                    (lift & areas_agree(m, a.repeat_predictions)).alias("agrees"))


@query
def best_model_check(a: Analysis) -> DataFrame:
    """The scores of the test rows are those of the model with the largest area by ranks."""
    scores = a.churn_predictions
    areas = dict(zip(scores, at_once(a.model_table.sparkSession, rank_auc, scores.values())))
    best = scores[max(sorted(areas), key=areas.get)].select(F.col("id").alias("customer_unique_id"), "score")
    table = models.score_table(a.model_table, STAR, scores).join(best, "customer_unique_id")
    same = F.abs(F.col("churn_prob") - F.col("score")) < 1e-12
    return table.select("customer_unique_id", "churn", (
        same & ((F.col("prediction") == 1) == (F.col("churn_prob") > 0.5))).alias("agrees"))


@query
def logistic_check(a: Analysis) -> DataFrame:
    """The logistic models stand at their optimum: the gradient over the training rows is zero."""
    found = [models.logistic_certificate(table, label, STAR, weighted).withColumn("label", F.lit(label))
             for table, label, weighted in ((a.model_table, "churn", False), (a.mature, "repeat_180", True))]
    return found[0].unionByName(found[1]).select("label", "entries", (F.col("gradient") < 1e-3).alias("optimal"))


@query
def tree_check(a: Analysis) -> DataFrame:
    """Walking a model's nodes gives its scores, and its leaves are what their training rows say."""
    kinds = ((a.model_table, "churn", False, STAR.boosted_depth_churn), (a.mature, "repeat_180", True, STAR.boosted_depth_repeat))
    # Boosted trees grow in many short jobs that leave cores idle: both labels are trained beside each other.
    found = at_once(a.model_table.sparkSession, lambda kind: models.tree_certificates(
        kind[0], kind[1], STAR, *kind[2:]).withColumn("label", F.lit(kind[1])), kinds)
    return found[0].unionByName(found[1]).select(
        "label", "Model", "trees", "test_rows", (F.col("score_gap") < 1e-9).alias("scores_agree"),
        (F.col("leaf_gap") < 1e-9).alias("leaves_agree"))


@query
def model_inputs(a: Analysis) -> DataFrame:
    """The preparation fitted on the training rows: median and deviation of every input."""
    return models.fitted_inputs(a.model_table, STAR).select(
        "input", F.round("median", 9).alias("median"), F.round("spread", 6).alias("spread"))


@query
def curve_check(a: Analysis) -> DataFrame:
    """Every curve begins and ends where it must and never falls."""
    points = models.all_curves(models.repeat_predictions(a.mature, STAR, models.model_curves))
    whole = F.when(F.col("Curve") == "ROC", 1.0).otherwise(100.0)
    along = W.partitionBy("Model", "Curve").orderBy("X", "Y")
    falls = F.coalesce(F.col("Y") < F.lag("Y").over(along), F.lit(False))
    return (points.withColumns({"falls": falls, "top": whole}).groupBy("Model", "Curve").agg(
        (~F.bool_or("falls") & (F.max("X") == F.max("top")) & (F.max("Y") == F.max("top"))
         & (F.min("Y") >= 0)).alias("agrees")))


@query
def decile_check(a: Analysis) -> DataFrame:
    scores = a.repeat_predictions
    table = models.best_deciles(scores)
    return table.select("Decile", "Customers", F.round("Base_Rate", 9).alias("Base_Rate"))


def cluster_proof(wide: DataFrame, centres: list[list[float]], cost: float, profile: DataFrame) -> DataFrame:
    """One row: do assignment, cost, means and names follow from the centres and the members?

    ``wide`` has ``segment``, the measures and their scaled form; the means and names of ``profile`` are
    derived again from the clusters' moments. ``cost``, which the fit reports, is that of the step before
    the last, so the assignment's own cost lies between it and the cost about the members' means.
    """
    n = F.col("n")
    means = [F.col("sums")[i] / n for i in range(len(segments.MEASURES))]
    again = segments.cluster_moments(wide, segments.MEASURES).select(
        "segment", "n", F.array(*means).alias("means"), segment_label(means[1], means[0], STAR).alias("name"))
    near = [F.abs(F.col(f"Avg_{m}") - F.col("means")[i]) <= 1e-6 * (1 + F.abs(F.col("means")[i]))
            for i, m in enumerate(segments.MEASURES)]
    same = profile.join(again, "segment", "full").select(
        F.coalesce((F.col("Count") == n) & near[0] & near[1] & near[2], F.lit(False)).alias("means"),
        F.col("Segment_Label").eqNullSafe(F.col("name")).alias("names")).agg(
        F.struct(F.bool_and("means").alias("means"), F.bool_and("names").alias("names"))).scalar()
    scaled = segments.cluster_moments(wide, tuple(f"{m}_z" for m in segments.MEASURES))
    square = F.aggregate("sums", F.lit(0.0), lambda total, s: total + s * s)
    least = scaled.agg(F.sum(F.col("squares") - square / n)).scalar()
    return segments.certificate(wide, centres).select(
        "customers", (F.col("misplaced") == 0).alias("nearest"),
        ((F.col("cost") <= cost * (1 + 1e-9)) & (F.col("cost") >= least * (1 - 1e-9))).alias("cost_agrees"),
        same["means"].alias("means_agree"), same["names"].alias("names_agree"))


@query
def cluster_check(a: Analysis) -> DataFrame:
    """Clusters hold every customer once, at a nearest centre; profiles and names follow from the members."""
    found, centres, cost = segments.kmeans_fit(a.rfm_direct, STAR)
    wide = stage(found, "clusters")
    profile = segments.segment_profile(wide, STAR)
    named = segments.name_segments(wide, profile)
    falls = segments.kmeans_selection(a.rfm_direct, STAR).agg(
        (F.max_by("WSSSE", -F.col("k")) > F.max_by("WSSSE", "k")).alias("falls")).scalar()
    return cluster_proof(wide, centres, cost, profile).withColumns({
        "clusters": profile.agg(F.count(F.lit(1))).scalar(),
        "shares_add_up": profile.agg(F.abs(F.sum("Share_pct") - 100) < 0.3).scalar(),
        "named": named.agg(F.count(F.lit(1))).scalar(), "cost_falls": falls})


@query
def silhouette_check(a: Analysis) -> DataFrame:
    """The silhouettes from cluster moments are the evaluator's."""
    return segments.silhouette_selection(a.rfm_direct, STAR).select(
        "k", (F.abs(F.col("evaluator") - F.col("moments")) < 1e-9).alias("agrees"))


@query
def approx_check(a: Analysis) -> DataFrame:
    """Sketched percentiles within a thousandth of the rank of the exact ones."""
    customers_of = a.segment(a.rfm_direct).select("Segment_Label", "Monetary")
    sketch = segments.segment_value_approx(a.segment(a.rfm_direct), STAR)
    names = {segments.QUANTILE_NAMES[q]: q for q in STAR.quantiles}
    rows = customers_of.join(F.broadcast(sketch.select("Segment_Label", *names)), "Segment_Label")
    n = F.count(F.lit(1))
    return rows.groupBy("Segment_Label").agg(n.alias("Customers"), *[
        ((F.count_if(F.col("Monetary") <= F.col(p)) >= q * n - n / 1000 - 1)
         & (F.count_if(F.col("Monetary") < F.col(p)) <= q * n + n / 1000 + 1)).alias(f"{p}_near")
        for p, q in names.items()])


@query
def attribution_check(a: Analysis) -> DataFrame:
    """One row a held-out customer; base and attributions add up to the forest's own probability."""
    values, _ = attribution.feature_attribution(a.mature, REGIONS, STAR)
    gap = attribution.sum_gap(values, attribution.feature_names(REGIONS))
    return values.select("customer_unique_id", (gap < 1e-9).alias("adds_up"))


@query
def importance_check(a: Analysis) -> DataFrame:
    """Mean absolute attributions of the long rows and of the wide table are the same, feature by feature."""
    values, _ = attribution.feature_attribution(a.mature, REGIONS, STAR)
    names = attribution.feature_names(REGIONS)
    wide = attribution.mean_absolute_wide(values, names).withColumnRenamed("Mean_Abs", "wide")
    return attribution.mean_absolute(values, names).join(wide, "Feature").select(
        "Feature", (F.abs(F.col("Mean_Abs") - F.col("wide")) < 1e-12).alias("agrees"))
