"""The whole analysis as one batch: from the seven CSV tables to a folder of result tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from orderlens import stages
from orderlens.operators import (
    attribution, customers, decide, drill, facts, models, segments, stats)
from orderlens.plans.analysis import Analysis
from orderlens.settings import Settings
from orderlens.sources.files import read_order_tables, write_csv, write_parquet

Report = Callable[[Analysis], DataFrame]


def _states(a: Analysis) -> DataFrame:
    return drill.group_table(a.customers, "customer_state")


def _categories(a: Analysis) -> DataFrame:
    return drill.large_groups(drill.group_table(a.customers, "category"), a.settings.min_category_mature)


def _tests(a: Analysis) -> DataFrame:
    return stats.association_tests(a.customers, a.settings.min_test_group)


def _actions(a: Analysis) -> DataFrame:
    economics = decide.segment_economics(a.segmented)
    return decide.action_evidence(
        economics, decide.impact_scenarios(economics, a.settings), _categories(a),
        customers.overall_rates(a.customers), drill.installments_repeat(a.customers),
        stats.installments_test(a.customers), drill.drill_experience(a.customers), _tests(a))


def _label_check(a: Analysis) -> DataFrame:
    """Rank correlation of raw churn with missing repurchase, by state and by category."""
    large = drill.large_groups(_states(a), a.settings.min_state_mature)
    return stats.spearman(large, "Churn_Rate", "Repeat180_Mature", "customer_state", True).unionByName(
        stats.spearman(_categories(a), "Churn_Rate", "Repeat180_Mature", "category", True))


def _importance(a: Analysis) -> DataFrame:
    return attribution.mean_absolute(a.attributions, attribution.feature_names(a.regions))


def _attribution_rows(a: Analysis) -> DataFrame:
    return attribution.top_values(a.attributions, attribution.feature_names(a.regions))


def _break_even(a: Analysis) -> DataFrame:
    uplifts = tuple(100 * u for u in a.settings.uplift_points)
    return decide.break_even_grid(decide.segment_economics(a.segmented), uplifts=uplifts, costs=BREAK_EVEN_COSTS,
                                  margins=BREAK_EVEN_MARGINS)


# Campaign costs and margins in percent of the break-even report.
BREAK_EVEN_COSTS, BREAK_EVEN_MARGINS = (0.0, 1_000.0, 10_000.0), (10.0, 20.0, 40.0)

# Short reports, one file each.
REPORTS: dict[str, Report] = {
    "order_status": lambda a: facts.order_status(a.tables.orders),
    "kpi_summary": lambda a: facts.kpi_summary(a.facts),
    "monthly_trend": lambda a: facts.monthly_trend(a.facts),
    "top_categories": lambda a: facts.top_categories(a.tables),
    "kmeans_selection": lambda a: segments.kmeans_selection(a.rfm, a.settings),
    "segment_value": lambda a: segments.segment_value(a.segmented, a.settings),
    "segment_profile": lambda a: segments.segment_profile(a.clustered, a.settings),
    "segment_shares": lambda a: segments.segment_share_long(segments.segment_value(a.segmented, a.settings)),
    "pareto": lambda a: segments.pareto(a.rfm, a.settings.pareto_points),
    "rfm_histogram": lambda a: segments.histogram(a.rfm, segments.MEASURES, 40),
    "churn_summary": lambda a: customers.churn_summary(a.labelled),
    "churn_models": lambda a: models.classification_metrics(a.churn_predictions),
    "churn_curves": lambda a: models.curves(a.churn_predictions),
    "repeat_models": lambda a: models.ranking_metrics(a.repeat_predictions),
    "repeat_curves": lambda a: models.curves(a.repeat_predictions),
    "repeat_deciles": lambda a: models.best_deciles(a.repeat_predictions),
    "feature_importance": _importance,
    "states": _states,
    "categories": _categories,
    "state_intervals": lambda a: drill.rate_ci95(_states(a), "Repeat180_Mature", "Mature_Customers"),
    "category_intervals": lambda a: drill.rate_ci95(_categories(a), "Repeat180_Mature", "Mature_Customers"),
    "experience": lambda a: drill.drill_experience(a.customers),
    "experience_intervals": lambda a: drill.rate_ci95(drill.drill_experience(a.customers), "Repeat180", "Customers"),
    "instalments": lambda a: drill.installments_repeat(a.customers),
    "association_tests": _tests,
    "significant_dimensions": lambda a: stats.significant(_tests(a)),
    "label_check": _label_check,
    "overall_rates": lambda a: customers.overall_rates(a.customers),
    "consistency_checks": lambda a: decide.consistency_checks(
        a.facts, a.tables.items, a.segmented, a.customers, a.settings),
    "impact_scenarios": lambda a: decide.impact_scenarios(decide.segment_economics(a.segmented), a.settings),
    "break_even": _break_even,
    "actions": _actions,
}
# Tables with a row per order or customer, as Parquet.
TABLES: dict[str, Report] = {
    "order_facts": lambda a: a.facts,
    "segmented_customers": lambda a: a.segmented_scores,
    "customer_table": lambda a: a.customers,
    "churn_scores": lambda a: models.score_table(a.model_table, a.settings, a.churn_predictions),
    "attribution_rows": _attribution_rows,
}


def run_reports(
    spark: SparkSession, paths: dict[str, str], out: str, settings: Settings | None = None,
    clusters: bool = True, only: tuple[str, ...] = (),
) -> list[str]:
    """Read the CSV tables in ``paths`` and write every report (or ``only`` some) below ``out``."""
    written = []
    # What the run stages on the way goes at its end.
    with stages.scope(spark):
        a = Analysis(read_order_tables(spark, paths), settings or Settings(), clusters)
        for name, build in (REPORTS | TABLES).items():
            if only and name not in only:
                continue
            if name in TABLES:
                write_parquet(build(a), f"{out}/{name}")
            else:
                write_csv(build(a), f"{out}/{name}", single_file=True)
            written.append(name)
    return written
