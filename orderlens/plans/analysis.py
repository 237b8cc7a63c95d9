"""The steps of the analysis wired together over one dataset.

Every shared table is computed once, when first asked for, and kept as a stage
table; the reports read those.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.operators import attribution, customers, facts, models, rfm, segments
from orderlens.settings import Settings
from orderlens.sources.contracts import OrderTables
from orderlens.stages import stage


class Analysis:
    """``clusters=True`` names customers by K-Means cluster, else by rules on their own RFM."""

    def __init__(self, tables: OrderTables, settings: Settings, clusters: bool = False):
        self.tables = tables
        self.settings = settings
        self.clusters = clusters

    @cached_property
    def facts(self) -> DataFrame:
        return stage(facts.order_facts(self.tables, early=True), "facts")

    @cached_property
    def rfm(self) -> DataFrame:
        return rfm.rfm(self.facts)

    @cached_property
    def rfm_direct(self) -> DataFrame:
        """RFM without staging the facts, for reports that need nothing else."""
        return rfm.rfm(facts.order_facts(self.tables))

    @cached_property
    def segmented(self) -> DataFrame:
        return self.segment(self.rfm)

    def segment(self, table: DataFrame) -> DataFrame:
        if not self.clusters:
            return customers.with_rule_segment(table, self.settings)
        clustered = self.clustered if table is self.rfm else stage(segments.kmeans_segments(table, self.settings), "clusters")
        profile = segments.segment_profile(clustered, self.settings)
        return segments.name_segments(clustered, profile)

    @cached_property
    def clustered(self) -> DataFrame:
        """RFM with K-Means cluster numbers."""
        return stage(segments.kmeans_segments(self.rfm, self.settings), "clusters")

    @cached_property
    def segmented_scores(self) -> DataFrame:
        """Segmented customers with their R, F and M scores and the sum of the scores."""
        return self.segment(rfm.rfm_scores(self.rfm))

    @cached_property
    def features(self) -> DataFrame:
        """First orders with their features: the one window over the facts, staged for all that reads them."""
        return stage(customers.first_order_features(self.facts, self.tables.regions, self.settings), "first-orders")

    @cached_property
    def labelled(self) -> DataFrame:
        return customers.with_churn(self.rfm, self.settings)

    @cached_property
    def model_table(self) -> DataFrame:
        """Segmented customers with churn label, repurchase label and features."""
        joined = customers.churn_features(
            customers.with_churn(self.segmented, self.settings), self.features)
        return customers.with_repeat(joined, self.facts, self.settings)

    @cached_property
    def mature(self) -> DataFrame:
        return self.model_table.filter("mature")

    @cached_property
    def churn_predictions(self) -> dict[str, DataFrame]:
        """Test scores of every churn classifier: each is fitted once for all reports that read them."""
        return models.churn_predictions(self.model_table, self.settings)

    @cached_property
    def repeat_predictions(self) -> dict[str, DataFrame]:
        """Test scores of every repurchase classifier, as ``churn_predictions``."""
        return models.repeat_predictions(self.mature, self.settings)

    @cached_property
    def regions(self) -> tuple[str, ...]:
        return tuple(sorted(r[0] for r in self.features.select("region").distinct().toLocalIterator()))

    @cached_property
    def attributions(self) -> DataFrame:
        """Attribution rows of all held-out customers, over the regions of the data."""
        return attribution.feature_attribution(self.mature, self.regions, self.settings)[0]

    @cached_property
    def customers(self) -> DataFrame:
        return stage(customers.customer_table(
            self.segmented, self.features, facts.main_category(self.tables, orders=self.features), self.facts,
            self.settings), "customers")

    @cached_property
    def scored(self) -> DataFrame:
        """Observed customers with a fixed score built from first-order features."""
        labelled = customers.with_repeat(self.features, self.facts, self.settings)
        points = (F.col("item_count") * 1000 + F.col("max_installments") * 100
                  + F.coalesce("delivery_days", F.lit(0.0)))
        return stage(labelled.filter("mature").select(
            F.col("customer_unique_id").alias("id"), F.col("repeat_180").alias("label"),
            (points / 10000.0).alias("score")), "scored")
