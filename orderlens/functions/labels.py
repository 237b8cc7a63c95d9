"""Outcome labels and rule-based segment names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from orderlens.settings import Settings

RECENT, AT_RISK, LOST, REPEAT = (
    "Recent Buyers", "At-Risk Buyers", "Lost Customers", "Repeat Buyers")
SEGMENT_ORDER = (RECENT, AT_RISK, LOST, REPEAT)


def churn_label(frequency: Column, recency: Column, days: int) -> Column:
    """1.0 for customers with one order who have been away for more than ``days``."""
    return F.when((frequency == 1) & (recency > days), 1.0).otherwise(0.0)


def repeat_label(days_to_second: Column, days: int) -> Column:
    """1.0 when a second order came within ``days``; no second order counts as 0.0."""
    return F.when(days_to_second <= days, 1.0).otherwise(0.0)


def segment_label(frequency: Column, recency: Column, settings: Settings) -> Column:
    """Segment name; the first matching rule wins."""
    return (F.when(frequency > settings.repeat_frequency, REPEAT)
            .when(recency > settings.lost_recency, LOST)
            .when(recency < settings.recent_recency, RECENT)
            .otherwise(AT_RISK))


def effect_size(v: Column) -> Column:
    """Strength of association from Cramér's V; null where there was no test."""
    return F.when(v < 0.1, "weak").when(v < 0.3, "medium").when(v >= 0.3, "strong")
