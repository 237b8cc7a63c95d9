"""Bucket expressions of the drill-down reports, and the order of their buckets."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DELIVERY_BUCKETS = ("<=7 days", "8-14 days", "15-21 days", ">21 days")
DELAY_BUCKETS = ("on time or early", "1-7 days late", ">7 days late")
REVIEW_BUCKETS = ("1 star", "2 stars", "3 stars", "4 stars", "5 stars", "no review")
INSTALLMENT_BUCKETS = ("1", "2-3", "4-6", "7-10", ">10")


def _ladder(col: Column, limits: tuple[float, ...], names: tuple[str, ...]) -> Column:
    """Name of the first limit that ``col`` does not exceed; the last name has no limit."""
    out = F.lit(names[-1])
    for limit, name in reversed(list(zip(limits, names))):
        out = F.when(col <= limit, name).otherwise(out)
    return F.when(col.isNotNull(), out)


def delivery_bucket(days: Column) -> Column:
    return _ladder(days, (7, 14, 21), DELIVERY_BUCKETS)


def delay_bucket(days: Column) -> Column:
    return _ladder(days, (0, 7), DELAY_BUCKETS)


def review_bucket(score: Column) -> Column:
    """Stars after rounding half to even; a missing score is its own bucket."""
    stars = F.bround(score, 0).cast("int")
    name = F.concat(stars.cast("string"), F.when(stars == 1, " star").otherwise(" stars"))
    return F.coalesce(name, F.lit(REVIEW_BUCKETS[-1]))


def installment_bucket(count: Column) -> Column:
    """Right-closed bins over (0, 100]; anything outside is null."""
    inside = (count > 0) & (count <= 100)
    return F.when(inside, _ladder(count, (1, 3, 6, 10), INSTALLMENT_BUCKETS))


def position_in(col: Column, names: tuple[str, ...]) -> Column:
    """1-based place of ``col`` in an ordered list of names, for ordinal sorting."""
    return F.array_position(F.array(*[F.lit(n) for n in names]), col).cast("int")
