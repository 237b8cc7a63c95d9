"""Association tests and rank correlation on grouped counts."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from orderlens.functions.buckets import installment_bucket
from orderlens.functions.labels import effect_size
from orderlens.operators.drill import experience_columns, long_groups, observed
from orderlens.operators.rank import average_rank


# From this parameter on, Stirling's series for log-gamma is exact to double precision.
STIRLING_FROM = 20.0


def _log_front(a: Column, x: Column, dof: Column) -> Column:
    """log(x^a e^-x / gamma(a)). For large a the big terms cancel on paper, not in floating point."""
    lone = F.when(dof % 2 == 1, 0.5 * math.log(math.pi)).otherwise(0.0)
    below = F.floor((F.least(dof, F.lit(int(2 * STIRLING_FROM))) - 1) / 2).cast("int")
    log_gamma = F.aggregate(F.sequence(F.lit(1), F.greatest(below, F.lit(1))), lone,
                            lambda s, i: s + F.when(i <= below, F.ln(a - i)).otherwise(0.0))
    tail = 1 / (12 * a) - 1 / (360 * a * a * a) + 1 / (1260 * a * a * a * a * a)
    large = (a * F.log1p((x - a) / a) - (x - a) + 0.5 * F.ln(a) - 0.5 * math.log(2 * math.pi) - tail)
    return F.when(a < STIRLING_FROM, a * F.ln(x) - x - log_gamma).otherwise(large)


def chi2_p_value(chi2: Column, dof: Column) -> Column:
    """P(X > chi2) for a chi-square variable: the regularized upper incomplete gamma Q(a, x).

    A series serves small x and a continued fraction, evaluated from its far
    end, large x; each keeps its relative precision on its side. The number of
    terms grows with the square root of a, as their convergence needs.
    """
    a, x = dof / 2.0, chi2 / 2.0
    log_front = _log_front(a, x, dof)
    steps = F.ceil(10 * F.sqrt(F.greatest(a, F.lit(0.5))) + 200).cast("int")
    series = F.aggregate(
        F.sequence(F.lit(1), steps),
        F.struct((1 / a).alias("term"), (1 / a).alias("sum")),
        lambda s, i: F.struct((s["term"] * x / (a + i)).alias("term"),
                              (s["sum"] + s["term"] * x / (a + i)).alias("sum")),
        lambda s: s["sum"])
    fraction = F.aggregate(
        F.sequence(steps, F.lit(1)), x + (2 * steps + 1) - a,
        lambda f, i: x + 2 * i - 1 - a - i * (i - a) / f)
    tail = F.when(x < a + 1, 1 - F.exp(log_front) * series).otherwise(
        F.exp(log_front) / fraction)
    return F.when(dof >= 1, F.when(chi2 <= 0, 1.0).otherwise(tail))


def outcome_counts(rows: DataFrame) -> DataFrame:
    """Group sizes and positive outcomes per (Dimension, Bucket)."""
    return rows.groupBy("Dimension", "Bucket").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("repeat_180") == 1).alias("hits"))


def chi_square(counts: DataFrame, min_group: int = 0) -> DataFrame:
    """Independence of group and 0/1 outcome, per dimension, from counts.

    Yates' correction applies at one degree of freedom. A dimension with one
    group or one outcome has no test: its chi-square measures are null.
    """
    kept = counts.filter(F.col("n") >= min_group)
    margin = W.partitionBy("Dimension")
    cells = kept.withColumns({
        "_all": F.sum("n").over(margin).cast("double"),
        "_hits": F.sum("hits").over(margin).cast("double"),
        "_groups": F.count(F.lit(1)).over(margin)})
    total, pos = F.col("_all"), F.col("_hits")
    slack = F.when(F.col("_groups") == 2, 0.5).otherwise(0.0)

    def cell(seen: Column, margin_total: Column) -> Column:
        expected = F.col("n") * margin_total / total
        gap = F.abs(seen - expected)
        return F.try_divide(F.pow(gap - F.least(slack, gap), F.lit(2.0)), expected)

    both = cell(F.col("hits"), pos) + cell(F.col("n") - F.col("hits"), total - pos)
    tested = (F.col("Groups") > 1) & (F.col("_hits") > 0) & (F.col("_hits") < F.col("N"))
    sums = cells.groupBy("Dimension").agg(
        F.count(F.lit(1)).alias("Groups"), F.sum("n").alias("N"), F.sum("hits").alias("_hits"),
        F.sum(both).alias("_chi2"))
    return (sums.withColumn("Chi2", F.when(tested, F.col("_chi2")))
            .withColumns({
                "dof": (F.col("Groups") - 1).cast("int"),
                "Cramers_V": F.sqrt(F.col("Chi2") / F.col("N"))})
            .withColumn("p_value", chi2_p_value(F.col("Chi2"), F.col("dof")))
            .withColumn("Effect", effect_size(F.col("Cramers_V")))
            .select("Dimension", "Groups", "N", "Chi2", "dof", "p_value", "Cramers_V", "Effect"))


def association_tests(cust: DataFrame, min_group: int) -> DataFrame:
    """Repurchase against state, category and the three experience buckets, from one pass."""
    dimensions = {"state": F.col("customer_state"), "category": F.col("category")}
    rows = long_groups(observed(cust), dimensions | experience_columns(), ("repeat_180",))
    return chi_square(outcome_counts(rows), min_group)


def installments_test(cust: DataFrame) -> DataFrame:
    """Repurchase against the instalment bin of the first order."""
    bins = {"installments": installment_bucket(F.col("max_installments"))}
    return chi_square(outcome_counts(long_groups(cust.filter("mature"), bins, ("repeat_180",))))


def significant(tests: DataFrame, alpha: float = 0.05) -> DataFrame:
    """Every dimension with its p-value and whether it is below ``alpha``; untested ones are not."""
    return tests.select("Dimension", "p_value",
                        F.coalesce(F.col("p_value") < alpha, F.lit(False)).alias("significant"))


def spearman(groups: DataFrame, a: str, b: str, name: str, negate_b: bool = False) -> DataFrame:
    """Rank correlation of two columns of a group report (one row per group, ``name`` unique)."""
    pairs = groups.select(F.col(name).alias("_name"), F.col(a).cast("double").alias("a"),
                          F.col(b).cast("double").alias("b")).dropna(subset=["a", "b"])
    if negate_b:
        pairs = pairs.withColumn("b", -F.col("b"))
    ranks = average_rank(pairs, "a", "_name").select("_name", "b", F.col("avg_rank").alias("ra"))
    both = average_rank(ranks, "b", "_name").select("ra", F.col("avg_rank").alias("rb"))
    return both.agg(F.count(F.lit(1)).alias("groups"), F.corr("ra", "rb").alias("rho"))
