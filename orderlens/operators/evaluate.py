"""Evaluation of scored customers: any table with an id, a 0/1 label and a score."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from orderlens.operators.rank import (
    average_rank, percentile_value, qcut_bin, range_ranked, running_sums, with_next)
from orderlens.stages import stage

CURVE_POINTS = 300


def by_score(scored: DataFrame) -> DataFrame:
    """Scored rows ranked from the highest score down, ties by id."""
    return range_ranked(scored.select("id", "label", "score"), F.desc("score"), "id")


def _positives(label: str = "label") -> Column:
    return F.count_if(F.col(label) == 1)


def with_threshold(scored: DataFrame, threshold: Column) -> DataFrame:
    """``prediction`` = 1.0 for scores at or above the threshold."""
    return scored.withColumn("prediction", F.when(F.col("score") >= threshold, 1.0).otherwise(0.0))


def median_score(scored: DataFrame) -> Column:
    return percentile_value(scored, "score", "id", 0.5)


def confusion_matrix(predicted: DataFrame, label: str = "label") -> DataFrame:
    """TN, FP, FN, TP and the measures that follow from them, in one pass.

    Precision and recall of class 1 use a denominator of at least 1; F1 is
    weighted by class size.
    """
    y, p = F.col(label), F.col("prediction")
    counts = predicted.agg(
        F.count_if((y == 0) & (p == 0)).alias("TN"), F.count_if((y == 0) & (p == 1)).alias("FP"),
        F.count_if((y == 1) & (p == 0)).alias("FN"), F.count_if((y == 1) & (p == 1)).alias("TP"))
    tn, fp, fn, tp = (F.col(c) for c in ("TN", "FP", "FN", "TP"))
    total = tn + fp + fn + tp

    def f1(hit: Column, wrong: Column, missed: Column) -> Column:
        return F.coalesce(F.try_divide(2.0 * hit, 2.0 * hit + wrong + missed), F.lit(0.0))

    weighted = ((tn + fp) * f1(tn, fn, fp) + (tp + fn) * f1(tp, fp, fn))
    return counts.withColumns({
        "accuracy": F.try_divide(tp + tn, total),
        "precision": tp / F.greatest(tp + fp, F.lit(1)),
        "recall": tp / F.greatest(tp + fn, F.lit(1)),
        "f1_weighted": F.try_divide(weighted, total)})


def score_levels(scored: DataFrame) -> DataFrame:
    """One row per distinct score, highest first: ``pos``, ``neg`` and their running sums ``tp``, ``fp``."""
    levels = scored.groupBy("score").agg(
        _positives().alias("pos"), F.count_if(F.col("label") == 0).alias("neg"))
    return running_sums(range_ranked(levels, F.desc("score")), {"tp": "pos", "fp": "neg"})


def auc_exact(scored: DataFrame) -> DataFrame:
    """Area under the ROC curve: each level's negatives see the positives above them, ties at half weight."""
    pos, neg = F.col("pos").cast("double"), F.col("neg").cast("double")
    above = F.col("tp").cast("double") - pos / 2.0
    sums = score_levels(scored).agg(
        F.coalesce(F.sum("pos"), F.lit(0)).alias("positives"), F.coalesce(F.sum("neg"), F.lit(0)).alias("negatives"),
        F.sum(neg * above).alias("_area"))
    every = F.col("positives").cast("double") * F.col("negatives").cast("double")
    return sums.withColumn("auc", F.try_divide("_area", every)).drop("_area")


def pr_auc(scored: DataFrame) -> DataFrame:
    """Area under the precision-recall curve by trapezoids, from (0, precision of the first level)."""
    levels = score_levels(scored)
    tp, fp = F.col("tp").cast("double"), F.col("fp").cast("double")
    before = F.col("tp") - F.col("pos"), F.col("fp") - F.col("neg")
    precision = tp / (tp + fp)
    earlier = F.coalesce(F.try_divide(before[0].cast("double"), before[0] + before[1]), precision)
    return levels.agg(F.sum("pos").alias("positives"),
                      F.sum(F.col("pos") * (precision + earlier) / 2.0).alias("_area")).select(
        "positives", F.try_divide("_area", F.col("positives").cast("double")).alias("pr_auc"))


def lift_at_k(scored: DataFrame, fractions: tuple[float, ...] = (0.1, 0.2)) -> DataFrame:
    """Recall and lift among the top floor(n * fraction) scores, per fraction."""
    sums = by_score(scored).agg(
        F.count(F.lit(1)).alias("n"), _positives().alias("pos"),
        *[F.count_if((F.col("label") == 1) & (F.col("rank") <= F.floor(F.col("total") * f)))
          .alias(f"hit{i}") for i, f in enumerate(fractions)])
    rows = F.array(*[F.struct(F.lit(f).alias("fraction"), F.floor(F.col("n") * f).alias("selected"),
                              F.col(f"hit{i}").alias("captured")) for i, f in enumerate(fractions)])
    recall = F.try_divide("captured", "pos")
    return (sums.select("n", "pos", F.explode(rows).alias("r")).select("n", "pos", "r.*")
            .select("fraction", "selected", "captured",
                    F.try_divide("pos", "n").alias("base_rate"), recall.alias("recall"),
                    (recall / F.col("fraction")).alias("lift")))


def score_deciles(scored: DataFrame, k: int = 10) -> DataFrame:
    """Size, outcome rate and lift of each equal-frequency bin, highest scores first."""
    binned = by_score(scored).withColumn("Decile", qcut_bin(F.col("rank"), F.col("total"), k))
    table = binned.groupBy("Decile").agg(
        F.count(F.lit(1)).alias("Customers"), _positives().alias("_hits"))
    every = W.partitionBy()
    rate = F.try_divide("_hits", "Customers")
    base = F.try_divide(F.sum("_hits").over(every), F.sum("Customers").over(every))
    return (table.withColumns({"Base_Rate": base, "Repeat_Rate": rate})
            .withColumn("Lift", F.try_divide("Repeat_Rate", "Base_Rate"))
            .drop("_hits"))


def lift_ci(deciles: DataFrame) -> DataFrame:
    """95 % interval of the top bin's lift."""
    p, n, base = F.col("Repeat_Rate"), F.col("Customers"), F.col("Base_Rate")
    half = 1.96 * F.sqrt(p * (1 - p) / n)
    return deciles.filter(F.col("Decile") == 1).select(
        "Customers", "Repeat_Rate", "Lift",
        F.try_divide(p - half, base).alias("Lift_Low"),
        F.try_divide(p + half, base).alias("Lift_High"))


def _thin(curve: DataFrame, place: str, last: Column, points: int) -> DataFrame:
    """Rows of a curve at the whole parts of ``points`` even steps from 0 to ``last``.

    The list of wanted places has at most ``points`` rows and is broadcast.
    """
    step = F.col("_last") / float(points - 1)
    at = F.when(F.col("_j") == points - 1, F.col("_last")).otherwise(F.floor(F.col("_j") * step))
    wanted = (curve.sparkSession.range(points).withColumnRenamed("id", "_j")
              .withColumn("_last", last)
              .select(at.cast("long").alias(place)).distinct())
    return curve.join(F.broadcast(wanted), place)


def roc_points(scored: DataFrame, points: int = CURVE_POINTS) -> DataFrame:
    """ROC curve from (0, 0), one point per distinct score, thinned for reporting.

    Equal scores are grouped before the sort. A point on a straight piece of the
    curve is dropped: there the group below it has the same counts as its own.
    """
    levels = scored.groupBy("score").agg(
        _positives().alias("pos"), F.count_if(F.col("label") == 0).alias("neg"))
    ranked = range_ranked(levels, F.desc("score"))
    straight = (F.col("pos") == F.col("next_pos")) & (F.col("neg") == F.col("next_neg"))
    bend = with_next(ranked, "pos", "neg").withColumn(
        "bend", F.when((F.col("rank") > 1) & F.coalesce(straight, F.lit(False)), 0).otherwise(1))
    curve = stage(running_sums(bend, {"tp": "pos", "fp": "neg", "place": "bend"}).filter("bend = 1")
                  .select("place", "tp", "fp"), "roc")
    totals = curve.agg(F.struct(
        F.max("tp").alias("pos"), F.max("fp").alias("neg"), F.max("place").alias("last"))).scalar()
    origin = curve.sparkSession.range(1).select(
        F.lit(0).cast("long").alias("place"), F.lit(0).cast("long").alias("tp"),
        F.lit(0).cast("long").alias("fp"))
    whole = origin.unionByName(curve)
    thinned = _thin(whole, "place", totals["last"], points)
    return thinned.withColumn("_t", totals).select(
        "place", F.try_divide("fp", "_t.neg").alias("FPR"),
        F.try_divide("tp", "_t.pos").alias("TPR"))


def cumulative_gains(scored: DataFrame, points: int = CURVE_POINTS) -> DataFrame:
    """Share of positives captured against share of customers selected, thinned.

    Every row counts for the first point at or after its place, so the curve is a running
    sum over at most ``points`` rows.
    """
    last = F.col("total") - 1
    step = last / float(points - 1)

    def place(j: Column) -> Column:
        return F.when(j >= points - 1, last).otherwise(F.floor(j * step)).cast("long")

    at = F.col("rank") - 1
    near = F.greatest(F.coalesce(F.floor(F.try_divide(at.cast("double"), step)), F.lit(0)), F.lit(1))
    j = (F.when(place(near - 1) >= at, near - 1).when(place(near) >= at, near).otherwise(near + 1)).cast("long")
    bins = (by_score(scored).withColumn("_place", place(j)).groupBy("_place")
            .agg(_positives().alias("_hits"), F.max("total").alias("n")))
    upto, every = W.orderBy("_place").rowsBetween(W.unboundedPreceding, 0), W.partitionBy()
    return bins.select(
        (F.try_divide(F.col("_place") + 1, "n") * 100.0).alias("Selected_pct"),
        (F.try_divide(F.sum("_hits").over(upto), F.sum("_hits").over(every)) * 100.0).alias("Captured_pct"))


def value_pct_rank(long: DataFrame, feature: str, value: str, id_col: str) -> DataFrame:
    """Percentile rank of each value among its feature's non-null values; ties share their mean."""
    ranked = average_rank(long.filter(F.col(value).isNotNull()), value, id_col, feature)
    return ranked.withColumn("Value_pct", F.col("avg_rank") / F.col("total")).drop(
        "avg_rank", "total")


def best_by(table: DataFrame, name: str, measure: str) -> DataFrame:
    """The row name with the highest measure; ties go to the smaller name."""
    return table.orderBy(F.desc(measure), name).limit(1).select(name, measure)
