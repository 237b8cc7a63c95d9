"""Churn and repurchase classifiers on Spark MLlib, their metrics and scores."""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.ml import Estimator
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import (
    BinaryClassificationEvaluator, MulticlassClassificationEvaluator)
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from orderlens.operators import trees
from orderlens.operators.customers import IMPUTED_FEATURES
from orderlens.operators.evaluate import (
    auc_exact, confusion_matrix, cumulative_gains, lift_at_k, roc_points, score_deciles)
from orderlens.operators.features import medians, with_split
from orderlens.settings import Settings
from orderlens.stages import at_once, stage

# Features that are never missing, and the names of the models.
PLAIN_FEATURES = ("log_order_value", "item_count", "has_review", "used_voucher")
# Training rows that are worth a task of their own.
TASK_ROWS = 10_000
LOGISTIC, FOREST, BOOSTED = "Logistic Regression", "Random Forest", "Gradient Boosted Trees"


@dataclass(frozen=True)
class Preparation:
    """What the training rows say about the inputs: one number a feature and the list of regions."""

    medians: dict[str, float]
    regions: tuple[str, ...]
    spread: dict[str, float]

    def inputs(self) -> dict[str, Column]:
        """Numeric inputs: plain features, features with nulls set to the median, an indicator a region."""
        found = {c: F.col(c).cast("double") for c in PLAIN_FEATURES}
        found |= {c: F.coalesce(F.col(c), F.lit(self.medians.get(c, 0.0))) for c in IMPUTED_FEATURES}
        return found | {f"region {r}": (F.col("region") == r).cast("double") for r in self.regions}

    def apply(self, table: DataFrame) -> DataFrame:
        """``features``: the inputs over their spread, not centred; an input without spread is 0."""
        parts = {f"_in_{i}": F.coalesce(F.try_divide(c, F.lit(self.spread[name])), F.lit(0.0))
                 for i, (name, c) in enumerate(self.inputs().items())}
        wide = table.withColumns(parts)
        return VectorAssembler(inputCols=list(parts), outputCol="features").transform(wide).drop(*parts)


def preparation(train: DataFrame) -> Preparation:
    """Exact medians, the regions but one, and sample deviations; the driver sees a few dozen numbers."""
    known = {r["feature"]: r["median"] for r in medians(train, IMPUTED_FEATURES, "customer_unique_id").collect()}
    regions = sorted(r[0] for r in train.select("region").distinct().collect() if r[0] is not None)
    draft = Preparation(known, tuple(regions[1:]), {})
    row = train.agg(*[F.stddev_samp(c).alias(name) for name, c in draft.inputs().items()]).first()
    return replace(draft, spread={name: row[name] or 0.0 for name in draft.inputs()})


def classifiers(
    label: str, settings: Settings, weight: str | None = None, boosted_depth: int | None = None
) -> dict[str, Estimator]:
    """The three models with the parameters of ``settings``."""
    common = {"featuresCol": "features", "labelCol": label} | ({"weightCol": weight} if weight else {})
    table = {
        LOGISTIC: (LogisticRegression, {"maxIter": settings.logistic_rounds}),
        # The places of rows in all trees are kept between levels instead of found again: the same forest.
        FOREST: (RandomForestClassifier, {"numTrees": settings.forest_trees, "maxDepth": settings.forest_depth,
                                          "seed": settings.seed, "cacheNodeIds": True}),
        BOOSTED: (GBTClassifier, {"maxIter": settings.boosted_rounds, "seed": settings.seed,
                                  "maxDepth": boosted_depth or settings.boosted_depth_churn}),
    }
    return {name: kind(**common, **options) for name, (kind, options) in table.items()}


def train_test(table: DataFrame, settings: Settings) -> tuple[DataFrame, DataFrame]:
    """Split by customer id; both sides come from one stage table."""
    rows = stage(with_split(table, "customer_unique_id", settings.seed, settings.train_share),
                 "split")
    return (rows.filter(F.col("split") == "train").drop("split"),
            rows.filter(F.col("split") == "test").drop("split"))


def with_class_weight(train: DataFrame, label: str) -> DataFrame:
    """``w``: negatives per positive for positive rows, 1 for the others."""
    ratio = train.agg(F.count_if(F.col(label) == 0)
                      / F.greatest(F.count_if(F.col(label) == 1), F.lit(1))).scalar()
    return train.withColumn("w", F.when(F.col(label) == 1, ratio).otherwise(1.0))


def spread(train: DataFrame, id_col: str = "customer_unique_id") -> DataFrame:
    """Training rows dealt evenly over the cores by id, in the order of ids; few rows stay as they are.

    Trees are grown in many short passes, each as long as its largest task, and the files of a stage are as
    many and as large as its shuffle left them. MLlib draws a forest's samples by partition and place there.
    """
    tasks = min(train.sparkSession.sparkContext.defaultParallelism, train.count() // TASK_ROWS)
    return train.repartition(tasks, id_col).sortWithinPartitions(id_col) if tasks > 1 else train


@contextmanager
def _cached(df: DataFrame):
    df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield df
    finally:
        df.unpersist()


def _prepared(train: DataFrame, test: DataFrame) -> tuple[Preparation, DataFrame, DataFrame]:
    prep = preparation(train)
    return prep, prep.apply(train), prep.apply(test)


def _score_columns(pred: DataFrame, label: str) -> DataFrame:
    return pred.select(
        F.col("customer_unique_id").alias("id"), F.col(label).alias("label"),
        vector_to_array("probability")[1].alias("score"), "prediction", "rawPrediction")


def _areas(pred: DataFrame) -> dict[str, float]:
    return {name: BinaryClassificationEvaluator(labelCol="label", metricName=metric).evaluate(pred)
            for name, metric in (("AUC_ROC", "areaUnderROC"), ("PR_AUC", "areaUnderPR"))}


def predictions(
    table: DataFrame, label: str, settings: Settings, weighted: bool = False,
    boosted_depth: int | None = None, then: Callable[[str, DataFrame], object] | None = None,
) -> dict:
    """Staged test scores (id, label, score, prediction, rawPrediction) of every classifier, each fitted once.

    ``then`` is called with name and scores of a model as soon as it is scored, while others are still
    fitted; its results are returned in place of the scores.

    Metrics, curves and deciles are computed from these tables, so a label needs one fit. The forest's few long
    passes keep every core at work and come first, by themselves; the other models are fitted in hundreds of short
    passes that leave cores idle, and these run beside each other, as does the scoring of the test rows.
    """
    train, test = train_test(table, settings)
    weight = "w" if weighted else None
    if weighted:
        train = with_class_weight(train, label)
    _, fitted, held_out = _prepared(train, test)
    fitted = spread(fitted)
    estimators = classifiers(label, settings, weight, boosted_depth)
    with _cached(fitted.select(label, "features", *([weight] if weight else []))) as data:
        forest = estimators[FOREST].fit(data)

        def scored(name: str) -> DataFrame:
            model = forest if name == FOREST else estimators[name].fit(data)
            scores = stage(_score_columns(model.transform(held_out), label), "predictions")
            return then(name, scores) if then else scores

        return dict(zip(estimators, at_once(table.sparkSession, scored, estimators)))


def churn_predictions(table: DataFrame, settings: Settings, then: Callable[[str, DataFrame], object] | None = None) -> dict:
    return predictions(table, "churn", settings, False, settings.boosted_depth_churn, then)


def repeat_predictions(mature: DataFrame, settings: Settings, then: Callable[[str, DataFrame], object] | None = None) -> dict:
    return predictions(mature, "repeat_180", settings, True, settings.boosted_depth_repeat, then)


def _session(scores: dict[str, DataFrame]) -> SparkSession:
    return next(iter(scores.values())).sparkSession


def classification_metrics(scores: dict[str, DataFrame]) -> DataFrame:
    """One row of test metrics per model: areas, accuracy, F1, precision, recall and the confusion counts."""
    def row(name: str) -> tuple:
        pred = scores[name]
        quality = {m: MulticlassClassificationEvaluator(
            labelCol="label", metricName=m).evaluate(pred) for m in ("accuracy", "f1")}
        areas = _areas(pred)
        cm = confusion_matrix(pred).first()
        return (name, areas["AUC_ROC"], areas["PR_AUC"], quality["accuracy"],
                quality["f1"], cm["precision"], cm["recall"],
                cm["TN"], cm["FP"], cm["FN"], cm["TP"])

    spark = _session(scores)
    return spark.createDataFrame(
        at_once(spark, row, scores), "Model string, AUC_ROC double, PR_AUC double, Accuracy double, F1_Score double, "
              "Precision double, Recall double, TN long, FP long, FN long, TP long")


def ranking_metrics(scores: dict[str, DataFrame]) -> DataFrame:
    """One row of ranking metrics per model: areas, base rate, recall and lift among the top scores."""
    def row(name: str) -> tuple:
        areas = _areas(scores[name])
        top = {r["fraction"]: r for r in lift_at_k(scores[name]).collect()}
        return (name, areas["AUC_ROC"], areas["PR_AUC"], top[0.1]["base_rate"],
                top[0.2]["recall"], top[0.1]["lift"], top[0.2]["lift"])

    spark = _session(scores)
    return spark.createDataFrame(
        at_once(spark, row, scores), "Model string, AUC_ROC double, PR_AUC double, Base_rate double, "
              "Recall_top20 double, Lift_top10 double, Lift_top20 double")


def churn_metrics(table: DataFrame, settings: Settings) -> DataFrame:
    """Train every classifier on the churn label; one row of test metrics per model."""
    return classification_metrics(churn_predictions(table, settings))


def repeat_metrics(mature: DataFrame, settings: Settings) -> DataFrame:
    """Train every classifier on the weighted repurchase label; ranking metrics per model."""
    return ranking_metrics(repeat_predictions(mature, settings))


def with_area(name: str, scored: DataFrame) -> tuple[DataFrame, float]:
    """Scores of a model and their exact AUC."""
    return scored, auc_exact(scored).first()["auc"] or 0.0


def best_of(measured: dict[str, tuple[DataFrame, float]]) -> str:
    return max(sorted(measured), key=lambda name: measured[name][1])


def best_model(scores: dict[str, DataFrame]) -> str:
    """The model with the highest exact AUC; ties go to the smaller name."""
    found = at_once(_session(scores), lambda name: with_area(name, scores[name]), scores)
    return best_of(dict(zip(scores, found)))


def fitted_inputs(table: DataFrame, settings: Settings) -> DataFrame:
    """The preparation fitted on the training rows as a table: (input, median, spread)."""
    prep = preparation(train_test(table, settings)[0])
    rows = [(name, prep.medians.get(name), prep.spread[name]) for name in prep.inputs()]
    return table.sparkSession.createDataFrame(rows, "input string, median double, spread double")


def logistic_gradient(fitted: DataFrame, label: str, weight: str | None = None) -> DataFrame:
    """How far a logistic model is from its optimum: the gradient's largest entry over the inputs' weight.

    ``fitted`` has the inputs ``features`` and the model's ``probability`` on its own training rows. Without a
    penalty the weighted sum of (probability - label) times each input, and times 1, is zero at the optimum.
    """
    w = F.col(weight) if weight else F.lit(1.0)
    miss = w * (vector_to_array("probability")[1] - F.col(label))
    cells = F.concat(F.array(F.lit(1.0)), vector_to_array("features"))
    long = fitted.select(miss.alias("miss"), w.alias("w"), F.posexplode(cells).alias("i", "x"))
    return (long.groupBy("i").agg(F.abs(F.sum(F.col("miss") * F.col("x"))).alias("g"), F.sum(F.col("w") * F.abs("x")).alias("size"))
            .agg(F.max(F.coalesce(F.try_divide("g", "size"), F.lit(0.0))).alias("gradient"), F.count(F.lit(1)).alias("entries")))


def logistic_certificate(table: DataFrame, label: str, settings: Settings, weighted: bool) -> DataFrame:
    """``logistic_gradient`` of the logistic model as it is trained for ``label``."""
    train, _ = train_test(table, settings)
    if weighted:
        train = with_class_weight(train, label)
    weight = "w" if weighted else None
    with _cached(preparation(train).apply(train).select(label, "features", *([weight] if weighted else []))) as data:
        model = classifiers(label, settings, weight)[LOGISTIC].fit(data)
        return stage(logistic_gradient(model.transform(data), label, weight), "gradient")


def tree_certificates(
    table: DataFrame, label: str, settings: Settings, weighted: bool = False, boosted_depth: int | None = None
) -> DataFrame:
    """Forest and boosted trees held against their own nodes, trained as for ``label``.

    ``score_gap``: the largest difference on test rows between MLlib's probability and the one that
    walking the saved nodes gives. ``leaf_gap``: for boosted trees the largest difference between a
    leaf's value and the mean of what its training rows had left; for the forest, whose trees see samples
    of the rows, between a node's training totals and its children's, relatively.
    """
    train, test = train_test(table, settings)
    weight = "w" if weighted else None
    if weighted:
        train = with_class_weight(train, label)
    _, fitted, held_out = _prepared(train, test)
    fitted = spread(fitted)
    spark, found = table.sparkSession, []
    with _cached(fitted.select(label, "features", *([weight] if weighted else []))) as data:
        estimators = classifiers(label, settings, weight, boosted_depth)
        for name, link in ((FOREST, trees.forest_probability), (BOOSTED, trees.boosted_probability)):
            model = estimators[name].fit(data)
            nodes = stage(trees.saved_nodes(spark, model), "nodes")
            walked = model.transform(held_out).withColumn("walked", trees.leaves(nodes))
            gap = F.max(F.abs(vector_to_array("probability")[1] - link(F.col("walked"))))
            scores = walked.agg(F.count(F.lit(1)).alias("test_rows"), gap.alias("score_gap"))
            if name == BOOSTED:
                gaps = trees.boosted_leaf_means(data, nodes, label, weight).select(
                    F.coalesce(F.abs(F.col("value") - F.col("mean")), F.lit(float("inf"))).alias("gap"))
            else:
                gaps = trees.totals_add_up(nodes)
            found.append(stage(scores.select(
                F.lit(name).alias("Model"), F.lit(model.getNumTrees).alias("trees"), "test_rows", "score_gap",
                F.coalesce(gaps.agg(F.max("gap")).scalar(), F.lit(0.0)).alias("leaf_gap")), "certificate"))
    return reduce(DataFrame.unionByName, found)


def model_curves(name: str, scored: DataFrame) -> DataFrame:
    """ROC and cumulative-gains points of one model, as (Model, Curve, X, Y) rows."""
    kinds = {"ROC": (roc_points, "FPR", "TPR"), "Gains": (cumulative_gains, "Selected_pct", "Captured_pct")}

    def part(curve: str) -> DataFrame:
        points, x, y = kinds[curve]
        return points(scored).select(
            F.lit(name).alias("Model"), F.lit(curve).alias("Curve"), F.col(x).alias("X"), F.col(y).alias("Y"))

    return reduce(DataFrame.unionByName, at_once(scored.sparkSession, part, kinds))


def all_curves(parts: dict[str, DataFrame]) -> DataFrame:
    """The curves of several models as one table."""
    return reduce(DataFrame.unionByName, parts.values())


def curves(scores: dict[str, DataFrame]) -> DataFrame:
    """ROC and cumulative-gains points of every model, as (Model, Curve, X, Y) rows."""
    parts = at_once(_session(scores), lambda name: model_curves(name, scores[name]), scores)
    return all_curves(dict(zip(scores, parts)))


def deciles_of_best(measured: dict[str, tuple[DataFrame, float]]) -> DataFrame:
    """Decile table of the model with the highest area, from ``with_area`` of every model."""
    best = best_of(measured)
    return score_deciles(measured[best][0]).withColumn("Model", F.lit(best))


def best_deciles(scores: dict[str, DataFrame]) -> DataFrame:
    """Decile table of the model with the highest exact AUC."""
    best = best_model(scores)
    return score_deciles(scores[best]).withColumn("Model", F.lit(best))


def score_table(table: DataFrame, settings: Settings, scores: dict[str, DataFrame], label: str = "churn") -> DataFrame:
    """Test customers with their features, and the best model's probability and class from staged ``scores``.

    ``scores`` come from the same table and settings, so its ids are the test rows.
    """
    # The columns of the score table.
    columns = ("customer_unique_id", "Segment_Label", "log_order_value", "item_count", "freight_ratio",
               "avg_review_score", "delivery_days", "delay_days", "max_installments", "used_voucher", "region")
    best = scores[best_model(scores)].select(
        F.col("id").alias("customer_unique_id"), F.col("score").alias(f"{label}_prob"), "prediction")
    return table.select(*columns, label).join(best, "customer_unique_id")


def score_customers(table: DataFrame, settings: Settings, label: str = "churn", model: str | None = None) -> DataFrame:
    """Train the classifiers (or one) and score the test customers with the best."""
    scores = predictions(table, label, settings)
    return score_table(table, settings, {model: scores[model]} if model else scores, label)
