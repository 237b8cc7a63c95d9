import threading
from dataclasses import replace

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from orderlens.operators import attribution, evaluate, models, segments
from orderlens.plans.analysis import Analysis
from orderlens.plans.queries import REGIONS, STAR
from orderlens.sources.star import star_tables
from orderlens.stages import new_path


@pytest.fixture(scope="module")
def analysis(spark):
    return Analysis(star_tables(spark, "/root/testdata/sf0.001"), STAR)


def test_kmeans_cost_falls_and_profile_counts_everyone(analysis):
    rows = segments.kmeans_selection(analysis.rfm, STAR).orderBy("k").collect()
    assert [r["k"] for r in rows] == [2, 3, 4, 5, 6]
    assert rows[0]["WSSSE"] > rows[-1]["WSSSE"]
    assert all(-1 <= r["Silhouette"] <= 1 for r in rows)
    clustered = segments.kmeans_segments(analysis.rfm, STAR).cache()
    profile = segments.segment_profile(clustered, STAR)
    assert profile.agg(F.sum("Count")).first()[0] == analysis.rfm.count()
    named = segments.name_segments(clustered, profile)
    assert named.count() == analysis.rfm.count()
    clustered.unpersist()


def test_evaluator_and_exact_auc_agree(analysis):
    train, test = models.train_test(analysis.model_table, STAR)
    _, fitted, held_out = models._prepared(train, test)
    lr = models.classifiers("churn", STAR)[models.LOGISTIC].fit(fitted)
    scored = models._score_columns(lr.transform(held_out), "churn").cache()
    area = models._areas(scored)["AUC_ROC"]
    assert evaluate.auc_exact(scored).first()["auc"] == pytest.approx(area, abs=0.01)
    scored.unpersist()


def test_split_is_disjoint_and_whole(analysis):
    train, test = models.train_test(analysis.model_table, STAR)
    assert train.join(test, "customer_unique_id", "left_semi").count() == 0
    assert train.count() + test.count() == analysis.model_table.count()


def test_attribution_adds_up_to_the_probability(spark, analysis):
    names = attribution.feature_names(REGIONS)
    table = attribution.model_table(analysis.mature, REGIONS).cache()
    model = attribution.train_forest(table, names, STAR, 8, 4)
    path = new_path(spark, "forest")
    model.save(path)
    leaves = attribution.forest_leaves(spark, path)
    values = attribution.attribute(table, names, leaves)
    total = F.col("base") + sum((F.col(f"`{n}`") for n in names), F.lit(0.0))
    scored = model.transform(VectorAssembler(inputCols=names, outputCol="features").transform(
        table)).select("customer_unique_id", vector_to_array("probability")[1].alias("p"))
    gap = values.select("customer_unique_id", total.alias("s")).join(
        scored, "customer_unique_id").agg(F.max(F.abs(F.col("s") - F.col("p"))), F.count("s"))
    worst, n = gap.first()
    assert n == table.count() and worst < 1e-9
    importance = attribution.mean_absolute(values, names)
    assert importance.count() == len(names)
    share = attribution.importance_share(importance, tuple(names)).first()["share"]
    assert share == pytest.approx(1.0)
    table.unpersist()


def test_shapley_values_equal_the_definition():
    """Every subset of features, on a tree of depth 2 that splits twice on one feature."""
    import itertools
    import math
    inf = math.inf
    leaves = [(0.1, {0: (-inf, 1.0, 0.25), 1: (-inf, 5.0, 0.5)}),
              (0.9, {0: (-inf, 1.0, 0.25), 1: (5.0, inf, 0.5)}),
              (0.4, {0: (1.0, 3.0, 0.5)}), (0.7, {0: (3.0, inf, 0.25)})]

    def known(x, subset):
        return sum(v * math.prod(
            float(lo < x[f] <= hi) if f in subset else z for f, (lo, hi, z) in path.items())
            for v, path in leaves)

    x = np.array([[0.5, 7.0], [2.0, 1.0], [9.0, 5.0]])
    got = attribution.shapley_values(x, attribution.path_arrays(leaves))
    for row, phi in zip(x, got):
        for k in (0, 1):
            other = 1 - k
            want = sum((known(row, {*s, k}) - known(row, set(s))) / 2
                       for r in (0, 1) for s in itertools.combinations([other], r))
            assert phi[k] == pytest.approx(want)
    assert attribution.expected_value(leaves) == pytest.approx(known(x[0], set()))


def test_curves_and_deciles_cover_every_model_and_customer(analysis):
    scores = models.predictions(analysis.mature, "repeat_180", STAR, True, 4)
    kinds = models.curves(scores).groupBy("Model", "Curve").agg(F.max("Y").alias("top")).collect()
    assert {(r["Model"], r["Curve"]) for r in kinds} == {
        (m, c) for m in scores for c in ("ROC", "Gains")}
    assert {r["top"] for r in kinds} == {1.0, 100.0}
    deciles = models.best_deciles(scores)
    assert deciles.agg(F.sum("Customers")).first()[0] == scores[models.LOGISTIC].count()


def test_attribution_tables_are_made_once(monkeypatch):
    """Rows look their values up: the quadrature's work does not grow with them, whichever way a path is handled."""
    rng = np.random.default_rng(7)
    cuts = np.round(rng.random((12, 4)), 1)
    leaves = [(float(rng.random()), {int(f): (float(c), float(c) + 0.3, float(rng.random()))
                                     for f, c in zip(rng.permutation(5)[:2 + i % 3], cuts[i])}) for i in range(12)]
    paths = attribution.path_arrays(leaves)
    x = np.round(rng.random((700, 5)), 1)
    plain, done = attribution.path_values, []
    monkeypatch.setattr(attribution, "path_values", lambda o, z, value: done.append(o.size) or plain(o, z, value))
    values = attribution.Attributor(paths)
    assert values(x[:3]) == pytest.approx(values(x)[:3])
    assert sum(done) == sum(m << m for m in paths)
    looked_up = values(x)
    for name, limit in (("TABLE_BYTES", 0), ("TABLE_FEATURES", 2)):
        monkeypatch.setattr(attribution, name, limit)
        assert attribution.shapley_values(x, paths) == pytest.approx(looked_up, abs=1e-12)


def test_training_rows_are_spread_over_the_cores(spark):
    """Many rows in one file are dealt evenly, the same way whatever the layout; few stay where they are."""
    table = spark.range(45_000).withColumnRenamed("id", "customer_unique_id").coalesce(1)
    one = models.spread(table)
    rows = [[r[0] for r in part] for part in one.rdd.glom().collect()]
    assert len(rows) == 4 and sum(map(len, rows)) == 45_000 and max(map(len, rows)) < 1.05 * 45_000 / 4
    assert all(part == sorted(part) for part in rows)
    other = models.spread(table.repartition(7))
    assert [[r[0] for r in part] for part in other.rdd.glom().collect()] == rows
    assert models.spread(table.limit(500)).rdd.getNumPartitions() == 1
    assert models.classifiers("label", STAR)[models.FOREST].getCacheNodeIds()


def test_models_are_evaluated_while_others_are_fitted(spark, analysis, monkeypatch):
    """The boosted trees' fit waits for the other models' curves and areas; results are those of staged scores."""
    settings = replace(STAR, logistic_rounds=5, forest_trees=3, boosted_rounds=2)
    scores = models.predictions(analysis.mature, "repeat_180", settings, True, 4)
    plain, done = models.classifiers, threading.Semaphore(0)

    class Late:
        def __init__(self, estimator):
            self.estimator = estimator

        def fit(self, data):
            assert all(done.acquire(timeout=60) for _ in range(2))
            return self.estimator.fit(data)

    def late(*args):
        found = plain(*args)
        return found | {models.BOOSTED: Late(found[models.BOOSTED])}

    def noted(then):
        def run(name, scored):
            result = then(name, scored)
            done.release()
            return result
        return run

    monkeypatch.setattr(models, "classifiers", late)
    for then, whole, known in ((models.model_curves, models.all_curves, models.curves(scores)),
                               (models.with_area, models.deciles_of_best, models.best_deciles(scores))):
        found = whole(models.repeat_predictions(analysis.mature, settings, noted(then)))
        assert found.columns == known.columns
        assert sorted(map(tuple, found.collect())) == sorted(map(tuple, known.collect()))
        done = threading.Semaphore(0)


@pytest.mark.parametrize("step, report", [
    ("confusion_matrix", models.classification_metrics), ("lift_at_k", models.ranking_metrics),
    ("roc_points", models.curves), ("cumulative_gains", models.curves), ("auc_exact", models.best_model)])
def test_models_are_evaluated_beside_each_other(spark, monkeypatch, step, report):
    """Every model's step waits for those of the others; results stay with their model, in order."""
    rows = [(i, float(i % 3 == 0), (i * 37 % 50) / 50) for i in range(50)]
    scored = spark.createDataFrame(rows, "id long, label double, score double").withColumn(
        "prediction", F.when(F.col("score") > 0.5, 1.0).otherwise(0.0)).withColumn(
        "rawPrediction", array_to_vector(F.array(-F.col("score"), "score")))
    scores = {"a": scored, "b": scored.withColumn("score", F.col("label") / 2 + 0.1).withColumn(
        "rawPrediction", array_to_vector(F.array(-F.col("score"), "score")))}
    plain, met = report(scores), threading.Barrier(2)
    alone, meets = getattr(models, step), lambda *args: (met.wait(60), alone(*args))[1]
    monkeypatch.setattr(models, step, meets)
    again = report(scores)
    if step == "auc_exact":
        assert plain == again == "b"
    else:
        assert [r["Model"] for r in again.select("Model").distinct().orderBy("Model").collect()] == ["a", "b"]
        assert sorted(map(tuple, again.collect())) == sorted(map(tuple, plain.collect()))


def test_models_of_many_short_passes_are_fitted_beside_each_other(spark, monkeypatch):
    """Logistic model and boosted trees wait for each other's fit, after the forest's; scores stay with their model."""
    def cell(k, n):
        return (F.col("customer_unique_id") * k % n).cast("double")

    table = spark.range(400).withColumnRenamed("id", "customer_unique_id").select(
        "customer_unique_id", (cell(7, 11) > 5).cast("int").alias("churn"), F.concat(F.lit("r"), cell(1, 3)).alias("region"),
        *[cell(3 + i, 13 + i).alias(c) for i, c in enumerate(models.PLAIN_FEATURES + models.IMPUTED_FEATURES)])
    settings = replace(STAR, logistic_rounds=5, forest_trees=3, boosted_rounds=2)
    before = models.predictions(table, "churn", settings)
    plain, met, begun = models.classifiers, threading.Barrier(2), []

    class Waiting:
        def __init__(self, name, estimator):
            self.name, self.estimator = name, estimator

        def fit(self, data):
            begun.append(self.name)
            if self.name != models.FOREST:
                met.wait(60)
            return self.estimator.fit(data)

    monkeypatch.setattr(models, "classifiers", lambda *args: {n: Waiting(n, e) for n, e in plain(*args).items()})
    after = models.predictions(table, "churn", settings)
    assert begun[0] == models.FOREST and len(begun) == 3
    assert list(after) == [models.LOGISTIC, models.FOREST, models.BOOSTED]
    found = [{n: sorted((r["id"], r["score"]) for r in df.collect()) for n, df in scores.items()} for scores in (before, after)]
    assert found[0] == found[1] and len({str(rows) for rows in found[0].values()}) == 3
