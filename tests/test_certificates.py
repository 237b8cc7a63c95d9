"""Every certificate of a fitted result turns false when the result is spoiled."""

import dataclasses

import numpy as np
import pytest
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from orderlens import stages
from orderlens.operators import attribution, models, segments, trees
from orderlens.plans import queries
from orderlens.plans.analysis import Analysis
from orderlens.plans.queries import STAR
from orderlens.sources.star import star_tables

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def analysis(spark):
    small = dataclasses.replace(STAR, forest_trees=5, forest_depth=3, boosted_rounds=3)
    return Analysis(star_tables(spark, FOLDER), small)


def test_clusters(analysis):
    found, centres, cost = segments.kmeans_fit(analysis.rfm, STAR)
    wide = stages.stage(found, "wide")
    profile = segments.segment_profile(wide, STAR)
    names = ("nearest", "cost_agrees", "means_agree", "names_agree")
    proof = lambda *parts: {n: queries.cluster_proof(*parts).first()[n] for n in names}
    assert proof(wide, centres, cost, profile) == dict.fromkeys(names, True)
    shuffled = wide.withColumn("segment", (F.col("segment") + F.col("customer_unique_id") % 2) % STAR.k_final)
    assert not any(proof(shuffled, centres, cost, profile)[n] for n in names[:3])
    one = wide.withColumn("segment", F.when(F.col("customer_unique_id") == wide.agg(F.min("customer_unique_id")).first()[0],
                                            (F.col("segment") + 1) % STAR.k_final).otherwise(F.col("segment")).cast("int"))
    assert not proof(one, centres, cost, segments.segment_profile(one, STAR))["nearest"]
    renamed = profile.withColumn("Segment_Label", F.lit("Lost"))
    assert proof(wide, centres, cost, renamed) == {**dict.fromkeys(names, True), "names_agree": False}
    moved = profile.withColumn("Avg_Monetary", F.col("Avg_Monetary") * 1.01)
    assert not proof(wide, centres, cost, moved)["means_agree"]
    assert not proof(wide, centres, cost, profile.filter("segment <> 0"))["means_agree"]


@pytest.mark.parametrize("k", [2, 5])
def test_silhouette_from_moments(spark, k):
    rng = np.random.default_rng(k)
    points = [[float(x) for x in p] for p in np.concatenate((rng.normal(0, 1, (60, 2)), rng.normal(4, 1, (50, 2))))]
    df = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(spark.createDataFrame(points, "a double, b double"))
    found = KMeans(k=k, seed=1, predictionCol="segment").fit(df).transform(df)
    told = ClusteringEvaluator(predictionCol="segment").evaluate(found)
    assert segments.silhouette(found, ("a", "b")).first()["silhouette"] == pytest.approx(told, abs=1e-9)
    spoiled = found.withColumn("segment", (F.col("segment") + (F.col("a") > 0.5).cast("int")) % k)
    assert abs(segments.silhouette(spoiled, ("a", "b")).first()["silhouette"] - told) > 1e-3


def test_silhouette_by_definition(spark):
    """Squared distances to every other point; a customer alone counts 0, also equal points; one cluster has none."""
    rows = [(0, 0.0, 0.0), (0, 1.0, 0.0), (0, 0.0, 2.0), (1, 5.0, 5.0), (1, 6.0, 5.0), (2, -4.0, 1.0)]
    x, c = np.array([r[1:] for r in rows]), np.array([r[0] for r in rows])
    d = ((x[:, None] - x[None]) ** 2).sum(axis=2)
    values = []
    for i in range(len(rows)):
        own = (c == c[i]).sum() - 1
        if not own:
            values.append(0.0)
            continue
        a, b = d[i][c == c[i]].sum() / own, min(d[i][c == o].mean() for o in {*c} - {c[i]})
        values.append((b - a) / max(a, b))
    df = spark.createDataFrame(rows, "segment int, a double, b double")
    assert segments.silhouette(df, ("a", "b")).first()[0] == pytest.approx(np.mean(values), abs=1e-12)
    assert segments.silhouette(df.withColumn("segment", F.lit(0)), ("a", "b")).first()[0] is None
    same = spark.createDataFrame([(0, 1.0, 1.0), (0, 1.0, 1.0), (1, 1.0, 1.0), (1, 1.0, 1.0)], "segment int, a double, b double")
    assert segments.silhouette(same, ("a", "b")).first()[0] == 0


def test_logistic_optimum(analysis):
    told = models.logistic_certificate(analysis.model_table, "churn", analysis.settings, False).first()
    assert told["gradient"] < 1e-3
    hasty = dataclasses.replace(analysis.settings, logistic_rounds=1)
    assert models.logistic_certificate(analysis.model_table, "churn", hasty, False).first()["gradient"] > 1e-2


@pytest.mark.parametrize("label, weighted", [("churn", False), ("repeat_180", True)])
def test_trees_against_their_nodes(analysis, label, weighted):
    table = analysis.model_table if label == "churn" else analysis.mature
    told = {r["Model"]: r for r in models.tree_certificates(table, label, analysis.settings, weighted, 3).collect()}
    assert {n: r["trees"] for n, r in told.items()} == {models.FOREST: 5, models.BOOSTED: 3}
    assert all(r["score_gap"] < 1e-9 and r["leaf_gap"] < 1e-9 and r["test_rows"] > 0 for r in told.values())


def test_spoiled_trees(spark):
    """A moved threshold, a changed leaf or a missing child shows; the mean of a leaf by hand; NaN goes right."""
    rng = np.random.default_rng(5)
    rows = [(float(a), float(b), float(a + b > 1)) for a, b in rng.random((300, 2))]
    vectors = VectorAssembler(inputCols=["a", "b"], outputCol="features", handleInvalid="keep")
    data = stages.stage(vectors.transform(spark.createDataFrame(rows, "a double, b double, label double")), "points")
    model = GBTClassifier(maxIter=4, maxDepth=3, seed=1).fit(data)
    nodes = stages.stage(trees.saved_nodes(spark, model), "nodes")
    odd = vectors.transform(spark.createDataFrame([(float("nan"), y, 1.0) for y in (0.1, 0.5, 0.9)], "a double, b double, label double"))
    walked = lambda n: model.transform(data.unionByName(odd)).select(F.max(F.abs(vector_to_array("probability")[1] - trees.boosted_probability(
        trees.leaves(n)))).alias("g")).first()["g"]
    means = lambda n: trees.boosted_leaf_means(data, n, "label").select(
        F.max(F.coalesce(F.abs(F.col("value") - F.col("mean")), F.lit(9.0))).alias("g")).first()["g"]
    gap = lambda n: trees.totals_add_up(n).agg(F.max("gap")).first()[0]
    assert walked(nodes) < 1e-12 and means(nodes) < 1e-9 and gap(nodes) < 1e-9
    moved = nodes.withColumn("threshold", F.when(F.expr("tree = 1 AND node = 0"), F.col("threshold") / 2).otherwise(F.col("threshold")))
    assert walked(moved) > 1e-4 and means(moved) > 1e-4
    first = nodes.filter("left < 0 AND tree = 0").agg(F.min("node")).first()[0]
    leaf = nodes.withColumn("value", F.col("value") + F.when((F.col("tree") == 0) & (F.col("node") == first), 0.01).otherwise(0.0))
    assert walked(leaf) > 1e-4 and means(leaf) > 1e-3
    assert gap(nodes.filter(f"tree > 0 OR node <> {first}")) == float("inf")
    # The first tree's leaves are plain means of the label as -1 or 1.
    by_leaf = {}
    for r in data.select("label", trees.leaves(nodes)["leaf"][0].alias("leaf")).collect():
        by_leaf.setdefault(r["leaf"], []).append(2 * r["label"] - 1)
    values = {r["node"]: r["value"] for r in nodes.filter("tree = 0 AND left < 0").collect()}
    assert by_leaf.keys() == values.keys() and all(values[k] == pytest.approx(np.mean(v)) for k, v in by_leaf.items())


def test_leaf_means_send_a_row_a_leaf(spark):
    """A task sends a row a leaf it met, not one a row and tree; weighted means by hand."""
    rows = [(x / 10, float(x % 7 < 3), 1.0 + x % 2) for x in range(400)]
    points = spark.createDataFrame(rows, "a double, label double, w double").repartition(3)
    data = stages.stage(VectorAssembler(inputCols=["a"], outputCol="features").transform(points), "points")
    model = GBTClassifier(maxIter=3, maxDepth=2, seed=1, weightCol="w").fit(data)
    nodes = stages.stage(trees.saved_nodes(spark, model), "nodes")
    found = trees.boosted_leaf_means(data, nodes, "label", "w")
    assert "Generate" not in found._jdf.queryExecution().executedPlan().toString()
    sums: dict = {}
    for r in data.select("label", "w", trees.leaves(nodes).alias("f")).collect():
        y = 2 * r["label"] - 1
        for tree, (leaf, before) in enumerate(zip(r["f"]["leaf"], r["f"]["before"])):
            rest = y if tree == 0 else 4 * y / (1 + np.exp(2 * y * before))
            cell = sums.setdefault((tree, leaf), [0.0, 0.0])
            cell[0] += r["w"] * rest
            cell[1] += r["w"]
    got = {(r["tree"], r["node"]): (r["value"], r["mean"]) for r in found.collect()}
    assert got.keys() == sums.keys()
    for key, (rest, weight) in sums.items():
        assert got[key][1] == pytest.approx(rest / weight, abs=1e-12) and got[key][0] == pytest.approx(rest / weight, abs=1e-9)


def test_attributions_and_importance(analysis):
    names = attribution.feature_names(analysis.regions)
    values, _ = attribution.feature_attribution(analysis.mature, analysis.regions, STAR, trees=4, depth=3)
    gap = lambda v: v.agg(F.max(attribution.sum_gap(v, names))).first()[0]
    assert gap(values) < 1e-9
    assert gap(values.withColumn("item_count", F.col("item_count") + 1e-6)) > 1e-7
    assert gap(values.withColumn("probability", F.lit(0.5))) > 1e-4
    long = {r[0]: r[1] for r in attribution.mean_absolute(values, names).collect()}
    wide = {r[0]: r[1] for r in attribution.mean_absolute_wide(values, names).collect()}
    assert long.keys() == wide.keys() and all(abs(long[n] - wide[n]) < 1e-12 for n in names)


def test_areas_and_best_model(analysis):
    scores = analysis.churn_predictions
    assert analysis.churn_predictions is scores
    metrics = models.classification_metrics(scores)
    assert all(r[0] for r in metrics.select(queries.areas_agree(metrics, scores)).collect())
    worse = metrics.withColumn("AUC_ROC", F.col("AUC_ROC") - 0.01)
    assert not any(r[0] for r in worse.select(queries.areas_agree(worse, scores)).collect())
    areas = {name: queries.rank_auc(s) for name, s in scores.items()}
    best = models.best_model(scores)
    assert areas[best] == max(areas.values())
    flipped = {**scores, best: scores[best].withColumn("score", 1 - F.col("score"))}
    assert models.best_model(flipped) != best or areas[best] <= 0.5
    table = models.score_table(analysis.model_table, analysis.settings, scores)
    assert table.count() == scores[best].count() and table.columns[-2:] == ["churn_prob", "prediction"]


def test_fitted_inputs(analysis):
    """Medians and deviations of the training rows, in NumPy."""
    table = {r["input"]: r for r in models.fitted_inputs(analysis.model_table, analysis.settings).collect()}
    train = models.train_test(analysis.model_table, analysis.settings)[0].toPandas()
    for name in models.IMPUTED_FEATURES:
        assert table[name]["median"] == pytest.approx(train[name].median())
        assert table[name]["spread"] == pytest.approx(train[name].fillna(train[name].median()).std())
    regions = sorted(train["region"].unique())
    assert sorted(n for n in table if n.startswith("region ")) == [f"region {r}" for r in regions[1:]]


def test_stages_of_a_scope_go(spark):
    before = stages.stage(spark.range(3), "kept")
    with pytest.raises(ZeroDivisionError), stages.scope(spark):
        inside = stages.stage(spark.range(4), "gone")
        path = inside.inputFiles()[0]
        raise ZeroDivisionError
    assert before.count() == 3
    import os
    assert not os.path.exists(path.removeprefix("file:").removeprefix("//"))
