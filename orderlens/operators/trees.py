"""Trees of MLlib's forests and boosted trees as tables, and their evaluation beside MLlib.

A saved model's nodes are a table of their own. Rows are walked down all trees in
Arrow batches against a broadcast of the nodes, whose size is set by number and depth
of the trees and not by the data: a model costs no join and no shuffle.

Only splits at a threshold are handled; a model with a categorical split is refused.
A missing number (NaN) goes right, as in MLlib.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast, cloudpickle
from pyspark.ml.classification import GBTClassificationModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.stages import new_path

# The batch function travels to the executors with its code, as in ``attribution``.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def saved_nodes(spark: SparkSession, model) -> DataFrame:
    """One row a node: tree, weight of the tree, node, feature, threshold, left, right (-1 in a leaf), value, stats.

    ``value`` of a classification tree is the share of class 1 among the rows of the node, that of
    a regression tree its prediction. ``stats`` are the training totals MLlib keeps.
    """
    path = new_path(spark, "trees")
    model.save(path)
    stats, split = F.col("nodeData.impurityStats"), F.col("nodeData.split")
    share = F.coalesce(F.try_divide(F.get(stats, F.lit(1)), F.aggregate(stats, F.lit(0.0), lambda a, b: a + b)), F.lit(0.0))
    boosted = isinstance(model, GBTClassificationModel)
    nodes = spark.read.parquet(f"{path}/data").select(
        F.col("treeID").alias("tree"), F.col("nodeData.id").alias("node"), split["featureIndex"].alias("feature"),
        F.get(split["leftCategoriesOrThreshold"], F.lit(0)).alias("threshold"),
        F.col("nodeData.leftChild").alias("left"), F.col("nodeData.rightChild").alias("right"),
        (F.col("nodeData.prediction") if boosted else share).alias("value"), stats.alias("stats"),
        (split["numCategories"] >= 0).alias("categorical"))
    if nodes.filter((F.col("left") >= 0) & F.col("categorical")).limit(1).count():
        raise ValueError("the model has categorical splits")
    weights = [(i, float(w)) for i, w in enumerate(model.treeWeights)]
    return nodes.drop("categorical").join(F.broadcast(spark.createDataFrame(weights, "tree int, weight double")), "tree")


class Trees:
    """Nodes of all trees as arrays (tree, node); a leaf is its own child."""

    def __init__(self, rows: list):
        size = max((r["node"] for r in rows), default=0) + 1
        shape = (max((r["tree"] for r in rows), default=-1) + 1, size)
        self.left = np.tile(np.arange(size), (shape[0], 1))
        self.right, self.feature = self.left.copy(), np.zeros(shape, np.int64)
        self.cut, self.value, self.inner = np.zeros(shape), np.zeros(shape), np.zeros(shape, bool)
        for r in rows:
            at = r["tree"], r["node"]
            self.value[at] = r["value"] * r["weight"]
            if r["left"] >= 0:
                self.left[at], self.right[at], self.inner[at] = r["left"], r["right"], True
                self.feature[at], self.cut[at] = r["feature"], r["threshold"]

    def walk(self, x: np.ndarray) -> np.ndarray:
        """The leaf of every row of ``x`` in every tree."""
        row, tree = np.arange(len(x))[:, None], np.arange(len(self.left))[None, :]
        at = np.zeros((len(x), len(self.left)), np.int64)
        while self.inner[tree, at].any():
            goes_left = x[row, self.feature[tree, at]] <= self.cut[tree, at]
            at = np.where(goes_left, self.left[tree, at], self.right[tree, at])
        return at


def _shared(nodes: DataFrame) -> Broadcast[Trees]:
    """The nodes of a model, whose number is set by its parameters."""
    rows = nodes.select("tree", "weight", "node", "feature", "threshold", "left", "right", "value").toArrow().to_pylist()
    return nodes.sparkSession.sparkContext.broadcast(Trees(rows))


def leaves(nodes: DataFrame, features: str | Column = "features") -> Column:
    """A row in every tree, in their order: ``leaf``, ``value`` (times the tree's weight), ``before``: the sum so far."""
    shared = _shared(nodes)

    @F.pandas_udf("leaf array<int>, value array<double>, before array<double>")
    def walked(x: pd.Series) -> pd.DataFrame:
        trees, parts = shared.value, []
        # A few hundred rows at a time, so that rows times trees stays small.
        for at in range(0, len(x), 512):
            leaf = trees.walk(np.stack(x.iloc[at:at + 512]))
            value = trees.value[np.arange(leaf.shape[1])[None, :], leaf]
            parts.append((leaf.astype(np.int32), value, np.cumsum(value, axis=1) - value))
        return pd.DataFrame({name: [row for part in parts for row in part[k]] for k, name in enumerate(("leaf", "value", "before"))})

    return walked(vector_to_array(features))


def _total(found: Column) -> Column:
    return F.aggregate(found["value"], F.lit(0.0), lambda total, value: total + value)


def forest_probability(found: Column) -> Column:
    """Probability of class 1: the mean of the trees' shares."""
    return _total(found) / F.size(found["value"])


def boosted_probability(found: Column) -> Column:
    """Probability of class 1: the logistic link of twice the weighted sum of the trees."""
    return 1 / (1 + F.exp(-2 * _total(found)))


def boosted_leaf_means(fitted: DataFrame, nodes: DataFrame, label: str, weight: str | None = None) -> DataFrame:
    """Every leaf of boosted trees with the value it has and the mean that its training rows give it.

    A tree is fitted on what the trees before it leave: the first on the label as -1 or 1 (y), each later one
    on 4y / (1 + exp(2 y m)), with m the weighted sum of the trees before. A leaf's value is the weighted mean
    of its rows. One pass over ``fitted``: a task adds its rows up per leaf and sends a row a leaf, however many they are.
    """
    y, w = 2 * F.col(label).cast("double") - 1, F.col(weight) if weight else F.lit(1.0)
    rows = fitted.select(y.alias("y"), w.cast("double").alias("w"), vector_to_array("features").alias("x"))
    shared = _shared(nodes)

    def leaf_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = shared.value
        count, size = trees.left.shape
        hits, weights, rests = (np.zeros(count * size) for _ in range(3))
        tree = np.arange(count)[None, :]
        for batch in batches:
            # A few hundred rows at a time, so that rows times trees stays small.
            for at in range(0, batch.num_rows, 512):
                y, w, x = batch.slice(at, 512).columns
                y, w = (c.to_numpy(zero_copy_only=False)[:, None] for c in (y, w))
                leaf = trees.walk(np.stack(x.to_numpy(zero_copy_only=False)))
                value = trees.value[tree, leaf]
                before = np.cumsum(value, axis=1) - value
                rest = np.where(tree == 0, y, 4 * y / (1 + np.exp(2 * y * before)))
                own = (tree * size + leaf).ravel()
                for total, part in ((hits, None), (weights, np.broadcast_to(w, leaf.shape).ravel()), (rests, (w * rest).ravel())):
                    total += np.bincount(own, part, count * size)
        met = np.flatnonzero(hits)
        yield pa.record_batch([pa.array((met // size).astype(np.int32)), pa.array((met % size).astype(np.int32)),
                               pa.array(weights[met]), pa.array(rests[met])], ["tree", "node", "weight", "rest"])

    means = (rows.mapInArrow(leaf_sums, "tree int, node int, weight double, rest double").groupBy("tree", "node")
             .agg((F.sum("rest") / F.sum("weight")).alias("mean")))
    return nodes.filter("left < 0").select("tree", "node", "value").join(means, ["tree", "node"], "full")


def totals_add_up(nodes: DataFrame) -> DataFrame:
    """Largest relative difference between a node's training totals and those of its two children, per tree."""
    sides = [nodes.select("tree", F.col("node").alias(side), F.col("stats").alias(f"{side}_stats")) for side in ("left", "right")]
    inner = nodes.filter("left >= 0").join(sides[0], ["tree", "left"], "left").join(sides[1], ["tree", "right"], "left")
    both = F.zip_with("left_stats", "right_stats", lambda a, b: a + b)
    gaps = F.zip_with("stats", both, lambda a, b: F.coalesce(F.abs(a - b) / F.greatest(F.abs(a), F.lit(1.0)), F.lit(float("inf"))))
    return inner.groupBy("tree").agg(F.max(F.coalesce(F.array_max(gaps), F.lit(float("inf")))).alias("gap"))
