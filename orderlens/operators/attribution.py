"""Shapley attribution of a random forest's probability to its features.

The forest is trained by MLlib and its nodes are read back as a table. For every
leaf, the features on its path and their cover ratios are laid out as rows of
arrays; each Arrow batch of customers then looks its values up in tables of the
leaves (path-dependent Shapley values for trees, Lundberg et al. 2018).
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from orderlens.operators.customers import IMPUTED_FEATURES, NUMERIC_FEATURES
from orderlens.operators.evaluate import value_pct_rank
from orderlens.operators.features import dummies, impute_median, with_stratified_split
from orderlens.operators.models import spread, with_class_weight
from orderlens.settings import Settings
from orderlens.stages import new_path, stage

# The batch function travels to the executors with its code, so that the package
# need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Paths of more features have no table: it would have two answers to the power of their number.
TABLE_FEATURES = 8
# Answers that a task keeps, and the leaves whose answers are made at once.
TABLE_BYTES, LEAVES_AT_ONCE = 256_000_000, 64


def feature_names(regions: tuple[str, ...]) -> list[str]:
    return [*NUMERIC_FEATURES, *[f"region_{r}" for r in regions]]


def model_table(mature: DataFrame, regions: tuple[str, ...]) -> DataFrame:
    """Imputed numeric features and region indicators of the observed customers."""
    filled = impute_median(mature, IMPUTED_FEATURES, "customer_unique_id")
    return dummies(filled, "region", regions).select(
        "customer_unique_id", "repeat_180", *feature_names(regions))


def forest_leaves(spark: SparkSession, path: str) -> list[tuple]:
    """Leaves of a saved forest: (value, cover-weighted path constraints), one entry per leaf.

    The model is read to the driver: its size is set by the number and depth of
    trees, not by the data. Each path maps a feature to (low, high, cover ratio).
    """
    nodes = spark.read.parquet(f"{path}/data").select(
        "treeID", "nodeData.id", "nodeData.leftChild", "nodeData.rightChild",
        "nodeData.impurityStats", F.col("nodeData.split.featureIndex").alias("feature"),
        F.get("nodeData.split.leftCategoriesOrThreshold", F.lit(0)).alias("threshold"))
    trees: dict[int, dict[int, tuple]] = {}
    for n in nodes.collect():
        trees.setdefault(n["treeID"], {})[n["id"]] = n
    leaves = []
    for tree in trees.values():
        stack = [(0, {})]
        while stack:
            at, path_so_far = stack.pop()
            node = tree[at]
            cover = sum(node["impurityStats"])
            if node["leftChild"] < 0:
                value = node["impurityStats"][1] / cover if cover else 0.0
                leaves.append((value / len(trees), path_so_far))
                continue
            f, cut = node["feature"], node["threshold"]
            low, high, ratio = path_so_far.get(f, (-math.inf, math.inf, 1.0))
            for child, bounds in ((node["leftChild"], (low, min(high, cut))),
                                  (node["rightChild"], (max(low, cut), high))):
                part = sum(tree[child]["impurityStats"]) / cover if cover else 0.0
                stack.append((child, {**path_so_far, f: (*bounds, ratio * part)}))
    return leaves


def path_arrays(leaves: list[tuple]) -> dict[int, tuple[np.ndarray, ...]]:
    """Leaves grouped by the number m of features on their path, as (leaf, m) arrays:
    leaf value, feature, lower bound, upper bound, cover ratio."""
    groups: dict[int, list] = {}
    for value, path in leaves:
        groups.setdefault(len(path), []).append((value, path))
    return {
        m: (np.array([[v] for v, _ in members]),
            np.array([list(p) for _, p in members]),
            *(np.array([[b[i] for b in p.values()] for _, p in members]) for i in range(3)))
        for m, members in groups.items() if m}


def expected_value(leaves: list[tuple]) -> float:
    """Prediction before any feature is known: leaf values weighted by their cover."""
    return sum(v * math.prod(b[2] for b in path.values()) for v, path in leaves)


def path_values(o: np.ndarray, z: np.ndarray, value: np.ndarray) -> np.ndarray:
    """Shapley values at leaves, one for each feature on the path (the last axis).

    With o = 1 where the row passes a feature's bounds and z its cover ratio, the
    value of feature k at a leaf is (o_k - z_k) times the integral over t in
    [0, 1] of the product of t * o_i + (1 - t) * z_i over the other features
    (Owen 1972). The integrand is a polynomial of degree m - 1, so Gauss-Legendre
    quadrature with m // 2 + 1 nodes is exact.
    """
    nodes, weights = np.polynomial.legendre.leggauss(o.shape[-1] // 2 + 1)
    total = np.zeros(np.broadcast_shapes(o.shape, z.shape))
    for t, w in zip((nodes + 1) / 2, weights / 2):
        factor = o * t + z * (1 - t)
        total += w * factor.prod(axis=-1, keepdims=True) / factor
    return total * (o - z) * value


class Attributor:
    """Shapley values of rows over the leaves of ``path_arrays``.

    What a leaf gives depends only on which of its m features a row passes. Those 2^m answers are
    computed once a leaf, and a row looks up its own (Yang 2021, Fast TreeSHAP). Features come as
    places among the forest's thresholds, so that one look-up tells whether a bound is passed. Tables
    are kept up to ``TABLE_BYTES`` and made anew for each batch beyond; paths of more than
    ``TABLE_FEATURES`` features are computed row by row.
    """

    def __init__(self, paths: dict[int, tuple[np.ndarray, ...]]):
        self.paths, self.kept, self.room = paths, {}, TABLE_BYTES
        bounds: dict[int, set] = {}
        for _, feature, low, high, _ in paths.values():
            for f in np.unique(feature).tolist():
                bounds.setdefault(f, set()).update(low[feature == f].tolist(), high[feature == f].tolist())
        self.cuts = {f: np.array(sorted(b - {-math.inf, math.inf})) for f, b in bounds.items()}

    def __call__(self, x: np.ndarray) -> np.ndarray:
        phi = np.zeros(x.shape[::-1])
        place = {f: np.searchsorted(cuts, x[:, f]) for f, cuts in self.cuts.items()}
        given, pattern = np.empty(len(x)), np.empty(len(x), np.intp)
        for m, (_, feature, *_) in self.paths.items():
            if m > TABLE_FEATURES:
                phi += self._row_by_row(x, m).T
                continue
            for at in range(0, len(feature), LEAVES_AT_ONCE):
                for owner, passes, answers in zip(feature[at:at + LEAVES_AT_ONCE].tolist(), *self._tables(m, at)):
                    pattern.fill(0)
                    for f, bit in zip(owner, passes):
                        pattern += bit[place[f]]
                    for f, answer in zip(owner, answers):
                        phi[f] += np.take(answer, pattern, out=given, mode="clip")
        return phi.T

    def _tables(self, m: int, at: int) -> tuple[list, np.ndarray]:
        """For some leaves: per feature its bit of the pattern by place, and the answers (leaf, feature, pattern)."""
        if (m, at) in self.kept:
            return self.kept[m, at]
        value, feature, low, high, z = (c[at:at + LEAVES_AT_ONCE] for c in self.paths[m])
        o = (np.arange(1 << m)[:, None] >> np.arange(m) & 1).astype(float)
        answers = np.ascontiguousarray(path_values(o, z[:, None, :], value[:, None, :]).transpose(0, 2, 1))
        passes = []
        for owner, lows, highs in zip(feature.tolist(), low.tolist(), high.tolist()):
            bits = []
            for k, (f, a, b) in enumerate(zip(owner, lows, highs)):
                cuts, bit = self.cuts[f], np.zeros(len(self.cuts[f]) + 1, np.intp)
                # Place i is above the cut before it and at or below its own.
                bit[np.searchsorted(cuts, a, "right"):np.searchsorted(cuts, b) + 1] = 1 << k
                bits.append(bit)
            passes.append(bits)
        if answers.nbytes <= self.room:
            self.room -= answers.nbytes
            self.kept[m, at] = passes, answers
        return passes, answers

    def _row_by_row(self, x: np.ndarray, m: int) -> np.ndarray:
        value, feature, low, high, z = self.paths[m]
        phi, owner = np.zeros(x.shape), feature.ravel()
        for at in range(0, len(x), 64):
            v = x[at:at + 64][:, feature]
            part = path_values(((v > low) & (v <= high)).astype(float), z, value).reshape(len(v), -1)
            for f in np.unique(owner):
                phi[at:at + 64, f] = part[:, owner == f].sum(axis=1)
        return phi


def shapley_values(x: np.ndarray, paths: dict[int, tuple[np.ndarray, ...]]) -> np.ndarray:
    """Shapley values of the rows of ``x``, one column per feature."""
    return Attributor(paths)(x)


def train_forest(train: DataFrame, names: list[str], settings: Settings, trees: int, depth: int):
    rows = VectorAssembler(inputCols=names, outputCol="features").transform(
        with_class_weight(spread(train), "repeat_180")).select("repeat_180", "w", "features")
    rows.persist(StorageLevel.MEMORY_AND_DISK)
    model = RandomForestClassifier(
        featuresCol="features", labelCol="repeat_180", weightCol="w", numTrees=trees,
        maxDepth=depth, minInstancesPerNode=20, seed=settings.seed, cacheNodeIds=True).fit(rows)
    rows.unpersist()
    return model


def attribute(test: DataFrame, names: list[str], leaves: list[tuple]) -> DataFrame:
    """One row per customer: id, ``base``, the Shapley value of every feature, and ``raw``, the features."""
    spark = test.sparkSession
    shared = spark.sparkContext.broadcast((path_arrays(leaves), expected_value(leaves)))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        paths, base = shared.value
        values = Attributor(paths)
        for pdf in batches:
            x = pdf[names].to_numpy(dtype=float)
            out = pd.DataFrame(values(x), columns=names)
            out.insert(0, "base", base)
            out.insert(0, "customer_unique_id", pdf["customer_unique_id"].to_numpy())
            out["raw"] = list(x)
            yield out

    id_type = test.schema["customer_unique_id"].dataType.simpleString()
    columns = ", ".join(f"`{n}` double" for n in names)
    return test.select("customer_unique_id", *names).mapInPandas(
        run, f"customer_unique_id {id_type}, base double, {columns}, raw array<double>")


def feature_attribution(
    mature: DataFrame, regions: tuple[str, ...], settings: Settings, trees: int = 100,
    depth: int = 8,
) -> tuple[DataFrame, DataFrame]:
    """Shapley values of all held-out customers, and those customers with their features.

    ``probability`` beside the values is the model's own, from MLlib.
    """
    names = feature_names(regions)
    table = with_stratified_split(
        model_table(mature, regions), "customer_unique_id", "repeat_180", settings.seed,
        settings.train_share)
    rows = stage(table, "attribution")
    model = train_forest(rows.filter(F.col("split") == "train"), names, settings, trees, depth)
    path = new_path(mature.sparkSession, "forest")
    model.save(path)
    test = rows.filter(F.col("split") == "test").drop("split")
    values = attribute(test, names, forest_leaves(mature.sparkSession, path))
    said = model.transform(VectorAssembler(inputCols=names, outputCol="features").transform(test)).select(
        "customer_unique_id", vector_to_array("probability")[1].alias("probability"))
    return stage(values.join(said, "customer_unique_id"), "attributions"), test


def sum_gap(values: DataFrame, names: list[str]) -> Column:
    """How far base and attributions of a customer are from the model's probability."""
    return F.abs(F.col("base") + sum((F.col(f"`{n}`") for n in names), F.lit(0.0)) - F.col("probability"))


def mean_absolute_wide(values: DataFrame, names: list[str]) -> DataFrame:
    """As ``mean_absolute``, computed from the wide rows in one aggregate without making them long."""
    means = values.agg(*[F.avg(F.abs(F.col(f"`{n}`"))).alias(n) for n in names])
    return means.unpivot([], [F.col(f"`{n}`") for n in names], "Feature", "Mean_Abs")


def mean_absolute(values: DataFrame, names: list[str]) -> DataFrame:
    """Mean absolute attribution per feature, largest first."""
    cells = F.array(*[F.struct(F.lit(n).alias("Feature"), F.abs(F.col(f"`{n}`")).alias("a"))
                      for n in names])
    return (values.select(F.explode(cells).alias("c")).select("c.*")
            .groupBy("Feature").agg(F.avg("a").alias("Mean_Abs"))
            .orderBy(F.desc("Mean_Abs"), "Feature"))


def importance_share(importance: DataFrame, selected: tuple[str, ...]) -> DataFrame:
    """Share of the selected features in the total importance."""
    chosen = F.sum(F.when(F.col("Feature").isin(*selected), F.col("Mean_Abs")).otherwise(0.0))
    return importance.agg(chosen.alias("selected"), F.sum("Mean_Abs").alias("total")).withColumn(
        "share", F.try_divide("selected", "total"))


def top_values(values: DataFrame, names: list[str], k: int = 10) -> DataFrame:
    """Long rows (feature, attribution, value, its percentile) of the k strongest features."""
    best = mean_absolute(values, names).limit(k)
    cells = F.array(*[F.struct(F.lit(n).alias("Feature"), F.col(f"`{n}`").alias("Attribution"),
                               F.col("raw")[i].alias("Value")) for i, n in enumerate(names)])
    long = values.select("customer_unique_id", F.explode(cells).alias("c")).select("customer_unique_id", "c.*")
    kept = long.join(F.broadcast(best.select("Feature")), "Feature", "left_semi")
    return value_pct_rank(kept, "Feature", "Value", "customer_unique_id")
