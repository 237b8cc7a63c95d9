"""Imputation, indicator columns, standardization, sampling and splitting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from orderlens.operators.rank import group_percentiles, range_ranked


def medians(table: DataFrame, columns: tuple[str, ...], id_col: str, accuracy: int = 10_000) -> DataFrame:
    """Exact median of each column: rows of (feature, median), nulls left out.

    Found by counting, as the cuts of ``rank.cut_rows``: a quantile sketch encloses the middle of each column,
    one aggregate counts the rows below and those of every value in between, and running sums over these few
    counts name the middle. Columns that the sketch misses are ranked.
    """
    values = {c: F.col(c).cast("double") for c in columns}
    around = [0.5 - 2.0 / accuracy, 0.5 + 2.0 / accuracy]
    told = table.agg(*[F.struct(F.count(v).alias("n"), F.percentile_approx(v, around, accuracy).alias("q")).alias(f"_{i}")
                       for i, v in enumerate(values.values())]).first()
    known = [(i, c, told[i]["n"], *told[i]["q"]) for i, c in enumerate(columns) if told[i]["n"]]

    def listed(rows: list[tuple[str, float]]) -> DataFrame:
        one = table.sparkSession.range(1 if rows else 0)
        row = [F.struct(F.lit(c).alias("feature"), F.lit(m).cast("double").alias("median")) for c, m in rows or [("", 0.0)]]
        return one.select(F.inline(F.array(*row)))

    if not known:
        return listed([])
    cells = [F.when(values[c] < low, F.struct(F.lit(i).alias("i"), F.lit(None).cast("double").alias("value")))
             .when(values[c] <= high, F.struct(F.lit(i).alias("i"), values[c].alias("value"))) for i, c, _, low, high in known]
    # Rows below the limits are counted together, under a null value, which sorts first.
    counted = (table.select(F.explode(F.array_compact(F.array(*cells))).alias("_c"))
               .groupBy("_c.i", "_c.value").agg(F.count(F.lit(1)).alias("n")))
    upto = F.sum("n").over(W.partitionBy("i").orderBy("value"))

    def at(i: int, rank: int) -> Column:
        return F.max(F.when((F.col("i") == i) & (F.col("upto") >= rank) & (F.col("upto") - F.col("n") < rank), F.col("value")))

    ends = counted.withColumn("upto", upto).agg(*[
        at(i, (n + side) // 2).alias(f"_{i}_{side}") for i, _, n, _, _ in known for side in (1, 2)]).first()
    found, missed = [], []
    for i, c, n, _, _ in known:
        low, high = ends[f"_{i}_1"], ends[f"_{i}_2"]
        if low is None or high is None:
            missed.append(c)
        else:
            part = (n - 1) % 2 / 2
            found.append((c, low * (1 - part) + high * part))
    if not missed:
        return listed(found)
    long = table.unpivot([id_col], missed, "feature", "value")
    return listed(found).unionByName(group_percentiles(long, "feature", "value", id_col, {"median": 0.5}))


def impute_median(table: DataFrame, columns: tuple[str, ...], id_col: str) -> DataFrame:
    """Nulls of each column replaced by its exact median.

    The medians, one row per column, are read as a map; all columns share one range sort.
    """
    found = medians(table, columns, id_col)
    lookup = found.agg(F.map_from_entries(F.collect_list(F.struct("feature", "median")))).scalar()
    return (table.withColumn("_medians", lookup)
            .withColumns({c: F.coalesce(F.col(c), F.col("_medians")[c]) for c in columns})
            .drop("_medians"))


def dummies(table: DataFrame, column: str, values: tuple[str, ...]) -> DataFrame:
    """One 0/1 column per value, replacing ``column``."""
    flags = {f"{column}_{v}": F.when(F.col(column) == v, 1).otherwise(0) for v in values}
    return table.withColumns(flags).drop(column)


def standardize(table: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """``<column>_z``: centred and scaled by the sample standard deviation."""
    stats = table.agg(F.struct(
        *[F.avg(c).alias(f"{c}_mean") for c in columns],
        *[F.stddev_samp(c).alias(f"{c}_std") for c in columns])).scalar()
    return (table.withColumn("_stats", stats)
            .withColumns({f"{c}_z": F.try_divide(F.col(c) - F.col(f"_stats.{c}_mean"),
                                                 F.col(f"_stats.{c}_std")) for c in columns})
            .drop("_stats"))


def draw(id_col: str, seed: int) -> Column:
    """A fixed pseudo-random integer in [0, 2^32) per id, whatever the partitioning."""
    digest = F.md5(F.concat(F.col(id_col).cast("string"), F.lit(f"-{seed}")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")


def with_split(table: DataFrame, id_col: str, seed: int, train_share: float = 0.8) -> DataFrame:
    """``split`` = train or test, decided by the id alone."""
    limit = int(train_share * 2 ** 32)
    return table.withColumn(
        "split", F.when(draw(id_col, seed) < limit, "train").otherwise("test"))


def with_stratified_split(
    table: DataFrame, id_col: str, label: str, seed: int, train_share: float = 0.8
) -> DataFrame:
    """As ``with_split``, with the same share inside every class of ``label``.

    Each class is cut at its own position in one global order, so the shares
    are exact however unequal the classes are.
    """
    ranked = range_ranked(table.withColumn("_draw", draw(id_col, seed)), label, "_draw", id_col)
    classes = ranked.groupBy(label).agg(
        (F.min("rank") - 1).alias("_start"), F.count(F.lit(1)).alias("_n"))
    last = F.col("_start") + F.rint(F.col("_n") * float(train_share))
    ends = classes.select(F.struct(label, last.alias("last")).alias("e"))
    by_class = ends.agg(F.map_from_entries(F.collect_list("e"))).scalar()
    return (ranked.withColumn("_ends", by_class)
            .withColumn("split", F.when(F.col("rank") <= F.col("_ends")[F.col(label)], "train")
                        .otherwise("test"))
            .drop("_ends", "_draw", "_part", "rank", "total"))


def seeded_sample(table: DataFrame, id_col: str, seed: int, n: int) -> DataFrame:
    """A fixed-size random sample that depends only on the ids and the seed."""
    return (table.withColumn("_draw", draw(id_col, seed))
            .orderBy("_draw", id_col).limit(n).drop("_draw"))
