"""K-Means segments, their profiles and names, value tables, revenue concentration."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from orderlens.functions.buckets import position_in
from orderlens.functions.labels import SEGMENT_ORDER, segment_label
from orderlens.functions.numbers import MONEY, exact_avg, exact_sum, percent, round_even
from orderlens.operators.rank import group_percentiles, range_ranked
from orderlens.settings import Settings

MEASURES = ("Recency", "Frequency", "Monetary")
QUANTILE_NAMES = {0.25: "P25", 0.5: "Median", 0.75: "P75", 0.95: "P95"}


def scaled_measures(rfm: DataFrame) -> DataFrame:
    """RFM with its three measures as one centred and scaled vector."""
    model = Pipeline(stages=[
        VectorAssembler(inputCols=list(MEASURES), outputCol="features_raw"),
        StandardScaler(inputCol="features_raw", outputCol="features",
                       withStd=True, withMean=True),
    ]).fit(rfm)
    return model.transform(rfm).drop("features_raw")


def kmeans_selection(rfm: DataFrame, settings: Settings) -> DataFrame:
    """Within-cluster cost and silhouette for each k."""
    scaled = scaled_measures(rfm).persist(StorageLevel.MEMORY_AND_DISK)
    quality = ClusteringEvaluator(featuresCol="features", predictionCol="prediction",
                                  metricName="silhouette", distanceMeasure="squaredEuclidean")
    rows = []
    for k in settings.k_range:
        model = KMeans(k=k, seed=settings.seed, featuresCol="features").fit(scaled)
        rows.append((k, model.summary.trainingCost, quality.evaluate(model.transform(scaled))))
    scaled.unpersist()
    return rfm.sparkSession.createDataFrame(rows, "k int, WSSSE double, Silhouette double")


def kmeans_fit(rfm: DataFrame, settings: Settings, max_iter: int = 20) -> tuple[DataFrame, list[list[float]], float]:
    """RFM with ``segment`` and its scaled measures (``<measure>_z``), the centres, and the cost that the fit reports."""
    scaled = scaled_measures(rfm).persist(StorageLevel.MEMORY_AND_DISK)
    model = KMeans(k=settings.k_final, seed=settings.seed, maxIter=max_iter,
                   featuresCol="features", predictionCol="segment").fit(scaled)
    place = vector_to_array("features")
    clustered = model.transform(scaled).withColumns({f"{m}_z": place[i] for i, m in enumerate(MEASURES)}).drop("features")
    scaled.unpersist()
    return clustered, [[float(x) for x in c] for c in model.clusterCenters()], model.summary.trainingCost


def kmeans_segments(rfm: DataFrame, settings: Settings, max_iter: int = 20) -> DataFrame:
    """RFM with the cluster number ``segment`` of the final K-Means."""
    return kmeans_fit(rfm, settings, max_iter)[0].drop(*[f"{m}_z" for m in MEASURES])


def certificate(clustered: DataFrame, centres: list[list[float]], slack: float = 1e-9) -> DataFrame:
    """One row: the customers, those whose cluster is not a nearest centre, and the cost of the assignment.

    The distances to the centres are recomputed from the scaled measures, one column a centre.
    """
    def distance(centre: list[float]) -> Column:
        return sum((F.pow(F.col(f"{m}_z") - x, F.lit(2)) for m, x in zip(MEASURES, centre)), F.lit(0.0))

    own = F.get(F.col("_d"), F.col("segment"))
    return clustered.withColumn("_d", F.array(*[distance(c) for c in centres])).agg(
        F.count(F.lit(1)).alias("customers"),
        F.count_if(own.isNull() | (own > F.array_min("_d") + slack)).alias("misplaced"), F.sum(own).alias("cost"))


def cluster_moments(clustered: DataFrame, columns: tuple[str, ...], cluster: str = "segment") -> DataFrame:
    """Size, sums and sum of squares of each cluster: what its mean distances follow from."""
    return clustered.groupBy(cluster).agg(
        F.count(F.lit(1)).alias("n"), F.array(*[F.sum(c) for c in columns]).alias("sums"),
        F.sum(sum((F.col(c) * F.col(c) for c in columns), F.lit(0.0))).alias("squares"))


def silhouette(clustered: DataFrame, columns: tuple[str, ...], cluster: str = "segment") -> DataFrame:
    """Mean silhouette by squared distances, in two aggregates: moments of the clusters (k rows) and a mean.

    The mean squared distance of x to a cluster is |x|^2 - 2 x S / n + Q / n, with its sums S and its
    sum of squares Q. A customer alone in its cluster has silhouette 0; one cluster has none.
    """
    moments = (cluster_moments(clustered, columns, cluster)
               .agg(F.collect_list(F.struct(F.col(cluster).alias("c"), "n", "sums", "squares"))).scalar())
    square = sum((F.col(c) * F.col(c) for c in columns), F.lit(0.0))

    def mean_distance(m: Column) -> Column:
        inner = sum((F.col(c) * m["sums"][i] for i, c in enumerate(columns)), F.lit(0.0))
        return F.greatest(square - 2.0 * inner / m["n"] + m["squares"] / m["n"], F.lit(0.0))

    mine = F.filter("_m", lambda m: m["c"] == F.col(cluster))[0]
    inside = mean_distance(mine) * mine["n"] / F.nullif(mine["n"] - 1, F.lit(0))
    nearest = F.array_min(F.transform(F.filter("_m", lambda m: m["c"] != F.col(cluster)), mean_distance))
    value = F.when(mine["n"] == 1, F.lit(0.0)).otherwise(F.coalesce(
        F.try_divide(nearest - inside, F.greatest(nearest, inside)), F.when(nearest.isNotNull(), F.lit(0.0))))
    return clustered.withColumn("_m", moments).agg(F.avg(value).alias("silhouette"))


def silhouette_selection(rfm: DataFrame, settings: Settings) -> DataFrame:
    """The silhouette of each k twice: by MLlib's evaluator and from cluster moments."""
    scaled = scaled_measures(rfm).persist(StorageLevel.MEMORY_AND_DISK)
    quality = ClusteringEvaluator(featuresCol="features", predictionCol="segment")
    place = vector_to_array("features")
    names, rows = tuple(f"{m}_z" for m in MEASURES), []
    for k in settings.k_range:
        found = KMeans(k=k, seed=settings.seed, featuresCol="features", predictionCol="segment").fit(scaled).transform(scaled)
        wide = found.withColumns({n: place[i] for i, n in enumerate(names)})
        rows.append((k, quality.evaluate(found), silhouette(wide, names).first()["silhouette"]))
    scaled.unpersist()
    return rfm.sparkSession.createDataFrame(rows, "k int, evaluator double, moments double")


def segment_profile(clustered: DataFrame, settings: Settings) -> DataFrame:
    """Mean measures, size, share and name of each cluster."""
    means = clustered.groupBy("segment").agg(
        *[exact_avg(m).alias(f"Avg_{m}") for m in MEASURES],
        F.count(F.lit(1)).alias("Count"))
    total = F.sum("Count").over(W.partitionBy())
    return means.withColumns({
        "Segment_Label": segment_label(F.col("Avg_Frequency"), F.col("Avg_Recency"), settings),
        "Share_pct": percent(F.col("Count"), total, 1)}).orderBy("segment")


def name_segments(clustered: DataFrame, profile: DataFrame) -> DataFrame:
    """Clustered customers with the name of their cluster (k rows are broadcast)."""
    names = profile.select("segment", "Segment_Label")
    return clustered.join(F.broadcast(names), "segment")


def _value_measures() -> list:
    return [F.count(F.lit(1)).alias("Customers"),
            exact_sum("Monetary").alias("Revenue"),
            exact_avg("Monetary").alias("Mean_Monetary")]


def _with_shares(values: DataFrame) -> DataFrame:
    every = W.partitionBy()
    revenue = F.sum(F.col("Revenue").cast(MONEY)).over(every)
    return values.withColumns({
        "Customer_Share_pct": percent(F.col("Customers"), F.sum("Customers").over(every), 1),
        "Revenue_Share_pct": percent(F.col("Revenue"), revenue, 1),
        "Segment_Order": position_in(F.col("Segment_Label"), SEGMENT_ORDER),
    }).orderBy("Segment_Order")


def segment_value(segmented: DataFrame, settings: Settings) -> DataFrame:
    """Size, revenue, exact spending percentiles and shares per segment."""
    names = {QUANTILE_NAMES.get(q, f"P{q * 100:g}"): q for q in settings.quantiles}
    spread = group_percentiles(
        segmented, "Segment_Label", "Monetary", "customer_unique_id", names)
    totals = segmented.groupBy("Segment_Label").agg(*_value_measures())
    return _with_shares(totals.join(spread, "Segment_Label"))


def segment_value_approx(segmented: DataFrame, settings: Settings, accuracy: int = 10000) -> DataFrame:
    """As ``segment_value`` with sketched percentiles: one aggregate, no sort."""
    sketch = F.percentile_approx("Monetary", list(settings.quantiles), accuracy)
    totals = segmented.groupBy("Segment_Label").agg(*_value_measures(), sketch.alias("_q"))
    return _with_shares(totals.withColumns({
        QUANTILE_NAMES.get(q, f"P{q * 100:g}"): F.col("_q")[i]
        for i, q in enumerate(settings.quantiles)}).drop("_q"))


def segment_share_long(values: DataFrame) -> DataFrame:
    """The two share columns as (segment, metric, percent) rows."""
    return values.unpivot(["Segment_Label"], ["Customer_Share_pct", "Revenue_Share_pct"],
                          "Metric", "Percent")


def pareto(rfm: DataFrame, points: tuple[int, ...]) -> DataFrame:
    """Revenue share of the top p percent of customers, for each p.

    After the global ranking one pass sums the revenue above every cut-off.
    An empty top set has a share of 0.
    """
    ranked = range_ranked(rfm.select("Monetary", "customer_unique_id"),
                          F.desc("Monetary"), "customer_unique_id")

    def top(p: int) -> Column:
        chosen = exact_sum(f"CASE WHEN rank <= FLOOR(total * {p} / 100) THEN Monetary END")
        return F.coalesce(chosen, F.lit(0.0))

    sums = ranked.agg(exact_sum("Monetary").alias("_all"),
                      *[top(p).alias(f"_top{p}") for p in points])
    rows = F.array(*[F.struct(F.lit(p).alias("Top_pct"),
                              percent(F.col(f"_top{p}"), F.col("_all")).alias("Revenue_pct"))
                     for p in points])
    return sums.select(F.explode(rows).alias("r")).select(
        "r.Top_pct", "r.Revenue_pct",
        round_even(F.col("r.Revenue_pct"), 1).alias("Revenue_pct_1d"))


def histogram(table: DataFrame, columns: tuple[str, ...], bins: int) -> DataFrame:
    """Equal-width counts of each column between its minimum and maximum, empty bins included.

    Nulls are counted beside the bins: in a bin -1 without a start, for the columns that have any.
    """
    limits = table.agg(F.struct(
        *[F.min(c).cast("double").alias(f"{c}_lo") for c in columns],
        *[F.max(c).cast("double").alias(f"{c}_hi") for c in columns])).scalar()
    cells = F.array(*[F.struct(
        F.lit(c).alias("metric"), F.col(c).cast("double").alias("value"),
        F.col(f"_l.{c}_lo").alias("lo"), F.col(f"_l.{c}_hi").alias("hi")) for c in columns])
    long = table.withColumn("_l", limits).select(F.explode(cells).alias("c")).select("c.*")
    width = (F.col("hi") - F.col("lo")) / float(bins)
    place = F.coalesce(F.floor(F.try_divide(F.col("value") - F.col("lo"), width)), F.lit(0))
    at = F.when(F.col("value").isNull(), F.lit(-1)).otherwise(F.least(place, F.lit(bins - 1)))
    found = (long.withColumn("bin", at.cast("int"))
             .groupBy("metric", "bin").agg(F.count(F.lit(1)).alias("customers")))
    # All bins of all columns, a fixed list that the counts are looked up for.
    edges = (table.sparkSession.range(bins).withColumn("_l", limits)
             .select(F.col("id").cast("int").alias("bin"), F.explode(F.array(*[F.struct(
                 F.lit(c).alias("metric"), F.col(f"_l.{c}_lo").alias("lo"), F.col(f"_l.{c}_hi").alias("hi"))
                 for c in columns])).alias("e")).select("bin", "e.*"))
    filled = edges.join(F.broadcast(found), ["metric", "bin"], "left").select(
        "metric", "bin", F.coalesce("customers", F.lit(0)).alias("customers"),
        (F.col("lo") + F.col("bin") * width).alias("bin_start"))
    nulls = found.filter("bin = -1").select("metric", "bin", "customers", F.lit(None).cast("double").alias("bin_start"))
    return filled.unionByName(nulls)
