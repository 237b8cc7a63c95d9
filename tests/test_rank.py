import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from orderlens.operators import rank


def table(spark, n, distinct=None, partitions=3):
    """n rows (id, v); v takes ``distinct`` values, a third of the rows share one of them."""
    rng = np.random.default_rng(n)
    v = rng.integers(0, distinct or 10 * n, n).astype(float)
    v[: n // 3] = v[0]
    rows = list(zip(range(n), v.tolist()))
    return spark.createDataFrame(rows, "id long, v double").repartition(partitions)


@pytest.mark.parametrize("n", [1, 4, 10, 57, 1234])
def test_scores_equal_the_single_partition_window(spark, n):
    df = table(spark, n, distinct=7)
    got = rank.scores(df, "id", {"s": F.col("v"), "d": -F.col("v")}, 5).toPandas()
    want = df.withColumn("s", F.ntile(5).over(W.orderBy("v", "id"))).withColumn(
        "d", F.ntile(5).over(W.orderBy(F.desc("v"), "id"))).toPandas()
    key = ["id"]
    pd.testing.assert_frame_equal(
        got.sort_values(key).reset_index(drop=True)[["id", "s", "d"]],
        want.sort_values(key).reset_index(drop=True)[["id", "s", "d"]], check_dtype=False)


@pytest.mark.parametrize("n", [3, 900, 30000])
@pytest.mark.parametrize("kind", ["long", "string", "date"])
def test_cuts_inside_ties_and_nulls(spark, monkeypatch, n, kind):
    """Null and equal keys over whole bins, ids of several types, a sketch that misses, ranges that are ranked."""
    number = F.col("id") * 7 % 100_003
    ids = {"long": number, "string": F.concat_ws("-", F.md5(number.cast("string")), F.lit("é")),
           "date": F.date_add(F.lit("1970-01-01").cast("date"), number.cast("int"))}[kind]
    df = spark.range(n).select(ids.alias("id"), F.when(F.col("id") % 3 > 0, F.col("id") % 5 * 1.0).alias("v"),
                               F.sin("id").alias("w"), F.lit(1.5).alias("same"))
    want = df.select("id", *[F.ntile(5).over(W.orderBy(c, "id")).alias(c) for c in ("v", "w", "same")])
    metrics = {c: F.col(c) for c in ("v", "w", "same")}
    expected = sorted(map(tuple, want.collect()))
    # The scores take the names of their inputs, and each is computed from the input.
    assert sorted(map(tuple, rank.scores(df, "id", metrics, 5).collect())) == expected
    monkeypatch.setattr(rank, "RANGE_ROWS", 2)
    assert sorted(map(tuple, rank.scores(df, "id", metrics, 5).collect())) == expected
    keys = [F.coalesce(c.cast("double"), F.lit(float("-inf"))) for c in metrics.values()]
    rough = rank.cut_rows(df, "id", keys, 5, rank.ntile_ends, accuracy=3)
    assert [(c.key, c.id) for c in rough] == [(c.key, c.id) for c in rank.cut_rows(df, "id", keys, 5, rank.ntile_ends)]
    assert rank.scores(df.limit(0), "id", metrics, 5).collect() == []


def test_scores_do_not_sort_the_table(spark):
    """Neither the scored table's plan nor the jobs that find the cuts hold a range exchange of it."""
    scored = rank.scores(table(spark, 5000, distinct=9), "id", {"s": F.col("v")}, 5)
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan and "Sort" not in plan and "Join" not in plan


@pytest.mark.parametrize("n", [1, 4, 10, 57, 1234])
def test_bins_from_ranks(spark, n):
    ranked = rank.range_ranked(table(spark, n, distinct=5), "v", "id")
    got = ranked.select("rank", rank.ntile_bin(F.col("rank"), F.col("total"), 5).alias("t"),
                        rank.qcut_bin(F.col("rank"), F.col("total"), 10).alias("q")
                        ).toPandas().sort_values("rank")
    assert got["rank"].tolist() == list(range(1, n + 1))
    sizes = [n // 5 + (i < n % 5) for i in range(5)]
    assert got["t"].tolist() == [i + 1 for i, s in enumerate(sizes) for _ in range(s)]
    if n > 1:
        cut = pd.qcut(got["rank"], 10, labels=False).tolist() if n >= 10 else None
        if cut:
            assert [q - 1 for q in got["q"].tolist()] == cut


@pytest.mark.parametrize("n", [10, 57, 1234])
def test_qcut_scores_equal_pandas(spark, n):
    df = table(spark, n, distinct=6)
    got = rank.scores(df, "id", {"s": F.col("v")}, 5, rank.qcut_ends).toPandas().sort_values("id")
    pdf = df.toPandas().sort_values(["v", "id"])
    pdf["s"] = pd.qcut(np.arange(1, n + 1), 5, labels=False) + 1
    assert got["s"].tolist() == pdf.sort_values("id")["s"].tolist()


def test_decile_sizes_of_the_published_table(spark):
    ranked = spark.range(1, 10968).select(
        rank.qcut_bin(F.col("id"), F.lit(10967), 10).alias("bin"))
    sizes = [r["count"] for r in ranked.groupBy("bin").count().orderBy("bin").collect()]
    assert sizes == [1097, 1097, 1096, 1097, 1097, 1096, 1097, 1096, 1097, 1097]


@pytest.mark.parametrize("partitions", [1, 3, 8])
def test_result_does_not_depend_on_partitions(spark, partitions):
    df = table(spark, 500, distinct=4, partitions=partitions)
    ranked = rank.range_ranked(df, F.desc("v"), "id").select("id", "v", "rank").toPandas()
    want = df.toPandas().sort_values(["v", "id"], ascending=[False, True])
    assert ranked.sort_values("rank")["id"].tolist() == want["id"].tolist()


def many_parts(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    return lambda: spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


@pytest.mark.parametrize("distinct", [1, 3, 1000])
def test_average_rank_and_running_sums_over_many_parts(spark, distinct):
    restore = many_parts(spark)
    try:
        df = table(spark, 700, distinct=distinct)
        got = rank.average_rank(df, "v", "id").toPandas().sort_values("id")
        ranked = rank.range_ranked(df, "v", "id")
        assert ranked.select("_part").distinct().count() > 1
        sums = rank.running_sums(ranked, {"s": "id"}).toPandas().sort_values("rank")
    finally:
        restore()
    pdf = df.toPandas().sort_values("id")
    assert got["avg_rank"].tolist() == pdf["v"].rank().tolist()
    assert sums["s"].tolist() == sums["id"].cumsum().tolist()


@pytest.mark.parametrize("distinct", [1, 4, 1000])
def test_next_values_and_grouped_ranks_over_many_parts(spark, distinct):
    restore = many_parts(spark)
    try:
        df = table(spark, 600, distinct=distinct).withColumn("g", F.col("id") % 5 == 0)
        ranked = rank.range_ranked(df, "v", "id")
        ahead = rank.with_next(ranked, "id").toPandas().sort_values("rank")
        grouped = rank.average_rank(df, "v", "id", "g").toPandas().sort_values("id")
    finally:
        restore()
    assert ahead["next_id"].tolist()[:-1] == ahead["id"].tolist()[1:]
    assert np.isnan(ahead["next_id"].tolist()[-1])
    pdf = df.toPandas().sort_values("id")
    assert grouped["avg_rank"].tolist() == pdf.groupby("g")["v"].rank().tolist()
    assert set(grouped["total"]) == {120, 480}


def test_group_percentiles_are_exact(spark):
    df = table(spark, 400, distinct=50).withColumn("g", F.col("id") % 3)
    got = rank.group_percentiles(df, "g", "v", "id", {"p25": 0.25, "p95": 0.95}).toPandas()
    want = df.toPandas().groupby("g")["v"].quantile([0.25, 0.95]).unstack()
    for row in got.itertuples():
        assert row.p25 == pytest.approx(want.loc[row.g, 0.25], abs=1e-9)
        assert row.p95 == pytest.approx(want.loc[row.g, 0.95], abs=1e-9)


def test_string_ids(spark):
    rows = [(f"c{i}", float(i % 2)) for i in range(20)]
    df = spark.createDataFrame(rows, "id string, v double")
    got = rank.scores(df, "id", {"s": F.col("v")}, 4)
    want = df.withColumn("s", F.ntile(4).over(W.orderBy("v", "id")))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
