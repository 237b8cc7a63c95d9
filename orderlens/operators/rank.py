"""Global order without a single-partition window.

``range_ranked`` sorts a table across partitions once and numbers the rows:
the range exchange puts neighbouring keys together, each partition is sorted
locally, and a row's position is its place in the partition plus the number of
rows in the partitions before it. The sorted rows are staged, since the range
boundaries are sampled and must not move between the steps that use them.
The ordering columns must end with a unique id: it spreads tied values over
partitions and makes every rank reproducible.

Quantile scores need no order of the table, only the rows that end a bin: ``cut_rows``
selects those by counting keys.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StringType

from orderlens.stages import stage

# Fixed value: monotonically_increasing_id keeps the row number in its low 33 bits.
ROW_BITS = 33


def range_ranked(df: DataFrame, *order: Column | str) -> DataFrame:
    """``df`` with its range partition ``_part``, the 1-based ``rank`` and the row count ``total``."""
    placed = (df.repartitionByRange(*order)
              .sortWithinPartitions(*order)
              .withColumn("_seq", F.monotonically_increasing_id()))
    rows = stage(placed, "ranked").withColumn("_part", F.shiftright("_seq", ROW_BITS))
    before = _before(rows, {"_rows": F.count(F.lit(1))}, {"_rows": "total"})
    place = F.col("_seq") - F.shiftleft("_part", ROW_BITS) + 1
    return (rows.join(F.broadcast(before), "_part")
            .withColumn("rank", place + F.col("_rows"))
            .drop("_rows", "_seq"))


def _before(
    rows: DataFrame, sums: dict[str, Column], totals: dict[str, str] | None = None
) -> DataFrame:
    """Sums over all partitions before each one: one row per range partition.

    ``totals`` names columns for the sums over all partitions.
    """
    every = W.orderBy("_part").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    earlier = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    per_part = rows.groupBy("_part").agg(*[v.alias(k) for k, v in sums.items()])
    return per_part.select(
        "_part",
        *[F.coalesce(F.sum(k).over(earlier), F.lit(0)).alias(k) for k in sums],
        *[F.sum(k).over(every).alias(name) for k, name in (totals or {}).items()])


def running_sums(ranked: DataFrame, sums: dict[str, Column | str]) -> DataFrame:
    """Inclusive running sums in rank order over a ``range_ranked`` table.

    Each range partition is summed on its own and shifted by the partitions
    before it, so the window never holds more than one partition's rows.
    """
    inputs = {f"_in_{k}": (F.col(v) if isinstance(v, str) else v) for k, v in sums.items()}
    rows = ranked.withColumns(inputs)
    before = _before(rows, {f"_pre_{k}": F.sum(f"_in_{k}") for k in sums})
    upto = (W.partitionBy("_part").orderBy("rank")
            .rowsBetween(W.unboundedPreceding, W.currentRow))
    return (rows.withColumns({f"_loc_{k}": F.sum(f"_in_{k}").over(upto) for k in sums})
            .join(F.broadcast(before), "_part")
            .withColumns({k: F.col(f"_loc_{k}") + F.col(f"_pre_{k}") for k in sums})
            .drop(*inputs, *[f"_loc_{k}" for k in sums], *[f"_pre_{k}" for k in sums]))


def ntile_bin(rank: Column, n: Column, k: int) -> Column:
    """``ntile(k)`` of a rank among n: the first n % k bins hold one row more."""
    size = F.floor(n / k).cast("long")
    extra = n % k
    wide = extra * (size + 1)
    in_wide = F.floor((rank - 1) / (size + 1)) + 1
    in_narrow = F.floor((rank - 1 - wide) / F.greatest(size, F.lit(1))) + extra + 1
    return F.when(rank <= wide, in_wide).otherwise(in_narrow).cast("int")


def qcut_bin(rank: Column, n: Column, k: int) -> Column:
    """Bin 1..k of a rank among n by equal-frequency edges with linear interpolation."""
    edge = F.ceil((rank - 1) * k / F.greatest(n - 1, F.lit(1)))
    return F.greatest(F.lit(1), edge).cast("int")


def ntile_ends(n: Column, k: int) -> list[Column]:
    """Last rank in each of the first k - 1 ``ntile`` bins."""
    size = F.floor(n / k).cast("long")
    return [F.lit(j) * size + F.least(F.lit(j).cast("long"), n % k) for j in range(1, k)]


def qcut_ends(n: Column, k: int) -> list[Column]:
    """Last rank in each of the first k - 1 equal-frequency bins."""
    return [(F.floor(F.lit(j) * (n - 1) / k) + 1).cast("long") for j in range(1, k)]


@dataclass
class _Cut:
    """The last row of a bin: the ``rank``-th of a metric by (key, id); its key lies between ``low`` and ``high``."""

    metric: int
    rank: int
    low: float
    high: float
    key: float | None = None
    id: object = None


# Ids of equal keys are counted in so many ranges; a range of more rows is ranked, others are ordered in one task.
ID_RANGES, RANGE_ROWS = 1 << 14, 1_000_000


def _double(value: float) -> str:
    return f"CAST('{value!r}' AS DOUBLE)"


def _id_range(rows: DataFrame, low: object, high: object) -> str:
    """A coarse value that never falls along the ids: their range for numbers, their beginning for strings."""
    kind = rows.schema["id"].dataType
    if isinstance(kind, NumericType) and low is not None:
        return (f"coalesce(width_bucket(CAST(id AS DOUBLE), {_double(float(low))}, {_double(float(high))}, {ID_RANGES}), 0L)")
    return "substring(id, 1, 3)" if isinstance(kind, StringType) else "0"


def cut_rows(df: DataFrame, id_col: str, keys: list[Column], k: int, ends, accuracy: int = 10_000) -> list[_Cut]:
    """The rows that end the first k - 1 bins of each key, found by counting and without ranking the table.

    A quantile sketch gives keys that enclose every cut. One aggregate then counts the rows below
    them and, between them (some 4 / ``accuracy`` of the rows a cut), the rows of every key and id
    range; running sums over these counts name the key and the id range that hold the cut. Only
    the ids of that range are ordered. Cuts that the sketch misses are counted over all keys.
    """
    rows = df.select(F.col(id_col).alias("id"), *[c.alias(f"k{i}") for i, c in enumerate(keys)])
    margin = 2.0 / accuracy
    shares = [min(1.0, max(0.0, j / k + side * margin)) for side in (-1, 1) for j in range(1, k)]
    told = rows.agg(
        F.count(F.lit(1)).alias("n"), F.min("id").alias("first"), F.max("id").alias("last"),
        *[F.percentile_approx(f"k{i}", shares, accuracy).alias(f"q{i}") for i in range(len(keys))],
    ).withColumn("ends", F.array(*ends(F.col("n"), k))).first()
    if not told["n"]:
        return []
    cuts = [_Cut(i, told["ends"][j], told[f"q{i}"][j], told[f"q{i}"][k - 1 + j])
            for i in range(len(keys)) for j in range(k - 1)]
    id_range = _id_range(rows, told["first"], told["last"])
    missed = _locate(rows, cuts, id_range)
    for cut in missed:
        cut.low, cut.high = float("-inf"), float("nan")
    if missed:
        _locate(rows, missed, id_range)
    return cuts


def _locate(rows: DataFrame, cuts: list[_Cut], id_range: str) -> list[_Cut]:
    """Sets key and id of the cuts; returns those whose key lies outside their limits."""
    cells = ", ".join(
        f"CASE WHEN k{c.metric} < {_double(c.low)} THEN named_struct('cut', {n}, 'key', CAST(NULL AS DOUBLE), 'ids', NULL) "
        f"WHEN k{c.metric} <= {_double(c.high)} THEN named_struct('cut', {n}, 'key', k{c.metric}, 'ids', {id_range}) END"
        for n, c in enumerate(cuts))
    # Rows below a cut's limits are counted together, under a null key, which sorts first.
    counted = (rows.select("id", F.expr(f"explode(array_compact(array({cells})))").alias("c"))
               .groupBy("c.cut", "c.key", "c.ids").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("first"),
                                                       F.max("id").alias("last")))
    upto = F.sum("n").over(W.partitionBy("cut").orderBy("key", "ids"))
    wanted = F.array(*[F.lit(c.rank) for c in cuts])[F.col("cut")]
    found = (counted.withColumns({"upto": upto, "place": wanted - upto + F.col("n")})
             .filter((F.col("place") >= 1) & (F.col("place") <= F.col("n")) & F.col("key").isNotNull()).collect())
    hidden = []
    for row in found:
        cut = cuts[row["cut"]]
        cut.key = row["key"]
        cut.id = row["first"] if row["place"] == 1 else row["last"]
        if 1 < row["place"] < row["n"]:
            hidden.append((cut, row))
    if hidden:
        cells = ", ".join(f"CASE WHEN k{c.metric} = {_double(c.key)} AND {id_range} = "
                          f"{repr(r['ids']) if isinstance(r['ids'], int) else 'x' + chr(39) + r['ids'].encode().hex() + chr(39)} THEN {n} END"
                          for n, (c, r) in enumerate(hidden))
        own = rows.select("id", F.expr(f"explode(array_compact(array({cells})))").alias("cut"))
        places = F.array(*[F.lit(r["place"]) for _, r in hidden])[F.col("cut")]
        if max(r["n"] for _, r in hidden) > RANGE_ROWS:
            ranked = range_ranked(own, "cut", "id")
            starts = ranked.groupBy("cut").agg((F.min("rank") - 1).alias("start"))
            own = ranked.join(F.broadcast(starts), "cut").withColumn("place", F.col("rank") - F.col("start"))
        else:
            own = own.withColumn("place", F.row_number().over(W.partitionBy("cut").orderBy("id")))
        for row in own.filter(F.col("place") == places).select("cut", "id").collect():
            hidden[row["cut"]][0].id = row["id"]
    return [c for c in cuts if c.key is None]


def scores(
    df: DataFrame, id_col: str, metrics: dict[str, Column], k: int, ends=ntile_ends
) -> DataFrame:
    """``df`` plus one 1..k quantile score per metric (ascending, nulls first, ties by id).

    The k - 1 rows that end a bin are selected by counting keys, and scoring is a comparison
    with them in generated code: the table is neither sorted nor joined back.
    """
    keys = [F.coalesce(c.cast("double"), F.lit(float("-inf"))) for c in metrics.values()]
    cuts = cut_rows(df, id_col, keys, k, ends)

    def score(i: int) -> Column:
        passed = [F.when((keys[i] > c.key) | ((keys[i] == F.lit(c.key)) & (F.col(id_col) > F.lit(c.id))), 1).otherwise(0)
                  for c in cuts if c.metric == i]
        return (F.lit(1) + sum(passed, F.lit(0))).cast("int")

    # Expressions of the input's columns: a score may bear the name of one.
    return df.withColumns({m: score(i) for i, m in enumerate(metrics)})


def with_next(ranked: DataFrame, *columns: str) -> DataFrame:
    """``next_<column>``: the value in the following rank, null in the last one.

    Looks ahead within each range partition; the first row of every partition,
    one per partition, is broadcast to the row before it.
    """
    along = W.partitionBy("_part").orderBy("rank")
    heads = ranked.groupBy("_part").agg(
        F.min("rank").alias("_first"),
        *[F.min_by(c, "rank").alias(f"_head_{c}") for c in columns],
    ).withColumn("rank", F.col("_first") - 1).drop("_part", "_first")
    return (ranked.withColumns({f"next_{c}": F.lead(c).over(along) for c in columns})
            .join(F.broadcast(heads), "rank", "left")
            .withColumns({f"next_{c}": F.coalesce(f"next_{c}", f"_head_{c}") for c in columns})
            .drop(*[f"_head_{c}" for c in columns]))


def average_rank(df: DataFrame, value: str, id_col: str, group: str | None = None) -> DataFrame:
    """``df`` plus ``avg_rank`` (ties share their mean rank) among ``total`` rows, per group.

    Groups are few (features, classes): their sizes travel as one map. A tie group is bounded by its first and last rank. Groups are looked at per
    range partition; those that cross a boundary, at most one per boundary, are
    completed from a broadcast list.
    """
    keys = [group, value] if group else [value]
    ranked = range_ranked(df, *keys, id_col)
    tie = W.partitionBy("_part", *keys)
    local = ranked.withColumns({"_lo": F.min("rank").over(tie), "_hi": F.max("rank").over(tie)})
    # Only the first and the last value of a part can go on in another one.
    of = F.struct(*[F.col(k).alias(f"_of_{k}") for k in keys])
    edges = (ranked.groupBy("_part").agg(F.min_by(of, "rank").alias("head"), F.max_by(of, "rank").alias("tail"))
             .select(F.explode(F.array("head", "tail")).alias("e")).select("e.*").distinct())
    same = [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in keys]
    crossing = (ranked.join(F.broadcast(edges), same)
                .groupBy(*[f"_of_{k}" for k in keys])
                .agg(F.min("rank").alias("_lo_all"), F.max("rank").alias("_hi_all"),
                     F.min("_part").alias("_first"), F.max("_part").alias("_last"))
                .filter("_first < _last").drop("_first", "_last"))
    middle = (F.coalesce("_lo_all", "_lo") + F.coalesce("_hi_all", "_hi")) / 2.0
    found = (local.join(F.broadcast(crossing), same, "left")
             .withColumn("avg_rank", middle)
             .drop("_lo", "_hi", "_lo_all", "_hi_all", "_part", "rank",
                   *[f"_of_{k}" for k in keys]))
    if group is None:
        return found
    sizes = (ranked.groupBy(group).agg(F.struct((F.min("rank") - 1).alias("start"),
                                                F.count(F.lit(1)).alias("n")).alias("s"))
             .agg(F.map_from_entries(F.collect_list(F.struct(group, "s")))).scalar())
    return (found.withColumn("_size", sizes[F.col(group)]).withColumns({
        "total": F.col("_size.n"), "avg_rank": F.col("avg_rank") - F.col("_size.start")}).drop("_size"))


def group_percentiles(
    df: DataFrame, group: str, value: str, id_col: str, quantiles: dict[str, float]
) -> DataFrame:
    """Exact interpolated percentiles per group: one row per group, one column per quantile.

    The values are ranked across partitions by (group, value) and only the two rows around each
    wanted position are read off, so no task holds a group; these places (two per group and
    quantile) are broadcast.
    """
    rows = df.filter(F.col(value).isNotNull()).select(group, value, id_col)
    ranked = range_ranked(rows, group, value, id_col)
    groups = ranked.groupBy(group).agg(
        (F.min("rank") - 1).alias("_start"), F.count(F.lit(1)).alias("_n"))
    wanted = F.array(*[F.struct(F.lit(name).alias("name"), F.lit(float(q)).alias("q"))
                       for name, q in quantiles.items()])
    spots = (groups.select("*", F.explode(wanted).alias("_w"))
             .withColumn("_at", (F.col("_n") - 1) * F.col("_w.q"))
             .select(F.col(group).alias("_group"), F.col("_w.name").alias("_name"),
                     (F.col("_at") - F.floor("_at")).alias("_frac"),
                     F.explode(F.array(
                         F.struct(F.lit(0).alias("side"),
                                  (F.col("_start") + F.floor("_at") + 1).alias("rank")),
                         F.struct(F.lit(1).alias("side"),
                                  (F.col("_start") + F.ceil("_at") + 1).alias("rank")),
                     )).alias("_s"))
             .select("_group", "_name", "_frac", F.col("_s.side").alias("_side"),
                     F.col("_s.rank").alias("rank")))
    found = ranked.select("rank", F.col(value).cast("double").alias("_v")).join(F.broadcast(spots), "rank")
    ends = found.groupBy("_group", "_name", "_frac").agg(
        F.max(F.when(F.col("_side") == 0, F.col("_v"))).alias("_lo"),
        F.max(F.when(F.col("_side") == 1, F.col("_v"))).alias("_hi"))
    point = F.col("_lo") * (1 - F.col("_frac")) + F.col("_hi") * F.col("_frac")
    return (ends.withColumn("_p", point)
            .groupBy(F.col("_group").alias(group))
            .agg(*[F.max(F.when(F.col("_name") == name, F.col("_p"))).alias(name)
                   for name in quantiles]))


def percentile_value(df: DataFrame, value: str, id_col: str, q: float) -> Column:
    """One exact percentile of a whole column, as a scalar."""
    one = df.select(F.lit(0).alias("_all"), value, id_col)
    return group_percentiles(one, "_all", value, id_col, {"p": q}).select("p").scalar()
