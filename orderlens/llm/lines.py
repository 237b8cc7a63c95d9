"""Line dedup over levelled sorted runs of line hashes.

Documents are taken in batches of ascending ids. A run is a table of line
hashes, bucketed and sorted by hash. Each batch merge-anti-joins all runs, adds
the hashes it saw first as a new run of level 0, and ``fanout`` runs of one
level are compacted into one run of the next. Because earlier batches hold the
smaller ids, a line stays exactly in the document that has its key first.

Defined cases: a null text is empty, an empty text is one empty line; rows with
the same id count as one document, rows without an id as one document after all
others; a key shorter than ``min_chars`` is never dropped.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens import stages
from orderlens.llm import text as T

HASH = ["h1", "h2"]


def line_key(line: Column) -> Column:
    return T.lower_az(F.btrim(line, F.lit(T.SPACES)))


class Runs:
    """The levels of sorted runs, as bucketed tables in the shared folder."""

    def __init__(self, spark: SparkSession, fanout: int):
        self.spark, self.fanout = spark, fanout
        self.levels: list[list[str]] = []
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.paths: dict[str, str] = {}

    def unseen(self, keys: DataFrame) -> DataFrame:
        """The keys that no run holds."""
        for level in self.levels:
            for run in level:
                keys = keys.join(self.spark.table(run).hint("merge"), HASH, "left_anti")
        return keys

    def write(self, keys: DataFrame) -> str:
        name = f"line_run_{uuid.uuid4().hex}"
        self.paths[name] = stages.new_path(self.spark, name)
        (keys.repartition(self.buckets, *HASH).write.bucketBy(self.buckets, *HASH).sortBy(*HASH)
         .option("path", self.paths[name]).format("parquet").saveAsTable(name))
        return name

    def add(self, keys: DataFrame) -> None:
        """Add a new run and compact full levels."""
        run = self.write(keys.select(*HASH))
        for depth in range(len(self.levels) + 1):
            if depth == len(self.levels):
                self.levels.append([])
            self.levels[depth].append(run)
            if len(self.levels[depth]) < self.fanout:
                return
            full, self.levels[depth] = self.levels[depth], []
            merged = self.spark.table(full[0])
            for other in full[1:]:
                merged = merged.union(self.spark.table(other))
            run = self.write(merged)
            for old in full:
                self.drop(old)

    def drop(self, run: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {run}")
        stages.remove(self.spark, self.paths.pop(run))

    def close(self) -> None:
        for run in list(self.paths):
            self.drop(run)


def dedup_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 10,
    batches: int = 4, fanout: int = 3,
) -> DataFrame:
    """``_id``, ``_row`` (the input row), ``n_lines``, ``n_dropped`` and ``kept``, the joined lines left."""
    spark = docs.sparkSession
    table = T.documents(docs, id_col, text_col).withColumn("_fp", F.xxhash64("_text"))
    shares = [i / batches for i in range(1, batches)]
    bounds = table.agg(F.percentile_approx("_id", shares)).first()[0] or []
    batch = sum((F.when(F.col("_id") > b, 1).otherwise(0) for b in bounds), F.lit(0))

    lines = (table.select("_id", "_fp", batch.alias("batch"), F.posexplode(F.split("_text", "\n", -1)))
             .withColumn("key", line_key(F.col("col")))
             .filter(F.char_length("key") >= min_chars))
    first, second = T.wide_hash(F.col("key"))
    hashes = spark.createDataFrame([], "_id long, _fp long, pos int, h1 long, h2 long, batch int")
    path = stages.new_path(spark, "lines")
    (lines.select("_id", "_fp", "pos", first.alias("h1"), second.alias("h2"), "batch")
     .write.partitionBy("batch").parquet(path))
    staged = spark.read.schema(hashes.schema).parquet(path)

    runs, lost = Runs(spark, fanout), stages.new_path(spark, "lost_lines")
    for b in range(len(bounds) + 1):
        part = staged.filter(F.col("batch") == b).drop("batch")
        fresh = stages.new_path(spark, "fresh_lines")
        runs.unseen(part.groupBy(*HASH).agg(F.min("_id").alias("_id"))).write.parquet(fresh)
        owners = spark.read.schema("h1 long, h2 long, _id long").parquet(fresh)
        # The document is part of the join key, so a line that every document has is spread out.
        (part.join(owners, [*HASH, "_id"], "left_anti")
         .groupBy("_id", "_fp").agg(F.sort_array(F.collect_set("pos")).alias("lost"))
         .write.mode("append").parquet(lost))
        if b < len(bounds):
            runs.add(owners)
        stages.remove(spark, fresh)
    runs.close()
    stages.remove(spark, path)

    found = spark.read.schema("_id long, _fp long, lost array<int>").parquet(lost)
    return (table.join(found, ["_id", "_fp"], "left")
            .withColumn("_lines", F.split("_text", "\n", -1))
            .select("_id", "_row", F.size("_lines").cast("long").alias("n_lines"),
                    F.coalesce(F.size("lost"), F.lit(0)).cast("long").alias("n_dropped"),
                    F.when(F.col("lost").isNull(), F.col("_text"))
                    .otherwise(F.array_join(without(F.col("_lines"), F.col("lost")), "\n"))
                    .alias("kept")))


def without(items: Column, lost: Column) -> Column:
    """``items`` without the sorted 0-based positions ``lost``: the slices between them, in one pass."""
    edges = F.concat(F.array(F.lit(-1)), lost, F.array(F.size(items)))
    gaps = F.transform(F.sequence(F.lit(0), F.size(lost)), lambda i: F.slice(
        items, F.element_at(edges, i + 1) + 2,
        F.element_at(edges, i + 2) - F.element_at(edges, i + 1) - 1))
    return F.flatten(gaps)
