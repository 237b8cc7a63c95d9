"""The corpus pipeline: documents through five operators, each stage written and read again.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor kept and
returns a DataFrame; all but the last return the columns of documents.

* quality: documents that the classifier rejects (low quality or toxic) go. It is
  fitted on the label rows of the documents given.
* line_dedup: lines that a document with a smaller id has already go.
* near_dedup: of each group of texts linked by SimHash fingerprints of 3-word shingles that
  differ in at most 3 of 64 bits the smallest id stays. Of rows with the same id and text
  one stays; of near copies that all lack an id, all stay.
* decontaminate: words inside benchmark passages go; the documents stay.
* packing: the texts as token ids in sequences, one row per piece.

``n_chars`` follows the text. A null text stays null until lines are judged, and is
empty from then on. Rows without an id are kept or judged like any other; they come
after all ids. Empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from orderlens import stages
from orderlens.llm import fmindex, hamming, lines, packing
from orderlens.llm import quality as views
from orderlens.llm import text as T

# The lines, the neighbours and the sequences cannot all be said in SQL; see tests/llm/test_pipeline.py.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    score = max(docs.columns, key=len) + "_score"
    judged = views.score(docs, views.fit(docs, labels), name=score)
    return judged.filter(F.col(f"`{score}`")["keep"]).select([F.col(f"`{c}`") for c in docs.columns])


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    kept = lines.dedup_lines(docs)
    return kept.select(T.row_fields(kept, text=F.col("kept"),
                                    n_chars=F.char_length("kept").cast("long")))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row stays when its id is its group's smallest; of equal rows one stays."""
    first = (hamming.near_groups(docs, words=3, radius=3).filter(F.col("_id").eqNullSafe(F.col("component")))
             .select(F.coalesce("_id", F.lit(T.LAST_ID)).alias("_id"), "_key").distinct())
    table = T.documents(docs).withColumn("_key", F.xxhash64("_text"))
    same = W.partitionBy("_id", "_key").orderBy("_key")
    kept = (table.join(first, ["_id", "_key"], "left_semi")
            .withColumn("_place", F.row_number().over(same)).filter("_place = 1"))
    return kept.select(T.row_fields(kept))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    kept = fmindex.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return kept.select(T.row_fields(kept, text=F.col("kept"),
                                    n_chars=F.char_length("kept").cast("long")))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs).select(
        F.col("_id").alias("doc_id"), "start", "length", F.crc32("ids").alias("ids_crc32"),
        "doc_tokens", "sequence_id", "offset")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and read again.

    What the stages wrote stays until ``stages.release``: the result is read from it.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES:
        docs = stages.stage(step(spark, docs, sf_dir), name)
    return docs
