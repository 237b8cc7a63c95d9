"""Stage tables: results written once to the shared folder and read back.

A stage cuts the lineage and fixes the rows: a lost executor re-reads files
instead of recomputing the scan and the shuffles before it, and a table used
by several later steps is computed once.

The folder is ``spark.checkpoint.dir``; where that is unset, the warehouse
folder, which Spark shares between executors as well. A folder of the local
machine is accepted only when the executors run on it.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession


# Paths made inside ``scope`` blocks, one list a block.
_scopes: list[list[str]] = []


def shared_folder(spark: SparkSession) -> str:
    """Folder for stage tables: ``spark.checkpoint.dir``, else the warehouse folder."""
    configured = (spark.conf.get("spark.checkpoint.dir", None)
                  or spark.conf.get("spark.sql.warehouse.dir"))
    local = spark.sparkContext.master.startswith("local")
    if configured.startswith("file:") and not local:
        raise ValueError(f"{configured} is a folder of one machine; "
                         "set spark.checkpoint.dir to a folder that all executors share")
    return configured.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path for one table or model in the shared folder."""
    app = spark.sparkContext.applicationId
    path = f"{shared_folder(spark)}/orderlens/{app}/{name}-{uuid.uuid4().hex}"
    for made in _scopes:
        made.append(path)
    return path


def stage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and return the table read back."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def at_once(spark: SparkSession, work: Callable, parts: Iterable) -> list:
    """``work`` on a few independent parts, in their order, whose Spark jobs run beside each other.

    For parts made of many short jobs, which leave cores idle when they run one after the other.
    """
    parts = list(parts)
    with ThreadPool(max(1, len(parts))) as pool:
        # Each thread takes on the caller's job group and tags, as in MLlib's CrossValidator.
        return pool.map(inheritable_thread_target(spark)(work), parts, 1)


def remove(spark: SparkSession, path: str) -> None:
    """Delete one path of the shared folder through the Hadoop file system."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)


@contextmanager
def scope(spark: SparkSession) -> Iterator[None]:
    """Deletes the stages made inside the block at its end, also after an error; results must be saved in it."""
    made: list[str] = []
    _scopes.append(made)
    try:
        yield
    finally:
        _scopes.remove(made)
        for path in made:
            remove(spark, path)


def release(spark: SparkSession) -> None:
    """Delete every stage of this session's application; results built on them must be saved by then."""
    remove(spark, f"{shared_folder(spark)}/orderlens/{spark.sparkContext.applicationId}")
