"""CSV and Parquet scans with fixed schemas, result sinks, optional tables."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from orderlens.functions.regions import region_table
from orderlens.sources.contracts import SCHEMAS, OrderTables

TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"


def header_columns(spark: SparkSession, path: str) -> list[str]:
    """Column names of a CSV file (reads its first line only)."""
    return spark.read.option("header", True).csv(path).columns


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    timestamp_format: str = TIMESTAMP_FORMAT,
    mode: str = "FAILFAST",
    multi_line: bool = False,
) -> DataFrame:
    """Scan a CSV file with a header, keeping the schema's columns by name.

    No inference pass over the data: the file's own columns are taken from its
    header, those of the schema get their types, the others are not parsed. The
    header of every file of a folder must be the same, else Spark raises; so it does for a
    malformed value, unless ``mode`` is PERMISSIVE (null) or DROPMALFORMED.
    """
    types = {field.name: field.dataType for field in schema}
    found = header_columns(spark, path)
    full = T.StructType([T.StructField(c, types.get(c, T.StringType())) for c in found])
    return (spark.read.schema(full)
            .options(header=True, enforceSchema=False, mode=mode, multiLine=multi_line,
                     timestampFormat=timestamp_format)
            .csv(path)
            .select(*[f.name for f in schema]))


def read_order_tables(spark: SparkSession, paths: dict[str, str]) -> OrderTables:
    """Load the seven order tables from CSV, given the path of each."""
    loaded = {name: read_csv(spark, paths[name], schema) for name, schema in SCHEMAS.items()}
    return OrderTables(regions=region_table(spark), **loaded)


def write_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """Write a result as CSV; ``single_file`` is for the short reports."""
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").option("header", True).csv(path)


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def load_if_present(
    spark: SparkSession, path: str, fmt: str = "parquet", schema: T.StructType | None = None
) -> DataFrame | None:
    """The table at ``path``, or None when nothing has been written there."""
    reader = spark.read.format(fmt)
    try:
        if fmt == "csv":
            if schema is None:
                raise ValueError("a CSV table needs its schema")
            return read_csv(spark, path, schema)
        return (reader.schema(schema) if schema is not None else reader).load(path)
    except AnalysisException as err:
        if err.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
