"""Load scaling: copies of a dataset with their own ids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def replicate(df: DataFrame, copies: int, id_cols: list[str]) -> DataFrame:
    """``copies`` times the rows of ``df``; ids get the suffix ``_0``, ``_1``, ...

    One scan followed by a row generator, with no join and no shuffle.
    """
    expanded = df.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
    suffixed = {c: F.concat(F.col(c).cast("string"), F.lit("_"), F.col("_copy").cast("string"))
                for c in id_cols}
    return expanded.withColumns(suffixed).drop("_copy")


def scale_factor(label: str):
    """The number in a scale label such as ``×10``."""
    return F.regexp_replace(label, "^×", "").cast("int")
