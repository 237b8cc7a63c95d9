"""Small helpers shared by the corpus operators.

Every operator works on three internal columns: ``_id``, ``_text`` and ``_row``.
``_row`` is a struct of all input columns, so extra columns never clash with
an operator's own, and a stage can give the document back unchanged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The white space and the letters that the text rules name.
SPACES = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# Rows without an id come after all others and count as one document.
LAST_ID = 2**63 - 1


def documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``_id`` (null: after all others), ``_text`` (null: empty) and ``_row``, the whole input row."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    return docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(LAST_ID)).alias("_id"),
        F.coalesce(F.col(text_col), F.lit("")).alias("_text"), row.alias("_row"))


def lower_az(text: Column) -> Column:
    """A-Z to a-z and nothing else. For pure ASCII text that is ``lower``, which is far faster."""
    ascii_only = F.octet_length(text) == F.char_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def wide_hash(value: Column) -> tuple[Column, Column]:
    """Two 64-bit hashes with different seeds: together they tell 1e15 values apart."""
    return F.xxhash64(value), F.xxhash64(F.lit("second"), value)


def row_fields(docs: DataFrame, **changed: Column) -> list[Column]:
    """The input columns of a table in internal form, some of them replaced."""
    names = docs.schema["_row"].dataType.names
    return [changed[n].alias(n) if n in changed else F.col("_row")[n].alias(n) for n in names]
