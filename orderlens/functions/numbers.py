"""Sums that do not depend on row order, guarded ratios, half-even rounding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Sums of sums: room for 10^32 units at six decimals.
MONEY = "decimal(38,6)"
# A value is split into blocks of 2^20 units, whole units and a fraction.
BLOCK = 2 ** 20
# Whole numbers up to this one are doubles.
EXACT = 2 ** 53


def exact_sum(sql: str, digits: int = 6) -> Column:
    """Sum of a SQL expression that is the same for any partitioning, to ``digits`` decimals.

    Values are rounded to ``digits`` decimals (at most 9; use ``F.sum`` for finer ones) and added
    in three long sums: blocks of 2^20 units, units within a block, and fractions. Values up to 1e21
    and 9e18 / 10^digits rows a group fit; the parts meet once a group, in a long where they are
    small and else in a decimal, so the result is the double nearest to the exact sum.
    """
    scale = 10 ** digits
    value = f"CAST(({sql}) AS DOUBLE)"
    block = f"CAST(FLOOR({value} / {BLOCK}D) AS BIGINT)"
    rest = f"CAST(RINT(({value} - FLOOR({value} / {BLOCK}D) * {BLOCK}D) * {scale}D) AS BIGINT)"
    blocks, units = f"SUM({block})", f"SUM({rest} DIV {scale})"
    fractions = f"SUM({rest} % {scale})"
    whole = f"CAST({blocks} AS DECIMAL(25,0)) * {BLOCK} + {units} + {fractions} DIV {scale}"
    part = f"CAST({fractions} % {scale} AS DECIMAL({digits + 1},0)) / {scale}"
    nearest = f"CAST(CAST({whole} AS DECIMAL({37 - digits},0)) + CAST({part} AS DECIMAL({digits + 2},{digits})) AS DOUBLE)"
    # A total of at most 2^53 / scale units is a whole number of fractions that a double holds: one division rounds it alike.
    room = EXACT // scale
    small = (f"ABS({blocks}) <= {room * 4 // 10 // BLOCK} AND {units} <= {room * 4 // 10}"
             f" AND {fractions} <= {room // 10 * scale}")
    total = f"({blocks} * {BLOCK} + {units}) * {scale} + {fractions}"
    return F.expr(f"CASE WHEN {small} THEN CAST({total} AS DOUBLE) / {scale}D ELSE {nearest} END")


def exact_avg(sql: str) -> Column:
    """Mean of the non-null values from the exact sum; null when there are none."""
    return F.try_divide(exact_sum(sql), F.count(F.expr(sql)))


def share(condition: str) -> Column:
    """Share of true among the rows where a SQL condition is not null."""
    return F.expr(f"TRY_DIVIDE(CAST(COUNT_IF({condition}) AS DOUBLE), COUNT({condition}))")


def round_even(col: Column, digits: int = 0) -> Column:
    """Round half to even by scaling, as NumPy does for report columns."""
    scale = float(10 ** digits)
    return F.rint(col * scale) / scale


def percent(part: Column, whole: Column, digits: int | None = None) -> Column:
    """``part`` as a percentage of ``whole``; null when ``whole`` is zero."""
    value = F.try_divide(part.cast("double"), whole.cast("double")) * 100.0
    return value if digits is None else round_even(value, digits)
