"""Rounding and ratio rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EXACT = "decimal(20,0)"


def round_long(col: Column) -> Column:
    """Double to integer, half away from zero."""
    return F.round(col).cast("long")


def ratio(num: Column, den: Column) -> Column:
    """Double quotient; NULL where the denominator is 0."""
    return num / F.nullif(den, F.lit(0))


def exact_ratio(num: Column, den: Column, precision: int, scale: int) -> Column:
    """Quotient of two integers as a decimal, rounded half away from zero once.

    NULL where it does not fit the declared type, so that one row cannot abort a load.
    """
    den = F.nullif(den, F.lit(0)).cast(EXACT)
    return (num.cast(EXACT) / den).try_cast(f"decimal({precision},{scale})")


def count_if(cond: Column) -> Column:
    """Rows where ``cond`` holds, as ``SUM(CASE … 1 ELSE 0)``: NULL only on no rows."""
    return F.sum(F.when(cond, 1).otherwise(0)).cast("long")
