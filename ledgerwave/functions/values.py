"""Parsing and arithmetic helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"
ZERO_MONEY = "0.00"


def money(column: Column | str) -> Column:
    """Money as an exact decimal, so that equality of sums does not depend on row order."""
    column = F.col(column) if isinstance(column, str) else column
    return column.cast(MONEY)


def month_floor(column: Column) -> Column:
    return F.trunc(column, "month")


def clock_seconds(column: Column | str) -> Column:
    """Seconds of an ``m:ss`` text."""
    column = F.col(column) if isinstance(column, str) else column
    minutes = F.split_part(column, F.lit(":"), F.lit(1)).cast("int")
    seconds = F.split_part(column, F.lit(":"), F.lit(2)).cast("int")
    return minutes * 60 + seconds


def first_number(column: Column | str, pattern: str = r"(\d+)") -> Column:
    """First run of digits in a text, NULL when there is none."""
    return F.regexp_extract(column, pattern, 1).try_cast("int")


def safe_div(numerator: Column, denominator: Column) -> Column:
    """Ratio as double; 0 unless the denominator is positive."""
    ratio = numerator.cast("double") / denominator.cast("double")
    return F.when(denominator > 0, ratio).otherwise(F.lit(0.0))


def clamp(column: Column, low: float, high: float) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), column))
