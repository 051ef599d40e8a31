"""Calendar spines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerwave.operators.snapshots import MonthWindow, months_of

# The calendar of the metric layer: 2022 through 2026.
CALENDAR = ("2022-01-01", "2027-01-01")


def month_spine(spark: SparkSession, window: MonthWindow) -> DataFrame:
    """Month-ends of [start, end); the end is exclusive."""
    return (
        spark.range(1)
        .select(months_of(window.first, window.stop).alias("month"))
        .select(F.last_day("month").alias("measurement_month"))
    )


def day_spine(spark: SparkSession, start: str = CALENDAR[0], end: str = CALENDAR[1]) -> DataFrame:
    """Days of [start, end); the end is exclusive."""
    days = F.sequence(F.lit(start).cast("date"), F.date_sub(F.lit(end).cast("date"), 1))
    return spark.range(1).select(F.explode(days).alias("date_day"))
