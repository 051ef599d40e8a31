"""Usage at the snapshot grain and against entitlement."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerwave.functions.keys import surrogate_key
from ledgerwave.operators.snapshots import months_of

KEYS = ("account_id", "product_id")


def usage_period_rollup(usage: DataFrame, month: str = "usage_month") -> DataFrame:
    """Units and value per key and month-end."""
    return usage.groupBy(*KEYS, F.last_day(month).alias("usage_month")).agg(
        F.sum("consumed_units").alias("consumed_units"), F.sum("consumed_value").alias("consumed_value")
    )


def usage_by_key(rollup: DataFrame) -> DataFrame:
    """One row per key with its months as a map: no more entries than the calendar has months."""
    month = F.struct("usage_month", F.struct("consumed_units", "consumed_value"))
    return rollup.groupBy(*KEYS).agg(F.map_from_entries(F.collect_list(month)).alias("used"))


def fct_usage(snapshots: DataFrame, rollup: DataFrame) -> DataFrame:
    """Entitled months with what was consumed; usage without entitlement is left out."""
    entitled = snapshots.filter(F.col("entitled_units") > 0).withColumnRenamed("measurement_month", "usage_month")
    return with_utilization(entitled.join(rollup, [*KEYS, "usage_month"], "left"))


def fct_usage_of_spans(spans: DataFrame, rollup: DataFrame) -> DataFrame:
    """D15 from spans of constant entitlement.

    A key's usage meets its few spans of constant entitlement before these are expanded, and a
    month looks its usage up in the row, so expanded months are never shuffled.
    """
    entitled = spans.filter((F.col("entitled_units") > 0) & (F.col("active_segments") > 0))
    months = (
        entitled.join(usage_by_key(rollup), [*KEYS], "left")
        .withColumn("snapshot", months_of(F.col("month"), F.col("until")))
        .withColumn("usage_month", F.last_day("snapshot"))
        .withColumn("use", F.try_element_at("used", F.col("usage_month")))
    )
    return with_utilization(
        months.select(*KEYS, "usage_month", "arr", "entitled_units", "use.consumed_units", "use.consumed_value")
    )


def with_utilization(entitled: DataFrame) -> DataFrame:
    """The usage fact of entitled months and what was consumed in them, if anything."""
    used = F.coalesce(F.col("consumed_units"), F.lit(0))
    units = F.col("entitled_units")
    return entitled.select(
        surrogate_key(*KEYS, "usage_month").alias("usage_key"),
        surrogate_key("account_id").alias("account_key"),
        surrogate_key("product_id").alias("product_key"),
        *KEYS,
        "usage_month",
        used.alias("consumed_units"),
        F.coalesce(F.col("consumed_value"), F.lit(0)).alias("consumed_value"),
        "entitled_units",
        F.col("arr").alias("entitled_arr"),
        (used.cast("double") / units.cast("double")).alias("utilization_pct"),
        F.greatest(used - units, F.lit(0)).alias("overage_units"),
        (used > units).alias("is_over_entitlement"),
        (used * 2 < units).alias("is_under_utilized"),
    )
