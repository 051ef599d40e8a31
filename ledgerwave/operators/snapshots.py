"""Effective-dated segments to a dense month-end snapshot.

A segment covers a run of months, so it is reduced to two changes: its amount
comes in at its first covered month and goes out after its last. Changes are
summed per key and month, which combines before the shuffle however many
segments one key has, and a running sum over a key's change months, of which
there are no more than the window has months, restates the run rate. The gap
between two changes is a span of equal months. No segment meets the calendar in
a join, and months appear only when a span is expanded, row by row.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerwave.functions.values import MONEY, money, month_floor

KEYS = ("account_id", "product_id")


@dataclass(frozen=True)
class MonthWindow:
    """Snapshot months from ``start`` up to, not including, ``end``; both month firsts."""

    start: str
    end: str

    @property
    def first(self) -> Column:
        return F.lit(self.start).cast("date")

    @property
    def stop(self) -> Column:
        return F.lit(self.end).cast("date")


# The window of the revenue warehouse: 36 months.
DEFAULT_WINDOW = MonthWindow("2023-01-01", "2026-01-01")


def run_rate_changes(
    segments: DataFrame,
    window: MonthWindow = DEFAULT_WINDOW,
    keys: tuple[str, ...] = KEYS,
    start: str = "subscription_start_date",
    end: str = "subscription_end_date",
    amount: str = "annual_recurring_amount",
    units: str = "entitled_units",
) -> DataFrame:
    """Net change of amount, units and segment count per key and month.

    A segment counts in a month when start <= month-end <= end, so the first
    month that no longer counts is the month of the day after ``end``. Segments
    without a key have no run rate.

    The totals are never NULL; asking for that keeps all three in every use of
    the changes, so that uses of different columns still share one shuffle.
    """
    present = [F.col(c).isNotNull() for c in (*keys, start, end)]
    covered = (
        segments.filter(reduce(lambda a, b: a & b, present))
        .withColumn("enter", F.greatest(month_floor(F.col(start)), window.first))
        .withColumn("leave", F.least(month_floor(F.date_add(F.col(end), 1)), window.stop))
        .filter(F.col("enter") < F.col("leave"))
    )
    value = F.coalesce(F.col(amount), F.lit(0).cast(MONEY))
    count = F.coalesce(F.col(units), F.lit(0)).cast("bigint")
    one = F.lit(1).cast("bigint")
    changes = F.array(
        F.struct(F.col("enter").alias("month"), value.alias("arr"), count.alias("units"), one.alias("active")),
        F.struct(
            F.col("leave").alias("month"), (-value).alias("arr"), (-count).alias("units"), (-one).alias("active")
        ),
    )
    return (
        covered.select(*keys, F.inline(changes))
        .filter(F.col("month") < window.stop)
        .groupBy(*keys, "month")
        .agg(
            F.sum("arr").alias("arr_change"),
            F.sum("units").alias("units_change"),
            F.sum("active").alias("active_change"),
        )
        .filter("arr_change is not null and units_change is not null and active_change is not null")
    )


def run_rate_spans(
    changes: DataFrame, window: MonthWindow = DEFAULT_WINDOW, keys: tuple[str, ...] = KEYS
) -> DataFrame:
    """Per key, spans of months [month, until) with a constant run rate, gap free to the window end."""
    by_month = Window.partitionBy(*keys).orderBy("month")
    so_far = by_month.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return changes.select(
        *keys,
        "month",
        F.coalesce(F.lead("month").over(by_month), window.stop).alias("until"),
        money(F.sum("arr_change").over(so_far)).alias("arr"),
        F.sum("units_change").over(so_far).alias("entitled_units"),
        F.sum("active_change").over(so_far).alias("active_segments"),
    )


def months_of(first: Column, until: Column) -> Column:
    """One row per month first in [first, until)."""
    return F.explode(F.sequence(first, F.add_months(until, -1), F.expr("interval 1 month")))


def expand_months(spans: DataFrame, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """The dense month-end table of a set of spans."""
    return spans.withColumn("snapshot", months_of(F.col("month"), F.col("until"))).select(
        *keys, F.last_day("snapshot").alias("measurement_month"), "arr", "entitled_units"
    )


def active_on_snapshot(spans: DataFrame, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """Run rate per key and month-end on which at least one segment is active."""
    return expand_months(spans.filter(F.col("active_segments") > 0), keys)


def first_active(changes: DataFrame, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """D3: first snapshot on which each key is active; its first change is always an entry."""
    return changes.groupBy(*keys).agg(F.last_day(F.min("month")).alias("first_active_month"))


def densify(
    snapshots: DataFrame,
    window: MonthWindow,
    keys: tuple[str, ...] = KEYS,
    month: str = "measurement_month",
    values: tuple[str, ...] = ("arr", "entitled_units"),
) -> DataFrame:
    """Fill the months a key misses, from its first month to the window end, with zeros.

    Each present month also stands for the gap up to the key's next one, so the
    scaffold needs no join.
    """
    by_month = Window.partitionBy(*keys).orderBy(month)
    following = F.coalesce(month_floor(F.lead(month).over(by_month)), window.stop)
    return (
        snapshots.withColumn("until", following)
        .withColumn("snapshot", months_of(month_floor(F.col(month)), F.col("until")))
        .select(
            *keys,
            F.last_day("snapshot").alias(month),
            *[
                F.when(F.last_day("snapshot") == F.col(month), F.col(v))
                .otherwise(F.lit(0))
                .alias(v)
                for v in values
            ],
        )
    )
