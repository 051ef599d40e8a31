"""The recurring-revenue waterfall.

Amounts change only where a span starts, so prior values and history are looked
up on spans and the months inside a span are added afterwards.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerwave.functions.joins import join_hot
from ledgerwave.functions.keys import surrogate_key
from ledgerwave.functions.values import MONEY, money
from ledgerwave.operators.snapshots import months_of

# The categories of a monthly movement.
CATEGORIES = ("new_logo", "cross_sell", "upsell", "downgrade", "churn", "scheduled")
SIGNED_BUCKETS = ("new_logo", "cross_sell", "upsell", "downgrade", "churn")


def account_first_month(changes: DataFrame, account: str = "account_id") -> DataFrame:
    """First month in which an account's total over its products is positive."""
    so_far = (
        Window.partitionBy(account).orderBy("month").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        changes.groupBy(account, "month")
        .agg(F.sum("arr_change").alias("arr_change"))
        .withColumn("account_arr", F.sum("arr_change").over(so_far))
        .filter(F.col("account_arr") > 0)
        .groupBy(account)
        .agg(F.min("month").alias("account_first_month"))
    )


def ever_active_before(spans: DataFrame, changes: DataFrame) -> DataFrame:
    """Spans with the prior run rate and whether pair and account were ever active earlier.

    "Ever active before a month" is the same as "first active month lies before
    it", so the account side is one date per account, joined back.
    """
    pair = Window.partitionBy("account_id", "product_id")
    by_month = pair.orderBy("month")
    history = spans.withColumns(
        {
            "prior_arr": F.coalesce(F.lag("arr").over(by_month), F.lit(0).cast(MONEY)),
            "pair_first_month": F.min(F.when(F.col("arr") > 0, F.col("month"))).over(
                by_month.rowsBetween(Window.unboundedPreceding, Window.currentRow)
            ),
        }
    )
    return join_hot(history, account_first_month(changes), ["account_id"], spread=["product_id"]).withColumns(
        {
            "product_active_before": _before("pair_first_month", F.col("month")),
            "account_active_before": _before("account_first_month", F.col("month")),
        }
    )


def _before(first: str, month: Column) -> Column:
    return F.coalesce(F.col(first) < month, F.lit(False))


def history_by_month(history: DataFrame) -> DataFrame:
    """D6 at the grain of the snapshot: prior run rate and history flags of every month."""
    month = F.col("snapshot")
    return history.withColumn("snapshot", months_of(F.col("month"), F.col("until"))).select(
        "account_id",
        "product_id",
        F.last_day(month).alias("measurement_month"),
        F.when(month == F.col("month"), F.col("prior_arr")).otherwise(F.col("arr")).alias("prior_arr"),
        _before("pair_first_month", month).alias("product_active_before"),
        _before("account_first_month", month).alias("account_active_before"),
    )


def movement_category(
    now: Column, prior: Column, account_active_before: Column, product_active_before: Column
) -> Column:
    starts = (now > 0) & (prior == 0)
    return (
        F.when(starts & ~account_active_before, "new_logo")
        .when(starts & ~product_active_before, "cross_sell")
        .when(starts, "new_logo")  # a lapsed product won back
        .when((now > prior) & (prior > 0), "upsell")
        .when((now < prior) & (now > 0), "downgrade")
        .when((prior > 0) & (now == 0), "churn")
        .when((now == prior) & (now > 0), "scheduled")
        .otherwise("inactive")
    )


def _shown_until(keep_inactive: bool) -> Column:
    """Where the months of a span end that are kept: of zero spans just the first, in which the run rate may have churned."""
    until = F.col("until")
    return until if keep_inactive else F.when(F.col("arr") > 0, until).otherwise(F.add_months(F.col("month"), 1))


def by_year(history: DataFrame, keep_inactive: bool = True) -> DataFrame:
    """``history`` cut at the turn of years, with the ``year`` and its part [shown_from, shown_until) of the span.

    The months of a year are then made from rows of that year, which are few: what is written by month can be dealt
    before it is expanded.
    """
    shown = _shown_until(keep_inactive)
    last = F.add_months(shown, -1)
    turn = F.make_date(F.col("year"), F.lit(1), F.lit(1))
    return (
        history.withColumn("year", F.explode(F.sequence(F.year("month"), F.year(last))))
        .withColumn("shown_from", F.greatest(F.col("month"), turn))
        .withColumn("shown_until", F.least(shown, F.add_months(turn, 12)))
    )


def period_movement(history: DataFrame, keep_inactive: bool = True) -> DataFrame:
    """One classified row per key and month; also from history cut ``by_year``.

    Only the first month of a span can differ from the month before it; the
    others are carried unchanged. Without inactive rows, zero spans keep just
    their first month, in which the run rate may have churned.
    """
    first = F.col("month")
    cut = "shown_from" in history.columns
    shown = (F.col("shown_from"), F.col("shown_until")) if cut else (first, _shown_until(keep_inactive))
    opening = F.col("snapshot") == first
    nothing = F.lit(0).cast(MONEY)
    category = movement_category(
        F.col("arr"), F.col("prior_arr"), F.col("account_active_before"), F.col("product_active_before")
    )
    carried = F.when(F.col("arr") > 0, "scheduled").otherwise("inactive")
    movement = (
        history.withColumns(
            {
                "opening_category": category,
                "carried_category": carried,
                "opening_change": money(F.col("arr") - F.col("prior_arr")),
            }
        )
        .withColumn("snapshot", months_of(*shown))
        .select(
            "account_id",
            "product_id",
            F.last_day("snapshot").alias("measurement_month"),
            F.when(opening, F.col("prior_arr")).otherwise(F.col("arr")).alias("beginning_arr"),
            F.col("arr").alias("ending_arr"),
            F.when(opening, F.col("opening_change")).otherwise(nothing).alias("arr_change"),
            "entitled_units",
            F.when(opening, F.col("opening_category"))
            .otherwise(F.col("carried_category"))
            .alias("revenue_category"),
        )
    )
    return movement if keep_inactive else movement.filter(F.col("revenue_category") != "inactive")


def movement_buckets(movement: DataFrame) -> DataFrame:
    """The signed change in the bucket of its category, and the carried run rate."""

    def bucket(category: str, value: str) -> Column:
        return F.when(F.col("revenue_category") == category, F.col(value)).otherwise(F.lit(0).cast(MONEY))

    return movement.filter(F.col("revenue_category") != "inactive").select(
        "*",
        *[bucket(c, "arr_change").alias(f"{c}_arr") for c in SIGNED_BUCKETS],
        bucket("scheduled", "ending_arr").alias("scheduled_arr"),
    )


def fct_arr(movements: DataFrame) -> DataFrame:
    """The waterfall fact with its keys."""
    return movements.select(
        surrogate_key("account_id", "product_id", "measurement_month").alias("arr_key"),
        surrogate_key("account_id").alias("account_key"),
        surrogate_key("product_id").alias("product_key"),
        "account_id",
        "product_id",
        "measurement_month",
        "revenue_category",
        "beginning_arr",
        "ending_arr",
        "arr_change",
        "entitled_units",
        *[f"{c}_arr" for c in SIGNED_BUCKETS],
        "scheduled_arr",
    )


def fct_arr_of_years(history: DataFrame) -> DataFrame:
    """D9 from history cut ``by_year``, in each task by month and account.

    That is the order in which a table partitioned by month is written, and equal keys side by side take little space.
    """
    return fct_arr(movement_buckets(period_movement(history, False).sortWithinPartitions("measurement_month", "account_id")))
