"""Report queries over the marts.

The waterfall reports all start from ``monthly_bridge``: the fact is summed to
one row per month in a single aggregation, and quarters, years and retention
are worked out on those few rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerwave.functions.joins import join_hot

# Display labels.
CATEGORY_LABELS = {
    "new_logo": "New logo",
    "cross_sell": "Cross-sell",
    "upsell": "Upsell",
    "scheduled": "Renewal",
    "downgrade": "Downgrade",
    "churn": "Churn",
}
DISCREPANCY_LABELS = {
    "missing_in_netsuite": "Missing in NetSuite",
    "amount_mismatch": "Amount mismatch",
    "orphan_in_netsuite": "Orphan in NetSuite",
    "currency_rounding": "Currency rounding",
    "timing_difference": "Timing difference",
    "partially_invoiced": "Partially invoiced",
}

MOVEMENTS = ("new_logo_arr", "cross_sell_arr", "upsell_arr", "downgrade_arr", "churn_arr")


def monthly_bridge(fct_arr: DataFrame) -> DataFrame:
    """The waterfall of the company, one row per snapshot."""
    summed = ("beginning_arr", *MOVEMENTS, "arr_change", "ending_arr")
    return fct_arr.groupBy("measurement_month").agg(*[F.sum(c).alias(c) for c in summed])


def _last_ending() -> Column:
    return F.max_by("ending_arr", "measurement_month")


def _period_sums() -> list[Column]:
    return [F.sum(c).alias(c) for c in MOVEMENTS]


def arr_bridge_by_period(fct_arr: DataFrame) -> DataFrame:
    """Movements by quarter, and the run rate on each quarter's last snapshot."""
    return (
        monthly_bridge(fct_arr)
        .groupBy(
            F.year("measurement_month").alias("fiscal_year"),
            F.concat(F.lit("Q"), F.quarter("measurement_month").cast("string")).alias("fiscal_quarter"),
        )
        .agg(*_period_sums(), F.sum("arr_change").alias("net_new_arr"), _last_ending().alias("ending_arr"))
        .select(
            "fiscal_year",
            "fiscal_quarter",
            "new_logo_arr",
            "cross_sell_arr",
            "upsell_arr",
            (F.col("upsell_arr") + F.col("cross_sell_arr")).alias("expansion_arr"),
            "downgrade_arr",
            "churn_arr",
            "net_new_arr",
            "ending_arr",
        )
        .orderBy("fiscal_year", "fiscal_quarter")
    )


def _at_risk() -> Column:
    return F.sum(F.abs(F.coalesce("amount_variance", "sfdc_contract_amount", "ns_order_amount")))


def recon_summary(rpt_recon: DataFrame) -> DataFrame:
    """Records and money at risk by discrepancy category and match status."""
    return (
        rpt_recon.groupBy("discrepancy_category", "match_status")
        .agg(F.count("*").alias("record_count"), F.round(_at_risk(), 0).alias("dollars_at_risk"))
        .orderBy(F.desc("dollars_at_risk"), "discrepancy_category")
    )


def arr_trend(fct_arr: DataFrame) -> DataFrame:
    """Run rate by month."""
    return monthly_bridge(fct_arr).select(
        F.date_format("measurement_month", "yyyy-MM").alias("ym"), F.col("ending_arr").alias("arr")
    ).orderBy("ym")


def arr_movement_by_year(fct_arr: DataFrame) -> DataFrame:
    """Movements by year, with upsell and cross-sell as expansion."""
    return (
        monthly_bridge(fct_arr)
        .groupBy(F.year("measurement_month").alias("yr"))
        .agg(
            F.sum("new_logo_arr").alias("new_logo"),
            F.sum(F.col("cross_sell_arr") + F.col("upsell_arr")).alias("expansion"),
            F.sum("downgrade_arr").alias("downgrade"),
            F.sum("churn_arr").alias("churn"),
            F.sum("arr_change").alias("net_new"),
        )
        .orderBy("yr")
    )


def year_end_arr(fct_arr: DataFrame) -> DataFrame:
    """Run rate on the last snapshot of each year."""
    return (
        monthly_bridge(fct_arr)
        .groupBy(F.year("measurement_month").alias("yr"))
        .agg(_last_ending().alias("ending_arr"))
        .orderBy("yr")
    )


def retention_kpis(fct_arr: DataFrame) -> DataFrame:
    """Net and gross retention over the whole period, and the latest run rate."""
    totals = monthly_bridge(fct_arr).agg(
        F.sum("beginning_arr").alias("beginning_arr"), *_period_sums(), _last_ending().alias("ending_arr")
    )
    return totals.select(*_retention(), "ending_arr")


def _retention() -> tuple[Column, Column]:
    """Net and gross retention from period sums."""
    base = F.col("beginning_arr")
    kept = base + F.col("downgrade_arr") + F.col("churn_arr")
    grown = kept + F.col("upsell_arr") + F.col("cross_sell_arr")

    def share(part: Column) -> Column:
        return part.cast("double") / F.nullif(base.cast("double"), F.lit(0.0))

    return share(grown).alias("nrr"), share(kept).alias("grr")


def bookings_by_category(fct_acv: DataFrame) -> DataFrame:
    """Won value by revenue category."""
    return (
        fct_acv.filter(F.col("is_closed_won") & (F.col("acv") > 0))
        .groupBy("revenue_category")
        .agg(F.sum("acv").alias("acv"))
        .orderBy(F.desc("acv"), "revenue_category")
    )


def bookings_by_segment(fct_acv: DataFrame, dim_account: DataFrame) -> DataFrame:
    """Won value and deals by account segment.

    Lines are summed per account and deal before the dimension is joined, so a
    busy account crosses the join as one row per deal.
    """
    deals = (
        fct_acv.filter("is_closed_won").groupBy("account_key", "opportunity_id").agg(F.sum("acv").alias("acv"))
    )
    return (
        join_hot(deals, dim_account.select("account_key", "segment"), ["account_key"], "inner", ["opportunity_id"])
        .groupBy("segment")
        .agg(F.sum("acv").alias("acv"), F.count_distinct("opportunity_id").alias("deals"))
        .orderBy(F.desc("acv"), "segment")
    )


def open_pipeline(fct_acv: DataFrame) -> DataFrame:
    """Value and number of open opportunities."""
    return fct_acv.filter(~F.col("is_closed")).agg(
        F.sum("acv").alias("acv"), F.count_distinct("opportunity_id").alias("opportunities")
    )


def latest_year_bookings(fct_acv: DataFrame) -> DataFrame:
    """Won value of the latest year with a won deal."""
    return (
        fct_acv.filter("is_closed_won")
        .groupBy("sales_year")
        .agg(F.sum("acv").alias("acv"))
        .agg(F.max("sales_year").alias("sales_year"), F.max_by("acv", "sales_year").alias("acv"))
    )


def utilization_buckets(fct_usage: DataFrame) -> DataFrame:
    """Entitled months over, within and under their entitlement."""
    share = F.col("utilization_pct")
    return fct_usage.agg(
        F.count_if(share > 1).alias("over_ent"),
        F.count_if(share.between(0.5, 1)).alias("healthy"),
        F.count_if(share < 0.5).alias("under_util"),
        F.count("*").alias("total"),
    )


def at_risk_by_category(rpt_recon: DataFrame) -> DataFrame:
    """Records and money at risk by category, clean matches left out."""
    return (
        rpt_recon.filter(F.col("discrepancy_category") != "matched_clean")
        .groupBy("discrepancy_category")
        .agg(F.count("*").alias("n"), _at_risk().alias("at_risk"))
        .orderBy(F.desc("at_risk"), "discrepancy_category")
    )


def with_label(df: DataFrame, column: str, labels: dict[str, str], name: str = "label") -> DataFrame:
    """Display label of a category; an unknown category shows as itself."""
    lookup = F.create_map(*[F.lit(x) for pair in labels.items() for x in pair])
    return df.withColumn(name, F.coalesce(F.try_element_at(lookup, F.col(column)), F.col(column)))


def _millions(value: Column) -> Column:
    return F.concat(F.lit("$"), (value.cast("decimal(38,2)") / 1000000).cast("decimal(18,1)").cast("string"), F.lit("M"))


def _percent(value: Column) -> Column:
    return F.concat(F.round(value * 100, 0).cast("decimal(18,0)").cast("string"), F.lit("%"))


def _bookings_state(fct_acv: DataFrame) -> DataFrame:
    """One row: the latest year with a won deal, its won value, and value and number of open deals.

    A deal's lines share its year and state, so deals are counted per year and the counts added up.
    """
    acv, won, still = F.col("acv"), F.col("is_closed_won"), ~F.col("is_closed")
    deals = fct_acv.filter(won | still).groupBy("opportunity_id", "sales_year").agg(
        F.sum(F.when(won, acv)).alias("won"),
        F.sum(F.when(still, acv)).alias("open_acv"),
        F.max(F.when(still, 1).otherwise(0)).alias("open"),
    )
    years = deals.groupBy("sales_year").agg(*[F.sum(c).alias(c) for c in ("won", "open_acv", "open")])
    latest = F.max_by(F.struct("sales_year", "won"), F.when(F.col("won").isNotNull(), F.col("sales_year")))
    return years.agg(
        latest.alias("latest"), F.sum("open_acv").alias("open_acv"), F.coalesce(F.sum("open"), F.lit(0)).alias("open")
    )


def kpi_frame(fct_arr: DataFrame, fct_acv: DataFrame, rpt_recon: DataFrame) -> DataFrame:
    """The headline figures as one long table of position, label, value and note.

    Each mart is read once: its months, years and totals come from one aggregation.
    """

    def one(position: int, label: Column | str, value: Column, note: Column | str) -> Column:
        text = [F.lit(x) if isinstance(x, str) else x for x in (label, note)]
        return F.struct(
            F.lit(position).alias("position"), text[0].alias("label"), value.alias("value"), text[1].alias("sub")
        )

    latest = F.struct("ending_arr", F.date_format("measurement_month", "MMM yyyy").alias("month"))
    arr = monthly_bridge(fct_arr).agg(
        F.sum("beginning_arr").alias("beginning_arr"),
        *_period_sums(),
        F.max_by(latest, F.col("measurement_month")).alias("latest"),
    )
    risk = at_risk_by_category(rpt_recon).agg(F.sum("at_risk").alias("at_risk"))
    period = "period approximation"
    figures = [
        (
            arr.select("latest", *_retention()),
            one(1, "Ending ARR", _millions(F.col("latest.ending_arr")), F.concat("latest.month", F.lit(" run-rate"))),
            one(2, "Net Revenue Retention", _percent(F.col("nrr")), period),
            one(3, "Gross Revenue Retention", _percent(F.col("grr")), period),
        ),
        (
            _bookings_state(fct_acv),
            one(
                4,
                F.concat(F.lit("Bookings ACV (FY"), F.col("latest.sales_year").cast("string"), F.lit(")")),
                _millions(F.col("latest.won")),
                "closed-won",
            ),
            one(
                5, "Open Pipeline ACV", _millions(F.col("open_acv")),
                F.concat(F.col("open").cast("string"), F.lit(" opportunities")),
            ),
        ),
        (risk, one(6, "$ at risk (recon)", _millions(F.col("at_risk")), "SFDC vs NetSuite")),
    ]
    table = reduce(DataFrame.unionByName, [row.select(F.inline(F.array(*rows))) for row, *rows in figures])
    return table.orderBy("position")
