"""Contract lines, bookings value and the motion of each deal line."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerwave.functions.joins import join_hot, join_sized
from ledgerwave.functions.keys import surrogate_key


def contract_lines_normalized(subscriptions: DataFrame, products: DataFrame) -> DataFrame:
    """Recurring segments with their product hierarchy."""
    hierarchy = products.select("product_id", "product_name", "line_of_business", "product_family")
    recurring = subscriptions.filter("is_recurring")
    return join_sized(recurring, hierarchy, ["product_id"], ["subscription_id"]).select(
        "subscription_id",
        "contract_id",
        "account_id",
        "product_id",
        "product_name",
        "line_of_business",
        "product_family",
        F.col("quantity").alias("entitled_units"),
        "annual_recurring_amount",
        "subscription_start_date",
        "subscription_end_date",
        "subscription_status",
    )


DEAL = (
    "opportunity_id", "account_id", "owner_id", "opportunity_type", "stage_name", "forecast_category", "is_closed",
    "is_won", "close_date", "term_months",
)
OWNER = ("opportunity_owner", "sales_region", "sales_team")
HIERARCHY = ("product_name", "line_of_business", "product_family")


def _deal_lines(lines: DataFrame, opportunities: DataFrame, *also: str) -> DataFrame:
    return lines.drop("term_months").join(opportunities.select(*DEAL, *also), "opportunity_id")


def _owned(opportunities: DataFrame, users: DataFrame) -> DataFrame:
    """Opportunities with their owner, who is looked up before an opportunity becomes its lines."""
    owners = users.select(
        F.col("user_id").alias("owner_id"),
        F.col("user_name").alias("opportunity_owner"),
        "sales_region",
        "sales_team",
    )
    return join_sized(opportunities.select(*DEAL), owners, ["owner_id"], ["opportunity_id"])


def _valued(deal_lines: DataFrame, products: DataFrame, lines: DataFrame, *also: str) -> DataFrame:
    """Lines that have their deal, with product and amounts; products come last, after every shuffle of lines."""
    amount = F.col("line_amount")
    nothing = F.lit(0).cast("decimal(18,2)")
    years = F.col("term_months").cast("double") / 12
    total = F.when(F.col("is_recurring"), amount.cast("double") * years).otherwise(amount.cast("double"))
    described = join_sized(
        deal_lines, products.select("product_id", *HIERARCHY), ["product_id"], ["opportunity_line_id"]
    )
    first = ["owner_id", "product_id", "opportunity_id"]
    own = [c for c in lines.columns if c not in (*first, "term_months")]
    return described.select(*first, *own, *[c for c in DEAL if c not in first], *HIERARCHY, *OWNER, *also).withColumns(
        {
            "sales_year": F.year("close_date"),
            "annual_recurring_amount": F.when(F.col("is_recurring"), amount).otherwise(nothing),
            "one_time_amount": F.when(~F.col("is_recurring"), amount).otherwise(nothing),
            "acv": amount,
            "tcv": total,
        }
    )


def opportunity_acv_tcv(
    lines: DataFrame, opportunities: DataFrame, products: DataFrame, users: DataFrame
) -> DataFrame:
    """Deal lines with recurring and one-time amounts, annual and total contract value."""
    return _valued(_deal_lines(lines, _owned(opportunities, users), *OWNER), products, lines)


def first_won_dates(lines: DataFrame, opportunities: DataFrame, won_only: bool = False) -> DataFrame:
    """First won close date per account and product, and per account.

    One aggregation over the lines; the account date is the least of its
    products' dates. ``won_only`` reads won deals alone and leaves out products
    an account has never won.
    """
    won_on = F.when(F.col("is_won"), F.col("close_date"))
    deals = opportunities.filter("is_won") if won_only else opportunities
    products = (
        _deal_lines(lines, deals)
        .groupBy("account_id", "product_id")
        .agg(F.min(won_on).alias("product_first_won_date"))
    )
    accounts = products.groupBy("account_id").agg(F.min("product_first_won_date").alias("account_first_won_date"))
    return join_hot(products, accounts, ["account_id"], spread=["product_id"], null_safe=True)


def deal_motion() -> Column:
    """Type rules first, then won history, then the intent of open and lost lines."""
    kind = F.col("opportunity_type")
    return (
        F.when(kind == "Churn", "churn")
        .when(kind == "Downgrade", "downgrade")
        .when(kind == "Renewal", "scheduled")
        .when(F.col("is_won") & (F.col("close_date") == F.col("account_first_won_date")), "new_logo")
        .when(F.col("is_won") & (F.col("close_date") == F.col("product_first_won_date")), "cross_sell")
        .when(F.col("is_won"), "upsell")
        .when(kind == "New Business", "new_logo")
        .otherwise("upsell")
    )


def opportunity_lines_acv(
    lines: DataFrame, opportunities: DataFrame, products: DataFrame, users: DataFrame
) -> DataFrame:
    """D10-D12 together."""
    # Only won lines are compared with these dates, and the product of a won line has been won.
    firsts = first_won_dates(lines, opportunities, won_only=True)
    dates = ["product_first_won_date", "account_first_won_date"]
    # Dealt by the opportunity, a line's own text is shuffled only where it is asked for. AQE splits the slices.
    dated = join_hot(
        _deal_lines(lines, _owned(opportunities, users), *OWNER), firsts, ["account_id", "product_id"],
        spread=["opportunity_id"], null_safe=True, slices=2,
    )
    valued = _valued(dated, products, lines, *dates)
    last = [c for c in valued.columns if c not in dates] + dates
    return valued.select(*last).withColumns(
        {"is_closed_won": F.col("is_closed") & F.col("is_won"), "revenue_category": deal_motion()}
    )


def fct_acv(acv_lines: DataFrame) -> DataFrame:
    """The bookings fact with its keys."""
    return acv_lines.select(
        surrogate_key("opportunity_line_id").alias("acv_key"),
        surrogate_key("account_id").alias("account_key"),
        surrogate_key("product_id").alias("product_key"),
        surrogate_key("owner_id").alias("sales_rep_key"),
        "opportunity_line_id",
        "opportunity_id",
        "account_id",
        "product_id",
        "owner_id",
        "opportunity_owner",
        "sales_region",
        "sales_team",
        "opportunity_type",
        "stage_name",
        "forecast_category",
        "revenue_category",
        "is_closed",
        "is_won",
        "is_closed_won",
        "close_date",
        "sales_year",
        "term_months",
        "is_recurring",
        "quantity",
        "annual_recurring_amount",
        "one_time_amount",
        "acv",
        "tcv",
    )
