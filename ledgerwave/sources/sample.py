"""The fourteen revenue feeds and five bout tables as views over the sample tables.

The feeds have the shape in which the systems deliver them (flags as 0/1,
missing references as empty text); ``conform`` turns them into typed tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerwave.functions.joins import join_hot
from ledgerwave.functions.values import money, month_floor

# The snapshot window of the sample data: first month, and first month after it.
WINDOW_START = "1995-01-01"
WINDOW_END = "2002-01-01"
LAST_SNAPSHOT = "2001-12-31"

SEGMENT_MONTHS = {"R": 5, "A": 11, "N": 23}


class Tables:
    """The sample tables of one folder; each is opened once."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder
        self._opened: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._opened:
            self._opened[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._opened[name]


def _flag(condition: Column) -> Column:
    return F.when(condition, 1).otherwise(0)


def _line_key() -> Column:
    return F.concat_ws(
        "-", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", F.col("l_shipdate").cast("date")
    )


def _order_date() -> Column:
    return F.col("o_orderdate").cast("date")


def _term_months(order_key: str) -> Column:
    return (F.col(order_key) % 3 + 1).cast("int") * 12


def _supplier_count(tables: Tables) -> Column:
    return tables["supplier"].agg(F.count("*")).scalar()


def _territories(tables: Tables) -> DataFrame:
    return tables["nation"].join(
        tables["region"], F.col("n_regionkey") == F.col("r_regionkey")
    )


def users(tables: Tables) -> DataFrame:
    team = F.when(F.col("s_suppkey") % 3 == 0, "Enterprise").when(
        F.col("s_suppkey") % 3 == 1, "Mid-Market"
    ).otherwise("SMB")
    return (
        tables["supplier"]
        .join(_territories(tables), F.col("s_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("s_suppkey").alias("user_id"),
            F.col("s_name").alias("user_name"),
            team.alias("sales_team"),
            F.col("r_name").alias("sales_region"),
            F.lit("Account Executive").alias("role"),
        )
    )


def accounts(tables: Tables) -> DataFrame:
    buyers = tables["orders"].groupBy("o_custkey").agg(F.lit(1).alias("has_order"))
    return (
        tables["customer"]
        .join(_territories(tables), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(buyers, F.col("c_custkey") == F.col("o_custkey"), "left")
        .select(
            F.col("c_custkey").alias("account_id"),
            F.col("c_name").alias("account_name"),
            F.concat(F.lit("Industry "), F.col("c_custkey") % 7).alias("industry"),
            F.col("n_name").alias("billing_country"),
            F.col("r_name").alias("geo_region"),
            F.concat(F.lit("Division "), F.col("c_nationkey") % 4).alias("division"),
            F.col("c_mktsegment").alias("segment"),
            F.concat(F.lit("Tier "), F.col("c_custkey") % 3 + 1).alias("account_tier"),
            F.when(F.col("c_custkey") % 2 == 0, "USD").otherwise("EUR").alias("account_currency"),
            (F.col("c_custkey") % _supplier_count(tables)).alias("owner_id"),
            F.date_add(F.lit("1994-01-01").cast("date"), (F.col("c_custkey") % 365).cast("int")).alias(
                "created_date"
            ),
            F.coalesce("has_order", F.lit(0)).alias("is_customer"),
        )
    )


def products(tables: Tables) -> DataFrame:
    product_id = F.col("product_id")
    return (
        tables["part"]
        .groupBy((F.col("p_partkey") % 12).alias("product_id"))
        .agg(
            F.min("p_name").alias("product_name"),
            F.min("p_type").alias("line_of_business"),
            F.min("p_brand").alias("product_family"),
            F.max("p_retailprice").alias("list_unit_price"),
        )
        .select(
            "product_id",
            "product_name",
            F.concat(F.lit("SKU-"), product_id).alias("product_sku"),
            "line_of_business",
            "product_family",
            F.when(product_id < 9, "Recurring").otherwise("One-Time").alias("product_category"),
            _flag(product_id < 9).alias("is_recurring"),
            _flag(product_id != 11).alias("is_active"),
            "list_unit_price",
        )
    )


def opportunities(tables: Tables) -> DataFrame:
    kind, won = F.col("o_orderkey") % 10, (F.col("o_orderstatus") == "F") & (F.col("o_orderkey") % 10 != 9)
    opportunity_type = (
        F.when(kind <= 1, "New Business")
        .when(kind <= 4, "Expansion")
        .when(kind <= 7, "Renewal")
        .when(kind == 8, "Downgrade")
        .otherwise("Churn")
    )
    stage = (
        F.when(won, "Closed Won").when(F.col("o_orderstatus") != "P", "Closed Lost").otherwise("Proposal")
    )
    return tables["orders"].select(
        F.col("o_orderkey").alias("opportunity_id"),
        F.col("o_custkey").alias("account_id"),
        (F.col("o_orderkey") % _supplier_count(tables)).alias("owner_id"),
        F.concat(F.lit("Deal "), "o_orderkey").alias("opportunity_name"),
        opportunity_type.alias("opportunity_type"),
        stage.alias("stage_name"),
        F.col("o_orderpriority").alias("forecast_category"),
        F.col("o_totalprice").alias("amount"),
        F.lit("USD").alias("currency_code"),
        _term_months("o_orderkey").alias("term_months"),
        F.date_add(_order_date(), -30).alias("created_date"),
        _order_date().alias("close_date"),
        _flag(F.col("o_orderstatus") != "P").alias("is_closed"),
        _flag(won).alias("is_won"),
        F.when(F.col("o_orderkey") % 50 == 49, "")
        .otherwise(F.col("o_orderkey").cast("string"))
        .alias("contract_id"),
    )


def opportunity_line_items(tables: Tables) -> DataFrame:
    sign = F.when(F.col("l_orderkey") % 10 == 8, -1).otherwise(1)
    return tables["lineitem"].select(
        _line_key().alias("opportunity_line_id"),
        F.col("l_orderkey").alias("opportunity_id"),
        (F.col("l_partkey") % 12).alias("product_id"),
        (F.col("l_quantity").cast("int") * sign).alias("quantity"),
        (money("l_extendedprice") / F.col("l_quantity").cast("int")).cast("decimal(18,2)").alias("unit_price"),
        _term_months("l_orderkey").alias("term_months"),
        _flag(F.col("l_partkey") % 12 < 9).alias("is_recurring"),
        (money("l_extendedprice") * sign).cast("decimal(18,2)").alias("line_amount"),
    )


def contracts(tables: Tables) -> DataFrame:
    term = _term_months("o_orderkey")
    return (
        tables["orders"]
        .filter(F.col("o_orderkey") % 50 != 49)
        .select(
            F.col("o_orderkey").cast("string").alias("contract_id"),
            F.col("o_custkey").alias("account_id"),
            F.concat(F.lit("C-"), "o_orderkey").alias("contract_number"),
            _order_date().alias("start_date"),
            F.date_add(F.add_months(_order_date(), term), -1).alias("end_date"),
            term.alias("term_months"),
            F.lit("Activated").alias("contract_status"),
            F.lit("USD").alias("currency_code"),
            F.col("o_orderkey").alias("external_order_ref"),
            F.col("o_totalprice").alias("total_contract_value"),
        )
    )


def subscriptions(tables: Tables) -> DataFrame:
    start = month_floor(F.col("l_shipdate").cast("date"))
    months = (
        F.when(F.col("l_returnflag") == "R", SEGMENT_MONTHS["R"])
        .when(F.col("l_returnflag") == "A", SEGMENT_MONTHS["A"])
        .otherwise(SEGMENT_MONTHS["N"])
    )
    lines = tables["lineitem"].filter(F.col("l_shipdate").isNotNull())
    return lines.join(
        tables["orders"], F.col("l_orderkey") == F.col("o_orderkey")
    ).select(
        _line_key().alias("subscription_id"),
        F.col("l_orderkey").cast("string").alias("contract_id"),
        F.col("o_custkey").alias("account_id"),
        (F.col("l_partkey") % 5).alias("product_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        money("l_extendedprice").alias("annual_recurring_amount"),
        (money("l_extendedprice") / F.col("l_quantity").cast("int")).cast("decimal(18,2)").alias("unit_price"),
        F.when(F.col("l_returnflag") == "N", "Annual").otherwise("Monthly").alias("billing_frequency"),
        start.alias("start_date"),
        F.last_day(F.add_months(start, months)).alias("end_date"),
        _flag(F.col("l_linestatus") == "O").alias("is_recurring"),
        F.when(F.col("l_returnflag") == "R", "Expired").otherwise("Active").alias("status"),
    )


def erp_customers(tables: Tables) -> DataFrame:
    return tables["customer"].select(
        F.col("c_custkey").alias("ns_customer_id"),
        F.col("c_name").alias("customer_name"),
        F.col("c_custkey").alias("sfdc_account_external_id"),
        F.concat(F.lit("Subsidiary "), F.col("c_nationkey") % 3).alias("subsidiary"),
        F.when(F.col("c_custkey") % 2 == 0, "USD").otherwise("EUR").alias("currency_code"),
    )


def erp_items(tables: Tables) -> DataFrame:
    return products(tables).select(
        F.concat(F.lit("ITEM-"), "product_id").alias("ns_item_id"),
        F.col("product_name").alias("item_name"),
        F.when(F.col("is_recurring") == 1, "Service").otherwise("Non-inventory").alias("item_type"),
        F.col("product_id").alias("sfdc_product_external_id"),
    )


def _order_amount() -> Column:
    """Order amount with two injected kinds of discrepancy, by order key."""
    amount, kind = money("o_totalprice"), F.col("o_orderkey") % 50
    return (
        F.when(kind == 1, (amount * F.lit("0.92").cast("decimal(3,2)")).cast("decimal(18,2)"))
        .when(kind == 2, (amount + 20).cast("decimal(18,2)"))
        .otherwise(amount)
    )


def erp_orders(tables: Tables) -> DataFrame:
    return (
        tables["orders"]
        .filter(F.col("o_orderkey") % 50 != 0)
        .select(
            F.col("o_orderkey").alias("sales_order_id"),
            F.col("o_custkey").alias("ns_customer_id"),
            F.concat(F.lit("SO-"), "o_orderkey").alias("order_number"),
            F.col("o_orderkey").alias("external_order_ref"),
            F.when(F.col("o_orderkey") % 50 == 3, F.date_add(_order_date(), 20))
            .otherwise(_order_date())
            .alias("order_date"),
            F.col("o_orderstatus").alias("order_status"),
            _order_amount().alias("order_total"),
            F.lit("USD").alias("currency_code"),
        )
    )


def _erp_lines(tables: Tables, line_id: str, parent_id: str) -> DataFrame:
    return (
        tables["lineitem"]
        .filter(F.col("l_orderkey") % 50 != 0)
        .select(
            _line_key().alias(line_id),
            F.col("l_orderkey").alias(parent_id),
            F.concat(F.lit("ITEM-"), F.col("l_partkey") % 12).alias("ns_item_id"),
            F.col("l_quantity").alias("quantity"),
            (money("l_extendedprice") / F.col("l_quantity").cast("int")).cast("decimal(18,2)").alias("rate"),
            F.col("l_extendedprice").alias("line_amount"),
        )
    )


def erp_order_lines(tables: Tables) -> DataFrame:
    return _erp_lines(tables, "sales_order_line_id", "sales_order_id")


def erp_invoices(tables: Tables) -> DataFrame:
    total = F.when(
        F.col("sales_order_id") % 50 == 4,
        (F.col("order_total") * F.lit("0.7").cast("decimal(2,1)")).cast("decimal(18,2)"),
    ).otherwise(F.col("order_total"))
    return erp_orders(tables).select(
        F.col("sales_order_id").alias("invoice_id"),
        "ns_customer_id",
        "sales_order_id",
        F.concat(F.lit("INV-"), "sales_order_id").alias("invoice_number"),
        F.date_add("order_date", 5).alias("invoice_date"),
        total.alias("invoice_total"),
        F.lit("Paid").alias("invoice_status"),
        "currency_code",
    )


def erp_invoice_lines(tables: Tables) -> DataFrame:
    return _erp_lines(tables, "invoice_line_id", "invoice_id")


def usage_monthly(tables: Tables) -> DataFrame:
    """Units consumed per covered month, in tenths until the last step to stay exact.

    A line's tenths in a month are its quantity times a rate that its span, one digit and the month decide. So lines
    are summed by span and digit, of which even a hot key has few thousand, dealt by key, and only then expanded: no
    month is shuffled here or by what works on keys afterwards.
    """
    start = month_floor(F.col("l_shipdate").cast("date"))
    months = (
        F.when(F.col("l_returnflag") == "R", SEGMENT_MONTHS["R"])
        .when(F.col("l_returnflag") == "A", SEGMENT_MONTHS["A"])
        .otherwise(SEGMENT_MONTHS["N"])
    )
    first = F.greatest(start, F.lit(WINDOW_START).cast("date"))
    last = F.least(F.add_months(start, months), F.add_months(F.lit(WINDOW_END).cast("date"), -1))
    number = (F.col("l_orderkey") * 10 + F.col("l_linenumber")) * 7
    # % keeps the sign, and no month adds more than 36 to a number.
    digit = F.when(number < 0, F.greatest(number, number % 10 - 40)).otherwise(number % 10)
    tenths = F.col("quantity") * (4 + (F.col("digit") + F.month("usage_month") * 3) % 10)
    spans = (
        tables["lineitem"]
        .filter((F.col("l_linestatus") == "O") & (first <= last))
        .join(tables["orders"], F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy(
            F.col("o_custkey").alias("account_id"),
            (F.col("l_partkey") % 5).alias("product_id"),
            first.alias("first"),
            last.alias("last"),
            digit.alias("digit"),
        )
        .agg(F.sum(F.col("l_quantity").cast("int")).alias("quantity"))
    )
    # As many tasks as a shuffle has: the spans are small and would be coalesced, their months are not.
    tasks = int(tables.spark.conf.get("spark.sql.shuffle.partitions"))
    return (
        spans.repartition(tasks, "account_id", "product_id")
        .withColumn("usage_month", F.explode(F.sequence("first", "last", F.expr("interval 1 month"))))
        .groupBy("account_id", "product_id", "usage_month")
        .agg(F.sum(tenths).alias("tenths"))
        .select(
            "account_id",
            "product_id",
            "usage_month",
            (F.col("tenths").cast("decimal(18,0)") / 10).cast("decimal(18,2)").alias("consumed_units"),
            (F.col("tenths").cast("decimal(18,0)") / 4).cast("decimal(18,2)").alias("consumed_value"),
        )
    )


FEEDS = {
    "accounts": accounts,
    "users": users,
    "products": products,
    "opportunities": opportunities,
    "opportunity_line_items": opportunity_line_items,
    "contracts": contracts,
    "subscriptions": subscriptions,
    "erp_customers": erp_customers,
    "erp_items": erp_items,
    "erp_orders": erp_orders,
    "erp_order_lines": erp_order_lines,
    "erp_invoices": erp_invoices,
    "erp_invoice_lines": erp_invoice_lines,
    "usage_monthly": usage_monthly,
}


# --- bout tables -------------------------------------------------------------

FIRST_NAMES = ["Ana", "Bo", "Cy", "Di", "Ed", "Flo", "Gus"]


def _fighter_url(key: str) -> Column:
    return F.concat(F.lit("f/"), key)


def _roster(tables: Tables) -> DataFrame:
    first = F.element_at(F.array(*[F.lit(n) for n in FIRST_NAMES]), (F.col("s_suppkey") % 7 + 1).cast("int"))
    return tables["supplier"].select(
        "s_suppkey",
        _fighter_url("s_suppkey").alias("fighter_url"),
        F.concat_ws(" ", first, "s_nationkey").alias("fighter_name"),
    )


def fighters(tables: Tables) -> DataFrame:
    born = F.date_sub(F.lit("1978-01-01").cast("date"), (F.col("s_suppkey") * 97 % 8000).cast("int"))
    key = F.col("s_suppkey")
    return _roster(tables).select(
        "fighter_url",
        "fighter_name",
        F.concat((key % 120 + 115).cast("string"), F.lit(" lbs.")).alias("weight"),
        F.when(key % 10 == 9, "--").otherwise(F.date_format(born, "MMM dd, yyyy")).alias("dob"),
        F.concat((key % 16 + 64).cast("string"), F.lit('"')).alias("reach"),
        F.when(key % 5 == 0, "Southpaw").when(key % 5 == 1, "Switch").otherwise("Orthodox").alias("stance"),
    )


def _bout_suppliers(tables: Tables) -> DataFrame:
    """First and second fighter of every order that has at least two suppliers."""
    return (
        tables["lineitem"]
        .groupBy("l_orderkey")
        .agg(F.min("l_suppkey").alias("s1"), F.max("l_suppkey").alias("s2"))
        .filter(F.col("s1") != F.col("s2"))
    )


def fight_details(tables: Tables) -> DataFrame:
    key = F.col("o_orderkey")
    method = F.when(key % 3 == 0, "KO/TKO").when(key % 3 == 1, "Submission").otherwise("Decision")
    roster = _roster(tables)
    one = roster.select(F.col("s_suppkey").alias("s1"), F.col("fighter_name").alias("fighter1_name"))
    two = roster.select(F.col("s_suppkey").alias("s2"), F.col("fighter_name").alias("fighter2_name"))
    return (
        _bout_suppliers(tables)
        .join(tables["orders"], F.col("l_orderkey") == key)
        .join(one, "s1")
        .join(two, "s2")
        .select(
            key.cast("string").alias("fight_id"),
            _fighter_url("s1").alias("fighter1_url"),
            _fighter_url("s2").alias("fighter2_url"),
            "fighter1_name",
            "fighter2_name",
            F.when(key % 2 == 0, "fighter1").otherwise("fighter2").alias("winner"),
            method.alias("method"),
            (key % 3 + 1).cast("int").alias("finish_round"),
            F.concat(
                F.floor(key % 300 / 60).cast("string"),
                F.lit(":"),
                F.lpad((key % 60).cast("string"), 2, "0"),
            ).alias("finish_time"),
        )
    )


def fights(tables: Tables) -> DataFrame:
    return tables["orders"].select(
        F.col("o_orderkey").cast("string").alias("fight_id"),
        F.concat(F.lit("e/"), _order_date().cast("string")).alias("event_id"),
    )


def events(tables: Tables) -> DataFrame:
    return (
        tables["orders"]
        .select(_order_date().alias("event_date"))
        .distinct()
        .select(F.concat(F.lit("e/"), F.col("event_date").cast("string")).alias("event_id"), "event_date")
    )


def round_stats(tables: Tables) -> DataFrame:
    landed = F.col("l_quantity").cast("int")
    part = F.col("l_partkey")
    third = F.floor(landed / 3).cast("int")
    quarter = F.floor(landed / 4).cast("int")
    spread = ["l_partkey", "l_suppkey", "l_linenumber", "l_quantity"]
    return (
        join_hot(tables["lineitem"], _bout_suppliers(tables), ["l_orderkey"], "inner", spread)
        .filter((F.col("l_suppkey") == F.col("s1")) | (F.col("l_suppkey") == F.col("s2")))
        .select(
            F.col("l_orderkey").cast("string").alias("fight_id"),
            _fighter_url("l_suppkey").alias("fighter_url"),
            F.col("l_linenumber").alias("round"),
            F.when(landed % 4 == 3, 1).otherwise(0).alias("knockdowns"),
            landed.alias("sig_str_landed"),
            (landed + F.col("l_linenumber") * 3).alias("sig_str_attempted"),
            (part % 3).cast("int").alias("takedowns_landed"),
            (part % 3 + part % 2).cast("int").alias("takedowns_attempted"),
            (part % 5 % 2).cast("int").alias("submission_attempts"),
            (landed - third - quarter).alias("sig_distance_landed"),
            third.alias("sig_clinch_landed"),
            quarter.alias("sig_ground_landed"),
            (landed - third - quarter).alias("sig_head_landed"),
            quarter.alias("sig_body_landed"),
            third.alias("sig_leg_landed"),
            F.concat(
                F.floor(part % 300 / 60).cast("string"), F.lit(":"), F.lpad((part % 60).cast("string"), 2, "0")
            ).alias("control_time"),
        )
    )


BOUT_TABLES = {
    "fight_details": fight_details,
    "fights": fights,
    "events": events,
    "round_stats": round_stats,
    "fighters": fighters,
}


def load(tables: Tables, name: str) -> DataFrame:
    """One raw feed or bout table by its logical name."""
    return {**FEEDS, **BOUT_TABLES}[name](tables)
