"""Conformed dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerwave.functions.keys import surrogate_key
from ledgerwave.operators.snapshots import MonthWindow


def current_run_rate(spans: DataFrame, window: MonthWindow) -> DataFrame:
    """Run rate per account on the latest snapshot, which is where every key's last span ends."""
    return (
        spans.filter(F.col("until") == window.stop)
        .groupBy("account_id")
        .agg(F.sum("arr").alias("current_arr"))
    )


def dim_account(
    accounts: DataFrame, users: DataFrame, customers: DataFrame, contracts: DataFrame, run_rate: DataFrame
) -> DataFrame:
    """Accounts with owner, ERP customer, first contract and current run rate."""
    owners = users.select(
        F.col("user_id").alias("owner_id"), F.col("user_name").alias("account_owner"), "sales_region", "sales_team"
    )
    bridge = customers.select(F.col("sfdc_account_external_id").alias("account_id"), "ns_customer_id")
    first_contract = contracts.groupBy("account_id").agg(
        F.min("contract_start_date").alias("first_contract_date")
    )
    return (
        accounts.join(owners, "owner_id", "left")
        .join(bridge, "account_id", "left")
        .join(first_contract, "account_id", "left")
        .join(run_rate, "account_id", "left")
        .select(
            surrogate_key("account_id").alias("account_key"),
            "account_id",
            "account_name",
            "industry",
            "billing_country",
            "geo_region",
            "division",
            "segment",
            "account_tier",
            "account_currency",
            "owner_id",
            "account_owner",
            "sales_region",
            "sales_team",
            "ns_customer_id",
            "is_customer",
            "first_contract_date",
            F.coalesce(F.col("current_arr"), F.lit(0)).cast("double").alias("current_arr"),
        )
    )


def dim_product(products: DataFrame, items: DataFrame) -> DataFrame:
    """Products with their ERP item."""
    bridge = items.select(F.col("sfdc_product_external_id").alias("product_id"), "ns_item_id")
    return products.join(bridge, "product_id", "left").select(
        surrogate_key("product_id").alias("product_key"),
        "product_id",
        "product_name",
        "product_sku",
        "line_of_business",
        "product_family",
        "product_category",
        "is_recurring",
        "is_active",
        F.col("list_unit_price").cast("double").alias("list_unit_price"),
        "ns_item_id",
    )


def dim_sales_rep(users: DataFrame) -> DataFrame:
    """Sales reps."""
    return users.select(
        surrogate_key("user_id").alias("sales_rep_key"),
        "user_id",
        F.col("user_name").alias("sales_rep_name"),
        "sales_team",
        "sales_region",
        "role",
    )
