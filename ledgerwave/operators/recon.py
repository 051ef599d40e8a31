"""Contracts against ERP orders and invoices."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerwave.functions.joins import join_hot
from ledgerwave.functions.keys import surrogate_key

# Discrepancy categories, in order of precedence.
CATEGORIES = (
    "orphan_in_netsuite",
    "missing_in_netsuite",
    "amount_mismatch",
    "currency_rounding",
    "partially_invoiced",
    "timing_difference",
    "matched_clean",
)


@dataclass(frozen=True)
class Tolerances:
    amount: str = "50"
    share: float = 0.01
    coverage: float = 0.999
    days: int = 7


def invoice_coverage(invoices: DataFrame) -> DataFrame:
    """Invoiced total and number of invoices per order."""
    return invoices.groupBy("sales_order_id").agg(
        F.sum("invoice_total").alias("ns_invoice_amount"), F.count("*").alias("invoice_count")
    )


def match_orders(contracts: DataFrame, orders: DataFrame, order_refs: DataFrame) -> DataFrame:
    """Full outer match on the order reference.

    A full outer join can neither split a hot reference nor spread rows without
    one, so it is put together from two joins that can: orders with their
    contract, and the contracts no order refers to.
    """
    ref = "external_order_ref"
    referenced = order_refs.select(ref).filter(F.col(ref).isNotNull()).distinct()
    with_order = (
        orders.withColumnRenamed(ref, "order_ref")
        .join(contracts, F.col("order_ref") == F.col(ref), "left")
        .withColumn(ref, F.col("order_ref"))
        .drop("order_ref")
    )
    without_order = join_hot(contracts, referenced, [ref], "left_anti", spread=["contract_id"])
    return with_order.unionByName(without_order, allowMissingColumns=True)


def reconcile(contracts: DataFrame, orders: DataFrame, customers: DataFrame, invoices: DataFrame) -> DataFrame:
    """Matched and unmatched contracts and orders with their variances."""
    crm = contracts.select(
        "contract_id",
        "contract_number",
        F.col("account_id").alias("sfdc_account_id"),
        F.col("total_contract_value").alias("sfdc_contract_amount"),
        "contract_start_date",
        F.col("currency_code").alias("sfdc_currency"),
        "external_order_ref",
    )
    bridge = customers.select("ns_customer_id", F.col("sfdc_account_external_id").alias("order_account_id"))
    erp = (
        orders.select(
            "sales_order_id",
            "ns_customer_id",
            "order_number",
            F.col("order_total").alias("ns_order_amount"),
            "order_date",
            F.col("currency_code").alias("ns_currency"),
            "external_order_ref",
        )
        .join(bridge, "ns_customer_id", "left")
        .join(invoice_coverage(invoices), "sales_order_id", "left")
    )
    variance = F.col("sfdc_contract_amount") - F.col("ns_order_amount")

    def ratio(top: Column, bottom: Column) -> Column:
        return top.cast("double") / F.nullif(bottom.cast("double"), F.lit(0.0))

    return match_orders(crm, erp, orders).select(
        F.coalesce("sfdc_account_id", "order_account_id").alias("account_id"),
        "contract_id",
        "contract_number",
        "external_order_ref",
        "sales_order_id",
        "order_number",
        "contract_start_date",
        "order_date",
        "sfdc_contract_amount",
        "ns_order_amount",
        "ns_invoice_amount",
        variance.alias("amount_variance"),
        ratio(variance, F.col("sfdc_contract_amount")).alias("amount_variance_pct"),
        F.datediff("order_date", "contract_start_date").alias("date_variance_days"),
        (F.col("sfdc_currency") != F.col("ns_currency")).alias("currency_variance"),
        ratio(F.col("ns_invoice_amount"), F.col("ns_order_amount")).alias("invoice_coverage_pct"),
    )


def recon_classify(matched: DataFrame, limits: Tolerances = Tolerances()) -> DataFrame:
    """Match status and one discrepancy category per row, by precedence."""
    off_by = F.abs("amount_variance")
    limit = F.lit(limits.amount).cast("decimal(18,2)")
    mismatch = (off_by > limit) & (F.abs("amount_variance_pct") > limits.share)
    orphan, missing = F.col("contract_id").isNull(), F.col("sales_order_id").isNull()
    status = (
        F.when(orphan, "unmatched_netsuite")
        .when(missing, "unmatched_sfdc")
        .when(mismatch, "variance")
        .otherwise("matched")
    )
    category = (
        F.when(orphan, "orphan_in_netsuite")
        .when(missing, "missing_in_netsuite")
        .when(mismatch, "amount_mismatch")
        .when((off_by > 0) & (off_by <= limit), "currency_rounding")
        .when(F.coalesce(F.col("invoice_coverage_pct"), F.lit(0.0)) < limits.coverage, "partially_invoiced")
        .when(F.abs("date_variance_days") > limits.days, "timing_difference")
        .otherwise("matched_clean")
    )
    return matched.withColumns({"match_status": status, "discrepancy_category": category})


def rpt_recon(classified: DataFrame) -> DataFrame:
    """The reconciliation report with its keys."""
    return classified.select(
        surrogate_key(
            F.coalesce(F.col("contract_id").cast("string"), F.lit("")),
            F.coalesce(F.col("sales_order_id").cast("string"), F.lit("")),
        ).alias("recon_key"),
        surrogate_key("account_id").alias("account_key"),
        "account_id",
        "contract_id",
        "contract_number",
        "external_order_ref",
        "sales_order_id",
        "order_number",
        "contract_start_date",
        "order_date",
        "sfdc_contract_amount",
        "ns_order_amount",
        "ns_invoice_amount",
        "amount_variance",
        "amount_variance_pct",
        "date_variance_days",
        "currency_variance",
        "invoice_coverage_pct",
        "match_status",
        "discrepancy_category",
    )
