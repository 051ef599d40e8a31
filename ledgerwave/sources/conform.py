"""Raw feeds to typed tables, one specification per feed.

A specification lists the output columns in order. A plain name passes a column
through; otherwise the entry says how to derive it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerwave.functions.values import MONEY


@dataclass(frozen=True)
class Field:
    name: str
    source: str | None = None
    type: str | None = None

    def column(self) -> Column:
        raw = F.col(self.source or self.name)
        if self.type == "flag":
            raw = raw == 1
        elif self.type == "blank_as_null":
            raw = F.nullif(raw, F.lit(""))
        elif self.type:
            raw = raw.cast(self.type)
        return raw.alias(self.name)


def keep(*names: str) -> list[Field]:
    return [Field(n) for n in names]


def typed(type_: str, *names: str) -> list[Field]:
    return [Field(n, type=type_) for n in names]


def renamed(name: str, source: str, type_: str | None = None) -> list[Field]:
    return [Field(name, source, type_)]


UNITS = "decimal(18,2)"

SPECS: dict[str, list[Field]] = {
    "accounts": keep(
        "account_id", "account_name", "industry", "billing_country", "geo_region", "division",
        "segment", "account_tier", "account_currency", "owner_id",
    )
    + renamed("account_created_date", "created_date", "date")
    + typed("flag", "is_customer"),
    "users": keep("user_id", "user_name", "sales_team", "sales_region", "role"),
    "products": keep(
        "product_id", "product_name", "product_sku", "line_of_business", "product_family", "product_category"
    )
    + typed("flag", "is_recurring", "is_active")
    + typed(MONEY, "list_unit_price"),
    "opportunities": keep(
        "opportunity_id", "account_id", "owner_id", "opportunity_name", "opportunity_type",
        "stage_name", "forecast_category",
    )
    + renamed("opportunity_amount", "amount", MONEY)
    + keep("currency_code")
    + typed("int", "term_months")
    + typed("date", "created_date", "close_date")
    + typed("flag", "is_closed", "is_won")
    + typed("blank_as_null", "contract_id"),
    "opportunity_line_items": keep("opportunity_line_id", "opportunity_id", "product_id")
    + typed("int", "quantity")
    + typed(MONEY, "unit_price")
    + typed("int", "term_months")
    + typed("flag", "is_recurring")
    + typed(MONEY, "line_amount"),
    "contracts": keep("contract_id", "account_id", "contract_number")
    + renamed("contract_start_date", "start_date", "date")
    + renamed("contract_end_date", "end_date", "date")
    + typed("int", "term_months")
    + keep("contract_status", "currency_code", "external_order_ref")
    + typed(MONEY, "total_contract_value"),
    "subscriptions": keep("subscription_id", "contract_id", "account_id", "product_id")
    + typed("int", "quantity")
    + typed(MONEY, "annual_recurring_amount", "unit_price")
    + keep("billing_frequency")
    + renamed("subscription_start_date", "start_date", "date")
    + renamed("subscription_end_date", "end_date", "date")
    + typed("flag", "is_recurring")
    + renamed("subscription_status", "status"),
    "erp_customers": keep(
        "ns_customer_id", "customer_name", "sfdc_account_external_id", "subsidiary", "currency_code"
    ),
    "erp_items": keep("ns_item_id", "item_name", "item_type", "sfdc_product_external_id"),
    "erp_orders": keep("sales_order_id", "ns_customer_id", "order_number", "external_order_ref")
    + typed("date", "order_date")
    + keep("order_status")
    + typed(MONEY, "order_total")
    + keep("currency_code"),
    "erp_order_lines": keep("sales_order_line_id", "sales_order_id", "ns_item_id")
    + typed("int", "quantity")
    + typed(MONEY, "rate", "line_amount"),
    "erp_invoices": keep("invoice_id", "ns_customer_id", "sales_order_id", "invoice_number")
    + typed("date", "invoice_date")
    + typed(MONEY, "invoice_total")
    + keep("invoice_status", "currency_code"),
    "erp_invoice_lines": keep("invoice_line_id", "invoice_id", "ns_item_id")
    + typed("int", "quantity")
    + typed(MONEY, "rate", "line_amount"),
    "usage_monthly": keep("account_id", "product_id")
    + typed("date", "usage_month")
    + typed(UNITS, "consumed_units")
    + typed(MONEY, "consumed_value"),
}


def conform(raw: DataFrame, feed: str) -> DataFrame:
    """The typed table of a raw feed."""
    return raw.select(*[field.column() for field in SPECS[feed]])
