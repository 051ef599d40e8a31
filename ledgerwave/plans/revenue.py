"""The revenue marts, composed from the typed feeds."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from ledgerwave.operators import bookings, dims, movements, recon, snapshots, usage
from ledgerwave.operators.snapshots import DEFAULT_WINDOW, MonthWindow
from ledgerwave.sources import sample
from ledgerwave.sources.conform import conform
from ledgerwave.sources.layers import Dealt

MARTS = ("dim_account", "dim_product", "dim_sales_rep", "fct_acv", "fct_arr", "fct_usage", "rpt_recon")


@dataclass
class Revenue:
    """Every table of the warehouse as a lazy DataFrame; nothing runs until one is used."""

    feed: Callable[[str], DataFrame]
    window: MonthWindow = DEFAULT_WINDOW

    _staged: dict[str, DataFrame] = field(default_factory=dict)

    def staged(self, name: str) -> DataFrame:
        if name not in self._staged:
            self._staged[name] = conform(self.feed(name), name)
        return self._staged[name]

    @cached_property
    def contract_lines(self) -> DataFrame:
        return bookings.contract_lines_normalized(self.staged("subscriptions"), self.staged("products"))

    @cached_property
    def arr_changes(self) -> DataFrame:
        # The snapshot reads no product attribute, so it starts before that join.
        segments = self.staged("subscriptions").filter("is_recurring").withColumnRenamed(
            "quantity", "entitled_units"
        )
        return snapshots.run_rate_changes(segments, self.window)

    @cached_property
    def arr_spans(self) -> DataFrame:
        return snapshots.run_rate_spans(self.arr_changes, self.window)

    @cached_property
    def arr_account_product_month(self) -> DataFrame:
        return snapshots.expand_months(self.arr_spans)

    @cached_property
    def arr_history(self) -> DataFrame:
        return movements.ever_active_before(self.arr_spans, self.arr_changes)

    @cached_property
    def arr_movements(self) -> DataFrame:
        return movements.movement_buckets(movements.period_movement(self.arr_history, keep_inactive=False))

    @cached_property
    def fct_arr(self) -> DataFrame:
        return movements.fct_arr(self.arr_movements)

    def fct_arr_by_month(self) -> Dealt:
        """``fct_arr`` to be written by month: a span is dealt once for every year it touches, not for every month."""
        return Dealt(movements.by_year(self.arr_history, False), "year", movements.fct_arr_of_years)

    @cached_property
    def acv_lines(self) -> DataFrame:
        return bookings.opportunity_lines_acv(
            self.staged("opportunity_line_items"),
            self.staged("opportunities"),
            self.staged("products"),
            self.staged("users"),
        )

    @cached_property
    def fct_acv(self) -> DataFrame:
        return bookings.fct_acv(self.acv_lines)

    @cached_property
    def usage_rollup(self) -> DataFrame:
        return usage.usage_period_rollup(self.staged("usage_monthly"))

    @cached_property
    def fct_usage(self) -> DataFrame:
        return usage.fct_usage_of_spans(self.arr_spans, self.usage_rollup)

    @cached_property
    def recon_match(self) -> DataFrame:
        return recon.recon_classify(
            recon.reconcile(
                self.staged("contracts"),
                self.staged("erp_orders"),
                self.staged("erp_customers"),
                self.staged("erp_invoices"),
            )
        )

    @cached_property
    def rpt_recon(self) -> DataFrame:
        return recon.rpt_recon(self.recon_match)

    @cached_property
    def dim_account(self) -> DataFrame:
        return dims.dim_account(
            self.staged("accounts"),
            self.staged("users"),
            self.staged("erp_customers"),
            self.staged("contracts"),
            dims.current_run_rate(self.arr_spans, self.window),
        )

    @cached_property
    def dim_product(self) -> DataFrame:
        return dims.dim_product(self.staged("products"), self.staged("erp_items"))

    @cached_property
    def dim_sales_rep(self) -> DataFrame:
        return dims.dim_sales_rep(self.staged("users"))

    def __getitem__(self, name: str) -> DataFrame:
        """A mart by name, for operators that look tables up."""
        if name not in MARTS:
            raise KeyError(name)
        return getattr(self, name)

    def marts(self) -> dict[str, DataFrame]:
        return {name: self[name] for name in MARTS}


def sample_revenue(spark: SparkSession, folder: str) -> Revenue:
    """The warehouse over the sample tables."""
    tables = sample.Tables(spark, folder)
    return Revenue(
        lambda name: sample.load(tables, name), MonthWindow(sample.WINDOW_START, sample.WINDOW_END)
    )
