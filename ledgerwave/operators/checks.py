"""Q-1 to Q-10: data-quality checks as DataFrames of violations; no row means the check passes."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DataType, DateType, DecimalType, IntegralType, StringType

from ledgerwave.session import free_shuffles, fresh_path


def assert_unique(df: DataFrame, column: str) -> DataFrame:
    """Q-1: values that occur more than once."""
    return assert_unique_combination(df.filter(F.col(column).isNotNull()), column)


def assert_not_null(df: DataFrame, column: str) -> DataFrame:
    """Q-2: rows without a value."""
    return df.filter(F.col(column).isNull())


def assert_relationship(child: DataFrame, column: str, parent: DataFrame, field: str) -> DataFrame:
    """Q-3: foreign keys no parent has, with their number of rows.

    Keys are counted before the join, so a key that a third of the rows share
    crosses it once.
    """
    keys = child.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n_records"))
    return keys.join(parent.select(F.col(field).alias("parent_key")), F.col(column) == F.col("parent_key"), "left_anti")


def assert_accepted_values(df: DataFrame, column: str, values: Iterable[str]) -> DataFrame:
    """Q-4: values outside the accepted ones, with their number of rows."""
    return (
        df.groupBy(column).agg(F.count("*").alias("n_records")).filter(~F.col(column).isin(*values))
    )


def assert_unique_combination(df: DataFrame, *columns: str) -> DataFrame:
    """Q-5: combinations that occur more than once."""
    return df.groupBy(*columns).agg(F.count("*").alias("n_records")).filter("n_records > 1")


def assert_range(df: DataFrame, column: str, low: float | None = None, high: float | None = None) -> DataFrame:
    """Q-6: rows outside [low, high]."""
    return df.filter(_outside(F.col(column), low, high))


def _outside(value: Column, low: float | None, high: float | None) -> Column:
    bounds = []
    if low is not None:
        bounds.append(value < low)
    if high is not None:
        bounds.append(value > high)
    return reduce(lambda a, b: a | b, bounds)


def assert_waterfall_integrity(monthly: DataFrame, tolerance: str = "0.01") -> DataFrame:
    """Q-7: months in which beginning plus movements is not ending; takes one row per month."""
    rebuilt = (
        F.col("beginning_arr") + F.col("new_logo_arr") + F.col("cross_sell_arr") + F.col("upsell_arr")
        + F.col("downgrade_arr") + F.col("churn_arr")
    )
    return monthly.select(
        "measurement_month", "ending_arr", rebuilt.alias("reconstructed_ending_arr")
    ).filter(F.abs(F.col("ending_arr") - F.col("reconstructed_ending_arr")) > F.lit(tolerance).cast("decimal(18,2)"))


def assert_arr_continuity(monthly: DataFrame, tolerance: str = "0.01") -> DataFrame:
    """Q-8: months whose ending is not the next month's beginning; takes one row per month."""
    following = F.lead("beginning_arr").over(Window.orderBy("measurement_month"))
    return monthly.select(
        "measurement_month", "ending_arr", following.alias("next_month_beginning_arr")
    ).filter(F.abs(F.col("ending_arr") - F.col("next_month_beginning_arr")) > F.lit(tolerance).cast("decimal(18,2)"))


def acv_off(tolerance: str = "0.01") -> Column:
    parts = F.col("annual_recurring_amount") + F.col("one_time_amount")
    return F.abs(F.col("acv") - parts) > F.lit(tolerance).cast("decimal(18,2)")


def assert_acv_components(fct_acv: DataFrame) -> DataFrame:
    """Q-9: lines whose value is not the sum of its recurring and one-time parts."""
    return fct_acv.filter(acv_off()).select("acv_key", "acv", "annual_recurring_amount", "one_time_amount")


def assert_recon_counts(rpt_recon: DataFrame, expected: DataFrame) -> DataFrame:
    """Q-10: categories whose count is not the expected one; ``expected`` has category and expected_count."""
    actual = rpt_recon.groupBy("discrepancy_category").agg(F.count("*").alias("actual_count"))
    return (
        expected.join(actual, "discrepancy_category", "left")
        .withColumn("actual_count", F.coalesce("actual_count", F.lit(0)))
        .filter(F.col("expected_count") != F.col("actual_count"))
        .select("discrepancy_category", "expected_count", "actual_count")
    )


# --- the check suite ---------------------------------------------------------


@dataclass(frozen=True)
class Check:
    kind: str
    table: str
    columns: tuple[str, ...]
    values: tuple[str, ...] = ()
    parent: str = ""
    field: str = ""
    low: float | None = None

    @property
    def name(self) -> str:
        return "_".join([self.kind, self.table, *self.columns])


def unique_and_present(table: str, *columns: str) -> list[Check]:
    return [Check(kind, table, (c,)) for c in columns for kind in ("unique", "not_null")]


def present(table: str, *columns: str) -> list[Check]:
    return [Check("not_null", table, (c,)) for c in columns]


def refers(table: str, column: str, parent: str, field: str | None = None) -> Check:
    return Check("relationship", table, (column,), parent=parent, field=field or column)


def accepts(table: str, column: str, *values: str) -> Check:
    return Check("accepted_values", table, (column,), values=values)


def unique_together(table: str, *columns: str) -> Check:
    return Check("unique_combination", table, columns)


# The accepted values and the tests per table.
REVENUE_CATEGORIES = ("new_logo", "cross_sell", "upsell", "downgrade", "churn", "scheduled")
GENERIC_CHECKS: list[Check] = [
    *unique_and_present("accounts", "account_id"),
    refers("accounts", "owner_id", "users", "user_id"),
    *unique_and_present("users", "user_id"),
    *unique_and_present("products", "product_id"),
    *present("products", "is_recurring"),
    *unique_and_present("opportunities", "opportunity_id"),
    refers("opportunities", "account_id", "accounts"),
    accepts("opportunities", "opportunity_type", "New Business", "Expansion", "Renewal", "Downgrade", "Churn"),
    *present("opportunities", "is_won", "is_closed"),
    *unique_and_present("opportunity_line_items", "opportunity_line_id"),
    refers("opportunity_line_items", "opportunity_id", "opportunities"),
    refers("opportunity_line_items", "product_id", "products"),
    *unique_and_present("contracts", "contract_id"),
    refers("contracts", "account_id", "accounts"),
    *unique_and_present("subscriptions", "subscription_id"),
    refers("subscriptions", "account_id", "accounts"),
    refers("subscriptions", "product_id", "products"),
    *unique_and_present("erp_customers", "ns_customer_id"),
    refers("erp_customers", "sfdc_account_external_id", "accounts", "account_id"),
    *unique_and_present("erp_items", "ns_item_id"),
    *unique_and_present("erp_orders", "sales_order_id"),
    refers("erp_orders", "ns_customer_id", "erp_customers"),
    *unique_and_present("erp_order_lines", "sales_order_line_id"),
    refers("erp_order_lines", "sales_order_id", "erp_orders"),
    *unique_and_present("erp_invoices", "invoice_id"),
    *unique_and_present("erp_invoice_lines", "invoice_line_id"),
    refers("erp_invoice_lines", "invoice_id", "erp_invoices"),
    unique_together("usage_monthly", "account_id", "product_id", "usage_month"),
    refers("usage_monthly", "account_id", "accounts"),
    refers("usage_monthly", "product_id", "products"),
    *present("usage_monthly", "usage_month"),
    *unique_and_present("acv_lines", "opportunity_line_id"),
    *unique_and_present("contract_lines", "subscription_id"),
    unique_together("arr_account_product_month", "account_id", "product_id", "measurement_month"),
    accepts("arr_movements", "revenue_category", *REVENUE_CATEGORIES),
    *unique_and_present("dim_account", "account_key", "account_id"),
    accepts("dim_account", "geo_region", "NA", "EMEA", "APAC", "LATAM"),
    accepts("dim_account", "segment", "Enterprise", "Mid-Market", "SMB"),
    *unique_and_present("dim_product", "product_key", "product_id"),
    *present("dim_product", "is_recurring"),
    *unique_and_present("dim_sales_rep", "sales_rep_key", "user_id"),
    *unique_and_present("fct_acv", "acv_key", "opportunity_line_id"),
    refers("fct_acv", "account_key", "dim_account"),
    refers("fct_acv", "product_key", "dim_product"),
    refers("fct_acv", "sales_rep_key", "dim_sales_rep"),
    accepts("fct_acv", "revenue_category", *REVENUE_CATEGORIES),
    *present("fct_acv", "is_closed_won"),
    unique_together("fct_arr", "account_id", "product_id", "measurement_month"),
    *unique_and_present("fct_arr", "arr_key"),
    refers("fct_arr", "account_key", "dim_account"),
    refers("fct_arr", "product_key", "dim_product"),
    *present("fct_arr", "measurement_month"),
    accepts("fct_arr", "revenue_category", *REVENUE_CATEGORIES),
    unique_together("fct_usage", "account_id", "product_id", "usage_month"),
    *unique_and_present("fct_usage", "usage_key"),
    refers("fct_usage", "account_key", "dim_account"),
    refers("fct_usage", "product_key", "dim_product"),
    Check("range", "fct_usage", ("utilization_pct",), low=0),
    *unique_and_present("rpt_recon", "recon_key"),
    refers("rpt_recon", "account_key", "dim_account"),
    accepts("rpt_recon", "match_status", "matched", "variance", "unmatched_sfdc", "unmatched_netsuite"),
    accepts(
        "rpt_recon", "discrepancy_category", "matched_clean", "amount_mismatch", "missing_in_netsuite",
        "orphan_in_netsuite", "currency_rounding", "timing_difference", "partially_invoiced",
    ),
]

ROW_KINDS = ("not_null", "range")
UNIQUE_KINDS = ("unique", "unique_combination")
#: Hashes that a task of the checks of uniqueness takes, so that it need not spill.
HASHES_OF_A_TASK = 2_000_000
#: Values of these types are equal just where their strings are.
HASHED_AS_THEY_ARE = (StringType, IntegralType, BooleanType, DateType, DecimalType)


def _checked_value(check: Check) -> Column:
    """What a row contributes to a check: the value looked at, or a mark if the row itself fails."""
    value = F.col(check.columns[0])
    if check.kind in ROW_KINDS:
        failed = value.isNull() if check.kind == "not_null" else _outside(value, check.low, None)
        return F.when(failed, "failed")
    parts = [F.col(c).cast("string") for c in check.columns]
    return parts[0] if len(parts) == 1 else F.to_json(F.struct(*parts))


def _value_counts(df: DataFrame, checks: list[Check], *also: Column) -> DataFrame:
    """(check, value, rows) for every check of one table, in one pass over it, by ``also`` if given."""
    pairs = F.array(*[F.struct(F.lit(c.name).alias("name"), _checked_value(c).alias("value")) for c in checks])
    return (
        df.select(*also, F.inline(pairs))
        .filter(F.col("value").isNotNull())
        .groupBy(*(["part"] if also else []), "name", "value")
        .agg(F.count("*").alias("n"))
    )


def _hash(check: Check, nth: int, types: Mapping[str, DataType]) -> Column:
    """A number that is the same for equal values of a check; null where a row has no value."""
    parts = [F.col(c) if isinstance(types[c], HASHED_AS_THEY_ARE) else F.col(c).cast("string") for c in check.columns]
    number = F.xxhash64(F.lit(nth), *parts)
    return number if len(parts) > 1 else F.when(parts[0].isNotNull(), number)


def _repeated_values(spark: SparkSession, tables: Mapping[str, DataFrame], checks: list[Check]) -> DataFrame:
    """(name, value, n) for the values that occur more than once under checks of uniqueness, and perhaps a few others.

    Nearly all values are distinct, so nothing is gained by counting them before a shuffle. Only a hash of each is
    shuffled; values are looked at, in a second pass, where a hash occurs twice.
    """
    by_table: dict[str, list[tuple[Check, Column]]] = {}
    for nth, check in enumerate(checks):
        types = {field.name: field.dataType for field in tables[check.table].schema}
        by_table.setdefault(check.table, []).append((check, _hash(check, nth, types)))

    hashes = [
        tables[name].select(F.explode(F.array(*[number for _, number in group])).alias("hash")).filter("hash is not null")
        for name, group in by_table.items()
    ]
    path = fresh_path(spark, "repeated")
    number_of_hashes = sum(tables[name].count() * len(group) for name, group in by_table.items())
    dealt = reduce(DataFrame.unionByName, hashes).repartition(max(1, number_of_hashes // HASHES_OF_A_TASK), "hash")
    several = dealt.groupBy("hash").agg(F.count("*").alias("n"))
    several.filter("n > 1").select("hash").write.parquet(path)
    repeated = spark.read.schema("hash long").parquet(path)
    if not repeated.take(1):
        return spark.createDataFrame([], "name string, value string, n long")

    def values(name: str) -> DataFrame:
        rows = [
            F.struct(F.lit(check.name).alias("name"), _checked_value(check).alias("value"), number.alias("hash"))
            for check, number in by_table[name]
        ]
        return tables[name].select(F.inline(F.array(*rows)))

    looked_at = reduce(DataFrame.unionByName, map(values, by_table)).join(repeated, "hash", "left_semi")
    return looked_at.groupBy("name", "value").agg(F.count("*").alias("n"))


def _partitions(table: DataFrame, column: str) -> set[str | None]:
    """The values of a partition column, from the names of folders if it is one; there are as many as months."""
    named = [re.search(f"/{re.escape(column)}=([^/]+)/", path) for path in table.inputFiles()]
    if named and all(named):
        values = {unquote(m[1]) for m in named}
        return {None if v == "__HIVE_DEFAULT_PARTITION__" else v for v in values}
    return {r[0] for r in table.select(F.col(column).cast("string")).distinct().collect()}


class KeptCounts:
    """Value counts of a table's checks, kept by partition of the table.

    Counts of values add up over partitions, and from them every check is judged, uniqueness over
    all partitions too. So a month that is new, or named as changed, is counted alone, and no file
    of another is read.
    """

    def __init__(self, spark: SparkSession, folder: str, partitions: Mapping[str, str]) -> None:
        """``partitions`` has the partition column of every table whose counts are kept."""
        self.spark, self.folder, self.partitions = spark, folder.rstrip("/"), partitions

    def counts(self, name: str, table: DataFrame, checks: list[Check], changed: Sequence = ()) -> DataFrame:
        """(name, value, n) over all partitions of ``table``, which those in ``changed`` are counted anew for."""
        column = self.partitions[name]
        path = f"{self.folder}/{name}"
        known = self._known(path)
        present = _partitions(table, column)
        again = {str(c) for c in changed}
        wanted = sorted((present - (known - again)) - {None})
        if wanted or None in present:
            fresh = table.filter(F.col(column).cast("string").isin(wanted) | F.col(column).isNull())
            counted = _value_counts(fresh, checks, F.coalesce(F.col(column).cast("string"), F.lit("none")).alias("part"))
            # Most values are keys of hex digits, which zstd stores in half of the space.
            writer = counted.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd")
            writer.partitionBy("part").parquet(path)
            free_shuffles(self.spark)
        kept = self.spark.read.schema("name string, value string, n long, part string").parquet(path)
        gone = known - present - {"none"}
        return kept.filter(~F.col("part").isin(*gone)).groupBy("name", "value").agg(F.sum("n").alias("n"))

    def _known(self, path: str) -> set[str]:
        try:
            return {r[0] for r in self.spark.read.parquet(path).select(F.col("part").cast("string")).distinct().collect()}
        except AnalysisException as missing:
            if missing.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
            return set()


def run_checks(
    spark: SparkSession,
    tables: Mapping[str, DataFrame],
    checks: list[Check] = GENERIC_CHECKS,
    kept: KeptCounts | None = None,
    changed: Mapping[str, Sequence] | None = None,
) -> DataFrame:
    """Every check with its number of violations.

    Each table is read once to count equal values, or only its new and ``changed`` partitions where
    counts are ``kept``. That settles row-level checks and accepted values, and after
    one join for all of them the references, whose parents are read once per key. Uniqueness is
    settled by hashes (``_repeated_values``), or by the counts that are kept.
    """

    def is_kept(name: str) -> bool:
        return kept is not None and name in kept.partitions

    unique = [c for c in checks if c.kind in UNIQUE_KINDS and not is_kept(c.table)]
    by_table: dict[str, list[Check]] = {}
    for check in checks:
        if check not in unique:
            by_table.setdefault(check.table, []).append(check)

    def counts(name: str, group: list[Check]) -> DataFrame:
        if not is_kept(name):
            return _value_counts(tables[name], group)
        return kept.counts(name, tables[name], group, (changed or {}).get(name, ()))

    values = [counts(table, group) for table, group in by_table.items()]
    if unique:
        values.append(_repeated_values(spark, tables, unique))
    kinds = spark.createDataFrame(
        [(c.name, c.kind, c.table, ", ".join(c.columns), list(c.values)) for c in checks],
        "name string, kind string, table string, columns string, accepted array<string>",
    )
    counted = reduce(DataFrame.unionByName, values).join(F.broadcast(kinds.select("name", "kind", "accepted")), "name")

    references = [c for c in checks if c.kind == "relationship"]
    by_key: dict[tuple[str, str], list[str]] = {}
    for c in references:
        by_key.setdefault((c.parent, c.field), []).append(c.name)
    none = spark.createDataFrame([], "name string, value string")
    keys = [
        tables[parent].select(F.explode(F.array(*map(F.lit, names))).alias("name"), F.col(field).cast("string").alias("value"))
        for (parent, field), names in by_key.items()
    ]
    parents = reduce(DataFrame.unionByName, keys, none).distinct()
    kind, rows_of_value = F.col("kind"), F.col("n")
    violations = (
        F.when(kind == "relationship", F.when(F.col("has_parent").isNull(), rows_of_value).otherwise(0))
        .when(kind.isin(*ROW_KINDS), rows_of_value)
        .when(kind == "accepted_values", F.when(F.array_contains("accepted", F.col("value")), 0).otherwise(1))
        .otherwise(F.when(rows_of_value > 1, 1).otherwise(0))
    )
    judged = counted.join(parents.withColumn("has_parent", F.lit(True)), ["name", "value"], "left").select(
        "name", violations.cast("bigint").alias("violations")
    )
    total = judged.groupBy("name").agg(F.sum("violations").alias("violations"))
    return kinds.join(total, "name", "left").select(
        "name", "kind", "table", "columns", F.coalesce("violations", F.lit(0)).alias("violations")
    )
