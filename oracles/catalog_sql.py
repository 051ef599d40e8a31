"""The SQL of every query that has one, by query name."""

from __future__ import annotations

from collections import namedtuple

from oracles import bout_sql
from oracles.ctes import assemble

FINAL: dict[str, str] = {}


def money(table: str, *columns: str) -> str:
    """All of a block, with the named exact columns as doubles."""
    replaced = ", ".join(f"cast({c} AS double) AS {c}" for c in columns)
    return f"SELECT * REPLACE ({replaced}) FROM {table}"


def doubles(*columns: str) -> str:
    return ", ".join(f"cast(sum({c}) AS double) AS {c}" for c in columns)


for _name in ("accounts", "users", "erp_customers", "erp_items"):
    FINAL[f"stg_{_name}"] = f"SELECT * FROM st_{_name}"
FINAL["stg_products"] = money("st_products", "list_unit_price")
FINAL["stg_opportunities"] = money("st_opportunities", "opportunity_amount")
FINAL["stg_opportunity_lines"] = money("st_opportunity_lines", "unit_price", "line_amount")
FINAL["stg_contracts"] = money("st_contracts", "total_contract_value")
FINAL["stg_subscriptions"] = money("st_subscriptions", "annual_recurring_amount", "unit_price")
FINAL["stg_erp_orders"] = money("st_erp_orders", "order_total")
FINAL["stg_erp_order_lines"] = money("st_erp_order_lines", "rate", "line_amount")
FINAL["stg_erp_invoices"] = money("st_erp_invoices", "invoice_total")
FINAL["stg_erp_invoice_lines"] = money("st_erp_invoice_lines", "rate", "line_amount")
FINAL["stg_usage_monthly"] = money("st_usage_monthly", "consumed_units", "consumed_value")

FINAL["contract_lines_normalized"] = money("contract_lines", "annual_recurring_amount")
FINAL["active_on_snapshot"] = money("active", "arr")
FINAL["first_active"] = "SELECT * FROM pairs_first"
FINAL["densify"] = money("apm", "arr")
FINAL["arr_account_product_month"] = money("apm", "arr")
FINAL["ever_active_before"] = """
  SELECT account_id, product_id, measurement_month, cast(prior_arr AS double) AS prior_arr,
         product_active_before, account_active_before
  FROM classified"""
FINAL["period_movement"] = """
  SELECT account_id, product_id, measurement_month, cast(prior_arr AS double) AS beginning_arr,
         cast(arr AS double) AS ending_arr, cast(arr_change AS double) AS arr_change, entitled_units, revenue_category
  FROM classified"""
ARR_MONEY = (
    "beginning_arr", "ending_arr", "arr_change", "new_logo_arr", "cross_sell_arr", "upsell_arr", "downgrade_arr",
    "churn_arr", "scheduled_arr",
)
FINAL["movement_buckets"] = money("movements", *ARR_MONEY)
FINAL["fct_arr"] = money("m_fct_arr", *ARR_MONEY)
FINAL["opportunity_acv_tcv"] = money(
    "acv_joined", "unit_price", "line_amount", "annual_recurring_amount", "one_time_amount", "acv"
)
FINAL["first_won_dates"] = """
  SELECT DISTINCT account_id, product_id, product_first_won_date, account_first_won_date FROM acv_history"""
FINAL["deal_motion"] = """
  SELECT revenue_category, opportunity_type, is_won, count(*) AS lines, cast(sum(acv) AS double) AS acv
  FROM acv_lines GROUP BY 1, 2, 3"""
FINAL["fct_acv"] = money("m_fct_acv", "annual_recurring_amount", "one_time_amount", "acv")
FINAL["surrogate_key"] = (
    "SELECT opportunity_line_id, acv_key, account_key, product_key, sales_rep_key FROM m_fct_acv"
)
FINAL["usage_period_rollup"] = money("usage_rollup", "consumed_units", "consumed_value")
FINAL["fct_usage"] = money("m_fct_usage", "consumed_units", "consumed_value", "entitled_arr", "overage_units")
FINAL["invoice_coverage"] = money("invoice_totals", "ns_invoice_amount")
RECON = """account_id, contract_id, contract_number, external_order_ref, sales_order_id, order_number,
  contract_start_date, order_date, cast(sfdc_contract_amount AS double) AS sfdc_contract_amount,
  cast(ns_order_amount AS double) AS ns_order_amount, cast(ns_invoice_amount AS double) AS ns_invoice_amount,
  cast(amount_variance AS double) AS amount_variance, amount_variance_pct, date_variance_days, currency_variance,
  invoice_coverage_pct"""
FINAL["reconcile"] = f"SELECT {RECON} FROM recon"
FINAL["recon_classify"] = "SELECT contract_id, sales_order_id, match_status, discrepancy_category FROM recon"
FINAL["rpt_recon"] = money(
    "m_rpt_recon", "sfdc_contract_amount", "ns_order_amount", "ns_invoice_amount", "amount_variance"
)
for _name in ("dim_account", "dim_product", "dim_sales_rep"):
    FINAL[_name] = f"SELECT * FROM m_{_name}"

YEAR = "cast(extract(year FROM measurement_month) AS integer)"
FINAL["arr_bridge_by_period"] = f"""
  SELECT m.*, e.ending_arr
  FROM (SELECT {YEAR} AS fiscal_year, 'Q' || cast(extract(quarter FROM measurement_month) AS integer) AS fiscal_quarter,
               {doubles('new_logo_arr', 'cross_sell_arr', 'upsell_arr')},
               cast(sum(upsell_arr + cross_sell_arr) AS double) AS expansion_arr,
               {doubles('downgrade_arr', 'churn_arr')}, cast(sum(arr_change) AS double) AS net_new_arr
        FROM movements GROUP BY 1, 2) m
  LEFT JOIN (
    SELECT q.fiscal_year, q.fiscal_quarter, cast(sum(f.ending_arr) AS double) AS ending_arr
    FROM movements f JOIN (
      SELECT {YEAR} AS fiscal_year, 'Q' || cast(extract(quarter FROM measurement_month) AS integer) AS fiscal_quarter,
             max(measurement_month) AS quarter_end FROM movements GROUP BY 1, 2) q
      ON f.measurement_month = q.quarter_end GROUP BY 1, 2) e
  ON m.fiscal_year = e.fiscal_year AND m.fiscal_quarter = e.fiscal_quarter
  ORDER BY 1, 2"""
AT_RISK = "sum(abs(coalesce(amount_variance, sfdc_contract_amount, ns_order_amount)))"
FINAL["recon_summary"] = f"""
  SELECT discrepancy_category, match_status, count(*) AS record_count,
         cast(round({AT_RISK}, 0) AS double) AS dollars_at_risk
  FROM recon GROUP BY 1, 2 ORDER BY 4 DESC, 1"""
FINAL["arr_trend"] = """
  SELECT strftime(measurement_month, '%Y-%m') AS ym, cast(sum(ending_arr) AS double) AS arr
  FROM movements GROUP BY 1 ORDER BY 1"""
FINAL["arr_movement_by_year"] = f"""
  SELECT {YEAR} AS yr, cast(sum(new_logo_arr) AS double) AS new_logo,
         cast(sum(cross_sell_arr + upsell_arr) AS double) AS expansion, cast(sum(downgrade_arr) AS double) AS downgrade,
         cast(sum(churn_arr) AS double) AS churn, cast(sum(arr_change) AS double) AS net_new
  FROM movements GROUP BY 1 ORDER BY 1"""
FINAL["year_end_arr"] = f"""
  SELECT y.yr, cast(sum(f.ending_arr) AS double) AS ending_arr
  FROM movements f JOIN (SELECT {YEAR} AS yr, max(measurement_month) AS m FROM movements GROUP BY 1) y
    ON f.measurement_month = y.m
  GROUP BY 1 ORDER BY 1"""
BASE = "nullif(cast(sum(beginning_arr) AS double), 0)"
FINAL["retention_kpis"] = f"""
  SELECT cast(sum(beginning_arr) + sum(upsell_arr) + sum(cross_sell_arr) + sum(downgrade_arr) + sum(churn_arr) AS double)
           / {BASE} AS nrr,
         cast(sum(beginning_arr) + sum(downgrade_arr) + sum(churn_arr) AS double) / {BASE} AS grr,
         cast((SELECT sum(ending_arr) FROM movements
               WHERE measurement_month = (SELECT max(measurement_month) FROM movements)) AS double) AS ending_arr
  FROM movements"""
CATEGORY_LABEL = """CASE revenue_category WHEN 'new_logo' THEN 'New logo' WHEN 'cross_sell' THEN 'Cross-sell'
  WHEN 'upsell' THEN 'Upsell' WHEN 'scheduled' THEN 'Renewal' WHEN 'downgrade' THEN 'Downgrade'
  WHEN 'churn' THEN 'Churn' END"""
FINAL["bookings_by_category"] = f"""
  SELECT revenue_category, cast(sum(acv) AS double) AS acv, {CATEGORY_LABEL} AS label
  FROM acv_lines WHERE is_closed_won AND acv > 0 GROUP BY 1 ORDER BY 2 DESC"""
FINAL["bookings_by_segment"] = """
  SELECT a.segment, cast(sum(f.acv) AS double) AS acv, count(DISTINCT f.opportunity_id) AS deals
  FROM m_fct_acv f JOIN m_dim_account a USING (account_key) WHERE f.is_closed_won GROUP BY 1 ORDER BY 2 DESC"""
FINAL["open_pipeline"] = """
  SELECT cast(sum(acv) AS double) AS acv, count(DISTINCT opportunity_id) AS opportunities
  FROM acv_lines WHERE NOT is_closed"""
FINAL["latest_year_bookings"] = """
  SELECT sales_year, cast(sum(acv) AS double) AS acv FROM acv_lines
  WHERE is_closed_won AND sales_year = (SELECT max(sales_year) FROM acv_lines WHERE is_closed_won) GROUP BY 1"""
FINAL["utilization_buckets"] = """
  SELECT cast(sum(CASE WHEN utilization_pct > 1 THEN 1 ELSE 0 END) AS bigint) AS over_ent,
         cast(sum(CASE WHEN utilization_pct BETWEEN 0.5 AND 1 THEN 1 ELSE 0 END) AS bigint) AS healthy,
         cast(sum(CASE WHEN utilization_pct < 0.5 THEN 1 ELSE 0 END) AS bigint) AS under_util, count(*) AS total
  FROM m_fct_usage"""
DISCREPANCY_LABEL = """CASE discrepancy_category WHEN 'missing_in_netsuite' THEN 'Missing in NetSuite'
  WHEN 'amount_mismatch' THEN 'Amount mismatch' WHEN 'orphan_in_netsuite' THEN 'Orphan in NetSuite'
  WHEN 'currency_rounding' THEN 'Currency rounding' WHEN 'timing_difference' THEN 'Timing difference'
  WHEN 'partially_invoiced' THEN 'Partially invoiced' END"""
FINAL["at_risk_by_category"] = f"""
  SELECT discrepancy_category, count(*) AS n, cast({AT_RISK} AS double) AS at_risk, {DISCREPANCY_LABEL} AS label
  FROM recon WHERE discrepancy_category <> 'matched_clean' GROUP BY 1 ORDER BY 3 DESC"""
MILLIONS = "'$' || cast(round(cast({} AS decimal(38,2)) / 1000000, 1) AS decimal(18,1)) || 'M'"
PERCENT = "cast(cast(round({} * 100) AS bigint) AS varchar) || '%'"
FINAL["kpi_frame"] = f"""
  SELECT 1 AS position, 'Ending ARR' AS label, {MILLIONS.format('sum(ending_arr)')} AS value,
         strftime(max(measurement_month), '%b %Y') || ' run-rate' AS sub
  FROM movements WHERE measurement_month = (SELECT max(measurement_month) FROM movements)
  UNION ALL SELECT 2, 'Net Revenue Retention', {PERCENT.format(
      'cast(sum(beginning_arr + upsell_arr + cross_sell_arr + downgrade_arr + churn_arr) AS double) / ' + BASE)},
         'period approximation' FROM movements
  UNION ALL SELECT 3, 'Gross Revenue Retention', {PERCENT.format(
      'cast(sum(beginning_arr + downgrade_arr + churn_arr) AS double) / ' + BASE)},
         'period approximation' FROM movements
  UNION ALL SELECT 4, 'Bookings ACV (FY' || max(sales_year) || ')', {MILLIONS.format('sum(acv)')}, 'closed-won'
  FROM acv_lines WHERE is_closed_won
    AND sales_year = (SELECT max(sales_year) FROM acv_lines WHERE is_closed_won)
  UNION ALL SELECT 5, 'Open Pipeline ACV', {MILLIONS.format('sum(acv)')},
         count(DISTINCT opportunity_id) || ' opportunities' FROM acv_lines WHERE NOT is_closed
  UNION ALL SELECT 6, '$ at risk (recon)', {MILLIONS.format(AT_RISK)}, 'SFDC vs NetSuite'
  FROM recon WHERE discrepancy_category <> 'matched_clean'"""


# --- metric layer ----------------------------------------------------------------

def total(expr: str, name: str, where: str = "TRUE") -> str:
    return f"cast(sum(CASE WHEN {where} THEN {expr} END) AS double) AS {name}"


WON, OPEN = "is_closed AND is_won", "NOT is_closed"
ARR_METRICS = {
    "total_arr": "ending_arr", "beginning_arr": "beginning_arr", "net_new_arr": "arr_change",
    "new_logo_arr": "new_logo_arr", "cross_sell_arr": "cross_sell_arr", "upsell_arr": "upsell_arr",
    "downgrade_arr": "downgrade_arr", "churned_arr": "churn_arr",
}
ARR_SUMS = ", ".join(total(e, n) for n, e in ARR_METRICS.items())
WON_COUNT = f"cast(count(DISTINCT CASE WHEN {WON} THEN opportunity_id END) AS double) AS won_opportunity_count"
ACV_SUMS = ", ".join([
    total("acv", "bookings_acv", WON), total("acv", "pipeline_acv", OPEN),
    total("acv", "new_logo_bookings_acv", f"{WON} AND revenue_category = 'new_logo'"), WON_COUNT,
])
USAGE_SUMS = ", ".join([
    total("consumed_value", "total_consumed_value"), total("consumed_units", "total_consumed_units"),
    total("entitled_units", "total_entitled_units"),
])


def period(grain: str, column: str) -> str:
    return f"cast(date_trunc('{grain}', {column}) AS date) AS metric_time"


FINAL["semantic_model"] = "\nUNION ALL ".join(
    f"SELECT '{model}' AS model, '{name}' AS measure, cast({expr} AS double) AS value FROM {table}"
    for model, table, name, expr in [
        *[("arr", "movements", n, f"sum({e})") for n, e in (
            ("ending_arr", "ending_arr"), ("beginning_arr", "beginning_arr"), ("net_new_arr", "arr_change"),
            ("new_logo_arr", "new_logo_arr"), ("cross_sell_arr", "cross_sell_arr"), ("upsell_arr", "upsell_arr"),
            ("downgrade_arr", "downgrade_arr"), ("churn_arr", "churn_arr"))],
        ("acv", "acv_lines", "acv_amount", "sum(acv)"),
        ("acv", "acv_lines", "tcv_amount", "sum(cast(tcv AS decimal(38,6)))"),
        ("acv", "acv_lines", "opportunity_count", "count(DISTINCT opportunity_id)"),
        ("usage", "m_fct_usage", "consumed_value", "sum(consumed_value)"),
        ("usage", "m_fct_usage", "consumed_units_total", "sum(consumed_units)"),
        ("usage", "m_fct_usage", "entitled_units_total", "sum(entitled_units)"),
    ]
)
FINAL["simple_metric"] = f"""
  SELECT * FROM (SELECT {period('year', 'measurement_month')}, {ARR_SUMS} FROM movements GROUP BY 1) a
  FULL JOIN (SELECT {period('year', 'close_date')}, {ACV_SUMS} FROM acv_lines GROUP BY 1) b USING (metric_time)
  FULL JOIN (SELECT {period('year', 'usage_month')}, {USAGE_SUMS} FROM m_fct_usage GROUP BY 1) c USING (metric_time)"""
FINAL["metric_filter"] = f"SELECT opportunity_type, {ACV_SUMS} FROM acv_lines GROUP BY 1"
FINAL["derived_metric"] = f"""
  SELECT metric_time, upsell_arr + cross_sell_arr AS expansion_arr,
         (beginning_arr + downgrade_arr + churned_arr) / nullif(beginning_arr, 0) AS gross_revenue_retention,
         (beginning_arr + upsell_arr + cross_sell_arr + downgrade_arr + churned_arr) / nullif(beginning_arr, 0)
           AS net_revenue_retention,
         bookings_acv / nullif(won_opportunity_count, 0) AS average_deal_acv
  FROM (SELECT {period('quarter', 'measurement_month')}, {ARR_SUMS} FROM movements GROUP BY 1)
  FULL JOIN (SELECT {period('quarter', 'close_date')}, {ACV_SUMS} FROM acv_lines GROUP BY 1) USING (metric_time)"""
FINAL["ratio_metric"] = f"""
  SELECT metric_time, total_consumed_units / nullif(total_entitled_units, 0) AS average_utilization
  FROM (SELECT {period('quarter', 'usage_month')}, {USAGE_SUMS} FROM m_fct_usage GROUP BY 1)"""
FINAL["metric_by_dimension"] = f"""
  SELECT a.segment AS account__segment, u.sales_region AS sales_rep__sales_region, {period('quarter', 'f.close_date')},
         {total('f.acv', 'bookings_acv', WON)}, {WON_COUNT}
  FROM acv_lines f LEFT JOIN st_accounts a USING (account_id) LEFT JOIN st_users u ON f.owner_id = u.user_id
  GROUP BY 1, 2, 3"""
FINAL["metric_where"] = f"""
  SELECT u.sales_region AS sales_rep__sales_region, {period('year', 'f.close_date')},
         {total('f.acv', 'bookings_acv', WON)}, {total('f.acv', 'pipeline_acv', OPEN)}
  FROM acv_lines f LEFT JOIN st_accounts a USING (account_id) LEFT JOIN st_users u ON f.owner_id = u.user_id
  WHERE a.segment = 'BUILDING' OR a.segment IS NULL
  GROUP BY 1, 2"""
FINAL["metric_last_snapshot"] = f"""
  SELECT a.segment AS account__segment, {period('year', 'f.measurement_month')},
         {total('f.ending_arr', 'total_arr', 'f.measurement_month = y.latest')}, {total('f.arr_change', 'net_new_arr')}
  FROM movements f LEFT JOIN st_accounts a USING (account_id)
  JOIN (SELECT {YEAR} AS yr, max(measurement_month) AS latest FROM movements GROUP BY 1) y
    ON y.yr = cast(extract(year FROM f.measurement_month) AS integer)
  GROUP BY 1, 2"""
DAYS = """(SELECT cast(d AS date) AS metric_time
   FROM unnest(generate_series(timestamp '1995-01-01', timestamp '2001-12-31', interval 1 day)) AS t(d))"""
FINAL["metric_time_fill"] = f"""
  SELECT metric_time, coalesce(bookings_acv, 0) AS bookings_acv, coalesce(pipeline_acv, 0) AS pipeline_acv
  FROM {DAYS} LEFT JOIN (SELECT {period('day', 'close_date')}, {ACV_SUMS} FROM acv_lines GROUP BY 1) USING (metric_time)"""

# --- checks --------------------------------------------------------------------------

FINAL["assert_unique"] = """
  SELECT opportunity_id, count(*) AS n_records FROM st_opportunity_lines GROUP BY 1 HAVING count(*) > 1"""
FINAL["assert_not_null"] = (
    money("st_opportunities", "opportunity_amount") + " WHERE contract_id IS NULL"
)
FINAL["assert_relationship"] = """
  SELECT external_order_ref, count(*) AS n_records FROM st_contracts
  WHERE external_order_ref NOT IN (SELECT sales_order_id FROM st_erp_orders) GROUP BY 1"""
FINAL["assert_accepted_values"] = """
  SELECT geo_region, count(*) AS n_records FROM st_accounts
  WHERE geo_region NOT IN ('NA', 'EMEA', 'APAC', 'LATAM') GROUP BY 1"""
FINAL["assert_unique_combination"] = """
  SELECT account_id, product_id, count(*) AS n_records FROM st_subscriptions GROUP BY 1, 2 HAVING count(*) > 1"""
FINAL["assert_range"] = """
  SELECT account_id, product_id, usage_month, utilization_pct FROM m_fct_usage
  WHERE utilization_pct < 0 OR utilization_pct > 1.2"""
FINAL["assert_waterfall_integrity"] = """
  SELECT measurement_month, cast(ending_arr AS double) AS ending_arr,
         cast(rebuilt AS double) AS reconstructed_ending_arr
  FROM (SELECT measurement_month, sum(ending_arr) AS ending_arr, sum(beginning_arr)
          + sum(new_logo_arr + cross_sell_arr + upsell_arr + downgrade_arr + churn_arr) AS rebuilt
        FROM movements GROUP BY 1)
  WHERE abs(ending_arr - rebuilt) > 0.01"""
FINAL["assert_arr_continuity"] = """
  SELECT measurement_month, cast(ending_arr AS double) AS ending_arr,
         cast(following AS double) AS next_month_beginning_arr
  FROM (SELECT measurement_month, ending_arr, lead(beginning_arr) OVER (ORDER BY measurement_month) AS following
        FROM (SELECT measurement_month, sum(ending_arr) AS ending_arr, sum(beginning_arr) AS beginning_arr
              FROM movements GROUP BY 1))
  WHERE following IS NOT NULL AND abs(ending_arr - following) > 0.01"""
FINAL["assert_acv_components"] = """
  SELECT acv_key, cast(acv AS double) AS acv, cast(annual_recurring_amount AS double) AS annual_recurring_amount,
         cast(one_time_amount AS double) AS one_time_amount
  FROM m_fct_acv WHERE abs(acv - (annual_recurring_amount + one_time_amount)) > 0.01"""
FINAL["assert_recon_counts"] = """
  SELECT e.discrepancy_category, e.expected_count, coalesce(a.actual_count, 0) AS actual_count
  FROM (SELECT unnest(['orphan_in_netsuite', 'missing_in_netsuite', 'amount_mismatch', 'currency_rounding',
                       'partially_invoiced', 'timing_difference']) AS discrepancy_category,
               (SELECT count(*) // 50 FROM orders) AS expected_count) e
  LEFT JOIN (SELECT discrepancy_category, count(*) AS actual_count FROM recon GROUP BY 1) a USING (discrepancy_category)
  WHERE e.expected_count <> coalesce(a.actual_count, 0)"""

# SQL block that stands for each table of the check suite.
CHECK_BLOCKS = {
    "accounts": "st_accounts", "users": "st_users", "products": "st_products", "opportunities": "st_opportunities",
    "opportunity_line_items": "st_opportunity_lines", "contracts": "st_contracts",
    "subscriptions": "st_subscriptions", "erp_customers": "st_erp_customers", "erp_items": "st_erp_items",
    "erp_orders": "st_erp_orders", "erp_order_lines": "st_erp_order_lines", "erp_invoices": "st_erp_invoices",
    "erp_invoice_lines": "st_erp_invoice_lines", "usage_monthly": "st_usage_monthly", "acv_lines": "acv_lines",
    "contract_lines": "contract_lines", "arr_account_product_month": "apm", "arr_movements": "movements",
    "dim_account": "m_dim_account", "dim_product": "m_dim_product", "dim_sales_rep": "m_dim_sales_rep",
    "fct_acv": "m_fct_acv", "fct_arr": "m_fct_arr", "fct_usage": "m_fct_usage", "rpt_recon": "m_rpt_recon",
}


# The tests of each table. "key" is unique and not null; a reference names its parent's column.
CHECKS = """
accounts: key account_id; refers owner_id users.user_id
users: key user_id
products: key product_id; present is_recurring
opportunities: key opportunity_id; refers account_id accounts.account_id;
  accepts opportunity_type New Business|Expansion|Renewal|Downgrade|Churn; present is_won; present is_closed
opportunity_line_items: key opportunity_line_id; refers opportunity_id opportunities.opportunity_id;
  refers product_id products.product_id
contracts: key contract_id; refers account_id accounts.account_id
subscriptions: key subscription_id; refers account_id accounts.account_id; refers product_id products.product_id
erp_customers: key ns_customer_id; refers sfdc_account_external_id accounts.account_id
erp_items: key ns_item_id
erp_orders: key sales_order_id; refers ns_customer_id erp_customers.ns_customer_id
erp_order_lines: key sales_order_line_id; refers sales_order_id erp_orders.sales_order_id
erp_invoices: key invoice_id
erp_invoice_lines: key invoice_line_id; refers invoice_id erp_invoices.invoice_id
usage_monthly: together account_id,product_id,usage_month; refers account_id accounts.account_id;
  refers product_id products.product_id; present usage_month
acv_lines: key opportunity_line_id
contract_lines: key subscription_id
arr_account_product_month: together account_id,product_id,measurement_month
arr_movements: accepts revenue_category new_logo|cross_sell|upsell|downgrade|churn|scheduled
dim_account: key account_key; key account_id; accepts geo_region NA|EMEA|APAC|LATAM;
  accepts segment Enterprise|Mid-Market|SMB
dim_product: key product_key; key product_id; present is_recurring
dim_sales_rep: key sales_rep_key; key user_id
fct_acv: key acv_key; key opportunity_line_id; refers account_key dim_account.account_key;
  refers product_key dim_product.product_key; refers sales_rep_key dim_sales_rep.sales_rep_key;
  accepts revenue_category new_logo|cross_sell|upsell|downgrade|churn|scheduled; present is_closed_won
fct_arr: together account_id,product_id,measurement_month; key arr_key; refers account_key dim_account.account_key;
  refers product_key dim_product.product_key; present measurement_month;
  accepts revenue_category new_logo|cross_sell|upsell|downgrade|churn|scheduled
fct_usage: together account_id,product_id,usage_month; key usage_key; refers account_key dim_account.account_key;
  refers product_key dim_product.product_key; from utilization_pct 0
rpt_recon: key recon_key; refers account_key dim_account.account_key;
  accepts match_status matched|variance|unmatched_sfdc|unmatched_netsuite;
  accepts discrepancy_category matched_clean|amount_mismatch|missing_in_netsuite|orphan_in_netsuite|currency_rounding|timing_difference|partially_invoiced
"""
Test = namedtuple("Test", "kind table columns detail")


def tests() -> list[Test]:
    kinds = {
        "key": ("unique", "not_null"), "present": ("not_null",), "refers": ("relationship",),
        "accepts": ("accepted_values",), "together": ("unique_combination",), "from": ("range",),
    }
    found = []
    for line in CHECKS.replace("\n  ", " ").strip().splitlines():
        table, _, rules = line.partition(": ")
        for rule in rules.split("; "):
            word, columns, detail = (*rule.split(" ", 2), "")[:3]
            found += [Test(kind, table, columns.split(","), detail) for kind in kinds[word]]
    return found


def test_sql(test: Test) -> str:
    """Number of violations of one test, counted as the check itself lists them."""
    table, first, columns = CHECK_BLOCKS[test.table], test.columns[0], ", ".join(test.columns)
    present = f"FROM {table} WHERE {first} IS NOT NULL"
    if test.kind == "not_null":
        return f"SELECT count(*) FROM {table} WHERE {first} IS NULL"
    if test.kind == "range":
        return f"SELECT count(*) FROM {table} WHERE {first} < {test.detail}"
    if test.kind == "unique":
        return f"SELECT count(*) FROM (SELECT {first} {present} GROUP BY {first} HAVING count(*) > 1)"
    if test.kind == "unique_combination":
        return f"SELECT count(*) FROM (SELECT {columns} FROM {table} GROUP BY {columns} HAVING count(*) > 1)"
    if test.kind == "accepted_values":
        values = ", ".join(f"'{v}'" for v in test.detail.split("|"))
        return f"SELECT count(DISTINCT {first}) FROM {table} WHERE {first} NOT IN ({values})"
    parent, field = test.detail.split(".")
    return f"SELECT count(*) {present} AND {first} NOT IN (SELECT {field} FROM {CHECK_BLOCKS[parent]})"


def tests_sql(chosen: list[Test]) -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{'_'.join([t.kind, t.table, *t.columns])}' AS name, '{t.kind}' AS kind, '{t.table}' AS \"table\","
        f" '{', '.join(t.columns)}' AS columns, ({test_sql(t)}) AS violations"
        for t in chosen
    )


FINAL["run_checks"] = tests_sql(tests())
FINAL["run_checks_kept"] = tests_sql([t for t in tests() if t.table == "fct_arr" and t.kind != "relationship"])
# --- sources and sinks -----------------------------------------------------------------

FINAL["month_spine"] = """
  SELECT m.measurement_month, count(s.subscription_id) AS starting
  FROM months m LEFT JOIN st_subscriptions s ON last_day(s.subscription_start_date) = m.measurement_month GROUP BY 1"""
FINAL["day_spine"] = f"""
  SELECT d.metric_time AS date_day, count(o.opportunity_id) AS closing
  FROM {DAYS} d LEFT JOIN st_opportunities o ON o.close_date = d.metric_time GROUP BY 1"""
FINAL["load_feed"] = """
  SELECT * REPLACE (cast(account_id AS varchar) AS account_id, cast(owner_id AS varchar) AS owner_id) FROM st_accounts"""
FINAL["register_sources"] = """
  SELECT c_mktsegment, o_orderstatus, count(*) AS orders FROM orders JOIN customer ON o_custkey = c_custkey
  GROUP BY 1, 2"""
FINAL["materialize_layer"] = """
  SELECT revenue_category, count(*) AS rows, cast(sum(ending_arr) AS double) AS ending_arr FROM movements
  WHERE measurement_month = date '2001-12-31' GROUP BY 1"""
FINAL["upsert_by_key"] = """
  SELECT account_id, contract_id, 'Restated' AS contract_status, 0 AS batch FROM st_contracts
  WHERE account_id % 7 = 0 AND cast(contract_id AS bigint) % 2 = 0
  UNION ALL
  SELECT account_id, contract_id, contract_status, 1 AS batch FROM st_contracts
  WHERE account_id NOT IN (SELECT account_id FROM st_contracts
                           WHERE account_id % 7 = 0 AND cast(contract_id AS bigint) % 2 = 0)"""
_CHANGED = "cast(contract_id AS bigint) % {n} = 0 AND account_id % {a} = 0"
FINAL["upsert_stored"] = f"""
  SELECT account_id, contract_id, coalesce(status, contract_status) AS contract_status, cast(version AS bigint) AS version
  FROM (
    SELECT *, bool_or({_CHANGED.format(n=3, a=5)}) OVER account AS closed,
           bool_or({_CHANGED.format(n=2, a=7)}) OVER account AS restated
    FROM st_contracts WINDOW account AS (PARTITION BY account_id)
  ) c JOIN (VALUES (1, NULL), (2, 'Restated'), (3, 'Closed')) AS v(version, status) ON version = CASE
    WHEN closed THEN 3 WHEN restated THEN 2 ELSE 1 END
  WHERE version = 1 OR (version = 2 AND {_CHANGED.format(n=2, a=7)}) OR (version = 3 AND {_CHANGED.format(n=3, a=5)})"""


# --- paired index -----------------------------------------------------------------------

FINAL["load_bout_tables"] = """
  SELECT event_date, method, count(*) AS bouts FROM bt_fight_details JOIN bt_dates USING (fight_id) GROUP BY 1, 2"""
FINAL["entity_names"] = "SELECT * FROM names"
FINAL["per_side_totals"] = "SELECT * FROM side_totals"
FINAL["pair_opponents"] = "SELECT * FROM paired"
FINAL["loss_flag"] = "SELECT * FROM flagged"
FINAL["chin_index"] = "SELECT * FROM chin_raw"
FINAL["disambiguate_names"] = "SELECT fighter_url, fighter FROM chin"
RATE_RANGES = [
    (1, "0.00", 0.0, 0.001), (2, "0.01-0.10", 0.001, 0.1001), (3, "0.11-0.20", 0.1001, 0.2001),
    (4, "0.21-0.30", 0.2001, 0.3001), (5, "0.31-0.40", 0.3001, 0.4001), (6, "0.41-0.50", 0.4001, 0.5001),
    (7, "0.51-0.70", 0.5001, 0.7001), (8, "0.71+", 0.7001, 100.0),
]
RANGE_VALUES = ", ".join(f"({p}, '{n}', {lo}::double, {hi}::double)" for p, n, lo, hi in RATE_RANGES)
FINAL["bucket_histogram"] = f"""
  SELECT cast(b.position AS integer) AS position, b.bucket, count(c.fighter_url) AS count,
         round(count(c.fighter_url) / nullif((SELECT count(*) FROM chin_raw WHERE fights >= 5), 0) * 100, 1)
           AS percentage
  FROM (VALUES {RANGE_VALUES}) AS b(position, bucket, low, high)
  LEFT JOIN (SELECT * FROM chin_raw WHERE fights >= 5) c ON c.kd_per_fight >= b.low AND c.kd_per_fight < b.high
  GROUP BY 1, 2"""
FINAL["distribution_summary"] = """
  SELECT count(*) AS total_fighters,
         round(cast(sum(cast(kd_per_fight AS decimal(18,3))) AS double) / count(*), 3) AS mean,
         list_sort(list(kd_per_fight))[count(*) // 2 + 1] AS median,
         count(*) FILTER (kd_per_fight < 0.001) AS zero_count,
         round(count(*) FILTER (kd_per_fight < 0.001) / count(*) * 100, 1) AS zero_pct
  FROM chin_raw WHERE fights >= 5"""
FINAL["leaderboard_highest"] = """
  SELECT * FROM chin WHERE fights >= 10 ORDER BY kd_per_fight DESC, kd_absorbed DESC, fighter_url LIMIT 15"""
FINAL["write_artifact_json"] = FINAL["leaderboard_highest"]
FINAL["leaderboard_zero"] = """
  SELECT * FROM chin WHERE fights >= 10 AND kd_absorbed <= fights * 0.25::double
  ORDER BY fights DESC, fighter_url LIMIT 15"""
FINAL["leaderboard_survivors"] = """
  SELECT * FROM chin WHERE fights >= 10 AND kd_absorbed >= 3 AND ko_losses <= 40
  ORDER BY kd_absorbed DESC, kd_per_fight DESC, fighter_url LIMIT 20"""
FINAL["weight_class_of"] = """
  SELECT f.fighter_url, f.weight, c.division FROM bt_fighters f LEFT JOIN fighter_class c USING (fighter_url)"""
FINAL["class_breakdown"] = """
  SELECT division, count(*) AS fighters, cast(sum(kd_absorbed) AS bigint) AS kd_absorbed,
         cast(sum(fights) AS bigint) AS fights, cast(sum(rounds) AS bigint) AS rounds,
         round(sum(kd_absorbed) / sum(fights), 3) AS kd_per_fight,
         round(sum(kd_absorbed) / sum(rounds), 4) AS kd_per_round,
         round(sum(ko_losses) / sum(fights) * 100, 1) AS ko_loss_pct
  FROM chin_raw JOIN fighter_class USING (fighter_url) WHERE fights >= 5 GROUP BY 1"""
FINAL["age_at_event"] = "SELECT * FROM ages"
FINAL["age_curve"] = """
  SELECT bucket, count(*) AS fights, cast(sum(kd_absorbed) AS bigint) AS kd_absorbed,
         round(sum(kd_absorbed) / count(*), 3) AS kd_per_fight
  FROM (SELECT a.age_at_fight, p.kd_absorbed FROM ages a JOIN paired p USING (fighter_url, fight_id)
        WHERE a.age_at_fight BETWEEN 18 AND 50)
  JOIN (VALUES ('18-24', 18::double, 24.999::double), ('25-27', 25, 27.999), ('28-30', 28, 30.999),
               ('31-33', 31, 33.999), ('34-36', 34, 36.999), ('37-39', 37, 39.999), ('40+', 40, 100))
    AS b(bucket, low, high) ON age_at_fight BETWEEN low AND high
  GROUP BY 1 HAVING count(*) >= 50"""
SCATTER = """SELECT fighter_url, fighter, fights, kd_absorbed, kd_per_fight, ko_losses,
         round(ko_losses / fights * 100, 1) AS ko_loss_pct FROM {} WHERE fights >= 10"""
FINAL["scatter"] = SCATTER.format("chin")
FINAL["scatter_and_corr"] = f"""
  SELECT count(*) AS fighters, round(corr(kd_per_fight, ko_loss_pct), 3) AS pearson_r
  FROM ({SCATTER.format('chin_raw')})"""
FINAL["recent_vs_career_watchlist"] = """
  SELECT r.fighter_url, c.fighter, cast(r.last_fight AS varchar) AS last_fight, r.recent_kd, r.recent_fights,
         round(r.recent_kd / r.recent_fights, 2) AS recent_kd_per_fight, c.kd_per_fight AS career_kd_per_fight,
         c.fights AS career_fights, c.ko_losses AS career_ko_losses
  FROM (SELECT fighter_url, max(event_date) AS last_fight,
               cast(sum(CASE WHEN rn <= 5 THEN kd_absorbed ELSE 0 END) AS bigint) AS recent_kd,
               count(CASE WHEN rn <= 5 THEN 1 END) AS recent_fights
        FROM (SELECT *, row_number() OVER (PARTITION BY fighter_url ORDER BY event_date DESC, fight_id DESC) AS rn
              FROM paired JOIN bt_dates USING (fight_id)) GROUP BY 1) r
  JOIN chin c USING (fighter_url)
  WHERE r.recent_fights >= 3 AND extract(year FROM r.last_fight) >= 2001 AND r.recent_kd / r.recent_fights >= 0.6
  ORDER BY recent_kd_per_fight DESC, fighter_url LIMIT 12"""

# --- careers ------------------------------------------------------------------------------

CAREER = [f for f in bout_sql.FEATURES if not f.startswith(("recent", "win_streak", "loss_streak", "log"))]


def profile(*columns: str) -> str:
    return f"SELECT fighter_url, event_date, {', '.join(columns)} FROM profile_asof"


FINAL["bouts_clean"] = "SELECT * FROM clean"
FINAL["side_stats"] = "SELECT * FROM stats"
FINAL["bout_sides"] = "SELECT * FROM sides"
FINAL["career_features_asof"] = profile("fights", *CAREER)
FINAL["recent5_win_rate"] = profile("recent_win_rate")
FINAL["recent3_features"] = profile(*[f for f in bout_sql.FEATURES if f.startswith("recent_") and "win" not in f])
FINAL["streaks"] = profile("win_streak", "loss_streak")
FINAL["experience"] = profile("fights", "round(log_fights, 9) AS log_fights")
FINAL["career_profiles"] = "SELECT * REPLACE (round(log_fights, 9) AS log_fights) FROM profile_final"
WINNER = [f"winner_{f}" for f in bout_sql.METHOD_FEATURES]
FINAL["training_pairs"] = f"""
  SELECT * EXCLUDE ({', '.join(WINNER)}) REPLACE (round(log_fights, 9) AS log_fights) FROM pairs"""
_UNITS = ", ".join(
    f"({f} - avg({f}) OVER ()) / coalesce(nullif(stddev_pop({f}) OVER (), 0), 1)" for f in bout_sql.MODEL_FEATURES
)
_NAMES = ", ".join(f"'{f}'" for f in bout_sql.MODEL_FEATURES)
FINAL["interactions_select"] = f"""
  SELECT cast(position AS integer) AS position, feature, information FROM (
    SELECT position, feature, round(sum(n / n_all * ln(n * n_all / (n_bin * n_label))), 9) AS information FROM (
      SELECT position, feature, bin, label, cast(count(*) AS double) AS n,
             cast(sum(count(*)) OVER (PARTITION BY position) AS double) AS n_all,
             cast(sum(count(*)) OVER (PARTITION BY position, bin) AS double) AS n_bin,
             cast(sum(count(*)) OVER (PARTITION BY position, label) AS double) AS n_label
      FROM (
        SELECT label, p.position, p.feature, floor(greatest(-2.5, least(2.5, u[p.a] * p.factor)) / 0.5 + 1e-9) AS bin
        FROM (
          SELECT label, u, unnest(list_transform(places, lambda q: struct_pack(
                   position := q.position, feature := q.feature, a := q.a,
                   factor := CASE WHEN q.b = 0 THEN 1 ELSE u[q.b] END))) AS p
          FROM (SELECT label, [{_UNITS}] AS u FROM pairs),
               (SELECT list(struct_pack(position := position, feature := feature, a := a, b := b)) AS places FROM (
                  SELECT row_number() OVER (ORDER BY b > 0, a, b) - 1 AS position, a, b,
                         CASE WHEN b = 0 THEN names[a] ELSE names[a] || '*' || names[b] END AS feature
                  FROM (SELECT [{_NAMES}] AS names), range(1, {len(bout_sql.MODEL_FEATURES) + 1}) x(a),
                       range(0, {len(bout_sql.MODEL_FEATURES) + 1}) y(b)
                  WHERE b = 0 OR b > a))))
      GROUP BY position, feature, bin, label)
    GROUP BY position, feature)
  ORDER BY information DESC, position LIMIT 50"""
FINAL["saved_models"] = """
  SELECT model, n AS rows, cast(0 AS bigint) AS changed FROM (SELECT count(*) AS n FROM pairs),
    (VALUES ('GradientBoosting'), ('RandomForest'), ('MLP'), ('LogisticReg'), ('Interactions'), ('Stacking'),
            ('InteractionStacking'), ('Calibrated')) AS m(model)"""
FINAL["winner_profile"] = f"SELECT fight_id, method, {', '.join(WINNER)} FROM pairs WHERE NOT mirrored"


# --- cards and match-ups --------------------------------------------------------------------

FINAL["resolve_entity"] = "SELECT * FROM resolved"
FINAL["resolve_requests"] = """
  SELECT request_id, requested, coalesce(e.fighter_url, p.fighter_url) AS fighter_url, coalesce(e.fighter, p.fighter) AS fighter
  FROM (
    SELECT fight_id AS request_id, CASE cast(fight_id AS bigint) % 4
             WHEN 0 THEN upper(fighter1_name) WHEN 1 THEN '  ' || split_part(fighter1_name, ' ', 1) || ' Nobody'
             WHEN 2 THEN substr(fighter1_name, 2, least(2, strpos(fighter1_name, ' ') - 2)) || ' 3'
             ELSE fight_id || ' ' || split_part(fighter1_name, ' ', 1) END AS requested
    FROM bt_fight_details) r
  LEFT JOIN (SELECT DISTINCT ON (name) lower(fighter) AS name, fighter_url, fighter FROM card_names
             WHERE fighter IS NOT NULL ORDER BY name, fighter_url, fighter) e ON e.name = lower(r.requested)
  LEFT JOIN (
    SELECT DISTINCT ON (word) word, fighter_url, fighter FROM card_names, (
      SELECT unnest(list_distinct(list(lower(word)))) AS word FROM (
        SELECT unnest(['nobody', fight_id, split_part(fighter1_name, ' ', 1),
                       substr(fighter1_name, 2, least(2, strpos(fighter1_name, ' ') - 2))]) AS word FROM bt_fight_details))
    WHERE contains(lower(fighter), word) ORDER BY word, fighter_url, fighter
  ) p ON p.word = lower(regexp_extract(r.requested, '\\S+'))"""
FINAL["select_card"] = """
  SELECT cast(a.request_id // 2 AS bigint) AS position, coalesce(a.fighter, a.requested) AS fighter1, a.fighter_url AS fighter1_url,
         coalesce(x.fights, 0) AS f1_count, coalesce(b.fighter, b.requested) AS fighter2,
         b.fighter_url AS fighter2_url, coalesce(y.fights, 0) AS f2_count,
         coalesce(x.fights, 0) + coalesce(y.fights, 0) AS combined
  FROM resolved a JOIN resolved b ON b.request_id = a.request_id + 1 AND a.request_id % 2 = 0
  LEFT JOIN fight_counts x ON x.fighter_url = a.fighter_url LEFT JOIN fight_counts y ON y.fighter_url = b.fighter_url
  WHERE coalesce(x.fights, 0) >= 3 AND coalesce(y.fights, 0) >= 3
  ORDER BY combined DESC, position LIMIT 3"""
FINAL["reasoning_text"] = bout_sql.REASONING
FINAL["round_distributions"] = "SELECT * FROM round_dist"
FINAL["global_distributions"] = "SELECT * FROM global_dist"
FINAL["shrink_to_global"] = """
  SELECT f.fighter_url, g.bucket, g.stat,
         coalesce(f.weight * d.mean + (1.0::double - f.weight) * g.mean, g.mean) AS mean,
         coalesce(f.weight * d.std + (1.0::double - f.weight) * g.std, g.std) AS std
  FROM (SELECT fighter_url, cast(least(count(*), 15) AS double) / 15 AS weight FROM side_totals GROUP BY 1) f
  CROSS JOIN global_dist g
  LEFT JOIN round_dist d ON d.fighter_url = f.fighter_url AND d.bucket = g.bucket AND d.stat = g.stat"""
BLENDED = ("sig_spm", "sig_acc", "td_per_fight", "kd_per_fight", "ctrl_secs_per_fight")
FINAL["form_blend"] = profile(*[f"{c} * 0.6::double + recent_{c} * 0.4::double AS eff_{c}" for c in BLENDED])
FINAL["class_finish_rates"] = "SELECT * FROM multipliers"
FINAL["matchup_modifiers"] = bout_sql.modifiers("v2.3")
for _version in ("v2", "v2.1", "v2.2"):
    FINAL[f"matchup_modifiers_{_version.replace('.', '_')}"] = bout_sql.modifiers(_version)
FINAL["age_thresholds"] = """
  SELECT f.fighter_url, f.weight,
         cast(CASE c.division WHEN 'Heavyweight' THEN 39 WHEN 'Light Heavyweight' THEN 38 WHEN 'Middleweight' THEN 37
           WHEN 'Welterweight' THEN 36 WHEN 'Lightweight' THEN 35 WHEN 'Featherweight' THEN 35
           WHEN 'Bantamweight' THEN 34 WHEN 'Flyweight' THEN 34 ELSE 36 END AS integer) AS chin,
         cast(CASE c.division WHEN 'Heavyweight' THEN 37 WHEN 'Light Heavyweight' THEN 36 WHEN 'Middleweight' THEN 35
           WHEN 'Welterweight' THEN 35 WHEN 'Lightweight' THEN 34 WHEN 'Featherweight' THEN 34
           WHEN 'Bantamweight' THEN 33 WHEN 'Flyweight' THEN 33 ELSE 34 END AS integer) AS fatigue
  FROM bt_fighters f LEFT JOIN fighter_class c USING (fighter_url)"""
FINAL["round_scorecard"] = "SELECT * FROM scorecards"
FINAL["decision_outcome"] = """
  SELECT fight_id,
         CASE WHEN wins1 >= 2 OR (wins2 < 2 AND total1 >= total2) THEN 'fighter1' ELSE 'fighter2' END AS winner,
         CASE WHEN greatest(wins1, wins2) = 3 THEN 'Decision (Unanimous)'
              WHEN greatest(wins1, wins2) = 2 OR (wins1 = 1 AND wins2 = 1) THEN 'Decision (Split)'
              ELSE 'Decision (Majority)' END AS method, total1, total2, wins1, wins2
  FROM card_totals"""


def oracles() -> dict[str, str]:
    return {name: assemble(sql) for name, sql in FINAL.items()}
