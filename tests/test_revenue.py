"""Hand-made cases for the waterfall, bookings, usage and reconciliation."""

import datetime as dt
from decimal import Decimal

import pytest

from ledgerwave.operators import bookings, checks, movements, recon, snapshots, usage
from ledgerwave.plans import reports
from ledgerwave.operators.snapshots import MonthWindow

WINDOW = MonthWindow("2023-01-01", "2023-09-01")
SEGMENT = (
    "account_id string, product_id string, annual_recurring_amount decimal(18,2), entitled_units int, "
    "subscription_start_date date, subscription_end_date date"
)


def day(text):
    return dt.date.fromisoformat(text)


def segments(spark, rows):
    return spark.createDataFrame(
        [(a, p, Decimal(m), u, day(s), day(e)) for a, p, m, u, s, e in rows], SEGMENT
    )


def story(spark, rows, window=WINDOW, keep_inactive=False):
    changes = snapshots.run_rate_changes(segments(spark, rows), window)
    spans = snapshots.run_rate_spans(changes, window)
    history = movements.ever_active_before(spans, changes)
    frame = movements.period_movement(history, keep_inactive)
    return {
        (r.account_id, r.product_id, r.measurement_month.month): (r.revenue_category, r.beginning_arr, r.ending_arr)
        for r in frame.collect()
    }


def test_every_movement_of_one_pair(spark):
    got = story(
        spark,
        [
            ("a", "p", "100", 1, "2023-01-01", "2023-01-31"),
            ("a", "p", "150", 1, "2023-02-01", "2023-02-28"),
            ("a", "p", "120", 1, "2023-03-01", "2023-04-30"),
            ("a", "p", "80", 1, "2023-06-01", "2023-06-30"),
        ],
    )
    categories = {month: value[0] for (_, _, month), value in got.items()}
    assert categories == {
        1: "new_logo", 2: "upsell", 3: "downgrade", 4: "scheduled", 5: "churn", 6: "new_logo", 7: "churn"
    }
    assert got[("a", "p", 3)][1:] == (Decimal("150.00"), Decimal("120.00"))


def test_new_product_after_the_account_has_left_is_cross_sell(spark):
    got = story(
        spark,
        [("a", "p", "100", 1, "2023-01-01", "2023-01-31"), ("a", "q", "50", 1, "2023-04-01", "2023-04-30")],
    )
    assert got[("a", "q", 4)][0] == "cross_sell"


def test_products_landing_in_the_same_first_month_are_both_new_logo(spark):
    got = story(
        spark, [("a", p, "100", 1, "2023-01-01", "2023-01-31") for p in ("p", "q")],
    )
    assert {got[("a", p, 1)][0] for p in ("p", "q")} == {"new_logo"}


def test_segment_ending_inside_a_month_does_not_count_that_month(spark):
    got = story(spark, [("a", "p", "100", 1, "2023-01-15", "2023-03-15")])
    assert {m: v[0] for (_, _, m), v in got.items()} == {1: "new_logo", 2: "scheduled", 3: "churn"}


def test_segment_inside_one_month_never_counts(spark):
    assert story(spark, [("a", "p", "100", 1, "2023-01-05", "2023-01-20")]) == {}


def test_segments_are_cut_to_the_window(spark):
    got = story(spark, [("a", "p", "100", 1, "2020-01-01", "2030-12-31")], keep_inactive=True)
    assert sorted(m for _, _, m in got) == list(range(1, 9))


def test_credit_keeps_an_account_from_being_active(spark):
    """The account total decides, not its products: a credit of the same size leaves it at zero."""
    got = story(
        spark,
        [
            ("a", "p", "100", 1, "2023-01-01", "2023-02-28"),
            ("a", "credit", "-100", 0, "2023-01-01", "2023-02-28"),
            ("a", "q", "70", 1, "2023-03-01", "2023-03-31"),
        ],
    )
    assert got[("a", "q", 3)][0] == "new_logo"


def brute_force(rows, window_months):
    """Run rate by the definition: every segment against every month-end."""
    table = {}
    for a, p, m, u, s, e in rows:
        for first in window_months:
            following = (first.replace(day=28) + dt.timedelta(days=4)).replace(day=1)
            end = following - dt.timedelta(days=1)
            if day(s) <= end <= day(e):
                arr, units = table.get((a, p, end), (Decimal(0), 0))
                table[(a, p, end)] = (arr + Decimal(m), units + u)
    return table


def test_snapshot_and_densify_against_the_definition(spark):
    rows = []
    for i in range(60):
        start = dt.date(2022, 11, 1) + dt.timedelta(days=(i * 37) % 300)
        rows.append(
            (f"a{i % 4}", f"p{i % 3}", str(10 + i), i % 5, start.isoformat(),
             (start + dt.timedelta(days=(i * 53) % 200)).isoformat())
        )
    months = [dt.date(2023, m, 1) for m in range(1, 9)]
    expected = brute_force(rows, months)
    changes = snapshots.run_rate_changes(segments(spark, rows), WINDOW)
    spans = snapshots.run_rate_spans(changes, WINDOW)
    active = snapshots.active_on_snapshot(spans)
    got = {(r.account_id, r.product_id, r.measurement_month): (r.arr, r.entitled_units) for r in active.collect()}
    assert got == expected
    dense = snapshots.expand_months(spans).collect()
    assert sorted(map(tuple, snapshots.densify(active, WINDOW).collect())) == sorted(map(tuple, dense))
    first = {(r.account_id, r.product_id): r.first_active_month for r in snapshots.first_active(changes).collect()}
    assert first == {
        (a, p): min(m for x, y, m in expected if (x, y) == (a, p)) for a, p, _ in expected
    }


def test_waterfall_checks_hold_and_notice_a_break(spark):
    changes = snapshots.run_rate_changes(
        segments(spark, [("a", "p", "100", 1, "2023-01-01", "2023-04-30")]), WINDOW
    )
    history = movements.ever_active_before(snapshots.run_rate_spans(changes, WINDOW), changes)
    fact = movements.fct_arr(movements.movement_buckets(movements.period_movement(history, False)))
    monthly = reports.monthly_bridge(fact)
    assert checks.assert_waterfall_integrity(monthly).count() == 0
    assert checks.assert_arr_continuity(monthly).count() == 0
    broken = monthly.selectExpr("* except (ending_arr)", "ending_arr + 5 as ending_arr")
    assert checks.assert_waterfall_integrity(broken).count() > 0
    assert checks.assert_arr_continuity(broken).count() > 0


LINES = (
    "opportunity_line_id string, opportunity_id string, product_id string, quantity int, unit_price decimal(18,2), "
    "term_months int, is_recurring boolean, line_amount decimal(18,2)"
)
DEALS = (
    "opportunity_id string, account_id string, owner_id string, opportunity_type string, stage_name string, "
    "forecast_category string, is_closed boolean, is_won boolean, close_date date, term_months int"
)


def acv(spark, lines, deals):
    line_frame = spark.createDataFrame(
        [(f"l{i}", o, p, 1, Decimal(a), 36, r, Decimal(a)) for i, (o, p, r, a) in enumerate(lines)], LINES
    )
    deal_frame = spark.createDataFrame(
        [(o, a, "u", k, "s", "f", closed, won, day(d), term) for o, a, k, closed, won, d, term in deals], DEALS
    )
    products = spark.createDataFrame(
        [("p", "P", "L", "F"), ("q", "Q", "L", "F")],
        "product_id string, product_name string, line_of_business string, product_family string",
    )
    users = spark.createDataFrame(
        [("u", "U", "NA", "T")], "user_id string, user_name string, sales_region string, sales_team string"
    )
    rows = bookings.opportunity_lines_acv(line_frame, deal_frame, products, users).collect()
    return {r.opportunity_line_id: r for r in rows}


def test_three_years_at_100k_and_a_10k_fee(spark):
    rows = acv(
        spark,
        [("o", "p", True, "100000"), ("o", "q", False, "10000")],
        [("o", "a", "New Business", True, True, "2023-05-01", 36)],
    )
    assert sum(r.acv for r in rows.values()) == Decimal("110000.00")
    assert sum(r.tcv for r in rows.values()) == pytest.approx(310000.0)


def test_motion_of_every_kind_of_line(spark):
    deals = [
        ("o0", "a", "New Business", True, True, "2023-01-01", 12),
        ("o1", "a", "Expansion", True, True, "2023-02-01", 12),
        ("o2", "a", "Expansion", True, True, "2023-03-01", 12),
        ("o3", "a", "Renewal", True, True, "2023-01-01", 12),
        ("o4", "a", "Downgrade", True, True, "2023-01-01", 12),
        ("o5", "a", "Churn", True, False, "2023-01-01", 12),
        ("o6", "a", "New Business", False, False, "2023-09-01", 12),
        ("o7", "a", "Expansion", True, False, "2023-09-01", 12),
        ("o8", None, "Expansion", True, True, "2023-09-01", 12),
    ]
    products = ["p", "q", "q", "p", "p", "p", "p", "p", "p"]
    rows = acv(spark, [(d[0], p, True, "1") for d, p in zip(deals, products)], deals)
    assert [rows[f"l{i}"].revenue_category for i in range(9)] == [
        "new_logo", "cross_sell", "upsell", "scheduled", "downgrade", "churn", "new_logo", "upsell", "new_logo",
    ]


def test_usage_without_entitlement_is_left_out(spark):
    snapshot = spark.createDataFrame(
        [("a", "p", day("2023-01-31"), Decimal("10"), 4), ("a", "q", day("2023-01-31"), Decimal("10"), 0)],
        "account_id string, product_id string, measurement_month date, arr decimal(18,2), entitled_units long",
    )
    used = spark.createDataFrame(
        [("a", "p", day("2023-01-01"), Decimal("5"), Decimal("1")), ("b", "p", day("2023-01-01"), Decimal("5"), Decimal("1"))],
        "account_id string, product_id string, usage_month date, consumed_units decimal(18,2), consumed_value decimal(18,2)",
    )
    (row,) = usage.fct_usage(snapshot, usage.usage_period_rollup(used)).collect()
    assert (row.utilization_pct, float(row.overage_units)) == (1.25, 1.0)
    assert row.is_over_entitlement and not row.is_under_utilized


CONTRACTS = (
    "contract_id string, contract_number string, account_id string, total_contract_value decimal(18,2), "
    "contract_start_date date, currency_code string, external_order_ref string"
)
ORDERS = (
    "sales_order_id string, ns_customer_id string, order_number string, order_total decimal(18,2), order_date date, "
    "currency_code string, external_order_ref string"
)


def reconcile(spark, contracts, orders, invoices):
    start = day("2023-01-01")
    return recon.recon_classify(
        recon.reconcile(
            spark.createDataFrame([(i, i, "a", Decimal(v), start, "USD", r) for i, v, r in contracts], CONTRACTS),
            spark.createDataFrame([(i, "n", i, Decimal(v), d, c, r) for i, v, d, c, r in orders], ORDERS),
            spark.createDataFrame([("n", "b")], "ns_customer_id string, sfdc_account_external_id string"),
            spark.createDataFrame([(o, Decimal(v)) for o, v in invoices], "sales_order_id string, invoice_total decimal(18,2)"),
        )
    )


def test_reconciliation_precedence(spark):
    start = day("2023-01-01")
    cases = {
        "clean": ("100000", "100000", start, "100000", "matched_clean"),
        "wide": ("100000", "99940", start, "99940", "matched_clean"),  # over 50 but under 1 %
        "mismatch": ("1000", "900", start, "10", "amount_mismatch"),
        "rounding": ("1000", "1020", start, "10", "currency_rounding"),
        "partial": ("1000", "1000", start + dt.timedelta(days=30), "700", "partially_invoiced"),
        "late": ("1000", "1000", start + dt.timedelta(days=8), "1000", "timing_difference"),
        "week": ("1000", "1000", start + dt.timedelta(days=7), "1000", "matched_clean"),
    }
    rows = reconcile(
        spark,
        [(k, v[0], k) for k, v in cases.items()],
        [(k, v[1], v[2], "USD", k) for k, v in cases.items()],
        [(k, v[3]) for k, v in cases.items()],
    ).collect()
    assert {r.contract_id: r.discrepancy_category for r in rows} == {k: v[4] for k, v in cases.items()}


def test_references_that_are_missing_or_shared(spark):
    start = day("2023-01-01")
    rows = reconcile(
        spark,
        [("c1", "10", None), ("c2", "10", "x"), ("c3", "10", "x"), ("c4", "10", "only")],
        [("o1", "10", start, "EUR", None), ("o2", "10", start, "EUR", "x"), ("o3", "10", start, "EUR", "x"),
         ("o4", "10", start, "EUR", "other")],
        [("o2", "6"), ("o2", "4")],
    ).collect()
    pairs = sorted((r.contract_id or "", r.sales_order_id or "", r.discrepancy_category) for r in rows)
    assert pairs == [
        ("", "o1", "orphan_in_netsuite"), ("", "o4", "orphan_in_netsuite"),
        ("c1", "", "missing_in_netsuite"),
        ("c2", "o2", "matched_clean"), ("c2", "o3", "partially_invoiced"),
        ("c3", "o2", "matched_clean"), ("c3", "o3", "partially_invoiced"),
        ("c4", "", "missing_in_netsuite"),
    ]
    assert {r.account_id for r in rows if r.contract_id is None} == {"b"}
    assert {r.currency_variance for r in rows if r.contract_id and r.sales_order_id} == {True}
    assert {r.external_order_ref for r in rows} == {None, "x", "only", "other"}
