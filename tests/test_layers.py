"""Sources, sinks, checks and the metric layer."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from ledgerwave.functions.keys import NULL_PART, surrogate_key
from ledgerwave.operators import checks, metrics
from ledgerwave.session import fresh_path, shared_dir
from ledgerwave.sources import conform, feeds, layers, sample, spines
from ledgerwave.operators.snapshots import DEFAULT_WINDOW


def test_surrogate_key_marks_null(spark):
    import hashlib

    row = spark.sql("select 1 as a, cast(null as string) as b, date '2023-01-31' as c")
    expected = hashlib.md5(f"1-{NULL_PART}-2023-01-31".encode()).hexdigest()
    assert row.select(surrogate_key("a", "b", "c")).first()[0] == expected


def test_spines_leave_out_their_end(spark):
    months = [r[0] for r in spines.month_spine(spark, DEFAULT_WINDOW).collect()]
    assert (len(months), min(months), max(months)) == (36, dt.date(2023, 1, 31), dt.date(2025, 12, 31))
    assert spines.day_spine(spark).count() == 1826


def test_csv_feed_is_typed_and_strict(spark, tmp_path):
    good = tmp_path / "users.csv"
    good.write_text("user_id,user_name,sales_team,sales_region,role\nU1,Ann,SMB,NA,AE\n")
    assert conform.conform(feeds.load_feed(spark, str(good), feeds.SCHEMAS["users"]), "users").first().user_name == "Ann"
    bad = tmp_path / "bad.csv"
    bad.write_text("id,n\nx,not a number\n")
    with pytest.raises(Exception):
        feeds.load_feed(spark, str(bad), "id string, n int").collect()


def test_every_feed_has_a_schema_and_a_spec():
    revenue = [f for system in ("crm", "erp", "usage") for f in feeds.SYSTEMS[system]]
    assert sorted(revenue) == sorted(conform.SPECS) == sorted(feeds.SCHEMAS) == sorted(sample.FEEDS)


def test_conform_turns_flags_and_blanks(spark):
    raw = spark.sql(
        "select '' as contract_id, 1 as is_won, 0 as is_closed, '12' as term_months, '10.5' as amount, "
        "'2023-01-02' as created_date, '2023-02-03' as close_date, 'o' as opportunity_id, 'a' as account_id, "
        "'u' as owner_id, 'n' as opportunity_name, 't' as opportunity_type, 's' as stage_name, "
        "'f' as forecast_category, 'USD' as currency_code"
    )
    row = conform.conform(raw, "opportunities").first()
    assert row.contract_id is None and row.is_won and not row.is_closed
    assert (row.term_months, str(row.opportunity_amount), row.close_date) == (12, "10.50", dt.date(2023, 2, 3))


def test_shared_dir_is_the_one_the_session_names(spark):
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    assert shared_dir(spark) == (named or spark.sparkContext.getCheckpointDir())


def test_layers(spark, tmp_path):
    table = spark.sql("select id, id % 3 as part from range(30)")
    views = layers.materialize_layer(spark, "staging", {"t": table}, str(tmp_path))
    assert spark.table("staging_t").count() == views["t"].count() == 30
    assert not os.path.exists(tmp_path / "staging")
    written = layers.materialize_layer(spark, "marts", {"t": table}, str(tmp_path), {"t": "part"})
    assert sorted(p for p in os.listdir(tmp_path / "marts" / "t") if p.startswith("part=")) == ["part=0", "part=1", "part=2"]
    assert sorted(map(tuple, written["t"].select("id", "part").collect())) == sorted(map(tuple, table.collect()))
    path = layers.write_artifact_json(table.limit(2), str(tmp_path), "report", "weekly_")
    assert spark.read.json(path).count() == 2


def test_upsert_replaces_by_key_and_keeps_rows_without_one(spark):
    existing = spark.createDataFrame([("e1", 1), ("e2", 2), (None, 3)], "event string, v int")
    incoming = spark.createDataFrame([("e1", 10), ("e1", 11)], "event string, v int")
    rows = layers.upsert_by_key(existing, incoming, "event").orderBy("batch", "v").collect()
    assert [(r.event, r.v) for r in rows] == [("e1", 10), ("e1", 11), ("e2", 2), (None, 3)]


def test_suite_has_the_published_number_of_checks():
    kinds = [c.kind for c in checks.GENERIC_CHECKS]
    assert {k: kinds.count(k) for k in set(kinds)} == {
        "unique": 26, "not_null": 33, "relationship": 21, "accepted_values": 8, "unique_combination": 4, "range": 1
    }


def test_run_checks_counts_every_kind_of_violation(spark):
    child = spark.createDataFrame(
        [("k1", "x", 1.0), ("k1", "y", -1.0), (None, "z", 2.0), ("k3", "z", None)], "id string, ref string, v double"
    )
    parent = spark.createDataFrame([("x",), ("x",)], "ref string")
    suite = [
        *checks.unique_and_present("child", "id"),
        checks.refers("child", "ref", "parent"),
        checks.accepts("child", "ref", "x", "y"),
        checks.unique_together("child", "id", "ref"),
        checks.Check("range", "child", ("v",), low=0),
    ]
    got = {r.kind: r.violations for r in checks.run_checks(spark, {"child": child, "parent": parent}, suite).collect()}
    assert got == {
        "unique": 1, "not_null": 1, "relationship": 3, "accepted_values": 1, "unique_combination": 0, "range": 1
    }


def test_values_that_differ_are_not_shuffled_for_uniqueness(spark, tmp_path):
    path = str(tmp_path / "keys")
    spark.range(1000).select(F.concat(F.lit("key"), "id").alias("id"), F.lit("x").alias("ref")).write.parquet(path)
    suite = [checks.Check("unique", "keys", ("id",)), checks.unique_together("keys", "id", "ref")]
    result = checks.run_checks(spark, {"keys": spark.read.parquet(path)}, suite)
    assert path not in result._jdf.queryExecution().executedPlan().toString()
    assert {r.name: r.violations for r in result.collect()} == {c.name: 0 for c in suite}


def test_uniqueness_by_value_where_hashes_agree(spark):
    """Nulls do not change a hash, so ("a", null) and (null, "a") have the same; zeros have two."""
    rows = [("a", None, 0.0, 1), (None, "a", -0.0, 1), (None, None, 2.5, 2), (None, None, 2.5, 3), ("b", "a", None, 3)]
    table = spark.createDataFrame(rows, "x string, y string, z double, k int")
    suite = [checks.unique_together("t", "x", "y"), *[checks.Check("unique", "t", (c,)) for c in "xyzk"]]
    got = {r.columns: r.violations for r in checks.run_checks(spark, {"t": table}, suite).collect()}
    assert got == {"x, y": 1, "x": 0, "y": 1, "z": 1, "k": 2}


def test_recon_counts_names_the_category_that_drifts(spark):
    report = spark.createDataFrame([("a",), ("a",)], "discrepancy_category string")
    expected = spark.createDataFrame([("a", 2), ("b", 1)], "discrepancy_category string, expected_count int")
    (row,) = checks.assert_recon_counts(report, expected).collect()
    assert tuple(row) == ("b", 1, 0)


def test_balance_over_time(spark):
    fact = spark.createDataFrame(
        [("a", dt.date(2023, 1, 31), 10.0), ("a", dt.date(2023, 2, 28), 12.0), ("b", dt.date(2023, 2, 28), 5.0)],
        "account_id string, measurement_month date, ending_arr double",
    ).selectExpr("*", "'p' as product_id", "'scheduled' as revenue_category")
    tables = {"fct_arr": fact}
    assert metrics.metric(tables, "total_arr").first()[0] == 27.0
    assert metrics.metric(tables, "total_arr", semi_additive="last").first()[0] == 17.0
    by_year = metrics.metric(tables, "total_arr", grain="year", semi_additive="last").first()
    assert tuple(by_year) == (dt.date(2023, 1, 1), 17.0)
    with pytest.raises(ValueError):
        metrics.metric(tables, "total_arr", grain="decade")


def test_twenty_metrics():
    assert len(metrics.METRICS) == 20
    assert sum(m.measure is not None for m in metrics.METRICS.values()) == 15
    assert sum(len(m.measures) for m in metrics.MODELS.values()) == 14


def test_fresh_paths_differ(spark):
    assert fresh_path(spark, "x") != fresh_path(spark, "x")


def test_kept_counts_read_new_partitions_only(spark, tmp_path):
    """A month is added after the files of the others are gone: the same violations as of all rows."""
    import shutil

    rows = [("2024-01", f"k{i}", i % 3) for i in range(20)] + [("2024-02", f"k{i}", 9) for i in range(15, 30)]
    more = [("2024-03", "k1", None), ("2024-03", "new", 1), ("2024-03", None, 1)]
    schema = "month string, key string, kind int"
    suite = [
        *checks.unique_and_present("t", "key"), checks.accepts("t", "kind", "0", "1", "2"),
        checks.unique_together("t", "month", "kind"),
    ]
    path, kept = str(tmp_path / "t"), checks.KeptCounts(spark, str(tmp_path / "kept"), {"t": "month"})

    def write(values):
        spark.createDataFrame(values, schema).write.mode("append").partitionBy("month").parquet(path)

    def table():
        return spark.read.schema(schema).parquet(path)

    def violations(frame, counts=None, changed=None):
        return {r["name"]: r["violations"] for r in checks.run_checks(spark, {"t": frame}, suite, counts, changed).collect()}

    write(rows)
    assert violations(table(), kept) == violations(table())
    write(more)
    want = violations(table())
    for month in ("2024-01", "2024-02"):
        for file in (tmp_path / "t" / f"month={month}").glob("*.parquet"):
            file.write_bytes(b"not a table")  # whoever reads it fails
    assert violations(table(), kept) == want
    # A month that was written anew is counted anew, one that is gone no longer counts.
    shutil.rmtree(tmp_path / "t")
    write([("2024-01", "a", 0), ("2024-03", "a", 1)])
    assert violations(table(), kept, {"t": ["2024-01", "2024-03"]}) == violations(table())


def test_headline_counts_deals_once(spark):
    from decimal import Decimal

    from ledgerwave.plans import reports

    schema = "opportunity_id string, sales_year int, is_closed boolean, is_closed_won boolean, acv decimal(18,2)"
    lines = [("o1", 2020, True, True, 5), ("o1", 2020, True, True, 7), ("o2", 2021, False, False, 1), ("o2", 2021, False, False, 2),
             ("o3", 2022, True, False, 100), ("o4", 2019, True, True, 3), ("o5", None, False, False, 4)]
    frame = spark.createDataFrame([(*x[:4], Decimal(x[4])) for x in lines], schema)
    (row,) = reports._bookings_state(frame).collect()
    assert (row["latest"]["sales_year"], int(row["latest"]["won"]), int(row["open_acv"]), row["open"]) == (2020, 12, 7, 2)
    (year,), (pipeline,) = reports.latest_year_bookings(frame).collect(), reports.open_pipeline(frame).collect()
    assert (year["sales_year"], int(year["acv"])) == (2020, 12) and pipeline["opportunities"] == 2
    (none,) = reports._bookings_state(frame.limit(0)).collect()
    assert (none["latest"], none["open_acv"], none["open"]) == (None, None, 0)


def test_a_layer_by_month_is_dealt_before_months_are_made(spark, sample_dir, tmp_path):
    """The same rows as the fact itself, each month in its folder; spans and not months are shuffled for it."""
    from ledgerwave.plans.revenue import sample_revenue

    r = sample_revenue(spark, sample_dir)
    dealt = r.fct_arr_by_month()
    table = dealt.finish(dealt.rows.hint("rebalance", "year"))
    text = table._jdf.queryExecution().executedPlan().toString().splitlines()
    made = next(i for i, line in enumerate(text) if "Generate explode(sequence" in line)
    assert not any("Exchange" in line for line in text[:made]) and any("REBALANCE" in line for line in text[made:])
    written = layers.materialize_layer(spark, "marts", {"t": dealt}, str(tmp_path), {"t": "measurement_month"})["t"]
    assert table.columns == r.fct_arr.columns
    own = written.select(*r.fct_arr.columns)
    assert own.exceptAll(r.fct_arr).count() == r.fct_arr.exceptAll(own).count() == 0
    months = [p for p in os.listdir(tmp_path / "marts" / "t") if p.startswith("measurement_month=")]
    assert len(months) == r.fct_arr.select("measurement_month").distinct().count()
