"""The shape of the physical plans: what scale depends on."""

import pytest
from pyspark.sql import functions as F

from ledgerwave.functions import joins
from ledgerwave.operators import bookings, careers, movements, snapshots, usage
from ledgerwave.operators.snapshots import MonthWindow
from ledgerwave.plans.bouts import sample_bouts
from ledgerwave.plans.catalog import QUERIES
from ledgerwave.plans.revenue import sample_revenue
from ledgerwave.sources import sample

# Queries that train models run jobs while they are built.
TRAINING = {"train_winner", "interactions_select", "stack", "calibrate", "train_method", "predict_card", "saved_models"}
WRITING = {"run_checks", "load_feed", "materialize_layer", "write_artifact_json", "upsert_stored"}


def plan(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - TRAINING - WRITING))
def test_no_nested_loops_and_no_python(spark, sample_dir, name):
    text = plan(QUERIES[name](spark, sample_dir))
    for operator in ("BroadcastNestedLoopJoin", "CartesianProduct", "BatchEvalPython", "ArrowEvalPython"):
        assert operator not in text


def test_recurring_filter_and_columns_reach_the_scan(spark, sample_dir):
    text = plan(sample_revenue(spark, sample_dir).arr_changes)
    scan = next(line for line in text.splitlines() if "lineitem.parquet" in line)
    assert "l_linestatus" in scan.split("DataFilters")[1]
    assert "l_discount" not in scan and "l_tax" not in scan


def test_both_sides_of_the_waterfall_share_one_scan(spark, sample_dir):
    for frame in (
        sample_revenue(spark, sample_dir).fct_arr,
        sample_revenue(spark, sample_dir).fct_arr.groupBy("measurement_month").agg(F.sum("ending_arr")),
    ):
        frame.collect()
        final = plan(frame).split("Initial Plan")[0]
        assert "ReusedExchange" in final
        assert final.count("lineitem.parquet") == 1


def test_latest_bouts_are_limited_before_the_shuffle(spark, sample_dir):
    text = plan(QUERIES["recent_vs_career_watchlist"](spark, sample_dir))
    assert text.count("WindowGroupLimit") == 2


def test_a_hot_account_is_split(spark):
    """One account holds a third of the segments, each of another product; its join partition is split."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    window = MonthWindow("2023-01-01", "2024-01-01")
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        segments = spark.range(60000).select(
            F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("account_id"),
            F.col("id").alias("product_id"),
            F.lit("10.00").cast("decimal(18,2)").alias("annual_recurring_amount"),
            F.lit(1).alias("entitled_units"),
            F.add_months(F.lit("2023-01-01").cast("date"), (F.col("id") % 12).cast("int")).alias(
                "subscription_start_date"
            ),
            F.lit("2023-12-31").cast("date").alias("subscription_end_date"),
        )
        changes = snapshots.run_rate_changes(segments, window)
        spans = snapshots.run_rate_spans(changes, window)
        frame = movements.period_movement(movements.ever_active_before(spans, changes), keep_inactive=False)
        rows = frame.collect()
        assert "skew=true" in plan(frame).split("Initial Plan")[0]
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    starts = [r for r in rows if r.revenue_category in ("new_logo", "cross_sell")]
    assert len(starts) == 60000
    assert sum(r.revenue_category == "cross_sell" for r in starts) == sum(
        1 for i in range(0, 60000, 3) if i % 12 != 0
    )


def test_a_hot_fighter_is_summed_per_day(spark, sample_dir):
    """The career window sees days, of which there are few, and not bouts."""
    text = plan(sample_bouts(spark, sample_dir).state)
    window = text.index("hashpartitioning(fighter_url")
    assert "HashAggregate(keys=[fighter_url" in text[window:] or "SortAggregate(key=[fighter_url" in text[
        window:
    ] or "ObjectHashAggregate(keys=[fighter_url" in text[window:]


def lines_above(text: str, mark: str) -> list[str]:
    """The operators that come after the first one with ``mark``: plans are printed from the result down."""
    lines = text.splitlines()
    return lines[: next(i for i, line in enumerate(lines) if mark in line)]


def test_expanded_usage_months_are_not_shuffled(spark, sample_dir):
    text = plan(sample_revenue(spark, sample_dir).fct_usage)
    assert not any("Exchange" in line for line in lines_above(text, "Generate explode(sequence"))


def test_usage_is_dealt_by_key_before_months_are_made(spark, sample_dir):
    r = sample_revenue(spark, sample_dir)
    for frame in (r.usage_rollup, usage.usage_by_key(r.usage_rollup)):
        assert not any("Exchange" in line for line in lines_above(plan(frame), "Generate explode(sequence"))


def test_usage_of_any_line_is_the_sum_over_its_months(spark, tmp_path):
    """Negative numbers and missing ones too: every line and month by itself gives the same."""
    lines = spark.range(-60, 60).select(
        (F.col("id") % 9).alias("l_orderkey"),
        F.lit(3).cast("long").alias("l_partkey"),
        F.when(F.col("id") % 11 != 0, F.col("id") % 8).cast("int").alias("l_linenumber"),
        F.when(F.col("id") % 7 != 0, F.col("id") % 13).cast("double").alias("l_quantity"),
        F.when(F.col("id") % 2 == 0, "R").otherwise("N").alias("l_returnflag"),
        F.lit("O").alias("l_linestatus"),
        F.add_months(F.lit("1998-03-05").cast("date"), (F.col("id") % 5).cast("int")).cast("timestamp").alias("l_shipdate"),
    )
    lines.write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.range(-8, 9).select(F.col("id").alias("o_orderkey"), (F.col("id") % 2).alias("o_custkey")).write.parquet(
        f"{tmp_path}/orders.parquet"
    )
    got = {tuple(r[:3]): r[3] for r in sample.usage_monthly(sample.Tables(spark, str(tmp_path))).collect()}
    month = F.explode(F.expr("sequence(trunc(l_shipdate, 'month'), add_months(trunc(l_shipdate, 'month'), "
                             "if(l_returnflag = 'R', 5, 23)), interval 1 month)"))
    tenths = F.expr("int(l_quantity) * (4 + ((l_orderkey * 10 + l_linenumber) * 7 + month(month) * 3) % 10)")
    plainly = lines.withColumn("month", month).groupBy(F.expr("l_orderkey % 2"), F.expr("l_partkey % 5"), "month").agg(
        F.sum(tenths).alias("tenths")
    )
    want = {tuple(r[:3]): r[3] for r in plainly.collect()}
    assert len(want) > 40 and want.keys() == got.keys()
    assert all((got[k] is None) == (v is None) and (v is None or got[k] * 10 == v) for k, v in want.items())


def test_lines_are_not_shuffled_on_product_keys(spark, sample_dir):
    """Even if the table behind the products is over Spark's limit."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        r = sample_revenue(spark, sample_dir)
        for frame in (r.contract_lines, r.acv_lines):
            text = plan(frame)
            assert "hashpartitioning(product_id" not in text and "BroadcastHashJoin [product_id" in text
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_owners_meet_deals_and_not_lines(spark, sample_dir):
    """Owners too many to be sent to every task are looked up per deal; lines are shuffled for their dates alone."""
    r = sample_revenue(spark, sample_dir)
    users = r.staged("users").unionByName(
        spark.range(10**6, 10**6 + 30000).selectExpr("id as user_id", "'x' as user_name"), allowMissingColumns=True
    )
    lines, deals, products = r.staged("opportunity_line_items"), r.staged("opportunities"), r.staged("products")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for frame in (
            bookings.opportunity_acv_tcv(lines, deals, products, users),
            bookings.fct_acv(bookings.opportunity_lines_acv(lines, deals, products, users)),
        ):
            text = plan(frame)
            above = lines_above(text, "SortMergeJoin [opportunity_id")
            assert "hashpartitioning(owner_id" in text
            assert not any("hashpartitioning(owner_id" in line for line in above)
        fact = bookings.fct_acv(bookings.opportunity_lines_acv(lines, deals, products, users))
        assert not any("l_linenumber" in line for line in plan(fact.agg(F.sum("acv"))).splitlines() if "Exchange" in line)
        scans = [line for line in plan(fact.agg(F.sum("acv"))).splitlines() if "lineitem.parquet" in line]
        assert not any("l_linenumber" in line for line in scans)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_lookup_of_any_size_gives_the_same(spark):
    rows = spark.range(500).select("id", (F.col("id") % 7).alias("k"))
    lookup = spark.range(6).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    small, sliced = (joins.join_sized(rows, lookup, ["k"], ["id"], small=n) for n in (6, 5))
    assert "BroadcastHashJoin" in plan(small) and "_slice" in sliced._jdf.queryExecution().analyzed().toString()
    assert sorted(map(tuple, small.collect()), key=str) == sorted(map(tuple, sliced.select(*small.columns).collect()), key=str)


def test_headline_figures_read_each_mart_once(spark, sample_dir):
    """As many scans as the three marts have by themselves."""

    def scans(frame):
        return plan(frame).count("FileScan") + plan(frame).count("Scan parquet")

    r = sample_revenue(spark, sample_dir)
    marts = sum(scans(m) for m in (r.fct_arr, r.fct_acv, r.rpt_recon))
    assert scans(QUERIES["kpi_frame"](spark, sample_dir)) <= marts


@pytest.mark.parametrize("spread", [None, ["bout"]])
def test_both_sides_meet_a_lookup_in_one_join(spark, spread):
    rows = spark.createDataFrame(
        [(1, "a", "b"), (2, "b", "a"), (3, "a", "nobody"), (4, "c", "c"), (5, None, "a")], "bout int, x string, y string"
    )
    lookup = spark.createDataFrame([("a", 1.0, None), ("b", 2.0, 3), ("c", 4.0, 5)], "who string, v double, n int")
    found = joins.join_sides(rows, lookup, [["x"], ["y"]], ["who"], "p", spread)
    got = {r["bout"]: (r["p1"]["v"], r["p2"]["v"]) for r in found.collect()}
    assert got == {1: (1.0, 2.0), 2: (2.0, 1.0), 4: (4.0, 4.0)}
    assert sum("Join" in line for line in plan(found).split("Initial Plan")[0].splitlines()) == 1


@pytest.mark.parametrize("name", ["training_pairs", "matchup_modifiers", "reasoning_text"])
def test_profiles_are_joined_once(spark, sample_dir, name):
    """One Generate makes the sides, and nothing joins a profile a second time."""
    text = plan(QUERIES[name](spark, sample_dir))
    assert text.count("posexplode") <= text.count("Generate")
    assert sum("posexplode" in line and "Generate" in line for line in text.splitlines()) == 1


def test_a_whole_career_is_merged_without_days(spark, sample_dir):
    b = sample_bouts(spark, sample_dir)
    text = plan(b.final_profiles)
    exchanges = [line for line in text.splitlines() if "Exchange hashpartitioning(fighter_url" in line]
    assert exchanges and not any("event_date" in line for line in exchanges)


def test_days_are_joined_as_they_lie(spark, sample_dir):
    """Sums, newest bouts and runs of a day share their partitions; only whole careers are shuffled after."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(sample_bouts(spark, sample_dir).state)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "coalesce(fighter_url" not in "".join(line for line in text.splitlines() if "Exchange" in line)


def test_a_career_up_to_a_date_is_the_state_of_a_bout_on_it(spark, sample_dir):
    """Streaks, sums and newest bouts, on days with several bouts too."""
    sides = sample_bouts(spark, sample_dir).sides.withColumn(
        "event_date", F.date_add(F.lit("2000-01-01").cast("date"), (F.xxhash64("fight_id") % 4).cast("int"))
    )
    later = sides.groupBy("fighter_url").agg(F.lit("x").alias("fight_id"), F.lit(True).alias("won")).withColumn(
        "event_date", F.lit("2001-01-01").cast("date")
    )
    day_by_day = careers.career_state(sides.unionByName(later, allowMissingColumns=True))
    want = day_by_day.filter("event_date = '2001-01-01'").collect()
    got = careers.career_state(sides, "2001-01-01").select(*day_by_day.columns).collect()
    assert len(got) > 5 and sorted(got, key=str) == sorted(want, key=str)


def test_bouts_and_sides_are_made_once(spark, sample_dir):
    """Queries of careers read what was written, and not the lines again for every step."""
    text = plan(QUERIES["career_profiles"](spark, sample_dir))
    assert "lineitem.parquet" not in text
