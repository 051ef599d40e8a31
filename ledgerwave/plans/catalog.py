"""Every query by name, each over the sample tables of one folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import Estimator
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from ledgerwave.functions.joins import join_sides
from ledgerwave.operators import (
    bookings,
    cards,
    careers,
    checks,
    matchup,
    metrics,
    models,
    movements,
    pairs,
    recon,
    snapshots,
)
from ledgerwave.plans import reports
from ledgerwave.plans.bouts import Bouts, sample_bouts
from ledgerwave.plans.revenue import Revenue, sample_revenue
from ledgerwave.session import ensure_checkpoint_dir, fresh_path
from ledgerwave.sources import conform, feeds, layers, sample, spines, versions

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def plain(df: DataFrame) -> DataFrame:
    """Exact decimals leave as doubles; inside the library they stay decimal."""
    decimals = {f.name for f in df.schema.fields if isinstance(f.dataType, DecimalType)}
    return df.select([F.col(c).cast("double").alias(c) if c in decimals else F.col(c) for c in df.columns])


def register(name: str, build: Callable[[Revenue], DataFrame]) -> None:
    QUERIES[name] = lambda spark, folder: plain(build(sample_revenue(spark, folder)))


STAGED = {
    "stg_accounts": "accounts",
    "stg_users": "users",
    "stg_products": "products",
    "stg_opportunities": "opportunities",
    "stg_opportunity_lines": "opportunity_line_items",
    "stg_contracts": "contracts",
    "stg_subscriptions": "subscriptions",
    "stg_erp_customers": "erp_customers",
    "stg_erp_items": "erp_items",
    "stg_erp_orders": "erp_orders",
    "stg_erp_order_lines": "erp_order_lines",
    "stg_erp_invoices": "erp_invoices",
    "stg_erp_invoice_lines": "erp_invoice_lines",
    "stg_usage_monthly": "usage_monthly",
}
for _name, _feed in STAGED.items():
    register(_name, lambda r, feed=_feed: r.staged(feed))

register("contract_lines_normalized", lambda r: r.contract_lines)
register("active_on_snapshot", lambda r: snapshots.active_on_snapshot(r.arr_spans))
register("first_active", lambda r: snapshots.first_active(r.arr_changes))
register("densify", lambda r: snapshots.densify(snapshots.active_on_snapshot(r.arr_spans), r.window))
register("arr_account_product_month", lambda r: r.arr_account_product_month)
register("ever_active_before", lambda r: movements.history_by_month(r.arr_history))
register("period_movement", lambda r: movements.period_movement(r.arr_history))
register("movement_buckets", lambda r: r.arr_movements)
register("fct_arr", lambda r: r.fct_arr)
register("opportunity_acv_tcv", lambda r: bookings.opportunity_acv_tcv(
    r.staged("opportunity_line_items"), r.staged("opportunities"), r.staged("products"), r.staged("users")))
register("first_won_dates", lambda r: bookings.first_won_dates(
    r.staged("opportunity_line_items"), r.staged("opportunities")))
register("deal_motion", lambda r: r.acv_lines.groupBy("revenue_category", "opportunity_type", "is_won").agg(
    F.count("*").alias("lines"), F.sum("acv").alias("acv")))
register("fct_acv", lambda r: r.fct_acv)
register("usage_period_rollup", lambda r: r.usage_rollup)
register("fct_usage", lambda r: r.fct_usage)
register("invoice_coverage", lambda r: recon.invoice_coverage(r.staged("erp_invoices")))
register("reconcile", lambda r: r.recon_match.drop("match_status", "discrepancy_category"))
register("recon_classify", lambda r: r.recon_match.select(
    "contract_id", "sales_order_id", "match_status", "discrepancy_category"))
register("rpt_recon", lambda r: r.rpt_recon)
register("dim_account", lambda r: r.dim_account)
register("dim_product", lambda r: r.dim_product)
register("dim_sales_rep", lambda r: r.dim_sales_rep)
register("surrogate_key", lambda r: r.fct_acv.select(
    "opportunity_line_id", "acv_key", "account_key", "product_key", "sales_rep_key"))

register("arr_bridge_by_period", lambda r: reports.arr_bridge_by_period(r.fct_arr))
register("recon_summary", lambda r: reports.recon_summary(r.rpt_recon))
register("arr_trend", lambda r: reports.arr_trend(r.fct_arr))
register("arr_movement_by_year", lambda r: reports.arr_movement_by_year(r.fct_arr))
register("year_end_arr", lambda r: reports.year_end_arr(r.fct_arr))
register("retention_kpis", lambda r: reports.retention_kpis(r.fct_arr))
register("bookings_by_category", lambda r: reports.with_label(
    reports.bookings_by_category(r.fct_acv), "revenue_category", reports.CATEGORY_LABELS))
register("bookings_by_segment", lambda r: reports.bookings_by_segment(r.fct_acv, r.dim_account))
register("open_pipeline", lambda r: reports.open_pipeline(r.fct_acv))
register("latest_year_bookings", lambda r: reports.latest_year_bookings(r.fct_acv))
register("utilization_buckets", lambda r: reports.utilization_buckets(r.fct_usage))
register("at_risk_by_category", lambda r: reports.with_label(
    reports.at_risk_by_category(r.rpt_recon), "discrepancy_category", reports.DISCREPANCY_LABELS))
register("kpi_frame", lambda r: reports.kpi_frame(r.fct_arr, r.fct_acv, r.rpt_recon))


# --- metric layer --------------------------------------------------------------

SIMPLE_METRICS = [m.name for m in metrics.METRICS.values() if m.measure]
DERIVED_METRICS = ("expansion_arr", "gross_revenue_retention", "net_revenue_retention", "average_deal_acv")
FILTERED_METRICS = ("bookings_acv", "pipeline_acv", "new_logo_bookings_acv", "won_opportunity_count")

register("semantic_model", lambda r: metrics.measure_totals(r))
register("simple_metric", lambda r: metrics.metric(r, *SIMPLE_METRICS, grain="year"))
register("metric_filter", lambda r: metrics.metric(r, *FILTERED_METRICS, by=("opportunity_type",)))
register("derived_metric", lambda r: metrics.metric(r, *DERIVED_METRICS, grain="quarter"))
register("ratio_metric", lambda r: metrics.metric(r, "average_utilization", grain="quarter"))
register("metric_by_dimension", lambda r: metrics.metric(
    r, "bookings_acv", "won_opportunity_count", by=("account__segment", "sales_rep__sales_region"),
    grain="quarter"))
register("metric_where", lambda r: metrics.metric(
    r, "bookings_acv", "pipeline_acv", by=("sales_rep__sales_region",), grain="year",
    where="account__segment = 'BUILDING' or account__segment is null"))
register("metric_last_snapshot", lambda r: metrics.metric(
    r, "total_arr", "net_new_arr", by=("account__segment",), grain="year", semi_additive="last"))


def _metric_time_fill(spark: SparkSession, folder: str) -> DataFrame:
    daily = metrics.metric(sample_revenue(spark, folder), "bookings_acv", "pipeline_acv", grain="day")
    days = spines.day_spine(spark, sample.WINDOW_START, sample.WINDOW_END)
    return metrics.metric_time_fill(daily, days, "date_day", "bookings_acv", "pipeline_acv")


QUERIES["metric_time_fill"] = _metric_time_fill


# --- checks ----------------------------------------------------------------------

register("assert_unique", lambda r: checks.assert_unique(r.staged("opportunity_line_items"), "opportunity_id"))
register("assert_not_null", lambda r: checks.assert_not_null(r.staged("opportunities"), "contract_id"))
register("assert_relationship", lambda r: checks.assert_relationship(
    r.staged("contracts"), "external_order_ref", r.staged("erp_orders"), "sales_order_id"))
register("assert_accepted_values", lambda r: checks.assert_accepted_values(
    r.dim_account, "geo_region", ("NA", "EMEA", "APAC", "LATAM")))
register("assert_unique_combination", lambda r: checks.assert_unique_combination(
    r.staged("subscriptions"), "account_id", "product_id"))
register("assert_range", lambda r: checks.assert_range(r.fct_usage, "utilization_pct", 0, 1.2).select(
    "account_id", "product_id", "usage_month", "utilization_pct"))
register("assert_waterfall_integrity", lambda r: checks.assert_waterfall_integrity(reports.monthly_bridge(r.fct_arr)))
register("assert_arr_continuity", lambda r: checks.assert_arr_continuity(reports.monthly_bridge(r.fct_arr)))
register("assert_acv_components", lambda r: checks.assert_acv_components(r.fct_acv))


def _assert_recon_counts(spark: SparkSession, folder: str) -> DataFrame:
    """The sample injects every kind of discrepancy into one order in fifty."""
    injected = [c for c in recon.CATEGORIES if c != "matched_clean"]
    expected = spark.read.parquet(f"{folder}/orders.parquet").agg(
        F.floor(F.count("*") / 50).alias("expected_count")
    ).select(F.explode(F.array(*[F.lit(c) for c in injected])).alias("discrepancy_category"), "expected_count")
    return checks.assert_recon_counts(sample_revenue(spark, folder).rpt_recon, expected)


QUERIES["assert_recon_counts"] = _assert_recon_counts


INNER_TABLES = ("acv_lines", "contract_lines", "arr_account_product_month", "arr_movements")


def check_tables(r: Revenue) -> dict[str, DataFrame]:
    """Every table the check suite looks at."""
    feeds = {name: r.staged(name) for name in conform.SPECS}
    return {**feeds, **{name: getattr(r, name) for name in INNER_TABLES}, **r.marts()}


def built(spark: SparkSession, folder: str) -> Revenue:
    """The warehouse as a build leaves it: feeds, then inner tables, then marts, each written from the layer before."""
    r = sample_revenue(spark, folder)
    path = fresh_path(spark, "warehouse")

    def layer(name: str, tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
        done = models.each(lambda t: layers.materialize_layer(spark, name, {t: tables[t]}, path)[t], list(tables))
        return dict(zip(tables, done))

    r._staged.update(layer("feeds", {name: r.staged(name) for name in conform.SPECS}))
    for name, table in layer("inner", {n: getattr(r, n) for n in INNER_TABLES}).items():
        setattr(r, name, table)
    for name, table in layer("marts", r.marts()).items():
        setattr(r, name, table)
    return r


def _run_checks(spark: SparkSession, folder: str) -> DataFrame:
    """Every table is written once, then checked, as a warehouse build does it."""
    return checks.run_checks(spark, check_tables(built(spark, folder)))


def _run_checks_kept(spark: SparkSession, folder: str) -> DataFrame:
    """The waterfall checked by month: first without its last month, then with it, which alone is counted then."""
    r = sample_revenue(spark, folder)
    path = fresh_path(spark, "by-month")
    month = F.col("measurement_month")
    last = F.lit(sample.LAST_SNAPSHOT).cast("date")
    stored = layers.materialize_layer(spark, "marts", {"fct_arr": r.fct_arr_by_month()}, path, {"fct_arr": "measurement_month"})["fct_arr"]
    of_arr = [c for c in checks.GENERIC_CHECKS if c.table == "fct_arr" and c.kind != "relationship"]
    kept = checks.KeptCounts(spark, f"{path}/counts", {"fct_arr": "measurement_month"})
    checks.run_checks(spark, {"fct_arr": stored.filter(month < last)}, of_arr, kept)
    return checks.run_checks(spark, {"fct_arr": stored}, of_arr, kept)


QUERIES["run_checks"] = _run_checks
QUERIES["run_checks_kept"] = _run_checks_kept


# --- sources and sinks -------------------------------------------------------------

def _month_spine(spark: SparkSession, folder: str) -> DataFrame:
    r = sample_revenue(spark, folder)
    starts = r.staged("subscriptions").groupBy(
        F.last_day("subscription_start_date").alias("measurement_month")
    ).agg(F.count("*").alias("starting"))
    return spines.month_spine(spark, r.window).join(starts, "measurement_month", "left").select(
        "measurement_month", F.coalesce("starting", F.lit(0)).alias("starting")
    )


def _day_spine(spark: SparkSession, folder: str) -> DataFrame:
    closing = sample_revenue(spark, folder).staged("opportunities").groupBy(
        F.col("close_date").alias("date_day")
    ).agg(F.count("*").alias("closing"))
    days = spines.day_spine(spark, sample.WINDOW_START, sample.WINDOW_END)
    return days.join(closing, "date_day", "left").select("date_day", F.coalesce("closing", F.lit(0)).alias("closing"))


def _load_feed(spark: SparkSession, folder: str) -> DataFrame:
    """Accounts written as the CSV feed they arrive as, read back typed."""
    path = fresh_path(spark, "accounts") + ".csv"
    sample.accounts(sample.Tables(spark, folder)).write.option("header", True).csv(path)
    return conform.conform(feeds.load_feed(spark, path, feeds.SCHEMAS["accounts"]), "accounts")


def _register_sources(spark: SparkSession, folder: str) -> DataFrame:
    feeds.register_sources(spark, {t: f"{folder}/{t}.parquet" for t in ("orders", "customer")}, prefix="raw_")
    return spark.sql(
        "SELECT c_mktsegment, o_orderstatus, count(*) AS orders FROM raw_orders "
        "JOIN raw_customer ON o_custkey = c_custkey GROUP BY c_mktsegment, o_orderstatus"
    )


def _materialize_layer(spark: SparkSession, folder: str) -> DataFrame:
    """The waterfall written by month; the latest snapshot reads one partition of it."""
    r = sample_revenue(spark, folder)
    marts = layers.materialize_layer(
        spark, "marts", {"fct_arr": r.fct_arr_by_month()}, fresh_path(spark, "layer"), {"fct_arr": "measurement_month"}
    )
    latest = F.lit(sample.LAST_SNAPSHOT).cast("date")
    return plain(marts["fct_arr"].filter(F.col("measurement_month") == latest).groupBy("revenue_category").agg(
        F.count("*").alias("rows"), F.sum("ending_arr").alias("ending_arr")
    ))


def _upsert_by_key(spark: SparkSession, folder: str) -> DataFrame:
    """A restatement of some accounts' contracts replaces what those accounts had."""
    existing = sample_revenue(spark, folder).staged("contracts").select(
        "account_id", "contract_id", "contract_status"
    )
    incoming = existing.filter((F.col("account_id") % 7 == 0) & (F.col("contract_id").cast("bigint") % 2 == 0))
    return layers.upsert_by_key(existing, incoming.withColumn("contract_status", F.lit("Restated")), "account_id")


def _upsert_stored(spark: SparkSession, folder: str) -> DataFrame:
    """Contracts stored, restated for some accounts, closed for others, and the closing run a second time."""
    contracts = sample_revenue(spark, folder).staged("contracts").select(
        "account_id", "contract_id", "contract_status"
    )
    stored = versions.StoredTable(spark, fresh_path(spark, "contracts"), ["account_id"])
    stored.upsert(contracts, "contracts")
    restated = contracts.filter((F.col("account_id") % 7 == 0) & (F.col("contract_id").cast("bigint") % 2 == 0))
    stored.upsert(restated.withColumn("contract_status", F.lit("Restated")), "restatement")
    closed = contracts.filter((F.col("account_id") % 5 == 0) & (F.col("contract_id").cast("bigint") % 3 == 0))
    for _ in range(2):
        stored.upsert(closed.withColumn("contract_status", F.lit("Closed")), "closing")
    return stored.read()


QUERIES["month_spine"] = _month_spine
QUERIES["day_spine"] = _day_spine
QUERIES["load_feed"] = _load_feed
QUERIES["register_sources"] = _register_sources
QUERIES["materialize_layer"] = _materialize_layer
QUERIES["upsert_by_key"] = _upsert_by_key
QUERIES["upsert_stored"] = _upsert_stored


# --- paired index ------------------------------------------------------------------

def register_bouts(name: str, build: Callable[[Bouts], DataFrame], write: bool = False) -> None:
    QUERIES[name] = lambda spark, folder: build(sample_bouts(spark, folder, write))


def register_careers(name: str, build: Callable[[Bouts], DataFrame]) -> None:
    """Careers read bouts and sides several times, so both are written once."""
    register_bouts(name, build, write=True)


# The sample's bouts end in 2001 and no fighter in it goes without a knockdown.
SAMPLE_ACTIVE_SINCE = 2001
SAMPLE_FEW_KNOCKDOWNS = 0.25
SAMPLE_FEW_LOSSES = 40

register_bouts("load_bout_tables", lambda b: b.fight_details.join(
    pairs.bout_dates(b.fights, b.events), "fight_id").groupBy("event_date", "method").agg(F.count("*").alias("bouts")))
register_bouts("entity_names", lambda b: b.names)
register_bouts("per_side_totals", lambda b: b.totals)
register_bouts("pair_opponents", lambda b: b.paired.drop("opponents"))
register_bouts("loss_flag", lambda b: b.flagged.drop("opponents"))
register_bouts("chin_index", lambda b: b.raw_index)
register_bouts("disambiguate_names", lambda b: b.index.select("fighter_url", "fighter"))
register_bouts("bucket_histogram", lambda b: pairs.bucket_histogram(b.raw_index))
register_bouts("distribution_summary", lambda b: pairs.distribution_summary(b.raw_index))
register_bouts("leaderboard_highest", lambda b: pairs.leaderboard_highest(b.index))
register_bouts("leaderboard_zero", lambda b: pairs.leaderboard_zero(b.index, max_per_fight=SAMPLE_FEW_KNOCKDOWNS))
register_bouts("leaderboard_survivors", lambda b: pairs.leaderboard_survivors(
    b.index, max_losses=SAMPLE_FEW_LOSSES))
register_bouts("weight_class_of", lambda b: b.fighters.select(
    "fighter_url", "weight", pairs.weight_class_of("weight").alias("division")))
register_bouts("class_breakdown", lambda b: pairs.class_breakdown(b.raw_index, b.fighters))
register_bouts("age_at_event", lambda b: b.ages)
register_bouts("age_curve", lambda b: pairs.age_curve(b.ages, b.paired))
register_bouts("scatter", lambda b: pairs.scatter(b.index))
register_bouts("scatter_and_corr", lambda b: pairs.scatter_corr(pairs.scatter(b.raw_index)))
register_bouts("recent_vs_career_watchlist", lambda b: pairs.recent_vs_career_watchlist(
    b.paired, b.fights, b.events, b.index, active_since=SAMPLE_ACTIVE_SINCE))


def _write_artifact_json(spark: SparkSession, folder: str) -> DataFrame:
    board = pairs.leaderboard_highest(sample_bouts(spark, folder).index)
    path = layers.write_artifact_json(board, fresh_path(spark, "artifacts"), "glass_jaws")
    return spark.read.schema(board.schema).json(path)


QUERIES["write_artifact_json"] = _write_artifact_json


# --- careers --------------------------------------------------------------------------

def profile_columns(b: Bouts, *names: str) -> DataFrame:
    return b.profiles.select("fighter_url", "event_date", *names)


register_bouts("bouts_clean", lambda b: b.clean)
register_bouts("side_stats", lambda b: b.stats)
register_bouts("bout_sides", lambda b: b.sides)
register_careers("career_features_asof", lambda b: profile_columns(
    b, "fights", *careers.CAREER_FEATURES, "opp_accuracy_against"))
register_careers("recent5_win_rate", lambda b: profile_columns(b, "recent_win_rate"))
register_careers("recent3_features", lambda b: profile_columns(b, *careers.RECENT_FEATURES))
register_careers("streaks", lambda b: profile_columns(b, "win_streak", "loss_streak"))
register_careers("experience", lambda b: profile_columns(b, "fights").withColumn(
    "log_fights", F.round(F.log1p(F.col("fights").cast("double")), 9)))
register_careers("career_profiles", lambda b: b.final_profiles.withColumn("log_fights", F.round("log_fights", 9)))
register_careers("training_pairs", lambda b: b.training.drop(*[f"winner_{f}" for f in careers.METHOD_FEATURES])
               .withColumn("log_fights", F.round("log_fights", 9)))
register_careers("winner_profile", lambda b: b.training.filter("not mirrored").select(
    "fight_id", "method", *[f"winner_{f}" for f in careers.METHOD_FEATURES]))


# --- cards and match-ups ------------------------------------------------------------------

# The sample's names are a first name and a number, so the first word finds someone at any scale.
CARD = [("ANA 0", "bo somebody"), ("Cy 7", "Di 3"), ("Ed 11", "Zoltan Nobody"), ("Flo 20", "gus 5"), ("Gus 1", "Ana 2")]
SAMPLE_TODAY = "2002-01-01"


def _resolve_entity(spark: SparkSession, folder: str) -> DataFrame:
    b = sample_bouts(spark, folder)
    return cards.resolve_entity(spark, cards.all_names(b.fight_details), [name for bout in CARD for name in bout])


def _resolve_requests(spark: SparkSession, folder: str) -> DataFrame:
    """A request for every bout: a full name, a first word, a part of one, or nobody's."""
    b = sample_bouts(spark, folder)
    name, kind = F.col("fighter1_name"), F.col("fight_id").cast("bigint") % 4
    first = F.split_part(name, F.lit(" "), F.lit(1))
    requests = b.fight_details.select(
        F.col("fight_id").alias("request_id"),
        F.when(kind == 0, F.upper(name))
        .when(kind == 1, F.concat(F.lit("  "), first, F.lit(" Nobody")))
        .when(kind == 2, F.concat(F.substring(first, 2, 2), F.lit(" 3")))
        .otherwise(F.concat(F.col("fight_id"), F.lit(" "), first))
        .alias("requested"),
    )
    return cards.resolve_requests(cards.all_names(b.fight_details), requests)


def _select_card(spark: SparkSession, folder: str) -> DataFrame:
    b = sample_bouts(spark, folder)
    return cards.select_card(spark, cards.all_names(b.fight_details), b.clean, CARD)


def _reasoning_text(b: Bouts) -> DataFrame:
    """Why the winner of each bout would have been picked, from both whole careers."""
    first = F.col("winner") == "fighter1"
    winner = F.when(first, F.col("p1")).otherwise(F.col("p2"))
    loser = F.when(first, F.col("p2")).otherwise(F.col("p1"))
    name = F.when(first, F.col("fighter1_name")).otherwise(F.col("fighter2_name"))
    bouts = b.clean.select(
        "fight_id", "fighter1_url", "fighter2_url", "fighter1_name", "fighter2_name", "winner", "method"
    )
    chance = winner["win_rate"] / F.nullif(winner["win_rate"] + loser["win_rate"], F.lit(0.0))
    return (
        join_sides(
            bouts, b.final_profiles.drop("event_date"), [["fighter1_url"], ["fighter2_url"]], ["fighter_url"], "p",
            ["fight_id"],
        )
        .withColumns({"w": winner, "l": loser, "name": name, "prob": F.coalesce(chance, F.lit(0.5))})
        .select(
            "fight_id",
            cards.confidence(F.col("prob")).alias("confidence"),
            cards.reasoning_text(F.col("w"), F.col("l"), F.col("name"), F.col("method"), F.col("prob")).alias(
                "reasoning"
            ),
        )
    )


def _shrink_to_global(b: Bouts) -> DataFrame:
    sums = matchup.round_sums(b.round_stats)
    fights = b.totals.groupBy("fighter_url").agg(F.count("*").alias("fights"))
    return matchup.shrink_to_global(
        matchup.round_distributions(sums), matchup.global_distributions(sums), fights
    )


def _matchup_modifiers(version: str) -> Callable[[Bouts], DataFrame]:
    def build(b: Bouts) -> DataFrame:
        card = b.fight_details.select("fight_id", "fighter1_url", "fighter2_url")
        corner = matchup.corners(b.final_profiles, b.fighters, SAMPLE_TODAY, version)
        return matchup.matchup_modifiers(card, corner, matchup.class_finish_rates(b.clean, b.fighters), version)

    return build


QUERIES["resolve_entity"] = _resolve_entity
QUERIES["resolve_requests"] = _resolve_requests
QUERIES["select_card"] = _select_card
register_careers("reasoning_text", _reasoning_text)
register_bouts("round_distributions", lambda b: matchup.round_distributions(matchup.round_sums(b.round_stats)))
register_bouts("global_distributions", lambda b: matchup.global_distributions(matchup.round_sums(b.round_stats)))
register_bouts("shrink_to_global", _shrink_to_global)
register_careers("form_blend", lambda b: b.profiles.select("fighter_url", "event_date", *[
    c.alias(n) for n, c in matchup.form_blend().items()]))
register_bouts("class_finish_rates", lambda b: matchup.class_finish_rates(b.clean, b.fighters))
register_careers("matchup_modifiers", _matchup_modifiers("v2.3"))
for _version in ("v2", "v2.1", "v2.2"):
    register_careers(f"matchup_modifiers_{_version.replace('.', '_')}", _matchup_modifiers(_version))
register_bouts("age_thresholds", lambda b: b.fighters.withColumn(
    "limits", matchup.age_thresholds(pairs.weight_class_of("weight"))).select(
        "fighter_url", "weight", "limits.chin", "limits.fatigue"))
register_bouts("round_scorecard", lambda b: matchup.round_scorecard(b.round_stats, b.fight_details))
register_bouts("decision_outcome", lambda b: matchup.decision_outcome(
    matchup.round_scorecard(b.round_stats, b.fight_details)))


# --- models ----------------------------------------------------------------------------------

# Small ensembles for the queries that calibrate, save and predict; stack and train_winner fit the full sizes.
TREES, EPOCHS, INNER_FOLDS = 5, 20, 3


def _training_table(spark: SparkSession, folder: str) -> tuple[Bouts, DataFrame]:
    """The training pairs, written once; every fit reads the table and not the plan behind it."""
    ensure_checkpoint_dir(spark)
    b = sample_bouts(spark, folder, write=True)
    written = layers.materialize_layer(spark, "training", {"pairs": b.training}, fresh_path(spark, "models"))
    return b, written["pairs"]


def _winner_candidates(pairs_table: DataFrame) -> dict[str, Estimator]:
    return models.candidates(pairs_table.count(), TREES, EPOCHS)


def _train_winner(spark: SparkSession, folder: str) -> DataFrame:
    """Four models and three made of them, compared on held-out bouts; the best is fitted on all and kept."""
    _, table = _training_table(spark, folder)
    everything = {**models.candidates(table.count()), **models.composites()}
    return models.scores_frame(spark, models.train_winner(table, everything))


def _interactions_select(spark: SparkSession, folder: str) -> DataFrame:
    _, table = _training_table(spark, folder)
    return models.interactions_select(table)


def _stack(spark: SparkSession, folder: str) -> DataFrame:
    _, table = _training_table(spark, folder)
    return models.stack_accuracy(table, models.composites()["Stacking"])


def _calibrate(spark: SparkSession, folder: str) -> DataFrame:
    """Bouts that neither a forest nor its maps have seen."""
    _, table = _training_table(spark, folder)
    calibrated = models.CrossCalibrated(_winner_candidates(table)["RandomForest"], INNER_FOLDS)
    return models.reliability(models.out_of_fold(models.with_folds(table), calibrated))


def _train_method(spark: SparkSession, folder: str) -> DataFrame:
    _, table = _training_table(spark, folder)
    return models.method_confusion(table)


def _predict_card(spark: SparkSession, folder: str) -> DataFrame:
    """The bouts of the last event, predicted with saved and reloaded models, the winner's calibrated."""
    b, table = _training_table(spark, folder)
    trees = {name: model for name, model in _winner_candidates(table).items() if name in models.TREE_MODELS}
    saved = fresh_path(spark, "saved")
    models.save_models(
        spark, saved, models.train_winner(table, trees, INNER_FOLDS), models.train_method(table)
    )
    winner, method = models.load_models(spark, saved)
    last_event = b.clean.agg(F.max("event_date")).scalar()
    card = b.clean.filter(F.col("event_date") == last_event).select(
        "fighter1_url", "fighter2_url", F.col("fighter1_name").alias("fighter1"), F.col("fighter2_name").alias("fighter2")
    )
    return models.predict_card(card, b.final_profiles, winner, method)


def _saved_models(spark: SparkSession, folder: str) -> DataFrame:
    """Every model saved and loaded again: rows, and those whose probability has changed."""
    _, table = _training_table(spark, folder)
    everything = {**_winner_candidates(table), **models.composites(TREES, EPOCHS, INNER_FOLDS)}
    everything["Calibrated"] = models.CrossCalibrated(everything["RandomForest"], INNER_FOLDS)
    fitted = models.each(lambda name: everything[name].fit(table), list(everything), models.at_once(table))
    return models.round_trips(spark, fresh_path(spark, "saved"), table, dict(zip(everything, fitted)))


QUERIES["train_winner"] = _train_winner
QUERIES["interactions_select"] = _interactions_select
QUERIES["stack"] = _stack
QUERIES["calibrate"] = _calibrate
QUERIES["train_method"] = _train_method
QUERIES["predict_card"] = _predict_card
QUERIES["saved_models"] = _saved_models
