"""A registry of semantic models and metrics, and the aggregation that answers them."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerwave.functions.joins import join_hot


@dataclass(frozen=True)
class Measure:
    name: str
    expr: str
    agg: str = "sum"
    snapshot: bool = False  # a balance, which adds up over everything but time


@dataclass(frozen=True)
class SemanticModel:
    """How a mart is measured, sliced and joined."""

    name: str
    table: str
    primary: str
    time: str | None = None
    foreign: dict[str, str] = field(default_factory=dict)
    dimensions: dict[str, str] = field(default_factory=dict)
    measures: tuple[Measure, ...] = ()


@dataclass(frozen=True)
class Metric:
    name: str
    label: str
    measure: str | None = None
    where: str | None = None
    expr: str | None = None
    inputs: tuple[str, ...] = ()


def _named(*names: str) -> dict[str, str]:
    return {n: n for n in names}


DEAL_STATUS = "case when is_closed and is_won then 'won' when not is_closed then 'open' else 'lost' end"

MODELS: dict[str, SemanticModel] = {
    m.name: m
    for m in (
        SemanticModel(
            "account", "dim_account", "account_id",
            dimensions=_named("segment", "geo_region", "industry", "division", "account_tier"),
        ),
        SemanticModel(
            "product", "dim_product", "product_id",
            dimensions=_named("line_of_business", "product_family", "product_category"),
        ),
        SemanticModel("sales_rep", "dim_sales_rep", "user_id", dimensions=_named("sales_region", "sales_team")),
        SemanticModel(
            "arr", "fct_arr", "arr_key", time="measurement_month",
            foreign={"account": "account_id", "product": "product_id"},
            dimensions=_named("revenue_category"),
            measures=(
                Measure("ending_arr", "ending_arr", snapshot=True),
                Measure("beginning_arr", "beginning_arr"),
                Measure("net_new_arr", "arr_change"),
                Measure("new_logo_arr", "new_logo_arr"),
                Measure("cross_sell_arr", "cross_sell_arr"),
                Measure("upsell_arr", "upsell_arr"),
                Measure("downgrade_arr", "downgrade_arr"),
                Measure("churn_arr", "churn_arr"),
            ),
        ),
        SemanticModel(
            "acv", "fct_acv", "acv_key", time="close_date",
            foreign={"account": "account_id", "product": "product_id", "sales_rep": "owner_id"},
            dimensions={
                **_named("revenue_category", "opportunity_type", "forecast_category"),
                "deal_status": DEAL_STATUS,
            },
            measures=(
                Measure("acv_amount", "acv"),
                Measure("tcv_amount", "cast(tcv as decimal(38,6))"),
                Measure("opportunity_count", "opportunity_id", agg="count_distinct"),
            ),
        ),
        SemanticModel(
            "usage", "fct_usage", "usage_key", time="usage_month",
            foreign={"account": "account_id", "product": "product_id"},
            measures=(
                Measure("consumed_value", "consumed_value"),
                Measure("consumed_units_total", "consumed_units"),
                Measure("entitled_units_total", "entitled_units"),
            ),
        ),
    )
}

METRICS: dict[str, Metric] = {
    m.name: m
    for m in (
        Metric("total_arr", "Total ARR", "ending_arr"),
        Metric("beginning_arr", "Beginning ARR", "beginning_arr"),
        Metric("net_new_arr", "Net New ARR", "net_new_arr"),
        Metric("new_logo_arr", "New Logo ARR", "new_logo_arr"),
        Metric("cross_sell_arr", "Cross-sell ARR", "cross_sell_arr"),
        Metric("upsell_arr", "Upsell ARR", "upsell_arr"),
        Metric("downgrade_arr", "Downgrade ARR", "downgrade_arr"),
        Metric("churned_arr", "Churned ARR", "churn_arr"),
        Metric(
            "expansion_arr", "Expansion ARR",
            expr="upsell_arr + cross_sell_arr", inputs=("upsell_arr", "cross_sell_arr"),
        ),
        Metric(
            "gross_revenue_retention", "Gross Revenue Retention",
            expr="(beginning_arr + downgrade_arr + churned_arr) / nullif(beginning_arr, 0)",
            inputs=("beginning_arr", "downgrade_arr", "churned_arr"),
        ),
        Metric(
            "net_revenue_retention", "Net Revenue Retention",
            expr="(beginning_arr + upsell_arr + cross_sell_arr + downgrade_arr + churned_arr)"
            " / nullif(beginning_arr, 0)",
            inputs=("beginning_arr", "upsell_arr", "cross_sell_arr", "downgrade_arr", "churned_arr"),
        ),
        Metric("bookings_acv", "Bookings ACV", "acv_amount", where="deal_status = 'won'"),
        Metric("pipeline_acv", "Pipeline ACV", "acv_amount", where="deal_status = 'open'"),
        Metric(
            "new_logo_bookings_acv", "New Logo Bookings ACV", "acv_amount",
            where="deal_status = 'won' and revenue_category = 'new_logo'",
        ),
        Metric("won_opportunity_count", "Won Opportunities", "opportunity_count", where="deal_status = 'won'"),
        Metric(
            "average_deal_acv", "Average Deal ACV (ASP)",
            expr="bookings_acv / nullif(won_opportunity_count, 0)",
            inputs=("bookings_acv", "won_opportunity_count"),
        ),
        Metric("total_consumed_value", "Total Consumed Value", "consumed_value"),
        Metric("total_consumed_units", "Total Consumed Units", "consumed_units_total"),
        Metric("total_entitled_units", "Total Entitled Units", "entitled_units_total"),
        Metric(
            "average_utilization", "Average Utilization",
            expr="total_consumed_units / nullif(total_entitled_units, 0)",
            inputs=("total_consumed_units", "total_entitled_units"),
        ),
    )
}

Tables = Mapping[str, DataFrame]
GRAINS = ("day", "month", "quarter", "year")


def _measure_of(metric: Metric) -> tuple[SemanticModel, Measure]:
    for model in MODELS.values():
        for measure in model.measures:
            if measure.name == metric.measure:
                return model, measure
    raise KeyError(metric.measure)


def _base_metrics(names: tuple[str, ...]) -> list[Metric]:
    """The simple metrics a set of metrics is worked out from."""
    found: dict[str, Metric] = {}
    for name in names:
        metric = METRICS[name]
        if metric.measure:
            found[name] = metric
        else:
            found.update({m.name: m for m in _base_metrics(metric.inputs)})
    return list(found.values())


def _aggregate(
    tables: Tables,
    model: SemanticModel,
    metrics: list[Metric],
    by: tuple[str, ...],
    grain: str | None,
    semi_additive: str | None,
    rows: str | None = None,
    named: tuple[str, ...] = (),
) -> DataFrame:
    """All metrics of one model in one pass.

    ``rows`` is a condition on the dimensions ``named``, which the result need not be grouped by.

    Rows are first summed per key of the dimensions in question, so that a key
    with very many rows meets its dimension as a few; filters are conditions
    inside the sums, so metrics with different filters share the pass.
    """
    local = {d: model.dimensions[d] for d in model.dimensions}
    foreign = {}
    sliced = list(dict.fromkeys([*by, *named]))
    for name in sliced:
        if "__" in name and name.split("__")[0] != model.name:
            entity, dimension = name.split("__")
            foreign[name] = (entity, dimension)
    own = [n for n in sliced if n not in foreign]
    source = tables[model.table].withColumns({d: F.expr(e) for d, e in local.items() if d != e})

    measures = {m.name: _measure_of(m)[1] for m in metrics}
    counted = [m for m in metrics if measures[m.name].agg == "count_distinct"]
    last_only = semi_additive == "last" and any(measures[m.name].snapshot for m in metrics)

    def condition(metric: Metric) -> Column:
        return F.expr(metric.where) if metric.where else F.lit(True)

    keys: dict[str, Column] = {n: F.col(n.split("__")[-1]) for n in own}
    if grain:
        keys["metric_time"] = F.date_trunc(grain, model.time).cast("date")
    for entity in {e for e, _ in foreign.values()}:
        keys[f"{entity}_entity"] = F.col(model.foreign[entity])
    extra: dict[str, Column] = {}
    if last_only:
        extra["snapshot_time"] = F.col(model.time)
    for metric in counted:
        extra[f"{metric.name}_value"] = F.when(condition(metric), F.expr(measures[metric.name].expr))

    sums = [
        F.sum(F.when(condition(m), F.expr(measures[m.name].expr))).alias(m.name) for m in metrics if m not in counted
    ]
    partial = source.groupBy(*[c.alias(n) for n, c in {**keys, **extra}.items()]).agg(
        *(sums or [F.count("*").alias("rows")])
    )
    for entity in {e for e, _ in foreign.values()}:
        target = MODELS[entity]
        wanted = [(n, d) for n, (e, d) in foreign.items() if e == entity]
        dimension = tables[target.table].select(
            F.col(target.primary).alias(f"{entity}_entity"), *[F.col(d).alias(n) for n, d in wanted]
        )
        partial = join_hot(partial, dimension, [f"{entity}_entity"])

    if rows is not None:
        partial = partial.filter(rows)
    group = [*by, *(["metric_time"] if grain else [])]
    if last_only and grain:
        latest = partial.groupBy("metric_time").agg(F.max("snapshot_time").alias("latest_time"))
        # One row per period of the calendar.
        partial = partial.join(F.broadcast(latest), "metric_time", "left")
    elif last_only:
        partial = partial.withColumn("latest_time", partial.agg(F.max("snapshot_time")).scalar())

    def final(metric: Metric) -> Column:
        if metric in counted:
            return F.count_distinct(f"{metric.name}_value").cast("double").alias(metric.name)
        value = F.col(metric.name)
        if last_only and measures[metric.name].snapshot:
            value = F.when(F.col("snapshot_time") == F.col("latest_time"), value)
        return F.sum(value).cast("double").alias(metric.name)

    return partial.groupBy(*group).agg(*[final(m) for m in metrics])


def measure_totals(tables: Tables) -> DataFrame:
    """Every measure of every model over its whole fact, as (model, measure, value)."""
    frames = []
    for model in MODELS.values():
        if not model.measures:
            continue
        plain = [Metric(m.name, m.name, m.name) for m in model.measures]
        totals = _aggregate(tables, model, plain, (), None, None)
        pairs = F.array(*[F.struct(F.lit(m.name).alias("measure"), F.col(m.name).alias("value")) for m in plain])
        frames.append(totals.select(F.lit(model.name).alias("model"), F.inline(pairs)))
    return reduce(DataFrame.unionByName, frames)


def _row_dimensions(where: Column | str | None, by: tuple[str, ...], models: Sequence[str]) -> tuple[str, ...]:
    """The dimensions of a condition that the result is not grouped by."""
    if not isinstance(where, str):
        return ()
    said = set(re.findall(r"[A-Za-z_]\w*", re.sub(r"'[^']*'", "", where)))
    known = {f"{m.name}__{d}" for m in MODELS.values() for d in m.dimensions}
    known |= {d for name in models for d in MODELS[name].dimensions}
    found = tuple(sorted((said & known) - set(by)))
    if found and said & set(METRICS):
        raise ValueError("a condition is on rows or on metrics, not on both")
    return found


def metric(
    tables: Tables,
    *names: str,
    by: tuple[str, ...] = (),
    grain: str | None = None,
    where: Column | str | None = None,
    semi_additive: str | None = None,
) -> DataFrame:
    """Metrics by dimensions and time.

    ``by`` names a dimension of the fact (``revenue_category``) or of a joined
    entity (``account__segment``). ``where`` filters the result's groups; if it
    names a dimension that is not in ``by``, it filters the rows instead.
    ``semi_additive="last"`` takes a balance from the last snapshot of each
    period instead of adding up its snapshots.
    """
    if grain is not None and grain not in GRAINS:
        raise ValueError(f"grain must be one of {GRAINS}")
    group = [*by, *(["metric_time"] if grain else [])]
    parts: dict[str, list[Metric]] = {}
    for base in _base_metrics(names):
        parts.setdefault(_measure_of(base)[0].name, []).append(base)
    named = _row_dimensions(where, by, list(parts))
    rows = where if named else None
    if named:
        named = tuple(dict.fromkeys([*named, *[d for d in by if d in where]]))
    frames = [
        _aggregate(tables, MODELS[model], metrics, by, grain, semi_additive, rows, named)
        for model, metrics in parts.items()
    ]
    if len(frames) == 1:
        result = frames[0]
    else:
        stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
        values = [c for c in stacked.columns if c not in group]
        result = stacked.groupBy(*group).agg(*[F.max(c).alias(c) for c in values])
    if where is not None and not named:
        result = result.filter(where)
    columns = [F.col(n) if METRICS[n].measure else F.expr(METRICS[n].expr).alias(n) for n in names]
    return result.select(*group, *columns)


def metric_time_fill(values: DataFrame, spine: DataFrame, spine_column: str, *columns: str) -> DataFrame:
    """One row per spine date, with zero where the metric has none."""
    return spine.withColumnRenamed(spine_column, "metric_time").join(values, "metric_time", "left").select(
        "metric_time", *[F.coalesce(F.col(c), F.lit(0.0)).alias(c) for c in columns]
    )
