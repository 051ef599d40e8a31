"""Finding the fighters of a card, choosing its bouts, and explaining a pick."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerwave.functions.joins import join_hot
from ledgerwave.operators.careers import MIN_PRIOR_FIGHTS


def all_names(fight_details: DataFrame) -> DataFrame:
    """Every name a fighter has appeared under."""
    sides = F.array(
        F.struct(F.col("fighter1_url").alias("fighter_url"), F.col("fighter1_name").alias("fighter")),
        F.struct(F.col("fighter2_url").alias("fighter_url"), F.col("fighter2_name").alias("fighter")),
    )
    return fight_details.select(F.inline(sides)).filter("fighter is not null").distinct()


def resolve_requests(names: DataFrame, requests: DataFrame) -> DataFrame:
    """H16 for a table of requests (request_id, requested): same name in any case, else one containing its first word.

    Ties go to the least fighter key; a blank or missing request matches nobody. Every name is cut into its pieces of
    the lengths that first words have, and those that are a first word go to it with the least fighter of their task;
    so a word that a third of all names contain gathers a row per task, and requests meet one row per word.
    """
    word = F.lower(F.regexp_extract("requested", r"(?U)\S+", 0))
    asked = requests.select("request_id", "requested", F.lower("requested").alias("_asked"), word.alias("_word"))
    fit = asked.filter("_word <> ''")
    lowered, fighter = F.lower("fighter").alias("_name"), F.struct("fighter_url", "fighter").alias("_fighter")
    known = names.filter("fighter is not null").select(lowered, fighter)
    exact = known.join(fit.select(F.col("_asked").alias("_name")).distinct(), "_name", "left_semi")
    exact = exact.groupBy(F.col("_name").alias("_asked")).agg(F.min("_fighter").alias("_exact"))

    longest = known.agg(F.max(F.length("_name"))).first()[0] or 0
    words = fit.select("_word").distinct()
    sizes = words.select(F.length("_word").alias("n")).distinct().filter(F.col("n") <= longest).collect()
    lengths = F.array(*[F.lit(r["n"]) for r in sizes]).cast("array<int>")  # none longer than a name
    name, end = F.col("_name"), F.length("_name")

    def cut(n: Column) -> Column:
        starts = F.when(n <= end, F.sequence(F.lit(1), end - n + 1)).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.substring(name, i, n))

    pieces = known.select("_fighter", F.explode(F.array_distinct(F.flatten(F.transform(lengths, cut)))).alias("_word"))
    partial = pieces.join(words, "_word", "left_semi").groupBy("_word").agg(F.min("_fighter").alias("_partial"))
    found = join_hot(join_hot(asked, exact, ["_asked"], spread=["request_id"]), partial, ["_word"], spread=["request_id"])
    best = F.coalesce("_exact", "_partial")
    return found.select(
        "request_id", "requested", best["fighter_url"].alias("fighter_url"), best["fighter"].alias("fighter")
    )


def resolve_entity(spark: SparkSession, names: DataFrame, requests: Sequence[str]) -> DataFrame:
    """The fighter of each requested name, for a list typed in by the caller."""
    return resolve_requests(names, spark.createDataFrame(list(enumerate(requests)), "request_id int, requested string"))


def fight_counts(bouts: DataFrame) -> DataFrame:
    return (
        bouts.select(F.explode(F.array("fighter1_url", "fighter2_url")).alias("fighter_url"))
        .groupBy("fighter_url")
        .agg(F.count("*").alias("fights"))
    )


def select_card(
    spark: SparkSession,
    names: DataFrame,
    bouts: DataFrame,
    card: Sequence[tuple[str, str]],
    n: int = 3,
    min_prior: int = MIN_PRIOR_FIGHTS,
) -> DataFrame:
    """The ``n`` bouts of a card whose fighters have the most history."""
    resolved = resolve_entity(spark, names, [name for bout in card for name in bout])
    counted = resolved.join(fight_counts(bouts), "fighter_url", "left").select(
        F.floor(F.col("request_id") / 2).alias("position"),
        (F.col("request_id") % 2 == 0).alias("first"),
        "fighter_url",
        F.coalesce("fighter", "requested").alias("fighter"),
        F.coalesce("fights", F.lit(0)).alias("fights"),
    )

    def side(first: bool, n: int) -> list[Column]:
        mine = F.col("first") == first
        return [
            F.max(F.when(mine, F.col("fighter"))).alias(f"fighter{n}"),
            F.max(F.when(mine, F.col("fighter_url"))).alias(f"fighter{n}_url"),
            F.max(F.when(mine, F.col("fights"))).alias(f"f{n}_count"),
        ]

    return (
        counted.groupBy("position")
        .agg(*side(True, 1), *side(False, 2))
        .withColumn("combined", F.col("f1_count") + F.col("f2_count"))
        .filter((F.col("f1_count") >= min_prior) & (F.col("f2_count") >= min_prior))
        .orderBy(F.desc("combined"), "position")
        .limit(n)
    )


def confidence(probability: Column) -> Column:
    return F.when(probability >= 0.68, "High").when(probability >= 0.57, "Medium").otherwise("Low")


def _fixed(value: Column, digits: int) -> Column:
    return value.cast(f"decimal(18,{digits})").cast("string")


# Closing words per method.
METHOD_TEXT = {
    "KO/TKO": "the striking advantage should produce a finish",
    "Submission": "the grappling dominance should force a tap",
    "Decision": "the output and control edge should carry the scorecards",
}
OTHER_METHOD_TEXT = "the overall edge should prove decisive"


def reasoning_text(
    winner: Column, loser: Column, winner_name: Column, method: Column, probability: Column
) -> Column:
    """Up to three of eight reasons for a pick; ``winner`` and ``loser`` are profile structs."""

    def edge(field: str) -> Column:
        return winner[field] - loser[field]

    control = F.floor(edge("ctrl_secs_per_fight")).cast("int")
    clock = F.concat(
        F.floor(control / 60).cast("string"), F.lit(":"), F.lpad((control % 60).cast("string"), 2, "0")
    )
    streak = winner["win_streak"]
    reasons = [
        (edge("sig_spm") > 1.0, "throws ", _fixed(edge("sig_spm"), 1), " more sig strikes/min"),
        (
            winner["sig_str_absorbed_spm"] < loser["sig_str_absorbed_spm"] - 0.8,
            "absorbs ", _fixed(loser["sig_str_absorbed_spm"] - winner["sig_str_absorbed_spm"], 1),
            " fewer strikes/min",
        ),
        (edge("td_per_fight") > 0.8, "averages ", _fixed(edge("td_per_fight"), 1), " more TD/fight"),
        (edge("ctrl_secs_per_fight") > 45, "controls ", clock, " more per fight"),
        (edge("kd_per_fight") > 0.10, "lands ", _fixed(edge("kd_per_fight"), 2), " more KD/fight"),
        (edge("win_rate") > 0.10, "holds a ", _fixed(edge("win_rate") * 100, 0), "pp win rate edge"),
        (
            (streak > loser["win_streak"]) & (streak >= 3),
            "riding a ", streak.cast("int").cast("string"), "-fight win streak",
        ),
        (
            edge("recent_win_rate") > 0.20,
            "recent form: ",
            F.concat(
                _fixed(winner["recent_win_rate"] * 100, 0), F.lit("% vs "), _fixed(loser["recent_win_rate"] * 100, 0)
            ),
            "% in last 5",
        ),
    ]
    points = F.array_compact(
        F.array(*[F.when(test, F.concat(F.lit(before), value, F.lit(after))) for test, before, value, after in reasons])
    )
    closing = F.lit(OTHER_METHOD_TEXT)
    for name, text in METHOD_TEXT.items():
        closing = F.when(method == name, text).otherwise(closing)
    percent = F.rint(probability * 100).cast("int").cast("string")
    return F.concat(
        F.lit("Model v2 favors "), winner_name, F.lit(" ("), percent, F.lit("% confidence). "),
        F.when(
            F.size(points) > 0,
            F.concat(winner_name, F.lit(" "), F.concat_ws(", ", F.slice(points, 1, 3)), F.lit(". ")),
        ).otherwise(""),
        F.lit("On this trajectory, "), closing, F.lit("."),
    )
