"""Round distributions, match-up modifiers and scorecards as table operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerwave.functions.joins import join_sides
from ledgerwave.functions.values import clamp, clock_seconds, safe_div
from ledgerwave.operators.careers import STATS
from ledgerwave.operators.pairs import birth_date, weight_class_of

ROUND_STATS = (*STATS, "ctrl_seconds")
ROUND_BUCKETS = ("r1", "r2", "r3plus")

# Full weight of a fighter's own rounds, and stand-ins where nothing is known.
FULL_WEIGHT_FIGHTS = 15
DEFAULT_MEAN = 10.0
DEFAULT_STD = 5.0
DEFAULT_ABSORBED = 3.55
TYPICAL_OPPONENT_ACCURACY = 0.44

VERSIONS = ("v2", "v2.1", "v2.2", "v2.3")

# Judges and how they weigh striking and grappling.
JUDGES = [("Judge A", 1.0, 1.0), ("Judge B", 1.15, 0.85), ("Judge C", 0.85, 1.15)]


# --- round distributions -------------------------------------------------------


def round_sums(round_stats: DataFrame) -> DataFrame:
    """Count, sum and sum of squares per fighter, round bucket and statistic, in whole numbers."""
    bucket = F.when(F.col("round") == 1, "r1").when(F.col("round") == 2, "r2").otherwise("r3plus")
    timed = round_stats.withColumn("ctrl_seconds", clock_seconds("control_time"))

    def summed(stat: str) -> Column:
        value = F.col(stat).cast("bigint")
        return F.struct(
            F.lit(stat).alias("stat"),
            F.count(value).alias("n"),
            F.sum(value).alias("total"),
            F.sum(value * value).alias("squares"),
        )

    return (
        timed.groupBy("fighter_url", bucket.alias("bucket"))
        .agg(F.array(*[summed(s) for s in ROUND_STATS]).alias("sums"))
        .select("fighter_url", "bucket", F.inline("sums"))
        .filter("n > 0")
    )


def _mean_std(grouped: DataFrame) -> DataFrame:
    n, total, squares = [F.col(c).cast("decimal(19,0)") for c in ("n", "total", "squares")]
    spread = (n * squares - total * total).cast("double")
    return grouped.withColumns(
        {
            "mean": F.col("total").cast("double") / F.col("n").cast("double"),
            "std": F.when(
                F.col("n") > 1,
                F.sqrt(spread / (F.col("n").cast("double") * F.nullif(F.col("n") - 1, F.lit(0)).cast("double"))),
            ).otherwise(0.0),
        }
    ).drop("total", "squares")


def round_distributions(sums: DataFrame) -> DataFrame:
    """Mean and sample deviation per fighter, round bucket and statistic."""
    return _mean_std(sums)


def global_distributions(sums: DataFrame) -> DataFrame:
    """The same over all fighters, from the fighters' sums."""
    return _mean_std(sums.groupBy("bucket", "stat").agg(*[F.sum(c).alias(c) for c in ("n", "total", "squares")]))


def shrink_to_global(distributions: DataFrame, overall: DataFrame, fights: DataFrame) -> DataFrame:
    """Every fighter's distribution, drawn to the overall one the fewer fights there are."""
    every = fights.select(
        "fighter_url",
        "fights",
        F.explode(F.array(*[F.lit(b) for b in ROUND_BUCKETS])).alias("bucket"),
    ).select("*", F.explode(F.array(*[F.lit(s) for s in ROUND_STATS])).alias("stat"))
    own = distributions.select("fighter_url", "bucket", "stat", F.col("mean").alias("own_mean"), F.col("std").alias("own_std"))
    base = overall.select("bucket", "stat", F.col("mean").alias("base_mean"), F.col("std").alias("base_std"))
    weight = F.least(F.col("fights"), F.lit(FULL_WEIGHT_FIGHTS)).cast("double") / FULL_WEIGHT_FIGHTS

    def blend(field: str, default: float) -> Column:
        general = F.coalesce(F.col(f"base_{field}"), F.lit(default))
        return F.coalesce(weight * F.col(f"own_{field}") + (1.0 - weight) * general, general).alias(field)

    return (
        every.join(own, ["fighter_url", "bucket", "stat"], "left")
        .join(F.broadcast(base), ["bucket", "stat"], "left")  # 39 rows
        .select("fighter_url", "bucket", "stat", blend("mean", DEFAULT_MEAN), blend("std", DEFAULT_STD))
    )


# --- match-up modifiers ----------------------------------------------------------

BLENDED = ("sig_spm", "sig_acc", "td_per_fight", "kd_per_fight", "ctrl_secs_per_fight")


def form_blend(version: str = "v2.3") -> dict[str, Column]:
    """Five rates at 60 % career and 40 % recent form; career only before v2.2."""
    if version in ("v2.2", "v2.3"):
        return {f"eff_{c}": F.col(c) * 0.6 + F.col(f"recent_{c}") * 0.4 for c in BLENDED}
    return {f"eff_{c}": F.col(c) for c in BLENDED}


def age_thresholds(weight_class: Column | str) -> Column:
    """Ages from which chin and stamina decline, by the words of a weight class, first match first."""
    name = F.lower(F.coalesce(F.col(weight_class) if isinstance(weight_class, str) else weight_class, F.lit("")))
    women = name.contains("women")

    def ages(chin: int, fatigue: int) -> Column:
        return F.struct(F.lit(chin).alias("chin"), F.lit(fatigue).alias("fatigue"))

    return (
        F.when(name.contains("heavyweight") & ~name.contains("light"), ages(39, 37))
        .when(name.contains("light heavyweight"), ages(38, 36))
        .when(name.contains("middleweight") & ~women, ages(37, 35))
        .when(name.contains("welterweight"), ages(36, 35))
        .when(name.contains("lightweight"), ages(35, 34))
        .when(name.contains("featherweight"), ages(35, 34))
        .when(name.contains("bantamweight") & ~women, ages(34, 33))
        .when(name.contains("flyweight") & ~women, ages(34, 33))
        .when(women, ages(35, 34))
        .otherwise(ages(36, 34))
    )


def corners(profiles: DataFrame, fighters: DataFrame, as_of: str, version: str = "v2.3") -> DataFrame:
    """Profile, blended form, reach, stance, weight class and age of every fighter."""
    reach = F.regexp_extract(F.regexp_replace("reach", '"', ""), r"([\d.]+)", 1).try_cast("double")
    age = F.floor(F.datediff(F.lit(as_of).cast("date"), birth_date("dob")) / F.lit(365.25).cast("double"))
    body = fighters.select(
        "fighter_url",
        reach.alias("reach"),
        F.lower(F.coalesce("stance", F.lit(""))).alias("stance"),
        weight_class_of("weight").alias("weight_class"),
        age.alias("age"),
    )
    return profiles.withColumns(form_blend(version)).join(body, "fighter_url", "left")


def class_finish_rates(bouts: DataFrame, fighters: DataFrame) -> DataFrame:
    """Knockout and submission rates per weight class, and relative to all bouts."""
    classes = fighters.select(
        F.col("fighter_url").alias("fighter1_url"), weight_class_of("weight").alias("weight_class")
    ).filter(F.col("weight_class").isNotNull())
    counts = bouts.join(classes, "fighter1_url").groupBy("weight_class").agg(
        F.count("*").alias("fights"),
        F.count_if(F.col("method") == "KO/TKO").alias("ko"),
        F.count_if(F.col("method") == "Submission").alias("sub"),
    )
    rates = {}
    for kind in ("ko", "sub"):
        overall = counts.agg(safe_div(F.sum(kind), F.sum("fights"))).scalar()
        rates[f"{kind}_rate"] = safe_div(F.col(kind), F.col("fights"))
        rates[f"{kind}_mult"] = safe_div(F.col(kind), F.col("fights")) / F.nullif(overall, F.lit(0.0))
    return counts.withColumns(rates).select(
        "weight_class", "fights", "ko_rate", "sub_rate",
        F.coalesce("ko_mult", F.lit(1.0)).alias("ko_mult"), F.coalesce("sub_mult", F.lit(1.0)).alias("sub_mult"),
    )


def _reach_modifier(ahead: Column) -> Column:
    return (
        F.when(ahead > 3, 1.08).when(ahead > 0, 1.03).when(ahead < -3, 0.95).when(ahead < 0, 0.97).otherwise(1.0)
    )


def _stance_modifier(own: Column, other: Column, switches_first: Column) -> Column:
    """``switches_first``: whether this corner's switch stance is the one that counts."""
    southpaw, other_southpaw = own == "southpaw", other == "southpaw"
    open_stance = (southpaw != other_southpaw) & (own != "") & (other != "")
    return (
        F.when(switches_first, 1.02)
        .when((own == "switch") | (other == "switch"), 0.98)
        .when(open_stance & southpaw, 1.03)
        .otherwise(1.0)
    )


def _skill(corner: Column, version: str) -> Column:
    if version == "v2":
        return corner["win_rate"] * 0.7 + corner["recent_win_rate"] * 0.3
    dominance = clamp(corner["strike_differential_spm"] / 5, -0.3, 0.3)
    return corner["win_rate"] * 0.5 + corner["recent_win_rate"] * 0.2 + dominance * 0.3


def _takedown_boost(own: Column, other: Column, edge: Column) -> Column:
    shots = own["eff_td_per_fight"]
    mismatch = F.when((shots > 1.5) & (other["ground_pct"] < 0.15), clamp(1.0 + (shots - 1.5) * 0.3, 1.0, 2.0)).otherwise(1.0)
    imposing = F.when(edge > 1.1, clamp(edge * 0.8, 1.0, 1.5)).otherwise(1.0)
    return mismatch * imposing * clamp(own["ground_pct"] / 0.15, 0.5, 2.0)


def _takedown_success(own: Column, other: Column) -> Column:
    gap = own["td_acc"] - (1.0 - other["td_defense"])
    return F.when(gap > 0.1, clamp(1.0 + gap * 0.8, 1.0, 1.4)).otherwise(1.0)


def matchup_modifiers(
    card: DataFrame,
    corner: DataFrame,
    multipliers: DataFrame,
    version: str = "v2.3",
    absorbed: float = DEFAULT_ABSORBED,
) -> DataFrame:
    """I4: how each corner of a card changes the other's numbers, one row per bout."""
    if version not in VERSIONS:
        raise ValueError(f"version must be one of {VERSIONS}")
    after_v2, form, defended = version != "v2", version in ("v2.2", "v2.3"), version == "v2.3"
    one, two = F.col("c1"), F.col("c2")
    reach_known = (one["reach"] > 0) & (two["reach"] > 0)
    ahead = F.when(reach_known, one["reach"] - two["reach"]).otherwise(0.0)
    switch1, switch2 = one["stance"] == "switch", two["stance"] == "switch"
    skill1, skill2 = _skill(one, version), _skill(two, version)
    neutral = F.lit(1.0)

    bouts = (
        join_sides(card, corner, [["fighter1_url"], ["fighter2_url"]], ["fighter_url"], "c", card.columns)
        .withColumns({"skill1": skill1, "skill2": skill2})
        .withColumns(
            {
                "edge1": clamp(1 + (F.col("skill1") - F.col("skill2")) * 2.5, 0.6, 1.8),
                "edge2": clamp(1 + (F.col("skill2") - F.col("skill1")) * 2.5, 0.6, 1.8),
                "weight_class": F.coalesce(one["weight_class"], two["weight_class"]),
            }
        )
        # At most one row per weight class.
        .join(F.broadcast(multipliers.select("weight_class", "ko_mult", "sub_mult")), "weight_class", "left")
    )

    def when(active: bool, column: Column) -> Column:
        return column if active else neutral

    def absorb(c: Column) -> Column:
        return when(after_v2, clamp(1.0 + (c["sig_str_absorbed_spm"] - absorbed) * 0.08, 0.7, 1.3))

    def defense(c: Column) -> Column:
        return when(defended, clamp(c["opp_accuracy_against"] / TYPICAL_OPPONENT_ACCURACY, 0.85, 1.15))

    def chin_loss(c: Column) -> Column:
        if not form:
            return F.lit(0.0)
        over = F.coalesce(c["age"], F.lit(30)) - age_thresholds(c["weight_class"])["chin"]
        return F.when(over > 0, F.least(over * 3, F.lit(15)).cast("double")).otherwise(0.0)

    return bouts.select(
        *card.columns,
        _reach_modifier(ahead).alias("f1_reach_mod"),
        _reach_modifier(-ahead).alias("f2_reach_mod"),
        when(form, _stance_modifier(one["stance"], two["stance"], switch1)).alias("f1_stance_mod"),
        when(form, _stance_modifier(two["stance"], one["stance"], switch2 & ~switch1)).alias("f2_stance_mod"),
        F.col("skill1").alias("f1_skill"),
        F.col("skill2").alias("f2_skill"),
        F.col("edge1").alias("f1_edge"),
        F.col("edge2").alias("f2_edge"),
        when(after_v2, F.coalesce("ko_mult", neutral)).alias("ko_mult"),
        when(after_v2, F.coalesce("sub_mult", neutral)).alias("sub_mult"),
        absorb(one).alias("f1_absorb_mod"),
        absorb(two).alias("f2_absorb_mod"),
        defense(one).alias("f1_defense_acc_mod"),
        defense(two).alias("f2_defense_acc_mod"),
        chin_loss(one).alias("f1_threshold_loss"),
        chin_loss(two).alias("f2_threshold_loss"),
        when(after_v2, _takedown_boost(one, two, F.col("edge1"))).alias("f1_td_boost"),
        when(after_v2, _takedown_boost(two, one, F.col("edge2"))).alias("f2_td_boost"),
        when(after_v2, _takedown_success(one, two)).alias("f1_td_success_boost"),
        when(after_v2, _takedown_success(two, one)).alias("f2_td_success_boost"),
    )


# --- scorecards --------------------------------------------------------------------


def round_scorecard(round_stats: DataFrame, bouts: DataFrame, noise: Column | None = None) -> DataFrame:
    """Three judges' 10-9 and 10-8 scores of every round; ``noise`` moves a judge's close rounds."""
    timed = round_stats.withColumn("control", clock_seconds("control_time"))
    scored = {"landed": "sig_str_landed", "kd": "knockdowns", "td": "takedowns_landed", "control": "control"}
    totals = (
        timed.join(bouts.select("fight_id", "fighter1_url", "fighter2_url"), "fight_id")
        .groupBy("fight_id", "round")
        .agg(
            *[
                F.coalesce(F.sum(F.when(F.col("fighter_url") == F.col(f"fighter{n}_url"), F.col(source))), F.lit(0)).alias(
                    f"{name}{n}"
                )
                for n in (1, 2)
                for name, source in scored.items()
            ]
        )
    )
    judges = F.array(
        *[
            F.struct(F.lit(j).alias("judge"), F.lit(s).alias("striking"), F.lit(g).alias("grappling"))
            for j, s, g in JUDGES
        ]
    )

    def score(n: int) -> Column:
        return (
            F.col(f"landed{n}").cast("double") * F.col("striking")
            + F.col(f"kd{n}").cast("double") * 5.0 * F.col("striking")
            + F.col(f"td{n}").cast("double") * 2.0 * F.col("grappling")
            + F.col(f"control{n}").cast("double") * 0.10 * F.col("grappling")
        )

    one, two = F.col("score1"), F.col("score2")
    won = one + (noise if noise is not None else F.lit(0.0)) > two

    def loser_points(winner: Column, loser: Column, knockdowns: str) -> Column:
        margin = (winner - loser) / F.greatest(winner, F.lit(1.0))
        return F.when((margin > 0.4) | (F.col(knockdowns) >= 2), 8).otherwise(9)

    return (
        totals.select("*", F.inline(judges))
        .withColumns({"score1": score(1), "score2": score(2)})
        .select(
            "fight_id",
            "round",
            "judge",
            F.when(won, 10).otherwise(loser_points(two, one, "kd2")).alias("fighter1"),
            F.when(won, loser_points(one, two, "kd1")).otherwise(10).alias("fighter2"),
        )
    )


def decision_outcome(scorecards: DataFrame) -> DataFrame:
    """The winner on the cards, by unanimous, split or majority decision; totals break a tie."""
    cards = scorecards.groupBy("fight_id", "judge").agg(
        F.sum("fighter1").alias("fighter1"), F.sum("fighter2").alias("fighter2")
    )
    bouts = cards.groupBy("fight_id").agg(
        F.sum("fighter1").alias("total1"),
        F.sum("fighter2").alias("total2"),
        F.count_if(F.col("fighter1") > F.col("fighter2")).alias("wins1"),
        F.count_if(F.col("fighter2") > F.col("fighter1")).alias("wins2"),
    )
    wins1, wins2 = F.col("wins1"), F.col("wins2")
    winner = (
        F.when(wins1 >= 2, "fighter1")
        .when(wins2 >= 2, "fighter2")
        .when(F.col("total1") >= F.col("total2"), "fighter1")
        .otherwise("fighter2")
    )
    method = (
        F.when((wins1 == 3) | (wins2 == 3), "Decision (Unanimous)")
        .when((wins1 == 2) | (wins2 == 2) | ((wins1 == 1) & (wins2 == 1)), "Decision (Split)")
        .otherwise("Decision (Majority)")
    )
    return bouts.select(
        "fight_id", winner.alias("winner"), method.alias("method"), "total1", "total2", "wins1", "wins2"
    )
