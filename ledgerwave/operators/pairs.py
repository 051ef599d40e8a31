"""An opponent-paired index, its distribution and its leaderboards.

What a side absorbs is what the rest of its bout scored: the bout's total less
its own. So opponents are paired by one aggregation per bout and not by
listing pairs, and a bout with several opponents is counted the same way.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerwave.functions.values import first_number

LEADERBOARD_MIN_FIGHTS = 10
DISTRIBUTION_MIN_FIGHTS = 5

# Half-open ranges of events absorbed per fight.
RATE_BUCKETS = [
    ("0.00", 0.0, 0.001),
    ("0.01-0.10", 0.001, 0.1001),
    ("0.11-0.20", 0.1001, 0.2001),
    ("0.21-0.30", 0.2001, 0.3001),
    ("0.31-0.40", 0.3001, 0.4001),
    ("0.41-0.50", 0.4001, 0.5001),
    ("0.51-0.70", 0.5001, 0.7001),
    ("0.71+", 0.7001, 100.0),
]

# Weight classes by pounds, both ends included.
WEIGHT_CLASSES = [
    (115, 124, "Strawweight"),
    (125, 134, "Flyweight"),
    (135, 144, "Bantamweight"),
    (145, 154, "Featherweight"),
    (155, 169, "Lightweight"),
    (170, 184, "Welterweight"),
    (185, 204, "Middleweight"),
    (205, 224, "Light Heavyweight"),
    (225, 999, "Heavyweight"),
]

# Age ranges in years, both ends included; ages in the gaps count nowhere.
AGE_BUCKETS = [
    ("18-24", 18, 24.999),
    ("25-27", 25, 27.999),
    ("28-30", 28, 30.999),
    ("31-33", 31, 33.999),
    ("34-36", 34, 36.999),
    ("37-39", 37, 39.999),
    ("40+", 40, 100),
]


def entity_names(fight_details: DataFrame) -> DataFrame:
    """G1: one name per fighter, the greatest where sources disagree."""
    sides = F.array(
        F.struct(F.col("fighter1_url").alias("fighter_url"), F.col("fighter1_name").alias("fighter")),
        F.struct(F.col("fighter2_url").alias("fighter_url"), F.col("fighter2_name").alias("fighter")),
    )
    return (
        fight_details.select(F.inline(sides))
        .filter((F.col("fighter_url") != "") & (F.col("fighter") != ""))
        .groupBy("fighter_url")
        .agg(F.max("fighter").alias("fighter"))
    )


def per_side_totals(round_stats: DataFrame) -> DataFrame:
    """Events scored and rounds per bout and side."""
    return round_stats.groupBy("fight_id", "fighter_url").agg(
        F.sum("knockdowns").alias("kd_scored"), F.count("*").alias("rounds")
    )


def pair_opponents(totals: DataFrame) -> DataFrame:
    """What each side absorbed from its opponents, and how many it had."""
    bout = Window.partitionBy("fight_id")
    scored = F.coalesce(F.col("kd_scored"), F.lit(0))
    return (
        totals.filter(F.col("fight_id").isNotNull() & F.col("fighter_url").isNotNull())
        .select(
            "fighter_url",
            "fight_id",
            (F.sum(scored).over(bout) - scored).alias("kd_absorbed"),
            F.col("rounds").alias("rounds_fought"),
            (F.count("*").over(bout) - 1).alias("opponents"),
        )
        .filter(F.col("opponents") > 0)
    )


def loss_flag(paired: DataFrame, fight_details: DataFrame, method: str = "KO/TKO") -> DataFrame:
    """Whether each side lost its bout by the given method."""
    outcome = fight_details.filter(F.col("winner").isNotNull()).select(
        "fight_id", "fighter1_url", "fighter2_url", "winner", "method"
    )
    side = F.col("fighter_url")
    lost = ((F.col("winner") == "fighter1") & (F.col("fighter2_url") == side)) | (
        (F.col("winner") == "fighter2") & (F.col("fighter1_url") == side)
    )
    return paired.join(outcome, "fight_id", "left").select(
        "fighter_url",
        "fight_id",
        "kd_absorbed",
        "rounds_fought",
        "opponents",
        F.when((F.col("method") == method) & lost, 1).otherwise(0).alias("lost_by_ko"),
    )


def chin_index(flagged: DataFrame, names: DataFrame) -> DataFrame:
    """Per fighter, events absorbed per fight and per round, and losses by the method."""
    opponents = F.col("opponents")
    totals = flagged.filter(F.col("fighter_url") != "").groupBy("fighter_url").agg(
        F.sum(opponents).alias("fights"),
        F.sum(F.col("rounds_fought") * opponents).alias("rounds"),
        F.sum("kd_absorbed").alias("kd_absorbed"),
        F.sum(F.col("lost_by_ko") * opponents).alias("ko_losses"),
    )
    absorbed, rounds = F.col("kd_absorbed"), F.col("rounds")
    return totals.join(names, "fighter_url", "left").select(
        "fighter_url",
        F.coalesce("fighter", F.lit("Unknown")).alias("fighter"),
        "fights",
        "rounds",
        "kd_absorbed",
        "ko_losses",
        F.round(absorbed / F.col("fights"), 3).alias("kd_per_fight"),
        F.when(rounds > 0, F.round(absorbed / F.nullif(rounds, F.lit(0)), 4)).otherwise(0.0).alias("kd_per_round"),
    )


def disambiguate_names(entities: DataFrame, name: str = "fighter", key: str = "fighter_url") -> DataFrame:
    """The second and later holders of a name get `` (n)``.

    Holders are numbered in the order of a hash of their key. Its leading digits
    cut any one name into equal, ordered slices, so a name very many share is
    numbered slice by slice rather than in one task.
    """
    sliced = entities.withColumn("rank_hash", F.md5(key)).withColumn("slice", F.substring("rank_hash", 1, 2))
    earlier = Window.partitionBy(name).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        sliced.groupBy(name, "slice")
        .agg(F.count("*").alias("holders"))
        .select(name, "slice", F.coalesce(F.sum("holders").over(earlier), F.lit(0)).alias("offset"))
    )
    place = F.row_number().over(Window.partitionBy(name, "slice").orderBy("rank_hash", key)) + F.col("offset")
    return (
        sliced.join(offsets, [name, "slice"])
        .withColumn("place", place)
        .withColumn(
            name,
            F.when(F.col("place") == 1, F.col(name)).otherwise(
                F.concat(F.col(name), F.lit(" ("), F.col("place").cast("string"), F.lit(")"))
            ),
        )
        .select(*entities.columns)
    )


def label_half_open(value: Column, buckets: list[tuple[str, float, float]]) -> Column:
    label = F.lit(None).cast("string")
    for name, low, high in reversed(buckets):
        label = F.when((value >= low) & (value < high), name).otherwise(label)
    return label


def bucket_histogram(
    index: DataFrame, min_fights: int = DISTRIBUTION_MIN_FIGHTS, value: str = "kd_per_fight"
) -> DataFrame:
    """Fighters per bucket of the rate, empty buckets included."""
    counts = index.filter(F.col("fights") >= min_fights).agg(
        F.count("*").alias("total"),
        *[F.count_if((F.col(value) >= low) & (F.col(value) < high)).alias(name) for name, low, high in RATE_BUCKETS],
    )
    rows = F.array(
        *[
            F.struct(F.lit(i).alias("position"), F.lit(name).alias("bucket"), F.col(f"`{name}`").alias("count"))
            for i, (name, _, _) in enumerate(RATE_BUCKETS, 1)
        ]
    )
    share = F.round(F.col("count") / F.nullif(F.col("total"), F.lit(0)) * 100, 1)
    return counts.select("total", F.inline(rows)).select(
        "position", "bucket", "count", F.coalesce(share, F.lit(0.0)).alias("percentage")
    )


def distribution_summary(
    index: DataFrame, min_fights: int = DISTRIBUTION_MIN_FIGHTS, value: str = "kd_per_fight"
) -> DataFrame:
    """Size, mean, upper median and share of zeros of the rate.

    The rate has three decimals, so the exact median keeps a short list of
    distinct values however many fighters there are.
    """
    exact = F.col(value).cast("decimal(18,3)")
    zero = F.count_if((F.col(value) >= RATE_BUCKETS[0][1]) & (F.col(value) < RATE_BUCKETS[0][2]))
    total = F.nullif(F.count("*"), F.lit(0))
    return index.filter(F.col("fights") >= min_fights).agg(
        F.count("*").alias("total_fighters"),
        F.coalesce(F.round(F.sum(exact).cast("double") / total, 3), F.lit(0.0)).alias("mean"),
        F.coalesce(F.expr(f"percentile_disc(0.5) within group (order by {value} desc)"), F.lit(0.0)).alias("median"),
        zero.alias("zero_count"),
        F.coalesce(F.round(zero / total * 100, 1), F.lit(0.0)).alias("zero_pct"),
    )


def leaderboard_highest(index: DataFrame, min_fights: int = LEADERBOARD_MIN_FIGHTS, top: int = 15) -> DataFrame:
    """Most absorbed per fight."""
    return (
        index.filter(F.col("fights") >= min_fights)
        .orderBy(F.desc("kd_per_fight"), F.desc("kd_absorbed"), "fighter_url")
        .limit(top)
    )


def leaderboard_zero(
    index: DataFrame, min_fights: int = LEADERBOARD_MIN_FIGHTS, top: int = 15, max_per_fight: float = 0.0
) -> DataFrame:
    """Most fights with nothing absorbed, or no more than ``max_per_fight``."""
    return (
        index.filter((F.col("fights") >= min_fights) & (F.col("kd_absorbed") <= F.col("fights") * max_per_fight))
        .orderBy(F.desc("fights"), "fighter_url")
        .limit(top)
    )


def leaderboard_survivors(
    index: DataFrame,
    min_fights: int = LEADERBOARD_MIN_FIGHTS,
    top: int = 20,
    min_absorbed: int = 3,
    max_losses: int = 0,
) -> DataFrame:
    """Most absorbed without a loss by the method."""
    return (
        index.filter(
            (F.col("fights") >= min_fights)
            & (F.col("kd_absorbed") >= min_absorbed)
            & (F.col("ko_losses") <= max_losses)
        )
        .orderBy(F.desc("kd_absorbed"), F.desc("kd_per_fight"), "fighter_url")
        .limit(top)
    )


def weight_class_of(weight: Column | str) -> Column:
    """Weight class of a text such as ``155 lbs.``."""
    pounds = first_number(weight)
    label = F.lit(None).cast("string")
    for low, high, name in WEIGHT_CLASSES:
        label = F.when(pounds.between(low, high), name).otherwise(label)
    return label


def class_position(division: Column | str) -> Column:
    names = F.array(*[F.lit(name) for _, _, name in WEIGHT_CLASSES])
    return F.array_position(names, F.col(division) if isinstance(division, str) else division)


def class_breakdown(
    index: DataFrame, fighters: DataFrame, min_fights: int = DISTRIBUTION_MIN_FIGHTS
) -> DataFrame:
    """The index per weight class, lightest first."""
    divisions = fighters.select("fighter_url", weight_class_of("weight").alias("division")).filter(
        F.col("division").isNotNull()
    )
    fights, rounds = F.col("fights"), F.nullif(F.col("rounds"), F.lit(0))
    return (
        index.filter(F.col("fights") >= min_fights)
        .join(divisions, "fighter_url")
        .groupBy("division")
        .agg(
            F.count("*").alias("fighters"),
            *[F.sum(c).alias(c) for c in ("kd_absorbed", "fights", "rounds", "ko_losses")],
        )
        .filter("fights > 0")
        .orderBy(class_position("division"))
        .select(
            "division",
            "fighters",
            "kd_absorbed",
            "fights",
            "rounds",
            F.round(F.col("kd_absorbed") / fights, 3).alias("kd_per_fight"),
            F.coalesce(F.round(F.col("kd_absorbed") / rounds, 4), F.lit(0.0)).alias("kd_per_round"),
            F.round(F.col("ko_losses") / fights * 100, 1).alias("ko_loss_pct"),
        )
    )


def birth_date(dob: Column | str) -> Column:
    """Date of a text such as ``Jan 05, 1990``; NULL for ``--`` and anything else."""
    return F.try_to_timestamp(dob, F.lit("MMM d, yyyy")).cast("date")


def bout_dates(fights: DataFrame, events: DataFrame) -> DataFrame:
    return (
        fights.join(events, "event_id")
        .filter(F.col("event_date").isNotNull())
        .select("fight_id", "event_date")
    )


def age_at_event(totals: DataFrame, fights: DataFrame, events: DataFrame, fighters: DataFrame) -> DataFrame:
    """Age in years of each side on the day of its bout."""
    born = fighters.select("fighter_url", birth_date("dob").alias("born")).filter(F.col("born").isNotNull())
    return (
        totals.select("fight_id", "fighter_url")
        .join(bout_dates(fights, events), "fight_id")
        .join(born, "fighter_url")
        .select(
            "fighter_url",
            "fight_id",
            (F.datediff("event_date", "born") / F.lit(365.25).cast("double")).alias("age_at_fight"),
        )
    )


def age_curve(ages: DataFrame, paired: DataFrame, min_bouts: int = 50) -> DataFrame:
    """Absorbed per fight by age range; ranges with few bouts are left out."""
    age = F.col("age_at_fight")
    label = F.lit(None).cast("string")
    for name, low, high in AGE_BUCKETS:
        label = F.when(age.between(low, high), name).otherwise(label)
    return (
        ages.filter(age.between(18, 50))
        .join(paired.select("fighter_url", "fight_id", "kd_absorbed"), ["fighter_url", "fight_id"])
        .groupBy(label.alias("bucket"))
        .agg(F.count("*").alias("fights"), F.sum("kd_absorbed").alias("kd_absorbed"))
        .filter(F.col("bucket").isNotNull() & (F.col("fights") >= min_bouts))
        .withColumn("kd_per_fight", F.round(F.col("kd_absorbed") / F.col("fights"), 3))
        .orderBy("bucket")
    )


def scatter(index: DataFrame, min_fights: int = LEADERBOARD_MIN_FIGHTS) -> DataFrame:
    """Absorbed rate against share of losses, per fighter."""
    return index.filter(F.col("fights") >= min_fights).select(
        "fighter_url",
        "fighter",
        "fights",
        "kd_absorbed",
        "kd_per_fight",
        "ko_losses",
        F.round(F.col("ko_losses") / F.col("fights") * 100, 1).alias("ko_loss_pct"),
    )


def scatter_corr(points: DataFrame) -> DataFrame:
    """Pearson correlation of the scatter, for more than two points."""
    return points.agg(
        F.count("*").alias("fighters"),
        F.when(F.count("*") > 2, F.round(F.corr("kd_per_fight", "ko_loss_pct"), 3)).alias("pearson_r"),
    )


def recent_vs_career_watchlist(
    paired: DataFrame,
    fights: DataFrame,
    events: DataFrame,
    index: DataFrame,
    active_since: int = 2024,
    min_rate: float = 0.6,
    recent: int = 5,
    min_recent: int = 3,
    top: int = 12,
) -> DataFrame:
    """Fighters still active whose last few bouts went worse than ``min_rate``.

    Everything it needs is in the latest ``recent`` bouts, a limit that Spark
    applies before the shuffle too.
    """
    latest = Window.partitionBy("fighter_url").orderBy(F.desc("event_date"), F.desc("fight_id"))
    rate = F.col("recent_kd") / F.col("recent_fights")
    career = index.select("fighter_url", "fighter", "kd_per_fight", "fights", "ko_losses")
    return (
        paired.join(bout_dates(fights, events), "fight_id")
        .select("fighter_url", "fight_id", "event_date", "kd_absorbed")
        .withColumn("rn", F.row_number().over(latest))
        .filter(F.col("rn") <= recent)
        .groupBy("fighter_url")
        .agg(
            F.max("event_date").alias("last_fight"),
            F.sum("kd_absorbed").alias("recent_kd"),
            F.count("*").alias("recent_fights"),
        )
        .filter(
            (F.col("recent_fights") >= min_recent) & (F.year("last_fight") >= active_since) & (rate >= min_rate)
        )
        .join(career, "fighter_url")
        .select(
            "fighter_url",
            "fighter",
            F.col("last_fight").cast("string").alias("last_fight"),
            "recent_kd",
            "recent_fights",
            F.round(rate, 2).alias("recent_kd_per_fight"),
            F.col("kd_per_fight").alias("career_kd_per_fight"),
            F.col("fights").alias("career_fights"),
            F.col("ko_losses").alias("career_ko_losses"),
        )
        .orderBy(F.desc("recent_kd_per_fight"), "fighter_url")
        .limit(top)
    )
