"""Features of a fighter's career strictly before a date.

A career is first summed per day. Everything up to a day is then a running sum
over a fighter's days, of which the calendar allows few however often one
fighter appears, and two bouts on one day cannot see each other. A day's own
state is put together from states that can be merged (sums, the newest five
bouts, the last loss and win, a count), so no task sees all bouts of a day.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerwave.functions.joins import join_hot, join_sides
from ledgerwave.functions.values import clock_seconds, safe_div
from ledgerwave.operators.pairs import bout_dates

MIN_PRIOR_FIGHTS = 3
DECISIVE_METHODS = ("KO/TKO", "Submission", "Decision")

STATS = (
    "knockdowns",
    "sig_str_landed",
    "sig_str_attempted",
    "takedowns_landed",
    "takedowns_attempted",
    "submission_attempts",
    "sig_distance_landed",
    "sig_clinch_landed",
    "sig_ground_landed",
    "sig_head_landed",
    "sig_body_landed",
    "sig_leg_landed",
)
OWN_SUMS = (*STATS, "ctrl_seconds")
OPPONENT_SUMS = ("sig_str_landed", "sig_str_attempted", "takedowns_landed", "takedowns_attempted")

CAREER_FEATURES = (
    "sig_spm", "sig_acc", "sig_str_absorbed_spm", "strike_differential_spm", "td_per_fight", "td_acc",
    "sub_att_per_fight", "kd_per_fight", "ctrl_secs_per_fight", "td_defense", "dist_pct", "clinch_pct",
    "ground_pct", "head_pct", "body_pct", "leg_pct", "win_rate", "finish_rate", "ko_win_rate", "sub_win_rate",
    "dec_win_rate",
)
RECENT_FEATURES = (
    "recent_sig_spm", "recent_sig_acc", "recent_td_per_fight", "recent_kd_per_fight", "recent_ctrl_secs_per_fight",
)
FEATURES = (*CAREER_FEATURES, "recent_win_rate", *RECENT_FEATURES, "win_streak", "loss_streak", "log_fights")
METHOD_FEATURES = (
    "sig_spm", "kd_per_fight", "sub_att_per_fight", "td_per_fight", "ground_pct", "dist_pct", "finish_rate",
    "ctrl_secs_per_fight",
)


def bouts_clean(fight_details: DataFrame, fights: DataFrame, events: DataFrame) -> DataFrame:
    """H1: decisive bouts with their date and duration in seconds."""
    return (
        fight_details.filter(
            F.col("winner").isin("fighter1", "fighter2")
            & F.col("method").isin(*DECISIVE_METHODS)
            & F.col("finish_round").isNotNull()
            & F.col("finish_time").like("%:%")
        )
        .join(bout_dates(fights, events), "fight_id")
        .select(
            "fight_id",
            "fighter1_url",
            "fighter2_url",
            "fighter1_name",
            "fighter2_name",
            "winner",
            "method",
            ((F.col("finish_round") - 1) * 300 + clock_seconds("finish_time")).alias("duration_s"),
            "event_date",
        )
    )


def side_stats(round_stats: DataFrame) -> DataFrame:
    """H2: totals per bout and side over the rounds with a control time."""
    return (
        round_stats.filter(F.col("control_time").like("%:%"))
        .groupBy("fighter_url", "fight_id")
        .agg(*[F.sum(c).alias(c) for c in STATS], F.sum(clock_seconds("control_time")).alias("ctrl_seconds"))
    )


def bout_sides(bouts: DataFrame, stats: DataFrame) -> DataFrame:
    """H3: one row per bout and side with both sides' totals and the outcome."""
    first_won = F.col("winner") == "fighter1"

    def side(own: str, other: str, won: Column) -> Column:
        return F.struct(F.col(own).alias("fighter_url"), F.col(other).alias("opponent_url"), won.alias("won"))

    sides = F.array(
        side("fighter1_url", "fighter2_url", first_won), side("fighter2_url", "fighter1_url", ~first_won)
    )
    bout = Window.partitionBy("fight_id")

    def of_opponent(stat: str) -> Column:
        """The bout's total less one's own; NULL when the opponent has no statistics."""
        own, known = F.col(stat), F.count(stat).over(bout) - F.when(F.col(stat).isNotNull(), 1).otherwise(0)
        return F.when(known > 0, F.sum(stat).over(bout) - F.coalesce(own, F.lit(0)))

    return (
        bouts.select("fight_id", "event_date", "duration_s", "method", F.inline(sides))
        .join(stats, ["fight_id", "fighter_url"], "left")
        .withColumns({f"opp_{c}": of_opponent(c) for c in OPPONENT_SUMS})
    )


DAY = ("fighter_url", "event_date")


def outcomes(bouts: DataFrame) -> DataFrame:
    """One row per bout and side: who fought when, and whether they won."""
    first_won = F.col("winner") == "fighter1"
    sides = F.array(
        F.struct(F.col("fighter1_url").alias("fighter_url"), first_won.alias("won")),
        F.struct(F.col("fighter2_url").alias("fighter_url"), (~first_won).alias("won")),
    )
    return bouts.select("fight_id", "event_date", F.inline(sides))


#: A fighter's day without NULLs: what is summed per day is joined as it lies, where null-safe keys would be shuffled anew.
KEY = (*DAY, "_no_url", "_no_date")
#: A whole career, which needs no days: a fighter's bouts are merged in every task before they are shuffled.
CAREER = ("fighter_url", "_no_url")


def _keyed(frame: DataFrame) -> DataFrame:
    url, date = (F.col(c) for c in DAY)
    return frame.withColumns(
        {
            "_no_url": url.isNull(),
            "_no_date": date.isNull(),
            "fighter_url": F.coalesce(url, F.lit("")),
            "event_date": F.coalesce(date, F.lit("1970-01-01").cast("date")),
        }
    )


def _unkeyed(frame: DataFrame, key: tuple[str, ...]) -> DataFrame:
    missing = {c: no for c, no in zip(DAY, ("_no_url", "_no_date")) if no in key}
    own = {c: F.when(~F.col(no), F.col(c)) for c, no in missing.items()}
    return frame.withColumns(own).drop(*missing.values())


def _place(key: tuple[str, ...]) -> Column:
    """What orders the bouts of a day, or of a career."""
    return F.col("fight_id") if "event_date" in key else F.struct("event_date", "fight_id")


def _final_runs(results: DataFrame, key: tuple[str, ...] = KEY) -> DataFrame:
    """(*key, since_loss, since_win): the bouts after the last loss of a day or career, and after its last win.

    NULL where there is none. One of the two is 0; the other is counted, where there are both, from
    the rows that come after the last of the other kind.
    """
    won, bout = F.col("won"), _place(key)
    lasts = results.groupBy(*key).agg(
        F.max(F.when(~won, bout)).alias("lost"), F.max(F.when(won, bout)).alias("victory")
    )
    mixed = lasts.filter("lost is not null and victory is not null").select(
        *key, F.least("lost", "victory").alias("turn")
    )
    run = (
        join_hot(results.select(*dict.fromkeys([*key, "event_date", "fight_id"])), mixed, key, "inner", ["fight_id"])
        .filter(bout > F.col("turn"))
        .groupBy(*key)
        .agg(F.count("*").alias("run"))
    )
    lost, victory = F.col("lost"), F.col("victory")

    def since(own: Column, other: Column) -> Column:
        return F.when(own.isNotNull(), F.when(other.isNull() | (own > other), 0).otherwise(F.col("run")))

    return lasts.join(run, list(key), "left").select(
        *key, since(lost, victory).alias("since_loss"), since(victory, lost).alias("since_win")
    )


def _newest_bouts(sides: DataFrame, key: tuple[str, ...] = KEY, n: int = 5) -> DataFrame:
    """(*key, latest): the newest ``n`` bouts of a day or career; every task sends ``n`` of them at most."""
    bout = F.struct(
        F.when(~F.col("_no_date"), F.col("event_date")).alias("event_date"), "fight_id", "won", "duration_s",
        "sig_str_landed", "sig_str_attempted", "takedowns_landed", "knockdowns", "ctrl_seconds",
    )
    last_first = Window.partitionBy(*key).orderBy(_place(key).desc())
    return (
        sides.select(*dict.fromkeys([*key, "event_date", "fight_id"]), bout.alias("bout"))
        .withColumn("place", F.row_number().over(last_first))
        .filter(F.col("place") <= n)
        .groupBy(*key)
        .agg(F.collect_list("bout").alias("latest"))
    )


def _merged(sides: DataFrame, results: DataFrame, key: tuple[str, ...]) -> DataFrame:
    """One row per fighter and day, or per fighter: sums, the last five bouts, and how it ended."""
    won = F.col("won")
    sides, results = _keyed(sides), _keyed(results)
    sums = sides.groupBy(*key).agg(
        F.count("*").alias("fights"),
        F.sum("duration_s").alias("duration_s"),
        F.count_if(won).alias("wins"),
        *[
            F.count_if(won & (F.col("method") == m)).alias(n)
            for m, n in zip(DECISIVE_METHODS, ("ko_wins", "sub_wins", "dec_wins"))
        ],
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in OWN_SUMS],
        *[F.coalesce(F.sum(f"opp_{c}"), F.lit(0)).alias(f"opp_{c}") for c in OPPONENT_SUMS],
    )
    every = sums.join(_newest_bouts(sides, key), list(key)).join(_final_runs(results, key), list(key))
    return _unkeyed(every, key)


def career_state(sides: DataFrame, cutoff: str | None = None, results: DataFrame | None = None) -> DataFrame:
    """Running totals, last five bouts and streaks strictly before each of a fighter's bout days.

    With a ``cutoff`` date: one row per fighter, as of that date. ``results`` has the outcomes of
    the same bouts, from ``outcomes`` if it is at hand, which is cheaper than taking them from ``sides``.
    """
    results = sides.select(*DAY, "fight_id", "won") if results is None else results
    summed = (
        "fights", "duration_s", "wins", "ko_wins", "sub_wins", "dec_wins", *OWN_SUMS,
        *[f"opp_{c}" for c in OPPONENT_SUMS],
    )
    if cutoff is not None:
        date = F.lit(cutoff).cast("date")
        sides, results = (frame.filter(F.col("event_date") < date) for frame in (sides, results))
        return _merged(sides, results, CAREER).select(
            "fighter_url",
            date.alias("event_date"),
            *[F.coalesce(c, F.lit(0)).alias(c) for c in summed],
            F.slice(F.sort_array("latest", asc=False), 1, 5).alias("recent"),
            *[
                F.coalesce(F.col("fights") - F.col(since), F.lit(0)).alias(at)
                for since, at in (("since_loss", "loss_at"), ("since_win", "win_at"))
            ],
        )

    days = _merged(sides, results, KEY)
    by_day = Window.partitionBy("fighter_url").orderBy("event_date")
    upto = by_day.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = by_day.rowsBetween(Window.unboundedPreceding, -1)
    recent = F.slice(
        F.sort_array(F.flatten(F.collect_list("latest").over(by_day.rowsBetween(-5, -1))), asc=False), 1, 5
    )
    return (
        days.withColumn("position", F.sum("fights").over(upto))
        # Where the last loss (win) of a day stands in the career, counting bouts.
        .withColumns(
            {
                "loss_at": F.col("position") - F.col("since_loss"),
                "win_at": F.col("position") - F.col("since_win"),
            }
        )
        .select(
            "fighter_url",
            "event_date",
            *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(c) for c in summed],
            recent.alias("recent"),
            F.coalesce(F.max("loss_at").over(before), F.lit(0)).alias("loss_at"),
            F.coalesce(F.max("win_at").over(before), F.lit(0)).alias("win_at"),
        )
    )


def career_features_asof() -> dict[str, Column]:
    """H4: 21 career ratios, and the share of opponents' strikes that landed."""
    c = F.col
    minutes = F.greatest(c("duration_s"), F.lit(1)).cast("double") / 60
    fights, landed, wins = c("fights"), c("sig_str_landed"), c("wins")
    return {
        "sig_spm": landed / minutes,
        "sig_acc": safe_div(landed, c("sig_str_attempted")),
        "sig_str_absorbed_spm": c("opp_sig_str_landed") / minutes,
        "strike_differential_spm": (landed - c("opp_sig_str_landed")) / minutes,
        "td_per_fight": safe_div(c("takedowns_landed"), fights),
        "td_acc": safe_div(c("takedowns_landed"), c("takedowns_attempted")),
        "sub_att_per_fight": safe_div(c("submission_attempts"), fights),
        "kd_per_fight": safe_div(c("knockdowns"), fights),
        "ctrl_secs_per_fight": safe_div(c("ctrl_seconds"), fights),
        "td_defense": 1.0 - safe_div(c("opp_takedowns_landed"), c("opp_takedowns_attempted")),
        "dist_pct": safe_div(c("sig_distance_landed"), landed),
        "clinch_pct": safe_div(c("sig_clinch_landed"), landed),
        "ground_pct": safe_div(c("sig_ground_landed"), landed),
        "head_pct": safe_div(c("sig_head_landed"), landed),
        "body_pct": safe_div(c("sig_body_landed"), landed),
        "leg_pct": safe_div(c("sig_leg_landed"), landed),
        "win_rate": safe_div(wins, fights),
        "finish_rate": safe_div(c("ko_wins") + c("sub_wins"), F.greatest(wins, F.lit(1))),
        "ko_win_rate": safe_div(c("ko_wins"), fights),
        "sub_win_rate": safe_div(c("sub_wins"), fights),
        "dec_win_rate": safe_div(c("dec_wins"), fights),
        "opp_accuracy_against": safe_div(c("opp_sig_str_landed"), c("opp_sig_str_attempted")),
    }


def _total(bouts: Column, field: str) -> Column:
    return F.aggregate(
        bouts, F.lit(0).cast("bigint"), lambda total, b: total + F.coalesce(b[field].cast("bigint"), F.lit(0))
    )


def recent5_win_rate() -> Column:
    """H5: share of the last five bouts won, or of all when there are fewer."""
    wins = F.size(F.filter("recent", lambda b: b["won"]))
    return wins.cast("double") / F.nullif(F.size("recent"), F.lit(0)).cast("double")


def recent3_features() -> dict[str, Column]:
    """H6: five rates over the last three bouts."""
    last = F.slice("recent", 1, 3)
    minutes = F.greatest(_total(last, "duration_s"), F.lit(1)).cast("double") / 60
    landed, count = _total(last, "sig_str_landed"), F.size(last)
    return {
        "recent_sig_spm": landed / minutes,
        "recent_sig_acc": safe_div(landed, _total(last, "sig_str_attempted")),
        "recent_td_per_fight": safe_div(_total(last, "takedowns_landed"), count),
        "recent_kd_per_fight": safe_div(_total(last, "knockdowns"), count),
        "recent_ctrl_secs_per_fight": safe_div(_total(last, "ctrl_seconds"), count),
    }


def streaks() -> dict[str, Column]:
    """H7: bouts since the last loss, and since the last win."""
    return {
        "win_streak": (F.col("fights") - F.col("loss_at")).cast("double"),
        "loss_streak": (F.col("fights") - F.col("win_at")).cast("double"),
    }


def experience() -> Column:
    """H8: log(1 + bouts)."""
    return F.log1p(F.col("fights").cast("double"))


def profiles(state: DataFrame, min_prior: int = MIN_PRIOR_FIGHTS) -> DataFrame:
    """H4-H8: the profile per fighter and date, where enough bouts came before."""
    columns = {
        **career_features_asof(),
        "recent_win_rate": recent5_win_rate(),
        **recent3_features(),
        **streaks(),
        "log_fights": experience(),
    }
    return state.filter(F.col("fights") >= min_prior).select(
        "fighter_url", "event_date", "fights", *[column.alias(name) for name, column in columns.items()]
    )


def training_pairs(bouts: DataFrame, profile: DataFrame) -> DataFrame:
    """Feature differences per bout with the winner as label, each bout also mirrored.

    ``winner_*`` holds the winner's own features for the method model.
    """
    known = bouts.select("fight_id", "event_date", "fighter1_url", "fighter2_url", "winner", "method")
    first_won = F.col("winner") == "fighter1"
    winner = F.when(first_won, F.col("p1")).otherwise(F.col("p2"))
    return (
        join_sides(
            known,
            profile.select("fighter_url", "event_date", "fights", *FEATURES),
            [["fighter1_url", "event_date"], ["fighter2_url", "event_date"]],
            ["fighter_url", "event_date"],
            "p",
        )
        .withColumn("mirrored", F.explode(F.array(F.lit(False), F.lit(True))))
        .select(
            "fight_id",
            "event_date",
            "mirrored",
            *[
                F.when(F.col("mirrored"), F.col(f"p2.{f}") - F.col(f"p1.{f}"))
                .otherwise(F.col(f"p1.{f}") - F.col(f"p2.{f}"))
                .alias(f)
                for f in FEATURES
            ],
            F.when(first_won != F.col("mirrored"), 1).otherwise(0).alias("label"),
            "method",
            (F.least("p1.fights", "p2.fights").cast("double") / 10).alias("weight"),
            *[winner[f].alias(f"winner_{f}") for f in METHOD_FEATURES],
        )
    )
