"""The paired index, careers, cards and scorecards against brute force."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from ledgerwave.operators import cards, careers, matchup, pairs

SIDE = "fight_id string, fighter_url string, kd_scored long, rounds long"


def test_pairing_counts_every_opponent(spark):
    """A bout with three sides counts twice for each of them, as listing its pairs would."""
    sides = [("b1", "x", 2, 3), ("b1", "y", 1, 3), ("b2", "x", 0, 1), ("b2", "y", 4, 2), ("b2", "z", 1, 1), ("b3", "z", 9, 1)]
    details = spark.createDataFrame(
        [("b1", "x", "y", "fighter2", "KO/TKO")],
        "fight_id string, fighter1_url string, fighter2_url string, winner string, method string",
    )
    names = spark.createDataFrame([("x", "X"), ("y", "Y")], "fighter_url string, fighter string")
    paired = pairs.pair_opponents(spark.createDataFrame(sides, SIDE))
    got = {
        r.fighter_url: (r.fighter, r.fights, r.rounds, r.kd_absorbed, r.ko_losses)
        for r in pairs.chin_index(pairs.loss_flag(paired, details), names).collect()
    }
    listed = [(a, b) for a in sides for b in sides if a[0] == b[0] and a[1] != b[1]]
    for url, name, losses in (("x", "X", 1), ("y", "Y", 0), ("z", "Unknown", 0)):
        mine = [(a, b) for a, b in listed if a[1] == url]
        assert got[url] == (name, len(mine), sum(a[3] for a, _ in mine), sum(b[2] for _, b in mine), losses)


def test_repeated_names_are_numbered_once_each(spark):
    people = spark.createDataFrame([(f"u{i}", "Tony") for i in range(600)] + [("v", "Ann")], "fighter_url string, fighter string")
    got = [r.fighter for r in pairs.disambiguate_names(people).collect()]
    assert sorted(got) == sorted(["Ann", "Tony"] + [f"Tony ({i})" for i in range(2, 601)])


def index(spark, rows):
    return spark.createDataFrame(
        [(f"u{i}", f"n{i}", f, f * 3, k, l, round(k / f, 3), 0.0) for i, (f, k, l) in enumerate(rows)],
        "fighter_url string, fighter string, fights long, rounds long, kd_absorbed long, ko_losses long, "
        "kd_per_fight double, kd_per_round double",
    )


def test_distribution_uses_the_upper_median_and_shows_empty_buckets(spark):
    table = index(spark, [(10, 1, 0), (10, 2, 0), (10, 3, 0), (10, 0, 0), (4, 4, 0)])
    summary = pairs.distribution_summary(table).first()
    assert (summary.total_fighters, summary.mean, summary.median, summary.zero_count) == (4, 0.15, 0.2, 1)
    buckets = {r.bucket: (r["count"], r.percentage) for r in pairs.bucket_histogram(table).collect()}
    assert len(buckets) == 8 and buckets["0.71+"] == (0, 0.0) and buckets["0.01-0.10"] == (1, 25.0)
    empty = pairs.bucket_histogram(table.filter("fights > 99")).collect()
    assert [(r["count"], r.percentage) for r in empty] == [(0, 0.0)] * 8


def test_leaderboards(spark):
    table = index(spark, [(10, 5, 0), (20, 0, 0), (12, 0, 1), (10, 5, 1), (9, 9, 0), (30, 4, 0)])
    assert [r.fighter_url for r in pairs.leaderboard_highest(table, top=2).collect()] == ["u0", "u3"]
    assert [r.fighter_url for r in pairs.leaderboard_zero(table).collect()] == ["u1", "u2"]
    assert [r.fighter_url for r in pairs.leaderboard_survivors(table).collect()] == ["u0", "u5"]


def test_ages_between_ranges_count_nowhere(spark):
    ages = [(f"u{i}", f"b{i}", a) for i, a in enumerate([17.99, 24.999, 24.9995, 25.0, 50.0, 50.1])]
    frame = spark.createDataFrame(ages, "fighter_url string, fight_id string, age_at_fight double")
    paired = frame.selectExpr("fighter_url", "fight_id", "1 as kd_absorbed")
    got = {r.bucket: r.fights for r in pairs.age_curve(frame, paired, min_bouts=1).collect()}
    assert got == {"18-24": 1, "25-27": 1, "40+": 1}


def test_text_values(spark):
    frame = spark.createDataFrame(
        [("155 lbs.", "Jan 05, 1990"), ("--", "--"), (None, None), ("114 lbs.", "Feb 3, 1991")], "weight string, dob string"
    )
    got = frame.select(pairs.weight_class_of("weight"), pairs.birth_date("dob")).collect()
    assert [tuple(r) for r in got] == [
        ("Lightweight", dt.date(1990, 1, 5)), (None, None), (None, None), (None, dt.date(1991, 2, 3))
    ]


# --- careers ------------------------------------------------------------------


def random_bouts(seed=7, fighters=9, n=160):
    rng = random.Random(seed)
    bouts, stats = [], []
    for i in range(n):
        a, b = rng.sample(range(fighters), 2)
        date = dt.date(2020, 1, 1) + dt.timedelta(days=rng.randrange(60))
        bouts.append(
            (f"b{i:03d}", f"f{a}", f"f{b}", f"N{a}", f"N{b}", rng.choice(["fighter1", "fighter2"]),
             rng.choice(careers.DECISIVE_METHODS), rng.randrange(0, 900), date)
        )
        for who in (a, b):
            if rng.random() < 0.9:
                stats.append((f"f{who}", f"b{i:03d}", *[rng.randrange(0, 30) for _ in careers.OWN_SUMS]))
    return bouts, stats


def ratio(a, b):
    return a / b if b > 0 else 0.0


def expected_profile(url, cutoff, bouts, stats):
    mine = sorted((b for b in bouts if url in b[1:3] and b[8] < cutoff), key=lambda b: (b[8], b[0]))
    if len(mine) < 3:
        return None
    by_key = {(s[0], s[1]): dict(zip(careers.OWN_SUMS, s[2:])) for s in stats}
    zero = dict.fromkeys(careers.OWN_SUMS, 0)

    def total(stat, chosen, opponent=False):
        keys = [((b[2] if b[1] == url else b[1]) if opponent else url, b[0]) for b in chosen]
        return sum(by_key.get(k, zero)[stat] for k in keys)

    won = [(b[5] == "fighter1") == (b[1] == url) for b in mine]
    minutes = max(sum(b[7] for b in mine), 1) / 60
    last3, run = mine[-3:], 0
    minutes3 = max(sum(b[7] for b in last3), 1) / 60
    for outcome in reversed(won):
        if outcome != won[-1]:
            break
        run += 1
    landed, n = total("sig_str_landed", mine), len(mine)
    finishes = sum(w and b[6] != "Decision" for w, b in zip(won, mine))
    return {
        "fights": n,
        "sig_spm": landed / minutes,
        "sig_acc": ratio(landed, total("sig_str_attempted", mine)),
        "strike_differential_spm": (landed - total("sig_str_landed", mine, True)) / minutes,
        "td_defense": 1 - ratio(total("takedowns_landed", mine, True), total("takedowns_attempted", mine, True)),
        "ctrl_secs_per_fight": total("ctrl_seconds", mine) / n,
        "ground_pct": ratio(total("sig_ground_landed", mine), landed),
        "finish_rate": finishes / max(sum(won), 1),
        "dec_win_rate": sum(w and b[6] == "Decision" for w, b in zip(won, mine)) / n,
        "recent_win_rate": sum(won[-5:]) / len(won[-5:]),
        "recent_sig_spm": total("sig_str_landed", last3) / minutes3,
        "recent_kd_per_fight": total("knockdowns", last3) / 3,
        "win_streak": float(run if won[-1] else 0),
        "loss_streak": float(0 if won[-1] else run),
        "log_fights": math.log1p(n),
    }


@pytest.fixture(scope="module")
def career(spark):
    bouts, stats = random_bouts()
    bout_frame = spark.createDataFrame(
        bouts,
        "fight_id string, fighter1_url string, fighter2_url string, fighter1_name string, fighter2_name string, "
        "winner string, method string, duration_s int, event_date date",
    )
    stat_frame = spark.createDataFrame(
        stats, "fighter_url string, fight_id string, " + ", ".join(f"{c} long" for c in careers.OWN_SUMS)
    )
    return bouts, stats, bout_frame, careers.bout_sides(bout_frame, stat_frame)


def assert_profiles(rows, bouts, stats):
    for row in rows:
        expected = expected_profile(row.fighter_url, row.event_date, bouts, stats)
        assert expected is not None
        for name, value in expected.items():
            assert row[name] == pytest.approx(value), (row.fighter_url, row.event_date, name)


def test_profiles_see_only_earlier_days(career):
    bouts, stats, _, sides = career
    rows = careers.profiles(careers.career_state(sides)).collect()
    assert_profiles(rows, bouts, stats)
    days = {(u, b[8]) for b in bouts for u in b[1:3]}
    assert len(rows) == sum(expected_profile(u, d, bouts, stats) is not None for u, d in days)
    assert len(days) < 2 * len(bouts)  # some fighter does fight twice in a day


def test_whole_career(career):
    bouts, stats, _, sides = career
    rows = careers.profiles(careers.career_state(sides, "2099-01-01")).collect()
    assert len(rows) == 9
    assert_profiles(rows, bouts, stats)


def test_training_pairs_are_mirrored(career):
    _, _, bouts, sides = career
    rows = careers.training_pairs(bouts, careers.profiles(careers.career_state(sides))).collect()
    by_bout = {}
    for r in rows:
        by_bout.setdefault(r.fight_id, []).append(r)
    assert by_bout and all(len(v) == 2 for v in by_bout.values())
    for one, two in by_bout.values():
        assert one.label + two.label == 1
        assert all(one[f] == -two[f] for f in careers.FEATURES)
        assert one.winner_sig_spm == two.winner_sig_spm


# --- cards and scorecards -------------------------------------------------------


def test_names_resolve_exactly_before_partly(spark):
    names = spark.createDataFrame(
        [("u1", "Ann Lee"), ("u2", "Joann Ray"), ("u3", "Ann Zed")], "fighter_url string, fighter string"
    )
    got = cards.resolve_entity(spark, names, ["ANN ZED", "ann nobody", "Joann x", "Bob y"]).orderBy("request_id")
    assert [r.fighter_url for r in got.collect()] == ["u3", "u1", "u2", None]


def test_card_needs_history_on_both_sides(spark, career):
    _, _, bouts, _ = career
    card = [("N0", "N1"), ("N2", "Nobody"), ("N3", "zzz")]
    rows = cards.select_card(spark, cards.all_names(bouts.withColumnsRenamed({})), bouts, card, n=5).collect()
    assert [r.position for r in rows if r.fighter1 == "N0"] == [0]
    assert all(r.fighter2 != "zzz" for r in rows)


def profile(**values):
    base = dict(
        sig_spm=1.0, sig_str_absorbed_spm=1.0, td_per_fight=1.0, ctrl_secs_per_fight=0.0, kd_per_fight=0.0,
        win_rate=0.5, win_streak=0.0, recent_win_rate=0.5,
    )
    return {**base, **values}


def test_reasoning_lists_three_reasons_at_most(spark):
    winner = profile(sig_spm=3.25, sig_str_absorbed_spm=0.1, td_per_fight=2.0, ctrl_secs_per_fight=125.9, win_streak=4.0)
    schema = "w struct<" + ",".join(f"{k}:double" for k in winner) + ">, l struct<" + ",".join(f"{k}:double" for k in winner) + ">"
    frame = spark.createDataFrame([(tuple(winner.values()), tuple(profile().values())),
                                   (tuple(profile().values()), tuple(profile().values()))], schema)
    texts = [r[0] for r in frame.select(cards.reasoning_text(
        F.col("w"), F.col("l"), F.lit("Ann"), F.lit("Submission"), F.lit(0.625))).collect()]
    assert texts[0] == (
        "Model v2 favors Ann (62% confidence). Ann throws 2.3 more sig strikes/min, absorbs 0.9 fewer strikes/min, "
        "averages 1.0 more TD/fight. On this trajectory, the grappling dominance should force a tap."
    )
    assert texts[1] == (
        "Model v2 favors Ann (62% confidence). On this trajectory, the grappling dominance should force a tap."
    )


@pytest.mark.parametrize("name, ages", [
    ("Heavyweight", (39, 37)), ("Light Heavyweight", (38, 36)), ("Women's Flyweight", (35, 34)),
    ("Women's Featherweight", (35, 34)), ("Flyweight", (34, 33)), (None, (36, 34)), ("Strawweight", (36, 34)),
])
def test_age_thresholds(spark, name, ages):
    frame = spark.createDataFrame([(name,)], "wc string").select(matchup.age_thresholds("wc").alias("a"))
    assert tuple(frame.first().a) == ages


@pytest.mark.parametrize("one, two, expected", [
    ("switch", "switch", (1.02, 0.98)), ("orthodox", "switch", (0.98, 1.02)), ("southpaw", "orthodox", (1.03, 1.0)),
    ("orthodox", "southpaw", (1.0, 1.03)), ("southpaw", "southpaw", (1.0, 1.0)), ("southpaw", "", (1.0, 1.0)),
])
def test_stances(spark, one, two, expected):
    a, b = F.col("a"), F.col("b")
    switch1, switch2 = a == "switch", b == "switch"
    frame = spark.createDataFrame([(one, two)], "a string, b string").select(
        matchup._stance_modifier(a, b, switch1), matchup._stance_modifier(b, a, switch2 & ~switch1)
    )
    assert tuple(frame.first()) == expected


def test_few_fights_are_drawn_to_the_whole(spark):
    own = spark.createDataFrame([("u", "r1", "knockdowns", 2.0, 1.0)], "fighter_url string, bucket string, stat string, mean double, std double")
    overall = spark.createDataFrame([("r1", "knockdowns", 1.0, 0.5)], "bucket string, stat string, mean double, std double")
    fights = spark.createDataFrame([("u", 3)], "fighter_url string, fights long")
    got = {(r.bucket, r.stat): (r.mean, r.std) for r in matchup.shrink_to_global(own, overall, fights).collect()}
    assert len(got) == 39
    assert got[("r1", "knockdowns")] == pytest.approx((1.2, 0.6))
    assert got[("r2", "knockdowns")] == (10.0, 5.0)


def test_decisions(spark):
    def card(fight, *totals):
        return [(fight, 1, f"Judge {j}", a, b) for j, (a, b) in zip("ABC", totals)]

    rows = (
        card("unanimous", (10, 9), (10, 9), (10, 8)) + card("split", (9, 10), (9, 10), (10, 9))
        + card("two", (10, 9), (10, 9), (10, 10)) + card("one each", (10, 8), (9, 10), (10, 10))
        + card("level", (10, 10), (10, 10), (10, 10)) + card("one", (9, 10), (10, 10), (10, 10))
    )
    frame = spark.createDataFrame(rows, "fight_id string, round int, judge string, fighter1 int, fighter2 int")
    got = {r.fight_id: (r.winner, r.method) for r in matchup.decision_outcome(frame).collect()}
    assert got == {
        "unanimous": ("fighter1", "Decision (Unanimous)"), "split": ("fighter2", "Decision (Split)"),
        "two": ("fighter1", "Decision (Split)"), "one each": ("fighter1", "Decision (Split)"),
        "level": ("fighter1", "Decision (Majority)"), "one": ("fighter2", "Decision (Majority)"),
    }


def test_a_blank_request_matches_nobody(spark):
    names = spark.createDataFrame([("u1", "Ann Lee")], "fighter_url string, fighter string")
    for requests in (["ann lee", "  ", ""], ["", " "]):
        found = {r.request_id: r.fighter_url for r in cards.resolve_entity(spark, names, requests).collect()}
        assert found == {i: "u1" if r.strip() else None for i, r in enumerate(requests)}


def test_many_requests_meet_an_index_of_pieces(spark):
    """10,000 requests: the answers of one by one, nothing of them in the plan, a hot word pre-aggregated."""
    people = [(f"u{i:04d}", f"{('Ann', 'Joann', 'Bo', 'Zoë')[i % 4]} {chr(65 + i % 26)}{i}") for i in range(400)]
    names = spark.createDataFrame([*people, ("u9999", None), ("u0000", "Second Name")], "fighter_url string, fighter string")
    wanted = [None, "", "  ", "ZOË b37", "nn x", "joann", "A", "\t bo  x", "x" * 500, "second name", "SECOND"]
    wanted += [f"{people[i % 400][1].upper()}" if i % 3 else f"{('an', 'oan', 'b', 'q')[i % 4]} {i}" for i in range(9_989)]
    requests = spark.createDataFrame(list(enumerate(wanted)), "request_id int, requested string")
    found = cards.resolve_requests(names, requests)
    text = found._jdf.queryExecution().analyzed().toString()
    assert "joann" not in text and len(text) < 60_000
    got = {r["request_id"]: (r["fighter_url"], r["fighter"]) for r in found.collect()}
    assert len(got) == len(wanted)
    known = sorted([*people, ("u0000", "Second Name")])
    memo = {}

    def plain(request):
        words = (request or "").split()
        if not words:
            return None, None
        same = [p for p in known if p[1].lower() == request.lower()]
        part = [p for p in known if words[0].lower() in p[1].lower()]
        return (same or part or [(None, None)])[0]

    for i, request in enumerate(wanted):
        if request not in memo:
            memo[request] = plain(request)
        assert got[i] == memo[request], request


def test_a_days_state_is_merged_from_parts(spark):
    """A fighter with a third of all bouts, hundreds on one day: the state is that of all bouts in their order."""
    rng = random.Random(9)
    rows = []
    for i in range(900):
        who = "hot" if i % 3 == 0 else f"f{i % 40}"
        day = "2001-01-0" + str(1 + (0 if who == "hot" and i < 800 else rng.randrange(5)))
        rows.append((f"b{rng.randrange(10**6):06d}-{i}", day, who, rng.random() < 0.7, 60 + i % 7))
    rows += [(f"c{i:03d}", "2001-02-01", "hot", True, 60) for i in range(30)]  # longer than what is kept of a day
    rows += [("a000", "2001-02-01", "hot", False, 60), ("z", "2001-03-01", "hot", True, 60)]
    frame = spark.createDataFrame(
        [(*r[:2], r[2], r[3], r[4], "Decision", *[1] * len(careers.OWN_SUMS), *[1] * 4) for r in rows],
        "fight_id string, event_date string, fighter_url string, won boolean, duration_s int, method string, "
        + ", ".join(f"{c} int" for c in careers.OWN_SUMS) + ", " + ", ".join(f"opp_{c} int" for c in careers.OPPONENT_SUMS),
    ).withColumn("event_date", F.col("event_date").cast("date")).repartition(6)
    state = careers.career_state(frame)
    got = {(r["fighter_url"], str(r["event_date"])): r for r in state.collect()}
    for who, day in {(r[2], r[1]) for r in rows}:
        before = sorted(((r[1], r[0], r[3]) for r in rows if r[2] == who and r[1] < day), reverse=True)
        row = got[who, day]
        assert row["fights"] == len(before)
        assert [b["fight_id"] for b in row["recent"]] == [b[1] for b in before[:5]]
        wins = next((i for i, b in enumerate(before) if not b[2]), len(before))
        losses = next((i for i, b in enumerate(before) if b[2]), len(before))
        assert (row["fights"] - row["loss_at"], row["fights"] - row["win_at"]) == (wins, losses)


def test_no_window_over_raw_bouts(spark, sample_dir):
    """The only window ordered within a day is limited to five rows before the shuffle."""
    from ledgerwave.plans.bouts import sample_bouts

    plan = sample_bouts(spark, sample_dir).state._jdf.queryExecution().executedPlan().toString()
    ranked = [line for line in plan.splitlines() if "row_number" in line and "WindowGroupLimit" in line]
    assert any("Partial" in line for line in ranked) and any("Final" in line for line in ranked)
    assert sum("row_number" in line and "Window [" in line for line in plan.splitlines()) == 1
