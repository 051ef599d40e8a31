"""SQL blocks for the bout tables, the paired index, careers and match-ups."""

BLOCKS: dict[str, str] = {}

CLOCK = "{0} // 60 || ':' || lpad(cast({0} % 60 AS varchar), 2, '0')"

BLOCKS["roster"] = """
  SELECT s_suppkey, 'f/' || s_suppkey AS fighter_url,
         ['Ana', 'Bo', 'Cy', 'Di', 'Ed', 'Flo', 'Gus'][s_suppkey % 7 + 1] || ' ' || s_nationkey AS fighter_name
  FROM supplier"""

BLOCKS["bt_fighters"] = """
  SELECT fighter_url, fighter_name, (s_suppkey % 120 + 115) || ' lbs.' AS weight,
         CASE WHEN s_suppkey % 10 = 9 THEN '--'
              ELSE strftime(date '1978-01-01' - cast(s_suppkey * 97 % 8000 AS integer), '%b %d, %Y') END AS dob,
         (s_suppkey % 16 + 64) || '"' AS reach,
         CASE s_suppkey % 5 WHEN 0 THEN 'Southpaw' WHEN 1 THEN 'Switch' ELSE 'Orthodox' END AS stance
  FROM roster"""

BLOCKS["bout_suppliers"] = """
  SELECT l_orderkey, min(l_suppkey) AS s1, max(l_suppkey) AS s2 FROM lineitem GROUP BY 1
  HAVING min(l_suppkey) <> max(l_suppkey)"""

BLOCKS["bt_fight_details"] = f"""
  SELECT cast(o_orderkey AS varchar) AS fight_id, a.fighter_url AS fighter1_url, b.fighter_url AS fighter2_url,
         a.fighter_name AS fighter1_name, b.fighter_name AS fighter2_name,
         CASE o_orderkey % 2 WHEN 0 THEN 'fighter1' ELSE 'fighter2' END AS winner,
         CASE o_orderkey % 3 WHEN 0 THEN 'KO/TKO' WHEN 1 THEN 'Submission' ELSE 'Decision' END AS method,
         cast(o_orderkey % 3 + 1 AS integer) AS finish_round,
         {CLOCK.format('(o_orderkey % 300)')} AS finish_time
  FROM bout_suppliers JOIN orders ON l_orderkey = o_orderkey
  JOIN roster a ON a.s_suppkey = s1 JOIN roster b ON b.s_suppkey = s2"""

BLOCKS["bt_dates"] = """
  SELECT cast(o_orderkey AS varchar) AS fight_id, cast(o_orderdate AS date) AS event_date FROM orders"""

BLOCKS["bt_round_stats"] = f"""
  SELECT cast(l_orderkey AS varchar) AS fight_id, 'f/' || l_suppkey AS fighter_url, l_linenumber AS round,
         CASE WHEN landed % 4 = 3 THEN 1 ELSE 0 END AS knockdowns, landed AS sig_str_landed,
         landed + l_linenumber * 3 AS sig_str_attempted, l_partkey % 3 AS takedowns_landed,
         l_partkey % 3 + l_partkey % 2 AS takedowns_attempted, l_partkey % 5 % 2 AS submission_attempts,
         landed - landed // 3 - landed // 4 AS sig_distance_landed, landed // 3 AS sig_clinch_landed,
         landed // 4 AS sig_ground_landed, landed - landed // 3 - landed // 4 AS sig_head_landed,
         landed // 4 AS sig_body_landed, landed // 3 AS sig_leg_landed,
         {CLOCK.format('(l_partkey % 300)')} AS control_time
  FROM (SELECT *, cast(l_quantity AS integer) AS landed FROM lineitem) JOIN bout_suppliers USING (l_orderkey)
  WHERE l_suppkey IN (s1, s2)"""

# --- paired index -----------------------------------------------------------------

BLOCKS["names"] = """
  SELECT fighter_url, max(fighter) AS fighter
  FROM (SELECT fighter1_url AS fighter_url, fighter1_name AS fighter FROM bt_fight_details
        UNION SELECT fighter2_url, fighter2_name FROM bt_fight_details) GROUP BY 1"""

BLOCKS["side_totals"] = """
  SELECT fight_id, fighter_url, cast(sum(knockdowns) AS bigint) AS kd_scored, count(*) AS rounds
  FROM bt_round_stats GROUP BY 1, 2"""

BLOCKS["paired"] = """
  SELECT a.fighter_url, a.fight_id, b.kd_scored AS kd_absorbed, a.rounds AS rounds_fought
  FROM side_totals a JOIN side_totals b ON a.fight_id = b.fight_id AND a.fighter_url <> b.fighter_url"""

BLOCKS["flagged"] = """
  SELECT p.*, CASE WHEN d.method = 'KO/TKO' AND ((d.winner = 'fighter1' AND d.fighter2_url = p.fighter_url)
                OR (d.winner = 'fighter2' AND d.fighter1_url = p.fighter_url)) THEN 1 ELSE 0 END AS lost_by_ko
  FROM paired p LEFT JOIN bt_fight_details d ON d.fight_id = p.fight_id"""

BLOCKS["chin_raw"] = """
  SELECT fighter_url, coalesce(fighter, 'Unknown') AS fighter, fights, rounds, kd_absorbed, ko_losses,
         round(kd_absorbed / fights, 3) AS kd_per_fight, round(kd_absorbed / rounds, 4) AS kd_per_round
  FROM (SELECT fighter_url, count(*) AS fights, cast(sum(rounds_fought) AS bigint) AS rounds,
               cast(sum(kd_absorbed) AS bigint) AS kd_absorbed, cast(sum(lost_by_ko) AS bigint) AS ko_losses
        FROM flagged GROUP BY 1) LEFT JOIN names USING (fighter_url)"""

BLOCKS["chin"] = """
  SELECT * EXCLUDE (place)
         REPLACE (CASE WHEN place = 1 THEN fighter ELSE fighter || ' (' || place || ')' END AS fighter)
  FROM (SELECT *, row_number() OVER (PARTITION BY fighter ORDER BY md5(fighter_url), fighter_url) AS place
        FROM chin_raw)"""

BLOCKS["classes"] = """
  SELECT * FROM (VALUES (1, 115, 124, 'Strawweight'), (2, 125, 134, 'Flyweight'), (3, 135, 144, 'Bantamweight'),
    (4, 145, 154, 'Featherweight'), (5, 155, 169, 'Lightweight'), (6, 170, 184, 'Welterweight'),
    (7, 185, 204, 'Middleweight'), (8, 205, 224, 'Light Heavyweight'), (9, 225, 999, 'Heavyweight'))
    AS t(place, low, high, division)"""

BLOCKS["fighter_class"] = """
  SELECT fighter_url, division, place FROM bt_fighters
  JOIN classes ON try_cast(regexp_extract(weight, '(\\d+)', 1) AS integer) BETWEEN low AND high"""

BLOCKS["ages"] = """
  SELECT t.fighter_url, t.fight_id, date_diff('day', cast(try_strptime(f.dob, '%b %d, %Y') AS date), e.event_date)
           / 365.25::double AS age_at_fight
  FROM side_totals t JOIN bt_dates e USING (fight_id) JOIN bt_fighters f USING (fighter_url)
  WHERE try_strptime(f.dob, '%b %d, %Y') IS NOT NULL"""

# --- careers ------------------------------------------------------------------------

STATS = (
    "knockdowns", "sig_str_landed", "sig_str_attempted", "takedowns_landed", "takedowns_attempted",
    "submission_attempts", "sig_distance_landed", "sig_clinch_landed", "sig_ground_landed", "sig_head_landed",
    "sig_body_landed", "sig_leg_landed",
)
OPPONENT = ("sig_str_landed", "sig_str_attempted", "takedowns_landed", "takedowns_attempted")
SECONDS = "cast(split_part({0}, ':', 1) AS integer) * 60 + cast(split_part({0}, ':', 2) AS integer)"

BLOCKS["clean"] = f"""
  SELECT fight_id, fighter1_url, fighter2_url, fighter1_name, fighter2_name, winner, method,
         (finish_round - 1) * 300 + {SECONDS.format('finish_time')} AS duration_s, event_date
  FROM bt_fight_details JOIN bt_dates USING (fight_id)
  WHERE winner IN ('fighter1', 'fighter2') AND method IN ('KO/TKO', 'Submission', 'Decision')
    AND finish_time LIKE '%:%'"""

BLOCKS["stats"] = f"""
  SELECT fighter_url, fight_id, {', '.join(f'cast(sum({c}) AS bigint) AS {c}' for c in STATS)},
         cast(sum({SECONDS.format('control_time')}) AS bigint) AS ctrl_seconds
  FROM bt_round_stats WHERE control_time LIKE '%:%' GROUP BY 1, 2"""

BLOCKS["sides"] = f"""
  SELECT b.fight_id, b.event_date, b.duration_s, b.method, b.fighter_url, b.opponent_url, b.won,
         {', '.join(f's.{c}' for c in (*STATS, 'ctrl_seconds'))}, {', '.join(f'o.{c} AS opp_{c}' for c in OPPONENT)}
  FROM (SELECT fight_id, event_date, duration_s, method, fighter1_url AS fighter_url, fighter2_url AS opponent_url,
               winner = 'fighter1' AS won FROM clean
        UNION ALL SELECT fight_id, event_date, duration_s, method, fighter2_url, fighter1_url, winner = 'fighter2'
        FROM clean) b
  LEFT JOIN stats s ON s.fight_id = b.fight_id AND s.fighter_url = b.fighter_url
  LEFT JOIN stats o ON o.fight_id = b.fight_id AND o.fighter_url = b.opponent_url"""

SUMS = (
    "duration_s", *STATS, "ctrl_seconds", *[f"opp_{c}" for c in OPPONENT],
)
WINS = {
    "wins": "won", "ko_wins": "won AND method = 'KO/TKO'", "sub_wins": "won AND method = 'Submission'",
    "dec_wins": "won AND method = 'Decision'",
}
BOUT = (
    "{'d': event_date, 'i': fight_id, 'won': won, 'duration_s': duration_s, 'landed': sig_str_landed,"
    " 'attempted': sig_str_attempted, 'td': takedowns_landed, 'kd': knockdowns, 'ctrl': ctrl_seconds}"
)


def _state(source: str, window: str, group: str) -> str:
    return f"""
  SELECT fighter_url, event_date, count(*) {window} AS fights,
         {', '.join(f'sum({c}) {window} AS {c}' for c in SUMS)},
         {', '.join(f'sum(CASE WHEN {w} THEN 1 ELSE 0 END) {window} AS {n}' for n, w in WINS.items())},
         list_reverse_sort(list({BOUT}) {window}) AS history
  FROM {source} {group}"""


BLOCKS["state_asof"] = (
    "SELECT DISTINCT ON (fighter_url, event_date) * FROM ("
    + _state(
        "sides",
        "OVER w",
        "WINDOW w AS (PARTITION BY fighter_url ORDER BY event_date"
        " RANGE BETWEEN UNBOUNDED PRECEDING AND INTERVAL 1 DAY PRECEDING)",
    )
    + ")"
)
BLOCKS["state_final"] = _state(
    "(SELECT * REPLACE (date '2099-01-01' AS event_date), event_date AS fought FROM sides)", "", "GROUP BY 1, 2"
).replace("'d': event_date", "'d': fought")


def _ratio(a: str, b: str) -> str:
    return f"CASE WHEN coalesce({b}, 0) > 0 THEN cast(coalesce({a}, 0) AS double) / cast({b} AS double) ELSE 0.0 END"


MINUTES = "(cast(greatest(duration_s, 1) AS double) / 60)"
LAST3 = "list_slice(history, 1, 3)"
LAST5 = "list_slice(history, 1, 5)"


def _recent(field: str) -> str:
    return f"coalesce(list_sum(list_transform({LAST3}, lambda b: b.{field})), 0)"


MINUTES3 = f"(cast(greatest({_recent('duration_s')}, 1) AS double) / 60)"
STREAK = (
    "cast(CASE WHEN coalesce(list_position(list_transform(history, lambda b: b.won), {0}), 0) = 0 THEN len(history)"
    " ELSE list_position(list_transform(history, lambda b: b.won), {0}) - 1 END AS double)"
)
FEATURES = {
    "sig_spm": f"coalesce(sig_str_landed, 0) / {MINUTES}",
    "sig_acc": _ratio("sig_str_landed", "sig_str_attempted"),
    "sig_str_absorbed_spm": f"coalesce(opp_sig_str_landed, 0) / {MINUTES}",
    "strike_differential_spm": f"(coalesce(sig_str_landed, 0) - coalesce(opp_sig_str_landed, 0)) / {MINUTES}",
    "td_per_fight": _ratio("takedowns_landed", "fights"),
    "td_acc": _ratio("takedowns_landed", "takedowns_attempted"),
    "sub_att_per_fight": _ratio("submission_attempts", "fights"),
    "kd_per_fight": _ratio("knockdowns", "fights"),
    "ctrl_secs_per_fight": _ratio("ctrl_seconds", "fights"),
    "td_defense": f"1.0::double - {_ratio('opp_takedowns_landed', 'opp_takedowns_attempted')}",
    "dist_pct": _ratio("sig_distance_landed", "sig_str_landed"),
    "clinch_pct": _ratio("sig_clinch_landed", "sig_str_landed"),
    "ground_pct": _ratio("sig_ground_landed", "sig_str_landed"),
    "head_pct": _ratio("sig_head_landed", "sig_str_landed"),
    "body_pct": _ratio("sig_body_landed", "sig_str_landed"),
    "leg_pct": _ratio("sig_leg_landed", "sig_str_landed"),
    "win_rate": _ratio("wins", "fights"),
    "finish_rate": _ratio("(ko_wins + sub_wins)", "greatest(wins, 1)"),
    "ko_win_rate": _ratio("ko_wins", "fights"),
    "sub_win_rate": _ratio("sub_wins", "fights"),
    "dec_win_rate": _ratio("dec_wins", "fights"),
    "opp_accuracy_against": _ratio("opp_sig_str_landed", "opp_sig_str_attempted"),
    "recent_win_rate": f"cast(len(list_filter({LAST5}, lambda b: b.won)) AS double) / len({LAST5})",
    "recent_sig_spm": f"{_recent('landed')} / {MINUTES3}",
    "recent_sig_acc": _ratio(_recent("landed"), _recent("attempted")),
    "recent_td_per_fight": _ratio(_recent("td"), f"len({LAST3})"),
    "recent_kd_per_fight": _ratio(_recent("kd"), f"len({LAST3})"),
    "recent_ctrl_secs_per_fight": _ratio(_recent("ctrl"), f"len({LAST3})"),
    "win_streak": STREAK.format("false"),
    "loss_streak": STREAK.format("true"),
    "log_fights": "fights",
}
MODEL_FEATURES = tuple(f for f in FEATURES if f != "opp_accuracy_against")
METHOD_FEATURES = (
    "sig_spm", "kd_per_fight", "sub_att_per_fight", "td_per_fight", "ground_pct", "dist_pct", "finish_rate",
    "ctrl_secs_per_fight",
)


def _profile(state: str) -> str:
    columns = ", ".join(f"{e} AS {n}" for n, e in FEATURES.items() if n != "log_fights")
    return f"""
  SELECT fighter_url, event_date, cast(fights AS bigint) AS fights, {columns},
         ln(1 + cast(fights AS double)) AS log_fights
  FROM {state} WHERE fights >= 3"""


BLOCKS["profile_asof"] = _profile("state_asof")
BLOCKS["profile_final"] = _profile("state_final")

BLOCKS["pairs"] = f"""
  SELECT b.fight_id, b.event_date, m.mirrored,
         {', '.join(f'CASE WHEN m.mirrored THEN p2.{f} - p1.{f} ELSE p1.{f} - p2.{f} END AS {f}' for f in MODEL_FEATURES)},
         cast(CASE WHEN (b.winner = 'fighter1') <> m.mirrored THEN 1 ELSE 0 END AS integer) AS label, b.method,
         cast(least(p1.fights, p2.fights) AS double) / 10 AS weight,
         {', '.join(f"CASE WHEN b.winner = 'fighter1' THEN p1.{f} ELSE p2.{f} END AS winner_{f}" for f in METHOD_FEATURES)}
  FROM clean b JOIN profile_asof p1 ON p1.fighter_url = b.fighter1_url AND p1.event_date = b.event_date
  JOIN profile_asof p2 ON p2.fighter_url = b.fighter2_url AND p2.event_date = b.event_date,
  (VALUES (false), (true)) AS m(mirrored)"""

# --- cards and match-ups -------------------------------------------------------------

ROUND_STATS = (*STATS, "ctrl_seconds")
BLOCKS["round_long"] = f"""
  SELECT fighter_url, CASE round WHEN 1 THEN 'r1' WHEN 2 THEN 'r2' ELSE 'r3plus' END AS bucket, stat, value
  FROM (SELECT fighter_url, round, unnest([{', '.join(f"'{s}'" for s in ROUND_STATS)}]) AS stat,
               unnest([{', '.join(f'cast({s} AS bigint)' for s in STATS)},
                       cast({SECONDS.format('control_time')} AS bigint)]) AS value
        FROM bt_round_stats)"""
MEAN_STD = """count(*) AS n, cast(sum(value) AS double) / count(*) AS mean,
         CASE WHEN count(*) > 1 THEN sqrt(cast(count(*) * sum(value * value) - sum(value) * sum(value) AS double)
           / (cast(count(*) AS double) * cast(count(*) - 1 AS double))) ELSE 0.0 END AS std"""
BLOCKS["round_dist"] = f"SELECT fighter_url, bucket, stat, {MEAN_STD} FROM round_long GROUP BY 1, 2, 3"
BLOCKS["global_dist"] = f"SELECT bucket, stat, {MEAN_STD} FROM round_long GROUP BY 1, 2"
BLOCKS["corner"] = """
  SELECT p.*, try_cast(regexp_extract(replace(f.reach, '"', ''), '([\\d.]+)', 1) AS double) AS reach,
         lower(f.stance) AS stance, c.division AS weight_class,
         floor(date_diff('day', cast(try_strptime(f.dob, '%b %d, %Y') AS date), date '2002-01-01') / 365.25::double)
           AS age,
         sig_spm * 0.6::double + recent_sig_spm * 0.4::double AS eff_sig_spm,
         sig_acc * 0.6::double + recent_sig_acc * 0.4::double AS eff_sig_acc,
         td_per_fight * 0.6::double + recent_td_per_fight * 0.4::double AS eff_td_per_fight
  FROM profile_final p JOIN bt_fighters f USING (fighter_url) LEFT JOIN fighter_class c USING (fighter_url)"""
BLOCKS["finish_rates"] = """
  SELECT division AS weight_class, count(*) AS fights,
         cast(count(*) FILTER (method = 'KO/TKO') AS double) / count(*) AS ko_rate,
         cast(count(*) FILTER (method = 'Submission') AS double) / count(*) AS sub_rate,
         count(*) FILTER (method = 'KO/TKO') AS ko, count(*) FILTER (method = 'Submission') AS sub
  FROM clean JOIN fighter_class ON fighter_url = fighter1_url GROUP BY 1"""
BLOCKS["multipliers"] = """
  SELECT weight_class, fights, ko_rate, sub_rate,
         ko_rate / (SELECT cast(sum(ko) AS double) / cast(sum(fights) AS double) FROM finish_rates) AS ko_mult,
         sub_rate / (SELECT cast(sum(sub) AS double) / cast(sum(fights) AS double) FROM finish_rates) AS sub_mult
  FROM finish_rates"""


def clamp(x: str, low: float, high: float) -> str:
    return f"greatest({low}::double, least({high}::double, {x}))"


def modifiers(version: str) -> str:
    """One row per bout; ``a`` and ``b`` are the two corners."""
    form, shots = version in ("v2.2", "v2.3"), "eff_td_per_fight" if version in ("v2.2", "v2.3") else "td_per_fight"

    def skill(c: str) -> str:
        if version == "v2":
            return f"{c}.win_rate * 0.7::double + {c}.recent_win_rate * 0.3::double"
        spread = clamp(f"{c}.strike_differential_spm / 5", -0.3, 0.3)
        return f"{c}.win_rate * 0.5::double + {c}.recent_win_rate * 0.2::double + {spread} * 0.3::double"

    def edge(c: str, o: str) -> str:
        return clamp(f"1 + (({skill(c)}) - ({skill(o)})) * 2.5::double", 0.6, 1.8)

    def reach(c: str, o: str) -> str:
        d = f"({c}.reach - {o}.reach)"
        return (
            f"CASE WHEN {d} > 3 THEN 1.08 WHEN {d} > 0 THEN 1.03 WHEN {d} < -3 THEN 0.95 WHEN {d} < 0 THEN 0.97"
            " ELSE 1.0 END::double"
        )

    stance1 = """CASE WHEN a.stance = 'switch' THEN 1.02 WHEN b.stance = 'switch' THEN 0.98
      WHEN a.stance = 'southpaw' AND b.stance <> 'southpaw' THEN 1.03 ELSE 1.0 END::double"""
    stance2 = """CASE WHEN a.stance = 'switch' THEN 0.98 WHEN b.stance = 'switch' THEN 1.02
      WHEN b.stance = 'southpaw' AND a.stance <> 'southpaw' THEN 1.03 ELSE 1.0 END::double"""
    limit = """CASE {c}.weight_class WHEN 'Heavyweight' THEN 39 WHEN 'Light Heavyweight' THEN 38
      WHEN 'Middleweight' THEN 37 WHEN 'Welterweight' THEN 36 WHEN 'Lightweight' THEN 35 WHEN 'Featherweight' THEN 35
      WHEN 'Bantamweight' THEN 34 WHEN 'Flyweight' THEN 34 ELSE 36 END"""

    def loss(c: str) -> str:
        over = f"(coalesce({c}.age, 30) - {limit.format(c=c)})"
        return f"CASE WHEN {over} > 0 THEN cast(least({over} * 3, 15) AS double) ELSE 0.0::double END"

    def absorb(c: str) -> str:
        return clamp(f"1.0::double + ({c}.sig_str_absorbed_spm - 3.55::double) * 0.08::double", 0.7, 1.3)

    def defense(c: str) -> str:
        return clamp(f"{c}.opp_accuracy_against / 0.44::double", 0.85, 1.15)

    def boost(c: str, o: str) -> str:
        mismatch = clamp(f"1.0::double + ({c}.{shots} - 1.5::double) * 0.3::double", 1.0, 2.0)
        seek = clamp(f"{edge(c, o)} * 0.8::double", 1.0, 1.5)
        return (
            f"(CASE WHEN {c}.{shots} > 1.5 AND {o}.ground_pct < 0.15 THEN {mismatch} ELSE 1.0::double END)"
            f" * (CASE WHEN {edge(c, o)} > 1.1::double THEN {seek} ELSE 1.0::double END)"
            f" * {clamp(f'{c}.ground_pct / 0.15::double', 0.5, 2.0)}"
        )

    def success(c: str, o: str) -> str:
        gap = f"({c}.td_acc - (1.0::double - {o}.td_defense))"
        return f"CASE WHEN {gap} > 0.1::double THEN {clamp(f'1.0::double + {gap} * 0.8::double', 1.0, 1.4)} ELSE 1.0::double END"

    columns = {
        "f1_reach_mod": reach("a", "b"), "f2_reach_mod": reach("b", "a"),
        "f1_skill": skill("a"), "f2_skill": skill("b"), "f1_edge": edge("a", "b"), "f2_edge": edge("b", "a"),
    }
    later = {
        "f1_stance_mod": stance1, "f2_stance_mod": stance2,
        "ko_mult": "coalesce(m.ko_mult, 1.0)", "sub_mult": "coalesce(m.sub_mult, 1.0)",
        "f1_absorb_mod": absorb("a"), "f2_absorb_mod": absorb("b"),
        "f1_defense_acc_mod": defense("a"), "f2_defense_acc_mod": defense("b"),
        "f1_threshold_loss": loss("a"), "f2_threshold_loss": loss("b"),
        "f1_td_boost": boost("a", "b"), "f2_td_boost": boost("b", "a"),
        "f1_td_success_boost": success("a", "b"), "f2_td_success_boost": success("b", "a"),
    }
    since = {"stance": form, "loss": form, "defense": version == "v2.3"}

    def applies(name: str) -> bool:
        return version != "v2" and all(on for part, on in since.items() if part in name)

    later = {
        n: e if applies(n) else "0.0::double" if n.endswith("loss") else "1.0::double" for n, e in later.items()
    }
    chosen = ", ".join(f"{e} AS {n}" for n, e in {**columns, **later}.items())
    return f"""
  SELECT d.fight_id, d.fighter1_url, d.fighter2_url, {chosen}
  FROM bt_fight_details d JOIN corner a ON a.fighter_url = d.fighter1_url JOIN corner b ON b.fighter_url = d.fighter2_url
  LEFT JOIN multipliers m ON m.weight_class = coalesce(a.weight_class, b.weight_class)"""


def _scored(n: int) -> str:
    def total(expr: str) -> str:
        return f"coalesce(sum(CASE WHEN r.fighter_url = d.fighter{n}_url THEN {expr} END), 0)::double"

    return (
        f"{total('sig_str_landed')} AS landed{n}, {total('knockdowns')} AS kd{n}, {total('takedowns_landed')} AS td{n},"
        f" {total(SECONDS.format('control_time'))} AS control{n}"
    )


def _judged(n: int) -> str:
    return (
        f"landed{n} * striking + kd{n} * 5.0::double * striking + td{n} * 2.0::double * grappling"
        f" + control{n} * 0.10::double * grappling AS s{n}"
    )


BLOCKS["judged"] = f"""
  SELECT fight_id, round, judge, kd1, kd2, {_judged(1)}, {_judged(2)}
  FROM (SELECT d.fight_id, r.round, {_scored(1)}, {_scored(2)}
        FROM bt_round_stats r JOIN bt_fight_details d USING (fight_id) GROUP BY 1, 2),
       (VALUES ('Judge A', 1.0::double, 1.0::double), ('Judge B', 1.15, 0.85), ('Judge C', 0.85, 1.15))
         AS j(judge, striking, grappling)"""
BLOCKS["scorecards"] = """
  SELECT fight_id, round, judge,
         cast(CASE WHEN s1 > s2 THEN 10 WHEN (s2 - s1) / greatest(s2, 1) > 0.4::double OR kd2 >= 2 THEN 8 ELSE 9 END
              AS integer) AS fighter1,
         cast(CASE WHEN s1 <= s2 THEN 10 WHEN (s1 - s2) / greatest(s1, 1) > 0.4::double OR kd1 >= 2 THEN 8 ELSE 9 END
              AS integer) AS fighter2
  FROM judged"""
BLOCKS["card_totals"] = """
  SELECT fight_id, cast(sum(t1) AS bigint) AS total1, cast(sum(t2) AS bigint) AS total2,
         count(*) FILTER (t1 > t2) AS wins1, count(*) FILTER (t2 > t1) AS wins2
  FROM (SELECT fight_id, judge, sum(fighter1) AS t1, sum(fighter2) AS t2 FROM scorecards GROUP BY 1, 2) GROUP BY 1"""

CARD = [("ANA 0", "bo somebody"), ("Cy 7", "Di 3"), ("Ed 11", "Zoltan Nobody"), ("Flo 20", "gus 5"), ("Gus 1", "Ana 2")]
REQUESTS = ", ".join(
    f"({i}, '{name}', '{name.split()[0]}')" for i, name in enumerate(n for bout in CARD for n in bout)
)
BLOCKS["card_names"] = """
  SELECT fighter1_url AS fighter_url, fighter1_name AS fighter FROM bt_fight_details
  UNION SELECT fighter2_url, fighter2_name FROM bt_fight_details"""
BLOCKS["resolved"] = f"""
  SELECT cast(q.request_id AS integer) AS request_id, q.requested, h.fighter_url, h.fighter
  FROM (VALUES {REQUESTS}) AS q(request_id, requested, first_word)
  LEFT JOIN (
    SELECT r.request_id, n.fighter_url, n.fighter, row_number() OVER (
             PARTITION BY r.request_id ORDER BY lower(n.fighter) <> lower(r.requested), n.fighter_url, n.fighter) AS rn
    FROM (VALUES {REQUESTS}) AS r(request_id, requested, first_word)
    JOIN card_names n ON lower(n.fighter) = lower(r.requested) OR lower(n.fighter) LIKE '%' || lower(r.first_word) || '%'
  ) h ON h.request_id = q.request_id AND h.rn = 1"""
BLOCKS["fight_counts"] = """
  SELECT fighter_url, count(*) AS fights
  FROM (SELECT fighter1_url AS fighter_url FROM clean UNION ALL SELECT fighter2_url FROM clean) GROUP BY 1"""


def _fixed(expr: str, digits: int) -> str:
    return f"cast(cast({expr} AS decimal(18,{digits})) AS varchar)"


CONTROL = "cast(floor(w.ctrl_secs_per_fight - l.ctrl_secs_per_fight) AS integer)"
REASONS = [
    ("w.sig_spm - l.sig_spm > 1.0", f"'throws ' || {_fixed('w.sig_spm - l.sig_spm', 1)} || ' more sig strikes/min'"),
    (
        "w.sig_str_absorbed_spm < l.sig_str_absorbed_spm - 0.8::double",
        f"'absorbs ' || {_fixed('l.sig_str_absorbed_spm - w.sig_str_absorbed_spm', 1)} || ' fewer strikes/min'",
    ),
    (
        "w.td_per_fight - l.td_per_fight > 0.8::double",
        f"'averages ' || {_fixed('w.td_per_fight - l.td_per_fight', 1)} || ' more TD/fight'",
    ),
    (
        "w.ctrl_secs_per_fight - l.ctrl_secs_per_fight > 45",
        f"'controls ' || ({CONTROL} // 60) || ':' || lpad(cast({CONTROL} % 60 AS varchar), 2, '0') || ' more per fight'",
    ),
    (
        "w.kd_per_fight - l.kd_per_fight > 0.10::double",
        f"'lands ' || {_fixed('w.kd_per_fight - l.kd_per_fight', 2)} || ' more KD/fight'",
    ),
    (
        "w.win_rate - l.win_rate > 0.10::double",
        f"'holds a ' || {_fixed('(w.win_rate - l.win_rate) * 100', 0)} || 'pp win rate edge'",
    ),
    (
        "w.win_streak > l.win_streak AND w.win_streak >= 3",
        "'riding a ' || cast(w.win_streak AS integer) || '-fight win streak'",
    ),
    (
        "w.recent_win_rate - l.recent_win_rate > 0.20::double",
        f"'recent form: ' || {_fixed('w.recent_win_rate * 100', 0)} || '% vs ' || {_fixed('l.recent_win_rate * 100', 0)}"
        " || '% in last 5'",
    ),
]
POINTS = "list_filter([" + ", ".join(f"CASE WHEN {t} THEN {x} END" for t, x in REASONS) + "], lambda x: x IS NOT NULL)"
CHANCE = "coalesce(w.win_rate / nullif(w.win_rate + l.win_rate, 0), 0.5)"
REASONING = f"""
  SELECT fight_id, CASE WHEN prob >= 0.68::double THEN 'High' WHEN prob >= 0.57::double THEN 'Medium' ELSE 'Low' END
           AS confidence,
         'Model v2 favors ' || name || ' (' || cast(round_even(prob * 100, 0) AS integer) || '% confidence). '
         || CASE WHEN len(points) > 0 THEN name || ' ' || array_to_string(points[1:3], ', ') || '. ' ELSE '' END
         || 'On this trajectory, '
         || CASE method WHEN 'KO/TKO' THEN 'the striking advantage should produce a finish'
                        WHEN 'Submission' THEN 'the grappling dominance should force a tap'
                        ELSE 'the output and control edge should carry the scorecards' END || '.' AS reasoning
  FROM (SELECT b.fight_id, b.method, b.name, {CHANCE} AS prob, {POINTS} AS points
        FROM (SELECT fight_id, method, CASE winner WHEN 'fighter1' THEN fighter1_name ELSE fighter2_name END AS name,
                     CASE winner WHEN 'fighter1' THEN fighter1_url ELSE fighter2_url END AS winner_url,
                     CASE winner WHEN 'fighter1' THEN fighter2_url ELSE fighter1_url END AS loser_url FROM clean) b
        JOIN profile_final w ON w.fighter_url = b.winner_url JOIN profile_final l ON l.fighter_url = b.loser_url)"""
