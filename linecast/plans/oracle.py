"""DuckDB SQL oracles of the registered queries.

Written independently of the DataFrame code: plain SQL over the driver's
tables (``supplier``, ``lineitem``, ...), with the fixture relations as CTEs.
Model constants (stat lookup, thresholds, deviations, clamps, ranks) are
literals here, so a wrong one in the library shows as a mismatch. Only the
random generator's own parameters are shared.
Output columns and presentation match :func:`linecast.plans.queries.finalize`:
doubles through ``floor(x * 1e6 + 0.5) / 1e6``, dates and timestamps as text.
"""

from __future__ import annotations

# Fixture design (see FIXTURES.md).
PROP_STATS = ["points", "assists", "rebounds", "steals", "blocks", "threes", "turnovers"]
PROP_LINES = [24.5, 7.5, 5.5, 1.5, 0.5, 1.5, 22.5]
POINTS_LINE_DELTAS = [0.0, 1.0, -0.2]
PROP_GAME_DATE = "2024-01-01"


def stat_value_sql(stat: str) -> str:
    return (
        f"CAST(CASE {stat} WHEN 'assists' THEN assists WHEN 'rebounds' THEN reboundstotal WHEN 'steals' THEN steals "
        f"WHEN 'blocks' THEN blocks WHEN 'threes' THEN threepointersmade WHEN '3pm' THEN threepointersmade "
        f"ELSE points END AS DOUBLE)"
    )


RUN_TS = "2024-01-02 00:00:00"
RUN_DATE = RUN_TS[:10]


def r6(expr: str) -> str:
    return f"(floor(({expr}) * 1e6 + 0.5) / 1e6)"


def ts(expr: str) -> str:
    return f"strftime({expr}, '%Y-%m-%d %H:%M:%S')"


def _case_by_mod7(values: list, quote: bool) -> str:
    arms = " ".join(
        f"WHEN {i} THEN " + (f"'{v}'" if quote else f"CAST({v} AS DOUBLE)") for i, v in enumerate(values)
    )
    return f"CASE personid % 7 {arms} END"


_DELTAS = ", ".join(f"CAST({d} AS DOUBLE)" for d in POINTS_LINE_DELTAS)

VIEWS = f"""
players AS (
  SELECT s_suppkey AS personid, split_part(s_name, '#', 1) AS firstname, split_part(s_name, '#', 2) AS lastname
  FROM supplier),
players_namesakes AS (
  SELECT p_partkey AS personid, split_part(p_name, ' ', 1) AS firstname, split_part(p_name, ' ', 2) AS lastname
  FROM part),
games AS (SELECT o_orderkey AS gameid, o_orderdate AS gamedate FROM orders),
stats AS (
  SELECT l_suppkey AS personid, l_orderkey AS gameid, l_partkey AS row_a, CAST(l_linenumber AS BIGINT) AS row_b,
         l_quantity AS points,
         CAST(l_linenumber * 2 AS DOUBLE) AS assists,
         CAST(floor((l_extendedprice / 10000.0) * 100.0 + 0.5) AS DOUBLE) / 100.0 AS reboundstotal,
         CAST(floor((l_discount * 30.0) * 10.0 + 0.5) AS DOUBLE) / 10.0 AS steals,
         CAST(floor((l_tax * 10.0) * 10.0 + 0.5) AS DOUBLE) / 10.0 AS blocks,
         CAST(l_linenumber % 4 AS DOUBLE) AS threepointersmade
  FROM lineitem),
props AS (
  SELECT concat(firstname, ' ', lastname) AS player_name, stat, base_line + delta AS line,
         '{PROP_GAME_DATE}' AS game_date, team
  FROM (
    SELECT firstname, lastname, {_case_by_mod7(PROP_STATS, True)} AS stat,
           {_case_by_mod7(PROP_LINES, False)} AS base_line,
           concat('T', CAST(personid % 5 AS VARCHAR)) AS team,
           unnest(CASE WHEN personid % 7 = 0 THEN [{_DELTAS}] ELSE [CAST(0.0 AS DOUBLE)] END) AS delta
    FROM players) x),
players_dedup AS (
  SELECT personid, firstname, lastname FROM players
  QUALIFY row_number() OVER (PARTITION BY personid ORDER BY firstname, lastname) = 1),
props_named AS (
  SELECT *, trim(string_split(player_name, ' ')[1]) AS firstname, trim(string_split(player_name, ' ')[2]) AS lastname
  FROM props),
props_with_id AS (
  SELECT pn.player_name, pn.stat, pn.line, pn.team, pd.personid
  FROM props_named pn JOIN players_dedup pd ON pn.firstname = pd.firstname AND pn.lastname = pd.lastname),
history AS (
  SELECT s.*, w.player_name, w.stat, w.line, w.team FROM stats s JOIN props_with_id w ON s.personid = w.personid),
averages AS (
  SELECT personid, player_name, stat, line, team, avg({stat_value_sql('stat')}) AS predicted_value
  FROM history GROUP BY personid, player_name, stat, line, team),
recommended AS (
  SELECT *, CASE WHEN predicted_value > line THEN 'over' ELSE 'under' END AS bet_outcome,
         CASE WHEN predicted_value > line THEN ((predicted_value - line) / line) * 100.0
              ELSE ((line - predicted_value) / line) * 100.0 END AS deviation_percentage
  FROM averages)
"""


def with_views(body: str) -> str:
    return f"WITH {VIEWS.strip()}\n{body}"


Q: dict[str, str] = {}

Q["scan_props"] = with_views(
    f"SELECT player_name, stat, {r6('line')} AS line, game_date, team FROM props")

Q["props_quarantine"] = with_views(
    f"SELECT player_name, stat, {r6('line')} AS line, game_date, team, CAST(NULL AS VARCHAR) AS broken_name FROM props "
    "UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, player_name FROM props")

Q["split_names"] = with_views(
    f"SELECT player_name, stat, {r6('line')} AS line, game_date, team, firstname, lastname FROM props_named")

Q["dedup_players"] = with_views("SELECT personid, firstname, lastname FROM players_dedup")

Q["resolve_players"] = with_views(
    f"SELECT player_name, stat, {r6('line')} AS line, team, personid FROM props_with_id")

Q["resolve_namesakes"] = with_views(f"""
, nd AS (SELECT personid, firstname, lastname FROM players_namesakes
         QUALIFY row_number() OVER (PARTITION BY personid ORDER BY firstname, lastname) = 1),
offered AS (SELECT DISTINCT concat_ws(' ', firstname, lastname) AS player_name, 'points' AS stat,
                   CAST(10.5 AS DOUBLE) AS line, 'N' AS team FROM nd),
named AS (SELECT *, trim(string_split(player_name, ' ')[1]) AS firstname,
                 trim(string_split(player_name, ' ')[2]) AS lastname FROM offered)
SELECT n.player_name, n.stat, {r6('n.line')} AS line, n.team, d.personid
FROM named n JOIN nd d ON n.firstname = d.firstname AND n.lastname = d.lastname""".replace("\n,", ",", 1))

Q["stat_types"] = with_views("SELECT DISTINCT stat FROM props_with_id")

Q["stat_value"] = with_views(
    f"SELECT personid, gameid, row_a, row_b, stat, {r6('line')} AS line, {r6(stat_value_sql('stat'))} AS x FROM history")

Q["stat_averages"] = with_views(
    f"SELECT personid, player_name, stat, {r6('line')} AS line, team, {r6('predicted_value')} AS predicted_value FROM averages")

Q["stat_averages_split"] = Q["stat_averages"]
Q["stat_averages_union"] = Q["stat_averages"]

Q["deviation"] = with_views(f"""
SELECT personid, player_name, stat, {r6('line')} AS line, team, {r6('predicted_value')} AS predicted_value,
       bet_outcome, {r6('deviation_percentage')} AS deviation_percentage
FROM recommended""")

Q["locks_final"] = with_views(f"""
SELECT personid, player_name, stat AS stat_type, {r6('line')} AS line, '{RUN_DATE}' AS game_date, team,
       {r6('predicted_value')} AS predicted_value, bet_outcome, {r6('deviation_percentage')} AS deviation_percentage,
       '{RUN_TS}' AS created_at
FROM recommended WHERE deviation_percentage >= 5.0""")

Q["batch_points_predictions"] = with_views(f"""
SELECT personid, stat AS stat_type, {r6('line')} AS line, '{RUN_DATE}' AS game_date, CAST(NULL AS VARCHAR) AS team,
       {r6('pv')} AS predicted_value, CASE WHEN pv > line THEN 'over' ELSE 'under' END AS bet_outcome
FROM (SELECT personid, player_name, stat, line, avg(points) AS pv FROM history
      GROUP BY personid, player_name, stat, line) a""")


def oracle_sql() -> dict[str, str]:
    return dict(Q)


# --- history --------------------------------------------------------------------

_ELITE_SQL = (
    "CASE WHEN stat = 'points' THEN base_avg > 20.0 "
    "WHEN stat = 'assists' THEN base_avg > 5.0 "
    "WHEN stat IN ('rebounds', 'reboundstotal') THEN base_avg > 6.5 "
    "WHEN stat = 'steals' THEN base_avg > 1.3 "
    "WHEN stat = 'blocks' THEN base_avg > 1.2 "
    "WHEN stat IN ('threes', '3pm', 'threepointersmade') THEN base_avg > 2.5 ELSE false END"
)

HISTORY = f"""
, unified AS (
  SELECT h.personid, h.player_name, h.stat, h.line, h.team, h.gameid, g.gamedate, h.row_a, h.row_b,
         {stat_value_sql('h.stat')} AS x
  FROM history h JOIN games g ON h.gameid = g.gameid),
ranked AS (
  SELECT *,
    row_number() OVER (PARTITION BY personid, stat
                       ORDER BY gamedate DESC, gameid DESC, row_a DESC, row_b DESC, line, team, player_name, x DESC NULLS LAST) AS rk,
    CASE WHEN x IS NOT NULL THEN row_number() OVER (
        PARTITION BY personid, player_name, stat, line, team, (x IS NULL)
        ORDER BY gamedate DESC, gameid DESC, row_a DESC, row_b DESC, x DESC NULLS LAST) - 1 END AS pos,
    count(x) OVER (PARTITION BY personid, player_name, stat, line, team) AS n_vals
  FROM unified),
weighted AS (
  SELECT *, pow(CAST(0.95 AS DOUBLE), rk - 1) AS w,
    CASE WHEN x IS NULL THEN NULL
         WHEN pos < 10 THEN CAST(0.7 AS DOUBLE) * CAST(1.5 AS DOUBLE)
         WHEN pos < 82 THEN CAST(0.7 AS DOUBLE) ELSE CAST(0.3 AS DOUBLE) END AS tw
  FROM ranked),
summary AS (
  SELECT personid, player_name, stat, line, team,
         sum(x * w) / sum(w) AS base_avg, stddev_samp(x) AS std_dev, min(x) AS min_val, max(x) AS max_val,
         count(x) AS game_count, sum(x * tw) / sum(tw) AS recent_avg,
         sum(CASE WHEN pos >= n_vals - 3 THEN x END) / 3.0 AS last3_avg
  FROM weighted GROUP BY personid, player_name, stat, line, team
  HAVING count(x) >= 3),
model AS (
  SELECT *, CASE WHEN base_avg > 0 THEN recent_avg / base_avg ELSE CAST(1.0 AS DOUBLE) END AS trend,
         COALESCE(game_count > 100 AND ({_ELITE_SQL}), false) AS is_elite,
         CASE WHEN last3_avg > base_avg * 1.2 THEN 'hot' WHEN last3_avg < base_avg * 0.8 THEN 'cold'
              ELSE 'none' END AS streak
  FROM summary)
"""

_K = "personid, player_name, stat, " + r6("line") + " AS line, team"

Q["unified_history"] = with_views(HISTORY + f"""
SELECT {_K}, gameid, {ts('gamedate')} AS gamedate, row_a, row_b, {r6('x')} AS x FROM unified""")

Q["recency_rank"] = with_views(HISTORY + f"""
SELECT {_K}, gameid, row_a, row_b, rk, {r6('w')} AS w FROM weighted""")

Q["decay_summary"] = with_views(HISTORY + f"""
SELECT {_K}, {r6('base_avg')} AS base_avg, {r6('std_dev')} AS std_dev, {r6('min_val')} AS min_val,
       {r6('max_val')} AS max_val, game_count FROM model""")

Q["season_trend"] = with_views(HISTORY + f"""
SELECT {_K}, {r6('base_avg')} AS base_avg, {r6('recent_avg')} AS recent_avg, {r6('trend')} AS trend FROM model""")

Q["streak_state"] = with_views(HISTORY + f"""
SELECT {_K}, {r6('base_avg')} AS base_avg, {r6('last3_avg')} AS last3_avg, streak FROM model""")

Q["elite_flag"] = with_views(HISTORY + f"""
SELECT {_K}, {r6('base_avg')} AS base_avg, game_count, is_elite FROM model""")

Q["history_segments"] = with_views(HISTORY + f"""
SELECT {_K}, CAST(pos // 82 AS BIGINT) AS segment, min(pos) AS first_pos, count(*) AS n_values,
       string_agg(CAST(CAST(x AS DECIMAL(18,4)) AS VARCHAR), ',' ORDER BY pos) AS values, max(n_vals) AS n_vals
FROM ranked WHERE pos IS NOT NULL GROUP BY personid, player_name, stat, line, team, pos // 82""")

Q["segment_rules"] = with_views(HISTORY + f"""
SELECT {_K}, game_count, {r6('recent_avg')} AS recent_avg, {r6('last3_avg')} AS last3_avg FROM summary""")

Q["decay_from_state"] = with_views(HISTORY + f"""
SELECT {_K}, {r6('base_avg')} AS base_avg, {r6('std_dev')} AS std_dev, {r6('min_val')} AS min_val,
       {r6('max_val')} AS max_val, game_count, {r6('recent_avg')} AS recent_avg, {r6('last3_avg')} AS last3_avg FROM summary""")


# --- scenario simulation ------------------------------------------------------------
# Same seeded integer generator as linecast.functions.rng, written as SQL.

from linecast.functions import rng as _rng  # noqa: E402

SEED = 42
N_DRAWS = 500_000
_P = _rng.MOD
_SHORT = 5
_DAILY = ["daily_form", "injury_concern", "matchup_factor", "rest_factor"]
# (deviation, low, high) per daily factor: tight stats, other stats
_DAILY_TIGHT = [(0.02, 0.95, 1.05), (0.01, 0.97, 1.03), (0.02, 0.93, 1.07), (0.01, 0.97, 1.03)]
_DAILY_OTHER = [(0.03, 0.92, 1.08), (0.02, 0.95, 1.05), (0.04, 0.90, 1.10), (0.02, 0.95, 1.05)]


def _mix_ctes(prefix: str, src: str, cols: list[str], rounds) -> tuple[str, str]:
    """CTE chain applying the mixing rounds to ``cols``; returns (sql, last name)."""
    parts, prev = [], src
    for i, (m, c, sh) in enumerate(rounds):
        a, b = f"{prefix}m{i}a", f"{prefix}m{i}b"
        rep_a = ", ".join(f"({x} * {m} + {c}) % {_P} AS {x}" for x in cols)
        rep_b = ", ".join(f"xor({x}, {x} >> {sh}) AS {x}" for x in cols)
        parts.append(f"{a} AS (SELECT * REPLACE ({rep_a}) FROM {prev})")
        parts.append(f"{b} AS (SELECT * REPLACE ({rep_b}) FROM {a})")
        prev = b
    return ",\n".join(parts), prev


def _u(x: str) -> str:
    return f"((CAST({x} AS DOUBLE) + 0.5) / {_rng.TWO_POW_31})"


def _bm(u1: str, u2: str) -> tuple[str, str]:
    r = f"sqrt(-2.0 * ln({u1}))"
    return f"{r} * cos({_rng.TWO_PI!r} * {u2})", f"{r} * sin({_rng.TWO_PI!r} * {u2})"


_FLOOR_MIN = (
    "CASE WHEN stat = 'points' THEN 2.0 WHEN stat = 'assists' THEN 1.0 WHEN stat IN ('rebounds', 'reboundstotal') THEN 1.5 "
    "WHEN stat = 'steals' THEN 0.3 WHEN stat = 'blocks' THEN 0.2 ELSE 0.5 END::DOUBLE"
)


def _draw_ids(n_draws: int, branches: int = 8) -> str:
    """All draw ids as a union of ranges: DuckDB runs the branches in parallel."""
    ends = [n_draws * i // branches for i in range(branches + 1)]
    return " UNION ALL ".join(f"SELECT range AS draw_id FROM range({a}, {b})" for a, b in zip(ends, ends[1:]))


def scenario_ctes(n_draws: int = N_DRAWS, seed: int = SEED) -> str:
    def seed_of(word: int, stream: int) -> str:
        return f"((k{word} * {_rng.KEY_MULT}) % {_P} + {((stream + 1) * _rng.STREAM_MULT) % _P}) % {_P}"

    s_cols = [f"s{t}" for t in range(10)]
    b_cols = [f"b{t}" for t in range(6)]
    seeds = ", ".join([f"{seed_of(0, t)} AS {c}" for t, c in enumerate(s_cols)] + [f"{seed_of(1, t)} AS {c}" for t, c in enumerate(b_cols)]
                      + [f"{seed_of(2, 0)} AS pa, {seed_of(3, 1)} AS pb"])
    mix_keys, keys_last = _mix_ctes("k", "sc_seed", [*s_cols, *b_cols, "pa", "pb"], _rng.ROUNDS)
    dz = []
    for p in range(2):
        a, b = _bm(_u(f"s{6 + 2 * p}"), _u(f"s{7 + 2 * p}"))
        dz += [a, b]
    factors = []
    for i, (name, t, n) in enumerate(zip(_DAILY, _DAILY_TIGHT, _DAILY_OTHER)):
        factors.append(
            f"CASE WHEN tight THEN greatest(CAST({t[1]} AS DOUBLE), least(CAST({t[2]} AS DOUBLE), 1.0 + dz{i} * {t[0]})) "
            f"ELSE greatest(CAST({n[1]} AS DOUBLE), least(CAST({n[2]} AS DOUBLE), 1.0 + dz{i} * {n[0]})) END AS {name}"
        )
    u_cols = [f"u{t}" for t in range(6)]
    mix_draws, draws_last = _mix_ctes("d", "sc_d0", u_cols, _rng.ROUNDS[:3])
    zs = []
    for p in range(3):
        a, b = _bm(_u(f"u{2 * p}"), _u(f"u{2 * p + 1}"))
        zs += [f"{a} AS z{2 * p}", f"{b} AS z{2 * p + 1}"]
    # injury, motivation, referee, trend
    ts_, ns_ = (0.02, 0.03, 0.01, 0.02), (0.04, 0.05, 0.02, 0.04)
    daily_mult = " * daily_form * injury_concern * matchup_factor * rest_factor"

    def regular(sd):
        return (f"sample * (1.0 + z1 * {sd[0]}) * (1.0 + z2 * {sd[1]}) * (1.0 + z3 * {sd[2]})"
                f" * (trend + z4 * {sd[3]}){daily_mult}")

    # streak multipliers: (mean, deviation) hot and cold, elite and regular players
    eh, ec, rh, rc = (1.03, 0.02), (0.98, 0.02), (1.08, 0.04), (0.93, 0.04)
    return f"""
, sc_in AS (
  SELECT *, stat IN ('threes', '3pm', 'threepointersmade', 'steals') AS tight,
         md5(concat_ws('|', coalesce(CAST(personid AS VARCHAR), '~'), coalesce(player_name, '~'),
                       coalesce(stat, '~'), coalesce(CAST(CAST(line AS DECIMAL(18,4)) AS VARCHAR), '~'),
                       coalesce(team, '~'), '{seed}')) AS h
  FROM model WHERE game_count >= {_SHORT}),
sc_seed AS (SELECT *, {seeds} FROM (SELECT *, {", ".join(f"CAST(('0x' || substr(h, {1 + 7 * i}, 7)) AS BIGINT) AS k{i}" for i in range(4))} FROM sc_in) q),
{mix_keys},
sc_dz AS (SELECT *, {dz[0]} AS dz0, {dz[1]} AS dz1, {dz[2]} AS dz2, {dz[3]} AS dz3 FROM {keys_last}),
sc_inputs AS (
  SELECT personid, player_name, stat, line, team, base_avg, trend, is_elite, tight, streak,
         greatest(std_dev, base_avg * 0.1) AS sd_eff,
         CASE WHEN is_elite THEN base_avg * 0.6 ELSE greatest(base_avg * 0.5, {_FLOOR_MIN}) END AS fl,
         greatest(max_val, base_avg * 3.0) AS ce,
         {", ".join(factors)},
         s0, s1, s2, s3, s4, s5, b0, b1, b2, b3, b4, b5,
         pa % {_P - 1} + 1 AS pa, pb % {_rng.MOD_B - 1} + 1 AS pb
  FROM sc_dz),
sc_d0 AS (
  SELECT personid, player_name, stat, line, team, base_avg, trend, is_elite, tight, streak, sd_eff, fl, ce,
         daily_form, injury_concern, matchup_factor, rest_factor, d.draw_id,
         {", ".join(f"(s{t} + ((d.draw_id + 1) * pa) % {_P}) % {_P} + (b{t} + ((d.draw_id + 1) * pb) % {_rng.MOD_B}) % {_rng.MOD_B} AS u{t}" for t in range(6))}
  FROM ({_draw_ids(n_draws)}) d, sc_inputs),
{mix_draws},
sc_z AS (SELECT * EXCLUDE ({", ".join(u_cols)}), {", ".join(zs)} FROM {draws_last}),
sc_v0 AS (
  SELECT *, base_avg + z0 * sd_eff AS sample,
         greatest(CAST(-0.15 AS DOUBLE), least(CAST(0.15 AS DOUBLE),
                  z1 * 0.02 + z2 * 0.03 + z3 * 0.01 + (trend - 1.0) * 0.6)) AS impact
  FROM sc_z),
sc_v1 AS (
  SELECT *, CASE WHEN is_elite THEN sample * (1.0 + impact){daily_mult}
                 WHEN tight THEN {regular(ts_)}
                 ELSE {regular(ns_)} END AS v_raw,
         CASE WHEN streak = 'hot' AND is_elite THEN {eh[0]} + z5 * {eh[1]}
              WHEN streak = 'hot' THEN {rh[0]} + z5 * {rh[1]}
              WHEN streak = 'cold' AND is_elite THEN {ec[0]} + z5 * {ec[1]}
              WHEN streak = 'cold' THEN {rc[0]} + z5 * {rc[1]} END AS mult
  FROM sc_v0),
sc_draws AS (
  SELECT personid, player_name, stat, line, team, draw_id,
         least(greatest(CASE WHEN mult IS NULL THEN v_raw ELSE v_raw * mult END, fl), ce) AS v
  FROM sc_v1),
sc_sorted AS (
  -- quantile_disc returns the element at 0-based index ceil(n * q) - 1, so
  -- q = (k + 0.5) / N selects exactly sorted[k] with k = int(0.1 N), int(0.9 N)
  SELECT personid, player_name, stat, line, team,
         avg(v) AS predicted_value,
         CAST(sum(CASE WHEN v > line THEN 1 ELSE 0 END) AS DOUBLE) / count(*) AS probability_over,
         quantile_disc(v, [{(int(0.1 * n_draws) + 0.5) / n_draws!r}, {(int(0.9 * n_draws) + 0.5) / n_draws!r}]) AS q
  FROM sc_draws GROUP BY personid, player_name, stat, line, team),
sc_summary AS (SELECT * EXCLUDE (q), q[1] AS confidence_low, q[2] AS confidence_high FROM sc_sorted),
sc_short AS (
  SELECT personid, player_name, stat, line, team, base_avg AS predicted_value, CAST(0.5 AS DOUBLE) AS probability_over,
         base_avg * 0.8 AS confidence_low, base_avg * 1.2 AS confidence_high
  FROM model WHERE game_count < {_SHORT}),
sc_all AS (SELECT * FROM sc_summary UNION ALL SELECT * FROM sc_short),
sc_rec AS (
  SELECT *, CASE WHEN probability_over > 0.6 THEN 'over' WHEN probability_over < 0.4 THEN 'under' ELSE 'neutral' END AS bet_outcome,
         CASE WHEN predicted_value > line THEN ((predicted_value - line) / line) * 100.0
              ELSE ((line - predicted_value) / line) * 100.0 END AS deviation_percentage,
         CASE WHEN probability_over >= 0.7 OR probability_over <= 0.3 THEN 'high'
              WHEN probability_over >= 0.55 OR probability_over <= 0.45 THEN 'medium' ELSE 'low' END AS confidence_score,
         CASE WHEN confidence_high - confidence_low > predicted_value * 0.5 THEN 'high_risk'
              WHEN confidence_high - confidence_low > predicted_value * 0.3 THEN 'medium_risk' ELSE 'low_risk' END AS risk_assessment
  FROM sc_all)
"""


_SC = HISTORY + scenario_ctes()
_PV = f"{r6('predicted_value')} AS predicted_value, {r6('probability_over')} AS probability_over, " \
      f"{r6('confidence_low')} AS confidence_low, {r6('confidence_high')} AS confidence_high"

Q["daily_factors"] = with_views(_SC + f"""
SELECT {_K}, {", ".join(f"{r6(n)} AS {n}" for n in _DAILY)} FROM sc_inputs""")

Q["scenario_draws"] = with_views(_SC + f"""
SELECT {_K}, count(*) AS n_draws, {r6('min(v)')} AS min_v, {r6('max(v)')} AS max_v, {r6('avg(v)')} AS mean_v
FROM sc_draws GROUP BY personid, player_name, stat, line, team""")

Q["scenario_summary"] = with_views(_SC + f"SELECT {_K}, {_PV} FROM sc_summary")

Q["scenario_short_history"] = f"""
WITH played AS (
  SELECT o_custkey AS personid, CAST(floor((o_totalprice / 10000.0) * 100.0 + 0.5) AS DOUBLE) / 100.0 AS x,
         pow(CAST(0.95 AS DOUBLE), row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) - 1) AS w
  FROM orders),
based AS (SELECT personid, sum(x * w) / sum(w) AS base FROM played GROUP BY personid HAVING count(*) IN (3, 4))
SELECT c_custkey AS personid, replace(c_name, '#', ' ') AS player_name, 'points' AS stat, {r6('15.5')} AS line,
       concat('T', CAST(c_custkey % 5 AS VARCHAR)) AS team, {r6('base')} AS predicted_value,
       {r6('CAST(0.5 AS DOUBLE)')} AS probability_over, {r6('base * 0.8')} AS confidence_low, {r6('base * 1.2')} AS confidence_high
FROM based JOIN customer ON c_custkey = personid"""

Q["recommend_scenario"] = with_views(_SC + f"""
SELECT {_K}, {_PV}, bet_outcome, {r6('deviation_percentage')} AS deviation_percentage, confidence_score, risk_assessment
FROM sc_rec""")

Q["scenario_predictions"] = with_views(_SC + f"""
SELECT personid, player_name, stat AS stat_type, {r6('line')} AS line, '{RUN_DATE}' AS game_date, team,
       {r6('predicted_value')} AS predicted_value, bet_outcome, {r6('deviation_percentage')} AS deviation_percentage,
       {r6('probability_over')} AS probability_over, {r6('confidence_low')} AS confidence_low,
       {r6('confidence_high')} AS confidence_high, confidence_score, risk_assessment, '{RUN_TS}' AS created_at
FROM sc_rec""")


# --- stored predictions, sink logic, reports, triggers ---------------------------------

PREDICTIONS = f"""
, predictions AS (
  SELECT *,
    CASE WHEN probability_over >= 0.7 OR probability_over <= 0.3 THEN 'high'
         WHEN probability_over >= 0.55 OR probability_over <= 0.45 THEN 'medium' ELSE 'low' END AS confidence_score,
    CASE WHEN confidence_high - confidence_low > predicted_value * 0.5 THEN 'high_risk'
         WHEN confidence_high - confidence_low > predicted_value * 0.3 THEN 'medium_risk' ELSE 'low_risk' END AS risk_assessment
  FROM (
    SELECT p.personid, concat_ws(' ', p.firstname, p.lastname) AS player_name, r.stat AS stat_type, r.line,
           DATE '{PROP_GAME_DATE}' AS game_date, r.team, s.pv AS predicted_value,
           CASE WHEN s.pv > r.line THEN 'over' ELSE 'under' END AS bet_outcome,
           CASE WHEN p.personid % 17 = 0 THEN NULL
                WHEN s.pv > r.line THEN (s.pv - r.line) / r.line * 100.0
                ELSE (r.line - s.pv) / r.line * 100.0 END AS deviation_percentage,
           CASE p.personid % 3 WHEN 0 THEN TIMESTAMP '2024-01-02 00:00:00'
                               WHEN 1 THEN TIMESTAMP '2024-01-02 00:04:00'
                               ELSE TIMESTAMP '2024-01-02 00:09:00' END AS created_at,
           CAST(1.5 AS DOUBLE) AS processing_time_seconds, CAST(12.25 AS DOUBLE) AS total_processing_time_seconds,
           least(CAST(1.0 AS DOUBLE), greatest(CAST(0.0 AS DOUBLE), s.pv / (r.line * 2.0))) AS probability_over,
           s.pv * 0.8 AS confidence_low, s.pv * 1.2 AS confidence_high
    FROM props r
    JOIN (SELECT *, concat(firstname, ' ', lastname) AS player_name FROM players) p ON r.player_name = p.player_name
    JOIN (SELECT personid, avg(points) AS pv FROM stats GROUP BY personid) s ON s.personid = p.personid) q)
"""

Q["locks_new_only"] = with_views(PREDICTIONS + f"""
, batch AS (
  SELECT personid, player_name, stat AS stat_type, line, DATE '2024-01-01' AS game_date, team, predicted_value,
         bet_outcome, deviation_percentage, TIMESTAMP '2024-01-01 18:00:00' AS created_at
  FROM recommended WHERE deviation_percentage >= 5.0),
stored AS (SELECT DISTINCT personid, stat_type, line, game_date FROM predictions
           WHERE created_at < TIMESTAMP '2024-01-02 00:05:00'),
fresh AS (
  SELECT b.* FROM batch b WHERE NOT EXISTS (
    SELECT 1 FROM stored s WHERE s.personid = b.personid AND s.stat_type = b.stat_type
      AND s.line = b.line AND s.game_date = b.game_date)
  QUALIFY row_number() OVER (PARTITION BY personid, stat_type, line, game_date
                             ORDER BY player_name, team, predicted_value, bet_outcome, deviation_percentage) = 1)
SELECT personid, player_name, stat_type, {r6('line')} AS line, CAST(game_date AS VARCHAR) AS game_date, team,
       {r6('predicted_value')} AS predicted_value, bet_outcome, {r6('deviation_percentage')} AS deviation_percentage,
       {ts('created_at')} AS created_at
FROM fresh""")

Q["stage_counts"] = with_views("""
SELECT 'props' AS stage, count(*) AS row_count FROM props
UNION ALL SELECT 'players', count(*) FROM players_dedup
UNION ALL SELECT 'props_with_id', count(*) FROM props_with_id
UNION ALL SELECT 'stats', count(*) FROM stats
UNION ALL SELECT 'history', count(*) FROM history
UNION ALL SELECT 'averages', count(*) FROM averages
UNION ALL SELECT 'locks', count(*) FROM recommended WHERE deviation_percentage >= 5.0""")

_REPORT = f"""
SELECT concat_ws(' ', firstname, lastname) AS player_name, stat_type, {r6('line')} AS line,
       {r6('predicted_value')} AS predicted_value, bet_outcome,
       CASE WHEN predicted_value IS NULL OR line IS NULL THEN NULL
            WHEN predicted_value > line THEN 'OVER' ELSE 'UNDER' END AS display_outcome,
       {ts('created_at')} AS created_at,
       {r6('coalesce(floor(deviation_percentage * 10.0 + 0.5) / 10.0, 0.0)')} AS deviation_percentage,
       CASE WHEN team IS NULL OR team = '' THEN 'N/A' ELSE team END AS team,
       CASE WHEN deviation_percentage >= 20 THEN 'HIGH' ELSE 'MEDIUM' END AS confidence,
       {r6('probability_over')} AS probability_over, {r6('confidence_low')} AS confidence_low,
       {r6('confidence_high')} AS confidence_high, confidence_score, risk_assessment"""

_REPORT_COLS = ("p.firstname, p.lastname, pr.stat_type, pr.line, pr.predicted_value, pr.bet_outcome, pr.created_at, "
                "pr.deviation_percentage, pr.team, pr.probability_over, pr.confidence_low, pr.confidence_high, "
                "pr.confidence_score, pr.risk_assessment")

Q["report_locks"] = with_views(PREDICTIONS + _REPORT + f"""
FROM (SELECT DISTINCT {_REPORT_COLS} FROM predictions pr JOIN players p ON pr.personid = p.personid) x
ORDER BY x.deviation_percentage DESC NULLS LAST""")

Q["report_recent"] = with_views(PREDICTIONS + _REPORT + f"""
FROM (SELECT {_REPORT_COLS} FROM predictions pr JOIN players p ON pr.personid = p.personid) x
ORDER BY x.deviation_percentage DESC NULLS LAST, x.created_at DESC NULLS FIRST,
         concat_ws(' ', x.firstname, x.lastname), x.stat_type, x.line
LIMIT 20""")

Q["run_metrics"] = with_views(PREDICTIONS + f"""
SELECT total_predictions, strftime(_start, '%H:%M:%S') AS run_start, strftime(_end, '%H:%M:%S') AS run_end,
       {r6('floor(coalesce(_mc, 0.0) * 100.0 + 0.5) / 100.0')} AS monte_carlo_seconds,
       {r6('floor(coalesce(_total, 0.0) * 100.0 + 0.5) / 100.0')} AS total_processing_seconds,
       {ts('_end')} AS last_run_time,
       total_predictions * {N_DRAWS} AS monte_carlo_simulations,
       {r6(f'CASE WHEN coalesce(_total, 0.0) > 0 THEN floor(total_predictions * {N_DRAWS} / greatest(coalesce(_total, 0.0), 1.0) + 0.5) ELSE 0.0 END')} AS throughput
FROM (SELECT count(*) AS total_predictions, min(created_at) AS _start, max(created_at) AS _end,
             max(processing_time_seconds) AS _mc, max(total_processing_time_seconds) AS _total
      FROM predictions
      WHERE created_at >= (SELECT max(created_at) - INTERVAL 5 MINUTE FROM predictions)) m
WHERE total_predictions > 0""")

Q["prediction_count"] = with_views(PREDICTIONS + "SELECT count(*) AS total_predictions FROM predictions")

Q["run_metrics_index"] = Q["run_metrics"]
Q["prediction_count_index"] = Q["prediction_count"]

Q["locks_null_safe"] = with_views(PREDICTIONS + f"""
, keyed AS (SELECT personid, stat_type, CASE WHEN stat_type <> 'points' THEN line END AS line, game_date, created_at FROM predictions)
SELECT DISTINCT k.personid, k.stat_type, {r6('k.line')} AS line, CAST(k.game_date AS VARCHAR) AS game_date
FROM keyed k WHERE NOT EXISTS (
  SELECT 1 FROM keyed s WHERE s.created_at < TIMESTAMP '2024-01-02 00:05:00' AND s.personid = k.personid
    AND s.stat_type IS NOT DISTINCT FROM k.stat_type AND s.line IS NOT DISTINCT FROM k.line AND s.game_date = k.game_date)""")

_TRIGGERS = """
, triggers AS (
  SELECT ts AS kafka_timestamp,
         CASE WHEN event_type = 'purchase' THEN 'prop_bet_analysis' ELSE event_type END AS job_type,
         strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS "timestamp"
  FROM events)
"""

Q["parse_triggers"] = with_views(_TRIGGERS + f"""
SELECT {ts('kafka_timestamp')} AS kafka_timestamp, job_type, "timestamp" FROM triggers""")

Q["route_triggers"] = with_views(_TRIGGERS + f"""
SELECT {ts('kafka_timestamp')} AS kafka_timestamp, job_type, "timestamp" FROM triggers
WHERE job_type = 'prop_bet_analysis'""")

Q["trigger_records"] = with_views(_TRIGGERS + """
SELECT CAST(json_object('job_type', job_type, 'timestamp', "timestamp") AS VARCHAR) AS value FROM triggers""")
