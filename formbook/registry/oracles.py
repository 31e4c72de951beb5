"""Oracle SQL (DuckDB) for the registered queries that SQL can express."""

from formbook.schemas import (
    CLASSES, FEATURES, PLAYER_STATS, RAW_STAT_COLUMNS, REQUIRED_COLUMNS, TEAM_STATS,
)

# --- views ---------------------------------------------------------------------------------

KICKOFF = "o_orderdate + to_milliseconds(o_orderkey)"


def _team(number: str) -> str:
    return f"'T' || lpad(CAST(({number}) % 20 AS VARCHAR), 2, '0')"


def _points(own: str, other: str) -> str:
    return f"CAST(CASE WHEN {own} > {other} THEN 3 WHEN {own} = {other} THEN 1 WHEN {own} < {other} THEN 0 END AS BIGINT)"


STATS = """stats AS (
  SELECT l_orderkey,
    count(*) FILTER (WHERE l_returnflag = 'R') AS home_goals,
    count(*) FILTER (WHERE l_returnflag = 'A') AS away_goals,
    coalesce(sum(l_discount) FILTER (WHERE l_linenumber % 2 = 1), 0.0) AS home_xg,
    coalesce(sum(l_discount) FILTER (WHERE l_linenumber % 2 = 0), 0.0) AS away_xg,
    coalesce(sum(l_tax) FILTER (WHERE l_linenumber % 2 = 1), 0.0) AS home_np_xg,
    coalesce(sum(l_tax) FILTER (WHERE l_linenumber % 2 = 0), 0.0) AS away_np_xg,
    coalesce(avg(l_quantity) FILTER (WHERE l_linenumber % 2 = 1), 0.0) AS home_ppda,
    coalesce(avg(l_quantity) FILTER (WHERE l_linenumber % 2 = 0), 0.0) AS away_ppda,
    count(*) FILTER (WHERE l_linenumber % 2 = 1) AS home_deep_completions,
    count(*) FILTER (WHERE l_linenumber % 2 = 0) AS away_deep_completions
  FROM lineitem GROUP BY l_orderkey)"""

MATCHES = f"""{STATS},
matches AS (
  SELECT o_orderkey AS match_id, {KICKOFF} AS date,
    {_team('o_custkey')} AS home_team,
    {_team('o_custkey % 20 + 1 + o_orderkey % 19')} AS away_team,
    home_goals, away_goals, home_xg, away_xg, home_np_xg, away_np_xg, home_ppda, away_ppda,
    home_deep_completions, away_deep_completions,
    {_points('home_goals', 'away_goals')} AS home_points,
    {_points('away_goals', 'home_goals')} AS away_points,
    CAST(CASE WHEN month(o_orderdate) >= 8 THEN year(o_orderdate) ELSE year(o_orderdate) - 1 END AS INTEGER) AS season,
    CASE WHEN home_goals IS NULL THEN 'SCHEDULED' ELSE 'FINISHED' END AS status,
    CAST(o_orderkey % 38 + 1 AS INTEGER) AS matchday
  FROM orders LEFT JOIN stats ON o_orderkey = l_orderkey)"""

MATCH_COLUMNS = ["match_id", *REQUIRED_COLUMNS, "season", "status", "matchday"]

PLAYERS = f"""players AS (
  SELECT 'P' || CAST(user_id AS VARCHAR) AS player, {_team('user_id')} AS team,
    count(*) FILTER (WHERE event_type = 'purchase') AS goals,
    count(*) FILTER (WHERE event_type = 'signup') AS assists,
    count(*) FILTER (WHERE event_type = 'click') AS shots,
    count(*) FILTER (WHERE event_type = 'view') AS key_passes,
    count(*) FILTER (WHERE event_type = 'error') AS yellow_cards,
    count(*) FILTER (WHERE value > 40) AS red_cards,
    sum(value) FILTER (WHERE event_type = 'click') AS xg_chain,
    sum(value) FILTER (WHERE event_type = 'view') AS xg_buildup
  FROM events GROUP BY user_id)"""

SCHEDULE = f"""schedule AS (
  SELECT o_orderkey AS fixture_id,
    'NATION_' || CAST(o_custkey % 25 AS VARCHAR) AS home_name,
    'NATION_' || CAST((o_custkey % 25 + 1 + o_orderkey % 24) % 25 AS VARCHAR) AS away_name,
    {KICKOFF} AS date
  FROM orders),
alias AS (
  SELECT n_name AS display_name, {_team('n_nationkey')} AS source_name FROM nation WHERE n_nationkey < 20),
mapped AS (
  SELECT s.*, h.source_name AS home_team, a.source_name AS away_team
  FROM schedule s LEFT JOIN alias h ON s.home_name = h.display_name
  LEFT JOIN alias a ON s.away_name = a.display_name),
upcoming AS (
  SELECT * FROM mapped WHERE date > TIMESTAMP '2001-07-01'
    AND date <= (SELECT min(date) FROM schedule WHERE date > TIMESTAMP '2001-07-01') + INTERVAL 4 DAY)"""


def _label(code: str) -> str:
    return f"CASE {code} WHEN 'A' THEN 'Draw' WHEN 'N' THEN 'Lose' ELSE 'Win' END"


PREDICTIONS = f"""predictions AS (
  SELECT {_label('l_returnflag')} AS y_true,
    CASE l_linenumber % 3 WHEN 0 THEN 'Draw' WHEN 1 THEN 'Lose' ELSE 'Win' END AS y_pred,
    CASE WHEN l_linenumber = 1 THEN 'Draw' ELSE {_label('l_returnflag')} END AS y_pred_weak,
    l_quantity AS w
  FROM lineitem),
classes AS (SELECT unnest({CLASSES}) AS label),
per_class AS (
  SELECT label,
    (SELECT count(*) FROM predictions WHERE y_true = label AND y_pred = label) AS hits,
    (SELECT count(*) FROM predictions WHERE y_pred = label) AS predicted,
    (SELECT count(*) FROM predictions WHERE y_true = label) AS support
  FROM classes),
scores AS (
  SELECT *, coalesce(hits / nullif(predicted, 0), 0.0) AS precision,
    coalesce(hits / nullif(support, 0), 0.0) AS recall,
    coalesce(2.0 * hits / nullif(predicted + support, 0), 0.0) AS f1
  FROM per_class)"""

RUNS = """runs AS (
  SELECT o_orderpriority AS experiment, o_orderkey AS run_id,
    CASE WHEN o_orderstatus = 'F' THEN 'FINISHED' ELSE 'RUNNING' END AS status,
    o_totalprice AS metric, o_orderdate AS started,
    CASE o_orderkey % 7 WHEN 0 THEN 'Production' WHEN 1 THEN 'Staging' END AS stage,
    o_orderkey AS version
  FROM orders)"""

# --- helpers -------------------------------------------------------------------------------


def _r(column: str, name: str | None = None) -> str:
    return f"round({column}, 6) + 0.0 AS {name or column.split('.')[-1]}"


DOUBLES = {f"{s}_{c}" for s in ("home", "away") for c in ("xg", "np_xg", "ppda")}


def _match_columns(columns: list[str] = MATCH_COLUMNS) -> str:
    return ", ".join(_r(c) if c in DOUBLES else c for c in columns)


def _on_matches(body: str, *ctes: str) -> str:
    return f"WITH {', '.join([MATCHES, *ctes])} {body}"


def _all(source: str) -> str:
    return _on_matches(f"SELECT {_match_columns()} FROM {source}")


# --- features ------------------------------------------------------------------------------

AVERAGED = {
    "goals": ("home_goals", "away_goals"),
    "goals_conceded": ("away_goals", "home_goals"),
    "xg": ("home_xg", "away_xg"),
    "ppda": ("home_ppda", "away_ppda"),
    "deep_completions": ("home_deep_completions", "away_deep_completions"),
}
TEAM_VIEW = {**AVERAGED, "points": ("home_points", "away_points")}

BASIC = """basic AS (
  SELECT *, CASE WHEN home_goals > away_goals THEN 'Win' WHEN home_goals = away_goals THEN 'Draw' ELSE 'Lose' END AS result,
    away_goals AS home_goals_conceded, home_goals AS away_goals_conceded
  FROM matches)"""


def _lines(source: str) -> str:
    """Team rows of a match relation."""
    sides = []
    for i, side in enumerate(("home", "away")):
        stats = ", ".join(f"{pair[i]} AS {s}" for s, pair in TEAM_VIEW.items())
        sides.append(f"SELECT match_id, date, '{side}' AS side, {side}_team AS team, {stats} FROM {source}")
    return " UNION ALL ".join(sides)


def _full(value: str, column: str) -> str:
    return f"CASE WHEN count({column}) OVER w = 5 THEN {value} OVER w END"


def _flag(test: str) -> str:
    return f"CASE WHEN {test} THEN 1 ELSE 0 END"


ROLLED = ", ".join(f"{_full(f'avg({s})', s)} AS {s}_avg" for s in AVERAGED)
BEFORE = "ORDER BY date, match_id ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING"
VENUE_OUT = {n: t for n, t in (("wins", ">"), ("draws", "="), ("losses", "<"))}
VENUE = ", ".join(
    f"CASE WHEN count(*) OVER w = 5 THEN CAST(sum({_flag(f'goals {t} goals_conceded')}) OVER w AS BIGINT) END AS {n}"
    for n, t in VENUE_OUT.items()
)


def _join(source: str, form: str, columns: dict[str, tuple[str, str]]) -> str:
    out = ", ".join(f"h.{c} AS {home}, a.{c} AS {away}" for c, (home, away) in columns.items())
    return (
        f"SELECT m.*, {out} FROM {source} m"
        f" JOIN {form} h ON h.match_id = m.match_id AND h.side = 'home'"
        f" JOIN {form} a ON a.match_id = m.match_id AND a.side = 'away'"
    )


AVG_NAMES = {f"{s}_avg": (f"home_{s}_avg_last5", f"away_{s}_avg_last5") for s in AVERAGED}
POINT_NAMES = {"points5": ("home_points_last5", "away_points_last5")}
VENUE_NAMES = {n: (f"home_team_home_{n}_last5", f"away_team_away_{n}_last5") for n in VENUE_OUT}


def _known(*names: dict) -> str:
    return " AND ".join(f"{c} IS NOT NULL" for d in names for pair in d.values() for c in pair)


def _features(cascaded: bool) -> str:
    second = "s2" if cascaded else "basic"
    third = "s3" if cascaded else "basic"
    return f"""{BASIC},
f1 AS (SELECT match_id, side, {ROLLED} FROM ({_lines('basic')}) WINDOW w AS (PARTITION BY team {BEFORE})),
s2 AS (SELECT * FROM ({_join('basic', 'f1', AVG_NAMES)}) WHERE {_known(AVG_NAMES)}),
f2 AS (SELECT match_id, side, {_full('CAST(sum(points)', 'points').replace('OVER w END', 'OVER w AS BIGINT) END')} AS points5
  FROM ({_lines(second)}) WINDOW w AS (PARTITION BY team {BEFORE})),
s3 AS (SELECT * FROM ({_join('s2', 'f2', POINT_NAMES)}) WHERE {_known(POINT_NAMES)}),
f3 AS (SELECT match_id, side, {VENUE} FROM ({_lines(third)}) WINDOW w AS (PARTITION BY side, team {BEFORE})),
s4 AS (SELECT * FROM ({_join('s3', 'f3', VENUE_NAMES)}) WHERE {_known(VENUE_NAMES)}),
featured AS (
  SELECT *, home_points_last5 - away_points_last5 AS points_diff_last5,
    home_goals_avg_last5 - away_goals_avg_last5 AS goal_diff_avg5,
    home_xg_avg_last5 - away_xg_avg_last5 AS xg_diff_avg5,
    away_goals_conceded_avg_last5 - home_goals_conceded_avg_last5 AS x_defense_diff,
    home_ppda_avg_last5 - away_ppda_avg_last5 AS ppda_diff_avg5,
    home_deep_completions_avg_last5 - away_deep_completions_avg_last5 AS deep_comp_diff_avg5,
    home_team_home_wins_last5 - away_team_away_wins_last5 AS venue_wins_diff,
    home_team_home_wins_last5 / 5.0 - away_team_away_wins_last5 / 5.0 AS home_venue_advantage,
    1 AS home_advantage
  FROM s4)"""


WHOLE = {
    "home_points_last5", "away_points_last5", "points_diff_last5", "venue_wins_diff", "home_advantage",
    *[c for pair in VENUE_NAMES.values() for c in pair],
}


def _feature_columns(columns: list[str]) -> str:
    return ", ".join(c if c in WHOLE else _r(c) for c in columns)


def _featured(columns: list[str], source: str = "featured", cascaded: bool = True, extra: str = "") -> str:
    return _on_matches(
        f"SELECT match_id, {extra}{_feature_columns(columns)} FROM {source}", _features(cascaded)
    )


INPUT_COLUMNS = [c for c in MATCH_COLUMNS if c not in RAW_STAT_COLUMNS and c != "match_id"]

# --- latest and as-of form -----------------------------------------------------------------


def _last(source: str, side: str | None = None) -> str:
    where = f"WHERE side = '{side}'" if side else ""
    return (
        f"SELECT *, CAST(row_number() OVER (PARTITION BY team ORDER BY date DESC, match_id DESC) AS INTEGER) AS recency"
        f" FROM ({_lines(source)}) {where} QUALIFY recency <= 5"
    )


LATEST = f"""season AS (SELECT * FROM matches WHERE date >= TIMESTAMP '2000-08-01' AND date < TIMESTAMP '2001-08-01'),
latest AS (
  SELECT team, count(*) AS matches_used, {", ".join(f"round(avg({s}), 4) AS {s}_avg" for s in AVERAGED)},
    CAST(coalesce(sum(points), 0) AS BIGINT) AS points_sum
  FROM ({_last('season')}) GROUP BY team),
at_venue AS (
  SELECT side, team, count(*) AS matches_used, count(*) FILTER (WHERE points = 3) AS wins,
    count(*) FILTER (WHERE points = 1) AS draws, count(*) FILTER (WHERE points = 0) AS losses,
    round(count(*) FILTER (WHERE points = 3) / count(*), 4) AS win_rate
  FROM ({_last('season', 'home')} UNION ALL {_last('season', 'away')}) GROUP BY side, team)"""


def _form_columns() -> str:
    out = []
    for side, t in (("home", "h"), ("away", "a")):
        out += [f"{t}.{s}_avg AS {side}_{s}_avg_last5" for s in AVERAGED]
        out.append(f"{t}.points_sum AS {side}_points_last5")
    for side, t in (("home", "hv"), ("away", "av")):
        out += [f"{t}.{n} AS {side}_team_{side}_{n}_last5" for n in VENUE_OUT]
    return ", ".join(out)


DIFFERENCES = """home_points_last5 - away_points_last5 AS points_diff_last5,
    home_goals_avg_last5 - away_goals_avg_last5 AS goal_diff_avg5,
    home_xg_avg_last5 - away_xg_avg_last5 AS xg_diff_avg5,
    away_goals_conceded_avg_last5 - home_goals_conceded_avg_last5 AS x_defense_diff,
    home_ppda_avg_last5 - away_ppda_avg_last5 AS ppda_diff_avg5,
    home_deep_completions_avg_last5 - away_deep_completions_avg_last5 AS deep_comp_diff_avg5,
    home_team_home_wins_last5 - away_team_away_wins_last5 AS venue_wins_diff"""

SCORING = _on_matches(
    f"""SELECT fixture_id, home_name, away_name, date, home_team, away_team, status, {_feature_columns(FEATURES)}
FROM (SELECT *, {DIFFERENCES}, 1 AS home_advantage,
    CASE WHEN home_team IS NULL OR away_team IS NULL THEN 'SKIPPED'
      WHEN home_points_last5 IS NULL OR away_points_last5 IS NULL OR home_team_home_wins_last5 IS NULL
        OR away_team_away_wins_last5 IS NULL THEN 'ERROR' ELSE 'OK' END AS status
  FROM (SELECT u.*, {_form_columns()}, hv.win_rate AS home_venue_advantage
    FROM upcoming u LEFT JOIN latest h ON h.team = u.home_team LEFT JOIN latest a ON a.team = u.away_team
    LEFT JOIN at_venue hv ON hv.team = u.home_team AND hv.side = 'home'
    LEFT JOIN at_venue av ON av.team = u.away_team AND av.side = 'away'))""",
    LATEST,
    SCHEDULE,
)

UPTO = "ORDER BY date, match_id ROWS BETWEEN 4 PRECEDING AND CURRENT ROW"
ASOF = f"""lines AS ({_lines('matches')}),
state AS (
  SELECT team, date, count(*) OVER w AS found, {ROLLED},
    {_full('sum(points)', 'points')} AS points_sum
  FROM lines WINDOW w AS (PARTITION BY team {UPTO})),
venue_state AS (
  SELECT side, team, date, count(*) OVER w AS found_at_venue,
    CASE WHEN count(*) OVER w = 5 THEN CAST(sum({_flag('goals > goals_conceded')}) OVER w AS BIGINT) END AS wins,
    CASE WHEN count(*) OVER w = 5 THEN CAST(sum({_flag('goals = goals_conceded')}) OVER w AS BIGINT) END AS draws,
    CASE WHEN count(*) OVER w = 5 THEN 5 - CAST(sum({_flag('goals >= goals_conceded')}) OVER w AS BIGINT) END AS losses
  FROM lines WINDOW w AS (PARTITION BY side, team {UPTO})),
home_state AS (SELECT * FROM venue_state WHERE side = 'home'),
away_state AS (SELECT * FROM venue_state WHERE side = 'away'),
asked AS (SELECT * FROM mapped WHERE home_team IS NOT NULL AND away_team IS NOT NULL),
known AS (
  SELECT f.fixture_id,
    least(coalesce(h.found, 0), coalesce(a.found, 0), coalesce(hv.found_at_venue, 0), coalesce(av.found_at_venue, 0)) AS found,
    {_form_columns()}
  FROM asked f
  ASOF LEFT JOIN state h ON h.team = f.home_team AND f.date > h.date
  ASOF LEFT JOIN state a ON a.team = f.away_team AND f.date > a.date
  ASOF LEFT JOIN home_state hv ON hv.team = f.home_team AND f.date > hv.date
  ASOF LEFT JOIN away_state av ON av.team = f.away_team AND f.date > av.date)"""

FORM_ASOF = _on_matches(
    f"""SELECT fixture_id, home_name, away_name, date, home_team, away_team,
  CASE WHEN home_team IS NULL OR away_team IS NULL THEN 'SKIPPED' WHEN found = 5 THEN 'OK' ELSE 'ERROR' END AS status,
  {", ".join(f"CAST({c} AS DOUBLE) AS {c}" if c in ("home_points_last5", "away_points_last5", "points_diff_last5") else c if c in WHOLE else _r(c) for c in FEATURES)}
FROM (SELECT *, {DIFFERENCES},
    home_team_home_wins_last5 / 5.0 - away_team_away_wins_last5 / 5.0 AS home_venue_advantage,
    CASE WHEN found IS NOT NULL THEN 1 END AS home_advantage
  FROM (SELECT m.*, k.* EXCLUDE (fixture_id) FROM mapped m LEFT JOIN known k ON k.fixture_id = m.fixture_id))""",
    SCHEDULE,
    ASOF,
)

# --- leaderboards --------------------------------------------------------------------------


def _top(columns: str, source: str, order: str) -> str:
    return (
        f"SELECT CAST(row_number() OVER (ORDER BY {order}) AS INTEGER) AS rank, {columns}"
        f" FROM {source} ORDER BY {order} LIMIT 5"
    )


def _team_sum(value: str, name: str, kind: str) -> str:
    return f"(SELECT team, CAST(coalesce(sum({value}), 0) AS {kind}) AS {name} FROM players WHERE team IS NOT NULL GROUP BY team)"


def _top_player(stat: str) -> str:
    return f"WITH {PLAYERS} " + _top(f"player, team, {stat}", "players", f"{stat} DESC NULLS LAST, player, team")


def _top_team(stat: str) -> str:
    return f"WITH {PLAYERS} " + _top(f"team, {stat}", _team_sum(stat, stat, "BIGINT"), f"{stat} DESC, team")


CHANCES = _team_sum("xg_chain + xg_buildup", "created_chances", "DOUBLE")


def _boards() -> str:
    parts = [
        f"SELECT 'top_players_{s}' AS table_name, rank, player, team, CAST({s} AS DOUBLE) AS value"
        f" FROM ({_top(f'player, team, {s}', 'players', f'{s} DESC NULLS LAST, player, team')})"
        for s in PLAYER_STATS
    ]
    parts += [
        f"SELECT 'top_teams_{s}', rank, CAST(NULL AS VARCHAR), team, CAST({s} AS DOUBLE)"
        f" FROM ({_top(f'team, {s}', _team_sum(s, s, 'BIGINT'), f'{s} DESC, team')})"
        for s in TEAM_STATS
    ]
    parts.append(
        "SELECT 'top_teams_created_chances', rank, CAST(NULL AS VARCHAR), team, round(created_chances, 6) + 0.0"
        f" FROM ({_top('team, created_chances', CHANCES, 'created_chances DESC, team')})"
    )
    return f"WITH {PLAYERS} " + " UNION ALL ".join(parts)


# --- quality -------------------------------------------------------------------------------

KINDS = {
    "date": "timestamp_ntz", "home_team": "string", "away_team": "string",
    **{c: "double" for c in DOUBLES},
    "match_id": "bigint", "season": "int", "status": "string", "matchday": "int",
}


def _contract() -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, true AS present, '{KINDS.get(c, 'bigint')}' AS type,"
        f" count(*) FILTER (WHERE {c} IS NULL) AS nulls FROM matches"
        for c in REQUIRED_COLUMNS
    )


def _quality() -> str:
    checks = {}
    for c in REQUIRED_COLUMNS:
        checks[f"null:{c}"] = f"{c} IS NULL"
        if KINDS.get(c, "bigint") in ("bigint", "double"):
            checks[f"negative:{c}"] = f"{c} < 0"
        if KINDS.get(c) == "double":
            checks[f"nan:{c}"] = f"isnan({c})"
    checks["unplayed"] = "home_goals IS NULL OR away_goals IS NULL"
    checks["self_match"] = "home_team = away_team"
    lines = [
        f"SELECT '{name}' AS \"check\", count(*) FILTER (WHERE {test}) AS bad_rows FROM matches"
        for name, test in checks.items()
    ]
    lines += [
        f"SELECT 'duplicate:date,{s}_team', CAST(coalesce(sum(n), 0) AS BIGINT) FROM"
        f" (SELECT count(*) AS n FROM matches GROUP BY date, {s}_team HAVING count(*) > 1)"
        for s in ("home", "away")
    ]
    return " UNION ALL ".join(lines)


STEPS = [
    ("feature_engineering", "matches", "basic", "no rows dropped"),
    ("rolling_averages", "basic", "s2", "a team lacks five earlier matches"),
    ("points_last5", "s2", "s3", "a team lacks five earlier surviving matches"),
    ("venue_form_rolling", "s3", "s4", "a team lacks five earlier matches at the venue"),
    ("derived_features", "s4", "featured", "no rows dropped"),
]
AUDIT = " UNION ALL ".join(
    f"SELECT {i} AS step, '{name}' AS name, (SELECT count(*) FROM {a}) AS before, (SELECT count(*) FROM {b}) AS after,"
    f" (SELECT count(*) FROM {a}) - (SELECT count(*) FROM {b}) AS dropped,"
    f" round(100.0 * (SELECT count(*) FROM {b}) / (SELECT count(*) FROM matches), 2) AS retained_pct, '{note}' AS note"
    for i, (name, a, b, note) in enumerate(STEPS, 1)
)


def _samme(pred: str) -> str:
    return f"""WITH {PREDICTIONS},
e AS (SELECT sum(CASE WHEN y_true <> {pred} THEN w ELSE 0.0 END) / sum(w) AS err FROM predictions),
ea AS (SELECT err, ln((1 - err) / err) + ln(2) AS alpha FROM e),
rows AS (SELECT y_true, {pred} AS y_pred, w, CASE WHEN y_true <> {pred} THEN w * exp(alpha) ELSE w END AS raised
  FROM predictions, ea)
SELECT y_true, y_pred, round(sum(w), 6) + 0.0 AS weight_before, {_r('any_value(err)', 'err')}, {_r('any_value(alpha)', 'alpha')},
  {_r('sum(raised) / (SELECT sum(raised) FROM rows)', 'weight_after')}
FROM rows, ea GROUP BY y_true, y_pred"""


WEIGHTED = {
    n: f"sum({c} * support) / sum(support)" for n, c in (("precision", "precision"), ("recall", "recall"), ("f1_score", "f1"))
}

SPLIT = """labelled AS (
  SELECT match_id, date, CASE WHEN date < TIMESTAMP '2001-06-20' THEN 'train'
    WHEN date >= TIMESTAMP '2001-06-20' THEN 'test' END AS split FROM matches)"""

LEAGUE = f"""SELECT team, count(*) AS played, count(*) FILTER (WHERE points = 3) AS won, count(*) FILTER (WHERE points = 1) AS drawn,
    count(*) FILTER (WHERE points = 0) AS lost, CAST(sum(goals) AS BIGINT) AS goals_for, CAST(sum(goals_conceded) AS BIGINT) AS goals_against,
    CAST(sum(goals - goals_conceded) AS BIGINT) AS goal_difference, CAST(sum(points) AS BIGINT) AS points
  FROM ({_lines("matches WHERE season = 1998 AND home_goals IS NOT NULL")}) GROUP BY team"""

# --- model jobs over deterministic rows ----------------------------------------------------

_P = {"draw": "CAST(fixture_id % 7 + 1 AS DOUBLE) / 16", "lose": "CAST((fixture_id // 7) % 7 + 1 AS DOUBLE) / 16"}
SCORED = f"""{SCHEDULE},
chances AS (
  SELECT *, {_P['draw']} AS draw, {_P['lose']} AS lose, 1 - {_P['draw']} - {_P['lose']} AS win,
    strftime(date, '%Y-%m-%d') AS match_date,
    CASE WHEN home_team IS NULL OR away_team IS NULL THEN 'SKIPPED' WHEN fixture_id % 9 = 0 THEN 'ERROR' ELSE 'OK' END AS status
  FROM mapped),
graded AS (
  SELECT *, round(draw * 100, 1) AS prob_draw, round(lose * 100, 1) AS prob_lose, round(win * 100, 1) AS prob_win,
    round(greatest(draw, lose, win) * 100, 1) AS confidence,
    CASE greatest(draw, lose, win) WHEN draw THEN 'Draw' WHEN lose THEN 'Lose' ELSE 'Win' END AS predicted
  FROM chances)"""
FLAT = f"""WITH {SCORED} SELECT home_name AS home_team, away_name AS away_team, match_date, predicted AS predicted_result,
  confidence, prob_draw, prob_lose, prob_win FROM graded WHERE status = 'OK'"""
IMPORTANCES = f"""importances AS (
  SELECT {FEATURES}[l_orderkey % 27 + 1] AS feature, count(*) / (SELECT count(*) FROM lineitem) AS importance
  FROM lineitem GROUP BY l_orderkey % 27)"""
TOP_IMPORTANCES = f"""WITH {IMPORTANCES} SELECT feature, round(importance, 4) AS importance{{extra}} FROM importances
  ORDER BY round(importance, 4) DESC, feature LIMIT 8"""
TRIALS = """scores AS (
  SELECT CAST(o_custkey % 60 AS INTEGER) AS trial, o_orderkey % 5 + 1 AS fold, avg(o_totalprice) / 1000000 AS score
  FROM orders GROUP BY ALL),
known AS (SELECT trial, fold, CASE WHEN trial = 7 AND fold = 3 THEN NULL ELSE score END AS score FROM scores),
trials AS (
  SELECT trial, CASE WHEN count(score) = count(*) THEN avg(score + 0.01) END AS mean_train_score,
    CASE WHEN count(score) = count(*) THEN avg(score) END AS mean_test_score,
    CASE WHEN count(score) = count(*) THEN stddev_pop(score) END AS std_test_score,
    CASE WHEN count(score) = count(*) THEN avg(score + trial % 3 * 0.03) END AS mean_test_accuracy
  FROM known GROUP BY trial)"""
LABEL_INDEX = "CASE result WHEN 'Draw' THEN 0 WHEN 'Lose' THEN 1 ELSE 2 END"
GUESS = f"CASE WHEN match_id % 3 = 0 THEN {LABEL_INDEX} ELSE ({LABEL_INDEX} + 1) % 3 END"
SAMPLE = f"""(SELECT *, CAST({LABEL_INDEX} AS INTEGER) AS y_true_encoded, CAST({GUESS} AS INTEGER) AS y_pred_encoded
  FROM featured ORDER BY date, match_id LIMIT 50)"""
JOB = f"""games AS (
  SELECT CASE WHEN status = 'OK' AND ({' OR '.join(f'{f} IS NULL' for f in FEATURES)}) THEN 'ERROR' ELSE status END AS status
  FROM ({SCORING}) QUALIFY row_number() OVER (PARTITION BY home_name, away_name ORDER BY date DESC, fixture_id DESC) = 1),
counted AS (SELECT count(*) AS n, count(*) FILTER (WHERE status = 'SKIPPED') AS skipped,
  count(*) FILTER (WHERE status = 'ERROR') AS failed, count(*) FILTER (WHERE status = 'OK') AS predicted FROM games)"""
JOB_STEPS = ["1", "n", "skipped", "failed", "predicted", "predicted", "CASE WHEN predicted > 0 THEN 8 ELSE 0 END"]
JOB_NAMES = ["load_model", "fixtures", "skipped", "error", "predicted", "save_predictions", "save_importances"]
GAMEWEEK_JOB = f"WITH {JOB} " + " UNION ALL ".join(
    f"SELECT CAST({i} AS INTEGER) AS place, '{name}' AS step, "
    + ("CASE WHEN predicted > 0 THEN 'OK' ELSE 'SKIPPED' END" if name.startswith("save") else "'OK'")
    + f" AS status, CAST({rows} AS BIGINT) AS rows FROM counted"
    for i, (name, rows) in enumerate(zip(JOB_NAMES, JOB_STEPS))
)
DEPLOYMENT = f"""WITH {RUNS},
first20 AS (SELECT * FROM runs WHERE status = 'FINISHED'
  QUALIFY row_number() OVER (PARTITION BY experiment ORDER BY metric DESC, run_id) <= 20),
best AS (SELECT * FROM first20 WHERE stage IS NOT NULL AND experiment <> '5-LOW'
  QUALIFY row_number() OVER (PARTITION BY experiment ORDER BY metric DESC, run_id) = 1),
registered AS (SELECT * FROM runs WHERE stage IS NOT NULL AND experiment NOT IN (SELECT experiment FROM best)
  QUALIFY row_number() OVER (PARTITION BY experiment ORDER BY metric DESC, version) = 1),
chosen AS (SELECT *, 'run' AS source FROM best UNION ALL SELECT *, 'registry' FROM registered),
live AS (SELECT * FROM runs WHERE stage = 'Production' QUALIFY row_number() OVER (PARTITION BY experiment ORDER BY version DESC) = 1)
SELECT c.experiment, c.run_id, c.metric, 'model' AS artifact_path, c.source, c.version, l.version AS production_version,
  l.metric AS production_metric,
  CASE WHEN l.metric IS NULL THEN true WHEN c.metric IS NULL OR c.version = l.version THEN false ELSE c.metric > l.metric END AS promote
FROM chosen c LEFT JOIN live l ON l.experiment = c.experiment"""
DEPLOYED = f"""SELECT 'SUCCESS' AS status, CAST(r AS BIGINT) AS run_id,
  (SELECT count(*) FROM featured WHERE date < TIMESTAMP '2001-06-20') AS train_rows,
  (SELECT count(*) FROM featured WHERE date >= TIMESTAMP '2001-06-20') AS test_rows,
  'SUCCESS' AS evaluation, 'SUCCESS' AS deployment, CAST(1 AS BIGINT) AS deployed_run, CAST(1 AS BIGINT) AS version, r = 1 AS promoted
FROM (SELECT unnest([1, 2]) AS r)"""

ORACLES: dict[str, str] = {
    "class_probabilities": f"""WITH {SCORED} SELECT fixture_id, predicted AS predicted_label, confidence, label,
      CASE label WHEN 'Draw' THEN prob_draw WHEN 'Lose' THEN prob_lose ELSE prob_win END AS percent
      FROM graded, (SELECT unnest({CLASSES}) AS label)""",
    "predictions_flat": FLAT,
    "predictions_saved": FLAT,
    "prediction_summary": f"""WITH {SCORED} SELECT count(*) AS total, count(*) FILTER (WHERE status = 'OK') AS predicted,
      count(*) FILTER (WHERE status = 'OK' AND predicted = 'Win') AS home_wins,
      count(*) FILTER (WHERE status = 'OK' AND predicted = 'Draw') AS draws,
      count(*) FILTER (WHERE status = 'OK' AND predicted = 'Lose') AS away_wins FROM graded""",
    "all_feature_importance": f"WITH {IMPORTANCES} SELECT feature, {_r('importance')} FROM importances",
    "feature_importance_read": f"WITH {IMPORTANCES} SELECT feature, {_r('importance')} FROM importances",
    "top_feature_importance": TOP_IMPORTANCES.format(extra=""),
    "importance_saved": TOP_IMPORTANCES.format(extra=", TIMESTAMP '2001-07-01' AS created_at"),
    "top_trials": f"""WITH {TRIALS} SELECT trial, CAST(100 + trial AS INTEGER) AS n_estimators, {_r('trial / 128', 'learning_rate')},
      CAST(2 + trial % 8 AS INTEGER) AS max_depth, CAST(1 + trial % 19 AS INTEGER) AS min_samples_leaf,
      CAST(2 + trial % 18 AS INTEGER) AS min_samples_split, CASE WHEN trial % 2 = 0 THEN 'sqrt' END AS max_features,
      {_r('mean_train_score')}, {_r('mean_test_score')}, {_r('std_test_score')}, {_r('mean_test_accuracy')}
      FROM trials ORDER BY trials.mean_test_score DESC NULLS LAST, trial LIMIT 10""",
    "generalisation_gap": f"""WITH {TRIALS}, tested AS (SELECT trial, avg(score + trial % 3 * 0.03) AS test_score FROM known WHERE fold % 2 = 0 GROUP BY trial),
      gaps AS (SELECT trial, mean_test_accuracy AS cv_score, test_score, mean_test_accuracy - test_score AS gap FROM trials JOIN tested USING (trial))
      SELECT trial, {_r('cv_score')}, {_r('test_score')}, {_r('gap')}, CASE WHEN abs(gaps.gap) < 0.03 THEN 'generalises well'
        WHEN gaps.gap > 0.05 THEN 'possible overfitting' ELSE 'acceptable' END AS verdict FROM gaps""",
    "prediction_sample": _featured(
        FEATURES, SAMPLE,
        extra=f"y_true_encoded, {CLASSES}[y_true_encoded + 1] AS y_true_label, y_pred_encoded, {CLASSES}[y_pred_encoded + 1] AS y_pred_label, ",
    ),
    "gameweek_job": GAMEWEEK_JOB,
    "deployment_plan": DEPLOYMENT,
    "train_job_deployment": _on_matches(DEPLOYED, _features(True)),
    "season_union": _on_matches(f"SELECT {_match_columns(['match_id', 'season', *REQUIRED_COLUMNS])} FROM matches"),
    "season_coverage": _on_matches(
        """SELECT CAST(s AS INTEGER) AS season, s || '/' || (s + 1) AS label, coalesce(n, 0) AS rows, n IS NULL AS missing
        FROM (SELECT unnest(range(1992, 2004)) AS s) LEFT JOIN (SELECT season, count(*) AS n FROM matches GROUP BY season) ON s = season"""
    ),
    "player_season_stats": f"WITH {PLAYERS} SELECT * REPLACE (round(xg_chain, 6) + 0.0 AS xg_chain, round(xg_buildup, 6) + 0.0 AS xg_buildup) FROM players",
    "scan_matches": _all("matches"),
    "replace_table": _all("matches"),
    "analytics_snapshot": _boards(),
    "predictions_by_date": f"WITH {SCHEDULE} SELECT home_name, away_name, strftime(date, '%Y-%m-%d') AS match_date, fixture_id FROM schedule ORDER BY match_date",
    "landed_matches_json": _on_matches(
        "SELECT match_id, date, status, matchday, home_team, away_team, home_goals, away_goals FROM matches"
    ),
    "landed_documents_report": _on_matches(
        """SELECT 'read' AS what, count(*) AS n FROM matches UNION ALL SELECT 'malformed', 2 UNION ALL SELECT 'no known field', 1"""
    ),
    "landed_standings": _on_matches(
        f"""SELECT CAST(row_number() OVER (ORDER BY points DESC, goal_difference DESC, goals_for DESC, team) AS INTEGER) AS position, *
        FROM ({LEAGUE})"""
    ),
    "landed_news": """SELECT CAST(row_number() OVER (PARTITION BY doc_id // 100 ORDER BY doc_id DESC) - 1 AS INTEGER) AS place,
        left(text, 80) AS title, source, TIMESTAMP '2020-01-01' + to_minutes(doc_id) AS published FROM documents QUALIFY place < 10""",
    "dashboard_bundle": _on_matches(
        f"""SELECT part, rows, n AS next_mw, p AS prev_mw FROM (
          SELECT 'standings' AS part, (SELECT count(*) FROM ({LEAGUE})) AS rows
          UNION ALL SELECT 'fixtures', (SELECT count(*) FROM running, weeks WHERE matchday = n)
          UNION ALL SELECT 'results', (SELECT count(*) FROM running, weeks WHERE matchday = p)
          UNION ALL SELECT 'news', (SELECT least(10, count(*)) FROM documents
            WHERE lang = 'en' AND (contains(lower(text), 'this is') OR contains(lower(text), 'and the')))), weeks""",
        "running AS (SELECT * FROM matches WHERE season = 1998)",
        """weeks AS (SELECT (SELECT matchday FROM running WHERE status = 'SCHEDULED' ORDER BY date, match_id LIMIT 1) AS n,
          (SELECT max(matchday) FROM running WHERE status = 'FINISHED') AS p)""",
    ),
    "records_json": _on_matches(
        """SELECT CAST(json_object('match_id', match_id, 'date', strftime(date, '%Y-%m-%d'), 'home_team', home_team,
        'away_team', away_team, 'home_goals', home_goals, 'away_goals', away_goals, 'status', lower(status)) AS VARCHAR) AS record FROM matches"""
    ),
    "etl_summary": _on_matches(
        """SELECT 'SUCCESS' AS status, count(*) AS extracted_records, count(*) AS transformed_records, count(*) AS loaded_records,
        CAST(count(DISTINCT season) AS INTEGER) AS seasons_read,
        CAST(max(season) + 1 AS VARCHAR) || ',' || CAST(max(season) + 2 AS VARCHAR) AS failed_seasons,
        CAST(1 AS INTEGER) AS files_left_out FROM matches"""
    ),
    "season_read_report": _on_matches(
        """SELECT CAST(min(season) AS INTEGER) AS season, true AS single_file, 'no Parquet file' AS reason FROM matches
        UNION ALL SELECT CAST(max(season) + 1 AS INTEGER), false, 'no rows' FROM matches
        UNION ALL SELECT CAST(max(season) + 2 AS INTEGER), false, 'PATH_NOT_FOUND' FROM matches"""
    ),
    "drop_columns": _all("matches"),
    "column_contract": _on_matches(_contract()),
    "match_result": _on_matches("SELECT match_id, home_goals, away_goals, result FROM basic", BASIC),
    "goals_conceded": _on_matches("SELECT match_id, home_goals_conceded, away_goals_conceded FROM basic", BASIC),
    "model_input_columns": _on_matches(
        f"SELECT match_id, {_match_columns(INPUT_COLUMNS)}, result, {_feature_columns(FEATURES)} FROM featured", _features(True)
    ),
    "season_of_match": _on_matches(
        "SELECT match_id, season, season || '/' || (season + 1) AS label, season AS parsed FROM matches"
    ),
    "matches_by_season": _all("matches WHERE season = 1998"),
    "matches_by_team": _all("matches WHERE home_team = 'T07' OR away_team = 'T07'"),
    "null_rows_dropped": _all("matches WHERE home_goals IS NOT NULL AND away_goals IS NOT NULL"),
    "temporal_split": _on_matches("SELECT * FROM labelled", SPLIT),
    "split_ranges": _on_matches(
        "SELECT split, count(*) AS n, min(date) AS min_date, max(date) AS max_date FROM labelled GROUP BY split", SPLIT
    ),
    "time_series_folds": _on_matches(
        """SELECT match_id, position, CAST(CASE WHEN position < n - 5 * (n // 6) THEN 0
          ELSE (position - (n - 5 * (n // 6))) // (n // 6) + 1 END AS INTEGER) AS fold
        FROM (SELECT match_id, row_number() OVER (ORDER BY date, match_id) - 1 AS position, count(*) OVER () AS n FROM matches)"""
    ),
    "matchweek_window": _on_matches(
        f"""SELECT {_match_columns()}, week FROM matches JOIN (
          SELECT 'next_matchweek' AS week, (SELECT matchday FROM matches WHERE status = 'SCHEDULED' ORDER BY date, match_id LIMIT 1) AS d
          UNION ALL SELECT 'previous_matchweek', (SELECT max(matchday) FROM matches WHERE status = 'FINISHED')) ON matchday = d"""
    ),
    "keyword_feed": """SELECT doc_id AS published, lang, source, text FROM documents
        WHERE lang = 'en' AND (contains(lower(text), 'this is') OR contains(lower(text), 'and the')) ORDER BY doc_id DESC LIMIT 10""",
    "run_artifact_path": """SELECT event_id, path AS artifact_path, starts_with(path, 'model') AS is_model FROM (
        SELECT event_id, CASE event_type WHEN 'error' THEN NULL WHEN 'view' THEN NULL WHEN 'signup' THEN 'model'
          WHEN 'click' THEN 'plot' ELSE 'model_' || (props ->> '$.k') END AS path FROM events)""",
    "team_timeline": _on_matches(
        f"SELECT match_id, date, side, team, goals, goals_conceded, {_r('xg')}, {_r('ppda')}, deep_completions, points FROM ({_lines('matches')})"
    ),
    "rolling_form": _featured([c for pair in AVG_NAMES.values() for c in pair], "s2"),
    "points_last5": _featured(["home_points_last5", "away_points_last5"], "s3"),
    "venue_form": _featured([c for pair in VENUE_NAMES.values() for c in pair] + ["home_venue_advantage"]),
    "derived_features": _featured(FEATURES[18:25] + ["home_advantage"]),
    "match_features": _featured(FEATURES, extra="result, "),
    "match_features_chunked": _featured(FEATURES, extra="result, "),
    "match_features_single_pass": _featured(FEATURES, cascaded=False, extra="result, "),
    "row_audit": _on_matches(AUDIT, _features(True)),
    "row_audit_chunked": _on_matches(AUDIT, _features(True)),
    "result_distribution": _on_matches("SELECT result, count(*) AS n FROM basic GROUP BY result", BASIC),
    "gameweek_fixtures": f"WITH {SCHEDULE} SELECT fixture_id, home_name, away_name, date, home_name || ' vs ' || away_name AS match_key, strftime(date, '%Y-%m-%d') AS match_date FROM upcoming",
    "alias_mapped": f"WITH {SCHEDULE} SELECT * FROM mapped",
    "unmapped_fixtures": f"WITH {SCHEDULE} SELECT * FROM mapped WHERE home_team IS NULL OR away_team IS NULL",
    **{
        f"last5_{n}": _on_matches(
            f"SELECT * REPLACE (round(xg, 6) + 0.0 AS xg, round(ppda, 6) + 0.0 AS ppda) FROM ({_last('matches', s)})"
        )
        for n, s in (("all", None), ("home", "home"), ("away", "away"))
    },
    "team_form_latest": _on_matches("SELECT * FROM latest", LATEST),
    "venue_form_latest": _on_matches("SELECT * FROM at_venue", LATEST),
    "scoring_features": SCORING,
    "form_asof": FORM_ASOF,
    "form_asof_chunked": FORM_ASOF,
    **{f"top_players_{s}": _top_player(s) for s in PLAYER_STATS},
    **{f"top_teams_{s}": _top_team(s) for s in TEAM_STATS},
    "top_teams_created_chances": f"WITH {PLAYERS} SELECT rank, team, {_r('created_chances')} FROM ({_top('team, created_chances', CHANCES, 'created_chances DESC, team')})",
    "leaderboards_all": _boards(),
    "league_table": _on_matches(LEAGUE),
    "distinct_teams": _on_matches("SELECT home_team AS team FROM matches UNION SELECT away_team FROM matches"),
    "classification_metrics": f"WITH {PREDICTIONS} SELECT {_r('sum(hits) / sum(support)', 'accuracy')}, {', '.join(_r(v, n) for n, v in WEIGHTED.items())} FROM scores",
    "per_class_metrics": f"WITH {PREDICTIONS} SELECT label, hits, predicted, support, {_r('precision')}, {_r('recall')}, {_r('f1')} FROM scores",
    "macro_f1": f"WITH {PREDICTIONS} SELECT {_r('avg(f1)', 'macro_f1')} FROM scores WHERE support + predicted > 0",
    "confusion_matrix": f"WITH {PREDICTIONS} SELECT label AS y_true, "
    + ", ".join(f"count(*) FILTER (WHERE y_true = label AND y_pred = '{c}') AS pred_{c.lower()}" for c in CLASSES)
    + " FROM classes CROSS JOIN predictions GROUP BY label",
    "classification_report": f"""WITH {PREDICTIONS}
        SELECT label, {_r('precision')}, {_r('recall')}, {_r('f1')}, support FROM scores
        UNION ALL SELECT 'accuracy', NULL, NULL, {_r('sum(hits) / sum(support)', 'f1')}, CAST(sum(support) AS BIGINT) FROM scores
        UNION ALL SELECT 'macro avg', {_r('avg(precision)', 'p')}, {_r('avg(recall)', 'r')}, {_r('avg(f1)', 'f')}, CAST(sum(support) AS BIGINT) FROM scores
        UNION ALL SELECT 'weighted avg', {', '.join(_r(v, n) for n, v in WEIGHTED.items())}, CAST(sum(support) AS BIGINT) FROM scores""",
    "label_domain_check": f"""WITH {PREDICTIONS} SELECT label, count(*) AS n, label IN ('Draw', 'Lose', 'Win') AS known
        FROM (SELECT y_pred AS label FROM predictions UNION ALL SELECT l_returnflag FROM lineitem) GROUP BY label""",
    "best_run": f"WITH {RUNS} SELECT * FROM runs WHERE status = 'FINISHED' QUALIFY row_number() OVER (PARTITION BY experiment ORDER BY metric DESC, run_id) = 1",
    "best_run_with_artifact": f"""WITH {RUNS}, first20 AS (SELECT * FROM runs WHERE status = 'FINISHED'
          QUALIFY row_number() OVER (PARTITION BY experiment ORDER BY metric DESC, run_id) <= 20)
        SELECT *, 'model' AS artifact_path FROM first20 WHERE stage IS NOT NULL
          QUALIFY row_number() OVER (PARTITION BY experiment ORDER BY metric DESC, run_id) = 1""",
    "best_registered_run": f"""WITH {RUNS} SELECT experiment, run_id, version, metric FROM runs WHERE stage IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY experiment ORDER BY metric DESC, version) = 1""",
    "promotion_decision": f"""WITH {RUNS}, newest AS (SELECT * FROM runs WHERE stage IS NOT NULL
          QUALIFY row_number() OVER (PARTITION BY experiment, stage ORDER BY version DESC) = 1),
        experiments AS (SELECT DISTINCT experiment FROM runs)
        SELECT e.experiment, s.version AS staging_version, s.metric AS staging_metric, p.version AS production_version,
          p.metric AS production_metric,
          CASE WHEN p.metric IS NULL THEN true WHEN s.metric IS NULL THEN false ELSE s.metric > p.metric END AS promote
        FROM experiments e LEFT JOIN newest s ON s.experiment = e.experiment AND s.stage = 'Staging'
        LEFT JOIN newest p ON p.experiment = e.experiment AND p.stage = 'Production'""",
    "join_key_duplicates": _on_matches(
        f"SELECT date_trunc('day', date) AS date, side, team, count(*) AS rows FROM ({_lines('matches')}) GROUP BY ALL HAVING count(*) > 1"
    ),
    "quality_report": _on_matches(_quality()),
    "freshness": _on_matches(
        """SELECT max(date) AS newest, CAST(date_diff('day', max(date), TIMESTAMP '2001-08-01') AS INTEGER) AS age_days,
        date_diff('day', max(date), TIMESTAMP '2001-08-01') <= 7 AS fresh FROM matches"""
    ),
    "retrain_gate": _on_matches(
        "SELECT count(*) AS new_rows, count(*) >= 5 AS retrain FROM matches WHERE date >= TIMESTAMP '2001-07-31'"
    ),
    "table_profile": _on_matches(
        f"""SELECT count(*) AS total_rows, strftime(min(date), '%Y-%m-%d') AS min_date, strftime(max(date), '%Y-%m-%d') AS max_date,
        {len(MATCH_COLUMNS)} AS n_columns, '{",".join(MATCH_COLUMNS)}' AS columns,
        '{",".join(KINDS.get(c, "bigint") for c in MATCH_COLUMNS)}' AS dtypes FROM matches"""
    ),
    "label_encoded": _on_matches(
        "SELECT match_id, result, CASE result WHEN 'Draw' THEN 0 WHEN 'Lose' THEN 1 ELSE 2 END AS label FROM basic", BASIC
    ),
    "balanced_weights": _on_matches(
        "SELECT result AS label, count(*) AS n, round((SELECT count(*) FROM basic) / (3.0 * count(*)), 6) AS weight FROM basic GROUP BY result",
        BASIC,
    ),
    "assembled": _on_matches(
        " UNION ALL ".join(
            f"SELECT match_id, CASE result WHEN 'Draw' THEN 0 WHEN 'Lose' THEN 1 ELSE 2 END AS label,"
            f" {i} AS position, round(CAST({c} AS DOUBLE), 6) + 0.0 AS value FROM featured"
            for i, c in enumerate(FEATURES)
        ),
        _features(True),
    ),
    "samme_round": _samme("y_pred_weak"),
    "samme_round_at_chance": _samme("y_pred"),
}
