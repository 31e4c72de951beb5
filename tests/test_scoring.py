import datetime as dt

import pytest
from rows import START, match
from test_features import TEAMS, season

from formbook.operators import fixtures as fx
from formbook.operators.form import form_before, last_rows, team_form_latest, venue_form_latest
from formbook.operators.names import default_aliases, map_fixtures, unmapped
from formbook.plans.scoring import asof_features, scoring_features, upcoming
from formbook.schemas import TEAM_ALIASES, WINDOW

import brute

FIXTURES = "fixture_id long, home_name string, away_name string, date timestamp_ntz"


def fixtures(spark, rows):
    return spark.createDataFrame(rows, FIXTURES)


def test_latest_form_uses_one_to_five_rows(make):
    """Teams with 1, 4, 5 and 6 past matches."""
    rows, i = [], 0
    for team, n in (("A", 1), ("B", 4), ("C", 5), ("D", 6)):
        for goals in range(1, n + 1):
            rows.append(match(i, team, f"X{i}", goals, 0))
            i += 1
    form = {r["team"]: r for r in team_form_latest(make(rows)).collect()}
    assert [(form[t]["matches_used"], form[t]["goals_avg"]) for t in "ABCD"] == [(1, 1.0), (4, 2.5), (5, 3.0), (5, 4.0)]
    venue = {(r["side"], r["team"]): r for r in venue_form_latest(make(rows)).collect()}
    assert venue["home", "D"]["wins"] == 5 and venue["home", "D"]["win_rate"] == 1.0
    assert ("away", "D") not in venue


def test_last_rows_are_the_newest(make):
    df = make(season(100, TEAMS, 1))
    rows = last_rows(df, "home").filter("team = 'T1'").orderBy("recency").collect()
    expected = sorted((r["match_id"] for r in df.collect() if r["home_team"] == "T1"), reverse=True)[:5]
    assert [r["match_id"] for r in rows] == expected


def test_gameweek_window_is_inclusive(spark):
    first = dt.datetime(2001, 7, 3, 15)
    days = dt.timedelta(days=4)
    df = fixtures(spark, [
        (1, "a", "b", first), (2, "c", "d", first + days), (3, "e", "f", first + days + dt.timedelta(milliseconds=1)),
        (4, "g", "h", dt.datetime(2001, 7, 1)),
    ])
    assert sorted(r["fixture_id"] for r in fx.gameweek(df, dt.datetime(2001, 7, 1)).collect()) == [1, 2]
    empty = fx.gameweek(df, dt.datetime(2002, 1, 1))
    assert empty.collect() == [] and empty.columns == df.columns


def test_default_alias_table(spark):
    df = fixtures(spark, [(1, "Spurs", "Wolves", START), (2, "Spurs", "Nowhere", START)])
    mapped = map_fixtures(df, default_aliases(spark))
    rows = {r["fixture_id"]: r for r in mapped.collect()}
    assert rows[1]["home_team"] == "Tottenham" and rows[1]["away_team"] == "Wolverhampton Wanderers"
    assert [r["fixture_id"] for r in unmapped(mapped).collect()] == [2]
    assert len(TEAM_ALIASES) == 28


def test_last_row_per_match_key_wins(spark):
    df = fx.with_match_key(fixtures(spark, [
        (1, "a", "b", START), (2, "a", "b", START + dt.timedelta(days=2)), (3, "b", "a", START),
    ]))
    rows = {r["match_key"]: r["fixture_id"] for r in fx.latest_per_key(df).collect()}
    assert rows == {"a vs b": 2, "b vs a": 3}


def test_scoring_status_and_features(spark, make):
    as_of = START + dt.timedelta(days=30)
    rows = [match(i, *("AB" if i % 2 else "BA"), 2, 1) for i in range(12)]
    rows.append(match(20, "C", "A", 1, 1))
    soon = as_of + dt.timedelta(days=1)
    aliases = spark.createDataFrame([(t, t) for t in "ABC"], "display_name string, source_name string")
    games = upcoming(
        fixtures(spark, [(1, "A", "B", soon), (2, "A", "Z", soon), (3, "A", "C", soon), (4, "C", "A", soon)]), aliases, as_of
    )
    out = {r["fixture_id"]: r for r in scoring_features(games, make(rows), as_of).collect()}
    # C has no away match, hence ERROR as a visitor but a score at home.
    assert {k: r["status"] for k, r in out.items()} == {1: "OK", 2: "SKIPPED", 3: "ERROR", 4: "OK"}
    assert out[1]["home_team_home_wins_last5"] == 5 and out[1]["home_venue_advantage"] == 1.0
    assert out[1]["home_points_last5"] == 7 and out[1]["away_points_last5"] == 6
    assert out[4]["home_goals_avg_last5"] == 1.0 and out[4]["home_advantage"] == 1


def expected_before(matches, team, side, date):
    past = sorted((m for m in matches if m["date"] < date), key=lambda m: (m["date"], m["match_id"]))
    overall = brute.earlier(past, len(past), team)
    venue = brute.earlier(past, len(past), team, side)
    goals = brute.full(overall, "goals", lambda v: round(sum(v) / 5, 6))
    points = brute.full(overall, "points", sum)
    wins = None
    if len(venue) == WINDOW:
        wins = sum(1 for r in venue if r["goals"] is not None and r["goals"] > r["goals_conceded"])
    return len(overall), len(venue), goals, points, wins


@pytest.mark.parametrize("rows_per_chunk", [10_000, 15])
@pytest.mark.parametrize("span", [(0, 120), (60, 80), (200, 210)])
def test_form_before_fixture(spark, make, rows_per_chunk, span):
    """Fixtures between, at the very time of, and after the matches."""
    df = make(season(120, TEAMS, 12, hot="T0"))
    matches = [r.asDict() for r in df.collect()]
    asked = []
    for i, day in enumerate(range(*span)):
        hours = 0 if i % 2 else 7
        asked.append((i, f"T{i % 6}", f"T{(i + 1) % 6}", START + dt.timedelta(days=day, hours=hours)))
    games = spark.createDataFrame(asked, "fixture_id long, home_team string, away_team string, date timestamp_ntz")
    rows = form_before(df, games, rows_per_chunk).collect()
    assert len(rows) == 2 * len(asked)
    for r in rows:
        goals = None if r["goals_avg"] is None else round(r["goals_avg"], 6)
        got = (r["found"], r["found_at_venue"], goals, r["points_sum"], r["wins"])
        assert got == expected_before(matches, r["team"], r["side"], r["date"]), r


def test_asof_needs_five_of_each(spark, make):
    rows = [match(i, *("AB" if i % 2 else "BA"), 2, 1) for i in range(12)]
    games = fixtures(spark, [(1, "A", "B", START + dt.timedelta(days=11)), (2, "A", "B", START + dt.timedelta(days=8))])
    aliases = spark.createDataFrame([(t, t) for t in "AB"], "display_name string, source_name string")
    out = {r["fixture_id"]: r for r in asof_features(map_fixtures(games, aliases), make(rows)).collect()}
    assert (out[1]["status"], out[2]["status"]) == ("OK", "ERROR")
    assert out[1]["home_venue_advantage"] == 1.0 - 0.0


def test_matchweek_window(make):
    from pyspark.sql import functions as F

    df = make([match(i, "A", "B", None if i in (2, 3) else 1, 0) for i in range(4)]).withColumns({
        "matchday": F.element_at(F.array(*map(F.lit, (4, 5, 7, 6))), (F.col("match_id") + 1).cast("int")),
        "status": F.when(F.col("home_goals").isNull(), "SCHEDULED").otherwise("FINISHED"),
    })
    rows = {(r["week"], r["match_id"]) for r in fx.matchweek_window(df).collect()}
    assert rows == {("next_matchweek", 2), ("previous_matchweek", 1)}
