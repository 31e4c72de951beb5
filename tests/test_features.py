import random

import brute
import pytest
from rows import match
from pyspark.sql import functions as F

from formbook.operators.chunks import time_chunks, with_position
from formbook.plans.features import (
    STAGES, add_form, basic_features, feature_stages, match_features, points_spec, rolling_spec, venue_spec,
)
from formbook.schemas import FEATURES, ContractError


def season(n, teams, seed, hot=None, unplayed=0.02, same_day=False):
    """``n`` random matches; ``hot`` names a team that plays a third of them."""
    pick = random.Random(seed)
    rows = []
    for i in range(n):
        home, away = pick.sample(teams, 2)
        if hot and i % 3 == 0:
            home, away = (hot, away if away != hot else home) if i % 2 else (home if home != hot else away, hot)
        goals = (None, None) if pick.random() < unplayed else (pick.randint(0, 4), pick.randint(0, 4))
        day = (i // 10) if same_day else None
        rows.append(match(i, home, away, *goals, day=day, xg=round(pick.random(), 2)))
    return rows


def computed(df):
    return {r["match_id"]: [round(float(r[f]), 6) + 0.0 for f in FEATURES] for r in df.collect()}


TEAMS = [f"T{i}" for i in range(6)]


@pytest.mark.parametrize("mode", ["cascaded", "single_pass"])
def test_matches_brute_force(make, mode):
    df = make(season(180, TEAMS, 1, hot="T0"))
    expected = brute.features([r.asDict() for r in df.collect()], mode)
    assert len(expected) > 40
    assert computed(match_features(df, mode)) == expected


@pytest.mark.parametrize("mode", ["cascaded", "single_pass"])
@pytest.mark.parametrize("rows_per_chunk", [7, 40])
def test_chunks_do_not_change_results(make, mode, rows_per_chunk):
    """A hot team, chunks smaller than a window, and teams missing from chunks."""
    df = make(season(180, TEAMS + ["R1", "R2"], 2, hot="T0"))
    expected = brute.features([r.asDict() for r in df.collect()], mode)
    assert computed(match_features(df, mode, rows_per_chunk=rows_per_chunk)) == expected


def test_crowded_day_is_split_by_id(make):
    """Twenty matches at one instant, in order of their ids, over several chunks."""
    df = make(season(120, TEAMS, 3, same_day=True))
    df = df.withColumn("date", F.when(F.col("match_id").between(40, 90), F.lit("2000-01-05")).otherwise(
        F.date_format("date", "yyyy-MM-dd")).cast("timestamp_ntz"))
    df = df.filter(F.col("match_id") >= 40)
    chunks = time_chunks(df, 10)
    assert chunks.crowded
    sizes = [r["count"] for r in chunks.assign(df).groupBy("chunk").count().collect()]
    assert max(sizes) < 30
    expected = brute.features([r.asDict() for r in df.collect()])
    assert computed(match_features(df, rows_per_chunk=10)) == expected


def test_only_instants_at_a_quantile_are_counted(make, monkeypatch):
    """A crowded instant holds a quantile, so the rows of all others need no shuffle."""
    df = make([match(i, "A", "B", 1, 0, day=1000 if i % 5 == 0 else i) for i in range(400)])
    counted, group = [], type(df).groupBy

    def grouped(self, *keys):
        if keys == ("at",):
            counted.append(self.count())
        return group(self, *keys)

    monkeypatch.setattr(type(df), "groupBy", grouped)
    chunks = time_chunks(df, 40)
    assert len(chunks.crowded) == 1 and max(counted) <= 80 + len(chunks.cuts)


def test_chunk_order_follows_date_and_id(make):
    df = make(season(100, TEAMS, 4, same_day=True))
    chunks = time_chunks(df, 8)
    rows = chunks.assign(df).orderBy(F.col("date").asc_nulls_last(), "match_id").collect()
    order = [r["chunk"] for r in rows]
    assert order == sorted(order) and len(set(order)) > 5


def test_null_dates_sort_last(make):
    df = make(season(60, TEAMS, 5)).withColumn("date", F.when(F.col("match_id") % 4 > 0, F.col("date")))
    rows = time_chunks(df, 5).assign(df).collect()
    dated = [r["chunk"] for r in rows if r["date"]]
    undated = [r["chunk"] for r in rows if not r["date"]]
    assert max(dated) <= min(undated)
    assert len(set(undated)) > 1


@pytest.mark.parametrize("rows_per_chunk", [1000, 9])
def test_positions(make, rows_per_chunk):
    df = make(season(75, TEAMS, 6, same_day=True))
    rows = with_position(df, time_chunks(df, rows_per_chunk)).collect()
    rows.sort(key=lambda r: (r["date"], r["match_id"]))
    assert [r["position"] for r in rows] == list(range(75))
    assert {r["total"] for r in rows} == {75}


def one_team(values):
    """Home matches of team A against ever new opponents; goals are the values."""
    return [match(i, "A", f"B{i}", v, 0) for i, v in enumerate(values)]


def test_window_excludes_current_row(make):
    df = add_form(basic_features(make(one_team([1, 2, 3, 4, 5, 6, 7]))), rolling_spec())
    rows = df.orderBy("date").collect()
    assert [r["home_goals_avg_last5"] for r in rows] == [None] * 5 + [3.0, 4.0]


def test_null_voids_every_window_that_holds_it(make):
    df = add_form(basic_features(make(one_team([1, 2, None, 4, 5, 6, 7, 8, 9]))), rolling_spec())
    rows = df.orderBy("date").collect()
    assert [r["home_goals_avg_last5"] for r in rows] == [None] * 8 + [6.0]


def test_unplayed_match(make):
    """No goals: the label is Lose, venue flags are 0, points stay unknown."""
    df = basic_features(make(one_team([3, 3, None, 3, 3, 3])))
    rows = add_form(add_form(df, venue_spec()), points_spec()).orderBy("date").collect()
    assert rows[2]["result"] == "Lose"
    assert rows[5]["home_team_home_wins_last5"] == 4
    assert rows[5]["home_team_home_draws_last5"] == rows[5]["home_team_home_losses_last5"] == 0
    assert rows[5]["home_points_last5"] is None


def test_cascade_differs_from_single_pass(make):
    df = make(season(150, TEAMS, 7))
    cascaded, single = match_features(df), match_features(df, "single_pass")
    kept = {r["match_id"] for r in cascaded.collect()}
    assert kept < {r["match_id"] for r in single.collect()}


def test_stages_only_lose_rows(make):
    df = make(season(150, TEAMS, 8))
    stages = feature_stages(df)
    assert list(stages) == list(STAGES)
    ids = [{r["match_id"] for r in s.select("match_id").collect()} for s in stages.values()]
    assert all(later <= before for before, later in zip(ids, ids[1:]))


def test_full_venue_windows_add_up(make):
    df = match_features(make(season(180, TEAMS, 9, unplayed=0.0)))
    for side in ("home", "away"):
        total = sum(F.col(f"{side}_team_{side}_{n}_last5") for n in ("wins", "draws", "losses"))
        assert df.filter(total != 5).count() == 0


def test_a_result_never_reaches_earlier_or_same_matches(make):
    rows = season(150, TEAMS, 10, unplayed=0.0)
    changed = list(rows)
    target = 90
    old = rows[target]
    changed[target] = match(target, old[2], old[3], old[4] + 7, old[5], xg=9.0)
    before, after = computed(match_features(make(rows))), computed(match_features(make(changed)))
    assert {k: v for k, v in before.items() if k <= target} == {k: v for k, v in after.items() if k <= target}
    assert before != after


def test_input_order_is_irrelevant(make):
    rows = season(150, TEAMS, 11)
    shuffled = random.Random(0).sample(rows, len(rows))
    assert computed(match_features(make(rows))) == computed(match_features(make(shuffled).repartition(5)))


def test_contract(make):
    with pytest.raises(ContractError, match="home_ppda"):
        basic_features(make([]).drop("home_ppda"))
    with pytest.raises(ValueError, match="mode"):
        match_features(make([]), "other")


@pytest.mark.parametrize("rows_per_chunk", [1, 5, 50, 1_000])
def test_order_of_null_far_and_crowded_dates(make, rows_per_chunk):
    """Half the rows at one far instant, others null, before 1970 and beyond 2255."""
    import datetime as dt

    days = [dt.datetime(9999, 12, 31), None, dt.datetime(1890, 5, 1), dt.datetime(2300, 1, 1), dt.datetime(2020, 2, 2)]
    rows = []
    for i in range(80):
        row = list(match(1000 - 7 * i, "A", f"T{i % 5}", 1, 0))
        row[1] = days[0] if i % 2 else days[1 + i // 2 % 4]
        rows.append(tuple(row))
    df = make(rows)
    chunks = time_chunks(df, rows_per_chunk)
    got = {r.match_id: r.position for r in with_position(df, chunks).collect()}
    order = sorted(rows, key=lambda r: (r[1] is None, r[1] or days[0], r[0]))
    assert got == {r[0]: i for i, r in enumerate(order)}
    assert len(chunks.cuts) <= 4 * max(80 // rows_per_chunk, 4 * 4)
