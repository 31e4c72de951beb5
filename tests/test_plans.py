"""Plan shapes that matter at scale."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F
from rows import match

from formbook.operators import leaderboard as lb
from formbook.operators.form import form_before, form_of_teams, last_rows, team_form_latest, venue_form_latest
from formbook.operators.runs import top_runs
from formbook.plans.features import audited_features, feature_stages, match_features
from formbook.plans.scoring import scoring_features
from formbook.sources import seasons, tables, views


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(df):
    return len(re.findall(r"Exchange hashpartitioning", plan(df)))


@pytest.fixture(scope="module")
def saved(spark, make, tmp_path_factory):
    from formbook.functions.season import season_start

    root = str(tmp_path_factory.mktemp("warehouse"))
    df = make([match(i * 30, "A", "B", 1, 0) for i in range(40)]).withColumn("season", season_start(F.col("date")))
    return tables.replace_table(df, "matches", root, partition_by="season")


def test_season_read_prunes_files_and_columns(saved):
    text = plan(seasons.matches_by_season(saved, 2000).select("match_id", "home_team"))
    assert "PartitionFilters: [isnotnull(season" in text and "(season" in text
    assert "GreaterThanOrEqual(date" in text
    assert re.search(r"ReadSchema: struct<match_id:bigint,date:timestamp_ntz,home_team:string>", text)


def test_team_filter_is_pushed(saved):
    assert "Or(EqualTo(home_team,A),EqualTo(away_team,A))" in plan(seasons.matches_by_team(saved, "A"))


def test_two_shuffles_per_stage_and_no_join(saved):
    df = match_features(saved)
    assert exchanges(df) == 6
    assert "Join" not in plan(df)
    assert exchanges(match_features(saved, "single_pass")) == 2


@pytest.mark.parametrize("build", ["last_rows", "leaderboards", "runs"])
def test_top_rows_are_limited_before_the_shuffle(spark, small, saved, build):
    df = {
        "last_rows": lambda: last_rows(saved),
        "leaderboards": lambda: lb.leaderboards_all(views.player_stats(spark, small)),
        "runs": lambda: top_runs(views.model_runs(spark, small)),
    }[build]()
    assert re.search(r"WindowGroupLimit .*Partial", plan(df))


def test_top_players_need_no_full_sort(spark, small):
    assert "TakeOrderedAndProject" in plan(lb.top_players(views.player_stats(spark, small), "goals"))


def test_no_query_uses_a_cross_join_or_python(spark, small):
    from __spark_entry__ import oracle_sql, queries

    skip = {"season_union", "replace_table", "scan_matches", "analytics_snapshot", "etl_summary",
            "landed_matches_json", "predictions_by_date", "match_features_chunked", "form_asof_chunked",
            # jobs: their work is done when the frame is there
            "season_read_report", "landed_documents_report", "landed_standings", "landed_news", "row_audit",
            "row_audit_chunked", "predictions_saved", "importance_saved", "feature_importance_read",
            "prediction_sample", "gameweek_job", "train_job_deployment"}
    scored = {"stump_predictions", "stump_evaluation"}  # one Arrow expression scores all trees
    for name in set(oracle_sql()) - skip:
        text = plan(queries()[name](spark, small))
        if name in scored:
            assert text.count("ArrowEvalPython") <= 1, name
            text = text.replace("ArrowEvalPython", "")
        for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEvalPython", "MapInPandas"):
            assert operator not in text, (name, operator)


def test_scoring_reads_the_history_twice_at_most(spark, saved):
    fixtures = spark.createDataFrame([(1, "A", "B")], "fixture_id long, home_team string, away_team string")
    df = scoring_features(fixtures, saved, dt.datetime(2000, 9, 1))
    assert plan(df).count("FileScan") <= 2
    assert re.search(r"WindowGroupLimit .*Partial", plan(df))


@pytest.mark.parametrize("rows_per_chunk", [500_000, 10])
def test_the_audit_scans_nothing_of_its_own(spark, saved, rows_per_chunk):
    features, audit = audited_features(saved, rows_per_chunk=rows_per_chunk)
    assert plan(features).count("FileScan") == plan(match_features(saved, rows_per_chunk=rows_per_chunk)).count("FileScan")
    kept = features.count()
    lines = [(r["name"], r["before"], r["after"], r["dropped"]) for r in audit().collect()]
    stages = [(name, df.count()) for name, df in feature_stages(saved, rows_per_chunk=rows_per_chunk).items()]
    before = [saved.count(), *[n for _, n in stages][:-1]]
    assert lines == [(name, b, n, b - n) for b, (name, n) in zip(before, stages)] and lines[-1][2] == kept


def test_audit_of_an_empty_table(spark, saved):
    features, audit = audited_features(saved.limit(0))
    assert features.count() == 0
    assert [(r["before"], r["after"], r["retained_pct"]) for r in audit().collect()] == [(0, 0, None)] * 5


def test_one_pass_form_equals_the_single_ones(spark, small):
    history = views.matches(spark, small)
    one = {r["team"]: r for r in form_of_teams(history).collect()}
    overall = team_form_latest(history).collect()
    assert len(one) == len(overall)
    for r in overall:
        assert [r[c] for c in r.asDict() if c not in ("team", "matches_used")] == [one[r["team"]][c] for c in r.asDict() if c not in ("team", "matches_used")]
    for r in venue_form_latest(history).collect():
        names = ("wins", "draws", "losses", "win_rate")
        assert [r[n] for n in names] == [one[r["team"]][f"{r['side']}_{n}"] for n in names]


def test_chunked_asof_form_computes_its_timeline_once(spark, saved):
    """All scans of the form are of the written timeline; the tables are read by the call alone."""
    fixtures = spark.createDataFrame([(1, "A", "B", 1990), (2, "A", "B", 2030)], "fixture_id long, home_team string, away_team string, y int")
    fixtures = fixtures.withColumn("date", F.make_date("y", F.lit(1), F.lit(1)).cast("timestamp_ntz"))
    text = plan(form_before(saved, fixtures, rows_per_chunk=2))
    assert text.count("FileScan") == text.count("/timeline") > 0
