import datetime as dt

import pytest
from rows import START, match
from pyspark.sql import functions as F

from formbook.functions.season import in_season, season_of, season_start
from formbook.operators import fixtures
from formbook.operators import leaderboard as lb
from formbook.operators import metrics as mt
from formbook.operators import quality as ql
from formbook.operators import runs as rn
from formbook.operators import split as sp
from formbook.plans.dashboard import dashboard
from formbook.plans.etl import run_etl
from formbook.schemas import PLAYER_SCHEMA, ContractError
from formbook.sources import landed, pointers, seasons, tables


def players(spark, rows):
    """(player, team, goals); other stats follow goals."""
    return spark.createDataFrame(
        [(p, t, g, g, g, g, g, g, None if g is None else float(g), 1.0) for p, t, g in rows], PLAYER_SCHEMA
    )


def test_tie_at_the_last_rank_goes_by_name(spark):
    rows = [("g", "T", 1), ("f", "T", 2), ("e", "T", 2), ("d", "T", 3), ("c", "T", 4), ("b", "T", 5), ("a", "T", None)]
    top = lb.top_players(players(spark, rows), "goals").collect()
    assert [(r["rank"], r["player"]) for r in top] == [(1, "b"), (2, "c"), (3, "d"), (4, "e"), (5, "f")]
    every = lb.top_players(players(spark, rows), "goals", n=10).collect()
    assert every[-1]["player"] == "a"


def test_null_team_and_all_null_stat(spark):
    rows = [("a", None, 9), ("b", "X", None), ("c", "Y", 1), ("d", "Y", 2)]
    top = lb.top_teams(players(spark, rows), "goals").collect()
    assert [(r["team"], r["goals"]) for r in top] == [("Y", 3), ("X", 0)]
    chances = lb.top_teams_created_chances(players(spark, rows)).collect()
    assert [(r["team"], r["created_chances"]) for r in chances] == [("Y", 5.0), ("X", 0.0)]


def test_long_form_equals_single_tables(spark):
    df = players(spark, [(f"p{i}", f"t{i % 7}", i % 11) for i in range(40)])
    long = lb.leaderboards_all(df)
    for name in lb.leaderboard_tables():
        stat = name.removeprefix("top_players_").removeprefix("top_teams_")
        if name.endswith("created_chances"):
            single = lb.top_teams_created_chances(df)
        else:
            single = (lb.top_players if "players" in name else lb.top_teams)(df, stat)
        assert sorted(lb.leaderboard(long, name).collect()) == sorted(single.collect())


def test_missing_stat(spark):
    df = players(spark, [("a", "T", 1)]).drop("goals")
    with pytest.raises(ContractError):
        lb.top_players(df, "goals")
    assert lb.top_players(df, "goals", on_error="empty").count() == 0


def test_league_table_skips_unplayed(make):
    table = lb.league_table(make([match(0, "A", "B", 2, 0), match(1, "B", "A", 1, 1), match(2, "A", "B", None, None)]))
    rows = [(r["team"], r["played"], r["points"], r["goal_difference"]) for r in table.collect()]
    assert rows == [("A", 2, 4, 2), ("B", 2, 1, -2)]


def labelled(spark, pairs):
    return spark.createDataFrame(pairs, "y_true string, y_pred string")


def test_metrics_with_an_absent_class(spark):
    df = labelled(spark, [("Win", "Win"), ("Win", "Lose"), ("Lose", "Lose"), ("Lose", "Lose"), ("Draw", "Win"), ("Draw", "Lose")])
    grid = {r["y_true"]: r[1:] for r in mt.confusion_matrix(df).collect()}
    assert grid == {"Draw": (0, 1, 1), "Lose": (0, 2, 0), "Win": (0, 1, 1)}
    draw = mt.per_class_metrics(df).filter("label = 'Draw'").first()
    assert (draw["precision"], draw["recall"], draw["f1"]) == (0.0, 0.0, 0.0)
    assert mt.classification_metrics(df).first()["accuracy"] == 0.5
    assert mt.macro_f1(df).first()[0] == pytest.approx((0 + 2 / 3 + 0.5) / 3)


def test_macro_f1_ignores_a_class_on_neither_side(spark):
    df = labelled(spark, [("Win", "Win"), ("Lose", "Win")])
    assert mt.macro_f1(df).first()[0] == pytest.approx((2 / 3 + 0) / 2)


def test_confusion_cells_add_up(spark):
    pairs = [(a, b) for a in ("Win", "Draw", "Lose") for b in ("Win", "Draw", "Lose") for _ in range(len(a) * len(b))]
    grid = mt.confusion_matrix(labelled(spark, pairs)).collect()
    assert sum(sum(r[1:]) for r in grid) == len(pairs)


def test_gap_verdicts(spark):
    df = spark.createDataFrame([(0.5, 0.48), (0.6, 0.5), (0.5, 0.54)], "cv_score double, test_score double")
    assert [r["verdict"] for r in mt.generalisation_gap(df).collect()] == [
        "generalises well", "possible overfitting", "acceptable"
    ]


def test_folds(make):
    rows = sp.time_series_folds(make([match(i, "A", "B", 1, 0) for i in range(13)])).orderBy("position").collect()
    starts = {k: min(r["position"] for r in rows if r["fold"] == k) for k in range(1, 6)}
    assert starts == {1: 3, 2: 5, 3: 7, 4: 9, 5: 11}
    assert [r["fold"] for r in rows].count(1) == 2


def test_split(make):
    df = make([match(i, "A", "B", 1, 0) for i in range(60)])
    train, test = sp.temporal_split(df, START + dt.timedelta(days=60))
    assert (train.count(), test.count()) == (18, 42)
    with pytest.raises(ContractError):
        sp.temporal_split(df.drop("date"), START)


RUNS = "experiment string, run_id long, status string, metric double, stage string, version long"


def test_promotion(spark):
    df = spark.createDataFrame([
        ("none", 1, "FINISHED", 0.5, "Staging", 1),
        ("null", 2, "FINISHED", 0.5, "Production", 1), ("null", 3, "FINISHED", None, "Staging", 2),
        ("equal", 4, "FINISHED", 0.5, "Production", 1), ("equal", 5, "FINISHED", 0.5, "Staging", 2),
        ("newer", 6, "FINISHED", 0.5, "Production", 1), ("newer", 7, "FINISHED", 0.9, "Staging", 2),
        ("newer", 8, "FINISHED", 0.4, "Staging", 3),
    ], RUNS)
    up = {r["experiment"]: r["promote"] for r in rn.promotion_decision(df).collect()}
    assert up == {"none": True, "null": False, "equal": False, "newer": False}
    down = {r["experiment"]: r["promote"] for r in rn.promotion_decision(df, higher_is_better=False).collect()}
    assert down["newer"] is True


def test_best_run(spark):
    df = spark.createDataFrame([
        ("e", 1, "FINISHED", 0.7, None, 1), ("e", 2, "RUNNING", 0.9, None, 2), ("e", 3, "FINISHED", 0.8, None, 3),
        ("e", 4, "FINISHED", 0.8, None, 4), ("e", 5, "FINISHED", None, None, 5),
    ], RUNS)
    assert rn.best_run(df).first()["run_id"] == 3
    assert rn.best_run(df, higher_is_better=False).first()["run_id"] == 1
    kept = df.withColumn("artifact_path", F.when(F.col("run_id") == 1, "model"))
    assert rn.best_run(kept).first()["run_id"] == 1
    assert rn.best_run(kept, n=2).count() == 0
    versions = df.filter("run_id in (1, 4)").select("run_id", "version")
    assert rn.best_registered_run(df, versions).first()["run_id"] == 4
    assert rn.version_of_run(versions, 4).first()["version"] == 4


def test_artifact_path(spark):
    tags = ['[{"artifact_path": "model_a"}]', "[{}]", "[]", "{oops", None]
    df = spark.createDataFrame([(t,) for t in tags], "tag string")
    assert [r[0] for r in df.select(rn.artifact_path(F.col("tag"))).collect()] == ["model_a", "model", None, None, None]


def test_season_edges(spark):
    days = [dt.datetime(2000, 7, 31, 23), dt.datetime(2000, 8, 1), dt.datetime(2001, 1, 1), dt.datetime(2001, 8, 1)]
    df = spark.createDataFrame([(d,) for d in days], "date timestamp_ntz")
    assert [r[0] for r in df.select(season_start(F.col("date"))).collect()] == [1999, 2000, 2000, 2001]
    assert df.filter(in_season(F.col("date"), 2000)).count() == 2
    assert [season_of(d) for d in days] == [1999, 2000, 2000, 2001]


def test_quality_and_freshness(make):
    rows = [match(0, "A", "A", 1, 0), match(1, "A", "B", -1, None), match(1, "A", "C", 2, 1)]
    report = {r["check"]: r["bad_rows"] for r in ql.quality_report(make(rows)).collect()}
    assert report["self_match"] == 1 and report["negative:home_goals"] == 1 and report["unplayed"] == 1
    assert report["duplicate:date,home_team"] == 2 and report["duplicate:date,away_team"] == 0
    fresh = ql.freshness(make(rows), START + dt.timedelta(days=9)).first()
    assert (fresh["age_days"], fresh["fresh"]) == (8, False)
    gate = ql.retrain_gate(make(rows), make(rows[:1])).first()
    assert (gate["new_rows"], gate["retrain"]) == (2, False)


def test_nan_is_read_as_null(spark, tmp_path):
    df = spark.createDataFrame([(1.0, "a"), (float("nan"), "b"), (None, "c")], "x double, name string")
    saved = tables.replace_table(df, "Values", str(tmp_path))
    assert (tmp_path / "values").exists()
    assert saved.filter(F.col("x").isNull()).count() == 2


def test_missing_tables(spark, tmp_path):
    with pytest.raises(tables.MissingTable):
        tables.scan_table(spark, "nothing", str(tmp_path))
    found = tables.read_tables(spark, {"nothing": PLAYER_SCHEMA}, str(tmp_path))
    assert found["nothing"].schema == PLAYER_SCHEMA and found["nothing"].count() == 0


def test_records_keep_nulls(spark):
    df = spark.createDataFrame([(1, START, None)], "a int, day timestamp_ntz, b string")
    assert tables.records_json(df).first()[0] == '{"a":1,"day":"2000-01-01","b":null}'


def season_files(make, tmp_path, rows):
    paths = {}
    for season, part in rows.items():
        paths[season] = f"{tmp_path}/{season}"
        make(part).withColumn("game_id", F.lit(1)).write.parquet(paths[season])
    return paths


def test_etl(spark, make, tmp_path):
    paths = season_files(make, tmp_path, {1: [match(0, "A", "B", 1, 0)], 2: [], 3: [match(1, "B", "A", 1, 0)]})
    paths[4] = f"{tmp_path}/never"
    status = run_etl(spark, paths, f"{tmp_path}/warehouse").first()
    assert (status["status"], status["loaded_records"], status["failed_seasons"]) == ("SUCCESS", 2, "2,4")  # the empty season has failed too
    assert (status["extracted_records"], status["transformed_records"], status["files_left_out"]) == (2, 2, 0)
    loaded = tables.scan_table(spark, "matches", f"{tmp_path}/warehouse")
    assert "game_id" not in loaded.columns
    assert sorted(r["season"] for r in loaded.collect()) == [1, 3]


def test_no_seasons(spark, make, tmp_path):
    with pytest.raises(seasons.NoSeasons):
        seasons.read_seasons(spark, {1: f"{tmp_path}/never"})
    with pytest.raises(seasons.NoSeasons, match="empty"):
        seasons.read_seasons(spark, season_files(make, tmp_path, {1: [], 2: []}))


def test_contract_stops_the_load(spark, make, tmp_path):
    with pytest.raises(ContractError):
        tables.replace_table(make([]).drop("away_xg"), "matches", str(tmp_path), required=["away_xg"])
    report = {r["column_name"]: r for r in ql.column_contract(make([match(0, "A", "B", None, 0)]).drop("away_xg")).collect()}
    assert not report["away_xg"]["present"] and report["away_xg"]["nulls"] is None
    assert report["home_goals"]["nulls"] == 1


def test_dashboard(spark, small):
    from formbook.sources import views

    parts = dashboard(views.matches(spark, small), 1998, views.articles(spark, small), ["the"])
    assert set(parts) == {"standings", "fixtures", "results", "news", "metadata"}
    assert parts["metadata"].columns == ["next_mw", "prev_mw"] and parts["metadata"].count() == 1
    assert parts["news"].count() == 10 and parts["standings"].count() > 0


def test_corrupt_season_fails_alone(spark, tmp_path):
    """A season that is no Parquet file is reported; the others are read."""
    (tmp_path / "1").mkdir()
    (tmp_path / "1" / "part.parquet").write_text("no parquet")
    spark.range(3).write.parquet(str(tmp_path / "2"))
    rows, failed = seasons.read_seasons(spark, {1: str(tmp_path / "1"), 2: str(tmp_path / "2")})
    assert (rows.count(), failed) == (3, [1])


def test_broken_and_pretty_documents(spark, tmp_path):
    pretty = "{\"matches\": [\n {\"id\": 7, \"status\": \"FINISHED\"}\n]}"
    (tmp_path / "pretty.json").write_text(pretty)
    assert [r.match_id for r in landed.read_landed_matches(spark, str(tmp_path), multi_line=True).collect()] == [7]
    (tmp_path / "broken.json").write_text('{"matches": [{"id": ')
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|Malformed"):
        landed.read_landed_matches(spark, str(tmp_path), multi_line=True).collect()


def test_half_corrupt_season_loses_only_its_corrupt_files(spark, tmp_path):
    folder = tmp_path / "1"
    spark.range(0, 4000).repartition(2).write.parquet(str(folder))
    spark.range(0, 10).filter("id < 0").coalesce(1).write.mode("append").parquet(str(folder))  # rightly empty
    (folder / "part-x.parquet").write_text("no parquet")
    whole = sorted(folder.glob("*.parquet"), key=lambda f: f.stat().st_size)[-1]
    data = bytearray(whole.read_bytes())
    data[4 : len(data) // 2] = bytes(len(data) // 2 - 4)  # pages broken, footer whole
    whole.write_bytes(data)
    for crc in folder.glob(".*.crc"):
        crc.unlink()
    spark.range(7).write.parquet(str(tmp_path / "2"))
    rows, problems = seasons.read_seasons_reported(spark, {1: str(folder), 2: str(tmp_path / "2"), 3: str(tmp_path / "no")})
    found = {(season, file and file.rsplit("/", 1)[-1]): reason for season, file, reason in problems}
    assert found == {
        (1, "part-x.parquet"): "no Parquet file", (1, whole.name): "corrupt: not all rows can be read", (3, None): "PATH_NOT_FOUND",
    }
    assert rows.groupBy("season").count().orderBy("season").collect() == [(1, 2000), (2, 7)]


def test_broken_documents_are_told(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"matches": [{"id": 7}]}\n{"matches": [{"id": \n{"other": 1}\n')
    good, bad = landed.read_documents(spark, str(tmp_path), landed.LANDED_SCHEMA)
    assert [r.match_id for r in landed.match_rows_of(good).collect()] == [7]
    told = sorted((r["reason"], r["document"], r["file"].rsplit("/", 1)[-1]) for r in bad.collect())
    assert told == [("malformed", '{"matches": [{"id": ', "a.json"), ("no known field", None, "a.json")]


def test_standings_and_news(spark, tmp_path):
    standings = '{"standings": [{"table": [{"position": 1, "team": {"name": "A"}, "points": 9, "draw": 0}]}, {"table": []}]}'
    (tmp_path / "s.json").write_text(standings)
    row = landed.standings_of(landed.read_documents(spark, str(tmp_path / "s.json"), landed.STANDINGS_SCHEMA)[0]).first()
    assert (row["position"], row["team"], row["points"], row["drawn"], row["won"]) == (1, "A", 9, 0, None)
    items = ",".join(f'{{"title": "t{i}", "source": null, "publishedAt": "2020-01-0{i % 9 + 1}T10:00:00Z"}}' for i in range(12))
    (tmp_path / "n.json").write_text(f'{{"articles": [{items}]}}')
    news = landed.news_of(landed.read_documents(spark, str(tmp_path / "n.json"), landed.NEWS_SCHEMA)[0]).collect()
    assert [r["title"] for r in news] == [f"t{i}" for i in range(10)] and news[0]["published"] == dt.datetime(2020, 1, 1, 10)


def test_keyword_feed_breaks_ties(spark):
    rows = [("en", "Goal late", 5, c) for c in "dbac"] + [("en", "goal", 6, "z"), ("de", "goal", 9, "y"), ("en", "none", 9, "x")]
    articles = spark.createDataFrame(rows, "lang string, text string, published int, source string")
    for parts in (1, 5):
        feed = fixtures.keyword_feed(articles.repartition(parts), ["GOAL"], "en", n=3).collect()
        assert [r.source for r in feed] == ["z", "a", "b"]


def numbered(spark, n):
    return spark.range(n).withColumn("part", F.col("id") % 2)


@pytest.mark.parametrize("part", [None, "part"])
def test_a_frame_may_replace_the_table_it_reads(spark, tmp_path, part):
    root = str(tmp_path)
    first = tables.replace_table(numbered(spark, 10), "Counts", root, partition_by=part)
    second = tables.replace_table(first.filter("id >= 4"), "counts", root, partition_by=part)
    assert (first.count(), second.count()) == (10, 6)  # the old version stays for its readers
    assert tables.replace_table(second.filter("id < 0"), "counts", root, partition_by=part).count() == 0
    assert set(tables.scan_table(spark, "COUNTS", root).columns) == {"id", "part"}


def test_a_failing_write_leaves_the_old_table(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    tables.replace_table(numbered(spark, 3), "counts", root)
    broken = numbered(spark, 5).withColumn("id", F.when(F.col("id") < 4, F.col("id")).otherwise(F.raise_error(F.lit("gone")).cast("long")))
    with pytest.raises(Exception, match="gone"):
        tables.replace_table(broken, "counts", root)
    assert tables.scan_table(spark, "counts", root).count() == 3
    monkeypatch.setattr(tables, "_check", lambda *_: (_ for _ in ()).throw(tables.IncompleteWrite("counts")))
    with pytest.raises(tables.IncompleteWrite):
        tables.replace_table(numbered(spark, 5), "counts", root)
    assert tables.scan_table(spark, "counts", root).count() == 3


def test_old_versions_go_only_when_asked(spark, tmp_path):
    for n in (1, 2, 3):
        tables.replace_table(numbered(spark, n), "counts", str(tmp_path))
    assert len(list((tmp_path / "counts" / "_versions").iterdir())) == 3
    assert tables.replace_table(numbered(spark, 4), "counts", str(tmp_path), keep=2).count() == 4
    assert len(list((tmp_path / "counts" / "_versions").iterdir())) == 2


def test_a_plain_folder_becomes_a_replaced_table(spark, tmp_path):
    numbered(spark, 2).write.parquet(f"{tmp_path}/counts")
    assert tables.scan_table(spark, "counts", str(tmp_path)).count() == 2
    tables.replace_table(numbered(spark, 7), "counts", str(tmp_path))
    assert tables.scan_table(spark, "counts", str(tmp_path)).count() == 7


def test_catalog_tables_are_swapped_by_a_view(spark, tmp_path):
    name = "swap_" + tmp_path.name.replace("-", "_").lower()
    numbered(spark, 2).write.option("path", f"{tmp_path}/plain").saveAsTable(name)
    try:
        first = tables.replace_table(numbered(spark, 5), name, partition_by="part")
        assert first.count() == 5
        assert tables.replace_table(spark.table(name).filter("id > 2"), name).count() == 2
        with pytest.raises(Exception, match="gone"):
            tables.replace_table(numbered(spark, 2).withColumn("id", F.raise_error(F.lit("gone")).cast("long")), name)
        assert spark.table(name).count() == 2
    finally:
        spark.sql(f"DROP VIEW IF EXISTS {name}")
        for t in spark.catalog.listTables(pattern=f"{name}__v*"):
            spark.sql(f"DROP TABLE {t.name}")


def test_markers(spark, tmp_path):
    folder = f"{tmp_path}/ids"
    assert pointers.newest(spark, folder) is None
    assert [pointers.claim(spark, folder, {"n": i}) for i in range(3)] == [1, 2, 3]
    assert not pointers.create_only(spark, f"{folder}/000000000002", {})
    (tmp_path / "ids" / "000000000004").write_text("")  # claimed by a writer that died
    assert pointers.newest(spark, folder) == {"n": 2} and pointers.claim(spark, folder) == 5


def test_deployment_plan_falls_back_and_compares(spark):
    runs = spark.createDataFrame(
        [("a", 1, "FINISHED", 0.5, "m/1"), ("a", 2, "FINISHED", 0.7, None), ("a", 3, "RUNNING", 0.9, "m/3"),
         ("b", 4, "FINISHED", 0.6, None), ("c", 5, "FINISHED", None, "m/5"), ("d", 6, "FINISHED", 0.4, "m/6")],
        "experiment string, run_id long, status string, metric double, artifact_path string",
    )
    versions = spark.createDataFrame(
        [("a", 1, 3, "Production"), ("b", 2, 4, "Staging"), ("c", 3, 5, "Staging"), ("d", 4, 6, "Production")],
        "experiment string, version long, run_id long, stage string",
    )
    rows = {r["experiment"]: r for r in rn.deployment_plan(runs, versions).collect()}
    got = {e: (r["run_id"], r["source"], r["version"], r["production_metric"], r["promote"]) for e, r in rows.items()}
    assert got == {
        "a": (1, "run", None, 0.9, False), "b": (4, "registry", 2, None, True), "c": (5, "run", 3, None, True),
        "d": (6, "run", 4, 0.4, False),
    }
    assert rn.deployment_plan(runs.limit(0), versions).count() == 0
