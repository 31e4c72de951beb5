"""Every registered query: (spark, folder of Parquet tables) -> DataFrame.

Doubles are rounded to six places, as in the oracle SQL.
"""

import datetime as dt
from collections.abc import Callable
from functools import reduce

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from formbook.functions.columns import label_index, label_name
from formbook.functions.season import in_season, parse_season, season_label, season_start
from formbook.ml import store
from formbook.ml.packed import FIT_ROWS
from formbook.ml.samme import SammeClassifier, SammeModel, SammeParams, assemble, balanced_weights, samme_round
from formbook.ml.tuning import SearchSpace, boosting_curve as boosting_curve_of, top_trials, trial_table
from formbook.operators import fixtures as fx
from formbook.operators import leaderboard as lb
from formbook.operators import metrics as mt
from formbook.operators import quality as ql
from formbook.operators import runs as rn
from formbook.operators import split as sp
from formbook.operators.form import last_rows, team_form_latest, venue_form_latest
from formbook.operators.names import map_fixtures, unmapped
from formbook.operators.timeline import team_rows
from formbook.plans import features as ft
from formbook.plans import gameweek as gw
from formbook.plans import train as tr
from formbook.plans.dashboard import dashboard
from formbook.plans.etl import run_etl
from formbook.plans.leaderboards import analytics_snapshot, refresh_leaderboards
from formbook.plans.scoring import asof_features, scoring_features, upcoming
from formbook.registry import stumps
from formbook.schemas import (
    CLASSES, DROPPABLE_COLUMNS, FEATURES, PLAYER_STATS, RAW_STAT_COLUMNS, REQUIRED_COLUMNS, TEAM_STATS,
)
from formbook.session import new_path
from formbook.sources import landed, seasons, tables, views

FIXTURES_AS_OF = dt.datetime(2001, 7, 1)
SPLIT_AS_OF = dt.datetime(2001, 8, 1)
GATE_DAY = dt.datetime(2001, 7, 31)
SEASON = 1998
TEAM = "T07"
FEED_PHRASES = ["this is", "and the"]

Query = Callable[[SparkSession, str], DataFrame]


def rounded(df: DataFrame) -> DataFrame:
    """Doubles to six places; adding zero turns -0.0 into 0.0."""
    return df.select(
        *[
            (F.round(f.name, 6) + F.lit(0.0)).alias(f.name) if isinstance(f.dataType, T.DoubleType) else f.name
            for f in df.schema
        ]
    )


# --- sources and sinks ---------------------------------------------------------------------


def _season_files(spark: SparkSession, folder: str) -> dict[int, str]:
    """Matches landed as one folder per season; one holds a broken file too, one is empty, one never arrived."""
    path = new_path(spark, "seasons")
    extra = {c: F.lit(0) for c in DROPPABLE_COLUMNS}
    df = views.matches(spark, folder).withColumns(extra)
    df.hint("rebalance", "season").write.partitionBy("season").parquet(path)
    landed_seasons = [r["season"] for r in spark.read.parquet(path).select("season").distinct().collect()]
    last = max(landed_seasons)
    broken = spark.createDataFrame([("no Parquet",)], "value string").coalesce(1)
    broken.write.mode("append").text(f"{path}/season={min(landed_seasons)}")
    df.drop("season").limit(0).write.parquet(f"{path}/season={last + 1}")
    return {s: f"{path}/season={s}" for s in [*landed_seasons, last + 1, last + 2]}


def season_union(spark, folder):
    df, _ = seasons.read_seasons(spark, _season_files(spark, folder))
    return rounded(seasons.drop_columns(df).select("match_id", "season", *REQUIRED_COLUMNS))


def etl_summary(spark, folder):
    return run_etl(spark, _season_files(spark, folder), new_path(spark, "warehouse"))


def season_read_report(spark, folder):
    """What a read of the landed seasons left out, without the files' own names."""
    _, problems = seasons.read_seasons_reported(spark, _season_files(spark, folder))
    lines = [(season, file is not None, reason) for season, file, reason in problems]
    return spark.createDataFrame(lines, "season int, single_file boolean, reason string")


def season_coverage(spark, folder):
    return seasons.season_coverage(views.matches(spark, folder), 1992, dt.datetime(2003, 8, 15))


def scan_matches(spark, folder):
    root = new_path(spark, "warehouse")
    views.matches(spark, folder).write.parquet(f"{root}/matches")
    return rounded(tables.scan_table(spark, "matches", root))


def replace_table(spark, folder):
    """The second write replaces the first one as a whole."""
    root = new_path(spark, "warehouse")
    df = views.matches(spark, folder)
    tables.replace_table(df.filter(F.col("season") < SEASON), "Matches", root, REQUIRED_COLUMNS)
    return rounded(tables.replace_table(df, "Matches", root, REQUIRED_COLUMNS, partition_by="season"))


def analytics(spark, folder):
    root = new_path(spark, "analytics")
    names = refresh_leaderboards(views.player_stats(spark, folder), root)
    return rounded(analytics_snapshot(spark, [*names, "top_teams_fouls"], root))


def predictions_by_date(spark, folder):
    """Saved rows of the whole schedule, read back in date order."""
    rows = fx.with_match_key(views.schedule(spark, folder))
    saved = tables.replace_table(
        rows.select("home_name", "away_name", "match_date", "fixture_id"),
        "gameweek_predictions", new_path(spark, "warehouse"),
    )
    return gw.predictions_by_date(saved)


def landed_matches_json(spark, folder):
    path = new_path(spark, "landed")
    landed.as_documents(views.matches(spark, folder)).write.json(path)
    return landed.read_landed_matches(spark, path)


def landed_documents_report(spark, folder):
    """Match lists with broken documents among them: rows read, and documents left out by reason."""
    path = new_path(spark, "landed")
    landed.as_documents(views.matches(spark, folder)).write.json(path)
    wrong = ['{"matches": [{"id": ', '{"other": 1}', "no JSON"]
    spark.createDataFrame([(w,) for w in wrong], "value string").write.mode("append").text(path)
    good, bad = landed.read_documents(spark, path, landed.LANDED_SCHEMA)
    read = landed.match_rows_of(good).agg(F.count(F.lit(1)).alias("n")).select(F.lit("read").alias("what"), "n")
    return read.unionByName(bad.groupBy(F.col("reason").alias("what")).agg(F.count(F.lit(1)).alias("n")))


def landed_standings(spark, folder):
    path = new_path(spark, "landed")
    landed.as_standings(league_table(spark, folder)).write.json(path)
    return landed.standings_of(landed.read_documents(spark, path, landed.STANDINGS_SCHEMA)[0])


def landed_news(spark, folder):
    """The first ten articles of every page of a hundred."""
    path = new_path(spark, "landed")
    day = F.timestamp_add("MINUTE", F.col("published"), F.lit("2020-01-01").cast("timestamp_ntz"))
    articles = views.articles(spark, folder).select(
        F.col("published").alias("id"), day.alias("published"), F.substring("text", 1, 80).alias("title"), "source"
    )
    landed.as_news(articles).write.json(path)
    return landed.news_of(landed.read_documents(spark, path, landed.NEWS_SCHEMA)[0]).select("place", "title", "source", "published")


def dashboard_bundle(spark, folder):
    """Rows of every part of the dashboard, and the matchweeks' numbers."""
    parts = dashboard(views.matches(spark, folder), SEASON, views.articles(spark, folder), FEED_PHRASES)
    weeks = parts.pop("metadata")
    counts = [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(n).alias("part"), "rows") for n, df in parts.items()]
    numbers = [weeks.select(n).scalar().alias(n) for n in ("next_mw", "prev_mw")]
    return reduce(DataFrame.unionByName, counts).select("part", "rows", *numbers)


def records_json(spark, folder):
    df = views.matches(spark, folder).select(
        "match_id", "date", "home_team", "away_team", "home_goals", "away_goals",
        F.lower("status").alias("status"),
    )
    return tables.records_json(df)


# --- filters, projections, contracts -------------------------------------------------------


def drop_columns(spark, folder):
    df = views.matches(spark, folder).withColumns({c: F.lit(0) for c in DROPPABLE_COLUMNS[:5]})
    return rounded(seasons.drop_columns(df))


def match_result(spark, folder):
    df = ft.basic_features(views.matches(spark, folder))
    return df.select("match_id", "home_goals", "away_goals", "result")


def goals_conceded(spark, folder):
    df = ft.basic_features(views.matches(spark, folder))
    return df.select("match_id", "home_goals_conceded", "away_goals_conceded")


def season_of_match(spark, folder):
    start = season_start(F.col("date"))
    df = views.matches(spark, folder).select("match_id", start.alias("season"), season_label(start).alias("label"))
    return df.withColumn("parsed", parse_season(F.col("label")))


def matches_by_season(spark, folder):
    return rounded(seasons.matches_by_season(views.matches(spark, folder), SEASON))


def matches_by_team(spark, folder):
    return rounded(seasons.matches_by_team(views.matches(spark, folder), TEAM))


def null_rows_dropped(spark, folder):
    return rounded(views.matches(spark, folder).dropna(subset=["home_goals", "away_goals"]))


def model_input_columns(spark, folder):
    return rounded(ft.match_features(views.matches(spark, folder)).drop(*RAW_STAT_COLUMNS))


def temporal_split(spark, folder):
    df = views.matches(spark, folder).select("match_id", "date")
    return sp.split_label(df, sp.cutoff_for(SPLIT_AS_OF))


def split_ranges(spark, folder):
    return sp.split_ranges(temporal_split(spark, folder))


def time_series_folds(spark, folder):
    df = views.matches(spark, folder).select("match_id", "date")
    return sp.time_series_folds(df, rows_per_chunk=5000).select("match_id", "position", "fold")


def keyword_feed(spark, folder):
    return fx.keyword_feed(views.articles(spark, folder), FEED_PHRASES, "en")


def matchweek_window(spark, folder):
    return rounded(fx.matchweek_window(views.matches(spark, folder)))


def run_artifact_path(spark, folder):
    """The event's ``k`` as the path of the first entry of a run's history tag."""
    events = views.table(spark, folder, "events")
    name = F.concat(F.lit("model_"), F.get_json_object("props", "$.k"))
    tag = (
        F.when(F.col("event_type") == "error", F.lit("{broken"))
        .when(F.col("event_type") == "view", F.lit("[]"))
        .when(F.col("event_type") == "signup", F.lit('[{"run_id": "r"}]'))
        .when(F.col("event_type") == "click", F.concat(F.lit('[{"artifact_path": "plot"}, {"artifact_path": "'), name, F.lit('"}]')))
        .otherwise(F.concat(F.lit('[{"artifact_path": "'), name, F.lit('"}]')))
    )
    path = rn.artifact_path(tag)
    return events.select("event_id", path.alias("artifact_path"), rn.is_model_artifact(path).alias("is_model"))


# --- features ------------------------------------------------------------------------------


def team_timeline(spark, folder):
    return rounded(team_rows(views.matches(spark, folder)))


def _stage(name: str, columns: list[str], mode: str = "cascaded") -> Query:
    def run(spark, folder):
        stage = ft.feature_stages(views.matches(spark, folder), mode)[name]
        return rounded(stage.select("match_id", *columns))

    return run


def match_features(spark, folder):
    return rounded(ft.match_features(views.matches(spark, folder)).select("match_id", "result", *FEATURES))


def match_features_chunked(spark, folder):
    """The same over time chunks, as used for large tables."""
    df = ft.match_features(views.matches(spark, folder), rows_per_chunk=4000)
    return rounded(df.select("match_id", "result", *FEATURES))


def match_features_single_pass(spark, folder):
    df = ft.match_features(views.matches(spark, folder), "single_pass")
    return rounded(df.select("match_id", "result", *FEATURES))


def row_audit(spark, folder):
    features, audit = ft.audited_features(views.matches(spark, folder))
    features.write.format("noop").mode("overwrite").save()
    return audit()


def row_audit_chunked(spark, folder):
    """The same over time chunks, whose stages are counted as they are checkpointed."""
    features, audit = ft.audited_features(views.matches(spark, folder), rows_per_chunk=4000)
    features.write.format("noop").mode("overwrite").save()
    return audit()


# --- scoring -------------------------------------------------------------------------------


def gameweek_fixtures(spark, folder):
    return fx.with_match_key(fx.gameweek(views.schedule(spark, folder), FIXTURES_AS_OF))


def alias_mapped(spark, folder):
    return map_fixtures(views.schedule(spark, folder), views.aliases(spark, folder))


def unmapped_fixtures(spark, folder):
    return unmapped(alias_mapped(spark, folder))


def _last(side: str | None) -> Query:
    def run(spark, folder):
        return rounded(last_rows(views.matches(spark, folder), side))

    return run


def latest_form(spark, folder):
    return rounded(team_form_latest(views.matches(spark, folder).filter(in_season(F.col("date"), 2000))))


def latest_venue_form(spark, folder):
    return rounded(venue_form_latest(views.matches(spark, folder).filter(in_season(F.col("date"), 2000))))


def scoring(spark, folder):
    games = upcoming(views.schedule(spark, folder), views.aliases(spark, folder), FIXTURES_AS_OF)
    return rounded(scoring_features(games, views.matches(spark, folder), FIXTURES_AS_OF).drop("match_key", "match_date"))


def form_asof(spark, folder):
    return rounded(asof_features(alias_mapped(spark, folder), views.matches(spark, folder)))


def form_asof_chunked(spark, folder):
    return rounded(asof_features(alias_mapped(spark, folder), views.matches(spark, folder), rows_per_chunk=8000))


# --- leaderboards --------------------------------------------------------------------------


def player_season_stats(spark, folder):
    return rounded(views.player_stats(spark, folder))


def _players(stat: str) -> Query:
    return lambda spark, folder: lb.top_players(views.player_stats(spark, folder), stat)


def _teams(stat: str) -> Query:
    return lambda spark, folder: lb.top_teams(views.player_stats(spark, folder), stat)


def created_chances(spark, folder):
    return rounded(lb.top_teams_created_chances(views.player_stats(spark, folder)))


def leaderboards_all(spark, folder):
    return rounded(lb.leaderboards_all(views.player_stats(spark, folder)))


def league_table(spark, folder):
    return lb.league_table(views.matches(spark, folder).filter(in_season(F.col("date"), SEASON)))


def distinct_teams(spark, folder):
    return team_rows(views.matches(spark, folder), {}, []).select("team").distinct().orderBy("team")


def result_distribution(spark, folder):
    return ql.result_distribution(ft.basic_features(views.matches(spark, folder)))


# --- metrics -------------------------------------------------------------------------------


def _metric(build) -> Query:
    return lambda spark, folder: rounded(build(views.predictions(spark, folder)))


def label_domain_check(spark, folder):
    """The class labels of the predictions, next to raw codes that are no class."""
    known = views.predictions(spark, folder).select(F.col("y_pred").alias("label"))
    raw = views.table(spark, folder, "lineitem").select(F.col("l_returnflag").alias("label"))
    return mt.label_domain_check(known.unionByName(raw), "label")


def label_encoded(spark, folder):
    df = ft.basic_features(views.matches(spark, folder))
    return df.select("match_id", "result", label_index(F.col("result")).cast("int").alias("label"))


def weights(spark, folder):
    return rounded(balanced_weights(ft.basic_features(views.matches(spark, folder))))


def _round(pred: str) -> Query:
    return lambda spark, folder: rounded(samme_round(views.predictions(spark, folder), "y_true", pred, "w"))


# --- runs, quality -------------------------------------------------------------------------


def best_run(spark, folder):
    return rn.best_run(views.model_runs(spark, folder))


def best_run_with_artifact(spark, folder):
    """Among the first twenty runs, only those that reached a stage kept their model."""
    runs = views.model_runs(spark, folder)
    return rn.best_run(runs.withColumn("artifact_path", F.when(F.col("stage").isNotNull(), F.lit("model"))))


def best_registered_run(spark, folder):
    runs = views.model_runs(spark, folder)
    return rn.best_registered_run(runs, runs.filter(F.col("stage").isNotNull()))


def promotion_decision(spark, folder):
    return rn.promotion_decision(views.model_runs(spark, folder))


def _on_matches(build, *args) -> Query:
    return lambda spark, folder: build(views.matches(spark, folder), *args)


def join_key_duplicates(spark, folder):
    """By calendar day, on which a team does play more than once."""
    day = F.date_trunc("day", F.col("date")).cast("timestamp_ntz")
    return ql.join_key_duplicates(views.matches(spark, folder).withColumn("date", day))


def retrain_gate(spark, folder):
    df = views.matches(spark, folder)
    return ql.retrain_gate(df, df.filter(F.col("date") < F.lit(GATE_DAY.isoformat()).cast("timestamp_ntz")))


# --- model ---------------------------------------------------------------------------------

_stump_runs: dict[tuple[str, str], tr.Trained] = {}


def _stumps(spark: SparkSession, folder: str) -> tr.Trained:
    """The whole training on two features of three values, with trees of one split, which SQL can follow."""
    key = (spark.sparkContext.applicationId, folder)
    if key not in _stump_runs:
        _stump_runs[key] = tr.train_on(
            views.goal_rows(spark, folder), SPLIT_AS_OF, stumps.SPACE, stumps.TRIALS, stumps.FOLDS,
            features=views.GOAL_FEATURES, tally=True,
        )
    return _stump_runs[key]


def stump_rounds(spark, folder):
    """Split, error and say of each tree; no split where both sides vote alike."""
    model = _stumps(spark, folder).model
    lines = []
    for i, (tree, error, alpha) in enumerate(zip(model.trees, model.errors, model.alphas)):
        cut = tree.feature[0] >= 0
        name = model.features[tree.feature[0]] if cut else None
        lines.append((i, name, tree.threshold[0] if cut else None, error, alpha))
    return rounded(spark.createDataFrame(lines, "round int, feature string, threshold double, error double, alpha double"))


def stump_predictions(spark, folder):
    """Test rows scored by the staged model, read back from the model store."""
    root, run = new_path(spark, "warehouse"), _stumps(spark, folder)
    run_id = store.new_run(spark, root)
    run.model.save(spark, store.model_path(root, run_id))
    store.set_stage(spark, root, "Production", run_id, store.register(spark, root, run_id))
    model, _ = store.load_stage(spark, root, "Production")
    judged = model.transform(assemble(run.test, model.features))
    chances = [F.col("probabilities")[i].alias(f"prob_{c.lower()}") for i, c in enumerate(CLASSES)]
    return rounded(judged.select("match_id", "result", "predicted_label", *chances))


# Small budget for the training jobs; ``_trained`` runs the full one, the library's defaults.
SPACE = SearchSpace(n_estimators=(2, 4), max_depth=(7, 10), max_features=(None,), learning_rate=(0.2, 0.5))
_runs: dict[tuple[str, str], tr.Trained] = {}


def _trained(spark: SparkSession, folder: str) -> tr.Trained:
    """One training run, with the whole search, per application and folder, shared by the queries below."""
    key = (spark.sparkContext.applicationId, folder)
    if key not in _runs:
        _runs[key] = tr.run_training(views.matches(spark, folder), SPLIT_AS_OF, fit_rows=FIT_ROWS)
    return _runs[key]


def _predictions(spark, folder):
    return gw.gameweek_predictions(
        views.schedule(spark, folder), views.matches(spark, folder), views.aliases(spark, folder),
        _trained(spark, folder).model, FIXTURES_AS_OF,
    )


def _importances(spark, folder):
    return tr.importance_table(spark, _trained(spark, folder).model)


def assembled(spark, folder):
    """The feature vectors, one row per entry."""
    df = assemble(ft.match_features(views.matches(spark, folder)))
    entries = F.posexplode(vector_to_array("features")).alias("position", "value")
    return rounded(df.select("match_id", F.col("label").cast("int").alias("label"), entries))


def samme_fit(spark, folder):
    """Rounds of a fit on all featured matches: error and say of each tree."""
    rows = assemble(ft.match_features(views.matches(spark, folder)))
    model = SammeClassifier(SammeParams(n_estimators=3, max_depth=8, learning_rate=0.5)).fit_any(rows)
    lines = [(i, e, a) for i, (e, a) in enumerate(zip(model.errors, model.alphas))]
    return spark.createDataFrame(lines, "round int, error double, alpha double")


def evaluate_model(spark, folder):
    return tr.evaluation(_trained(spark, folder))


def class_probabilities(spark, folder):
    """Percentages by class name, as rows, and the predicted class's."""
    games = gw.class_probabilities(views.scored_fixtures(spark, folder))
    percents = F.explode("class_probabilities").alias("label", "percent")
    return games.select("fixture_id", "predicted_label", "confidence", percents)


def _scored(spark, folder):
    return gw.as_predictions(views.scored_fixtures(spark, folder))


def top_search_trials(spark, folder):
    return rounded(top_trials(trial_table(views.trial_scores(spark, folder))))


def generalisation_gap(spark, folder):
    """Each trial's cross-validation accuracy against the accuracy over all its rows' even folds."""
    scores = views.trial_scores(spark, folder)
    test = scores.filter(F.col("fold") % 2 == 0).groupBy("trial").agg(F.avg("test_accuracy").alias("test_score"))
    trials = trial_table(scores).select("trial", F.col("mean_test_accuracy").alias("cv_score"))
    return rounded(mt.generalisation_gap(trials.join(test, "trial")))


def _importance_rows(spark, folder):
    return tr.ranked_importances(views.importances(spark, folder))


def _saved(name: str) -> Query:
    """Both tables of a gameweek, saved together and read back."""

    def run(spark, folder):
        root = new_path(spark, "warehouse")
        gw.save_gameweek(_scored(spark, folder), _importance_rows(spark, folder), FIXTURES_AS_OF, root)
        return tables.scan_table(spark, name, root)

    return run


def importance_read(spark, folder):
    """All importances of a saved table, largest first, after a later run has replaced an earlier one's."""
    root, rows = new_path(spark, "warehouse"), views.importances(spark, folder)
    tables.replace_table(rows.filter("position < 5"), "feature_importance", root)
    tables.replace_table(rows, "feature_importance", root)
    return rounded(tr.ranked_importances(tables.scan_table(spark, "feature_importance", root)))


def prediction_sample(spark, folder):
    """First 50 judged rows, from the evaluation files; every third match is called right."""
    judged = assemble(ft.match_features(views.matches(spark, folder)))
    guess = F.when(F.col("match_id") % 3 == 0, F.col("label")).otherwise((F.col("label") + 1) % 3)
    judged = judged.withColumn("prediction", guess).withColumn("predicted_label", label_name(F.col("prediction")))
    path = new_path(spark, "evaluation")
    tr.write_report(judged, _importance_rows(spark, folder), FEATURES, path)
    schema = tr.prediction_sample(judged).schema
    return rounded(spark.read.schema(schema).csv(f"{path}/test_sample_predictions", header=True))


def boosting_curve(spark, folder):
    """Test scores of the model's first 1, 2, ... trees."""
    run = _trained(spark, folder)
    return rounded(boosting_curve_of(run.model, assemble(run.test)))


def deployment_plan(spark, folder):
    """Runs that reached a stage kept their model, but for those of one experiment, which the registry knows."""
    runs = views.model_runs(spark, folder)
    kept = F.when(F.col("stage").isNotNull() & (F.col("experiment") != "5-LOW"), F.lit("model"))
    versions = runs.filter(F.col("stage").isNotNull()).select("experiment", "version", "run_id", "stage")
    return rn.deployment_plan(runs.withColumn("artifact_path", kept), versions)


def gameweek_job(spark, folder):
    """The whole job over saved tables and a staged model: status and rows of each step."""
    root = new_path(spark, "warehouse")
    run, run_id = _trained(spark, folder), store.new_run(spark, root)
    run.model.save(spark, store.model_path(root, run_id))
    store.set_stage(spark, root, "Production", run_id, store.register(spark, root, run_id))
    for name, df in (("fixtures", views.schedule), ("matches", views.matches), ("aliases", views.aliases)):
        tables.replace_table(df(spark, folder), name, root)
    return gw.gameweek_job(spark, root, FIXTURES_AS_OF).drop("message")


def train_job_deployment(spark, folder):
    """Two training jobs over one store: ids, what was deployed and how each part ended."""
    root = new_path(spark, "training")
    space = SearchSpace(n_estimators=(1, 2), max_depth=(7, 8), max_features=(None,))
    done = [
        tr.train_job(spark, views.matches(spark, folder), SPLIT_AS_OF, root, space=space, trials=1, folds=2)
        for _ in range(2)
    ]
    columns = ["status", "run_id", "train_rows", "test_rows", "evaluation", "deployment", "deployed_run", "version", "promoted"]
    return done[0].unionByName(done[1]).select(*columns)


def model_roundtrip(spark, folder):
    """Test rows on which the reloaded model disagrees with the saved one, by result."""
    run = _trained(spark, folder)
    path = new_path(spark, "models/Production")
    run.model.save(spark, path)
    again = SammeModel.load(spark, path).transform(assemble(run.test).select("match_id", "features"))
    both = run.judged().select("match_id", "result", F.col("probabilities").alias("kept")).join(
        again.select("match_id", "probabilities"), "match_id"
    )
    differs = F.count(F.when(F.col("kept") != F.col("probabilities"), 1)).alias("different")
    return both.groupBy("result").agg(F.count(F.lit(1)).alias("rows"), differs)


def train_job_summary(spark, folder):
    return tr.train_job(
        spark, views.matches(spark, folder), SPLIT_AS_OF, new_path(spark, "training"), space=SPACE, trials=1, folds=2
    )


QUERIES: dict[str, Query] = {
    # sources, sinks
    "season_union": season_union,
    "season_read_report": season_read_report,
    "season_coverage": season_coverage,
    "player_season_stats": player_season_stats,
    "scan_matches": scan_matches,
    "replace_table": replace_table,
    "analytics_snapshot": analytics,
    "predictions_by_date": predictions_by_date,
    "landed_matches_json": landed_matches_json,
    "landed_documents_report": landed_documents_report,
    "landed_standings": landed_standings,
    "landed_news": landed_news,
    "dashboard_bundle": dashboard_bundle,
    "records_json": records_json,
    "etl_summary": etl_summary,
    # projections, filters, contracts
    "drop_columns": drop_columns,
    "column_contract": _on_matches(ql.column_contract),
    "match_result": match_result,
    "goals_conceded": goals_conceded,
    "model_input_columns": model_input_columns,
    "season_of_match": season_of_match,
    "matches_by_season": matches_by_season,
    "matches_by_team": matches_by_team,
    "null_rows_dropped": null_rows_dropped,
    "temporal_split": temporal_split,
    "split_ranges": split_ranges,
    "time_series_folds": time_series_folds,
    "matchweek_window": matchweek_window,
    "keyword_feed": keyword_feed,
    "run_artifact_path": run_artifact_path,
    # features
    "team_timeline": team_timeline,
    "rolling_form": _stage("rolling_averages", FEATURES[:10]),
    "points_last5": _stage("points_last5", FEATURES[10:12]),
    "venue_form": _stage("derived_features", FEATURES[12:18] + ["home_venue_advantage"]),
    "derived_features": _stage("derived_features", FEATURES[18:25] + ["home_advantage"]),
    "match_features": match_features,
    "match_features_chunked": match_features_chunked,
    "match_features_single_pass": match_features_single_pass,
    "row_audit": row_audit,
    "row_audit_chunked": row_audit_chunked,
    "result_distribution": result_distribution,
    # scoring
    "gameweek_fixtures": gameweek_fixtures,
    "alias_mapped": alias_mapped,
    "unmapped_fixtures": unmapped_fixtures,
    "last5_all": _last(None),
    "last5_home": _last("home"),
    "last5_away": _last("away"),
    "team_form_latest": latest_form,
    "venue_form_latest": latest_venue_form,
    "scoring_features": scoring,
    "form_asof": form_asof,
    "form_asof_chunked": form_asof_chunked,
    # leaderboards
    **{f"top_players_{s}": _players(s) for s in PLAYER_STATS},
    **{f"top_teams_{s}": _teams(s) for s in TEAM_STATS},
    "top_teams_created_chances": created_chances,
    "leaderboards_all": leaderboards_all,
    "league_table": league_table,
    "distinct_teams": distinct_teams,
    # metrics
    "classification_metrics": _metric(mt.classification_metrics),
    "per_class_metrics": _metric(mt.per_class_metrics),
    "macro_f1": _metric(mt.macro_f1),
    "confusion_matrix": _metric(mt.confusion_matrix),
    "classification_report": _metric(mt.classification_report),
    "label_domain_check": label_domain_check,
    # runs, quality
    "best_run": best_run,
    "best_run_with_artifact": best_run_with_artifact,
    "best_registered_run": best_registered_run,
    "promotion_decision": promotion_decision,
    "join_key_duplicates": join_key_duplicates,
    "quality_report": _on_matches(ql.quality_report),
    "freshness": _on_matches(ql.freshness, SPLIT_AS_OF),
    "retrain_gate": retrain_gate,
    "table_profile": _on_matches(ql.table_profile),
    # model
    "label_encoded": label_encoded,
    "balanced_weights": weights,
    "samme_round": _round("y_pred_weak"),
    "samme_round_at_chance": _round("y_pred"),
    "assembled": assembled,
    "stump_rows": views.goal_rows,
    "stump_rounds": stump_rounds,
    "stump_cv_scores": lambda spark, folder: rounded(_stumps(spark, folder).scores),
    "stump_search_trials": lambda spark, folder: rounded(_stumps(spark, folder).trials),
    "stump_params": lambda spark, folder: tr.parameter_record(spark, _stumps(spark, folder)),
    "stump_importances": lambda spark, folder: rounded(tr.importance_table(spark, _stumps(spark, folder).model)),
    "stump_evaluation": lambda spark, folder: rounded(tr.evaluation(_stumps(spark, folder))),
    "stump_predictions": stump_predictions,
    "samme_fit": samme_fit,
    "cv_scores": lambda spark, folder: _trained(spark, folder).scores,
    "random_search_trials": lambda spark, folder: _trained(spark, folder).trials,
    "top_trials": top_search_trials,
    "boosting_curve": boosting_curve,
    "final_model_params": lambda spark, folder: tr.parameter_record(spark, _trained(spark, folder)),
    "evaluate_model": evaluate_model,
    "class_probabilities": class_probabilities,
    "generalisation_gap": generalisation_gap,
    "model_importances": _importances,
    "all_feature_importance": lambda spark, folder: rounded(_importance_rows(spark, folder)),
    "top_feature_importance": lambda spark, folder: tr.top_importances(_importance_rows(spark, folder)),
    "gameweek_predictions": _predictions,
    "predictions_flat": lambda spark, folder: gw.predictions_flat(_scored(spark, folder)),
    "prediction_summary": lambda spark, folder: gw.prediction_summary(_scored(spark, folder)),
    "predictions_saved": _saved("gameweek_predictions"),
    "importance_saved": _saved("feature_importance"),
    "feature_importance_read": importance_read,
    "gameweek_job": gameweek_job,
    "deployment_plan": deployment_plan,
    "train_job_deployment": train_job_deployment,
    "prediction_sample": prediction_sample,
    "model_roundtrip": model_roundtrip,
    "train_job_summary": train_job_summary,
}
