import random
import time
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace
from datetime import datetime, timedelta

import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import functions as F
from rows import MATCH_SCHEMA, START, match

from formbook.ml import samme, store, trees, tuning
from formbook.ml.estimator import BoostedTrees
from formbook.ml.samme import SammeClassifier, SammeModel, SammeParams, WorseThanChance, assemble, balanced_weights
from formbook.ml.tuning import SearchSpace, best_params, cv_scores, top_trials, trial_table
from formbook.operators.metrics import classification_metrics
from formbook.plans import train
from formbook.plans.gameweek import class_probabilities, gameweek_job, prediction_summary, predictions_flat, score
from formbook.plans.train import importance_table, top_importances
from formbook.schemas import CLASSES, FEATURES, RUN_SCHEMA
from formbook.sources import tables, views


def rows(n, noise, seed=0):
    """The result follows the points difference, up to ``noise``.

    It has few distinct values, so that a binned split can separate them exactly.
    """
    pick = random.Random(seed)
    out = []
    for i in range(n):
        values = [pick.random() for _ in FEATURES]
        d = values[FEATURES.index("points_diff_last5")] = pick.randrange(20) / 20
        result = "Win" if d > 0.66 else "Draw" if d > 0.33 else "Lose"
        if pick.random() < noise:
            result = pick.choice(CLASSES)
        out.append((i, result, *values))
    return out


@pytest.fixture(scope="module")
def frame(spark):
    schema = "match_id long, result string, " + ", ".join(f"{f} double" for f in FEATURES)

    def build(n, noise, seed=0):
        df = spark.createDataFrame(rows(n, noise, seed), schema)
        day = F.expr("timestampadd(DAY, cast(match_id as int), timestamp_ntz'2000-01-01')")
        return df.withColumn("date", day)

    return build


def accuracy(model, df):
    return classification_metrics(model.transform(df), "result", "predicted_label").first()["accuracy"]


def test_separable_data_is_learnt(frame):
    df = assemble(frame(300, 0.0))
    model = SammeClassifier(SammeParams(n_estimators=5, max_depth=2)).fit(df)
    assert accuracy(model, df) == 1.0
    assert len(model.alphas) == 1  # a perfect tree ends the boosting
    best = max(model.importances(), key=lambda x: x[1])
    assert best[0] == "points_diff_last5"


def test_boosting_helps_and_is_repeatable(frame, spark):
    df = assemble(frame(400, 0.15)).cache()
    params = SammeParams(n_estimators=6, max_depth=1, learning_rate=0.5)
    model = SammeClassifier(params, checkpoint_every=2).fit(df)
    single = SammeClassifier(SammeParams(n_estimators=1, max_depth=1)).fit(df)
    assert len(model.alphas) == 6
    assert accuracy(model, df) > accuracy(single, df) + 0.1
    again = SammeClassifier(params, checkpoint_every=100).fit(df)
    assert again.alphas == pytest.approx(model.alphas)


def test_probabilities(frame):
    df = assemble(frame(300, 0.1))
    model = SammeClassifier(SammeParams(n_estimators=3, max_depth=1, learning_rate=0.5)).fit(df)
    out = class_probabilities(model.transform(df))
    total = F.aggregate("probabilities", F.lit(0.0), lambda a, x: a + x)
    assert out.filter(F.abs(total - 1) > 1e-9).count() == 0
    best = F.array_max(F.map_values("class_probabilities"))
    assert out.filter(F.col("confidence") < best - 0.1001).count() == 0


def test_roundtrip(frame, spark, tmp_path):
    df = assemble(frame(200, 0.1))
    model = SammeClassifier(SammeParams(n_estimators=2, max_depth=2, learning_rate=0.5)).fit(df)
    model.save(spark, str(tmp_path))
    again = SammeModel.load(spark, str(tmp_path))
    assert again.alphas == model.alphas and again.params == model.params
    assert again.transform(df).select("probabilities").collect() == model.transform(df).select("probabilities").collect()


def test_worse_than_chance(spark, frame):
    """Equal features everywhere: no tree can beat the balanced classes."""
    df = frame(90, 0.0).withColumns({f: F.lit(1.0) for f in FEATURES})
    df = df.withColumn("result", F.element_at(F.array(*map(F.lit, CLASSES)), (F.col("match_id") % 3 + 1).cast("int")))
    with pytest.raises(WorseThanChance):
        SammeClassifier(SammeParams(n_estimators=2)).fit(assemble(df))


def test_training_ends_without_a_boostable_tree(spark, frame, tmp_path):
    """Equal features everywhere: the search's best trial cannot be boosted on all training rows, and the job goes on."""
    df = frame(90, 0.0).withColumns({f: F.lit(1.0) for f in FEATURES})
    df = df.withColumn("result", F.element_at(F.array(*map(F.lit, CLASSES)), (F.col("match_id") % 3 + 1).cast("int")))
    space = SearchSpace(n_estimators=(3, 4), max_depth=(2, 3), max_features=(None,))
    run = train.train_on(df, datetime(2000, 1, 1) + timedelta(days=74), space, trials=1, folds=2, weeks=2)  # 60 rows, 20 a class
    assert not run.model.boosted and len(run.model.trees) == 1 and run.model.errors == [pytest.approx(2 / 3)]
    assert train.evaluation(run).first()["accuracy"] == pytest.approx(1 / 3)
    record = {r["name"]: r["value"] for r in train.parameter_record(spark, run).collect()}
    assert (record["n_estimators"], record["rounds_kept"]) == ("3", "0")
    run.model.save(spark, str(tmp_path))
    again = SammeModel.load(spark, str(tmp_path))
    assert not again.boosted and {r["predicted_label"] for r in again.transform(assemble(run.test)).collect()} < set(CLASSES)
    run.release()


def test_balanced_weights(frame):
    weights = {r["label"]: r for r in balanced_weights(frame(300, 0.0)).collect()}
    assert sum(r["n"] * r["weight"] for r in weights.values()) == pytest.approx(300)


def test_search_space():
    draws = SearchSpace().draw(200, 42)
    assert draws == SearchSpace().draw(200, 42)
    assert {d.max_depth for d in draws} == set(range(2, 10))
    assert all(100 <= d.n_estimators < 600 and 0.01 <= d.learning_rate < 0.5 for d in draws)
    assert {d.max_features for d in draws} == {"sqrt", "log2", None}
    assert SammeParams(min_samples_leaf=3, min_samples_split=10).min_instances_per_node == 5


def test_search(frame):
    space = SearchSpace(n_estimators=(1, 3), max_depth=(1, 4), max_features=(None,))
    scores = cv_scores(frame(120, 0.1), space, trials=2, folds=2)
    assert scores.count() == 4
    trials = trial_table(scores)
    best = top_trials(trials).collect()
    assert [r["mean_test_score"] for r in best] == sorted((r["mean_test_score"] for r in best), reverse=True)
    assert best_params(trials).max_depth == best[0]["max_depth"]


def test_gameweek_scores(frame, spark):
    df = frame(200, 0.1)
    model = SammeClassifier(SammeParams(n_estimators=2, max_depth=2, learning_rate=0.5)).fit(assemble(df))
    names = {c: F.lit("x") for c in ("match_key", "home_name", "away_name", "home_team", "away_team", "match_date")}
    status = F.when(F.col("match_id") == 0, "SKIPPED").otherwise("OK")
    games = df.filter("match_id < 5").drop("result").withColumns({**names, "status": status})
    games = games.withColumn(FEATURES[0], F.when(F.col("match_id") != 1, F.col(FEATURES[0])))
    out = score(games, model)
    assert sorted(r[0] for r in out.select("predicted_result").collect() if r[0] in ("ERROR", "SKIPPED")) == ["ERROR", "SKIPPED"]
    summary = prediction_summary(out).first()
    assert (summary["total"], summary["predicted"]) == (5, 3)
    flat = predictions_flat(out)
    assert flat.count() == 3 and {"prob_draw", "prob_lose", "prob_win"} <= set(flat.columns)
    top = top_importances(importance_table(spark, model)).collect()
    assert len(top) == 8 and top[0]["importance"] >= top[-1]["importance"]


SPACE = SearchSpace(n_estimators=(1, 2), max_depth=(5, 6), max_features=(None,))
AS_OF = datetime(2001, 8, 1)


def test_train_job_promotes_only_a_better_model(spark, small, tmp_path):
    root, matches = str(tmp_path), views.matches(spark, small).dropna(subset=["home_goals"])
    first, second = (train.train_job(spark, matches, AS_OF, root, space=SPACE, trials=1, folds=2).first() for _ in range(2))
    assert first["promoted"] and not second["promoted"]  # the second one only equals it, and the first stays the best
    assert (first["run_id"], second["run_id"]) == (1, 2)
    assert [(r["deployed_run"], r["version"]) for r in (first, second)] == [(1, 1), (1, 1)]
    assert {r["evaluation"] for r in (first, second)} == {r["deployment"] for r in (first, second)} == {"SUCCESS"}
    stages = [(r["run_id"], r["stage"]) for r in train.recorded_versions(spark, root).orderBy("run_id", "stage").collect()]
    assert stages == [(1, "Production"), (1, "Staging")]
    assert [r["run_id"] for r in train.recorded_runs(spark, root).orderBy("run_id").collect()] == [1, 2]
    report = spark.read.csv(f"{tmp_path}/runs/2/classification_report", header=True)
    assert {"Draw", "Lose", "Win", "accuracy", "macro avg", "weighted avg"} == {r["label"] for r in report.collect()}
    record = {r["name"]: r["value"] for r in spark.read.csv(f"{tmp_path}/runs/2/parameters", header=True).collect()}
    assert (record["n_iter_search"], record["cv_folds"], record["model_name"]) == ("1", "2", "match_result")
    model, held = store.load_stage(spark, root)
    assert model.features == FEATURES and (held["run_id"], held["version"], held["stage"]) == (1, 1, "Production")


def test_errors_after_the_fit_end_in_the_status(spark, small, tmp_path, monkeypatch):
    def broken(*args, **kwargs):
        raise OSError("no room")

    monkeypatch.setattr(train, "write_report", broken)
    matches = views.matches(spark, small).dropna(subset=["home_goals"])
    done = train.train_job(spark, matches, AS_OF, str(tmp_path), space=SPACE, trials=1, folds=2, weeks=4).first()
    assert done["evaluation"] == "FAILED: OSError: no room" and done["accuracy"] is None
    assert done["deployment"] == "SUCCESS" and done["promoted"]  # nothing is in production yet
    row = train.recorded_runs(spark, str(tmp_path)).first()
    assert row["metric"] is None and row["test_from"] == AS_OF - timedelta(weeks=4)
    monkeypatch.setattr(store, "register", broken)
    again = train.train_job(spark, matches, AS_OF, str(tmp_path), space=SPACE, trials=1, folds=2).first()
    assert again["deployment"] == "FAILED: OSError: no room" and again["promoted"] is None and again["run_id"] == 2


def test_train_job_ends_without_a_boostable_tree(spark, tmp_path):
    """Trees of one leaf over as many wins as draws and losses: the job evaluates, records and deploys that leaf."""
    games = [match(i, "A", "B", int(i % 3 == 0), int(i % 3 == 2)) for i in range(105)]  # the first 15 lack form
    space = SearchSpace(n_estimators=(2, 3), max_depth=(2, 3), min_samples_leaf=(1000, 1001), max_features=(None,))
    as_of = START + timedelta(days=104)
    done = train.train_job(
        spark, spark.createDataFrame(games, MATCH_SCHEMA), as_of, str(tmp_path), space=space, trials=1, folds=2, weeks=2
    ).first()
    assert (done["train_rows"], done["test_rows"], done["accuracy"]) == (75, 15, pytest.approx(1 / 3))
    assert (done["status"], done["evaluation"], done["deployment"], done["promoted"]) == ("SUCCESS", "SUCCESS", "SUCCESS", True)
    model, _ = store.load_stage(spark, str(tmp_path))
    assert not model.boosted and model.errors == [pytest.approx(2 / 3)]


def test_deploy_picks_the_best_run_not_the_newest(spark, frame, tmp_path):
    root = str(tmp_path)
    with pytest.raises(train.NothingToDeploy):
        train.deploy(spark, root, AS_OF)
    model = SammeClassifier(SammeParams(n_estimators=1, max_depth=1)).fit(assemble(frame(90, 0.1)))
    for metric in (0.5, 0.7, 0.6, None):
        run_id = store.new_run(spark, root)
        model.save(spark, store.model_path(root, run_id))
        line = (train.EXPERIMENT, run_id, "FINISHED", metric, metric, AS_OF, AS_OF, store.model_path(root, run_id))
        spark.createDataFrame([line], RUN_SCHEMA).write.mode("append").parquet(f"{root}/{train.RUNS_TABLE}")
    assert train.deploy(spark, root, AS_OF) == {"deployed_run": 2, "version": 1, "promoted": True}
    assert train.deploy(spark, root, AS_OF) == {"deployed_run": 2, "version": 1, "promoted": False}
    assert store.stage_metadata(spark, root, "Production")["run_id"] == 2
    assert store.register(spark, root, 2) == 1 and store.register(spark, root, 3) == 2
    with pytest.raises(store.NoModel):
        store.load_stage(spark, root, "Archive")


def test_run_ids_are_claimed_once(spark, tmp_path):
    with ThreadPoolExecutor(8) as pool:
        ids = list(pool.map(lambda _: store.new_run(spark, str(tmp_path)), range(24)))
    assert sorted(ids) == list(range(1, 25))


def test_a_stage_is_one_whole_model_during_a_save(spark, frame, tmp_path):
    root, rows = str(tmp_path), assemble(frame(90, 0.1))
    models = [SammeClassifier(SammeParams(n_estimators=n, max_depth=1, learning_rate=0.5)).fit(rows) for n in (1, 3)]
    models[0].save(spark, store.model_path(root, 1))
    store.set_stage(spark, root, "Production", 1, 1)
    models[1].save(spark, store.model_path(root, 2))
    assert len(store.load_stage(spark, root)[0].trees) == 1
    half = tmp_path / "models" / "stages" / "Production" / "000000000009"
    half.write_text('{"path": "')  # a marker whose writer died
    assert store.load_stage(spark, root)[1]["run_id"] == 1
    store.set_stage(spark, root, "Production", 2, 2)
    assert len(store.load_stage(spark, root)[0].trees) == 3


def test_gameweek_job_by_steps(spark, frame, tmp_path):
    root = str(tmp_path)

    def steps(as_of):
        return {r["step"]: (r["status"], r["rows"]) for r in gameweek_job(spark, root, as_of).collect()}

    none = steps(AS_OF)
    assert none["load_model"] == ("FAILED", 0) and none["save_predictions"] == ("SKIPPED", 0)
    model = SammeClassifier(SammeParams(n_estimators=2, max_depth=2, learning_rate=0.5)).fit(assemble(frame(90, 0.1)))
    model.save(spark, store.model_path(root, 1))
    store.set_stage(spark, root, "Production", 1, store.register(spark, root, 1))
    assert steps(AS_OF)["fixtures"] == ("FAILED", 0)  # no tables yet
    day = datetime(2000, 9, 1)
    games = [match(i, "A" if i % 2 else "B", "B" if i % 2 else "A", i % 3, 1, day=213 + 7 * i) for i in range(12)]
    tables.replace_table(spark.createDataFrame(games, MATCH_SCHEMA), "matches", root)
    aliases = [("a", "A"), ("b", "B"), ("c", "C")]
    tables.replace_table(spark.createDataFrame(aliases, "display_name string, source_name string"), "aliases", root)
    week = [(1, "a", "b", day + timedelta(days=70)), (2, "a", "x", day + timedelta(days=71)), (3, "a", "c", day + timedelta(days=72))]
    tables.replace_table(spark.createDataFrame(week, "fixture_id long, home_name string, away_name string, date timestamp_ntz"), "fixtures", root)
    done = steps(day + timedelta(days=69))
    assert done == {
        "load_model": ("OK", 1), "fixtures": ("OK", 3), "skipped": ("OK", 1), "error": ("OK", 1), "predicted": ("OK", 1),
        "save_predictions": ("OK", 1), "save_importances": ("OK", 8),
    }
    empty = steps(day + timedelta(days=400))
    assert empty["fixtures"] == empty["predicted"] == ("OK", 0) and empty["save_predictions"] == ("SKIPPED", 0)
    assert tables.scan_table(spark, "gameweek_predictions", root).count() == 1  # the empty week keeps the tables


def test_flat_trees_vote_like_mllib(spark, frame):
    rows = assemble(frame(300, 0.2).withColumn(FEATURES[3], F.when(F.col("match_id") % 5 > 0, F.col(FEATURES[3]))), invalid="keep")
    known = rows.filter(f"{FEATURES[3]} is not null")
    tree = RandomForestClassifier(numTrees=1, bootstrap=False, maxDepth=6, seed=3, featureSubsetStrategy="all").fit(known)
    flat = trees.Forest([trees.flatten(tree)], [1.0])
    scored = tree.transform(rows).withColumn("scores", trees.vote_scores(flat))  # NaN goes to the right in both
    best = F.array_position("scores", F.array_max("scores")) - 1
    assert scored.filter(best != F.col("prediction")).count() == 0 and scored.count() == 300


def test_many_trees_are_one_expression(frame):
    df = assemble(frame(100, 0.2))
    model = SammeClassifier(SammeParams(n_estimators=4, max_depth=3, learning_rate=0.3)).fit(df)
    many = SammeModel(model.trees * 150, model.alphas * 150, model.errors * 150, model.params)
    start = time.perf_counter()
    out = many.transform(df)
    text = out._jdf.queryExecution().executedPlan().toString()
    assert time.perf_counter() - start < 2
    assert text.count("ArrowEvalPython") + text.count("ArrowUDF") <= 2 and text.count("UDF(") < 10
    assert out.select("prediction").collect() == model.transform(df).select("prediction").collect()


def test_prefixes_equal_shorter_fits(frame):
    df = assemble(frame(200, 0.2)).cache()
    params = SammeParams(n_estimators=5, max_depth=2, learning_rate=0.4)
    model = SammeClassifier(params).fit(df)
    assert SammeClassifier(replace(params, n_estimators=3)).fit(df).trees == model.prefix(3).trees
    curve = {r["trees"]: r["accuracy"] for r in tuning.boosting_curve(model, df).collect()}
    assert curve == pytest.approx({n: accuracy(model.prefix(n), df) for n in range(1, 6)})


def test_shared_fits_score_like_separate_ones(frame, monkeypatch):
    fixed = {"learning_rate": 0.4, "max_depth": 2, "min_samples_leaf": 1, "min_samples_split": 2, "max_features": None}
    draws = [SammeParams(n_estimators=n, **fixed) for n in (4, 2, 4, 1)] + [SammeParams(n_estimators=2, **{**fixed, "max_depth": 1})]
    fits = []
    fit = SammeClassifier.fit
    monkeypatch.setattr(SearchSpace, "draw", lambda self, trials, seed: draws[:trials])
    monkeypatch.setattr(SammeClassifier, "fit", lambda self, df: (fits.append(self.params), fit(self, df))[1])
    df = frame(150, 0.2)
    shared = cv_scores(df, SearchSpace(), trials=5, folds=2).collect()
    assert len(fits) == 4 and len(shared) == 10  # two distinct trees by two folds
    fits.clear()
    for i, params in enumerate(draws):
        monkeypatch.setattr(SearchSpace, "draw", lambda self, trials, seed, p=params: [p])
        alone = cv_scores(df, SearchSpace(), trials=1, folds=2).collect()
        assert [r[1:] for r in alone] == [r[1:] for r in shared if r["trial"] == i]


def test_counted_rows_are_fitted_like_the_rows(spark, monkeypatch):
    pick, names = random.Random(5), ["x", "y"]
    day = datetime(2001, 1, 1)
    data = []
    for i in range(600):
        x, y = pick.randrange(3), pick.randrange(3)
        result = CLASSES[2] if x > y else CLASSES[1] if x < y else CLASSES[0]
        data.append((i, day + timedelta(hours=i), pick.choice(CLASSES) if pick.random() < 0.2 else result, float(x), float(y)))
    df = spark.createDataFrame(data, "match_id long, date timestamp_ntz, result string, x double, y double")
    space = SearchSpace(n_estimators=(2, 5), max_depth=(1, 3), min_samples_leaf=(1, 2), min_samples_split=(2, 3), max_features=(None,))
    fitted, fit = [], SammeClassifier.fit
    monkeypatch.setattr(SammeClassifier, "fit", lambda self, rows: (fitted.append(rows.count()), fit(self, rows))[1])
    plain, counted = (
        train.train_on(df, datetime(2001, 3, 1), space, trials=2, folds=2, features=names, tally=tally) for tally in (False, True)
    )
    assert max(fitted[:5]) > 400 and max(fitted[5:]) <= 27 * 2  # cells of two features, result and fold
    for a, b in zip(plain.scores.collect(), counted.scores.collect()):
        assert a[:8] == b[:8] and a[8:] == pytest.approx(b[8:])
    nodes = [[(t.feature, t.threshold, t.right, t.label) for t in run.model.trees] for run in (plain, counted)]
    assert nodes[0] == nodes[1] and plain.model.alphas == pytest.approx(counted.model.alphas)
    with pytest.raises(ValueError, match="minimum"):
        fit(SammeClassifier(SammeParams(min_samples_leaf=2), names), assemble(samme.tallied(df, names), names))
    leaves = replace(space, min_samples_leaf=(2, 3))
    train.train_on(df, datetime(2001, 3, 1), leaves, trials=1, folds=2, features=names, tally=True)
    assert min(fitted[-3:]) > 100  # a minimum of rows is held against the rows themselves


def test_estimator_in_a_saved_pipeline(frame, spark, tmp_path):
    df = frame(200, 0.1)
    data = assemble(df).select("match_id", *FEATURES, "label")
    stages = [VectorAssembler(inputCols=FEATURES, outputCol="x"), BoostedTrees(featuresCol="x", numTrees=3, maxDepth=2, learningRate=0.5)]
    Pipeline(stages=stages).save(f"{tmp_path}/plan")
    model = Pipeline.load(f"{tmp_path}/plan").fit(data)
    model.save(f"{tmp_path}/model")
    again = PipelineModel.load(f"{tmp_path}/model")
    columns = ["match_id", "probabilities", "prediction", "predicted_label"]
    assert again.transform(data).select(*columns).collect() == model.transform(data).select(*columns).collect()
    plain = SammeClassifier(SammeParams(n_estimators=3, max_depth=2, learning_rate=0.5)).fit(assemble(df))
    assert model.stages[1].trees.trees == plain.trees and again.stages[1].getOrDefault("maxDepth") == 2


def test_estimator_in_cross_validation(frame):
    data = assemble(frame(200, 0.1)).select("features", "label")
    boosted = BoostedTrees(numTrees=2, learningRate=0.5)
    grid = ParamGridBuilder().addGrid(boosted.maxDepth, [1, 3]).build()
    scorer = MulticlassClassificationEvaluator(metricName="accuracy")
    found = CrossValidator(estimator=boosted, estimatorParamMaps=grid, evaluator=scorer, numFolds=2, seed=1).fit(data)
    assert len(found.avgMetrics) == 2 and found.bestModel.transform(data).count() == 200
    assert scorer.evaluate(found.bestModel.transform(data)) > 0.8
