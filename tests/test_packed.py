"""Fits inside a task against those of Spark jobs, and the whole search of the registered queries."""

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from formbook.ml import tuning
from formbook.ml.packed import boost, fold_outcomes, in_tasks, pack
from formbook.ml.samme import SammeClassifier, SammeParams, WorseThanChance, assemble
from formbook.ml.tuning import SearchSpace, cv_scores
from formbook.plans import train
from formbook.registry.queries import QUERIES
from formbook.schemas import CLASSES, FEATURES

NAMES = ["few", "many", "same", "coarse", "signed"]


@pytest.fixture(scope="module")
def table(spark):
    """Features of few and of many values, one constant; zeros, negative values and repeated rows."""

    def build(n, seed=3):
        pick, out = random.Random(seed), []
        for i in range(n):
            few, many, coarse = pick.randrange(6) / 5, pick.random(), pick.randrange(60) / 7
            signed = pick.choice([0.0, 0.0, pick.uniform(-1, 1)])
            result = CLASSES[int(few + many + signed / 2) % 3] if pick.random() < 0.7 else pick.choice(CLASSES)
            row = (result, few, many, 1.0, coarse, signed)
            out += [(i, *row)] if i % 9 else [(i, *row), (i + n, *row)]
        schema = "match_id long, result string, " + ", ".join(f"{c} double" for c in NAMES)
        day = F.expr("timestampadd(DAY, cast(match_id as int), timestamp_ntz'2000-01-01')")
        return spark.createDataFrame(out, schema).withColumn("date", day).cache()

    return build


def nodes(model):
    return [(t.feature, t.threshold, t.right, t.label) for t in model.trees]


@pytest.mark.parametrize("params", [
    SammeParams(n_estimators=6, max_depth=1),
    SammeParams(n_estimators=6, max_depth=4, learning_rate=0.3),
    SammeParams(n_estimators=4, max_depth=9, learning_rate=0.5, min_samples_leaf=25),
    SammeParams(n_estimators=4, max_depth=5, learning_rate=0.2, min_samples_split=30),
])
def test_a_task_fits_like_spark(table, params):
    rows = assemble(table(900), NAMES)
    packed = pack(rows, ["date", "match_id"])
    found, wanted = boost(packed.x, packed.y, params, NAMES), SammeClassifier(params, NAMES).fit(rows)
    assert nodes(found) == nodes(wanted)
    assert found.alphas == pytest.approx(wanted.alphas) and found.errors == pytest.approx(wanted.errors)
    for a, b in zip(found.trees, wanted.trees):
        assert a.importance == pytest.approx(b.importance)


def test_a_search_in_tasks_scores_like_one_of_jobs(table):
    space = SearchSpace(n_estimators=(2, 5), max_depth=(2, 5), max_features=(None,), learning_rate=(0.2, 0.5))
    inside, jobs = (
        cv_scores(table(400), space, trials=2, folds=2, features=NAMES, fit_rows=n).collect() for n in (1000, 0)
    )
    assert [r[:8] for r in inside] == [r[:8] for r in jobs]
    assert [r[8:] for r in inside] == [pytest.approx(r[8:]) for r in jobs]


def test_training_in_a_task(table, spark):
    """The final fit and the scores of the search do not depend on where they run."""
    space = SearchSpace(n_estimators=(2, 4), max_depth=(2, 4), max_features=(None,), learning_rate=(0.2, 0.5))
    runs = [
        train.train_on(table(300), dt.datetime(2001, 3, 1), space, trials=1, folds=2, features=NAMES, fit_rows=n)
        for n in (1000, 0)
    ]
    assert nodes(runs[0].model) == nodes(runs[1].model)
    assert runs[0].scores.collect()[0][:8] == runs[1].scores.collect()[0][:8]
    for run in runs:
        run.release()


@pytest.mark.parametrize("kind, most", [("sqrt", 3), ("log2", 3)])
def test_a_split_chooses_from_a_part_of_the_features(table, kind, most):
    packed = pack(assemble(table(900), NAMES), ["match_id"])
    params = SammeParams(n_estimators=5, max_depth=6, learning_rate=0.3, min_samples_leaf=20, max_features=kind)
    model = boost(packed.x, packed.y, params, NAMES)
    assert nodes(model) == nodes(boost(packed.x, packed.y, params, NAMES))
    whole = boost(packed.x, packed.y, SammeParams(n_estimators=5, max_depth=6, learning_rate=0.3, min_samples_leaf=20), NAMES)
    assert nodes(model) != nodes(whole)
    for tree in model.trees:  # every leaf holds its minimum
        held = [np.arange(packed.x.shape[1])] + [None] * (len(tree.feature) - 1)
        for i, feature in enumerate(tree.feature):
            assert len(held[i]) >= 20
            if feature >= 0:
                left = packed.x[feature, held[i]] <= tree.threshold[i]
                held[i + 1], held[tree.right[i]] = held[i][left], held[i][~left]


def test_outcomes_of_sizes(table, spark):
    """Prefixes are shorter fits, and a fit that ended early answers for all sizes above."""
    df = assemble(table(300), NAMES).withColumn("fold", F.when(F.col("match_id") < 200, 0).otherwise(1))
    packed = pack(df, ["fold", "match_id"], "fold")
    params = SammeParams(n_estimators=6, max_depth=3, learning_rate=0.4)
    sizes = [[2, 4, 6], [2]]
    ((kept, both), (_, two)) = in_tasks(spark, packed, lambda held, s: fold_outcomes(held, params, s, 1, NAMES), sizes)
    assert kept == 6 and {c[0] for c in both} == {2, 4, 6} and [c for c in both if c[0] == 2] == two
    seen, unseen = (df.filter(F.col("fold") == f).count() for f in (0, 1))
    for n in (2, 4, 6):
        assert [sum(c[4] for c in both if c[:2] == (n, u)) for u in (False, True)] == [seen, unseen]
    kept, ended = fold_outcomes(packed, SammeParams(n_estimators=9, max_depth=12), [1, 9], 1, NAMES)
    assert kept < 9 and {c[0] for c in ended} == {1, kept}


def test_chance_and_labels(spark):
    flat = spark.createDataFrame([(i, CLASSES[i % 3], 1.0) for i in range(9)], "match_id long, result string, a double")
    packed = pack(assemble(flat, ["a"]), ["match_id"])
    with pytest.raises(WorseThanChance):
        boost(packed.x, packed.y, SammeParams(n_estimators=3), ["a"])
    with pytest.raises(ValueError, match="without a label"):
        pack(assemble(flat.withColumn("result", F.lit("?")), ["a"]), ["match_id"])


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Sixty matches of two teams, each with goals from its line items."""
    root, pick, step = str(tmp_path_factory.mktemp("whole")), random.Random(1), 456  # keeps T00 against T01
    days = [dt.datetime(2001, 3, 1) + dt.timedelta(days=2 * i) for i in range(75)]
    orders = [(step * i, 100, day) for i, day in enumerate(days)]
    items = [
        (step * i, n, float(pick.randrange(50)), pick.random(), pick.random(), pick.choice("RNA"))
        for i in range(len(days)) for n in range(1, 5)
    ]
    tables = {
        "orders": (orders, "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz"),
        "lineitem": (
            items,
            "l_orderkey long, l_linenumber int, l_quantity double, l_discount double, l_tax double, l_returnflag string",
        ),
        "nation": ([(i, f"NATION_{i}") for i in range(25)], "n_nationkey int, n_name string"),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{root}/{name}.parquet")
    return root


def test_cv_scores_runs_the_whole_search(spark, folder):
    """Fifty draws from the library's ranges, each on five folds."""
    found = QUERIES["cv_scores"](spark, folder).collect()
    assert [(r["trial"], r["fold"]) for r in found] == [(t, f) for t in range(50) for f in range(1, 6)]
    draws = SearchSpace().draw(50)
    for r in found:
        drawn = draws[r["trial"]]
        assert (r["n_estimators"], r["max_depth"], r["max_features"]) == (drawn.n_estimators, drawn.max_depth, drawn.max_features)


def test_evaluate_model_is_of_the_best_draw(spark, folder):
    """The evaluated model is that of the best of fifty draws."""
    (found,) = QUERIES["evaluate_model"](spark, folder).collect()
    assert all(0 <= v <= 1 for v in found.asDict().values())
    best = max(QUERIES["random_search_trials"](spark, folder).collect(), key=lambda r: (r["mean_test_score"] or -1, -r["trial"]))
    record = {r["name"]: r["value"] for r in QUERIES["final_model_params"](spark, folder).collect()}
    assert (record["n_estimators"], record["max_depth"]) == (str(best["n_estimators"]), str(best["max_depth"]))


def test_final_model_params_tell_the_whole_search(spark, folder):
    record = {r["name"]: r["value"] for r in QUERIES["final_model_params"](spark, folder).collect()}
    assert (record["n_iter_search"], record["cv_folds"]) == ("50", "5") and 100 <= int(record["n_estimators"]) < 600


def test_model_importances_are_of_all_trees(spark, folder):
    """Every tree kept adds to them: more than the two or three that a cut search fits."""
    found = [tuple(r) for r in QUERIES["model_importances"](spark, folder).collect()]
    record = {r["name"]: r["value"] for r in QUERIES["final_model_params"](spark, folder).collect()}
    assert sorted(f for f, _ in found) == sorted(FEATURES) and sum(v for _, v in found) == pytest.approx(1.0)
    assert int(record["rounds_kept"]) > 3


def test_random_search_trials_has_all_draws(spark, folder):
    assert QUERIES["random_search_trials"](spark, folder).count() == 50


def test_large_tables_are_fitted_alone_and_held_on_disk(table, spark, monkeypatch):
    """Above the limit one fit at a time; what training persists itself takes no executor memory."""
    stored = spark.sparkContext._jsc.sc().getPersistentRDDs
    before = set(stored().keys().mkString(",").split(","))
    running, most, levels = [], [], []
    fit, tree = SammeClassifier.fit, SammeClassifier._tree

    def watched(self, df):
        running.append(1)
        most.append(len(running))
        try:
            return fit(self, df)
        finally:
            running.pop()

    def grown(self, round_):
        held = spark.sparkContext._jsc.getPersistentRDDs()
        levels.extend(held[k].getStorageLevel().useMemory() for k in held if str(k) not in before)
        return tree(self, round_)

    monkeypatch.setattr(SammeClassifier, "fit", watched)
    monkeypatch.setattr(SammeClassifier, "_tree", grown)
    space = SearchSpace(n_estimators=(2, 3), max_depth=(2, 4), max_features=(None,), learning_rate=(0.2, 0.5))
    df = table(300)
    for limit, together in ((10_000, False), (10, True)):
        most.clear(), levels.clear()
        monkeypatch.setattr(tuning, "SIDE_BY_SIDE", limit)
        run = train.train_on(df, dt.datetime(2001, 3, 1), space, trials=2, folds=2, features=NAMES)
        run.release()
        assert (max(most) == 1) == together
    assert levels and not any(levels)


def test_rows_of_rounds_are_not_persisted_inside_each_other(table, monkeypatch):
    """Only a checkpoint starts a new generation; the text of nested ones doubled every round and filled the driver."""
    rows = assemble(table(300), NAMES)
    kind, kept = type(rows), []
    persist = kind.persist
    monkeypatch.setattr(kind, "persist", lambda self, *level: (kept.append(1), persist(self, *level))[1])
    params = SammeParams(n_estimators=7, max_depth=3, learning_rate=0.3)
    model = SammeClassifier(params, NAMES, checkpoint_every=3).fit(rows)
    assert len(model.trees) == 7 and len(kept) == 3  # at first, after three rounds and after six
    assert nodes(model) == nodes(SammeClassifier(params, NAMES).fit(rows))
