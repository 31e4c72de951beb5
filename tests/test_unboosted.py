"""Whole training queries on tables whose final fit has no tree better than chance.

One pair of teams, no statistics but goals, and as many wins as draws and losses among 15 training rows: too few for a
split under the least leaf of any draw, so that the first tree is one leaf with a weighted error of 2/3.
"""

import datetime as dt

import pytest

from formbook.registry.queries import QUERIES
from formbook.schemas import CLASSES, FEATURES

SINGLE = 456  # keys in this step keep T00 against T01, and NATION_0 against NATION_1
FLAGS = ["R", "N", "A"]  # win, draw, loss


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("unboosted"))
    days = [dt.datetime(2001, 5, 20) + dt.timedelta(days=i) for i in range(30)]  # the first 15 lack form
    days += [dt.datetime(2001, 6, 21) + dt.timedelta(days=i) for i in range(15)]  # to be tested on
    orders = [(SINGLE * i, 100, day) for i, day in enumerate(days)]
    items = [(SINGLE * i, 1, 1.0, 0.0, 0.0, FLAGS[i % 3]) for i in range(len(days))]
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


@pytest.fixture(scope="module")
def ask(spark, folder):
    return lambda name: QUERIES[name](spark, folder).collect()


def test_cv_scores(ask):
    """Every trial and fold has its row, whether a fold could be fitted or not."""
    found = ask("cv_scores")
    assert [(r["trial"], r["fold"]) for r in found] == [(t, f) for t in range(2) for f in range(1, 4)]
    for r in found:
        assert (r["test_macro_f1"] is None) == (r["train_macro_f1"] is None) == (r["test_accuracy"] is None)


def test_evaluate_model(ask):
    (found,) = ask("evaluate_model")
    assert found["accuracy"] == pytest.approx(1 / 3) and found["macro_f1"] == pytest.approx(1 / 6)  # one class for all rows


def test_final_model_params(ask):
    record = {r["name"]: r["value"] for r in ask("final_model_params")}
    assert (record["rounds_kept"], record["n_estimators"], record["max_depth"]) == ("0", "2", "9")


def test_gameweek_job(ask):
    found = {r["step"]: (r["status"], r["rows"]) for r in ask("gameweek_job")}
    assert found == {
        "load_model": ("OK", 1), "fixtures": ("OK", 1), "skipped": ("OK", 0), "error": ("OK", 0), "predicted": ("OK", 1),
        "save_predictions": ("OK", 1), "save_importances": ("OK", 8),
    }


def test_gameweek_predictions(ask):
    (found,) = ask("gameweek_predictions")  # the week's games are of one pair, and its latest counts
    assert (found["home_team"], found["away_team"], found["error"]) == ("T00", "T01", None)
    chances = found["class_probabilities"]
    assert sorted(chances) == CLASSES and chances[found["predicted_result"]] == found["confidence"] == max(chances.values())


def test_model_importances(ask):
    assert [tuple(r) for r in ask("model_importances")] == [(f, 0.0) for f in FEATURES]  # no split, no importance


def test_model_roundtrip(ask):
    assert sorted(tuple(r) for r in ask("model_roundtrip")) == [(c, 5, 0) for c in CLASSES]


def test_random_search_trials(ask):
    """A trial's means are null where one of its folds could not be fitted, and all of them then."""
    unfit = {r["trial"] for r in ask("cv_scores") if r["test_macro_f1"] is None}
    found = sorted(ask("random_search_trials"), key=lambda r: r["trial"])
    assert [r["trial"] for r in found] == [0, 1]
    for r in found:
        means = [r[c] is None for c in ("mean_train_score", "mean_test_score", "std_test_score", "mean_test_accuracy")]
        assert means == [r["trial"] in unfit] * 4


def test_train_job_deployment(ask):
    """The first job's leaf goes into production; the second's, no better, does not take its place."""
    assert [tuple(r) for r in ask("train_job_deployment")] == [
        ("SUCCESS", 1, 15, 15, "SUCCESS", "SUCCESS", 1, 1, True),
        ("SUCCESS", 2, 15, 15, "SUCCESS", "SUCCESS", 1, 1, False),
    ]
