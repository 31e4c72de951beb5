"""Predict the next gameweek and save it."""

import datetime as dt

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, functions as F

from formbook.functions.season import ntz
from formbook.ml import store
from formbook.ml.samme import SammeModel, assemble
from formbook.operators.fixtures import latest_per_key
from formbook.plans.scoring import scoring_features, upcoming
from formbook.plans.train import importance_table, top_importances
from formbook.schemas import CLASSES, FEATURES
from formbook.sources.tables import replace_table, scan_table

STEPS = (
    "load_model", "fixtures", "skipped", "error", "predicted", "save_predictions", "save_importances",
)


def class_probabilities(scored: DataFrame) -> DataFrame:
    """Percent probability per class name, and that of the predicted class."""
    percents = F.transform("probabilities", lambda p: F.round(p * 100, 1))
    named = F.map_from_arrays(F.array(*map(F.lit, CLASSES)), percents)
    return scored.withColumn("class_probabilities", named).withColumn(
        "confidence", F.element_at("class_probabilities", F.col("predicted_label"))
    )


def score(featured: DataFrame, model: SammeModel, stage: str = "Production") -> DataFrame:
    """Predictions for scoring rows; SKIPPED and ERROR rows stay, without a prediction."""
    unknown = F.array_contains(F.array(*[F.col(f).isNull() for f in FEATURES]), True)
    status = F.when((F.col("status") == "OK") & unknown, "ERROR").otherwise(F.col("status"))
    rows = assemble(featured.withColumn("status", status), invalid="keep")
    return as_predictions(model.transform(rows), stage)


def as_predictions(scored: DataFrame, stage: str = "Production") -> DataFrame:
    """Prediction rows of scored games with a status; only OK games have a prediction."""
    scored = class_probabilities(scored)
    ok = F.col("status") == "OK"
    error = F.when(F.col("status") == "SKIPPED", "team name not in the alias table").when(
        F.col("status") == "ERROR", "not enough match history"
    )
    return scored.select(
        "match_key", "home_name", "away_name", "home_team", "away_team", "match_date",
        F.when(ok, F.col("predicted_label")).otherwise(F.col("status")).alias("predicted_result"),
        F.when(ok, F.col("class_probabilities")).alias("class_probabilities"),
        F.when(ok, F.col("confidence")).alias("confidence"),
        F.lit(stage).alias("stage"),
        error.alias("error"),
    )


def gameweek_predictions(
    fixtures: DataFrame, history: DataFrame, aliases: DataFrame, model: SammeModel, as_of: dt.datetime
) -> DataFrame:
    """One row per match key of the next gameweek."""
    games = latest_per_key(upcoming(fixtures, aliases, as_of))
    return score(scoring_features(games, history, as_of), model)


def predictions_flat(predictions: DataFrame) -> DataFrame:
    """Valid predictions with display names and one column per class."""
    valid = predictions.filter(~F.col("predicted_result").isin("ERROR", "SKIPPED"))
    return valid.select(
        F.col("home_name").alias("home_team"),
        F.col("away_name").alias("away_team"),
        "match_date",
        "predicted_result",
        "confidence",
        *[F.col("class_probabilities")[c].alias(f"prob_{c.lower()}") for c in CLASSES],
    )


def prediction_summary(predictions: DataFrame) -> DataFrame:
    """Predicted of total, and the predicted results."""

    def count(*labels: str):
        return F.count(F.when(F.col("predicted_result").isin(*labels), 1))

    return predictions.agg(
        F.count(F.lit(1)).alias("total"),
        count(*CLASSES).alias("predicted"),
        count("Win").alias("home_wins"),
        count("Draw").alias("draws"),
        count("Lose").alias("away_wins"),
    )


def save_gameweek(
    predictions: DataFrame, importances: DataFrame, as_of: dt.datetime, root: str | None = None
) -> dict[str, DataFrame]:
    """Replace the prediction and importance tables; a week without valid predictions leaves them as they are."""
    if predictions_flat(predictions).isEmpty():
        return {}
    stamped = top_importances(importances).withColumn("created_at", ntz(as_of))
    return {
        "gameweek_predictions": replace_table(predictions_flat(predictions), "gameweek_predictions", root),
        "feature_importance": replace_table(stamped, "feature_importance", root),
    }


def gameweek_job(spark: SparkSession, root: str, as_of: dt.datetime, stage: str = "Production") -> DataFrame:
    """Load the stage's model, predict the next gameweek from the tables below ``root``, and save the results.

    Reads ``fixtures``, ``matches`` and ``aliases``; replaces ``gameweek_predictions`` and ``feature_importance``.
    Returns a row per step: ``step, status, rows, message``. A step that fails says so, and those after it are SKIPPED;
    importances that cannot be saved leave the predictions. A week without valid predictions leaves both tables.
    """
    lines: dict[str, tuple[str, int, str | None]] = {}

    def step(name: str, run):
        if any(status == "FAILED" for status, _, _ in lines.values()):
            return None
        try:
            found, rows = run()
        except Exception as error:  # told in the step's row
            lines[name] = ("FAILED", 0, f"{type(error).__name__}: {str(error)[:200]}")
            return None
        lines[name] = ("OK", rows, None)
        return found

    def predict():
        tables = [scan_table(spark, name, root) for name in ("fixtures", "matches", "aliases")]
        found = gameweek_predictions(*tables, model, as_of).withColumn("stage", F.lit(stage))
        found = found.persist(StorageLevel.MEMORY_AND_DISK)  # counted and saved
        return found, found.count()

    def save(df: DataFrame, name: str):
        return None, replace_table(df, name, root).count()

    model = step("load_model", lambda: ((held := store.load_stage(spark, root, stage))[0], held[1]["version"]))
    predictions = step("fixtures", predict)
    if predictions is not None:
        try:
            counts = predictions.agg(
                *[F.count(F.when(F.col("predicted_result") == s, 1)).alias(s) for s in ("SKIPPED", "ERROR")]
            ).first()
            valid = lines["fixtures"][1] - counts["SKIPPED"] - counts["ERROR"]
            for name, rows in (("skipped", counts["SKIPPED"]), ("error", counts["ERROR"]), ("predicted", valid)):
                lines[name] = ("OK", rows, None)
            if valid:
                step("save_predictions", lambda: save(predictions_flat(predictions), "gameweek_predictions"))
                stamped = top_importances(importance_table(spark, model)).withColumn("created_at", ntz(as_of))
                step("save_importances", lambda: save(stamped, "feature_importance"))
        finally:
            predictions.unpersist()
    rows = [(i, name, *lines.get(name, ("SKIPPED", 0, None))) for i, name in enumerate(STEPS)]
    return spark.createDataFrame(rows, "place int, step string, status string, rows long, message string")


def predictions_by_date(table: DataFrame) -> DataFrame:
    """Saved predictions in date order; the other columns split a busy date over tasks."""
    rest = [c for c in table.columns if c != "match_date" and table.schema[c].dataType.typeName() != "map"]
    return table.orderBy("match_date", *rest)
