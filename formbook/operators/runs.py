"""Choosing among training runs and registered models, per experiment."""

from pyspark.sql import Column, DataFrame, Window, functions as F


def _better_first(higher_is_better: bool) -> list[Column]:
    metric = F.col("metric").desc_nulls_last() if higher_is_better else F.col("metric").asc_nulls_last()
    return [metric, F.col("run_id").asc()]


def top_runs(runs: DataFrame, higher_is_better: bool = True, n: int = 20) -> DataFrame:
    """First ``n`` finished runs of each experiment by metric."""
    order = Window.partitionBy("experiment").orderBy(*_better_first(higher_is_better))
    finished = runs.filter(F.col("status") == "FINISHED")
    return finished.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= n)


def best_run(runs: DataFrame, higher_is_better: bool = True, n: int = 20) -> DataFrame:
    """Best finished run per experiment.

    With an ``artifact_path`` column, the best of the first ``n`` that has one.
    """
    if "artifact_path" not in runs.columns:
        return top_runs(runs, higher_is_better, 1).drop("place")
    usable = top_runs(runs, higher_is_better, n).filter(F.col("artifact_path").isNotNull())
    first = F.min_by(F.struct(*runs.columns), F.col("place")).alias("r")
    return usable.groupBy("experiment").agg(first).select("r.*")


def best_registered_run(runs: DataFrame, versions: DataFrame, higher_is_better: bool = True) -> DataFrame:
    """Best run per experiment among those with a registered version."""
    metrics = runs.select("experiment", "run_id", "metric").filter(F.col("metric").isNotNull())
    registered = versions.select("run_id", "version").join(metrics, "run_id")
    sign = 1 if higher_is_better else -1
    best = F.max_by(F.struct("run_id", "version", "metric"), F.struct(sign * F.col("metric"), -F.col("version")))
    return registered.groupBy("experiment").agg(best.alias("b")).select("experiment", "b.*")


def version_of_run(versions: DataFrame, run_id: int) -> DataFrame:
    return versions.filter(F.col("run_id") == run_id).agg(F.min("version").alias("version"))


def promotion_decision(versions: DataFrame, higher_is_better: bool = True) -> DataFrame:
    """Promote the newest staged model over the newest one in production?

    No production metric: promote. No staging metric: keep. Otherwise the
    staged one must be strictly better.
    """

    def latest(stage: str, column: str) -> Column:
        key = F.when(F.col("stage") == stage, F.col("version"))
        return F.max_by(F.struct(column), key)[column]

    staging, production = F.col("staging_metric"), F.col("production_metric")
    better = staging > production if higher_is_better else staging < production
    return (
        versions.groupBy("experiment")
        .agg(
            latest("Staging", "version").alias("staging_version"),
            latest("Staging", "metric").alias("staging_metric"),
            latest("Production", "version").alias("production_version"),
            latest("Production", "metric").alias("production_metric"),
        )
        .withColumn(
            "promote", F.when(production.isNull(), True).when(staging.isNull(), False).otherwise(better)
        )
    )


def deployment_plan(runs: DataFrame, versions: DataFrame, higher_is_better: bool = True) -> DataFrame:
    """Per experiment: the run to deploy, where its model lies, its version, and whether to promote it.

    ``runs``: ``experiment, run_id, status, metric, artifact_path``; ``versions``: ``experiment, version, run_id, stage``,
    a row per version and stage it reached. The best of the first 20 finished runs that kept its model; failing that,
    the best registered run, ``source`` telling which. ``version`` is null if the run is to be registered first.
    Promote if production has no metric; keep it if the run has none, is the one in production or is no better.
    """
    best = best_run(runs, higher_is_better).select("experiment", "run_id", "metric", "artifact_path", F.lit("run").alias("source"))
    registered = best_registered_run(runs, versions.select("run_id", "version").distinct(), higher_is_better)
    registered = registered.select(
        "experiment", "run_id", "metric", F.lit("model").alias("artifact_path"), F.lit("registry").alias("source")
    )
    chosen = best.unionByName(registered.join(best, "experiment", "left_anti"))
    # A row per experiment from here on.
    ours = versions.select("experiment", "run_id", "version").join(chosen.select("experiment", "run_id"), ["experiment", "run_id"])
    ours = ours.groupBy("experiment").agg(F.min("version").alias("version"))
    live = versions.filter(F.col("stage") == "Production").groupBy("experiment")
    live = live.agg(F.max_by(F.struct("run_id", "version"), "version").alias("p"))
    live = live.select("experiment", F.col("p.run_id").alias("run_id"), F.col("p.version").alias("production_version"))
    live = live.join(runs.select("experiment", "run_id", "metric"), ["experiment", "run_id"], "left").select(
        "experiment", "production_version", F.col("metric").alias("production_metric")
    )
    new, old = F.col("metric"), F.col("production_metric")
    promote = (
        F.when(old.isNull(), True)
        .when(new.isNull() | (F.coalesce("version", F.lit(-1)) == F.col("production_version")), False)
        .otherwise(new > old if higher_is_better else new < old)
    )
    return chosen.join(ours, "experiment", "left").join(live, "experiment", "left").withColumn("promote", promote)


def artifact_path(tag: Column, default: str = "model") -> Column:
    """``artifact_path`` of the first entry of a JSON history tag.

    Missing path: the default. Empty or malformed history: null.
    """
    history = F.from_json(tag, "array<struct<artifact_path: string>>")
    return F.when(F.size(history) > 0, F.coalesce(history[0]["artifact_path"], F.lit(default)))


def is_model_artifact(path: Column) -> Column:
    return F.startswith(path, F.lit("model"))
