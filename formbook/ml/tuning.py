"""Random search with expanding-window cross-validation."""

from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass, replace

import numpy as np
from pyspark import StorageLevel, inheritable_thread_target
from pyspark.sql import DataFrame, Row, functions as F, types as T

from formbook.ml.packed import fold_outcomes, in_tasks, pack
from formbook.ml.samme import SammeClassifier, SammeModel, SammeParams, WorseThanChance, assemble, tallied
from formbook.ml.trees import staged_outcomes
from formbook.operators.metrics import averages_of_counts
from formbook.operators.split import time_series_folds
from formbook.schemas import CV_FOLDS, FEATURES, SEARCH_DRAWS, SEED

SIDE_BY_SIDE = 1_000_000  # rows up to which fits of Spark jobs share the executors


@dataclass(frozen=True)
class SearchSpace:
    """Ranges to draw from; upper ends are exclusive. Fixed values by default."""

    max_depth: tuple[int, int] = (2, 10)
    min_samples_leaf: tuple[int, int] = (1, 20)
    min_samples_split: tuple[int, int] = (2, 20)
    max_features: tuple[str | None, ...] = ("sqrt", "log2", None)
    n_estimators: tuple[int, int] = (100, 600)
    learning_rate: tuple[float, float] = (0.01, 0.50)

    def draw(self, trials: int, seed: int = SEED) -> list[SammeParams]:
        pick = np.random.default_rng(seed)
        return [
            SammeParams(
                n_estimators=int(pick.integers(*self.n_estimators)),
                learning_rate=float(pick.uniform(*self.learning_rate)),
                max_depth=int(pick.integers(*self.max_depth)),
                min_samples_leaf=int(pick.integers(*self.min_samples_leaf)),
                min_samples_split=int(pick.integers(*self.min_samples_split)),
                max_features=self.max_features[int(pick.integers(len(self.max_features)))],
                seed=seed,
            )
            for _ in range(trials)
        ]


TRIAL_SCHEMA = T.StructType(
    [
        T.StructField("trial", T.IntegerType()),
        T.StructField("fold", T.IntegerType()),
        T.StructField("n_estimators", T.IntegerType()),
        T.StructField("learning_rate", T.DoubleType()),
        T.StructField("max_depth", T.IntegerType()),
        T.StructField("min_samples_leaf", T.IntegerType()),
        T.StructField("min_samples_split", T.IntegerType()),
        T.StructField("max_features", T.StringType()),
        T.StructField("train_macro_f1", T.DoubleType()),
        T.StructField("test_macro_f1", T.DoubleType()),
        T.StructField("test_accuracy", T.DoubleType()),
    ]
)
PARAM_COLUMNS = [f.name for f in TRIAL_SCHEMA if f.name not in
                 ("trial", "fold", "train_macro_f1", "test_macro_f1", "test_accuracy")]


def cv_scores(
    train: DataFrame,
    space: SearchSpace = SearchSpace(),
    trials: int = SEARCH_DRAWS,
    folds: int = CV_FOLDS,
    seed: int = SEED,
    parallel: int = 4,
    checkpoint_every: int = 10,
    features: list[str] = FEATURES,
    tally: bool = False,
    fit_rows: int = 0,
) -> DataFrame:
    """One row per trial and fold with train and test scores; null where no fit is possible.

    ``train`` holds the ``features`` and ``result``. Every fold fits on all rows before its block. Trials that differ only
    in their number of trees share one fit per fold, whose first trees are the smaller models; one pass scores them
    all. ``parallel`` fits run at a time as separate Spark jobs over the same persisted rows, above ``SIDE_BY_SIDE`` rows only
    one, which keeps all executors busy and holds its rows alone. With ``tally``, for features
    of few values, rows alike are counted once and fits go over the counts, unless a draw asks for a minimum of rows.
    Up to ``fit_rows`` rows, every fit is a task of its own over all of them.
    """
    draws = list(enumerate(space.draw(trials, seed)))
    rows, held = time_series_folds(train, folds), []
    if tally and all(params.min_instances_per_node == 1 for _, params in draws):
        rows, held = tallied(rows, features, "fold"), ["_copies"]
    rows = assemble(rows, features).select("features", "label", "fold", *(held or ["position"]))
    rows = rows.persist(StorageLevel.DISK_ONLY)  # memory is left to the rows that MLlib holds
    alike: dict[SammeParams, list[tuple[int, SammeParams]]] = {}
    for trial, params in draws:
        alike.setdefault(replace(params, n_estimators=0), []).append((trial, params))
    tasks = [(group, fold) for group in alike.values() for fold in range(1, folds + 1)]

    def lines(group: list[tuple[int, SammeParams]], fold: int, kept: int, found: dict[tuple[int, bool], Row]) -> list[tuple]:
        """Of each trial, from the scores of the ``kept`` trees' prefixes; boosting may have ended earlier than asked."""
        out = []
        for trial, params in group:
            values = asdict(params)
            drawn = (trial, fold, *[values[c] for c in PARAM_COLUMNS])
            if kept:
                seen, unseen = (found[min(params.n_estimators, kept), u] for u in (False, True))
                out.append((*drawn, seen["macro_f1"], unseen["macro_f1"], unseen["accuracy"]))
            else:
                out.append((*drawn, None, None, None))
        return out

    def most(group: list[tuple[int, SammeParams]]) -> SammeParams:
        return replace(group[0][1], n_estimators=max(p.n_estimators for _, p in group))

    def score(task: tuple[list[tuple[int, SammeParams]], int]) -> list[tuple]:
        group, fold = task
        try:
            model = SammeClassifier(most(group), features, checkpoint_every).fit(rows.filter(F.col("fold") < fold))
        except WorseThanChance:
            return lines(group, fold, 0, {})
        kept = len(model.trees)
        judged = rows.filter(F.col("fold") <= fold).withColumn("unseen", F.col("fold") == fold)
        counts = staged_outcomes(judged, model.forest(), [min(p.n_estimators, kept) for _, p in group], "unseen")
        scored = averages_of_counts(counts, ["macro_f1", "accuracy"], ["trees", "unseen"])
        return lines(group, fold, kept, {(r["trees"], r["unseen"]): r for r in scored.collect()})  # two rows a size

    def score_packed() -> list[list[tuple]]:
        fits = [(most(group), sorted({p.n_estimators for _, p in group}), fold) for group, fold in tasks]
        long_first = sorted(range(len(fits)), key=lambda i: -fits[i][2] * fits[i][0].n_estimators * fits[i][0].max_depth)
        packed = pack(rows, ["position"], "fold")
        done = in_tasks(spark, packed, lambda held, i: (i, *fold_outcomes(held, *fits[i], features)), long_first)
        counted = [(i, *cell) for i, _, cells in done for cell in cells]
        counts = spark.createDataFrame(counted, "fit int, trees int, unseen boolean, y_true string, y_pred string, n long")
        found: dict[int, dict[tuple[int, bool], Row]] = {i: {} for i, _, _ in done}
        for r in averages_of_counts(counts, ["macro_f1", "accuracy"], ["fit", "trees", "unseen"]).collect():
            found[r["fit"]][r["trees"], r["unseen"]] = r
        return [lines(*tasks[i], kept, found[i]) for i, kept, _ in done]

    spark = train.sparkSession
    try:
        n = rows.count()  # once, before fits that run side by side each ask for it
        if 0 < n <= fit_rows and not held:
            parts = score_packed()
        else:
            with ThreadPoolExecutor(parallel if n <= SIDE_BY_SIDE else 1) as pool:
                parts = list(pool.map(inheritable_thread_target(spark)(score), tasks))
    finally:
        rows.unpersist()
    return spark.createDataFrame(sorted((line for part in parts for line in part), key=lambda line: line[:2]), TRIAL_SCHEMA)


def boosting_curve(model: SammeModel, judged: DataFrame) -> DataFrame:
    """Scores of the first 1, 2, ... trees of a model on assembled rows, from one pass over them."""
    counts = staged_outcomes(judged, model.forest())
    return averages_of_counts(counts, ["accuracy", "macro_f1"], ["trees"])


def trial_table(scores: DataFrame) -> DataFrame:
    """Mean and spread over the folds of each trial; null if a fold could not be fitted."""

    def over_all(value):
        return F.when(F.count("test_macro_f1") == F.count(F.lit(1)), value)

    return scores.groupBy("trial", *PARAM_COLUMNS).agg(
        over_all(F.avg("train_macro_f1")).alias("mean_train_score"),
        over_all(F.avg("test_macro_f1")).alias("mean_test_score"),
        over_all(F.stddev_pop("test_macro_f1")).alias("std_test_score"),
        over_all(F.avg("test_accuracy")).alias("mean_test_accuracy"),
    )


def top_trials(trials: DataFrame, n: int = 10) -> DataFrame:
    return trials.orderBy(F.col("mean_test_score").desc_nulls_last(), F.col("trial").asc()).limit(n)


def best_params(trials: DataFrame, seed: int = SEED) -> SammeParams:
    best = top_trials(trials, 1).first()
    return SammeParams(**{c: best[c] for c in PARAM_COLUMNS}, seed=seed)
