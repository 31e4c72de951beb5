"""Multi-class boosting (SAMME; Zhu et al., "Multi-class AdaBoost", 2009) on MLlib trees.

Each round fits one distributed tree on the weighted rows, measures its
weighted error with one aggregation and reweights the rows by a column
expression. The driver sees three numbers per round.
"""

import json
import math
from dataclasses import asdict, dataclass, field, replace

from pyspark import StorageLevel
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from formbook.functions.columns import label_index, label_name, require
from formbook.ml.trees import Forest, Tree, flatten, load_trees, save_trees, vote_scores
from formbook.schemas import CLASSES, FEATURES, SEED
from formbook.session import shared_dir

K = len(CLASSES)
CHANCE = 1.0 - 1.0 / K - 1e-12  # weighted error from which a tree is no better than chance, up to rounding
LABEL_META = {"ml_attr": {"type": "nominal", "name": "label", "vals": CLASSES}}


class WorseThanChance(ValueError):
    """The first tree's weighted error reaches 1 - 1/K; nothing can be boosted. ``alone`` is a model of that tree."""

    def __init__(self, alone: "SammeModel"):
        super().__init__(f"weighted error {alone.errors[0]:.4f} with {K} classes")
        self.alone = alone


@dataclass(frozen=True)
class SammeParams:
    n_estimators: int = 100
    learning_rate: float = 1.0
    max_depth: int = 4
    min_samples_leaf: int = 1
    min_samples_split: int = 2
    max_features: str | None = None
    seed: int = SEED

    @property
    def min_instances_per_node(self) -> int:
        """MLlib has no split minimum; a child of half that size comes closest."""
        return max(self.min_samples_leaf, self.min_samples_split // 2, 1)


def assemble(df: DataFrame, features: list[str] = FEATURES, invalid: str = "error") -> DataFrame:
    """Add the ``features`` vector, and ``label`` if there is a ``result``.

    ``invalid="keep"`` lets rows with unknown features through, as NaN.
    """
    require(df, features, "model input")
    df = VectorAssembler(inputCols=features, outputCol="features", handleInvalid=invalid).transform(df)
    if "result" in df.columns:
        index = label_index(F.col("result"))
        df = df.withColumn("label", index.alias("label", metadata=LABEL_META))
    return df


def tallied(df: DataFrame, features: list[str], *by: str) -> DataFrame:
    """One row per ``result``, ``by`` and equal features, with the number ``_copies`` of rows it stands for."""
    return df.groupBy(*features, "result", *by).agg(F.count(F.lit(1)).alias("_copies"))


def balanced_weights(df: DataFrame, label: str = "result") -> DataFrame:
    """Rows, N / (K * n) weight per class."""
    counts = df.groupBy(F.col(label).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    totals = counts.agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("classes"))
    return counts.select(
        "label",
        "n",
        (totals.select("total").scalar() / (totals.select("classes").scalar() * F.col("n"))).alias("weight"),
    )


def samme_error(miss: Column, weight: Column) -> Column:
    """Weighted error of a learner, as an aggregate."""
    return F.sum(F.when(miss, weight).otherwise(0.0)) / F.sum(weight)


def samme_alpha(error: Column, learning_rate: float = 1.0) -> Column:
    """Say of a learner in the vote."""
    return learning_rate * (F.ln((1.0 - error) / error) + math.log(K - 1))


def samme_round(
    df: DataFrame, true: str, pred: str, weight: str, learning_rate: float = 1.0
) -> DataFrame:
    """One boosting round over weighted rows, summed per (true, predicted) pair.

    Error and alpha of the learner, the weight of the pair before, and its
    normalised weight after reweighting. Rows are aggregated once.
    """
    miss = F.col(true) != F.col(pred)
    cells = df.groupBy(F.col(true).alias("y_true"), F.col(pred).alias("y_pred")).agg(
        F.sum(weight).alias("weight_before")
    )
    # At most K x K rows from here on.
    total = cells.agg(
        samme_error(F.col("y_true") != F.col("y_pred"), F.col("weight_before")).alias("err")
    ).select("err", samme_alpha(F.col("err"), learning_rate).alias("alpha"))
    err, alpha = total.select("err").scalar(), total.select("alpha").scalar()
    raised = F.when(F.col("y_true") != F.col("y_pred"), F.exp(F.col("alpha"))).otherwise(1.0)
    cells = cells.withColumns({"err": err, "alpha": alpha}).withColumn(
        "_raised", F.col("weight_before") * raised
    )
    norm = cells.agg(F.sum("_raised")).scalar()
    return cells.withColumn("weight_after", F.col("_raised") / norm).drop("_raised")


@dataclass
class SammeModel:
    """Weighted vote of trees."""

    trees: list[Tree]
    alphas: list[float]
    errors: list[float]
    params: SammeParams
    features: list[str] = field(default_factory=lambda: list(FEATURES))

    @property
    def boosted(self) -> bool:
        """False for a first tree that is no better than chance and votes alone."""
        return self.errors[0] < CHANCE

    def forest(self) -> Forest:
        return Forest(self.trees, self.alphas)

    def prefix(self, n: int) -> "SammeModel":
        """The model that a fit of ``n`` trees would have given: rounds do not depend on later ones."""
        params = replace(self.params, n_estimators=n)
        return SammeModel(self.trees[:n], self.alphas[:n], self.errors[:n], params, self.features)

    def transform(self, df: DataFrame, features: str = "features", prediction: str = "prediction") -> DataFrame:
        """Add ``scores``, ``probabilities`` (arrays in class order), the prediction and ``predicted_label``.

        One expression scores all trees, whatever their number.
        """
        df = df.withColumn("scores", vote_scores(self.forest(), features))
        raised = F.transform("scores", lambda s: F.exp(s / (K - 1)))
        df = df.withColumn("_raised", raised)
        norm = F.aggregate("_raised", F.lit(0.0), lambda a, x: a + x)
        df = df.withColumn("probabilities", F.transform("_raised", lambda x: x / norm)).drop("_raised")
        best = F.array_position("scores", F.array_max("scores")) - 1
        return df.withColumn(prediction, best.cast("double")).withColumn("predicted_label", label_name(F.col(prediction)))

    def importances(self) -> list[tuple[str, float]]:
        """Alpha-weighted mean of the trees' importances, in feature order."""
        total = sum(self.alphas) or 1.0
        sums = [0.0] * len(self.features)
        for tree, alpha in zip(self.trees, self.alphas):
            for i, value in enumerate(tree.importance):
                sums[i] += alpha * value
        return [(f, s / total) for f, s in zip(self.features, sums)]

    def save(self, spark: SparkSession, path: str) -> None:
        """The trees as one table below ``path``, and one JSON line of metadata, written last."""
        save_trees(spark, self.trees, f"{path}/trees")
        meta = {
            "alphas": self.alphas,
            "errors": self.errors,
            "importances": [t.importance for t in self.trees],
            "params": asdict(self.params),
            "features": self.features,
            "classes": CLASSES,
        }
        line = spark.createDataFrame([(json.dumps(meta),)], "value string")
        line.coalesce(1).write.mode("overwrite").text(f"{path}/metadata")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "SammeModel":
        meta = json.loads(spark.read.text(f"{path}/metadata").first()["value"])
        if meta["classes"] != CLASSES:
            raise ValueError(f"model classes {meta['classes']} differ from {CLASSES}")
        trees = load_trees(spark, f"{path}/trees", meta["importances"])
        return cls(trees, meta["alphas"], meta["errors"], SammeParams(**meta["params"]), meta["features"])


def _predict_only(tree: RandomForestClassificationModel, column: str):
    """The tree with a single output column."""
    return tree.copy().setRawPredictionCol("").setProbabilityCol("").setPredictionCol(column)


class SammeClassifier:
    """Boosted MLlib trees with balanced class weights.

    ``checkpoint_every`` rounds the row weights are checkpointed, so neither
    the plan nor a recovery reaches further back than that.
    """

    def __init__(self, params: SammeParams = SammeParams(), features: list[str] = FEATURES, checkpoint_every: int = 10):
        self.params = params
        self.features = list(features)
        self.checkpoint_every = checkpoint_every

    def _tree(self, round_: int) -> RandomForestClassifier:
        p = self.params
        return RandomForestClassifier(
            numTrees=1,
            bootstrap=False,
            subsamplingRate=1.0,
            featureSubsetStrategy=p.max_features or "all",
            maxDepth=p.max_depth,
            minInstancesPerNode=p.min_instances_per_node,
            weightCol="fit_weight",
            seed=p.seed + round_,
        )

    def fit(self, df: DataFrame) -> SammeModel:
        """Fit on assembled rows (``features``, ``label``), each counting as often as its ``_copies`` say, if it has them.

        MLlib holds a leaf's minimum against rows as they come, so tallied rows give the same trees only without one.
        """
        shared_dir(df.sparkSession)
        held = ["_copies"] if "_copies" in df.columns else []
        if held and self.params.min_instances_per_node > 1:
            raise ValueError("tallied rows cannot be fitted with a minimum of rows per leaf")
        copies = F.col("_copies") if held else F.lit(1)
        # Weights start equal; a common factor changes neither trees nor errors.
        rows = kept = df.select("features", "label", *held, F.lit(1.0).alias("w")).persist(StorageLevel.DISK_ONLY)
        trees, alphas, errors, old = [], [], [], None
        try:
            counts = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.sum(copies).alias("n")).collect()}
            total = sum(counts.values())
            balance = F.lit(1.0)
            for label, n in counts.items():
                balance = F.when(F.col("label") == label, total / (len(counts) * n)).otherwise(balance)
            for i in range(self.params.n_estimators):
                tree = self._tree(i).fit(rows.withColumn("fit_weight", F.col("w") * balance * copies))
                if old is not None:
                    old.unpersist()  # the fit has filled its successor
                    old = None
                judged = _predict_only(tree, "vote").transform(rows)
                miss, weight = F.col("vote") != F.col("label"), F.col("w") * copies
                mass, missed = judged.agg(F.sum(weight), F.sum(F.when(miss, weight).otherwise(0.0))).first()
                error = missed / mass
                if error >= CHANCE:
                    if not trees:
                        raise WorseThanChance(SammeModel([flatten(tree)], [1.0], [error], self.params, self.features))
                    break
                alpha = 1.0
                if error > 0:
                    alpha = self.params.learning_rate * (math.log((1 - error) / error) + math.log(K - 1))
                trees.append(flatten(tree))
                alphas.append(alpha)
                errors.append(error)
                if error <= 0 or i + 1 == self.params.n_estimators:
                    break
                mean = ((mass - missed) + missed * math.exp(alpha)) / total
                raised = F.col("w") * F.when(miss, math.exp(alpha)).otherwise(1.0) / mean
                # Weights follow from the rows kept last; plans of persisted rows in each other would double in size every round.
                rows = judged.select("features", "label", *held, raised.alias("w"))
                if (i + 1) % self.checkpoint_every == 0:
                    old, kept = kept, rows.checkpoint(eager=False).persist(StorageLevel.DISK_ONLY)
                    rows = kept
        finally:
            kept.unpersist()
            if old is not None:
                old.unpersist()
        return SammeModel(trees, alphas, errors, self.params, self.features)

    def fit_any(self, df: DataFrame) -> SammeModel:
        """``fit``, or the first tree alone where it is no better than chance and nothing can be boosted."""
        try:
            return self.fit(df)
        except WorseThanChance as unboosted:
            return unboosted.alone
