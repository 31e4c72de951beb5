"""Fitted trees as flat arrays: scored together in one pass, saved as one table."""

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from formbook.schemas import CLASSES

K = len(CLASSES)
NODE_SCHEMA = "tree int, node int, feature int, threshold double, right int, label int"


@dataclass(frozen=True)
class Tree:
    """Nodes in preorder. A value up to the threshold goes to the next node, any other and NaN to ``right``; a leaf has feature -1."""

    feature: list[int]
    threshold: list[float]
    right: list[int]
    label: list[int]
    importance: list[float]


def flatten(model: RandomForestClassificationModel) -> Tree:
    """The one tree of a model, from its printed form, which gives thresholds in full."""
    feature, threshold, right, label = [], [], [], []
    waiting: list[int] = []  # splits whose left side is not complete
    for line in model.trees[0].toDebugString.splitlines()[1:]:
        words = line.replace(")", "").split()
        if not words:
            continue
        if words[0] == "Else":
            right[waiting.pop()] = len(feature)
            continue
        split = words[0] == "If"  # "If (feature 3 <= 0.5)"; a leaf is "Predict: 2.0"
        if split:
            waiting.append(len(feature))
        feature.append(int(words[2]) if split else -1)
        threshold.append(float(words[4]) if split else 0.0)
        right.append(-1)
        label.append(-1 if split else int(float(words[1])))
    return Tree(feature, threshold, right, label, [float(v) for v in model.featureImportances.toArray()])


class Forest:
    """Trees laid one after the other, with their says in the vote."""

    def __init__(self, trees: list[Tree], alphas: list[float]):
        def joined(name: str, kind) -> np.ndarray:
            return np.array([v for t in trees for v in getattr(t, name)], kind)

        sizes = [len(t.feature) for t in trees]
        self.roots = np.cumsum([0, *sizes])[:-1]
        self.feature, self.threshold = joined("feature", np.int32), joined("threshold", np.float64)
        self.label = joined("label", np.int8)
        self.right = joined("right", np.int32) + np.repeat(self.roots, sizes).astype(np.int32)
        self.alphas = np.array(alphas, np.float64)

    def votes(self, x: np.ndarray, tree: int) -> np.ndarray:
        """Label that one tree gives each row."""
        at = np.full(len(x), self.roots[tree], np.int32)
        rows = np.arange(len(x))
        while len(rows):
            feature = self.feature[at[rows]]
            rows, feature = rows[feature >= 0], feature[feature >= 0]
            node = at[rows]
            left = x[rows, feature] <= self.threshold[node]  # false for NaN
            at[rows] = np.where(left, node + 1, self.right[node])
        return self.label[at]

    def scores(self, x: np.ndarray, after: Callable[[int, np.ndarray], None] | None = None) -> np.ndarray:
        """Says for less says against each class; ``after`` sees their raw sums after every tree."""
        total = self.alphas.sum() or 1.0
        sums = np.zeros((len(x), K))
        for i, alpha in enumerate(self.alphas if after else self.alphas / total):
            against = -alpha / (K - 1)
            sums += np.where(self.votes(x, i)[:, None] == np.arange(K), alpha, against)
            if after:
                after(i, sums)
        return sums


def matrix(column: pa.Array) -> np.ndarray:
    """Rows of an array column."""
    width = len(column[0]) if len(column) else 1
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def vote_scores(forest: Forest, features: str = "features") -> Column:
    """Class scores of a vector column, all trees in one expression."""

    @F.arrow_udf("array<double>")
    def score(x: pa.Array) -> pa.Array:
        found = forest.scores(matrix(x))
        ends = pa.array(np.arange(0, found.size + 1, K, dtype=np.int32))
        return pa.ListArray.from_arrays(ends, pa.array(found.ravel()))

    return score(vector_to_array(features))


def staged_outcomes(
    df: DataFrame, forest: Forest, sizes: list[int] | None = None, by: str | None = None,
    features: str = "features", label: str = "label",
) -> DataFrame:
    """``trees, y_true, y_pred, n``: outcomes of the first 1, 2, ... trees, or of ``sizes`` only, in one pass.

    With ``by``, a boolean column, apart for its values. A row counts as often as its ``_copies`` say, if it has them.
    A task sends one row per size and pair of classes.
    """
    wanted = sorted(set(sizes or range(1, len(forest.alphas) + 1)))
    place = {n: i for i, n in enumerate(wanted)}

    def count(batches):
        cells = np.zeros((2, len(wanted), K, K), np.int64)
        for batch in batches:
            truth = batch.column("y").to_numpy(zero_copy_only=False).astype(np.int64)
            group = batch.column("g").to_numpy(zero_copy_only=False).astype(np.int64)
            copies = batch.column("_copies").to_numpy(zero_copy_only=False).astype(np.int64)

            def after(i: int, sums: np.ndarray) -> None:
                if i + 1 in place:
                    np.add.at(cells, (group, place[i + 1], truth, sums.argmax(1)), copies)

            forest.scores(matrix(batch.column("x")), after)
        g, i, t, p = np.nonzero(cells)
        names = pa.array(CLASSES)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(g.astype(bool)), pa.array(np.array(wanted, np.int32)[i]), names.take(pa.array(t)),
                names.take(pa.array(p)), pa.array(cells[g, i, t, p]),
            ],
            ["g", "trees", "y_true", "y_pred", "n"],
        )

    group = F.col(by) if by else F.lit(False)
    copies = F.col("_copies") if "_copies" in df.columns else F.lit(1).alias("_copies")
    rows = df.select(vector_to_array(features).alias("x"), F.col(label).cast("int").alias("y"), group.alias("g"), copies)
    rows = rows.filter(F.col("y").isNotNull())
    counted = rows.mapInArrow(count, "g boolean, trees int, y_true string, y_pred string, n long")
    keys = [F.col("g").alias(by)] if by else []
    return counted.groupBy(*keys, "trees", "y_true", "y_pred").agg(F.sum("n").alias("n"))


def save_trees(spark: SparkSession, trees: list[Tree], path: str) -> None:
    """All trees as one small table."""
    rows = [
        (i, j, *node) for i, t in enumerate(trees) for j, node in enumerate(zip(t.feature, t.threshold, t.right, t.label))
    ]
    spark.createDataFrame(rows, NODE_SCHEMA).coalesce(1).write.mode("overwrite").parquet(path)


def load_trees(spark: SparkSession, path: str, importances: list[list[float]]) -> list[Tree]:
    nodes: list[list] = [[] for _ in importances]
    for r in spark.read.schema(NODE_SCHEMA).parquet(path).orderBy("tree", "node").collect():  # the model itself
        nodes[r["tree"]].append((r["feature"], r["threshold"], r["right"], r["label"]))
    return [Tree(*map(list, zip(*n)), importance=i) for n, i in zip(nodes, importances)]
