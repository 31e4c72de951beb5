"""Classification metrics from the grouped (true, predicted) counts.

The rows are aggregated once to at most K x K counts; everything else is
arithmetic on those.
"""

from pyspark.sql import Column, DataFrame, functions as F

from formbook.schemas import CLASSES


def outcome_counts(
    df: DataFrame, true: str = "y_true", pred: str = "y_pred", by: list[str] | None = None
) -> DataFrame:
    return df.groupBy(*(by or []), F.col(true).alias("y_true"), F.col(pred).alias("y_pred")).agg(
        F.count(F.lit(1)).alias("n")
    )


def confusion_matrix(df: DataFrame, true: str = "y_true", pred: str = "y_pred") -> DataFrame:
    """Full K x K grid, zeros included."""
    cells = [
        F.coalesce(F.sum(F.when(F.col("y_pred") == c, F.col("n"))), F.lit(0)).alias(f"pred_{c.lower()}")
        for c in CLASSES
    ]
    return (
        _per_label(outcome_counts(df, true, pred))
        .withColumn("n", F.when(F.col("y_true") == F.col("label"), F.col("n")))
        .groupBy("label")
        .agg(*cells)
        .withColumnRenamed("label", "y_true")
    )


def _per_label(counts: DataFrame) -> DataFrame:
    return counts.withColumn("label", F.explode(F.array(*map(F.lit, CLASSES))))


def _ratio(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part, whole), F.lit(0.0)).cast("double")


def per_class_metrics(
    df: DataFrame, true: str = "y_true", pred: str = "y_pred", by: list[str] | None = None
) -> DataFrame:
    """Precision, recall, F1 and support per class; 0 where undefined."""
    return per_class_of_counts(outcome_counts(df, true, pred, by), by)


def per_class_of_counts(counts: DataFrame, by: list[str] | None = None) -> DataFrame:
    """The same from ``y_true, y_pred, n``."""

    def total(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0))

    is_true, is_pred = F.col("y_true") == F.col("label"), F.col("y_pred") == F.col("label")
    return (
        _per_label(counts)
        .groupBy(*(by or []), "label")
        .agg(
            total(is_true & is_pred).alias("hits"),
            total(is_pred).alias("predicted"),
            total(is_true).alias("support"),
        )
        .withColumn("precision", _ratio(F.col("hits"), F.col("predicted")))
        .withColumn("recall", _ratio(F.col("hits"), F.col("support")))
        .withColumn("f1", _ratio(2.0 * F.col("hits"), F.col("predicted") + F.col("support")))
    )


def _averages() -> dict[str, Column]:
    support = F.sum("support")
    seen = (F.col("support") + F.col("predicted")) > 0

    def weighted(name: str) -> Column:
        return _ratio(F.sum(F.col(name) * F.col("support")), support)

    def macro(name: str) -> Column:
        return F.coalesce(F.avg(F.when(seen, F.col(name))), F.lit(0.0))

    return {
        "accuracy": _ratio(F.sum("hits"), support),
        "precision": weighted("precision"),
        "recall": weighted("recall"),
        "f1_score": weighted("f1"),
        "macro_precision": macro("precision"),
        "macro_recall": macro("recall"),
        "macro_f1": macro("f1"),
        "support": F.coalesce(support, F.lit(0)),
    }


def averaged_metrics(
    df: DataFrame, names: list[str], true: str, pred: str, by: list[str] | None = None
) -> DataFrame:
    """The named averages over the classes, per group of ``by``."""
    return averages_of_counts(outcome_counts(df, true, pred, by), names, by)


def averages_of_counts(counts: DataFrame, names: list[str], by: list[str] | None = None) -> DataFrame:
    """The same from ``y_true, y_pred, n``."""
    averages = _averages()
    classes = per_class_of_counts(counts, by)
    return classes.groupBy(*(by or [])).agg(*[averages[n].alias(n) for n in names])


def classification_metrics(df: DataFrame, true: str = "y_true", pred: str = "y_pred") -> DataFrame:
    """Accuracy and support-weighted precision, recall and F1."""
    return averaged_metrics(df, ["accuracy", "precision", "recall", "f1_score"], true, pred)


def macro_f1(df: DataFrame, true: str = "y_true", pred: str = "y_pred") -> DataFrame:
    """Unweighted mean F1 over the classes that occur on either side."""
    return averaged_metrics(df, ["macro_f1"], true, pred)


def classification_report(df: DataFrame, true: str = "y_true", pred: str = "y_pred") -> DataFrame:
    """Per-class lines, accuracy, macro and weighted averages."""
    classes = per_class_metrics(df, true, pred).select("label", "precision", "recall", "f1", "support")
    total = averaged_metrics(df, list(_averages()), true, pred)
    nothing = F.lit(None).cast("double")
    lines = [
        total.select(
            F.lit(name).alias("label"), p.alias("precision"), r.alias("recall"), f.alias("f1"), "support"
        )
        for name, p, r, f in (
            ("accuracy", nothing, nothing, F.col("accuracy")),
            ("macro avg", F.col("macro_precision"), F.col("macro_recall"), F.col("macro_f1")),
            ("weighted avg", F.col("precision"), F.col("recall"), F.col("f1_score")),
        )
    ]
    return classes.unionByName(lines[0]).unionByName(lines[1]).unionByName(lines[2])


def label_domain_check(df: DataFrame, label: str) -> DataFrame:
    """Rows per label and whether the label is a known class."""
    return df.groupBy(F.col(label).alias("label")).agg(F.count(F.lit(1)).alias("n")).withColumn(
        "known", F.coalesce(F.col("label").isin(CLASSES), F.lit(False))
    )


def generalisation_gap(df: DataFrame, cv: str = "cv_score", test: str = "test_score") -> DataFrame:
    """Cross-validation minus test score, and what that says."""
    gap = F.col(cv) - F.col(test)
    verdict = (
        F.when(F.abs(gap) < 0.03, "generalises well")
        .when(gap > 0.05, "possible overfitting")
        .otherwise("acceptable")
    )
    return df.withColumn("gap", gap).withColumn("verdict", verdict)
