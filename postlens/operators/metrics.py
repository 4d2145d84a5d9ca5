"""Classification metrics as aggregates: one pass over the rows, then a handful of numbers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _is(column: str, value: int) -> Column:
    return F.col(column).cast("double") == value


def confusion_cells(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """tp, fp, tn and fn in one row."""
    return df.agg(
        F.count_if(_is(prediction, 1) & _is(label, 1)).alias("tp"),
        F.count_if(_is(prediction, 1) & _is(label, 0)).alias("fp"),
        F.count_if(_is(prediction, 0) & _is(label, 0)).alias("tn"),
        F.count_if(_is(prediction, 0) & _is(label, 1)).alias("fn"),
    )


def confusion_pairs(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """How often each class was predicted for each actual class: ``(actual, predicted, n)``."""
    pairs = df.select(F.col(label).cast("int").alias("actual"), F.col(prediction).cast("int").alias("predicted"))
    return pairs.groupBy("actual", "predicted").agg(F.count("*").alias("n"))


#: Classes that may become columns.
MAX_CLASSES = 1000


def confusion_matrix(
    df: DataFrame, label: str = "label", prediction: str = "prediction", classes: Sequence[int] | None = None
) -> DataFrame:
    """One row per actual class, one column per predicted class.

    Without a list there is a column for every class predicted, ``MAX_CLASSES`` at most: more are an error, and
    ``confusion_pairs`` gives them as rows. With a list, predictions of other classes (null too) are counted in
    ``predicted_other``, so no row of the input is lost.
    """
    pairs = confusion_pairs(df, label, prediction)
    if classes is None:
        found = pairs.select("predicted").distinct().limit(MAX_CLASSES + 1).collect()
        if len(found) > MAX_CLASSES:
            raise ValueError(f"more than {MAX_CLASSES} classes are predicted; name the classes or use confusion_pairs")
        classes = sorted((row["predicted"] for row in found), key=lambda value: (value is not None, value or 0))
        return _spread(pairs, [value for value in classes if value is not None], None in classes)
    return _spread(pairs, classes, True)


def _spread(pairs: DataFrame, classes: Sequence[int], other: bool) -> DataFrame:
    def total(of: Column, name: str) -> Column:
        return F.sum(F.when(of, F.col("n")).otherwise(0)).alias(name)

    known = F.coalesce(F.col("predicted").isin(list(classes)), F.lit(False)) if classes else F.lit(False)
    columns = [total(F.col("predicted") == value, f"predicted_{value}") for value in classes]
    return pairs.groupBy("actual").agg(*columns, *([total(~known, "predicted_other")] if other else []))


def binary_prf(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Accuracy, and precision, recall and F1 of class 1; null where a divisor is 0."""
    return _with_prf(confusion_cells(df, label, prediction)).drop("tp", "fp", "tn", "fn")


def label_report(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """The confusion cells and the scores made of them, in one row."""
    return _with_prf(confusion_cells(df, label, prediction))


def _with_prf(cells: DataFrame) -> DataFrame:
    tp, fp, tn, fn = (F.col(name) for name in ("tp", "fp", "tn", "fn"))
    return cells.select(
        "*",
        F.try_divide(tp + tn, tp + fp + tn + fn).alias("accuracy"),
        F.try_divide(tp, tp + fp).alias("precision"),
        F.try_divide(tp, tp + fn).alias("recall"),
        F.when((tp + fp > 0) & (tp + fn > 0), F.try_divide(2 * tp, 2 * tp + fp + fn)).alias("f1"),
    )


def weighted_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Accuracy and support-weighted precision, recall and F1 over all classes.

    A class that is never predicted has precision 0. The pair counts are one row per pair of classes.
    """
    pairs = df.select(F.col(label).cast("double").alias("actual"), F.col(prediction).cast("double").alias("predicted"))
    pairs = pairs.dropna().groupBy("actual", "predicted").agg(F.count("*").alias("n"))
    # Each pair counts once as actual and once as predicted, so one grouping gives both totals.
    sides = pairs.select(
        F.col("n"),
        (F.col("actual") == F.col("predicted")).alias("hit"),
        F.explode(F.array(F.struct(F.col("actual").alias("cls"), F.lit(True).alias("is_actual")),
                          F.struct(F.col("predicted").alias("cls"), F.lit(False).alias("is_actual")))).alias("side"),
    ).select("n", "hit", "side.*")
    per_class = sides.groupBy("cls").agg(
        F.sum(F.when(F.col("is_actual") & F.col("hit"), F.col("n")).otherwise(0)).alias("tp"),
        F.sum(F.when(F.col("is_actual"), F.col("n")).otherwise(0)).alias("support"),
        F.sum(F.when(~F.col("is_actual"), F.col("n")).otherwise(0)).alias("predicted"),
    )
    zero = F.lit(0.0)
    per_class = per_class.select(
        "tp",
        "support",
        F.coalesce(F.try_divide("tp", "predicted"), zero).alias("precision"),
        F.coalesce(F.try_divide("tp", "support"), zero).alias("recall"),
        F.coalesce(F.try_divide(2 * F.col("tp"), F.col("support") + F.col("predicted")), zero).alias("f1"),
    )
    total = F.sum("support")
    return per_class.agg(
        F.try_divide(F.sum("tp"), total).alias("accuracy"),
        F.try_divide(F.sum(F.col("precision") * F.col("support")), total).alias("weighted_precision"),
        F.try_divide(F.sum(F.col("recall") * F.col("support")), total).alias("weighted_recall"),
        F.try_divide(F.sum(F.col("f1") * F.col("support")), total).alias("weighted_f1"),
    )


def hard_auc(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Areas under ROC and PR when the 0/1 prediction itself is the score.

    The curves then have one inner point, so both areas are sums of two trapezoids.
    """
    cells = confusion_cells(df, label, prediction)
    tp, fp, tn, fn = (F.col(name) for name in ("tp", "fp", "tn", "fn"))
    recall, specificity = F.try_divide(tp, tp + fn), F.try_divide(tn, tn + fp)
    share = F.try_divide(tp + fn, tp + fp + tn + fn)
    precision = F.coalesce(F.try_divide(tp, tp + fp), F.lit(1.0))
    return cells.select(
        ((recall + specificity) / 2).alias("area_under_roc"),
        (recall * precision + (1 - recall) * (precision + share) / 2).alias("area_under_pr"),
    )


def metric_rows(metrics: DataFrame, model: str) -> DataFrame:
    """A one-row metric frame as rows ``(model, metric, value)`` with two decimals."""
    rows = metrics.unpivot([], metrics.columns, "metric", "value")
    return rows.select(F.lit(model).alias("model"), "metric", F.round("value", 2).alias("value"))


def misclassified(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    return df.filter(F.col(prediction) != F.col(label))
