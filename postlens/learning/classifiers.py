"""Classifiers by name, cross-validation, and fitted models as tables."""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence
from itertools import product
from multiprocessing.pool import ThreadPool

import numpy as np
from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Model
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlens.learning.nested import NestedBoosting, NestedForest, NestedTree
from postlens.operators.metrics import hard_auc, weighted_metrics
from postlens.operators.sampling import fold_number
from postlens.session import materialise

# The settings the published models were trained with.
DEFAULTS: dict[str, tuple[Callable[..., Estimator], dict]] = {
    "logistic_regression": (LogisticRegression, {"maxIter": 5, "regParam": 0.3, "elasticNetParam": 0.0}),
    "decision_tree": (NestedTree, {"maxDepth": 5, "minInfoGain": 0.001, "impurity": "entropy"}),
    "random_forest": (
        NestedForest,
        {"numTrees": 100, "maxDepth": 5, "minInfoGain": 0.001, "impurity": "entropy"},
    ),
    "gradient_boosting": (NestedBoosting, {"maxIter": 5, "maxDepth": 5}),
}
# The smaller settings of the cloud and notebook models.
SMALL = {
    "logistic_regression": {},
    "decision_tree": {"maxDepth": 3},
    "random_forest": {"numTrees": 20, "maxDepth": 3, "maxBins": 32, "minInfoGain": 0.0, "impurity": "gini"},
    "gradient_boosting": {"maxIter": 3},
}
# Short names of the classifiers.
SHORT_NAMES = {
    "lr": "logistic_regression",
    "dt": "decision_tree",
    "rf": "random_forest",
    "gbt": "gradient_boosting",
}
# The parameter grids searched by cross-validation.
GRIDS: dict[str, dict[str, list]] = {
    "logistic_regression": {"regParam": [0.1, 0.3, 0.5]},
    "decision_tree": {"maxDepth": [2, 5, 10]},
    "random_forest": {"numTrees": [10, 50, 100], "maxDepth": [2, 5, 10]},
    "gradient_boosting": {"maxDepth": [2, 5, 10], "maxIter": [5, 10]},
}
#: Rows of a task that fits trees. Trees keep a number for each feature of a row, 40 kB of 10,000 features, and a
#: boosting step reads them up to three times.
TREE_ROWS = 8192


def full_name(name: str) -> str:
    found = SHORT_NAMES.get(name.lower(), name.lower())
    if found not in DEFAULTS:
        raise ValueError(f"unknown classifier {name!r}; known are {sorted(DEFAULTS)}")
    return found


def make_classifier(name: str, label: str = "label", features: str = "features", small: bool = False, **params) -> Estimator:
    """An unfitted classifier; given parameters go before the defaults."""
    known = full_name(name)
    kind, defaults = DEFAULTS[known]
    settings = {**defaults, **(SMALL[known] if small else {}), **params}
    return kind(labelCol=label, featuresCol=features, **settings)


def spread(train: DataFrame, key: str, rows: int = TREE_ROWS) -> DataFrame:
    """The rows dealt by their key to tasks of about so many rows: more rows give more tasks, not larger ones."""
    cores = train.sparkSession.sparkContext.defaultParallelism
    return train.repartition(task_rounds(train, rows) * cores, key)


def task_rounds(train: DataFrame, rows: int = TREE_ROWS) -> int:
    """How many tasks of so many rows each core has."""
    return max(1, math.ceil(train.count() / (rows * train.sparkSession.sparkContext.defaultParallelism)))


def param_grid(estimator: Estimator, values: Mapping[str, Sequence]) -> list[dict]:
    """All combinations of the estimator's own parameters; a parameter it lacks is an error."""
    for name in values:
        if not estimator.hasParam(name):
            raise ValueError(f"{type(estimator).__name__} has no parameter {name!r}")
    params = [estimator.getParam(name) for name in values]
    return [dict(zip(params, cell)) for cell in product(*values.values())]


class FoldsAtOnce(CrossValidator):
    """A search that fits all folds side by side: for fits that are many short jobs and hold little. A fold's train rows are
    not kept, as a boosted fit reads them once."""

    def _fold_scores(self, train: DataFrame, validation: DataFrame) -> list[float]:
        cells, evaluator = self.getEstimatorParamMaps(), self.getEvaluator()
        models = self.getEstimator().fitMultiple(train, cells)
        validation = validation.persist()

        def score(_) -> tuple[int, float]:
            cell, model = next(models)
            return cell, evaluator.evaluate(model.transform(validation, cells[cell]))

        try:
            with ThreadPool(min(self.getParallelism(), len(cells))) as pool:
                scores = dict(pool.map(inheritable_thread_target(train.sparkSession)(score), cells, 1))
        finally:
            validation.unpersist()
        return [scores[cell] for cell in range(len(cells))]

    def _fit(self, dataset: DataFrame) -> CrossValidatorModel:
        folds = self._kFold(dataset)
        with ThreadPool(len(folds)) as pool:
            scores = np.array(pool.starmap(inheritable_thread_target(dataset.sparkSession)(self._fold_scores), folds, 1))
        means = scores.mean(axis=0)
        best = int(means.argmax() if self.getEvaluator().isLargerBetter() else means.argmin())
        model = self.getEstimator().fit(dataset, self.getEstimatorParamMaps()[best])
        return self._copyValues(CrossValidatorModel(model, means.tolist(), stdMetrics=scores.std(axis=0).tolist()))


def cross_validate(
    train: DataFrame,
    name: str,
    label: str = "label",
    key: str | None = None,
    folds: int = 4,
    parallelism: int = 2,
    grid: Mapping[str, Sequence] | None = None,
    metric: str = "accuracy",
    folds_at_once: bool = False,
    **params,
) -> CrossValidatorModel:
    """Search a classifier's grid. With a key, folds follow its hash and repeat from run to run.

    Hand in a frame that is written or persisted: every fit reads it, once per fold. Tree models are fitted once
    for all cells that differ in depth or number of trees only (``nested``).
    """
    known = full_name(name)
    estimator = make_classifier(known, label, **params)
    cells = param_grid(estimator, GRIDS[known] if grid is None else grid)
    evaluator = MulticlassClassificationEvaluator(labelCol=label, predictionCol="prediction", metricName=metric)
    search = (FoldsAtOnce if folds_at_once else CrossValidator)(
        estimator=estimator, estimatorParamMaps=cells, evaluator=evaluator, numFolds=folds, parallelism=parallelism
    )
    if key is not None:
        train = train.withColumn("fold", fold_number(F.col(key), folds))
        search.setFoldCol("fold")
    return search.fit(train)


def grid_scores(model: CrossValidatorModel, df: DataFrame) -> DataFrame:
    """Mean score of each grid cell, best first; a row per parameter of a cell."""
    scores = [float(score) for score in model.avgMetrics]
    best = max(scores) if model.getEvaluator().isLargerBetter() else min(scores)
    rows = [
        (cell, param.name, float(value), score, score == best)
        for cell, (values, score) in enumerate(zip(model.getEstimatorParamMaps(), scores))
        for param, value in values.items()
    ]
    schema = "cell int, parameter string, value double, mean_score double, best boolean"
    return df.sparkSession.createDataFrame(rows, schema)


def tree_text(model: Model) -> str:
    return model.toDebugString


def feature_importances(model: Model, df: DataFrame) -> DataFrame:
    """Importance of each feature bucket the trees use."""
    vector = model.featureImportances
    rows = [(int(i), float(v)) for i, v in zip(vector.indices, vector.values)]
    return df.sparkSession.createDataFrame(rows, "feature int, importance double")


def evaluate(predictions: DataFrame, label: str = "label") -> DataFrame:
    """All metrics as rows ``(metric, value)``: two aggregates, and the areas by probability score."""
    kept = [name for name in (label, "prediction", "rawPrediction") if name in predictions.columns]
    # Written once: every metric reads it, and no prediction is computed twice.
    predictions = materialise(predictions.select(*kept), "predictions")
    weighted = weighted_metrics(predictions, label)
    hard = hard_auc(predictions, label)
    rows = weighted.unpivot([], weighted.columns, "metric", "value").unionByName(
        hard.unpivot([], hard.columns, "metric", "value")
    )
    if "rawPrediction" not in predictions.columns:
        return rows
    scored = [
        (f"{metric}_by_score", BinaryClassificationEvaluator(labelCol=label, metricName=curve).evaluate(predictions))
        for metric, curve in (("area_under_roc", "areaUnderROC"), ("area_under_pr", "areaUnderPR"))
    ]
    return rows.unionByName(predictions.sparkSession.createDataFrame(scored, "metric string, value double"))
