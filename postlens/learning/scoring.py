"""Saved models and batch scoring."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.ml import Model, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassificationModel,
    GBTClassificationModel,
    LogisticRegressionModel,
    RandomForestClassificationModel,
)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidatorModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlens.operators.cleaning import flagged
from postlens.schemas import HELPER_COLUMNS

READERS = {
    reader.__name__: reader
    for reader in (
        PipelineModel,
        CrossValidatorModel,
        LogisticRegressionModel,
        DecisionTreeClassificationModel,
        RandomForestClassificationModel,
        GBTClassificationModel,
    )
}


def save_model(model: Model, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(spark: SparkSession, path: str) -> Model:
    """Load a saved model of any kind used here; its own metadata names the kind."""
    metadata = json.loads(spark.read.text(f"{path.rstrip('/')}/metadata").first()["value"])
    kind = metadata["class"].rsplit(".", 1)[-1]
    if kind not in READERS:
        raise ValueError(f"no reader for {metadata['class']}")
    return READERS[kind].load(path)


def transform(posts: DataFrame, vectorizer: Model, model: Model) -> DataFrame:
    return model.transform(vectorizer.transform(posts))


def score(posts: DataFrame, vectorizer: Model, model: Model, drop: Sequence[str] = HELPER_COLUMNS) -> DataFrame:
    """Predictions next to the posts. A narrow plan: every task scores its own rows, without a shuffle."""
    return transform(posts, vectorizer, model).drop(*drop)


def score_saved(posts: DataFrame, vectorizer_path: str, model_path: str) -> DataFrame:
    spark = posts.sparkSession
    return score(posts, load_model(spark, vectorizer_path), load_model(spark, model_path))


def ranked_by_probability(scored: DataFrame, n: int = 20, key: str = "comment_id", only_flagged: bool = True) -> DataFrame:
    """Rows with the highest probability of class 1, by default among the flagged ones."""
    ranked = (flagged(scored) if only_flagged else scored).withColumn("p_flagged", vector_to_array("probability")[1])
    return ranked.orderBy(F.desc("p_flagged"), key).limit(n)
