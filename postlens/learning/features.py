"""Text features: tokens, stop words, hashed counts, IDF."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import (
    IDF,
    CountVectorizer,
    CountVectorizerModel,
    HashingTF,
    IDFModel,
    RegexTokenizer,
    StopWordsRemover,
)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlens.functions.stopwords import MODEL_EXTRA, spark_english


def hashed_counts(text: str, stopwords: Sequence[str] | None = None, num_features: int = 10_000) -> PipelineModel:
    """Tokens without stop words, counted into hash buckets. These stages learn nothing from the rows.

    Without a list, Spark's English words and the model extras are dropped.
    """
    words = spark_english() + MODEL_EXTRA if stopwords is None else list(stopwords)
    return PipelineModel(
        [
            RegexTokenizer(inputCol=text, outputCol="words", pattern="\\W"),
            StopWordsRemover(inputCol="words", outputCol="filtered", stopWords=words),
            HashingTF(inputCol="filtered", outputCol="rawFeatures", numFeatures=num_features),
        ]
    )


def idf_stage(min_doc_freq: int = 5) -> IDF:
    return IDF(inputCol="rawFeatures", outputCol="features", minDocFreq=min_doc_freq)


def text_vectorizer(
    text: str = "body_cleaned",
    stopwords: Sequence[str] | None = None,
    num_features: int = 10_000,
    min_doc_freq: int = 5,
) -> Pipeline:
    """All feature stages, unfitted."""
    return Pipeline(stages=[*hashed_counts(text, stopwords, num_features).stages, idf_stage(min_doc_freq)])


def with_idf(counting: PipelineModel, idf: IDFModel) -> PipelineModel:
    """The vectorizer made of the counting stages and an IDF fitted on rows counted before."""
    return PipelineModel([*counting.stages, idf])


def fit_features(train: DataFrame, test: DataFrame, vectorizer: Pipeline) -> tuple[PipelineModel, DataFrame, DataFrame]:
    """Fit on the training rows only, so nothing of the test rows leaks into the IDF."""
    fitted = vectorizer.fit(train)
    return fitted, fitted.transform(train), fitted.transform(test)


def vocabulary_counts(df: DataFrame, tokens: str, min_df: int = 1) -> DataFrame:
    """The vocabulary as a frame ``(token, df)``: tokens found in at least ``min_df`` rows, however many."""
    seen = df.select(F.explode(F.array_distinct(tokens)).alias("token"))
    return seen.groupBy("token").agg(F.count("*").alias("df")).filter(F.col("df") >= min_df)


def bag_of_words(df: DataFrame, tokens: str, vocabulary: int, min_df: int = 1) -> CountVectorizerModel:
    """A fitted count vectorizer. The model's vocabulary is held by the driver, so its size is stated; if
    more tokens qualify it is refused, not cut."""
    qualified = vocabulary_counts(df, tokens, min_df).count()
    if qualified > vocabulary:
        raise ValueError(f"{qualified} tokens qualify for a vocabulary of {vocabulary}")
    return CountVectorizer(inputCol=tokens, outputCol="features", vocabSize=vocabulary, minDF=float(min_df)).fit(df)
