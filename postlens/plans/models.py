"""Queries that train, tune, save, load and apply classifiers on documents and their labels."""

from __future__ import annotations

from itertools import product

from pyspark.ml import Model, PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from postlens.functions.stopwords import ENGLISH, MODEL_EXTRA, MODEL_SHORT, NLTK_ONLY, SPARK_ONLY
from postlens.learning import classifiers as cf
from postlens.learning import features as ft
from postlens.learning import scoring as sc
from postlens.operators.cleaning import clean_posts
from postlens.operators.metrics import label_report
from postlens.operators.sampling import hash_split
from postlens.plans.registry import query
from postlens.plans.tables import documents, hash_sql, table, word_list_sql
from postlens.session import materialise, scratch_path

TEXT = {"text": "body_cleaned"}


def labelled_counts(spark: SparkSession, sf_dir: str) -> tuple[PipelineModel, DataFrame]:
    """The counting stages, and the hashed term counts of the labelled documents. Texts are counted where
    they are read; the join with the labels moves counts."""
    counting = ft.hashed_counts("body_cleaned")
    posts = clean_posts(documents(spark, sf_dir), TEXT).select("doc_id", "body_cleaned")
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("toxic").cast("double").alias("label"))
    return counting, counting.transform(posts).select("doc_id", "rawFeatures").join(labels, "doc_id")


def vectorised(spark: SparkSession, sf_dir: str) -> tuple[PipelineModel, DataFrame, DataFrame]:
    """The fitted vectorizer, and the features of train and test rows.

    Texts are read once: their term counts are written, and both the IDF and the models start there.
    """
    counting, counted = labelled_counts(spark, sf_dir)
    counted = materialise(counted.select("doc_id", "label", "rawFeatures"), "term-counts")
    train, test = hash_split(counted, "doc_id", 80, 42)
    idf = ft.idf_stage().fit(train)
    return ft.with_idf(counting, idf), *(idf.transform(rows).select("doc_id", "label", "features") for rows in (train, test))


def tree_features(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The same features, with the train rows dealt to tasks that trees can be fitted in. Boosted trees deal them
    themselves."""
    _, train, test = vectorised(spark, sf_dir)
    return cf.spread(train, "doc_id"), test


def wrong_predictions() -> Column:
    """Rows whose prediction is neither 0 nor 1, or not the class with the greatest probability."""
    share = vector_to_array("probability")
    likeliest = F.when(share[1] > share[0], 1.0).otherwise(0.0)
    valid = F.col("prediction").isin(0.0, 1.0) & (F.col("prediction") == likeliest)
    return F.count_if(~F.coalesce(valid, F.lit(False)))


def _train(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Facts that must hold for any model: the rows it learned from and scored, valid predictions, and
    metrics that agree with the confusion cells of the stored predictions."""
    dense = name in ("decision_tree", "random_forest")
    train, test = tree_features(spark, sf_dir) if dense else vectorised(spark, sf_dir)[1:]
    model = cf.make_classifier(name).fit(train)
    scored = model.transform(test).select("doc_id", "label", "prediction", "rawPrediction", "probability")
    scored = materialise(scored, "scored")
    metrics = {row["metric"]: row["value"] for row in cf.evaluate(scored).collect()}
    cells = label_report(scored).select("tp", "fp", "tn", "fn", "accuracy", "recall")
    inside = all(value is None or 0 <= value <= 1 for value in metrics.values())
    agree = F.abs(F.col("accuracy") - F.lit(metrics["accuracy"])) < 1e-9
    rows = scored.agg(F.count("*").alias("n_scored"), wrong_predictions().alias("n_wrong"))
    counted = cells.select((F.col("tp") + F.col("fp") + F.col("tn") + F.col("fn")).alias("n_cells"), agree.alias("agree"))
    found = rows.join(counted, F.col("n_scored") == F.col("n_cells"), "left")
    return found.select(
        F.lit(name).alias("model"),
        F.lit(train.count()).alias("n_train"),
        "n_scored",
        "n_wrong",
        (F.coalesce("agree", F.lit(False)) & F.lit(inside)).alias("metrics_agree"),
    )


def _train_sql(name: str) -> str:
    bucket = hash_sql("doc_id", 100, "42")
    return f"""
SELECT '{name}' AS model, count(*) FILTER (WHERE {bucket} < 80) AS n_train, count(*) FILTER (WHERE {bucket} >= 80) AS n_scored,
       0 AS n_wrong, true AS metrics_agree FROM documents JOIN labels USING (doc_id)"""


@query(_train_sql("logistic_regression"))
def train_lr(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _train(spark, sf_dir, "logistic_regression")


@query(_train_sql("decision_tree"))
def train_dt(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _train(spark, sf_dir, "decision_tree")


@query(_train_sql("random_forest"))
def train_rf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _train(spark, sf_dir, "random_forest")


@query(_train_sql("gradient_boosting"))
def train_gbt(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _train(spark, sf_dir, "gradient_boosting")


def _search(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One row per parameter of each grid cell; scores lie between 0 and 1 and the best is the highest."""
    train, _ = vectorised(spark, sf_dir)[1:] if name in ("lr", "gbt") else tree_features(spark, sf_dir)
    # Fits of trees that each fill the memory run one after the other.
    at_once = 3 if name in ("lr", "gbt") or cf.task_rounds(train) == 1 else 1
    found = cf.cross_validate(train, name, key="doc_id", parallelism=at_once, folds_at_once=name == "gbt")
    scores = cf.grid_scores(found, train)
    highest = scores.agg(F.max("mean_score")).first()[0]
    return scores.select(
        "cell",
        "parameter",
        "value",
        F.col("mean_score").between(0, 1).alias("is_share"),
        (F.col("best") == (F.col("mean_score") == F.lit(highest))).alias("best_is_highest"),
    )


def _search_sql(name: str) -> str:
    grid = cf.GRIDS[cf.full_name(name)]
    cells = [dict(zip(grid, values)) for values in product(*grid.values())]
    rows = [f"({i}, '{key}', {float(value)}, true, true)" for i, cell in enumerate(cells) for key, value in cell.items()]
    return f"""
SELECT * FROM (VALUES {", ".join(rows)}) AS grid(cell, parameter, value, is_share, best_is_highest)
WHERE EXISTS (SELECT 1 FROM documents JOIN labels USING (doc_id))"""


@query(_search_sql("lr"))
def cv_lr(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The logistic-regression grid over four folds."""
    return _search(spark, sf_dir, "lr")


@query(_search_sql("dt"))
def cv_dt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The decision-tree grid over four folds."""
    return _search(spark, sf_dir, "dt")


@query(_search_sql("rf"))
def cv_rf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The random-forest grid over four folds."""
    return _search(spark, sf_dir, "rf")


@query(_search_sql("gbt"))
def cv_gbt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gradient-boosting grid over four folds."""
    return _search(spark, sf_dir, "gbt")


@query("""
SELECT true AS in_range, true AS sums_to_one, true AS some FROM labels LIMIT 1""")
def tree_importances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The importances of a tree's features: shares of 1, for features that exist."""
    train, _ = tree_features(spark, sf_dir)
    found = cf.feature_importances(cf.make_classifier("dt", small=True).fit(train), train)
    return found.agg(
        F.every(F.col("importance").between(0, 1) & F.col("feature").between(0, 9_999)).alias("in_range"),
        (F.abs(F.sum("importance") - 1) < 1e-6).alias("sums_to_one"),
        (F.count("*") > 0).alias("some"),
    )


def _fitted(spark: SparkSession, sf_dir: str) -> tuple[PipelineModel, Model]:
    vectorizer, train, _ = vectorised(spark, sf_dir)
    return vectorizer, cf.make_classifier("lr").fit(train)


def _saved(spark: SparkSession, vectorizer: PipelineModel, model: Model) -> tuple[str, str]:
    paths = scratch_path(spark, "vectorizer"), scratch_path(spark, "model")
    sc.save_model(vectorizer, paths[0])
    sc.save_model(model, paths[1])
    return paths


def _posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_posts(documents(spark, sf_dir, "lang"), TEXT).drop("text")


def _same_as_before_saving(spark: SparkSession, sf_dir: str, vectorizer: PipelineModel, model: Model) -> DataFrame:
    """All documents scored with the model as it was fitted and as it was saved and loaded."""
    posts = sc.transform(_posts(spark, sf_dir), vectorizer, model)
    fitted = posts.select("doc_id", "lang", "body_cleaned", F.col("prediction").alias("before"))
    # One scan: the loaded model scores the same rows, without a join.
    both = sc.score_saved(fitted, *_saved(spark, vectorizer, model))
    return both.select(
        "doc_id", "lang", F.col("prediction").isin(0.0, 1.0).alias("valid"), (F.col("prediction") == F.col("before")).alias("same")
    )


SAME_SQL = "SELECT doc_id, lang, true AS valid, true AS same FROM documents"


@query(SAME_SQL)
def score_saved_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _same_as_before_saving(spark, sf_dir, *_fitted(spark, sf_dir))


@query(SAME_SQL)
def score_saved_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same for a cross-validated model: it scores with the best cell's."""
    vectorizer, train, _ = vectorised(spark, sf_dir)
    return _same_as_before_saving(spark, sf_dir, vectorizer, cf.cross_validate(train, "lr", key="doc_id", parallelism=3))


@query("""
SELECT nth, true AS descending, true AS is_share FROM (
  SELECT row_number() OVER (ORDER BY doc_id) AS nth FROM documents) WHERE nth <= 20""")
def ranked_by_probability(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents most likely to be flagged, most likely first: 20 places, or all documents."""
    vectorizer, model = _fitted(spark, sf_dir)
    # Few documents are toxic, so the model may flag none at its own threshold.
    ranked = sc.ranked_by_probability(sc.transform(_posts(spark, sf_dir), vectorizer, model), 20, "doc_id", only_flagged=False)
    # A list of at most 20 rows: its order is what is looked at.
    listed = materialise(ranked.select("doc_id", "p_flagged").coalesce(1).withColumn("place", F.monotonically_increasing_id()), "ranked")
    by_place = Window.orderBy("place")
    falls = F.coalesce(F.lag("p_flagged").over(by_place) >= F.col("p_flagged"), F.lit(True))
    return listed.select((F.col("place") + 1).alias("nth"), falls.alias("descending"), F.col("p_flagged").between(0, 1).alias("is_share"))


@query("""
WITH tokens AS (SELECT lang, unnest(string_split_regex(lower(text), '[^A-Za-z0-9_]')) AS token FROM documents),
kept AS (SELECT lang, count(*) AS n_tokens FROM tokens WHERE token <> '' AND token NOT IN ('is', 'like', 'and', 'the') GROUP BY lang)
SELECT lang, n_tokens, n_docs FROM kept JOIN (SELECT lang, count(*) AS n_docs FROM documents GROUP BY lang) USING (lang)""")
def hashed_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hashed count vectors summed per language: buckets may mix terms, their total may not change."""
    rows = documents(spark, sf_dir, "lang")
    counted = ft.hashed_counts("text", MODEL_SHORT).transform(rows)
    sums = counted.groupBy("lang").agg(Summarizer.sum(F.col("rawFeatures")).alias("total"), F.count("*").alias("n_docs"))
    total = F.aggregate(vector_to_array("total"), F.lit(0.0), lambda left, right: left + right)
    return sums.select("lang", total.cast("long").alias("n_tokens"), "n_docs")


@query("""
SELECT doc_id, md5(string_agg(token, ' ' ORDER BY i)) AS words_md5 FROM (
  SELECT doc_id, unnest(tokens) AS token, generate_subscripts(tokens, 1) AS i FROM (
    SELECT doc_id, string_split_regex(lower(text), '[^A-Za-z0-9_]') AS tokens FROM documents))
WHERE token <> '' AND token NOT IN ('is', 'like', 'and', 'the') GROUP BY doc_id""")
def feature_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the tokenizer and stop-word stages hand to the hashing stage, with the short word list."""
    rows = documents(spark, sf_dir)
    kept = ft.hashed_counts("text", MODEL_SHORT).transform(rows).filter(F.size("filtered") > 0)
    return kept.select("doc_id", F.md5(F.array_join("filtered", " ")).alias("words_md5"))


@query(f"""
SELECT doc_id, md5(string_agg(token, ' ' ORDER BY i)) AS words_md5 FROM (
  SELECT doc_id, unnest(tokens) AS token, generate_subscripts(tokens, 1) AS i FROM (
    SELECT doc_id, string_split_regex(lower(text), '[^A-Za-z0-9_]') AS tokens FROM documents))
WHERE token <> '' AND token NOT IN {word_list_sql((set(ENGLISH) - set(NLTK_ONLY)) | set(SPARK_ONLY) | set(MODEL_EXTRA))} GROUP BY doc_id""")
def feature_tokens_english(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with Spark's English words and the extras of the models."""
    kept = ft.hashed_counts("text").transform(documents(spark, sf_dir)).filter(F.size("filtered") > 0)
    return kept.select("doc_id", F.md5(F.array_join("filtered", " ")).alias("words_md5"))
