"""Queries that score predictions against labels, label rows and read sentiment."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlens.functions.stopwords import ENGLISH
from postlens.functions.text import report_tokens
from postlens.functions.values import label_to_int
from postlens.operators import labeling as lb
from postlens.operators import metrics as mt
from postlens.plans.registry import query
from postlens.plans.tables import RULE_SQL, documents, rule_predictions, table, words_sql
from postlens.session import scratch_path
from postlens.sources.writers import write_metrics

CELLS_SQL = f"""{RULE_SQL},
cells AS (
  SELECT count(*) FILTER (WHERE prediction = 1 AND label = 1) AS tp, count(*) FILTER (WHERE prediction = 1 AND label = 0) AS fp,
         count(*) FILTER (WHERE prediction = 0 AND label = 0) AS tn, count(*) FILTER (WHERE prediction = 0 AND label = 1) AS fn
  FROM rules)"""

WEIGHTED_SQL = """per_class AS (
  SELECT tp, tp + fp AS predicted, tp + fn AS support FROM cells UNION ALL SELECT tn, tn + fn, tn + fp FROM cells),
scores AS (
  SELECT tp, support, coalesce(tp / nullif(predicted, 0), 0) AS p, coalesce(tp / nullif(support, 0), 0) AS r,
         coalesce(2 * tp / nullif(support + predicted, 0), 0) AS f FROM per_class),
weighted AS (
  SELECT sum(tp) / sum(support) AS accuracy, sum(p * support) / sum(support) AS weighted_precision,
         sum(r * support) / sum(support) AS weighted_recall, sum(f * support) / sum(support) AS weighted_f1 FROM scores)"""


def _rounded(df: DataFrame) -> DataFrame:
    return df.select(*[F.round(name, 6).alias(name) for name in df.columns])


@query(f"WITH {CELLS_SQL} SELECT tp, fp, tn, fn FROM cells")
def confusion_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mt.confusion_cells(rule_predictions(spark, sf_dir))


@query(f"""
WITH {RULE_SQL}
SELECT label AS actual, count(*) FILTER (WHERE prediction = 0) AS predicted_0, count(*) FILTER (WHERE prediction = 1) AS predicted_1
FROM rules GROUP BY label""")
def confusion_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mt.confusion_matrix(rule_predictions(spark, sf_dir))


@query(f"""
WITH {CELLS_SQL}
SELECT round((tp + tn) / (tp + fp + tn + fn), 6) AS accuracy, round(tp / nullif(tp + fp, 0), 6) AS precision,
       round(tp / nullif(tp + fn, 0), 6) AS recall, round(2 * tp / nullif(2 * tp + fp + fn, 0), 6) AS f1 FROM cells""")
def binary_prf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(mt.binary_prf(rule_predictions(spark, sf_dir)))


@query(f"""
WITH {CELLS_SQL}, {WEIGHTED_SQL}
SELECT round(accuracy, 6) AS accuracy, round(weighted_precision, 6) AS weighted_precision,
       round(weighted_recall, 6) AS weighted_recall, round(weighted_f1, 6) AS weighted_f1 FROM weighted""")
def weighted_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(mt.weighted_metrics(rule_predictions(spark, sf_dir)))


@query(f"""
WITH {CELLS_SQL},
rates AS (
  SELECT tp / (tp + fn) AS r, tn / (tn + fp) AS s, coalesce(tp / nullif(tp + fp, 0), 1) AS p, (tp + fn) / (tp + fp + tn + fn) AS share
  FROM cells)
SELECT round((r + s) / 2, 6) AS area_under_roc, round(r * p + (1 - r) * (p + share) / 2, 6) AS area_under_pr FROM rates""")
def auc_hard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(mt.hard_auc(rule_predictions(spark, sf_dir)))


@query(f"""
WITH {CELLS_SQL}, {WEIGHTED_SQL},
rounded AS (SELECT round(accuracy, 2) AS accuracy, round(weighted_precision, 2) AS weighted_precision,
  round(weighted_recall, 2) AS weighted_recall, round(weighted_f1, 2) AS weighted_f1 FROM weighted)
SELECT 'quality_rule' AS model, metric, value FROM (UNPIVOT rounded ON COLUMNS(*) INTO NAME metric VALUE value)""")
def metric_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report written to a table and read back."""
    path = scratch_path(spark, "metrics")
    write_metrics(mt.metric_rows(mt.weighted_metrics(rule_predictions(spark, sf_dir)), "quality_rule"), path)
    return spark.read.parquet(path)


@query(f"""
WITH {RULE_SQL} SELECT doc_id, label, prediction FROM rules WHERE prediction <> label""")
def misclassified_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mt.misclassified(rule_predictions(spark, sf_dir))


KEYWORDS = ["password", "license", "secret", "token"]
KEYWORD_SQL = "(" + " OR ".join(f"contains(lower(text), '{word}')" for word in KEYWORDS) + ")"


@query(f"""
SELECT doc_id, CASE WHEN {KEYWORD_SQL} THEN 'yes' ELSE 'no' END AS label,
       CASE WHEN {KEYWORD_SQL} THEN 1 ELSE 0 END AS label_int FROM documents""")
def keyword_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled = lb.label_with(documents(spark, sf_dir), "text", lb.keyword_labeler(KEYWORDS), columns=["doc_id"])
    return lb.with_label_int(labelled).select("doc_id", "label", "label_int")


@query(f"""
SELECT doc_id, CASE WHEN {KEYWORD_SQL} THEN 'yes' ELSE 'no' END AS label,
       (SELECT count(DISTINCT text) FROM documents) AS n_answers FROM documents""")
def keyword_label_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels through a store of answers: two pulls, the second of which holds all of the first. A text is asked
    about once, however many rows and pulls hold it."""
    store = scratch_path(spark, "answers")
    docs, labeler = documents(spark, sf_dir), lb.keyword_labeler(KEYWORDS)
    lb.label_with_store(docs.filter("doc_id % 2 = 0"), "text", labeler, store)
    labelled = lb.label_with_store(docs, "text", labeler, store, columns=["doc_id"])
    # Counted by rows of the store: a text asked about twice would be two.
    answers = spark.read.schema(lb.ANSWERS).parquet(store)
    return labelled.select("doc_id", "label", answers.agg(F.count("*")).scalar().alias("n_answers"))


@query(f"""
WITH answers AS (SELECT doc_id, CASE WHEN {KEYWORD_SQL} THEN 1 ELSE 0 END AS guess FROM documents),
pairs AS (SELECT guess, toxic FROM answers JOIN labels USING (doc_id)),
c AS (SELECT count(*) FILTER (WHERE guess = 1 AND toxic = 1) AS tp, count(*) FILTER (WHERE guess = 1 AND toxic = 0) AS fp,
  count(*) FILTER (WHERE guess = 0 AND toxic = 0) AS tn, count(*) FILTER (WHERE guess = 0 AND toxic = 1) AS fn FROM pairs)
SELECT tp, fp, tn, fn, round((tp + tn) / (tp + fp + tn + fn), 6) AS accuracy, round(tp / nullif(tp + fp, 0), 6) AS precision,
       round(tp / nullif(tp + fn, 0), 6) AS recall,
       CASE WHEN tp + fp > 0 AND tp + fn > 0 THEN round(2 * tp / (2 * tp + fp + fn), 6) END AS f1 FROM c""")
def label_vs_truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A labeler's answers against the reviewed labels."""
    truth = table(spark, sf_dir, "labels").select("doc_id", F.col("toxic").alias("label"))
    answers = lb.label_with(documents(spark, sf_dir), "text", lb.keyword_labeler(KEYWORDS), "answer", columns=["doc_id"])
    report = mt.label_report(answers.join(truth, "doc_id").withColumn("prediction", label_to_int(F.col("answer"))))
    return report.withColumns({name: F.round(name, 6) for name in ("accuracy", "precision", "recall", "f1")})


# A lexicon of made-up words of the given texts.
LEXICON = {"heon": 1.0, "thin": 0.5, "reti": 2.0, "onen": -1.0, "therre": -0.5, "der": -1.5, "los": 1.0, "les": -1.0}
LEXICON_SQL = ", ".join(f"('{word}', {score})" for word, score in LEXICON.items())


@query(f"""
WITH {words_sql()}, lexicon(token, score) AS (VALUES {LEXICON_SQL}),
scores AS (
  SELECT doc_id, sum(coalesce(score, 0)) / count(*) AS score FROM words LEFT JOIN lexicon USING (token) GROUP BY doc_id)
SELECT doc_id, round(coalesce(score, 0), 6) AS score,
       CASE WHEN score > 0 THEN 'Positive' WHEN score < 0 THEN 'Negative' ELSE 'Neutral' END AS sentiment
FROM documents LEFT JOIN scores USING (doc_id)""")
def lexicon_sentiment(spark: SparkSession, sf_dir: str) -> DataFrame:
    lexicon = spark.createDataFrame(list(LEXICON.items()), "token string, score double")
    tokens = report_tokens(F.col("text"), ENGLISH)
    rows = lb.lexicon_sentiment(documents(spark, sf_dir), "doc_id", tokens, lexicon)
    return rows.withColumn("score", F.round("score", 6))
