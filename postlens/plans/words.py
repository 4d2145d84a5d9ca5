"""Queries over texts: cleaning, tokens, n-grams, TF-IDF."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from postlens.functions import text as tx
from postlens.functions.stopwords import ENGLISH, EXPLORATION, MODEL_SHORT
from postlens.learning.features import hashed_counts, idf_stage, vocabulary_counts
from postlens.operators import frequency as fq
from postlens.operators import idf_state
from postlens.plans.registry import query
from postlens.plans.tables import (
    ENGLISH_SQL,
    EXPLORATION_SQL,
    SPACES_SQL,
    URL_SQL,
    documents,
    flagged_ids,
    grams_sql,
    letters_sql,
    table,
    with_flag,
    word_list_sql,
    words_sql,
)
from postlens.session import materialise, scratch_path

FLAGGED_SQL = "(SELECT doc_id FROM labels WHERE toxic = 1)"


def _letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as lower-case letter tokens; the text itself goes no further."""
    letters = tx.prepare(F.col("text"), [F.lower, tx.letter_tokens])
    return documents(spark, sf_dir).select("doc_id", letters.alias("letters"))


@query(f"""
WITH bodies AS (SELECT page_id, url || chr(10) || 'see ' || url || ' ' || html AS body FROM pages),
cleaned AS (SELECT page_id, lower(regexp_replace(body, '{URL_SQL}|\\n', '', 'g')) AS body_cleaned FROM bodies)
SELECT page_id, md5(body_cleaned) AS body_md5, CAST(length(body_cleaned) AS INTEGER) AS n_chars FROM cleaned""")
def clean_pages_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    body = F.concat("url", F.lit("\nsee "), "url", F.lit(" "), "html")
    pages = table(spark, sf_dir, "pages")
    cleaned = pages.select("page_id", tx.clean_text(body).alias("body_cleaned"))
    return cleaned.select("page_id", F.md5("body_cleaned").alias("body_md5"), F.char_length("body_cleaned").alias("n_chars"))


@query(f"""
WITH {words_sql()},
joined AS (SELECT doc_id, count(*) AS n, string_agg(token, ' ' ORDER BY i) AS kept FROM words GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(n, 0) AS INTEGER) AS n_tokens, md5(coalesce(kept, '')) AS tokens_md5
FROM documents d LEFT JOIN joined USING (doc_id)""")
def prepare_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = documents(spark, sf_dir).select("doc_id", tx.report_tokens(F.col("text"), ENGLISH).alias("tokens"))
    return tokens.select("doc_id", F.size("tokens").alias("n_tokens"), F.md5(F.array_join("tokens", " ")).alias("tokens_md5"))


@query("""
SELECT doc_id, CAST(length(CAST(doc_id AS VARCHAR)) AS INTEGER) AS id_length, CAST(length(text) AS INTEGER) AS text_length,
       CAST(length(source) AS INTEGER) AS source_length FROM documents""")
def id_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents(spark, sf_dir, "source").select(
        "doc_id",
        F.char_length(F.col("doc_id").cast("string")).alias("id_length"),
        F.char_length("text").alias("text_length"),
        F.char_length("source").alias("source_length"),
    )


STRIPPED_SQL = rf"""stripped AS (
  SELECT doc_id, regexp_replace(lower(regexp_replace(body, '{URL_SQL}', '', 'g')), '[^\p{{L}}\p{{N}}_{SPACES_SQL}]', '', 'g') AS plain
  FROM bodies),
lists AS (SELECT doc_id, regexp_split_to_array(plain, '[{SPACES_SQL}]+') AS tokens FROM stripped),
kept AS (
  SELECT doc_id, token, i FROM (
    SELECT doc_id, unnest(tokens) AS token, generate_subscripts(tokens, 1) AS i FROM lists)
  WHERE token <> '' AND token NOT IN {EXPLORATION_SQL})"""


def _stripped(text: Column) -> Column:
    return tx.prepare(
        text,
        [tx.strip_urls, F.lower, tx.strip_punctuation, lambda plain: tx.without_stopwords(plain, EXPLORATION)],
    )


@query(f"""
WITH bodies AS (SELECT page_id AS doc_id, url || ' ' || html AS body FROM pages),
{STRIPPED_SQL},
joined AS (SELECT doc_id, string_agg(token, ' ' ORDER BY i) AS plain, count(*) AS n FROM kept GROUP BY doc_id)
SELECT page_id, md5(coalesce(plain, '')) AS plain_md5, CAST(coalesce(n, 0) AS INTEGER) AS n_words
FROM pages LEFT JOIN joined ON doc_id = page_id""")
def strip_punct_stop(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    plain = pages.select("page_id", _stripped(F.concat("url", F.lit(" "), "html")).alias("plain"))
    return plain.select("page_id", F.md5("plain").alias("plain_md5"), F.size(tx.space_tokens(F.col("plain"))).alias("n_words"))


@query(f"""
WITH {words_sql()}
SELECT token, count(*) AS freq FROM words GROUP BY token HAVING count(*) >= 2 ORDER BY freq DESC, token LIMIT 50""")
def word_freq_top50(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fq.top_tokens(fq.count_tokens(_letters(spark, sf_dir), "letters", stopwords=ENGLISH), 50)


@query(f"""
WITH {words_sql(f"(SELECT * FROM documents WHERE doc_id IN {FLAGGED_SQL})")}
SELECT token, count(*) AS freq FROM words GROUP BY token HAVING count(*) >= 2""")
def word_freq_flagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    flagged = _letters(spark, sf_dir).join(flagged_ids(spark, sf_dir), "doc_id", "left_semi")
    return fq.count_tokens(flagged, "letters", stopwords=ENGLISH)


@query("""
WITH tokens AS (SELECT unnest(string_split_regex(lower(text), '[^A-Za-z0-9_]')) AS token FROM documents)
SELECT token, count(*) AS freq FROM tokens WHERE token <> '' GROUP BY token""")
def token_counts_nonword(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fq.count_tokens(documents(spark, sf_dir), tx.nonword_tokens(F.col("text")), min_freq=1)


@query(f"""
WITH {letters_sql()}, {grams_sql(2)}
SELECT token, count(*) AS freq FROM grams GROUP BY token HAVING count(*) >= 2""")
def bigram_freq(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fq.count_ngrams(_letters(spark, sf_dir), "letters", 2, stopwords=ENGLISH)


@query(f"""
WITH {letters_sql()}, {grams_sql(3)}
SELECT token, count(*) AS freq FROM grams GROUP BY token HAVING count(*) >= 2""")
def trigram_freq(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fq.count_ngrams(_letters(spark, sf_dir), "letters", 3, stopwords=ENGLISH)


@query(f"""
WITH bodies AS (SELECT doc_id, text AS body FROM documents),
{STRIPPED_SQL},
long_words AS (SELECT * FROM kept WHERE length(token) >= 2),
{grams_sql(2, "long_words", None)}
SELECT token, count(*) AS freq FROM grams GROUP BY token HAVING count(*) >= 2""")
def bigram_freq_stop_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = F.filter(tx.space_tokens(_stripped(F.col("text"))), lambda token: F.char_length(token) >= 2)
    return fq.count_ngrams(documents(spark, sf_dir).select(words.alias("words")), "words", 2)


IDF_SQL = "round(ln((SELECT count(*) FROM documents) / df) + 0.1, 6)"


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({name: F.round(name, 6) for name in columns})


@query(f"""
WITH {words_sql()},
counts AS (SELECT token, count(DISTINCT doc_id) AS df FROM words GROUP BY token HAVING count(DISTINCT doc_id) >= 2)
SELECT token, df, {IDF_SQL} AS idf FROM counts""")
def idf_unigram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(fq.compute_idf(_letters(spark, sf_dir), "letters", stopwords=ENGLISH), "idf")


@query(f"""
WITH {words_sql()},
counts AS (SELECT token, count(*) AS freq, count(DISTINCT doc_id) AS df FROM words GROUP BY token HAVING count(*) >= 2),
idfs AS (SELECT token, freq, CASE WHEN df >= 2 THEN ln((SELECT count(*) FROM documents) / df) + 0.1 END AS idf FROM counts)
SELECT token, freq, round(idf, 6) AS idf, round(freq * idf, 6) AS tfidf FROM idfs""")
def tfidf_unigram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(fq.corpus_tfidf(_letters(spark, sf_dir), "letters", stopwords=ENGLISH), "idf", "tfidf")


@query(f"""
WITH {letters_sql()}, {grams_sql(2)},
counts AS (
  SELECT token, count(*) FILTER (WHERE doc_id IN {FLAGGED_SQL}) AS freq, count(DISTINCT doc_id) AS df
  FROM grams GROUP BY token HAVING count(*) FILTER (WHERE doc_id IN {FLAGGED_SQL}) >= 2),
idfs AS (SELECT token, freq, CASE WHEN df >= 10 THEN ln((SELECT count(*) FROM documents) / df) + 0.1 END AS idf FROM counts)
SELECT token, freq, round(idf, 6) AS idf, round(freq * idf, 6) AS tfidf FROM idfs""")
def tfidf_bigram_flagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frequencies of the flagged documents against the IDF of all, in one pass over the texts."""
    # No token holds a space, and a row of joined tokens is far smaller than their array, if the join shuffles it.
    joined = _letters(spark, sf_dir).select("doc_id", F.array_join("letters", " ").alias("joined"))
    flagged = with_flag(joined, spark, sf_dir)
    letters = F.when(F.col("joined") != "", F.split("joined", " "))
    rows = flagged.select(letters.alias("letters"), "is_flagged")
    scores = fq.gram_tfidf(rows, "letters", 2, F.col("is_flagged"), min_df=10, stopwords=ENGLISH)
    return _rounded(scores, "idf", "tfidf")


@query(f"""
WITH {letters_sql()}, {grams_sql(3)},
counts AS (SELECT token, count(*) AS freq, count(DISTINCT doc_id) AS df FROM grams GROUP BY token HAVING count(*) >= 2),
idfs AS (SELECT token, freq, CASE WHEN df >= 10 THEN ln((SELECT count(*) FROM documents) / df) + 0.1 END AS idf FROM counts)
SELECT token, freq, round(idf, 6) AS idf, round(freq * idf, 6) AS tfidf FROM idfs""")
def tfidf_trigram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(fq.gram_tfidf(_letters(spark, sf_dir), "letters", 3, min_df=10, stopwords=ENGLISH), "idf", "tfidf")


@query(f"""
WITH {words_sql()}, {grams_sql(2)},
counts AS (
  SELECT token, 1 AS n, count(DISTINCT doc_id) AS df FROM words GROUP BY token HAVING count(DISTINCT doc_id) >= 2
  UNION ALL
  SELECT token, 2 AS n, count(DISTINCT doc_id) AS df FROM grams GROUP BY token HAVING count(DISTINCT doc_id) >= 10)
SELECT token, n, df, {IDF_SQL} AS idf FROM counts""")
def idf_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(fq.sized_idf(_letters(spark, sf_dir), "letters", {1: 2, 2: 10}, ENGLISH), "idf")


@query(f"""
WITH {words_sql()},
freqs AS (
  SELECT token, count(*) AS freq FROM words WHERE doc_id IN {FLAGGED_SQL} GROUP BY token HAVING count(*) >= 2),
idfs AS (
  SELECT token, ln((SELECT count(*) FROM documents) / count(DISTINCT doc_id)) + 0.1 AS idf
  FROM words GROUP BY token HAVING count(DISTINCT doc_id) >= 2)
SELECT token, freq, round(freq * idf, 6) AS tfidf
FROM freqs LEFT JOIN idfs USING (token) ORDER BY round(freq * idf, 6) DESC NULLS LAST, token LIMIT 100""")
def tfidf_top100_flagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = with_flag(_letters(spark, sf_dir), spark, sf_dir)
    scores = fq.corpus_tfidf(rows, "letters", F.col("is_flagged"), stopwords=ENGLISH)
    return fq.top_tokens(_rounded(scores.drop("idf"), "tfidf"), 100, by="tfidf")


@query(f"""
WITH tokens AS (
  SELECT doc_id, unnest(string_split_regex(lower(text), '[^A-Za-z0-9_]')) AS token FROM documents),
counts AS (
  SELECT token, count(DISTINCT doc_id) AS df FROM tokens
  WHERE token <> '' AND token NOT IN {word_list_sql(MODEL_SHORT)} GROUP BY token)
SELECT token, df, CASE WHEN df >= 5 THEN round(ln(((SELECT count(*) FROM documents) + 1) / (df + 1)), 6) ELSE 0 END AS idf
FROM counts""")
def idf_spark_ml_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = tx.drop_stopwords(tx.nonword_tokens(F.col("text")), MODEL_SHORT)
    return _rounded(fq.spark_ml_idf(documents(spark, sf_dir), tokens), "idf")


@query(f"""
WITH tokens AS (
  SELECT doc_id, unnest(string_split_regex(lower(text), '[^A-Za-z0-9_]')) AS token FROM documents)
SELECT token FROM tokens WHERE token <> '' AND token NOT IN {ENGLISH_SQL}
GROUP BY token HAVING count(DISTINCT doc_id) >= 5""")
def count_vectorizer_vocab(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = tx.drop_stopwords(tx.nonword_tokens(F.col("text")), ENGLISH)
    rows = documents(spark, sf_dir).select(tokens.alias("filtered"))
    return vocabulary_counts(rows, "filtered", 5).select("token")


@query(f"""
WITH tokens AS (
  SELECT doc_id, unnest(string_split_regex(lower(text), '[^A-Za-z0-9_]')) AS token FROM documents)
SELECT token, count(DISTINCT doc_id) AS df, true AS agrees FROM tokens
WHERE token <> '' AND token NOT IN {word_list_sql(MODEL_SHORT)} GROUP BY token""")
def idf_stage_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weights of the fitted IDF stage. A term alone in its hash bucket must have ``ln((N + 1) / (df + 1))``,
    0 below the floor; one that shares it can have no more than that."""
    counting = hashed_counts("text", MODEL_SHORT, num_features=1 << 18)
    rows = documents(spark, sf_dir)
    counted = materialise(counting.transform(rows).select("filtered", "rawFeatures"), "idf-counts")
    fitted = idf_stage(5).fit(counted)
    seen = counted.select(F.explode(F.array_distinct("filtered")).alias("token")).groupBy("token")
    terms = seen.agg(F.count("*").alias("df")).withColumn("filtered", F.array("token"))
    weighed = fitted.transform(counting.stages[-1].transform(terms))
    # One bucket a term: the vectors hold a single value.
    bucket = F.udf(lambda vector: int(vector.indices[0]), "int")
    weight = F.udf(lambda vector: float(vector.values[0]) if len(vector.values) else 0.0, "double")
    weighed = weighed.select("token", "df", bucket("rawFeatures").alias("bucket"), weight("features").alias("weight"))
    alone = F.count("*").over(Window.partitionBy("bucket")) == 1
    documents_read = F.lit(fitted.numDocs)
    own = F.ln((documents_read + 1) / (F.col("df") + 1))
    most = F.ln((documents_read + 1) / (F.greatest("df", F.lit(5)) + 1))
    exact = F.abs(F.col("weight") - F.when(F.col("df") >= 5, own).otherwise(0.0)) < 1e-9
    return weighed.select("token", "df", F.when(alone, exact).otherwise(F.col("weight") <= most + 1e-9).alias("agrees"))


@query(f"""
WITH {words_sql()},
counts AS (SELECT token, count(DISTINCT doc_id) AS df FROM words GROUP BY token HAVING count(DISTINCT doc_id) >= 2)
SELECT token, df, {IDF_SQL} AS idf FROM counts""")
def idf_by_pulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The IDF of all documents, summed up from parts stored by three pulls, the last of which pulls some days
    again."""
    path = scratch_path(spark, "idf-days")
    rows = _letters(spark, sf_dir).withColumn("day", F.col("doc_id") % 7)
    for days in ((0, 1, 2), (3, 4), (4, 5, 6)):
        idf_state.add_days(rows.filter(F.col("day").isin(*days)), "letters", "day", path, ENGLISH)
    return _rounded(idf_state.idf_of_days(spark, path), "idf")
