"""The given tables in the roles the library works with, and the same roles in SQL."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postlens.functions.stopwords import ENGLISH, EXPLORATION
from postlens.operators.cleaning import with_local_time


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as scored posts: the type is the subreddit, the user the author, a value of 100 or more
    counts as flagged."""
    events = table(spark, sf_dir, "events")
    return with_local_time(
        events.select(
            F.col("event_id").alias("comment_id"),
            F.get_json_object("props", "$.k").alias("submission_id"),
            F.col("ts").alias("timestamp"),
            F.col("user_id").alias("author"),
            F.col("event_type").alias("sub_reddit"),
            "value",
            (F.col("value") >= 100).cast("int").alias("prediction"),
        )
    )


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "text", *columns)


def flagged_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of the documents labelled toxic."""
    return table(spark, sf_dir, "labels").filter("toxic = 1").select("doc_id").distinct()


def with_flag(rows: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows with ``is_flagged``. Call it on rows that hold tokens already: if the ids are too many to
    broadcast, the join moves those and no texts."""
    flags = flagged_ids(spark, sf_dir).withColumn("is_flagged", F.lit(True))
    return rows.join(flags, "doc_id", "left").withColumn("is_flagged", F.coalesce("is_flagged", F.lit(False)))


def rule_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels as truth against a rule as prediction: low quality is predicted toxic."""
    labels = table(spark, sf_dir, "labels")
    return labels.select("doc_id", F.col("toxic").alias("label"), (F.col("quality") == 0).cast("int").alias("prediction"))


def day_text(column: str) -> Column:
    return F.date_format(column, "yyyy-MM-dd")


# ---- the same in SQL ----------------------------------------------------------------------------

POSTS_SQL = """posts AS (
  SELECT event_id AS comment_id, json_extract_string(props, '$.k') AS submission_id, ts AS "timestamp",
         user_id AS author, event_type AS sub_reddit, value, CAST(value >= 100 AS INTEGER) AS prediction,
         ts + INTERVAL 8 HOUR AS timestamp_local, CAST(ts + INTERVAL 8 HOUR AS DATE) AS date_local,
         CAST(hour(ts + INTERVAL 8 HOUR) AS INTEGER) AS hour_local
  FROM events)"""

RULE_SQL = "rules AS (SELECT doc_id, toxic AS label, CAST(quality = 0 AS INTEGER) AS prediction FROM labels)"

# Unicode spaces of Java and Python, which the SQL engine's \\s lacks.
SPACES_SQL = r"\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
URL_SQL = f"http[^{SPACES_SQL}]+"
LETTER_TOKEN_SQL = r"[\p{L}\p{M}\p{N}_-]*\p{L}[\p{L}\p{M}\p{N}_-]*"


def word_list_sql(words: Iterable[str]) -> str:
    return "(" + ", ".join("'" + word.replace("'", "''") + "'" for word in sorted(set(words))) + ")"


ENGLISH_SQL = word_list_sql(ENGLISH)
EXPLORATION_SQL = word_list_sql(EXPLORATION)


def letters_sql(source: str = "documents") -> str:
    """``letters(doc_id, i, token)``: letter tokens with their place."""
    return f"""letter_lists AS (SELECT doc_id, regexp_extract_all(lower(text), '{LETTER_TOKEN_SQL}') AS tokens FROM {source}),
letters AS (SELECT doc_id, unnest(tokens) AS token, generate_subscripts(tokens, 1) AS i FROM letter_lists)"""


def words_sql(source: str = "documents") -> str:
    """``words(doc_id, i, token)``: letter tokens without stop words."""
    return f"{letters_sql(source)},\nwords AS (SELECT * FROM letters WHERE token NOT IN {ENGLISH_SQL})"


def grams_sql(n: int, source: str = "letters", stop: str | None = ENGLISH_SQL) -> str:
    """``grams(doc_id, token)``: runs of n tokens of which none is a stop word."""
    parts = ["token"] + [f"lead(token, {k}) OVER w AS t{k}" for k in range(1, n)]
    names = ["token"] + [f"t{k}" for k in range(1, n)]
    keep = " AND ".join([f"t{n - 1} IS NOT NULL"] + ([f"{name} NOT IN {stop}" for name in names] if stop else []))
    return f"""runs AS (SELECT doc_id, {", ".join(parts)} FROM {source} WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
grams AS (SELECT doc_id, {" || ' ' || ".join(names)} AS token FROM runs WHERE {keep})"""


def hash_sql(key: str, buckets: int, seed: str = "") -> str:
    """A bucket of a key by the first 8 hex digits of its digest."""
    text = f"CAST({key} AS VARCHAR)" if seed == "" else f"'{seed}:' || CAST({key} AS VARCHAR)"
    return f"(CAST('0x' || substr(md5({text}), 1, 8) AS BIGINT) % {buckets})"
