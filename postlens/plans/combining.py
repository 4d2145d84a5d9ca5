"""Queries that join, union, upsert, split, sample and generate rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postlens.functions import values as vl
from postlens.operators import joins as jn
from postlens.operators import sampling as sp
from postlens.operators import synth as sy
from postlens.plans.registry import query
from postlens.plans.tables import RULE_SQL, hash_sql, rule_predictions, table
from postlens.sources.readers import restrict_to_watchlist


# ---- joins --------------------------------------------------------------------------------------


def _comments_and_submissions(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    comments = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("submission_id"), "l_partkey", "l_linenumber", "l_extendedprice"
    )
    submissions = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("submission_id"), "o_orderpriority", "o_orderstatus", "o_totalprice"
    )
    return comments, submissions


@query("""
SELECT l_orderkey AS submission_id, l_partkey, l_linenumber, l_extendedprice, o_orderpriority, o_orderstatus, o_totalprice
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")
def comment_submission_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jn.comments_with_submission(*_comments_and_submissions(spark, sf_dir))


@query("""
SELECT event_id AS comment_id, event_type AS submission_id, value, min(ts) OVER (PARTITION BY event_type) AS opened,
       count(*) OVER (PARTITION BY event_type) AS no_comment
FROM events WHERE event_type IS NOT NULL""")
def hot_submission_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with the facts of their type: a handful of keys, each with a large share of all rows."""
    comments = table(spark, sf_dir, "events").select(
        F.col("event_id").alias("comment_id"), F.col("event_type").alias("submission_id"), "value", "ts"
    )
    opened = comments.groupBy("submission_id").agg(F.min("ts").alias("opened"), F.count(F.lit(1)).alias("no_comment"))
    return jn.comments_with_hot_submissions(comments.drop("ts"), opened)


@query("""
SELECT l_orderkey AS submission_id, l_partkey, l_linenumber, l_extendedprice FROM lineitem
WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'F')""")
def watchlist_semi(spark: SparkSession, sf_dir: str) -> DataFrame:
    comments, submissions = _comments_and_submissions(spark, sf_dir)
    watched = submissions.filter((F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderstatus") == "F"))
    return restrict_to_watchlist(comments, watched)


@query(f"""
WITH {RULE_SQL} SELECT doc_id, lang, source, prediction FROM documents JOIN rules USING (doc_id)""")
def predictions_joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    return jn.predictions_to_rows(rows, rule_predictions(spark, sf_dir), "doc_id")


@query("""
SELECT r.conv_id, r.turn, r.role, md5(f.text) AS first_md5 FROM conversations r
JOIN conversations f ON r.conv_id = f.conv_id AND f.turn = 0 WHERE r.turn > 0""")
def reply_thread_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each reply with a digest of the post that opened its thread."""
    turns = table(spark, sf_dir, "conversations")
    openings = turns.filter("turn = 0").select("conv_id", F.md5("text").alias("first_md5"))
    return jn.comments_with_submission(turns.filter("turn > 0").select("conv_id", "turn", "role"), openings, "conv_id")


# ---- unions and upserts -------------------------------------------------------------------------


UPDATES_SQL = """updates AS (
  SELECT doc_id, 'first' AS source, n_chars, 1 AS version FROM documents WHERE doc_id % 3 = 0 UNION ALL
  SELECT doc_id, 'second' AS source, n_chars + 1, 2 AS version FROM documents WHERE doc_id % 6 = 0 UNION ALL
  SELECT doc_id + 1000000000, 'new' AS source, n_chars, 1 AS version FROM documents WHERE doc_id % 10 = 0)"""


def _updates(docs: DataFrame) -> DataFrame:
    """Changed rows, some of them twice, and new rows."""
    key = F.col("doc_id")
    first = docs.filter(key % 3 == 0).select("doc_id", F.lit("first").alias("source"), "n_chars", F.lit(1).alias("version"))
    second = docs.filter(key % 6 == 0).select(
        "doc_id", F.lit("second").alias("source"), (F.col("n_chars") + 1).alias("n_chars"), F.lit(2).alias("version")
    )
    new = docs.filter(key % 10 == 0).select(
        (key + 1000000000).alias("doc_id"), F.lit("new").alias("source"), "n_chars", F.lit(1).alias("version")
    )
    return jn.union_all(first, second, new)


@query(f"""
WITH {UPDATES_SQL},
everything AS (SELECT doc_id, source, n_chars, 0 AS version FROM documents UNION ALL SELECT * FROM updates)
SELECT doc_id, source, n_chars FROM everything QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY version DESC) = 1""")
def upsert_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "n_chars")
    return jn.upsert(docs, _updates(docs), ["doc_id"], ["version"])


@query(f"""
WITH {UPDATES_SQL}
SELECT doc_id, source, n_chars FROM updates QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY version DESC) = 1""")
def latest_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "n_chars")
    return jn.latest_per_key(_updates(docs), ["doc_id"], ["version"]).drop("version")


@query("""
SELECT doc_id AS id, source, n_chars, NULL AS role FROM documents
UNION ALL SELECT conv_id, NULL, length(text), role FROM conversations""")
def union_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "source", "n_chars")
    turns = table(spark, sf_dir, "conversations").select(
        F.col("conv_id").alias("id"), "role", F.char_length("text").cast("long").alias("n_chars")
    )
    return jn.union_all(docs, turns)


@query("""
SELECT doc_id, CASE WHEN toxic = 1 THEN 'yes' ELSE 'no' END AS label, 'labelled' AS origin FROM labels
UNION ALL SELECT doc_id, 'yes', 'simulated' FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)""")
def union_simulated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled rows, and the unlabelled ones standing for simulated positives."""
    labels = table(spark, sf_dir, "labels")
    labelled = labels.select("doc_id", F.when(F.col("toxic") == 1, "yes").otherwise("no").alias("label"))
    others = table(spark, sf_dir, "documents").select("doc_id").join(labels.select("doc_id"), "doc_id", "left_anti")
    return jn.union_labelled(labelled, others)


# ---- splits and samples -------------------------------------------------------------------------


@query(f"""
SELECT CASE WHEN {hash_sql("doc_id", 100, "42")} < 80 THEN 'train' ELSE 'test' END AS part, count(*) AS n,
       CAST(sum(doc_id) AS BIGINT) AS id_sum FROM documents GROUP BY ALL""")
def hash_split_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = zip(("train", "test"), sp.hash_split(table(spark, sf_dir, "documents").select("doc_id"), "doc_id", 80, 42))
    named = [rows.withColumn("part", F.lit(name)) for name, rows in parts]
    return jn.union_all(*named).groupBy("part").agg(F.count("*").alias("n"), F.sum("doc_id").alias("id_sum"))


SAMPLE_SIZE = 200
QUOTAS_SQL = f"""quotas AS (
  SELECT lang, count(*) AS size, CAST({SAMPLE_SIZE} * count(*) // (SELECT count(*) FROM documents) AS BIGINT) AS quota
  FROM documents GROUP BY lang),
places AS (
  SELECT lang, doc_id, row_number() OVER (PARTITION BY lang ORDER BY md5('7:' || doc_id), doc_id) - 1 AS place FROM documents)"""


@query(f"WITH {QUOTAS_SQL} SELECT lang, size, quota FROM quotas")
def stratified_quotas(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sp.strata_quotas(table(spark, sf_dir, "documents"), ["lang"], SAMPLE_SIZE)


@query(f"""
WITH {QUOTAS_SQL},
draws AS (
  SELECT lang, draw, CAST('0x' || substr(md5('7:' || lang || ':' || draw), 1, 15) AS BIGINT) % size AS place
  FROM (SELECT lang, size, unnest(range(1, quota + 1)) AS draw FROM quotas))
SELECT lang, doc_id, draw FROM draws JOIN places USING (lang, place)""")
def stratified_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sp.stratified_sample(table(spark, sf_dir, "documents"), ["lang"], "doc_id", SAMPLE_SIZE, seed=7)


@query(f"""
WITH {QUOTAS_SQL}
SELECT lang, doc_id, source, n_chars, place + 1 AS draw
FROM places JOIN quotas USING (lang) JOIN (SELECT doc_id, source, n_chars FROM documents) USING (doc_id) WHERE place < quota""")
def stratified_sample_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    sample = sp.stratified_sample(docs, ["lang"], "doc_id", SAMPLE_SIZE, replace=False, seed=7)
    return sp.sampled_rows(docs, sample, "doc_id")


# ---- generated rows -----------------------------------------------------------------------------


@query(f"""
WITH ids AS (SELECT event_id, md5(CAST(event_id AS VARCHAR)) AS comment_id FROM events)
SELECT event_id, regexp_replace(comment_id, '(.{{4}}).', '\\1', 'g')
  || substr('{vl.ALPHANUMERIC}', CAST({hash_sql("comment_id", 62)} + 1 AS INTEGER), 1) AS comment_id FROM ids""")
def scramble_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    comment_id = F.md5(F.col("event_id").cast("string"))
    return table(spark, sf_dir, "events").select("event_id", vl.scramble_id(comment_id).alias("comment_id"))


@query(f"""
WITH ids AS (SELECT md5(CAST(event_id AS VARCHAR)) AS comment_id FROM events),
scrambled AS (SELECT regexp_replace(comment_id, '(.{{4}}).', '\\1', 'g')
  || substr('{vl.ALPHANUMERIC}', CAST({hash_sql("comment_id", 62)} + 1 AS INTEGER), 1) AS comment_id FROM ids)
SELECT count(*) AS n_rows, count(DISTINCT comment_id) AS n_distinct FROM scrambled""")
def scrambled_ids_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scramble_ids(spark, sf_dir).agg(F.count("*").alias("n_rows"), F.count_distinct("comment_id").alias("n_distinct"))


def _pick_sql(words: list[str], seed: str) -> str:
    listed = ", ".join("'" + word + "'" for word in words)
    return f"list_extract([{listed}], {hash_sql('id', len(words), seed)} + 1)"


SYNTH_SQL = f"""
  substr(md5('1:' || id), 1, 10) AS submission_id, substr(md5('1:' || id), 11, 22) AS comment_id,
  'user' || {hash_sql("id", 1000, "1author")} AS author,
  {_pick_sql(sy.OPENINGS, "10")} || ' ' || {_pick_sql(sy.PLACES, "11")} || ' ' || {_pick_sql(sy.ENDINGS, "12")} AS body,
  CAST({hash_sql("id", 1000, "1votes")} + 1 AS INTEGER) AS upvotes,
  round(0.1 + {hash_sql("id", 900, "1ratio")} / 1000, 6) AS upvote_ratio"""


def _without_times(rows: DataFrame) -> list[Column | str]:
    return ["submission_id", "comment_id", "author", "body", "upvotes", F.round("upvote_ratio", 6).alias("upvote_ratio")]


@query(f"""
WITH need AS (SELECT count(*) FILTER (WHERE toxic = 0) - count(*) FILTER (WHERE toxic = 1) AS n FROM labels),
numbers AS (SELECT unnest(range(n)) AS id FROM need)
SELECT {_pick_sql(sy.SUBREDDITS, "1sub")} AS sub_reddit, {SYNTH_SQL} FROM numbers""")
def synth_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As many synthetic posts as class 1 lacks to match class 0."""
    rows = sy.synth_posts(spark, sy.class_deficit(table(spark, sf_dir, "labels"), "toxic"))
    return rows.select("sub_reddit", *_without_times(rows))


@query(f"""
SELECT source AS submission_id, CAST(doc_id AS VARCHAR) AS comment_id, lang AS author, md5(text) AS body, 1 AS upvotes,
       0.5 AS upvote_ratio FROM documents
UNION ALL
SELECT submission_id, comment_id, author, md5(body) AS body, upvotes, upvote_ratio
FROM (SELECT {SYNTH_SQL} FROM (SELECT doc_id AS id FROM documents WHERE doc_id % 20 = 0))""")
def inject_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as the scoring input, with one simulated post for each twentieth of them."""
    docs = table(spark, sf_dir, "documents")
    real = docs.select(
        F.col("source").alias("submission_id"),
        F.col("doc_id").cast("string").alias("comment_id"),
        F.lit(None).cast("timestamp").alias("timestamp"),
        F.col("lang").alias("author"),
        F.col("text").alias("body"),
        F.lit(1).alias("upvotes"),
        F.lit(0.5).alias("upvote_ratio"),
    )
    simulated = sy.synth_rows(docs.filter("doc_id % 20 = 0").select("doc_id"), number="doc_id")
    rows = sy.inject_rows(real, simulated)
    return rows.select(*_without_times(rows)).withColumn("body", F.md5("body"))
