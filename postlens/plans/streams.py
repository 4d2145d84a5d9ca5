"""Streaming jobs run to the end of the given tables, and what they wrote."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlens.functions.values import to_local
from postlens.learning.classifiers import make_classifier
from postlens.plans.models import vectorised
from postlens.plans.registry import query
from postlens.plans.tables import day_text, table
from postlens.session import scratch_path
from postlens.streaming import jobs
from postlens.streaming import sessions as ss


def _source(sf_dir: str, name: str) -> str:
    """A table as a stream source. The pattern fits a single file as well as a folder of files."""
    return f"{sf_dir.rstrip('/')}/{{{name}.parquet}}"


def _stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return jobs.comment_stream(spark, _source(sf_dir, name), table(spark, sf_dir, name).schema)


def _event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Event time must be a time with zone for the watermark; the session runs in UTC.
    events = _stream(spark, sf_dir, "events")
    return events.select(
        F.col("event_id").alias("comment_id"),
        F.col("ts").cast("timestamp").alias("dt"),
        F.col("user_id").alias("author"),
        F.col("event_type").alias("sub_reddit"),
        "value",
    )


@query("SELECT event_id AS comment_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS moment, user_id AS author, event_type AS sub_reddit, value FROM events")
def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Comments taken from a stream into files."""
    out, checkpoint = scratch_path(spark, "ingest"), scratch_path(spark, "ingest-progress")
    jobs.run_to_end(lambda: jobs.write_stream(_event_stream(spark, sf_dir), out, checkpoint, once=True))
    rows = spark.read.parquet(out)
    return rows.select("comment_id", F.date_format("dt", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("moment"), "author", "sub_reddit", "value")


@query("""
SELECT strftime(ts + INTERVAL 8 HOUR, '%Y-%m-%d') AS day, event_type AS sub_reddit, count(*) AS no_comment FROM events GROUP BY ALL""")
def stream_daily_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily counts kept by a stream; at the end of the input they equal the batch report."""
    out, checkpoint = scratch_path(spark, "daily"), scratch_path(spark, "daily-progress")
    counts = jobs.daily_counts(_event_stream(spark, sf_dir), "dt")
    jobs.run_to_end(lambda: jobs.write_counts(counts, out, checkpoint, once=True))
    latest = jobs.latest_counts(spark, out, ["start", "sub_reddit"])
    return latest.select(day_text("start").alias("day"), "sub_reddit", "no_comment")


@query("""
SELECT CAST(hour(ts + INTERVAL 8 HOUR) AS INTEGER) AS hour_local, count(*) AS no_comment FROM events
WHERE ts >= TIMESTAMP '2024-01-11' GROUP BY ALL""")
def stream_since(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only comments from a moment on are taken; their hours are counted afterwards."""
    out, checkpoint = scratch_path(spark, "since"), scratch_path(spark, "since-progress")
    schema = table(spark, sf_dir, "events").schema
    stream = jobs.comment_stream(
        spark, _source(sf_dir, "events"), schema, since="2024-01-11 00:00:00", time_column="ts"
    )
    jobs.run_to_end(lambda: jobs.write_stream(stream.select("event_id", "ts"), out, checkpoint, once=True))
    hours = spark.read.parquet(out).groupBy(F.hour(to_local(F.col("ts"))).alias("hour_local"))
    return hours.agg(F.count("*").alias("no_comment"))


@query("SELECT event_id AS comment_id, event_type AS sub_reddit FROM events")
def stream_without_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each comment comes twice, as when ingest pulls a window again; it is stored once, in whatever order the
    files come."""
    out, checkpoint = scratch_path(spark, "single"), scratch_path(spark, "single-progress")
    twice = _event_stream(spark, sf_dir).withColumn("pull", F.explode(F.array(F.lit(1), F.lit(2)))).drop("pull")
    single = jobs.without_repeats(twice, "dt").select("comment_id", "sub_reddit")
    jobs.run_to_end(lambda: jobs.write_stream(single, out, checkpoint, once=True))
    return spark.read.parquet(out)


SESSION_GAP, SESSION_DELAY = 3600, 86_400


@query("""
WITH marked AS (
  SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER w <= INTERVAL 1 HOUR THEN 0 ELSE 1 END AS fresh
  FROM events WHERE ts IS NOT NULL WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
numbered AS (
  SELECT user_id, ts, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS nth FROM marked)
SELECT user_id AS author, strftime(min(ts), '%Y-%m-%d %H:%M:%S.%f') AS first_moment,
       strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f') AS last_moment, count(*) AS no_comment
FROM numbered GROUP BY user_id, nth""")
def stream_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions of authors kept up by a stream, with what came too late for them."""
    out, checkpoint = scratch_path(spark, "sessions"), scratch_path(spark, "sessions-progress")
    stream = _event_stream(spark, sf_dir)
    jobs.run_to_end(
        lambda: ss.write_sessions(stream, out, checkpoint, "dt", "author", SESSION_GAP, SESSION_DELAY, once=True)
    )
    found = ss.whole_sessions(spark, out, stream.schema, "dt", "author", SESSION_GAP)
    text = "yyyy-MM-dd HH:mm:ss.SSSSSS"
    return found.select(
        "author",
        F.date_format("first", text).alias("first_moment"),
        F.date_format("last", text).alias("last_moment"),
        F.col("n_comment").alias("no_comment"),
    )


@query("SELECT doc_id, count(*) AS times, true AS valid FROM documents GROUP BY doc_id")
def stream_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents cleaned and scored as they come: each once, as 0 or 1."""
    vectorizer, train, _ = vectorised(spark, sf_dir)
    model = make_classifier("lr").fit(train)
    out, checkpoint = scratch_path(spark, "scored"), scratch_path(spark, "scored-progress")
    stream = _stream(spark, sf_dir, "documents").select("doc_id", "text")
    scored = jobs.score_stream(stream, vectorizer, model, {"text": "body_cleaned"}).select("doc_id", "prediction")
    jobs.run_to_end(lambda: jobs.write_stream(scored, out, checkpoint, once=True))
    return spark.read.parquet(out).groupBy("doc_id").agg(
        F.count("*").alias("times"), F.every(F.col("prediction").isin(0.0, 1.0)).alias("valid")
    )
