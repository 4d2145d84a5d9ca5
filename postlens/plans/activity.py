"""Queries over scored posts: dashboard counts, profiles, coercion and validity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postlens import schemas
from postlens.functions import values as vl
from postlens.operators import cleaning as cl
from postlens.operators import profile as pf
from postlens.operators import reports as rp
from postlens.operators import sketches as sk
from postlens.operators.joins import distinct_values
from postlens.plans.registry import query
from postlens.plans.tables import POSTS_SQL, URL_SQL, day_text, hash_sql, posts, table
from postlens.session import scratch_path
from postlens.sources.readers import flatten_listing, json_field

AUTHOR = 8


def _with_day(df: DataFrame, column: str = "date_local", name: str = "day") -> DataFrame:
    """The day column as text, so that it compares alike in every engine."""
    return df.select(*[day_text(c).alias(name) if c == column else F.col(c) for c in df.columns])


# ---- labels -------------------------------------------------------------------------------------


@query("SELECT toxic AS label, count(*) AS n FROM labels WHERE toxic IN (0, 1) GROUP BY toxic")
def class_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("toxic").cast("string").alias("label"))
    return rp.class_balance(cl.binary_labels(labels))


@query("""
SELECT 'documents' AS name, count(*) AS n FROM documents UNION ALL SELECT 'labels', count(*) FROM labels
UNION ALL SELECT 'events', count(*) FROM events""")
def row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = [
        table(spark, sf_dir, name).agg(F.count("*").alias("n")).select(F.lit(name).alias("name"), "n")
        for name in ("documents", "labels", "events")
    ]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


@query("SELECT doc_id, toxic AS label FROM labels WHERE toxic = 1")
def one_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "labels").select("doc_id", F.col("toxic").alias("label")).filter(F.col("label") == 1)


@query("""
SELECT doc_id, toxic, CASE WHEN answer = 'yes' THEN 1 ELSE 0 END AS label_int FROM (
  SELECT doc_id, toxic, CASE WHEN quality IS NULL THEN NULL WHEN toxic = 1 THEN 'yes' ELSE 'no' END AS answer FROM labels)""")
def label_text_to_int(spark: SparkSession, sf_dir: str) -> DataFrame:
    answer = F.when(F.col("toxic") == 1, " Yes").when(F.col("toxic") == 0, "NO")
    return table(spark, sf_dir, "labels").select("doc_id", "toxic", vl.label_to_int(answer).alias("label_int"))


@query(f"""
SELECT doc_id, CAST({hash_sql("doc_id", 100, "label")} < 20 AS INTEGER) AS label FROM documents""")
def random_label_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").select("doc_id")
    return rows.withColumn("label", vl.random_label(F.col("doc_id"), 20, "label"))


@query("""
SELECT event_id, coalesce(CASE WHEN event_id % 10 <> 0 THEN CAST(user_id AS VARCHAR) END, 'None') AS author FROM events""")
def author_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    author = F.when(F.col("event_id") % 10 != 0, F.col("user_id").cast("string"))
    return table(spark, sf_dir, "events").select("event_id", vl.author_or_none_text(author).alias("author"))


@query("SELECT event_id, user_id FROM events WHERE event_id % 7 <> 0 AND event_id % 3 <> 0")
def drop_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows with a null anywhere are dropped; the nulls are put in by rule."""
    holes = table(spark, sf_dir, "events").select(
        "event_id",
        "user_id",
        F.when(F.col("event_id") % 7 != 0, F.col("event_type")).alias("event_type"),
        F.when(F.col("event_id") % 3 != 0, F.col("value")).alias("value"),
    )
    return holes.dropna().select("event_id", "user_id")


# ---- dashboard ----------------------------------------------------------------------------------


@query(f"WITH {POSTS_SQL} SELECT DISTINCT strftime(date_local, '%Y-%m-%d') AS day FROM posts")
def distinct_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_day(distinct_values(posts(spark, sf_dir), "date_local"))


@query("SELECT DISTINCT event_type AS sub_reddit FROM events WHERE event_type IS NOT NULL")
def distinct_subs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distinct_values(posts(spark, sf_dir), "sub_reddit")


@query(f"WITH {POSTS_SQL} SELECT author, count(*) AS n FROM posts WHERE prediction = 1 GROUP BY author")
def top_flagged_authors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rp.flagged_authors(posts(spark, sf_dir))


@query(f"""
WITH {POSTS_SQL}
SELECT comment_id, author, sub_reddit FROM posts WHERE prediction = 1 ORDER BY author, comment_id LIMIT 20""")
def flagged_by_author_first20(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = cl.flagged(posts(spark, sf_dir), ["comment_id", "author", "sub_reddit"])
    return rp.first_rows(rows, 20, ["author", "comment_id"])


@query(f"""
WITH {POSTS_SQL}
SELECT count(DISTINCT sub_reddit) AS n_subreddits, count(DISTINCT submission_id) AS n_submissions,
       count(DISTINCT comment_id) AS n_comments, strftime(max(date_local), '%Y-%m-%d') AS latest_day
FROM posts""")
def dashboard_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_day(rp.dashboard_totals(posts(spark, sf_dir)), "latest_day", "latest_day")


@query(f"""
WITH {POSTS_SQL}
SELECT strftime(date_local, '%Y-%m-%d') AS day, sub_reddit, count(*) AS no_comment FROM posts GROUP BY ALL""")
def daily_by_sub(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_day(rp.daily_by_sub(posts(spark, sf_dir)))


@query(f"""
WITH {POSTS_SQL}
SELECT strftime(date_local, '%Y-%m-%d') AS day, sub_reddit, count(*) AS no_comment
FROM posts WHERE prediction = 1 GROUP BY ALL""")
def daily_flagged_by_sub(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_day(rp.daily_flagged_by_sub(posts(spark, sf_dir)))


@query(f"WITH {POSTS_SQL} SELECT author, prediction, count(*) AS no_comment FROM posts GROUP BY ALL")
def author_by_prediction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rp.author_by_prediction(posts(spark, sf_dir))


@query(f"""
WITH {POSTS_SQL},
counts AS (SELECT author, prediction, count(*) AS no_comment FROM posts GROUP BY ALL),
ranked AS (SELECT author, rank() OVER (ORDER BY no_comment DESC) AS place FROM counts WHERE prediction = 1)
SELECT author, prediction, no_comment FROM counts WHERE author IN (SELECT author FROM ranked WHERE place <= 10)""")
def author_by_prediction_top10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rp.top_authors_by_prediction(posts(spark, sf_dir), 10)


@query(f"""
WITH {POSTS_SQL},
counts AS (
  SELECT sub_reddit, author, count(*) AS no_comment, strftime(min(date_local), '%Y-%m-%d') AS first_day,
         strftime(max(date_local), '%Y-%m-%d') AS last_day
  FROM posts WHERE prediction = 1 GROUP BY sub_reddit, author)
SELECT * FROM counts
QUALIFY row_number() OVER (PARTITION BY sub_reddit ORDER BY no_comment DESC, author) <= 5""")
def top5_authors_per_sub(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = rp.top_authors_per_sub(posts(spark, sf_dir), 5)
    return _with_day(_with_day(rows, "first_day", "first_day"), "last_day", "last_day")


@query(f"""
WITH {POSTS_SQL}
SELECT sub_reddit, comment_id, author, CAST(epoch_us("timestamp") AS BIGINT) AS created_us FROM posts
QUALIFY row_number() OVER (PARTITION BY sub_reddit ORDER BY "timestamp" DESC, comment_id) <= 100""")
def newest_per_sub(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = posts(spark, sf_dir).select("sub_reddit", "comment_id", "author", "timestamp")
    newest = rp.newest_per_sub(rows, 100, key="comment_id")
    created = F.unix_micros(F.col("timestamp").cast("timestamp"))
    return newest.select("sub_reddit", "comment_id", "author", created.alias("created_us"))


DRILL_SQL = f"WITH {POSTS_SQL} SELECT %s FROM posts WHERE author = {AUTHOR} AND prediction = 1 AND date_local BETWEEN DATE '2024-01-05' AND DATE '2024-01-25'"


def _drilldown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rp.author_comments(posts(spark, sf_dir), AUTHOR, "2024-01-05", "2024-01-25", only_flagged=True)


@query(DRILL_SQL % "comment_id, sub_reddit, strftime(date_local, '%Y-%m-%d') AS day, hour_local" + " ORDER BY comment_id LIMIT 5")
def author_drilldown(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _drilldown(spark, sf_dir).select("comment_id", "sub_reddit", "date_local", "hour_local")
    return _with_day(rp.first_rows(rows, 5, ["comment_id"]))


@query(DRILL_SQL % "strftime(date_local, '%Y-%m-%d') AS day, count(*) AS n" + " GROUP BY ALL")
def author_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_day(rp.counts_by(_drilldown(spark, sf_dir), "date_local"))


@query(DRILL_SQL % "hour_local, count(*) AS n" + " GROUP BY ALL")
def author_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rp.counts_by(_drilldown(spark, sf_dir), "hour_local")


@query(f"""
WITH {POSTS_SQL}
SELECT strftime(min(date_local), '%Y-%m-%d') AS first_day, strftime(max(date_local), '%Y-%m-%d') AS last_day
FROM posts WHERE author = {AUTHOR}""")
def author_span(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_day(_with_day(rp.author_span(posts(spark, sf_dir), AUTHOR), "first_day", "first_day"), "last_day", "last_day")


@query(f"""
WITH {POSTS_SQL} SELECT DISTINCT author FROM posts WHERE sub_reddit = 'click' AND prediction = 1""")
def flagged_authors_of_sub(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distinct_values(cl.flagged(rp.authors_of_sub(posts(spark, sf_dir), "click")), "author")


@query(f"""
WITH {POSTS_SQL}, counts AS (SELECT hour_local, count(*) AS n FROM posts GROUP BY ALL)
SELECT CAST(h AS INTEGER) AS hour, coalesce(n, 0) AS n FROM range(24) hours(h) LEFT JOIN counts ON hour_local = h""")
def hour_hist(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rp.hour_histogram(posts(spark, sf_dir))


@query(f"""
WITH {POSTS_SQL} SELECT strftime(timestamp_local, '%I%p') AS hour, hour_local, count(*) AS n FROM posts GROUP BY ALL""")
def hour_label_hist(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = vl.hour_label(F.col("timestamp_local")).alias("hour")
    return rp.counts_by(posts(spark, sf_dir), label, "hour_local").orderBy("hour_local")


@query(f"""
WITH {POSTS_SQL}
SELECT strftime(date_local, '%Y-%m-%d') AS day, count(DISTINCT author) AS n_authors FROM posts GROUP BY ALL""")
def unique_authors_per_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_day(rp.unique_authors_per_day(posts(spark, sf_dir)))


# ---- profiles -----------------------------------------------------------------------------------


@query("""
WITH s AS (
  SELECT CAST(count(value) AS DOUBLE) AS count, avg(value) AS mean, stddev_samp(value) AS std, min(value) AS min,
         quantile_cont(value, 0.25) AS "25%", quantile_cont(value, 0.5) AS "50%", quantile_cont(value, 0.75) AS "75%",
         max(value) AS max FROM events)
SELECT statistic, round(value, 6) AS value FROM (UNPIVOT s ON COLUMNS(*) INTO NAME statistic VALUE value)""")
def profile_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pf.numeric_profile(table(spark, sf_dir, "events"), "value").withColumn("value", F.round("value", 6))


def _profile_sql(column: str) -> str:
    return f"""
SELECT '{column}' AS "column", statistic, round(value, 6) AS value FROM (UNPIVOT (
  SELECT CAST(count({column}) AS DOUBLE) AS count, avg({column}) AS mean, stddev_samp({column}) AS std,
         CAST(min({column}) AS DOUBLE) AS min, quantile_cont(CAST({column} AS DOUBLE), 0.25) AS "25%",
         quantile_cont(CAST({column} AS DOUBLE), 0.5) AS "50%", quantile_cont(CAST({column} AS DOUBLE), 0.75) AS "75%",
         CAST(max({column}) AS DOUBLE) AS max FROM lineitem) ON COLUMNS(*) INTO NAME statistic VALUE value)"""


LINEITEM_NUMBERS = [
    "l_orderkey",
    "l_partkey",
    "l_suppkey",
    "l_linenumber",
    "l_quantity",
    "l_extendedprice",
    "l_discount",
    "l_tax",
]


@query(" UNION ALL ".join(_profile_sql(column) for column in LINEITEM_NUMBERS))
def profile_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All numeric columns."""
    return pf.numeric_profiles(table(spark, sf_dir, "lineitem")).withColumn("value", F.round("value", 6))


@query("""
SELECT 'event_id' AS "column", 0 AS n_null UNION ALL
SELECT 'event_type', count(*) FILTER (WHERE event_id % 7 = 0) FROM events UNION ALL
SELECT 'value', count(*) FILTER (WHERE event_id % 3 = 0) FROM events""")
def profile_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    holes = table(spark, sf_dir, "events").select(
        "event_id",
        F.when(F.col("event_id") % 7 != 0, F.col("event_type")).alias("event_type"),
        F.when(F.col("event_id") % 3 != 0, F.col("value")).alias("value"),
    )
    return pf.null_counts(holes)


@query("""
WITH s AS (
  SELECT count(DISTINCT event_id) AS event_id, count(DISTINCT ts) AS ts, count(DISTINCT user_id) AS user_id,
         count(DISTINCT event_type) AS event_type, count(DISTINCT value) AS value, count(DISTINCT props) AS props FROM events)
SELECT "column", n_distinct FROM (UNPIVOT s ON COLUMNS(*) INTO NAME "column" VALUE n_distinct)""")
def profile_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pf.distinct_counts(table(spark, sf_dir, "events"))


@query("""
SELECT 'event_id' AS "column", 'bigint' AS type, count(event_id) AS n_present FROM events UNION ALL
SELECT 'ts', 'timestamp_ntz', count(ts) FROM events UNION ALL SELECT 'user_id', 'bigint', count(user_id) FROM events UNION ALL
SELECT 'event_type', 'string', count(event_type) FROM events UNION ALL SELECT 'value', 'double', count(value) FROM events
UNION ALL SELECT 'props', 'string', count(props) FROM events""")
def profile_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pf.table_info(table(spark, sf_dir, "events"))


@query("SELECT floor(value / 25.0) * 25.0 AS bin_start, count(*) AS n FROM events WHERE value IS NOT NULL GROUP BY ALL")
def hist_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pf.histogram(table(spark, sf_dir, "events"), "value", 25.0)


@query("""
WITH q AS (
  SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median, quantile_cont(value, 0.75) AS q3 FROM events),
w AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM q)
SELECT round(any_value(q1), 6) AS q1, round(any_value(median), 6) AS median, round(any_value(q3), 6) AS q3,
       min(value) FILTER (WHERE value BETWEEN lo AND hi) AS low, max(value) FILTER (WHERE value BETWEEN lo AND hi) AS high,
       count(*) FILTER (WHERE value NOT BETWEEN lo AND hi) AS n_outliers
FROM events, w""")
def box_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    box = pf.box_statistics(table(spark, sf_dir, "events"), "value")
    return box.withColumns({name: F.round(name, 6) for name in ("q1", "median", "q3")})


@query("""
SELECT CAST(sum(n) AS BIGINT) AS n_rows, count(*) AS n_distinct, CAST(sum(n) - count(*) AS BIGINT) AS n_duplicates
FROM (SELECT count(*) AS n FROM documents GROUP BY text, lang, n_chars)""")
def duplicate_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pf.duplicate_rows(table(spark, sf_dir, "documents").select("text", "lang", "n_chars"))


# ---- coercion, dates and validity ---------------------------------------------------------------


@query("""
SELECT event_id, CAST(floor(value) AS INTEGER) AS upvotes, round(value / 500, 6) AS upvote_ratio
FROM events WHERE event_id % 5 <> 0 AND event_id % 8 <> 0""")
def coerce_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers that arrive as text, some of them bad, to numbers."""
    event = F.col("event_id")
    arrived = table(spark, sf_dir, "events").select(
        "event_id",
        F.when(event % 5 == 0, "n/a").otherwise(F.floor("value").cast("string")).alias("upvotes"),
        F.when(event % 8 == 0, "").otherwise((F.col("value") / 500).cast("string")).alias("upvote_ratio"),
    )
    rows = cl.coerce_numbers(arrived, {"upvotes": "int", "upvote_ratio": "double"})
    return rows.withColumn("upvote_ratio", F.round("upvote_ratio", 6))


@query("""
SELECT event_id, CASE WHEN event_id % 6 <> 0 THEN strftime(ts, '%Y-%m-%d %H:%M:%S') END AS moment,
       CASE WHEN event_id % 9 <> 0 THEN strftime(ts, '%Y-%m-%d') END AS day FROM events""")
def coerce_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    event = F.col("event_id")
    arrived = table(spark, sf_dir, "events").select(
        "event_id",
        F.when(event % 6 == 0, "soon").otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).alias("moment"),
        F.when(event % 9 == 0, "32 May").otherwise(F.date_format("ts", "yyyy-MM-dd")).alias("day"),
    )
    rows = cl.coerce_dates(arrived, {"moment": "timestamp_ntz", "day": "date"})
    return rows.select("event_id", F.date_format("moment", "yyyy-MM-dd HH:mm:ss").alias("moment"), day_text("day").alias("day"))


@query("""
SELECT event_id, CASE WHEN event_id % 4 <> 0 THEN strftime(ts, '%Y-%m-%d %H:%M') END AS moment,
       CAST(event_id % 4 = 0 AS INTEGER) AS rejected FROM events""")
def parse_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dates as day/month/two-digit year; a four-digit year is a reject."""
    pattern = F.when(F.col("event_id") % 4 == 0, F.date_format("ts", "d/M/yyyy H:mm"))
    arrived = table(spark, sf_dir, "events").select("event_id", pattern.otherwise(F.date_format("ts", "d/M/yy H:mm")).alias("text"))
    good, rejects = cl.parsed_and_rejected(arrived, {"moment": vl.parse_time(F.col("text"))})
    moment = F.date_format("moment", "yyyy-MM-dd HH:mm")
    return good.select("event_id", moment.alias("moment"), F.lit(0).alias("rejected")).unionByName(
        rejects.select("event_id", F.lit(None).cast("string").alias("moment"), F.lit(1).alias("rejected"))
    )


@query("""
SELECT event_id, strftime(ts, '%Y-%m-%d') AS day FROM events
WHERE event_id % 9 <> 0 AND event_id % 11 <> 0 AND year(ts) = 2024""")
def row_sanity(spark: SparkSession, sf_dir: str) -> DataFrame:
    event = F.col("event_id")
    arrived = table(spark, sf_dir, "events").select(
        "event_id",
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("timestamp"),
        F.when(event % 9 == 0, "ab").otherwise(F.lpad(event.cast("string"), 7, "0")).alias("comment_id"),
        F.when(event % 11 == 0, "2024-3-1").otherwise(F.date_format("ts", "yyyy-MM-dd")).alias("date"),
    )
    return cl.row_sanity(arrived).select("event_id", F.col("date").alias("day"))


@query("""
SELECT lpad(CAST(event_id AS VARCHAR), 7, '0') AS comment_id, event_type AS sub_reddit, CAST(value >= 100 AS INTEGER) AS prediction,
       strftime(ts + INTERVAL 8 HOUR, '%Y-%m-%d %H:%M:%S') AS timestamp_local,
       strftime(ts + INTERVAL 8 HOUR, '%Y-%m-%d') AS day, CAST(hour(ts + INTERVAL 8 HOUR) AS INTEGER) AS hour_local
FROM events WHERE event_id % 9 <> 0 AND event_id % 17 <> 0 AND year(ts) = 2024""")
def dashboard_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scored posts made ready for the dashboard; some lack a prediction or have a broken id."""
    event = F.col("event_id")
    scored = table(spark, sf_dir, "events").select(
        F.when(event % 9 == 0, "broken id").otherwise(F.lpad(event.cast("string"), 7, "0")).alias("comment_id"),
        F.col("event_type").alias("sub_reddit"),
        F.when(event % 17 != 0, (F.col("value") >= 100).cast("int")).alias("prediction"),
        F.col("ts").alias("timestamp"),
        F.to_date("ts").alias("date"),
        F.col("props").alias("body"),
        F.col("event_type").alias("submission"),
    )
    return _with_day(cl.dashboard_rows(scored))


@query(f"""
SELECT CAST(event_id AS VARCHAR) AS comment_id, strftime(ts, '%Y-%m-%d') AS day,
       md5(lower(regexp_replace(event_type || chr(10) || 'http://x.y/' || event_id || ' ' || props, '{URL_SQL}|\n', '', 'g'))) AS body_md5,
       lower(event_type) AS submission_cleaned
FROM events WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-15' AND DATE '2024-01-20'""")
def raw_to_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw comments of some days renamed to the working columns and cleaned."""
    raw = table(spark, sf_dir, "events").select(
        F.get_json_object("props", "$.k").alias("sub_id"),
        F.col("event_id").cast("string").alias("id"),
        F.col("ts").alias("created_utc"),
        F.col("user_id").cast("string").alias("author"),
        F.concat("event_type", F.lit("\nhttp://x.y/"), "event_id", F.lit(" "), "props").alias("body"),
        F.upper("event_type").alias("sub_title"),
        F.col("event_type").alias("sr"),
        F.floor("value").cast("int").alias("sub_score"),
        F.lit(0.5).alias("sub_upvote_ratio"),
        F.to_date("ts").alias("dt"),
    )
    clean = cl.raw_to_clean(raw, "2024-01-15", "2024-01-20")
    return clean.select("comment_id", day_text("date").alias("day"), F.md5("body_cleaned").alias("body_md5"), "submission_cleaned")


@query("""
SELECT event_id, strftime(ts, '%Y-%m-%d') AS day FROM events
WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-15' AND DATE '2024-01-19'""")
def ingest_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", F.to_date("ts").alias("dt"))
    return _with_day(cl.ingest_window(events, "dt", "2024-01-20"), "dt")


@query("""
SELECT event_id AS comment_id, strftime(ts, '%Y-%m-%d') AS day, user_id AS author, event_type AS sub_reddit FROM events""")
def rename_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = {"event_id": "comment_id", "user_id": "author", "event_type": "sub_reddit", "ts": "timestamp"}
    rows = cl.with_day_key(cl.rename_columns(table(spark, sf_dir, "events"), names))
    return cl.move_column(rows, "day", 1).drop("timestamp")


@query("""
SELECT event_id, strftime(ts + INTERVAL 8 HOUR, '%Y-%m-%d %H:%M:%S') AS local_text,
       strftime(ts + INTERVAL 8 HOUR, '%Y-%m-%d') AS day, CAST(hour(ts + INTERVAL 8 HOUR) AS INTEGER) AS hour_local,
       strftime(ts + INTERVAL 8 HOUR, '%I%p') AS hour_label,
       strftime(make_timestamp((1704067200 + event_id * 60) * 1000000), '%Y-%m-%d %H:%M:%S') AS from_epoch FROM events""")
def local_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = cl.with_local_time(table(spark, sf_dir, "events"), "ts")
    return rows.select(
        "event_id",
        F.date_format("timestamp_local", "yyyy-MM-dd HH:mm:ss").alias("local_text"),
        day_text("date_local").alias("day"),
        "hour_local",
        vl.hour_label(F.col("timestamp_local")).alias("hour_label"),
        F.date_format(F.timestamp_seconds(F.lit(1704067200) + F.col("event_id") * 60), "yyyy-MM-dd HH:mm:ss").alias("from_epoch"),
    )


@query("""
SELECT event_id + part AS post, CAST(user_id AS VARCHAR) AS author, event_type AS subreddit, CAST(part + event_id % 50 AS INTEGER) AS score,
       strftime(make_timestamp((1704067200 + event_id) * 1000000), '%Y-%m-%d %H:%M:%S') AS moment
FROM events, (SELECT unnest([0, 1]) AS part)""")
def listing_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listing JSON made from events, two posts per listing, and taken apart again."""

    def child(part: int) -> Column:
        post = F.struct(
            (F.lit(1704067200.0) + F.col("event_id")).alias("created_utc"),
            F.col("event_type").alias("subreddit"),
            (F.col("event_id") + part).cast("string").alias("title"),
            F.col("user_id").cast("string").alias("author"),
            (F.col("event_id") % 50 + part).cast("int").alias("score"),
        )
        return F.struct(post.alias("data"))

    listing = F.struct(F.struct(F.array(child(0), child(1)).alias("children")).alias("data"))
    pages = table(spark, sf_dir, "events").select(F.to_json(listing).alias("json"))
    rows = flatten_listing(pages, "json", schemas.LISTING)
    moment = F.date_format("date", "yyyy-MM-dd HH:mm:ss")
    return rows.select(F.col("title").cast("long").alias("post"), "author", "subreddit", "score", moment.alias("moment"))


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events")
def json_field_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", json_field("props", "$.k", "int").alias("k"))


DAY_RANGES = [("2024-01-02", "2024-01-09"), ("2024-01-10", "2024-01-24"), ("2024-01-01", "2024-01-31")]
DAY_RANGES_SQL = ", ".join(f"('{first}', '{last}')" for first, last in DAY_RANGES)


@query(f"""
WITH {POSTS_SQL}, ranges(first_day, last_day) AS (VALUES {DAY_RANGES_SQL})
SELECT first_day, last_day, count(*) AS n_rows, true AS authors_close, true AS median_close
FROM posts JOIN ranges ON date_local BETWEEN CAST(first_day AS DATE) AND CAST(last_day AS DATE) GROUP BY ALL""")
def sketch_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Comments, different authors and the median value of ranges of days, from stored sketches of days; the
    estimates are held against all rows and their stated errors."""
    path = scratch_path(spark, "sketches")
    rows = posts(spark, sf_dir)
    sk.store_sketches(sk.day_sketches(rows, "date_local", "author", "value"), path)
    found = None
    for first, last in DAY_RANGES:
        one = sk.merged(sk.read_sketches(spark, path, first, last), quantiles=[0.5])
        one = one.select(F.lit(first).alias("first_day"), F.lit(last).alias("last_day"), "*")
        found = one if found is None else found.unionByName(one)
    spans = F.array(*[F.struct(F.lit(first).alias("first_day"), F.lit(last).alias("last_day")) for first, last in DAY_RANGES])
    day = F.col("date_local").cast("string")
    ranged = rows.select("author", "value", F.explode(F.filter(spans, lambda span: day.between(span["first_day"], span["last_day"]))).alias("span"))
    ranged = ranged.select("author", "value", "span.*").join(found.select("first_day", F.get("quantiles", F.lit(0)).alias("median")), "first_day")
    value = F.col("value").cast("double")
    exact = ranged.groupBy("first_day").agg(
        F.count_distinct("author").alias("authors"),
        (F.count_if(value < F.col("median")) / F.count("value")).alias("below"),
        (F.count_if(value <= F.col("median")) / F.count("value")).alias("up_to"),
    )
    # Four standard errors, and one more for very few authors.
    authors = F.abs(F.col("n_distinct") - F.col("authors")) <= 4 * sk.RELATIVE_ERROR * F.col("authors") + 1
    median = (F.col("below") - sk.RANK_ERROR <= 0.5) & (F.col("up_to") + sk.RANK_ERROR >= 0.5)
    return found.join(exact, "first_day").select("first_day", "last_day", "n_rows", authors.alias("authors_close"), median.alias("median_close"))
