"""Queries that write tables to the shared folder, read them back and give what was read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postlens.operators.cleaning import flagged
from postlens.operators.joins import union_all
from postlens.plans.registry import query
from postlens.plans.tables import POSTS_SQL, day_text, posts, rule_predictions, table
from postlens.session import scratch_path
from postlens.sources import keyed, readers, writers

DOCUMENT_SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)
FLAGGED_SCHEMA = "comment_id long, author long, sub_reddit string, value double"
EVENT_COLUMNS = ["event_id", "user_id", "value"]


def _partitioned_events(spark: SparkSession, sf_dir: str) -> str:
    path = scratch_path(spark, "events")
    events = table(spark, sf_dir, "events").select(
        *EVENT_COLUMNS, F.col("event_type").alias("sr"), F.to_date("ts").alias("dt")
    )
    writers.write_partitioned(events, path, by=["sr", "dt"])
    return path


@query("SELECT doc_id, md5(text) AS text_md5, lang, source, n_chars FROM documents")
def csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts with newlines and quotes through CSV."""
    path = scratch_path(spark, "documents-csv")
    writers.write_csv(table(spark, sf_dir, "documents").select(*DOCUMENT_SCHEMA.fieldNames()), path)
    rows = readers.read_csv(spark, path, DOCUMENT_SCHEMA)
    return rows.select("doc_id", F.md5("text").alias("text_md5"), "lang", "source", "n_chars")


@query(f"WITH {POSTS_SQL} SELECT comment_id, author, sub_reddit, value FROM posts WHERE prediction = 1")
def flagged_csv_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagged rows as CSV part files; all part files are read."""
    path = scratch_path(spark, "flagged-csv")
    writers.write_csv(flagged(posts(spark, sf_dir), ["comment_id", "author", "sub_reddit", "value"]), path)
    return readers.read_csv(spark, path, FLAGGED_SCHEMA)


@query("""
SELECT CASE WHEN event_id % 13 = 0 THEN 'reject' ELSE 'good' END AS kind, count(event_id) AS n,
       CAST(sum(event_id) AS BIGINT) AS id_sum FROM events GROUP BY ALL""")
def csv_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with a field too many, put in by rule, are told from good rows."""
    path = scratch_path(spark, "broken-csv")
    extra = F.when(F.col("event_id") % 13 == 0, ",left over").otherwise("")
    lines = table(spark, sf_dir, "events").select(F.concat_ws(",", "event_id", "event_type", "user_id").alias("line"), extra.alias("extra"))
    lines.select(F.concat("line", "extra")).write.text(path)
    schema = T.StructType.fromDDL("event_id long, event_type string, user_id long")
    # The lines written here have no header.
    good, rejects = readers.read_csv_with_rejects(spark, path, schema, header="false")
    kinds = [rows.select(F.lit(kind).alias("kind"), "event_id") for kind, rows in (("good", good), ("reject", rejects))]
    return union_all(*kinds).groupBy("kind").agg(F.count("event_id").alias("n"), F.sum("event_id").alias("id_sum"))


@query("""
SELECT event_id, user_id, value, event_type AS sr, strftime(ts, '%Y-%m-%d') AS day FROM events
WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-10' AND DATE '2024-01-12'""")
def parquet_partition_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = readers.read_partitioned(spark, _partitioned_events(spark, sf_dir), "2024-01-10", "2024-01-12")
    return rows.select(*EVENT_COLUMNS, "sr", day_text("dt").alias("day"))


@query("SELECT event_id, user_id, value FROM events")
def recursive_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every file below a nested folder as one table; the folder names play no part."""
    return readers.read_recursive(spark, _partitioned_events(spark, sf_dir)).select(*EVENT_COLUMNS)


@query("""
SELECT event_type AS sr, strftime(ts, '%Y-%m-%d') AS day, count(*) AS n FROM events GROUP BY ALL""")
def recover_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A partitioned folder as a catalog table, its partitions found on disk."""
    path = _partitioned_events(spark, sf_dir)
    schema = T.StructType.fromDDL("event_id long, user_id long, value double, sr string, dt date")
    name = "events_" + path.rsplit("-", 1)[-1]
    rows = readers.register_partitions(spark, name, path, schema, ["sr", "dt"])
    return rows.groupBy("sr", day_text("dt").alias("day")).agg(F.count("*").alias("n"))


@query("""
SELECT event_id, user_id, CASE WHEN CAST(ts AS DATE) >= DATE '2024-01-20' THEN -1 ELSE value END AS value FROM events""")
def partition_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second run over the last days replaces those days and leaves the others."""
    path = _partitioned_events(spark, sf_dir)
    again = table(spark, sf_dir, "events").select(
        "event_id", "user_id", F.lit(-1.0).alias("value"), F.col("event_type").alias("sr"), F.to_date("ts").alias("dt")
    )
    writers.write_partitioned(again.filter("dt >= DATE '2024-01-20'"), path, by=["sr", "dt"])
    return readers.read_partitioned(spark, path).select(*EVENT_COLUMNS)


@query("""
SELECT doc_id, quality, toxic, count(*) AS copies FROM (SELECT * FROM labels UNION ALL SELECT * FROM labels WHERE toxic = 1)
GROUP BY ALL""")
def append_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "labels")
    labels = table(spark, sf_dir, "labels")
    writers.append_parquet(labels, path)
    writers.append_parquet(labels.filter("toxic = 1"), path)
    return spark.read.parquet(path).groupBy("doc_id", "quality", "toxic").agg(F.count("*").alias("copies"))


@query("""
SELECT doc_id, CASE WHEN toxic = 1 THEN 1 - quality ELSE quality END AS quality, toxic FROM labels""")
def upsert_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Updates applied to a stored table, the result written to a new path."""
    base, target = scratch_path(spark, "base"), scratch_path(spark, "target")
    labels = table(spark, sf_dir, "labels")
    labels.write.parquet(base)
    updates = labels.filter("toxic = 1").withColumn("quality", 1 - F.col("quality"))
    return writers.write_upsert(base, updates, target, ["doc_id"])


@query("""
SELECT prediction, label, count(*) AS n FROM (SELECT toxic AS label, CAST(quality = 0 AS INTEGER) AS prediction FROM labels)
GROUP BY ALL""")
def report_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A report as CSV, read back."""
    path = scratch_path(spark, "report-csv")
    counts = rule_predictions(spark, sf_dir).groupBy("prediction", "label").agg(F.count("*").alias("n"))
    writers.write_csv(counts, path)
    return readers.read_csv(spark, path, T.StructType.fromDDL("prediction int, label int, n long"))


@query("""
SELECT doc_id, CASE WHEN toxic = 1 THEN 1 - quality ELSE quality END AS quality, toxic FROM labels
UNION ALL SELECT doc_id + 100000000, quality, 1 AS toxic FROM labels WHERE quality = 0""")
def upsert_keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two upserts into a table in key buckets: changed rows, then changed and new ones; only touched buckets are
    rewritten."""
    path = scratch_path(spark, "keyed")
    labels = table(spark, sf_dir, "labels")
    keyed.create_keyed(labels, path, ["doc_id"], buckets=32)
    turned = labels.filter("toxic = 1").withColumn("quality", F.lit(7))
    keyed.upsert_keyed(path, turned)
    again = labels.filter("toxic = 1").withColumn("quality", 1 - F.col("quality"))
    added = labels.filter("quality = 0").withColumns({"doc_id": F.col("doc_id") + 100000000, "toxic": F.lit(1)})
    keyed.upsert_keyed(path, union_all(again, added))
    return keyed.read_keyed(spark, path).select("doc_id", "quality", "toxic")


@query("""
SELECT event_type AS sr, strftime(ts, '%Y-%m-%d') AS day, count(*) AS n FROM events GROUP BY ALL""")
def changed_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A catalog table that learns of new partitions by what two runs wrote, without listing its folder."""
    path = scratch_path(spark, "events-changed")
    events = table(spark, sf_dir, "events").select(*EVENT_COLUMNS, F.col("event_type").alias("sr"), F.to_date("ts").alias("dt"))
    schema = T.StructType.fromDDL("event_id long, user_id long, value double, sr string, dt date")
    name = "changed_" + path.rsplit("-", 1)[-1]
    for part in (events.filter("dt < DATE '2024-01-20'"), events.filter("dt >= DATE '2024-01-20'")):
        writers.write_partitioned(part, path, by=["sr", "dt"])
        rows = readers.add_partitions(spark, name, path, schema, ["sr", "dt"], writers.written_partitions(part, ["sr", "dt"]))
    return rows.groupBy("sr", day_text("dt").alias("day")).agg(F.count("*").alias("n"))


@query("""
SELECT CASE WHEN event_id % 17 = 0 THEN 'reject' ELSE 'good' END AS kind, event_type AS sub_reddit,
       CASE WHEN event_id % 17 <> 0 THEN json_extract_string(props, '$.k') END AS k, count(*) AS n FROM events GROUP BY ALL""")
def json_without_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Properties of events read without naming their fields first; texts broken by rule are told apart."""
    events = table(spark, sf_dir, "events")
    broken = F.when(F.col("event_id") % 17 == 0, F.left("props", F.length("props") - 1)).otherwise(F.col("props"))
    good, rejects = readers.parsed_json(events.withColumn("props", broken), "props")
    good = readers.json_fields(good, "parsed", {"k": ("$.k", "string")}).withColumn("kind", F.lit("good"))
    rows = union_all(good.select("kind", "event_type", "k"), rejects.select(F.lit("reject").alias("kind"), "event_type"))
    return rows.groupBy("kind", F.col("event_type").alias("sub_reddit"), "k").agg(F.count("*").alias("n"))
