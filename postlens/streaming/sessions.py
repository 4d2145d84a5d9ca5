"""Sessions of authors by event time, kept up by a stream that loses no late comment.

A session is a run of an author's comments of which no two neighbours are more than ``gap`` seconds apart. Sessions are
summaries ``(author, first, last, n_comment)`` that merge: comments of one gap's width are one summary before anything
is shuffled by author, so an author holds at most the span of time divided by the gap, however many comments there are.

The stream keeps the newest time that it has seen. A comment that is more than ``delay`` seconds older than the newest
one of the batches before is late: its row goes to a side table. All others are merged into the open sessions, and a
session that no timely comment can reach any more is closed and never read again. So the state is the open sessions,
and ``whole_sessions`` adds the late rows whenever the full answer is wanted.

Defined results: a comment without a time is in no session; comments without an author are one author's.
"""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from postlens.streaming.jobs import start_stream

MICROS = 1_000_000


def session_parts(rows: DataFrame, time: str, author: str, gap: int) -> DataFrame:
    """Comments of an author within one gap's width of time as one summary; map tasks combine them."""
    moment = F.col(time).cast("timestamp")
    slot = F.floor(F.unix_micros(moment) / F.lit(gap * MICROS))
    parts = rows.filter(F.col(time).isNotNull()).groupBy(F.col(author).alias("author"), slot.alias("_slot"))
    return parts.agg(F.min(moment).alias("first"), F.max(moment).alias("last"), F.count(F.lit(1)).alias("n_comment")).drop("_slot")


def merge_sessions(parts: DataFrame, gap: int) -> DataFrame:
    """Summaries that touch become one session. Each opens a window as long as itself and a gap."""
    length = F.unix_micros("last") - F.unix_micros("first") + F.lit(gap * MICROS)
    reach = F.concat(length.cast("string"), F.lit(" microseconds"))
    merged = parts.groupBy("author", F.session_window("first", reach).alias("_reach"))
    found = merged.agg(F.min("first").alias("first"), F.max("last").alias("last"), F.sum("n_comment").alias("n_comment"))
    return found.drop("_reach")


def sessions(rows: DataFrame, time: str, author: str, gap: int) -> DataFrame:
    """``(author, first, last, n_comment)`` of a table in one go."""
    return merge_sessions(session_parts(rows, time, author, gap), gap)


def _schema(author: T.DataType, *more: T.StructField) -> T.StructType:
    fields = [T.StructField("author", author), T.StructField("first", T.TimestampType()), T.StructField("last", T.TimestampType())]
    return T.StructType([*fields, T.StructField("n_comment", T.LongType()), T.StructField("closed", T.BooleanType()), *more])


def write_sessions(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    time: str,
    author: str,
    gap: int,
    delay: int,
    once: bool = False,
    every: str = "1 minute",
) -> StreamingQuery:
    """Keep sessions under ``path``: a folder of each batch with the sessions that it closed and those then open, and
    one with its late rows. A batch that runs again reads what the batch before it left and replaces its own folders."""
    schema = _schema(stream.schema[author].dataType)

    def save(batch: DataFrame, batch_id: int) -> None:
        before = None
        if batch_id > 0:
            kept = batch.sparkSession.read.schema(schema).parquet(f"{path}/sessions/batch={batch_id - 1}")
            before = kept.filter(~F.col("closed")).drop("closed")
        moment = F.col(time).cast("timestamp")
        seen = None if before is None else before.agg(F.max("last")).first()[0]
        late = F.lit(False) if seen is None else F.coalesce(moment < F.lit(seen - datetime.timedelta(seconds=delay)), F.lit(False))
        batch.filter(late).write.mode("overwrite").parquet(f"{path}/late/batch={batch_id}")
        newest = batch.agg(F.max(moment)).first()[0]
        newest = max((one for one in (seen, newest) if one is not None), default=None)
        parts = session_parts(batch.filter(~late), time, author, gap)
        merged = merge_sessions(parts if before is None else parts.unionByName(before), gap)
        line = F.lit(None) if newest is None else F.lit(newest - datetime.timedelta(seconds=gap + delay))
        marked = merged.withColumn("closed", F.coalesce(F.col("last") < line, F.lit(False)))
        marked.write.mode("overwrite").partitionBy("closed").parquet(f"{path}/sessions/batch={batch_id}")

    return start_stream(stream.writeStream.foreachBatch(save), checkpoint, once, every)


def stored_sessions(spark: SparkSession, path: str, author_type: T.DataType) -> DataFrame:
    """What the stream holds without its late rows: all closed sessions and those open after its last batch."""
    schema = _schema(author_type, T.StructField("batch", T.LongType()))
    rows = spark.read.schema(schema).parquet(f"{path}/sessions")
    last = rows.filter(~F.col("closed")).agg(F.max("batch"))
    return rows.filter(F.col("closed") | (F.col("batch") == last.scalar())).drop("batch", "closed")


def late_rows(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The comments that came too late for their session."""
    return spark.read.schema(schema).parquet(f"{path}/late")


def whole_sessions(spark: SparkSession, path: str, schema: T.StructType, time: str, author: str, gap: int) -> DataFrame:
    """The sessions of all comments, late ones too: they may lengthen stored sessions or make two of them one."""
    late = session_parts(late_rows(spark, path, schema), time, author, gap)
    return merge_sessions(stored_sessions(spark, path, schema[author].dataType).unionByName(late), gap)
