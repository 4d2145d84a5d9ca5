"""Streaming ingest, counts and scoring.

Every job keeps its progress in a checkpoint folder, so a restart goes on where it stopped and adds
nothing twice. ``once=True`` works through what is there and stops; a cron job becomes such a run.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.ml import Model
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.readwriter import DataStreamWriter

from postlens.functions.values import to_local
from postlens.learning.scoring import score
from postlens.operators.cleaning import clean_posts


def comment_stream(
    spark: SparkSession,
    folder: str,
    schema: T.StructType,
    file_format: str = "parquet",
    files_per_batch: int = 100,
    since: str | None = None,
    time_column: str = "dt",
    **options: str,
) -> DataFrame:
    """New files of a folder as an unbounded table. ``since`` skips comments older than a moment."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).options(**options)
    stream = reader.format(file_format).load(folder)
    if since is None:
        return stream
    return stream.filter(F.col(time_column) >= F.lit(since).cast(schema[time_column].dataType))


def start_stream(writer: DataStreamWriter, checkpoint: str, once: bool, every: str) -> StreamingQuery:
    writer = writer.option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime=every)
    return writer.start()


def write_stream(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    file_format: str = "parquet",
    once: bool = False,
    every: str = "1 minute",
    **options: str,
) -> StreamingQuery:
    """Append a stream to files, each row once."""
    return start_stream(stream.writeStream.format(file_format).outputMode("append").options(**options, path=path), checkpoint, once, every)


def without_repeats(stream: DataFrame, time_column: str, key: str = "comment_id", delay: str | None = None) -> DataFrame:
    """Each comment once, though ingest pulls a window of days again and again.

    Without a delay every id stays in state and nothing else is dropped, in whatever order files come.
    With one, ids leave the state once the newest comment is that much younger, and comments that come
    later still are left out; it must cover the pulled window and the disorder of the files.
    """
    if delay is None:
        return stream.dropDuplicates([key])
    return stream.withWatermark(time_column, delay).dropDuplicatesWithinWatermark([key])


def daily_counts(
    stream: DataFrame,
    time_column: str,
    group: str = "sub_reddit",
    delay: str | None = None,
    hours: int = 8,
    width: str = "1 day",
) -> DataFrame:
    """Comments per local day and group.

    Without a delay the state keeps one number per day and group, and late comments always count. With
    one, a day leaves the state after the delay and later comments of it are left out.
    """
    local = stream.withColumn("_local", to_local(F.col(time_column), hours))
    if delay is not None:
        local = local.withWatermark("_local", delay)
    counts = local.groupBy(F.window("_local", width).alias("span"), group).agg(F.count("*").alias("no_comment"))
    return counts.select(F.col("span.start").alias("start"), group, "no_comment")


def write_counts(
    counts: DataFrame, path: str, checkpoint: str, once: bool = False, every: str = "1 minute"
) -> StreamingQuery:
    """Keep the newest count of every key, one folder per batch: what the batch changed, and the rest of the
    folder before it. A batch that runs again replaces its folder; folders before the last two may go."""

    def save(batch: DataFrame, batch_id: int) -> None:
        spark, keys = batch.sparkSession, [name for name in batch.columns if name != "no_comment"]
        if batch_id > 0:
            before = spark.read.schema(batch.schema).parquet(f"{path}/batch={batch_id - 1}")
            same = reduce(Column.__and__, [before[name].eqNullSafe(batch[name]) for name in keys])
            batch = batch.unionByName(before.join(batch, same, "left_anti"))
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return start_stream(counts.writeStream.outputMode("update").foreachBatch(save), checkpoint, once, every)


def latest_counts(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """The newest count of each key: the folder of the last batch, and no other, is read."""
    counts = spark.read.parquet(path)
    last = counts.select("batch").distinct().agg(F.max("batch")).first()[0]
    return counts.filter(F.col("batch") == last).select(*keys, "no_comment")


def score_stream(stream: DataFrame, vectorizer: Model, model: Model, columns: dict[str, str] | None = None) -> DataFrame:
    """Clean and score comments as they come. The transforms hold no state."""
    return score(clean_posts(stream, columns), vectorizer, model)


def run_to_end(start: Callable[[], StreamingQuery]) -> None:
    """Start a bounded run, wait for its end and pass on its error."""
    query = start()
    query.awaitTermination()
    error = query.exception()
    if error is not None:
        raise error
