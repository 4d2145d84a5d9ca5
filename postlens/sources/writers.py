"""Writers: CSV, partitioned Parquet, metric reports and upserted tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from postlens.operators.joins import upsert

# Fixed value: how null is written, so that an empty text stays one.
NULL_MARK = "\\N"
CSV_WRITE_OPTIONS = {
    "header": "true",
    "escape": '"',
    "quoteAll": "true",
    "emptyValue": "",
    "nullValue": NULL_MARK,
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", rows_per_file: int = 50_000) -> None:
    """Part files, each with a header, written by the tasks that hold the rows.

    A file with quoted newlines is read by one task, so files are kept short.
    """
    df.write.mode(mode).options(**CSV_WRITE_OPTIONS, maxRecordsPerFile=rows_per_file).csv(path)


def write_partitioned(df: DataFrame, path: str, by: Sequence[str] = ("sr", "sm", "dt"), rows_per_file: int = 5_000_000) -> None:
    """Parquet folders by key; a second run replaces only the folders it writes to.

    Rebalancing by the keys gives each folder few files; AQE splits a key with very many rows over
    several tasks and packs small keys together.
    """
    rows = df.hint("rebalance", *by)
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.option("maxRecordsPerFile", rows_per_file).partitionBy(*by).parquet(path)


def written_partitions(df: DataFrame, by: Sequence[str] = ("sr", "sm", "dt")) -> list[tuple]:
    """The folders that ``write_partitioned`` writes for these rows, as values of the keys: what a run changed.
    Only the keys are read; there are as many as folders."""
    return [tuple(row) for row in df.select(*by).distinct().collect()]


def append_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def write_upsert(
    base_path: str, updates: DataFrame, target_path: str, keys: Sequence[str], order: Sequence[str] = ()
) -> DataFrame:
    """Apply updates to a stored table and write the result to another path.

    The target must differ: a path must not be overwritten while it is being read. Readers move to
    the new path once the write has committed.
    """
    if base_path.rstrip("/") == target_path.rstrip("/"):
        raise ValueError("the target must differ from the path being read")
    spark = updates.sparkSession
    base = spark.read.parquet(base_path)
    upsert(base, updates, keys, order).write.parquet(target_path)
    return spark.read.schema(base.schema).parquet(target_path)


def write_metrics(metrics: DataFrame, path: str) -> None:
    """Add ``(model, metric, value)`` rows to a report table."""
    metrics.select("model", "metric", "value").write.mode("append").parquet(path)
