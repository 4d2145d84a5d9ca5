"""A stored table in key buckets, of which an upsert reads and rewrites only those it touches.

The bucket of a row is the hash of its keys by the number of buckets; it is the partition column of the
folder. Keys and number are written next to the data (``_layout``), so every later run deals rows alike.
An upsert of few rows into a table of any size costs what the touched buckets hold.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postlens.operators.joins import upsert
from postlens.session import materialise
from postlens.sources.writers import write_partitioned

BUCKET = "key_bucket"


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(key) for key in keys]), F.lit(buckets)).cast("int")


def create_keyed(df: DataFrame, path: str, keys: Sequence[str], buckets: int = 256) -> None:
    """Store a table of rows with unique keys. Choose the buckets so that one is a few tasks' work."""
    if not keys or buckets < 1:
        raise ValueError("a keyed table needs a key and a bucket")
    if BUCKET in df.columns:
        raise ValueError(f"the column {BUCKET} is the table's own")
    layout = df.sparkSession.createDataFrame([(list(keys), buckets)], "keys array<string>, buckets int")
    layout.coalesce(1).write.mode("overwrite").parquet(f"{path}/_layout")
    write_partitioned(df.withColumn(BUCKET, bucket_of(keys, buckets)), path, by=[BUCKET])


def layout_of(spark: SparkSession, path: str) -> tuple[list[str], int]:
    row = spark.read.parquet(f"{path}/_layout").first()
    return list(row["keys"]), row["buckets"]


def read_keyed(spark: SparkSession, path: str, buckets: Sequence[int] | None = None) -> DataFrame:
    """The table, or what some of its buckets hold: the others' files are not opened."""
    rows = spark.read.parquet(path)
    if buckets is not None:
        rows = rows.filter(F.col(BUCKET).isin(list(buckets)))
    return rows.drop(BUCKET)


def read_key(spark: SparkSession, path: str, *values: object) -> DataFrame:
    """The row of one key, from the files of its bucket."""
    keys, buckets = layout_of(spark, path)
    rows = spark.read.parquet(path)
    wanted = spark.range(1).select(*[F.lit(value).cast(rows.schema[key].dataType).alias(key) for key, value in zip(keys, values, strict=True)])
    bucket = wanted.select(bucket_of(keys, buckets)).first()[0]
    rows = rows.filter(F.col(BUCKET) == bucket)
    for key, value in zip(keys, values, strict=True):
        rows = rows.filter(F.col(key).eqNullSafe(F.lit(value).cast(rows.schema[key].dataType)))
    return rows.drop(BUCKET)


def upsert_keyed(path: str, updates: DataFrame, order: Sequence[str] = ()) -> list[int]:
    """Replace and add rows by key; returns the buckets that were rewritten.

    Of updates with one key the last by ``order`` counts. The driver learns the touched buckets, at most as
    many as there are; they become a partition filter, so the other buckets are neither read nor
    written. What they are to hold is first written to the shared folder: it never depends on files that
    are being replaced, and a run that was cut off while it replaced them can be repeated.
    """
    spark = updates.sparkSession
    keys, buckets = layout_of(spark, path)
    base = spark.read.parquet(path)
    kinds = {field.name: field.dataType for field in base.schema if field.name != BUCKET}
    own = [F.col(name).cast(kind).alias(name) for name, kind in kinds.items()]
    updates = updates.select(*own, *[name for name in order if name not in kinds])
    updates = materialise(updates.withColumn(BUCKET, bucket_of(keys, buckets)), "keyed-updates")
    touched = sorted(row[0] for row in updates.select(BUCKET).distinct().collect())
    if not touched:
        return []
    merged = upsert(base.filter(F.col(BUCKET).isin(touched)), updates, keys, order)
    write_partitioned(materialise(merged, "keyed-merged"), path, by=[BUCKET])
    spark.catalog.refreshByPath(path)
    return touched
