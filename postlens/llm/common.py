"""Helpers that the operators of this package share."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postlens.session import materialise

#: Fixed value: a word is a run of anything but ASCII white space (space, \t \n \v \f \r).
WORD = r"[^\x20\x09-\x0D]+"


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether a row is kept from learning: crc32 of the id as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def map_texts(
    df: DataFrame, key: str, text: str, schema: T.StructType, work: Callable[[list], list[pa.Array]]
) -> DataFrame:
    """Apply ``work`` to whole texts, batch by batch, inside the tasks.

    ``work`` gets the UTF-8 bytes of a batch's texts (None for null) and returns one Arrow array for
    each field of ``schema``; the key column is carried along in front. A batch is one Arrow batch, so
    memory is bounded by the session's Arrow batch settings and the longest text.
    """
    narrow = df.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    out = T.StructType([T.StructField("key", narrow.schema["key"].dataType), *schema.fields])
    arrow_names = ["key", *schema.fieldNames()]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                texts = part.column(1).cast(pa.binary()).to_pylist()
                yield pa.RecordBatch.from_arrays([part.column(0), *work(texts)], names=arrow_names)

    return narrow.mapInArrow(run, out).withColumnRenamed("key", key)


def with_positions(df: DataFrame, order: list[Column], name: str, label: str) -> DataFrame:
    """Number the rows of a narrow frame from 0 in the given order, with no task that sees all rows.

    The rows are dealt by range and written once, so that every later read sees the same parts; a row's
    number is its place in its part plus the sizes of the parts before. One row per part is summed up
    in one task. Rows that are equal in ``order`` are numbered in any order.
    """
    dealt = df.repartitionByRange(*order).select(*df.columns, F.spark_partition_id().alias("__part"))
    dealt = materialise(dealt, label)
    parts = dealt.groupBy("__part").agg(F.count(F.lit(1)).alias("__rows"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select("__part", F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__before"))
    inside = Window.partitionBy("__part").orderBy(*order)
    numbered = dealt.withColumn("__row", F.row_number().over(inside))
    return numbered.join(F.broadcast(offsets), "__part").select(
        *df.columns, (F.col("__before") + F.col("__row") - 1).cast("long").alias(name)
    )


def packed(docs: DataFrame) -> DataFrame:
    """All columns of a frame in one column ``row``, so that no working column can clash with them."""
    return docs.select(F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("row"))


def unpacked(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` again, in their order."""
    return rows.select(*[F.col("row").getField(name).alias(name) for name in docs.columns])


def with_text(rows: DataFrame, docs: DataFrame, text: str) -> DataFrame:
    """The columns of ``docs`` with another text; ``n_chars``, where ``docs`` has it, follows the text."""
    new = {"text": F.col(text)}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.length(text).cast(docs.schema["n_chars"].dataType)
    return rows.select(*[new.get(name, F.col("row").getField(name)).alias(name) for name in docs.columns])
