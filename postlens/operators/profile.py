"""Column profiles. Every result has a few rows per column, however long the table is."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postlens.session import materialise

QUARTILES = (0.25, 0.5, 0.75)


def present(column: str) -> Column:
    """A value as a number; NaN counts as missing, as null does."""
    value = F.col(column).cast("double")
    return F.when(~F.isnan(value), value)


def _value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """How often each value of each column occurs, ``(column, value, n)``, dealt in parts by range and
    written once. Equal values are one row before they are shuffled, so a value held by a third of all
    rows is one row per task."""
    values = df.select(*[present(name).alias(name) for name in columns]).unpivot([], list(columns), "column", "value")
    counts = values.filter(F.col("value").isNotNull()).groupBy("column", "value").agg(F.count("*").alias("n"))
    dealt = counts.repartitionByRange("column", "value").withColumn("part", F.spark_partition_id())
    return materialise(dealt, "value-counts")


def _quantiles(counts: DataFrame, shares: Sequence[float]) -> DataFrame:
    """Exact interpolated quantiles as rows ``(column, share, quantile)``.

    The running total over a column's parts tells in which part a rank lies; only these parts are
    sorted, each on its own.
    """
    sizes = counts.groupBy("column", "part").agg(F.sum("n").alias("size"))
    whole = Window.partitionBy("column")
    upto = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = sizes.select(
        "column",
        "part",
        (F.sum("size").over(upto) - F.col("size")).alias("before"),
        "size",
        F.sum("size").over(whole).alias("total"),
    )
    wanted = [F.lit(float(share)) for share in shares]
    ranks = placed.withColumn("share", F.explode(F.array(*wanted)))
    ranks = ranks.withColumn("rank", (F.col("total") - 1) * F.col("share"))
    # Interpolation needs the values at the ranks below and above.
    ranks = ranks.withColumn("place", F.explode(F.array(F.floor("rank"), F.ceil("rank"))))
    ranks = ranks.filter((F.col("place") >= F.col("before")) & (F.col("place") < F.col("before") + F.col("size")))
    needed = counts.join(ranks.select("column", "part", "before").distinct(), ["column", "part"])
    within = Window.partitionBy("column", "part").orderBy("value")
    within = within.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ends = needed.withColumn("end", F.col("before") + F.sum("n").over(within))
    ends = ends.select("column", "part", "value", (F.col("end") - F.col("n")).alias("start"), "end")
    found = ends.join(ranks.drop("before", "size"), ["column", "part"]).filter(
        (F.col("place") >= F.col("start")) & (F.col("place") < F.col("end"))
    )
    low = F.min(F.when(F.col("place") == F.floor("rank"), F.col("value")))
    high = F.max(F.when(F.col("place") == F.ceil("rank"), F.col("value")))
    step = F.first(F.col("rank") - F.floor("rank"))
    # Between two equal infinities there is no difference to take a part of.
    between = F.when(low == high, low).otherwise(low + (high - low) * step)
    return found.groupBy("column", "share").agg(between.alias("quantile"))


def exact_quantiles(df: DataFrame, column: str, shares: Sequence[float] = QUARTILES) -> DataFrame:
    """Exact interpolated quantiles of the present values, as rows ``(share, quantile)``."""
    return _quantiles(_value_counts(df, [column]), shares).select("share", "quantile")


def numeric_profiles(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """count, mean, std, min, quartiles and max of several columns, by default of all numeric ones, as
    rows ``(column, statistic, value)``.

    The table is scanned once; everything else comes out of the counts of its values.
    """
    names = list(columns or [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)])
    if not names:
        raise ValueError("no numeric columns")
    counts = _value_counts(df, names)
    total = F.sum("n").cast("double")
    basic = counts.groupBy("column").agg(
        total.alias("count"),
        (F.sum(F.col("value") * F.col("n")) / total).alias("mean"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    # Squares are summed around the mean, which keeps their digits.
    off = counts.join(F.broadcast(basic.select("column", "mean")), "column")
    squares = off.groupBy("column").agg(F.sum(F.col("n") * (F.col("value") - F.col("mean")) ** 2).alias("squares"))
    # Columns without a value are in no count.
    every = df.sparkSession.createDataFrame([(name,) for name in names], "column string")
    wide = every.join(basic, "column", "left").join(squares, "column", "left").select(
        "column",
        F.coalesce("count", F.lit(0.0)).alias("count"),
        "mean",
        F.sqrt(F.try_divide("squares", F.col("count") - 1)).alias("std"),
        "min",
        "max",
    )
    rows = wide.unpivot(["column"], ["count", "mean", "std", "min", "max"], "statistic", "value")
    named = F.concat((F.col("share") * 100).cast("int").cast("string"), F.lit("%"))
    quantiles = _quantiles(counts, QUARTILES)
    return rows.unionByName(quantiles.select("column", named.alias("statistic"), F.col("quantile").alias("value")))


def numeric_profile(df: DataFrame, column: str) -> DataFrame:
    """The profile of one column as rows ``(statistic, value)``."""
    return numeric_profiles(df, [column]).select("statistic", "value")


def null_counts(df: DataFrame) -> DataFrame:
    """Nulls per column in one pass, as rows ``(column, n_null)``."""
    counts = df.agg(*[F.count_if(F.col(name).isNull()).alias(name) for name in df.columns])
    return counts.unpivot([], df.columns, "column", "n_null")


#: Longer values are told apart by a digest, which is no shorter than that.
LONG_VALUE = 64


def _mark(value: Column, kind: T.DataType) -> Column:
    """A short text that equal values of a column share, and no others; null for null."""
    text = comparable(value, kind)
    if isinstance(kind, (T.ArrayType, T.StructType, T.MapType, T.VariantType)):
        return F.when(value.isNotNull(), F.sha2(F.to_json(F.struct(text)), 256))
    if isinstance(kind, (T.StringType, T.BinaryType)):
        # A mark in front keeps a text apart from a digest that reads like it.
        return F.when(F.length(text) > LONG_VALUE, F.concat(F.lit("#"), F.sha2(text, 256))).otherwise(F.concat(F.lit("="), text))
    return text


def distinct_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Distinct values per column, null left out, as rows ``(column, n_distinct)``.

    Each value goes to the shuffle once per task as ``(column, value)``; counting several columns in one
    aggregate would carry every column of every copy of a row. Plain values go as they are, in text; texts and
    binary values over ``LONG_VALUE`` characters, and arrays, structs and maps, go as digests.
    """
    columns = list(columns or df.columns)
    kinds = {f.name: f.dataType for f in df.schema}
    marks = [_mark(F.col(name), kinds[name]).alias(name) for name in columns]
    values = df.select(*marks).unpivot([], columns, "column", "digest").distinct()
    return values.groupBy("column").agg(F.count("digest").alias("n_distinct"))


def table_info(df: DataFrame) -> DataFrame:
    """Type and number of present values of each column, as rows ``(column, type, n_present)``."""
    types = F.create_map(*[F.lit(text) for pair in df.dtypes for text in pair])
    counts = df.agg(*[F.count(name).alias(name) for name in df.columns])
    rows = counts.unpivot([], df.columns, "column", "n_present")
    return rows.select("column", types[F.col("column")].alias("type"), "n_present")


def histogram(df: DataFrame, column: str, width: float) -> DataFrame:
    """Rows per bin of fixed width, by the lower edge of the bin. NaN is missing; each infinity is a bin
    of its own."""
    infinite = F.abs("value") == F.lit(float("inf"))
    edge = F.when(infinite, F.col("value")).otherwise(F.floor(F.when(~infinite, F.col("value")) / F.lit(width)) * F.lit(width))
    values = df.select(present(column).alias("value")).filter(F.col("value").isNotNull())
    return values.groupBy(edge.alias("bin_start")).agg(F.count("*").alias("n"))


def box_statistics(df: DataFrame, column: str, reach: float = 1.5) -> DataFrame:
    """Quartiles, whisker ends and the number of outliers of a box plot, in one row."""
    quartiles = exact_quantiles(df, column).agg(
        *[F.max(F.when(F.col("share") == s, F.col("quantile"))).alias(n) for s, n in zip(QUARTILES, ("q1", "median", "q3"))]
    )
    # One row of three numbers: the only thing the second scan needs.
    q1, median, q3 = quartiles.first()
    if q1 is None:
        return quartiles.select("*", *[F.lit(None).cast("double").alias(n) for n in ("low", "high")], F.lit(0).cast("long").alias("n_outliers"))
    low, high = q1 - reach * (q3 - q1), q3 + reach * (q3 - q1)
    value = present(column)
    inside = value.between(low, high)
    return df.agg(
        F.lit(q1).alias("q1"),
        F.lit(median).alias("median"),
        F.lit(q3).alias("q3"),
        F.min(F.when(inside, value)).alias("low"),
        F.max(F.when(inside, value)).alias("high"),
        F.count_if(~inside).alias("n_outliers"),
    )


def comparable(value: Column, kind: T.DataType) -> Column:
    """A value such that equal values, and no others, have the same JSON: as text with full precision,
    binary in hex, both zeros and all NaNs as one; the same inside arrays, structs and maps."""
    if isinstance(kind, T.BinaryType):
        return F.hex(value)
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return (value + F.lit(0.0).cast(kind)).cast("string")
    if isinstance(kind, T.ArrayType):
        return F.transform(value, lambda item: comparable(item, kind.elementType))
    if isinstance(kind, T.StructType):
        fields = [comparable(value.getField(f.name), f.dataType).alias(f.name) for f in kind.fields]
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(kind, T.MapType):
        pairs = F.map_entries(value)
        entry = lambda pair: F.struct(
            comparable(pair["key"], kind.keyType).alias("key"), comparable(pair["value"], kind.valueType).alias("value")
        )
        return F.array_sort(F.transform(pairs, entry))
    return value.cast("string")


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Rows that repeat an earlier row in all columns: ``(n_rows, n_distinct, n_duplicates)``.

    Rows are compared by a 256-bit digest of all their values, so the shuffle carries 32 bytes per
    distinct row and map tasks collapse a row that comes very often.
    """
    # A null field is left out of the JSON.
    values = [comparable(F.col(f.name), f.dataType).alias(f.name) for f in df.schema]
    digest = F.unhex(F.sha2(F.to_json(F.struct(*values)), 256))
    copies = df.groupBy(digest.alias("digest")).agg(F.count("*").alias("n"))
    return copies.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
        F.count("*").alias("n_distinct"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("n_duplicates"),
    )
