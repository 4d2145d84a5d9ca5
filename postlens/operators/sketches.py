"""Counts and quantiles of any range of days from small stored sketches.

Each day keeps, for each group, its number of rows, a HyperLogLog sketch of the different values of a column
and a quantile sketch of a number. Sketches merge: a range of days is answered from its days' sketches and
no row is read again. A day that is pulled again replaces its folder. The exact reports stay as they are;
these are beside them, for dashboards that ask again and again.

Errors: the relative standard error of a distinct count is 1.04 / sqrt(2^lg), 1.6 % at the default; a quantile's
rank is within ``RANK_ERROR`` of the wanted one with 99 % confidence at the default size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlens.sources.writers import write_partitioned

LG, QUANTILE_SIZE = 12, 200
RELATIVE_ERROR = 1.04 / 2 ** (LG / 2)
#: Fixed value: the published normalised rank error of a quantile sketch of that size.
RANK_ERROR = 0.0133


def day_sketches(df: DataFrame, day: str, counted: str, number: str | None = None, keys: Sequence[str] = ()) -> DataFrame:
    """``(day, *keys, n_rows, distinct_sketch[, quantile_sketch])``. Map tasks make sketches of their rows, so the
    shuffle carries sketches and no values, and a hot day or group is one sketch a task."""
    sketches = [F.count(F.lit(1)).alias("n_rows"), F.hll_sketch_agg(counted, LG).alias("distinct_sketch")]
    if number is not None:
        sketches.append(F.kll_sketch_agg_double(F.col(number).cast("double"), QUANTILE_SIZE).alias("quantile_sketch"))
    return df.groupBy(F.col(day).alias("day"), *keys).agg(*sketches)


def store_sketches(sketches: DataFrame, path: str) -> None:
    """One folder a day; days that are there already are replaced."""
    write_partitioned(sketches, path, by=["day"])


def read_sketches(spark: SparkSession, path: str, first_day: str | None = None, last_day: str | None = None) -> DataFrame:
    """The sketches of a range of days; other days' folders are not opened."""
    rows = spark.read.parquet(path)
    if first_day is not None:
        rows = rows.filter(F.col("day") >= F.lit(first_day).cast("date"))
    if last_day is not None:
        rows = rows.filter(F.col("day") <= F.lit(last_day).cast("date"))
    return rows


def merged(sketches: DataFrame, keys: Sequence[str] = (), quantiles: Sequence[float] = ()) -> DataFrame:
    """``(*keys, n_rows, n_distinct[, quantiles])`` of all given sketches; the quantiles as an array."""
    parts = [F.sum("n_rows").alias("n_rows"), F.hll_union_agg("distinct_sketch").alias("_distinct")]
    if quantiles:
        parts.append(F.kll_merge_agg_double("quantile_sketch").alias("_quantiles"))
    found = sketches.groupBy(*keys).agg(*parts)
    shown = [F.coalesce("n_rows", F.lit(0)).alias("n_rows"), F.coalesce(F.hll_sketch_estimate("_distinct"), F.lit(0)).alias("n_distinct")]
    if quantiles:
        ranks = [F.kll_sketch_get_quantile_double("_quantiles", F.lit(float(share))) for share in quantiles]
        shown.append(F.when(F.kll_sketch_get_n_double("_quantiles") > 0, F.array(*ranks)).alias("quantiles"))
    return found.select(*keys, *shown)
