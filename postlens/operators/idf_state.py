"""Document frequencies kept by day, and IDF models summed up from them.

Each pull of posts adds one part: how many posts of the day hold each token, and how many posts there are. An
IDF model of any days is a sum of their parts; the posts are not read again. A day that is pulled again
replaces its part.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postlens.functions.text import is_any
from postlens.operators.frequency import corpus_idf
from postlens.sources.writers import write_partitioned


def add_days(df: DataFrame, tokens: Column | str, day: str, path: str, stopwords: Iterable[str] = ()) -> None:
    """Write the parts of the days of ``df``, whole days, each post once.

    Each post brings its number of posts as the null token, so both numbers come of one scan and one
    shuffle, pre-aggregated by the map tasks.
    """
    token = F.explode(F.concat(F.array(F.lit(None).cast("string")), F.filter(F.array_distinct(tokens), lambda t: t.isNotNull())))
    seen = df.select(F.col(day).alias("day"), token.alias("token"))
    listed = sorted(set(stopwords))
    if listed:
        seen = seen.filter(F.col("token").isNull() | ~is_any(F.col("token"), listed))
    counts = seen.groupBy("day", "token").agg(F.count(F.lit(1)).alias("df"))
    write_partitioned(counts, path, by=["day"])


def summed(spark: SparkSession, path: str, last_day: object = None) -> DataFrame:
    """``(token, df, n_posts)`` over the stored days, or those up to one."""
    parts = spark.read.parquet(path)
    if last_day is not None:
        parts = parts.filter(F.col("day") <= F.lit(last_day))
    total = parts.groupBy("token").agg(F.sum("df").alias("df"))
    posts = parts.filter("token IS NULL").agg(F.sum("df").alias("n")).scalar()
    return total.filter("token IS NOT NULL").withColumn("n_posts", posts)


def idf_of_days(spark: SparkSession, path: str, min_df: int = 2, last_day: object = None) -> DataFrame:
    """The IDF that ``compute_idf`` gives over all posts of the stored days: ``(token, df, idf)``."""
    counts = summed(spark, path, last_day).filter(F.col("df") >= min_df)
    return counts.select("token", "df", corpus_idf(F.col("n_posts"), F.col("df")).alias("idf"))


def spark_ml_idf_of_days(spark: SparkSession, path: str, min_doc_freq: int = 5, last_day: object = None) -> DataFrame:
    """The IDF a Spark ML stage fitted on all those posts gives a term: ``(token, df, idf)``."""
    counts = summed(spark, path, last_day)
    value = F.ln((F.col("n_posts") + 1) / (F.col("df") + 1))
    return counts.select("token", "df", F.when(F.col("df") >= min_doc_freq, value).otherwise(0.0).alias("idf"))
