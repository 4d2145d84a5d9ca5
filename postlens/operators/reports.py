"""Dashboard and exploration counts over scored posts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlens.operators.cleaning import flagged
from postlens.operators.joins import top_k_per_group, top_k_with_ties
from postlens.session import materialise


def counts_by(df: DataFrame, *keys: str | Column, name: str = "n") -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias(name))


def class_balance(df: DataFrame, label: str = "label") -> DataFrame:
    return counts_by(df, label)


def flagged_authors(df: DataFrame) -> DataFrame:
    """Flagged comments per author, most first."""
    return counts_by(flagged(df), "author").orderBy(F.desc("n"), "author")


def distinct_count(column: str, count_null: bool = False) -> Column:
    """Distinct values; null counts as one more only on request."""
    count = F.count_distinct(column)
    return count + F.max(F.col(column).isNull().cast("int")) if count_null else count


def dashboard_totals(df: DataFrame, count_null: bool = False, approximate: bool = False) -> DataFrame:
    """Distinct subreddits, submissions and comments, and the latest local day.

    The distinct values of all columns are found in one scan and one shuffle of ``(column, value)``;
    ``approximate`` counts by sketches instead and shuffles next to nothing.
    """
    names = {"n_subreddits": "sub_reddit", "n_submissions": "submission_id", "n_comments": "comment_id"}
    if approximate:
        nulls = [F.max(F.col(column).isNull().cast("int")) if count_null else F.lit(0) for column in names.values()]
        counts = [F.approx_count_distinct(column) + null for column, null in zip(names.values(), nulls)]
        return df.agg(*[count.alias(name) for name, count in zip(names, counts)], F.max("date_local").alias("latest_day"))
    values = df.select(*[F.col(column).cast("string").alias(name) for name, column in names.items()],
                       F.col("date_local").cast("string").alias("latest_day"))
    found = values.unpivot([], values.columns, "name", "value").distinct()

    def count(name: str) -> Column:
        known = F.col("value").isNotNull() | F.lit(count_null)
        return F.count_if((F.col("name") == name) & known).alias(name)

    latest = F.max(F.when(F.col("name") == "latest_day", F.col("value")))
    return found.agg(*[count(name) for name in names], latest.cast("date").alias("latest_day"))


def daily_by_sub(df: DataFrame) -> DataFrame:
    return counts_by(df, "date_local", "sub_reddit", name="no_comment")


def daily_flagged_by_sub(df: DataFrame) -> DataFrame:
    return daily_by_sub(flagged(df))


def author_by_prediction(df: DataFrame) -> DataFrame:
    return counts_by(df, "author", "prediction", name="no_comment")


def top_authors_by_prediction(df: DataFrame, k: int = 10) -> DataFrame:
    """Counts per prediction of the k authors with most flagged comments, ties included."""
    counts = materialise(author_by_prediction(df), "author-counts")
    top = top_k_with_ties(flagged(counts), "no_comment", k)
    return counts.join(top.select("author"), "author", "left_semi")


def top_authors_per_sub(df: DataFrame, k: int = 5) -> DataFrame:
    """The k authors with most flagged comments of each subreddit, with their first and last day."""
    per_author = flagged(df).groupBy("sub_reddit", "author").agg(
        F.count("*").alias("no_comment"),
        F.min("date_local").alias("first_day"),
        F.max("date_local").alias("last_day"),
    )
    return top_k_per_group(per_author, ["sub_reddit"], [F.desc("no_comment"), F.asc("author")], k)


def newest_per_sub(submissions: DataFrame, n: int, created: str = "timestamp", key: str = "submission_id") -> DataFrame:
    return top_k_per_group(submissions, ["sub_reddit"], [F.desc(created), F.asc(key)], n)


def authors_of_sub(df: DataFrame, sub_reddit: str) -> DataFrame:
    return df.filter(F.col("sub_reddit") == sub_reddit)


def author_comments(
    df: DataFrame, author: object, first_day: str | None = None, last_day: str | None = None, only_flagged: bool = False
) -> DataFrame:
    """Comments of one author, optionally in a range of local days."""
    rows = df.filter(F.col("author") == F.lit(author))
    if first_day is not None:
        rows = rows.filter(F.col("date_local") >= F.lit(first_day).cast("date"))
    if last_day is not None:
        rows = rows.filter(F.col("date_local") <= F.lit(last_day).cast("date"))
    return flagged(rows) if only_flagged else rows


def author_span(df: DataFrame, author: object) -> DataFrame:
    return author_comments(df, author).agg(F.min("date_local").alias("first_day"), F.max("date_local").alias("last_day"))


def hour_histogram(df: DataFrame, hour: str = "hour_local") -> DataFrame:
    """Comments per hour, with 0 for hours without any."""
    hours = df.sparkSession.range(24).select(F.col("id").cast("int").alias("hour"))
    counts = counts_by(df, F.col(hour).alias("hour"))
    return hours.join(counts, "hour", "left").select("hour", F.coalesce("n", F.lit(0)).alias("n")).orderBy("hour")


def unique_authors_per_day(df: DataFrame) -> DataFrame:
    return df.groupBy("date_local").agg(F.count_distinct("author").alias("n_authors"))


def first_rows(df: DataFrame, n: int, order: Sequence[str | Column]) -> DataFrame:
    """A preview of n rows in a stated order."""
    return df.orderBy(*order).limit(n)
