"""Row cleaning: reshaping, coercion, null handling and validity filters."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlens.functions.text import clean_text
from postlens.functions.values import day_key, label_to_int, to_local, to_number

# Raw column names and the working names they get.
RAW_TO_POSTS = {
    "sub_id": "submission_id",
    "id": "comment_id",
    "created_utc": "timestamp",
    "author": "author",
    "body": "body",
    "sub_title": "submission",
    "sr": "sub_reddit",
    "sub_score": "upvotes",
    "sub_upvote_ratio": "upvote_ratio",
    "dt": "date",
}


def rename_columns(df: DataFrame, names: Mapping[str, str] = RAW_TO_POSTS) -> DataFrame:
    return df.select(*[F.col(old).alias(new) for old, new in names.items()])


def clean_posts(df: DataFrame, columns: Mapping[str, str] | None = None) -> DataFrame:
    """Add cleaned copies of text columns, by default of the body and the submission title."""
    columns = columns or {"body": "body_cleaned", "submission": "submission_cleaned"}
    return df.withColumns({new: clean_text(F.col(old)) for old, new in columns.items()})


def raw_to_clean(raw: DataFrame, first_day: str, last_day: str) -> DataFrame:
    """Raw comments of a range of days as cleaned posts; the range prunes partitions."""
    return clean_posts(rename_columns(between_days(raw, "dt", first_day, last_day)))


def between_days(df: DataFrame, column: str, first_day: str, last_day: str) -> DataFrame:
    """Rows whose day lies in a range, both ends included."""
    return df.filter(F.col(column).between(F.lit(first_day).cast("date"), F.lit(last_day).cast("date")))


def ingest_window(df: DataFrame, column: str, as_of: str, days: int = 5) -> DataFrame:
    """The rolling window of ingest: from ``days`` days before the given day up to the day before it."""
    today = F.lit(as_of).cast("date")
    return df.filter(F.col(column).between(F.date_sub(today, days), F.date_sub(today, 1)))


def binary_labels(df: DataFrame, column: str = "label") -> DataFrame:
    """Labels as integers, ``1.0`` too; rows with a null anywhere or a label other than 0 and 1 are dropped."""
    number = to_number(F.col(column))
    return df.withColumn(column, F.when(number.isin(0.0, 1.0), number.cast("int"))).dropna()


def reviewed_labels(df: DataFrame, column: str = "ground_truth_label") -> DataFrame:
    return df.withColumn(f"{column}_int", label_to_int(F.col(column)))


def coerce_numbers(df: DataFrame, kinds: Mapping[str, str]) -> DataFrame:
    """Text columns to numbers; rows where one is not a number are dropped."""
    return df.withColumns({name: to_number(F.col(name), kind) for name, kind in kinds.items()}).dropna(subset=list(kinds))


def coerce_dates(df: DataFrame, kinds: Mapping[str, str]) -> DataFrame:
    """Text columns to ``date`` or ``timestamp``; text that is neither becomes null."""
    return df.withColumns({name: F.col(name).try_cast(kind) for name, kind in kinds.items()})


def parsed_and_rejected(df: DataFrame, parsed: Mapping[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Rows whose values all parse, and the untouched rows of which one does not."""
    failed = F.lit(False)
    for value in parsed.values():
        failed = failed | value.isNull()
    return df.filter(~failed).withColumns(dict(parsed)), df.filter(failed)


def row_sanity(
    df: DataFrame,
    year: str = "2024",
    id_length: int = 7,
    timestamp: str = "timestamp",
    comment_id: str = "comment_id",
    date: str = "date",
) -> DataFrame:
    """Rows whose timestamp text starts with the year, with an id and a date of the right length."""
    as_text = {name: F.col(name).cast("string") for name in (timestamp, comment_id, date)}
    return df.filter(
        as_text[timestamp].startswith(year)
        & (F.char_length(as_text[comment_id]) == id_length)
        & (F.char_length(as_text[date]) == 10)
    )


def with_local_time(df: DataFrame, timestamp: str = "timestamp", hours: int = 8) -> DataFrame:
    """Add the local time, and its day and hour."""
    local = to_local(F.col(timestamp), hours)
    return df.withColumns(
        {"timestamp_local": local, "date_local": F.to_date(local), "hour_local": F.hour(local)}
    )


def dashboard_rows(scored: DataFrame, year: str = "2024") -> DataFrame:
    """Scored posts as the dashboard reads them."""
    rows = with_local_time(row_sanity(scored.filter(F.col("prediction").isNotNull()), year))
    rows = rows.withColumn("timestamp_local", F.date_format("timestamp_local", "yyyy-MM-dd HH:mm:ss"))
    return rows.drop("timestamp", "body", "submission", "date")


def move_column(df: DataFrame, column: str, position: int) -> DataFrame:
    """Put a column at a place counted from 0."""
    others = [name for name in df.columns if name != column]
    return df.select(*others[:position], column, *others[position:])


def flagged(df: DataFrame, columns: Sequence[str] = (), prediction: str = "prediction") -> DataFrame:
    rows = df.filter(F.col(prediction) == 1)
    return rows.select(*columns) if columns else rows


def with_day_key(df: DataFrame, timestamp: str = "timestamp", name: str = "day") -> DataFrame:
    return df.withColumn(name, day_key(F.col(timestamp)))
