"""Joins, unions, top-k per group and upserts."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postlens.session import materialise


def top_k_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int) -> DataFrame:
    """The first k rows of each group in a total order.

    First k rows of each group within each input partition, then k of what is left: however large a
    group is, no task sorts more of it than one partition holds, or k rows of each partition. For
    small k Spark keeps these rows before the first shuffle.
    """

    def first_k(rows: DataFrame, by: Sequence[Column | str]) -> DataFrame:
        place = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
        return rows.withColumn("_place", place).filter(F.col("_place") <= k).drop("_place")

    parted = df.withColumn("_salt", F.spark_partition_id())
    return first_k(first_k(parted, [*keys, "_salt"]).drop("_salt"), keys)


def top_k_with_ties(counts: DataFrame, count: str, k: int) -> DataFrame:
    """Rows whose count is at least the k-th largest, so ties at the edge all stay.

    The edge comes from a distributed top-k as a single number; there is no window over all rows.
    """
    edge = counts.select(count).orderBy(F.desc(count)).limit(k).agg(F.min(count))
    return counts.filter(F.col(count) >= edge.scalar())


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row of each key in ascending order of the given columns.

    A hash of the whole row breaks ties, so the same row wins on every run without sorting by texts.
    """
    tie = F.xxhash64(*df.columns)
    return top_k_per_group(df, keys, [*[F.desc(name) for name in order], tie.desc()], 1)


def upsert(base: DataFrame, updates: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """Replace rows of the base that share a key with an update, and add the others.

    Keys must be declared. A base built by upserts holds each key once, so it needs no sorting: it is
    only filtered by the update keys, and when these are few Spark broadcasts them and does not
    shuffle the base at all.
    """
    if not keys:
        raise ValueError("upsert needs at least one key")
    newest = latest_per_key(updates.select(*base.columns, *[o for o in order if o not in base.columns]), keys, order)
    # Written once, as both halves of the result read it.
    newest = materialise(newest.select(*base.columns), "upsert-newest")
    replaced = newest.select(*[F.col(key).alias(f"_new_{key}") for key in keys])
    same_key = reduce(Column.__and__, [F.col(key).eqNullSafe(F.col(f"_new_{key}")) for key in keys])
    return base.join(replaced, same_key, "left_anti").unionByName(newest)


def union_all(*frames: DataFrame) -> DataFrame:
    """All rows of all frames, columns by name, missing ones null; duplicates stay."""
    return reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), frames)


def union_labelled(labelled: DataFrame, simulated: DataFrame, label: str = "yes") -> DataFrame:
    """Labelled posts plus simulated ones, which get a constant label; ``origin`` tells them apart."""
    return union_all(
        labelled.withColumn("origin", F.lit("labelled")),
        simulated.withColumn("label", F.lit(label)).withColumn("origin", F.lit("simulated")),
    )


def comments_with_submission(comments: DataFrame, submissions: DataFrame, key: str = "submission_id") -> DataFrame:
    """Each comment with the fields of its submission.

    A small submission side is broadcast by Spark's size check; otherwise it is a sort-merge join in
    which AQE splits a submission that holds very many comments.
    """
    return comments.join(submissions, key, "inner")


def comments_with_hot_submissions(
    comments: DataFrame,
    submissions: DataFrame,
    key: str = "submission_id",
    comment_key: str = "comment_id",
    hot_share: float = 0.01,
    spread: int = 64,
) -> DataFrame:
    """The same join for tables whose hottest submissions hold a large share of all comments.

    A frequent-items sketch of the key column names every key above ``hot_share`` of the comments (and a few
    others, which does no harm): at most ``1 / hot_share`` keys. Comments of these are dealt to ``spread`` parts
    by their own key, and the few submission rows are copied to each part; all others are in part 0. So there is
    one join, and no task holds more of a hot key than a part, with or without AQE. It reads the key column once
    more than the plain join, which stays the better one where no key is hot.
    """
    frequent = comments.filter(F.col(key).isNotNull()).stat.freqItems([key], hot_share)

    def is_hot(side: DataFrame) -> Column:
        keys = frequent.select(F.col(frequent.columns[0])).scalar()
        return F.coalesce(F.array_contains(keys, side[key]), F.lit(False))

    part = F.when(is_hot(comments), F.pmod(F.xxhash64(comment_key), F.lit(spread))).otherwise(F.lit(0)).cast("int")
    parts = F.when(is_hot(submissions), F.sequence(F.lit(0), F.lit(spread - 1))).otherwise(F.array(F.lit(0)))
    dealt, copied = comments.withColumn("_deal", part), submissions.withColumn("_deal", F.explode(parts))
    return dealt.join(copied, [key, "_deal"], "inner").drop("_deal")


def predictions_to_rows(rows: DataFrame, predictions: DataFrame, key: str = "comment_id") -> DataFrame:
    return rows.join(predictions.select(key, "prediction"), key, "inner")


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """The sorted list behind a drop-down, without null."""
    return df.select(column).dropna().distinct().orderBy(column)
