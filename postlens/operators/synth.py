"""Harmless synthetic posts to balance classes or to try out scoring."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postlens import schemas
from postlens.functions.values import hash_fraction, seeded
from postlens.operators.joins import union_all

OPENINGS = ["Lovely morning at", "Had a good meal near", "Long queue today at", "Went for a walk around"]
PLACES = ["the river park", "the old market", "the central library", "the train station", "the hawker centre"]
ENDINGS = ["and would go again.", "but it rained.", "with friends.", "after work."]
SUBREDDITS = ["food", "travel", "weather"]


def _pick(words: list[str], key: Column, seed: int | str) -> Column:
    place = hash_fraction(key, len(words), seed)
    return F.element_at(F.array(*[F.lit(word) for word in words]), (place + 1).cast("int"))


def synth_rows(numbers: DataFrame, seed: int | str = 1, number: str = "id", day: str = "2024-03-01") -> DataFrame:
    """One post of the working schema per number; all values follow from the number and the seed."""
    key = F.col(number)
    digest = F.md5(seeded(key, seed))
    start = F.lit(f"{day} 00:00:00").cast("timestamp")
    timestamp = start + F.make_interval(secs=hash_fraction(key, 86_400, f"{seed}time"))
    body = F.concat_ws(" ", *[_pick(w, key, f"{seed}{i}") for i, w in enumerate((OPENINGS, PLACES, ENDINGS))])
    return numbers.select(
        F.substring(digest, 1, 10).alias("submission_id"),
        F.substring(digest, 11, 22).alias("comment_id"),
        timestamp.alias("timestamp"),
        F.concat(F.lit("user"), hash_fraction(key, 1_000, f"{seed}author").cast("string")).alias("author"),
        body.alias("body"),
        F.lit("Everyday notes").alias("submission"),
        _pick(SUBREDDITS, key, f"{seed}sub").alias("sub_reddit"),
        (hash_fraction(key, 1_000, f"{seed}votes") + 1).cast("int").alias("upvotes"),
        (F.lit(0.1) + hash_fraction(key, 900, f"{seed}ratio") / 1_000).alias("upvote_ratio"),
        F.to_date(timestamp).alias("date"),
    )


def synth_posts(spark: SparkSession, n: int, seed: int | str = 1) -> DataFrame:
    return synth_rows(spark.range(n), seed)


def class_deficit(df: DataFrame, label: str) -> int:
    """How many rows of class 1 are missing to match class 0."""
    row = df.agg(F.count_if(F.col(label) == 0).alias("zeros"), F.count_if(F.col(label) == 1).alias("ones")).first()
    return max(row["zeros"] - row["ones"], 0)


def inject_rows(posts: DataFrame, simulated: DataFrame) -> DataFrame:
    """Simulated posts next to real ones in the scoring input, which has no subreddit column."""
    columns = schemas.POSTS_FOR_INFERENCE.fieldNames()
    return union_all(posts.select(*[c for c in columns if c in posts.columns]), simulated.select(*columns))
