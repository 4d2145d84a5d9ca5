"""Labels from a caller's function, and sentiment from a lexicon."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postlens.functions.values import label_to_int, yes_no
from postlens.session import materialise

Labeler = Callable[[Sequence[str]], Sequence[str]]


#: Texts a labeler is given at once.
ASKED = 512


def _ask(make_labeler: Callable[[], Labeler]) -> Callable[[Column], Column]:
    """Only the texts of one call are Python strings at a time; the rest of a batch stays in Arrow."""

    @F.arrow_udf("string")
    def ask(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        labeler = make_labeler()
        for texts in batches:
            answers = []
            for start in range(0, len(texts), ASKED):
                part = texts.slice(start, ASKED).to_pylist()
                present = [text for text in part if text is not None]
                given = list(labeler(present)) if present else []
                if len(given) != len(present):
                    raise ValueError(f"{len(given)} answers to {len(present)} texts")
                turn = iter(given)
                answers += [None if text is None else next(turn) for text in part]
            yield pa.array(answers, pa.string())

    return ask.asNondeterministic()


def label_with(
    df: DataFrame,
    text: str,
    make_labeler: Callable[[], Labeler],
    name: str = "label",
    columns: Sequence[str] | None = None,
    keep: bool = True,
) -> DataFrame:
    """Label each row yes, no or null by a function that takes a batch of texts.

    ``make_labeler`` runs once per task, where it may open a client. Only the text crosses to Python.
    Answers of a costly labeler must not be asked for twice, so by default the labelled rows are
    written once and read back; ``columns`` names what to keep next to the label.
    """

    labelled = df.withColumn("_answer", _ask(make_labeler)(F.col(text)))
    labelled = labelled.select(*(columns if columns is not None else df.columns), yes_no(F.col("_answer")).alias(name))
    return materialise(labelled, "labels") if keep else labelled


ANSWERS = "digest string, answer string"


def stored_answers(spark: SparkSession, path: str) -> DataFrame:
    """What a labeler has answered so far: ``(digest, answer)``, one row for each different text."""
    # Adding nothing makes an empty store where there is none.
    spark.createDataFrame([], ANSWERS).coalesce(1).write.mode("append").parquet(path)
    return spark.read.schema(ANSWERS).parquet(path).dropDuplicates(["digest"])


def label_with_store(
    df: DataFrame,
    text: str,
    make_labeler: Callable[[], Labeler],
    store: str,
    name: str = "label",
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Label rows as ``label_with`` does, but ask for no text that the store has an answer to, and only once
    for texts that many rows share.

    Texts are told apart by their SHA-256. The digests of the rows, each once, are held against the store; only
    texts whose digests are new move, one row for each, and their answers are added to the store
    as soon as they are all there. Rows then meet their answers by digest; a text that a third of all rows
    share is one row on the store's side. A null text is not asked about and has no label. The store keeps raw
    answers; use another store for another labeler.
    """
    spark = df.sparkSession
    rows = df.withColumn("_digest", F.sha2(F.col(text).cast("binary"), 256))
    known = stored_answers(spark, store)
    fresh = rows.select("_digest").dropna().distinct().join(known, F.col("_digest") == F.col("digest"), "left_anti")
    fresh = materialise(fresh.select(F.col("_digest").alias("digest")), "labels-new")
    # Every row of a digest has the same text; the map tasks keep one each.
    asked = rows.join(fresh, F.col("_digest") == F.col("digest"), "left_semi")
    asked = asked.groupBy("_digest").agg(F.min(text).alias(text)).withColumnRenamed("_digest", "digest")
    answers = asked.select("digest", _ask(make_labeler)(F.col(text)).alias("answer"))
    materialise(answers, "labels-answers").write.mode("append").parquet(store)
    kept = rows.select("_digest", *(columns if columns is not None else df.columns))
    known = stored_answers(spark, store).withColumnRenamed("answer", "_answer")
    labelled = kept.join(known, F.col("_digest") == F.col("digest"), "left")
    return labelled.select(*(columns if columns is not None else df.columns), yes_no(F.col("_answer")).alias(name))


def keyword_labeler(words: Iterable[str]) -> Callable[[], Labeler]:
    """A labeler that answers yes where a text holds one of the words; for tests and dry runs."""
    wanted = [word.lower() for word in words]

    def make() -> Labeler:
        def label(texts: Sequence[str]) -> list[str]:
            return ["Yes" if any(word in text.lower() for word in wanted) else "No" for text in texts]

        return label

    return make


def with_label_int(df: DataFrame, label: str = "label") -> DataFrame:
    return df.withColumn(f"{label}_int", label_to_int(F.col(label)))


def lexicon_sentiment(df: DataFrame, key: str, tokens: Column | str, lexicon: DataFrame) -> DataFrame:
    """Positive, Negative or Neutral by the sign of the mean token score; unknown tokens score 0.

    The lexicon ``(token, score)`` is broadcast if its bytes are under Spark's threshold. Tokens of a row sit in one
    task, so partial sums leave one row per post for the shuffle. A post without tokens is Neutral.
    """
    words = df.select(key, F.explode_outer(tokens).alias("token"))
    scored = words.join(lexicon.select("token", "score"), "token", "left")
    per_post = scored.groupBy(key).agg(
        F.try_divide(F.sum(F.coalesce("score", F.lit(0))), F.count("token")).alias("score")
    )
    mood = F.when(F.col("score") > 0, "Positive").when(F.col("score") < 0, "Negative").otherwise("Neutral")
    return per_post.select(key, F.coalesce("score", F.lit(0.0)).alias("score"), mood.alias("sentiment"))
