"""Toxicity by non-negative positive-unlabelled learning.

There are confirmed toxic texts and texts about which nothing is said. With the share of toxic texts
(the class prior) known, the risk of a classifier is

    prior * loss(toxic as toxic) + max(0, loss(unlabelled as clean) - prior * loss(toxic as clean))

The second part estimates the risk on clean texts; it cannot be negative, so where the estimate falls
below zero the step goes the other way instead of fitting the unlabelled texts further. The classifier
is logistic over the words of a text (found or not), in numpy.

It is fitted on samples of bounded size: ``MAX_TOXIC`` confirmed toxic texts and ``MAX_UNLABELLED``
others (expected; twice that is a hard limit), taken by a hash of the id. The prior is the share of
toxic texts among the labelled rows. All texts are scored whole.

Defined results: a null or empty text gets the score of a text without known words; a label row
repeated or contradicted counts as toxic if any says so; without toxic examples every score is 0.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postlens.llm.common import held_out, map_texts

MAX_TOXIC, MAX_UNLABELLED = 1000, 3000
#: A word may tell if it is in so many toxic texts, and in so many times more of them than of others, and
#: if the likelihood ratio of its counts is so high that chance does not explain it.
MAX_WORDS, LEAST_TEXTS, LEAST_LIFT, LEAST_RATIO = 300, 4, 2.5, 8.0
ROUNDS, RATE, DECAY = 500, 0.1, 1e-4
THRESHOLD = 0.3
SEED = 11

find_words = re.compile(rb"[a-z\x80-\xff]+").findall


def words_of(text: bytes | None) -> set[bytes]:
    return set(find_words((text or b"").lower()))


@dataclass(frozen=True)
class Classifier:
    weights: dict[bytes, float]
    bias: float

    def score(self, text: bytes | None) -> float:
        weights = self.weights
        margin = self.bias + sum(weights[word] for word in words_of(text) if word in weights)
        return float(1 / (1 + np.exp(-margin)))


def telling_words(toxic: list[set], others: list[set]) -> list[bytes]:
    """The words that are more frequent in toxic texts than in the others beyond chance, by likelihood
    ratio; ties go by the word."""
    inside, outside = Counter(), Counter()
    for words in toxic:
        inside.update(words)
    for words in others:
        outside.update(words)
    n, m = len(toxic), len(others)
    found = [word for word, count in inside.items() if count >= LEAST_TEXTS and count * m >= LEAST_LIFT * outside[word] * n]
    if not found:
        return []
    a = np.array([inside[word] for word in found], float)
    b = np.array([outside[word] for word in found], float)

    def part(seen: np.ndarray, total: np.ndarray | float, share: np.ndarray) -> np.ndarray:
        share = np.clip(share, 1e-9, 1 - 1e-9)
        return seen * np.log(share) + (total - seen) * np.log(1 - share)

    ratio = part(a, n, a / n) + part(b, m, b / max(m, 1)) - part(a + b, n + m, (a + b) / (n + m))
    order = sorted(np.flatnonzero(ratio >= LEAST_RATIO), key=lambda i: (-ratio[i], found[i]))
    return [found[i] for i in order[:MAX_WORDS]]


def presence(texts: list[set], place: dict[bytes, int]) -> np.ndarray:
    rows = np.zeros((len(texts), len(place)), np.float32)
    for row, words in enumerate(texts):
        for word in words & place.keys():
            rows[row, place[word]] = 1
    return rows


def sigmoid(margins: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(margins, -30, 30)))


def fit(toxic: list[set], unlabelled: list[set], prior: float) -> Classifier:
    """Minimises the non-negative risk by Adam steps over all rows."""
    if not toxic:
        return Classifier({}, -np.inf)
    words = telling_words(toxic, unlabelled)
    place = {word: i for i, word in enumerate(words)}
    p, u = presence(toxic, place), presence(unlabelled, place)
    theta = np.zeros(len(words) + 1, np.float32)
    theta[-1] = np.log(prior / (1 - prior))
    p, u = (np.hstack([rows, np.ones((len(rows), 1), np.float32)]) for rows in (p, u))
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, ROUNDS + 1):
        on_p, on_u = p @ theta, u @ theta
        # Slopes of the mean logistic losses, as toxic (up) and as clean (down).
        p_up = p.T @ (sigmoid(on_p) - 1) / len(p)
        p_down = p.T @ sigmoid(on_p) / len(p)
        u_down = u.T @ sigmoid(on_u) / max(1, len(u))
        clean_risk = np.logaddexp(0, on_u).sum() / max(1, len(u)) - prior * np.logaddexp(0, on_p).mean()
        slope = u_down - prior * p_down
        slope = prior * p_up + slope if clean_risk >= 0 else -slope
        slope[:-1] += DECAY * theta[:-1]
        first, second = 0.9 * first + 0.1 * slope, 0.999 * second + 0.001 * slope**2
        move = (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
        theta = (theta - RATE * move).astype(np.float32)
    return Classifier(dict(zip(words, theta[:-1].tolist(), strict=True)), float(theta[-1]))


def draw(column: str = "doc_id"):
    return F.pmod(F.xxhash64(F.lit(SEED), F.col(column).cast("string")), F.lit(1 << 20)) / float(1 << 20)


def word_sets(docs: DataFrame, most: int) -> list[set]:
    """The different word sets of a bounded frame, in a fixed order. Copies count once."""

    def work(texts: list) -> list[pa.Array]:
        return [pa.array([sorted(words_of(text)) for text in texts], pa.list_(pa.binary()))]

    schema = T.StructType([T.StructField("words", T.ArrayType(T.BinaryType()))])
    found = map_texts(docs, "doc_id", "text", schema, work).select("words").limit(most).toArrow()
    # Every word is held once, however many texts have it.
    held: dict[bytes, bytes] = {}
    sets = set()
    for batch in found.to_batches(max_chunksize=64):
        sets.update(tuple(held.setdefault(word, word) for word in words) for words in batch.column(0).to_pylist())
    return [set(words) for words in sorted(sets)]


def learn(
    docs: DataFrame, labels: DataFrame, max_toxic: int = MAX_TOXIC, max_unlabelled: int = MAX_UNLABELLED
) -> Classifier:
    """Fits on rows that are not held out; ``labels`` has ``doc_id`` and ``toxic``."""
    docs = docs.filter(~held_out()).select("doc_id", "text")
    told = labels.filter(~held_out() & F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
    told = told.groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    rows, toxic_rows = told.agg(F.count(F.lit(1)), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    if not toxic_rows:
        return fit([], [], 0.5)
    prior = min(max(toxic_rows / rows, 1e-3), 1 - 1e-3)
    wanted = told.filter((F.col("toxic") == 1) & (draw() < max_toxic / toxic_rows)).select("doc_id")
    # At most twice the sample of ids is sent: a bound that no input exceeds.
    toxic = docs.join(F.broadcast(wanted.limit(2 * max_toxic)), "doc_id", "left_semi")
    share = max_unlabelled / max(1, docs.count())
    others = docs.filter(draw() < share)
    return fit(word_sets(toxic, 2 * max_toxic), word_sets(others, 2 * max_unlabelled), prior)


def score_texts(docs: DataFrame, classifier: Classifier, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, score)`` for every whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(classifier)

    def work(texts: list) -> list[pa.Array]:
        known = shared.value
        return [pa.array([known.score(one) for one in texts], pa.float64())]

    return map_texts(docs, key, text, T.StructType([T.StructField("score", T.DoubleType())]), work)


def detect(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` for every row of ``docs``."""
    docs = docs.select("doc_id", "text")
    found = score_texts(docs, learn(docs, labels))
    return found.select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )
