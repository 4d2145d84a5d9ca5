"""Language identification by error-correcting output codes.

Every language has a codeword of bits; a binary n-gram classifier predicts each bit. A text gets the
language whose codeword is nearest by loss: every bit's logistic loss counts by how well that bit's
classifier did on the language in training. Where the second nearest is about as near, the text is
flagged as ambiguous.

The classifiers are fitted with numpy on a sample of at most ``SAMPLE_PER_LANGUAGE`` texts of each
language (expected; twice that in all is a hard limit), taken by a hash of the id. Everything else sees
all texts, whole.

Defined results: a text that is null or has no letter is ``und`` with score 0; with no language to
learn from, all are; with one language, every other text is that, with score 1; rows without a language
are not learned from; more than ``MAX_LANGUAGES`` languages are refused.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postlens.llm.common import held_out, map_texts

SAMPLE_PER_LANGUAGE = 300
MAX_LANGUAGES = 500
PAIR_BITS, TRIPLE_BITS = 10, 12
FEATURES = (1 << PAIR_BITS) + (1 << TRIPLE_BITS)
EXHAUSTIVE_UP_TO = 7
ROUNDS, RATE, DECAY = 120, 0.3, 1e-4
AMBIGUOUS_BELOW = 0.2
UNKNOWN = "und"
SEED = 5

#: Everything below the letters of ASCII, and what stands between and after them, reads as a space.
LETTERS = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256))


def ngram_vector(text: bytes) -> np.ndarray:
    """Hashed pairs and triples of bytes, as square roots of their shares; length 1, or 0 if empty."""
    data = np.frombuffer(b" " + text.lower().translate(LETTERS) + b" ", np.uint8).astype(np.uint32)
    spread = np.uint32(2654435761)
    pairs = data[:-1] * np.uint32(257) + data[1:]
    triples = pairs[:-1] * np.uint32(257) + data[2:]
    counts = np.zeros(FEATURES, np.float32)
    counts[: 1 << PAIR_BITS] = np.bincount(pairs * spread >> np.uint32(32 - PAIR_BITS), minlength=1 << PAIR_BITS)
    counts[1 << PAIR_BITS :] = np.bincount(
        triples * spread >> np.uint32(32 - TRIPLE_BITS), minlength=1 << TRIPLE_BITS
    )
    total = counts.sum()
    return np.sqrt(counts / total) if total else counts


def codewords(languages: int) -> np.ndarray:
    """A row of -1 and 1 for each language. Few languages get every way to part them in two; many get
    seeded random codes of 15 log2(n) bits, the best of some by least distance between rows."""
    if languages <= EXHAUSTIVE_UP_TO:
        bits = max(1, 2 ** (languages - 1) - 1)
        columns = [[1 if (number >> row) & 1 else -1 for row in range(languages)] for number in range(1, bits + 1)]
        return np.array(columns, np.float32).T
    width = math.ceil(15 * math.log2(languages))
    random = np.random.default_rng(SEED)
    best, gap = None, -1
    for _ in range(50):
        code = random.choice(np.array([-1, 1], np.float32), (languages, width))
        near = code @ code.T - 2 * width * np.eye(languages, dtype=np.float32)
        least = (width - near.max()) / 2
        if least > gap and not (np.abs(code.sum(axis=0)) == languages).any():
            best, gap = code, least
    return best


@dataclass(frozen=True)
class Coder:
    languages: list[str]
    code: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    trust: np.ndarray

    def losses(self, vectors: np.ndarray) -> np.ndarray:
        """Weighted loss of each text against each language."""
        margins = vectors @ self.weights + self.bias
        loss = np.logaddexp(0, -margins[:, None, :] * self.code[None])
        return (loss * self.trust[None]).sum(axis=2) * self.code.shape[1]

    def decode(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Nearest language, its share of belief, and whether the second is about as near."""
        losses = self.losses(vectors)
        belief = np.exp(losses.min(axis=1, keepdims=True) - losses)
        belief /= belief.sum(axis=1, keepdims=True)
        nearest = losses.argmin(axis=1)
        order = np.sort(belief, axis=1)
        second = order[:, -2] if belief.shape[1] > 1 else np.zeros(len(belief))
        return nearest, belief.max(axis=1), order[:, -1] - second < AMBIGUOUS_BELOW


def fit_bits(vectors: np.ndarray, targets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One logistic classifier per column of ``targets`` (-1 and 1), by accelerated gradient steps."""
    rows, bits = targets.shape
    weights, bias = np.zeros((vectors.shape[1], bits), np.float32), np.zeros(bits, np.float32)
    speed, lift = np.zeros_like(weights), np.zeros_like(bias)
    # Vectors of length 1 spread over many features; steps are longer by the share that varies, up to 20 times.
    scale = np.float32(1 / max(0.05, vectors.var(axis=0).sum()))
    for _ in range(ROUNDS):
        margins = vectors @ (weights + 0.9 * speed) + bias
        pull = -targets / (1 + np.exp(np.clip(targets * margins, -30, 30))) / rows
        speed = 0.9 * speed - RATE * scale * (vectors.T @ pull + DECAY * weights)
        lift = 0.9 * lift - RATE * pull.sum(axis=0)
        weights, bias = weights + speed, bias + lift
    return weights, bias


def fit(languages: list[str], named: list[str], vectors: np.ndarray) -> Coder:
    code = codewords(len(languages))
    place = {language: row for row, language in enumerate(languages)}
    rows = np.array([place[name] for name in named])
    targets = code[rows]
    weights, bias = fit_bits(vectors, targets)
    right = ((vectors @ weights + bias) * targets > 0).astype(np.float32)
    trust = np.stack([right[rows == row].mean(axis=0) for row in range(len(languages))])
    trust = np.maximum(trust, 1e-3)
    return Coder(languages, code, weights, bias, trust / trust.sum(axis=1, keepdims=True))


def training_sample(docs: DataFrame, per_language: int) -> tuple[list[str], list[str], np.ndarray]:
    """Languages, and names and vectors of the sample. The vectors are made where the texts are."""
    known = docs.filter(~held_out() & F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = known.groupBy("lang").count().limit(MAX_LANGUAGES + 1).collect()
    if len(counts) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    languages = sorted(str(row["lang"]) for row in counts)
    if not languages:
        return [], [], np.zeros((0, FEATURES), np.float32)
    share = {str(row["lang"]): min(1.0, per_language / row["count"]) for row in counts}
    shares = F.create_map(*[F.lit(value) for pair in share.items() for value in pair])
    draw = F.pmod(F.xxhash64(F.lit(SEED), F.col("doc_id").cast("string")), F.lit(1 << 20)) / float(1 << 20)
    chosen = known.filter(draw < shares[F.col("lang").cast("string")])

    def work(texts: list) -> list[pa.Array]:
        return [pa.array([ngram_vector(text).tobytes() for text in texts], pa.binary())]

    vectors = map_texts(
        chosen.select(F.col("lang").cast("string").alias("lang"), "text"),
        "lang",
        "text",
        T.StructType([T.StructField("vector", T.BinaryType())]),
        work,
    )
    rows = vectors.limit(2 * per_language * len(languages)).collect()
    rows.sort(key=lambda row: (row["lang"], bytes(row["vector"])))
    named = [row["lang"] for row in rows]
    data = np.frombuffer(b"".join(bytes(row["vector"]) for row in rows), np.float32).reshape(len(rows), FEATURES)
    return sorted(set(named)), named, data


PREDICTED = T.StructType(
    [
        T.StructField("lang_pred", T.StringType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("ambiguous", T.BooleanType()),
    ]
)


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def predict(docs: DataFrame, coder: Coder | None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, lang_pred, score, ambiguous)`` for every whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(coder)

    def work(texts: list) -> list[pa.Array]:
        known = shared.value
        names, scores, doubts = [UNKNOWN] * len(texts), [0.0] * len(texts), [False] * len(texts)
        spoken = [i for i, one in enumerate(texts) if one and has_letter(one.decode("utf-8", "replace"))]
        if known is not None:
            for at in range(0, len(spoken), 64):
                part = spoken[at : at + 64]
                vectors = np.stack([ngram_vector(texts[i]) for i in part])
                for i, best, score, doubt in zip(part, *known.decode(vectors), strict=True):
                    names[i], scores[i], doubts[i] = known.languages[best], float(score), bool(doubt)
        return [pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(doubts, pa.bool_())]

    return map_texts(docs, key, text, PREDICTED, work)


def identify(docs: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE) -> DataFrame:
    """Learns from the rows that are not held out and predicts all."""
    narrow = docs.select("doc_id", "text", "lang")
    languages, named, vectors = training_sample(narrow, per_language)
    coder = fit(languages, named, vectors) if languages else None
    found = predict(narrow, coder)
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "ambiguous")
