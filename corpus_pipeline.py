"""From documents to token ids: quality rules, near-duplicates, personal data, mixing, encoding.

Every stage takes ``(spark, docs, sf_dir)`` and works on all rows that the stage before it kept. All but
the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from postlens.llm import mixing, near_copies, pii, piece_fst, repetition
from postlens.llm.common import read_table
from postlens.session import materialise

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go."""
    return repetition.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, the one with the smallest id."""
    return near_copies.drop_near_copies(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Spans of personal data are replaced by their kind."""
    return pii.redact(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents come as often, and as much of them, as the mix of sources takes."""
    return mixing.apply_mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text."""
    return piece_fst.encode_texts(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality),
    ("SimHash near-dedup", near_duplicates),
    ("PII", personal_data),
    ("mixing sources", mixture),
    ("SentencePiece", encode),
]

#: Suffix arrays, 64-bit hashes and transducers are beyond SQL; the tests hold run() against plain Python.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number + 1 < len(STAGES):
            docs = materialise(docs, f"pipeline-{number}")
    return docs
