"""Quality rules on repetition, by suffix arrays.

The words of a document are sorted by their suffixes (prefix doubling in numpy, many documents at a
time). Neighbours in that order give the longest common prefixes; the longest of the two at a place is
the longest substring that starts there and occurs again. Places whose repeat is no longer than the
rest of the repeat before them lie inside it; the others start the maximal repeats. The spans of the
repeats of ``min_words`` words or more are united; a document is rejected if they cover too great a
part of it, or if one of them alone is too long.

Defined results: a null text has no words and fails the base rules, as every text of under
``BASE_WORDS`` words does; repeated rows are judged one by one; nothing else than the text is read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postlens.llm.common import map_texts, packed, unpacked

#: Fixed values of the base rules.
BASE_WORDS = 50
BASE_REPEAT_PERCENT = 50
WINDOW = 3
SPACES = b" \t\n\v\f\r"
SYMBOLS = b"#*$%&|<>"

#: Words whose suffixes are sorted together.
GROUP_WORDS = 1 << 18


@dataclass(frozen=True)
class Limits:
    """A repeat counts from ``min_words`` words; rejected is a document of which over ``max_covered`` of
    the words lie in repeats, or in which one repeat has over ``max_repeat`` of the words. Words in long
    repeats are in repeated windows too, so only limits well below that of the base rule add to it."""

    min_words: int = 10
    max_covered: float = 0.2
    max_repeat: float = 0.15


def word_numbers(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """A number for every word of all documents, equal only for equal words of the same document, and
    the place at which each document starts (and the end)."""
    starts = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(words) for words in texts], out=starts[1:])
    numbers = np.empty(starts[-1], np.int64)
    used = 0
    for place, words in zip(starts, texts, strict=False):
        own = {word: number for number, word in enumerate(dict.fromkeys(words), used)}
        numbers[place : place + len(words)] = list(map(own.__getitem__, words))
        used += len(own)
    return numbers, starts


def suffix_ranks(symbols: np.ndarray) -> list[np.ndarray]:
    """Ranks of all places by their next 1, 2, 4, ... symbols; equal ranks only where these are equal.

    The last level has no equal ranks. Each level sorts only the places still tied, so a level costs what
    is repeated at its length. Symbols past the end count as least.
    """
    total = len(symbols)
    order = np.argsort(symbols, kind="stable")
    ordered = symbols[order]
    first = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]]) if total else np.zeros(0, np.int64)
    sizes = np.diff(np.r_[first, total])
    rank = np.empty(total, np.int64)
    rank[order] = np.repeat(first, sizes)
    levels, tied, step = [rank], order[np.repeat(sizes > 1, sizes)], 1
    while len(tied):
        after = tied + step
        second = np.where(after < total, rank[np.minimum(after, total - 1)] + 1, 0)
        both = rank[tied] * (total + 1) + second
        inner = np.argsort(both, kind="stable")
        tied, both = tied[inner], both[inner]
        head = rank[tied]
        new_group = np.r_[True, head[1:] != head[:-1]]
        new_key = np.r_[True, both[1:] != both[:-1]]
        at = np.arange(len(tied))
        group_at = np.maximum.accumulate(np.where(new_group, at, 0))
        key_at = np.maximum.accumulate(np.where(new_key, at, 0))
        rank = rank.copy()
        rank[tied] = head + key_at - group_at
        levels.append(rank)
        sizes = np.diff(np.r_[np.flatnonzero(new_key), len(tied)])
        tied, step = tied[np.repeat(sizes > 1, sizes)], step * 2
    return levels


def longest_repeats(symbols: np.ndarray) -> np.ndarray:
    """For every place, the length of the longest run from there that occurs at another place too."""
    total = len(symbols)
    longest = np.zeros(total, np.int64)
    levels = suffix_ranks(symbols)
    if len(levels) < 2:
        return longest
    order = np.empty(total, np.int64)
    order[levels[-1]] = np.arange(total)
    left, right = order[:-1], order[1:]
    equal = levels[0][left] == levels[0][right]
    left, right = left[equal], right[equal]
    common = np.zeros(len(left), np.int64)
    for power in range(len(levels) - 1, -1, -1):
        a, b = left + common, right + common
        inside = np.maximum(a, b) < total
        same = inside & (levels[power][np.where(inside, a, 0)] == levels[power][np.where(inside, b, 0)])
        common[same] += 1 << power
    np.maximum.at(longest, left, common)
    np.maximum.at(longest, right, common)
    return longest


def covered(longest: np.ndarray, starts: np.ndarray, least: int) -> np.ndarray:
    """How many words of each document lie in repeats of ``least`` words or more."""
    marks = np.zeros(len(longest) + 1, np.int64)
    places = np.flatnonzero(longest >= least)
    np.add.at(marks, places, 1)
    np.add.at(marks, places + longest[places], -1)
    inside = np.r_[0, np.cumsum(np.cumsum(marks[:-1]) > 0)]
    return inside[starts[1:]] - inside[starts[:-1]]


def repeated_windows(longest: np.ndarray, starts: np.ndarray, width: int) -> np.ndarray:
    """How many words of each document lie in a run of ``width`` words that is found twice or more."""
    return covered(np.where(longest >= width, width, 0), starts, width)


def maximal_repeats(words: list[bytes], least: int) -> list[tuple[int, int]]:
    """``(start, end)`` in words of the repeats that are part of no longer repeat from the word before."""
    numbers, _ = word_numbers([words])
    longest = longest_repeats(numbers)
    before = np.r_[0, longest[:-1]]
    places = np.flatnonzero((longest >= least) & (longest >= before))
    return [(int(at), int(at + longest[at])) for at in places]


def measure(texts: list[list[bytes]], limits: Limits) -> np.ndarray:
    """Repeated window words, covered words and the longest repeat of each document, as columns."""
    numbers, starts = word_numbers(texts)
    longest = longest_repeats(numbers)
    most = np.zeros(len(texts), np.int64)
    full = np.flatnonzero(np.diff(starts))
    if len(full):
        most[full] = np.maximum.reduceat(longest, starts[full])
    repeated = repeated_windows(longest, starts, WINDOW)
    return np.stack([repeated, covered(longest, starts, limits.min_words), most], axis=1)


def in_groups(texts: list[list[bytes]]) -> list[list[list[bytes]]]:
    groups, size = [[]], 0
    for words in texts:
        if size and size + len(words) > GROUP_WORDS:
            groups, size = [*groups, []], 0
        groups[-1].append(words)
        size += len(words)
    return groups


MEASURES = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("word_chars", T.LongType()),
        T.StructField("n_symbols", T.LongType()),
        T.StructField("n_dup_lines", T.LongType()),
        T.StructField("n_repeat_words", T.LongType()),
        T.StructField("covered_words", T.LongType()),
        T.StructField("longest_repeat", T.LongType()),
    ]
)


def plain_counts(text: bytes) -> tuple[int, int, int]:
    """Code points in words, symbols, and lines that repeat an earlier line."""
    in_words = text.translate(None, SPACES)
    code_points = len(in_words.decode("utf-8", "replace"))
    lines = [line for line in text.split(b"\n") if line.strip()]
    return code_points, len(text) - len(text.translate(None, SYMBOLS)), len(lines) - len(set(lines))


def repetition(docs: DataFrame, limits: Limits = Limits(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """The measures of every whole text, with ``base_failed`` and ``kept``."""

    def work(texts: list) -> list[pa.Array]:
        words = [(one or b"").split() for one in texts]
        plain = np.array([plain_counts(one or b"") for one in texts], np.int64).reshape(-1, 3)
        found = np.concatenate([measure(group, limits) for group in in_groups(words)])
        counts = np.array([len(one) for one in words], np.int64)
        return [pa.array(column) for column in (counts, *plain.T, *found.T)]

    words = F.col("n_words")
    base_failed = (words < BASE_WORDS) | (100 * F.col("n_repeat_words") > BASE_REPEAT_PERCENT * words)
    repeats = (F.col("covered_words") > limits.max_covered * words) | (
        (F.col("longest_repeat") >= limits.min_words) & (F.col("longest_repeat") > limits.max_repeat * words)
    )
    return (
        map_texts(docs, key, text, MEASURES, work)
        .withColumn("base_failed", base_failed)
        .withColumn("kept", ~F.col("base_failed") & ~repeats)
    )


def keep_good(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with their columns. The verdict is reached in the task
    that holds the row, so nothing is shuffled or joined."""
    rows = packed(docs)
    schema = rows.schema

    def run(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                texts = part.column(0).field("text").cast(pa.binary()).to_pylist()
                words = [(one or b"").split() for one in texts]
                found = np.concatenate([measure(group, limits) for group in in_groups(words)])
                counts = np.array([len(one) for one in words], np.int64)
                failed = (counts < BASE_WORDS) | (100 * found[:, 0] > BASE_REPEAT_PERCENT * counts)
                long = (found[:, 2] >= limits.min_words) & (found[:, 2] > limits.max_repeat * counts)
                yield part.filter(pa.array(~(failed | (found[:, 1] > limits.max_covered * counts) | long)))

    return unpacked(rows.mapInArrow(run, schema), docs)
