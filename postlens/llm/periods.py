"""Runs: stretches of a text in which a few words repeat with one period, many times over.

They are found with a dictionary of basic factors. At level k every stretch of 2^k words has a name, equal
for equal stretches of the same document; names of a level come from pairs of names of the level before.
The successor of a place is the next place of the same name, if it is at most twice the length away. Places
that follow one another and whose successors are equally far away, q words, are one step of an arithmetic
progression: all their words repeat q words later. Together they propose the stretch from the first of
them to the end of the last one's successor, with the period q; taking them together is what extends a
proposal to both sides.

A period q is read off at the one level with 2^(k-1) < q <= 2^k; a step longer than the length is left to
the next level. There a successor at q tells that q is the smallest period of the 2^k + q words from its
place (a smaller one would give a nearer successor), and in a run of four periods or more every place that
has 2^k + q words of the run before it has its successor at q. So each run is proposed once and whole.
Places whose name occurs once have no longer repeat either and are left out of the next level.

Memory is bounded by one Arrow batch of texts or the longest text; nothing is shuffled. Defined results: a
null text, and one without a word, has no run and an empty collapsed text; repeated rows are taken one by one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postlens.llm.common import WORD, map_texts
from postlens.llm.repetition import in_groups, word_numbers

#: A run has at least so many words and so many periods. The method needs four periods.
LEAST_WORDS, LEAST_PERIODS = 6, 4

RUN = T.StructType([T.StructField(name, T.LongType()) for name in ("start", "length", "period")])
FOUND = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("runs", T.ArrayType(RUN)),
        T.StructField("collapsed", T.StringType()),
    ]
)


def levels(symbols: np.ndarray, ends: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``(length, places, names)`` for 1, 2, 4, ... words: the places, in order of name and then of place,
    whose stretch occurs again. ``ends`` holds for every place the end of its document."""
    names = np.full(len(symbols), -1, np.int64)
    places, keys, length = np.arange(len(symbols)), symbols, 1
    while len(places):
        order = np.argsort(keys, kind="stable")
        places, keys = places[order], keys[order]
        first = np.r_[True, keys[1:] != keys[:-1]]
        sizes = np.diff(np.r_[np.flatnonzero(first), len(keys)])
        again = np.repeat(sizes > 1, sizes)
        places, number = places[again], np.cumsum(first)[again]
        yield length, places, number
        names[:] = -1
        names[places] = number
        places = np.sort(places)
        places = places[places + 2 * length <= ends[places]]
        second = names[places + length]
        places, second = places[second >= 0], second[second >= 0]
        keys = names[places] * (len(symbols) + 1) + second
        length *= 2


def periodic_stretches(symbols: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """``(start, length, period)`` of every stretch with four or more periods, by start and then period."""
    found = [np.zeros((0, 3), np.int64)]
    for length, places, names in levels(symbols, ends):
        ahead = np.diff(places, append=0)
        followed = np.r_[names[1:] == names[:-1], False] if len(names) else np.zeros(0, bool)
        near = followed & (2 * ahead > length) & (ahead <= length)
        starts, steps = places[near], ahead[near]
        order = np.argsort(starts)
        starts, steps = starts[order], steps[order]
        if not len(starts):
            continue
        new = np.r_[True, (np.diff(starts) != 1) | (np.diff(steps) != 0)]
        last = np.r_[np.flatnonzero(new)[1:] - 1, len(starts) - 1]
        start, step = starts[new], steps[new]
        found.append(np.stack([start, starts[last] + length + step - start, step], axis=1))
    every = np.concatenate(found)
    every = every[every[:, 1] >= LEAST_PERIODS * every[:, 2]]
    return every[np.lexsort((every[:, 2], every[:, 0]))]


def runs_of(texts: list[list[bytes]], least_words: int, least_periods: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The runs of all documents, with places counted over all of them; the places at which documents
    start; and for every word whether it stays when each run is collapsed to its first period."""
    symbols, starts = word_numbers(texts)
    runs = periodic_stretches(symbols, np.repeat(starts[1:], np.diff(starts)))
    runs = runs[(runs[:, 1] >= least_words) & (runs[:, 1] >= least_periods * runs[:, 2])]
    marks = np.zeros(len(symbols) + 1, np.int64)
    np.add.at(marks, runs[:, 0] + runs[:, 2], 1)
    np.add.at(marks, runs[:, 0] + runs[:, 1], -1)
    return runs, starts, np.cumsum(marks[:-1]) == 0


def find_runs(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    least_words: int = LEAST_WORDS,
    least_periods: int = LEAST_PERIODS,
) -> DataFrame:
    """``(key, n_words, runs, collapsed)`` of every whole text: its number of words, its runs by start and
    then period, and its words, joined by spaces, without those that a run repeats."""
    if least_periods < LEAST_PERIODS:
        raise ValueError(f"runs are whole from {LEAST_PERIODS} periods on")

    def work(texts: list) -> list[pa.Array]:
        counts, rows, ends, collapsed = [], [np.zeros((0, 3), np.int64)], [0], []
        for group in in_groups([(one or b"").split() for one in texts]):
            runs, starts, stays = runs_of(group, least_words, least_periods)
            cuts = np.searchsorted(runs[:, 0], starts)
            ends.extend((ends[-1] + cuts[1:]).tolist())
            counts.extend(np.diff(starts).tolist())
            rows.append(runs - np.repeat(starts[:-1], np.diff(cuts))[:, None] * np.array([1, 0, 0]))
            for words, at, cut, following in zip(group, starts, cuts, cuts[1:], strict=False):
                if cut < following:
                    own = stays[at : at + len(words)].tolist()
                    words = [word for word, stay in zip(words, own, strict=True) if stay]
                collapsed.append(b" ".join(words))
        columns = [pa.array(column) for column in np.concatenate(rows).T.copy()]
        structs = pa.StructArray.from_arrays(columns, names=RUN.fieldNames())
        runs = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), structs)
        return [pa.array(counts, pa.int64()), runs, pa.array(collapsed, pa.binary()).cast(pa.string())]

    return map_texts(docs, key, text, FOUND, work)


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """``docs`` with a periodic end in every tenth text, by the crc32 of its id; for testing the operator
    on whole tables. Rows without an id keep their text."""
    mark = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(mark / 10)

    def repeated(words: Column) -> Column:
        n = F.size(words)
        a = (g % n).cast("int")
        p = (F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8))).cast("int")
        source = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.when(i < a, i).otherwise(a + (i - a) % p))
        return F.array_join(F.transform(source, lambda i: F.get(words, i)), " ")

    # The lambda's argument holds the words, so that they are found once a text.
    words = F.array(F.regexp_extract_all(F.col("text"), F.lit(WORD), F.lit(0)))
    planted = F.get(F.transform(words, lambda own: F.when(F.size(own) > 0, repeated(own))), 0)
    return docs.withColumn("text", F.when(mark % 10 == 0, F.coalesce(planted, F.col("text"))).otherwise(F.col("text")))
