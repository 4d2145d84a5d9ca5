"""Runs of tokens counted within a batch of rows, on numbers instead of texts.

Tokens of a batch become numbers, a run of n tokens one number, and one sort of (run, row) gives how often
each run occurs and in how many rows. Only what is counted is spelled out.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Tokens counted in one go, or one row's, if it has more. Below 2^21, so that (run, row) fits 63 bits.
PIECE = 1 << 20
#: Runs given back in one batch.
RUNS = 1 << 17


def pieces(batch: pa.RecordBatch, most: int) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """Whole rows of at most ``most`` tokens, one row at least: their lists, and which rows are counted."""
    lists, counted = batch.column(0), batch.column(1).to_numpy(zero_copy_only=False)
    ends = lists.offsets.to_numpy()
    start = 0
    while start < len(lists):
        end = max(start + 1, int(np.searchsorted(ends, ends[start] + most, "right")) - 1)
        yield lists.slice(start, end - start), counted[start:end]
        start = end


def run_counts(
    lists: pa.Array, counted: np.ndarray, sizes: Iterable[int], sep: str, stopwords: list[str]
) -> Iterator[pa.RecordBatch]:
    """``(token, n, freq, df)`` of the runs of each size in which no token is null or a stop word."""
    lengths = np.diff(lists.offsets.to_numpy())
    encoded = lists.flatten().dictionary_encode()
    words, ids = encoded.dictionary, encoded.indices.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
    if not len(words):
        return
    counted, lengths = counted[lengths > 0].astype(np.int64), lengths[lengths > 0]
    row = np.repeat(np.arange(len(lengths)), lengths)
    stops = pc.is_in(words, value_set=pa.array(stopwords, words.type)).to_numpy(zero_copy_only=False)
    plain = (ids >= 0) & ~stops[ids]
    ranked: dict[int, np.ndarray] = {}

    def spelled(n: int, runs: np.ndarray) -> pa.Array:
        if n == 1:
            return words.take(pa.array(runs))
        head, last = np.divmod(runs, len(words))
        return pc.binary_join_element_wise(spelled(n - 1, ranked[n - 1][head] if n > 2 else head), words.take(pa.array(last)), sep)

    run, kept = ids, plain
    for n in range(1, max(sizes) + 1):
        if n > 1:
            if n > 2:
                ranked[n - 1], run = np.unique(run, return_inverse=True)
            run = run[:-1] * len(words) + ids[n - 1 :]
            kept = kept[:-1] & plain[n - 1 :] & (row[: 1 - n] == row[n - 1 :])
        if n not in sizes or not kept.any():
            continue
        found = np.sort(run[kept] * len(lengths) + row[: len(run)][kept])
        runs, rows = np.divmod(found, len(lengths))
        starts = np.flatnonzero(np.diff(runs, prepend=-1))
        df = np.add.reduceat((np.diff(found, prepend=-1) != 0).astype(np.int64), starts)
        freq, runs = np.add.reduceat(counted[rows], starts), runs[starts]
        for at in range(0, len(runs), RUNS):
            part = slice(at, at + RUNS)
            size = pa.array(np.full(len(runs[part]), n, np.int32))
            columns = [spelled(n, runs[part]), size, pa.array(freq[part]), pa.array(df[part])]
            yield pa.RecordBatch.from_arrays(columns, names=["token", "n", "freq", "df"])


def run_counter(
    sizes: Iterable[int], sep: str, stopwords: Iterable[str], most: int = PIECE
) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The counts of all pieces of the batches, whose columns are the tokens and whether the row is counted."""
    listed, stop = sorted(set(sizes)), sorted(set(stopwords))

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lists, counted in pieces(batch, most):
                yield from run_counts(lists, counted, listed, sep, stop)

    return count
