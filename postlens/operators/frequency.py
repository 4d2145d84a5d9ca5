"""Token and n-gram frequencies, IDF and corpus TF-IDF."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlens.functions.grams import run_counter
from postlens.functions.text import is_any


def without(words: DataFrame, stopwords: Iterable[str]) -> DataFrame:
    """Rows whose token is no stop word: a filter in generated code, before the shuffle."""
    listed = sorted(set(stopwords))
    return words.filter(~is_any(F.col("token"), listed)) if listed else words


def count_tokens(df: DataFrame, tokens: Column | str, min_freq: int = 2, stopwords: Iterable[str] = ()) -> DataFrame:
    """How often each token occurs. Map tasks pre-aggregate, so a hot token is one row per task."""
    words = without(df.select(F.explode(tokens).alias("token")), stopwords)
    return words.groupBy("token").agg(F.count("*").alias("freq")).filter(F.col("freq") >= min_freq)


def gram_rows(df: DataFrame, tokens: str, n: int, sep: str = " ", stopwords: Iterable[str] = ()) -> DataFrame:
    """One row per run of n tokens of which none is a stop word.

    The array is laid next to its own shifted copies and unrolled; dropping runs and joining their
    tokens is then generated code over plain columns. Runs are dropped before the shuffle.
    """
    if n < 1:
        raise ValueError("n must be at least 1")
    words = sorted(set(stopwords))
    names = [f"t{place}" for place in range(n)]
    runs = F.greatest(F.size(tokens) - (n - 1), F.lit(0))
    shifted = F.arrays_zip(*[F.slice(tokens, place + 1, runs).alias(name) for place, name in enumerate(names)])
    rows = df.select(F.inline(shifted).alias(*names))
    for name in names:
        rows = rows.filter(~is_any(F.col(name), words))
    return rows.select(F.concat_ws(sep, *names).alias("token"))


def count_ngrams(
    df: DataFrame, tokens: str, n: int, min_freq: int = 2, sep: str = " ", stopwords: Iterable[str] = ()
) -> DataFrame:
    """How often each run of n tokens occurs."""
    counts = gram_rows(df, tokens, n, sep, stopwords).groupBy("token").agg(F.count("*").alias("freq"))
    return counts.filter(F.col("freq") >= min_freq)


def top_tokens(counts: DataFrame, k: int, by: str = "freq") -> DataFrame:
    return counts.orderBy(F.desc(by), "token").limit(k)


def document_count(df: DataFrame) -> Column:
    """The number of rows as a scalar subquery; on Parquet it is answered from the footers."""
    return df.agg(F.count("*")).scalar()


def compute_idf(df: DataFrame, tokens: Column | str, min_df: int = 2, stopwords: Iterable[str] = ()) -> DataFrame:
    """Document frequency and ``ln(N / df) + 0.1`` of each token found in at least min_df rows."""
    seen = without(df.select(F.explode(F.array_distinct(tokens)).alias("token")), stopwords)
    counts = seen.groupBy("token").agg(F.count("*").alias("df")).filter(F.col("df") >= min_df)
    return counts.withColumn("idf", corpus_idf(document_count(df), F.col("df")))


def corpus_idf(documents: Column, df: Column) -> Column:
    return F.ln(documents / df) + 0.1


def token_statistics(
    df: DataFrame, tokens: Column | str, counted: Column | None = None, stopwords: Iterable[str] = ()
) -> DataFrame:
    """``freq`` over the counted rows and ``df`` over all rows, in one scan and one shuffle.

    Sorting a row's tokens puts equal ones side by side, so the first of each run marks the row once
    for the document frequency.
    """
    counted = F.lit(True) if counted is None else F.coalesce(counted, F.lit(False))
    ordered = df.select(F.sort_array(tokens).alias("tokens"), counted.alias("counted"))
    marked = F.transform(
        F.col("tokens"),
        lambda token, place: F.struct(
            token.alias("token"),
            ((place == 0) | (F.get(F.col("tokens"), place - 1) != token)).alias("first"),
        ),
    )
    words = ordered.select("counted", F.explode(marked).alias("word")).select("counted", "word.token", "word.first")
    return without(words, stopwords).groupBy("token").agg(
        F.count_if(F.col("counted")).alias("freq"), F.count_if(F.col("first")).alias("df")
    )


def gram_statistics(
    df: DataFrame,
    tokens: str,
    sizes: Iterable[int],
    counted: Column | None = None,
    sep: str = " ",
    stopwords: Iterable[str] = (),
) -> DataFrame:
    """``(token, n, freq, df)`` of the runs of n tokens, for each n of ``sizes``: ``freq`` over the counted rows and
    ``df`` over all rows, in one scan and one shuffle. A run that holds a null or a stop word is left out.

    Runs are counted piece by piece inside the scan (``functions/grams.py``), so a hot run is one row per piece.
    Most runs are rare and a map task's table of them would grow with its split while saving few rows, so the
    pieces are shuffled as they are and summed up behind.
    """
    if min(sizes) < 1:
        raise ValueError("n must be at least 1")
    counted = F.lit(True) if counted is None else F.coalesce(counted, F.lit(False))
    lists = F.coalesce(F.col(tokens), F.array().cast("array<string>"))
    pieces = df.select(lists.alias("tokens"), counted.alias("counted")).mapInArrow(
        run_counter(sizes, sep, stopwords), "token string, n int, freq long, df long"
    )
    dealt = pieces.repartition("token", "n")
    return dealt.groupBy("token", "n").agg(F.sum("freq").alias("freq"), F.sum("df").alias("df"))


def corpus_tfidf(
    df: DataFrame,
    tokens: Column | str,
    counted: Column | None = None,
    min_freq: int = 2,
    min_df: int = 2,
    stopwords: Iterable[str] = (),
) -> DataFrame:
    """``freq * idf`` of each token.

    The frequency may be taken over some rows only, the IDF always over all. A token below ``min_df``
    keeps its frequency and has a null IDF, as a left join of the two tables gives.
    """
    return _tfidf(token_statistics(df, tokens, counted, stopwords), document_count(df), min_freq, min_df)


def gram_tfidf(
    df: DataFrame,
    tokens: str,
    n: int,
    counted: Column | None = None,
    min_freq: int = 2,
    min_df: int = 2,
    stopwords: Iterable[str] = (),
) -> DataFrame:
    """``corpus_tfidf`` of the runs of n tokens of which none is a stop word."""
    stats = gram_statistics(df, tokens, [n], counted, stopwords=stopwords)
    return _tfidf(stats, document_count(df), min_freq, min_df)


def _tfidf(stats: DataFrame, documents: Column, min_freq: int, min_df: int) -> DataFrame:
    idf = F.when(F.col("df") >= min_df, corpus_idf(documents, F.col("df")))
    kept = stats.filter(F.col("freq") >= min_freq).select("token", "freq", idf.alias("idf"))
    return kept.withColumn("tfidf", F.col("freq") * F.col("idf"))


def join_tfidf(freq: DataFrame, idf: DataFrame) -> DataFrame:
    """``freq * idf`` from two stored tables, kept to the tokens of ``freq``."""
    return freq.join(idf.select("token", "idf"), "token", "left").withColumn("tfidf", F.col("freq") * F.col("idf"))


def union_idf(tables: dict[int, DataFrame]) -> DataFrame:
    """IDF tables of several n-gram sizes in one, with the size as column ``n``."""
    sized = [table.withColumn("n", F.lit(n)) for n, table in sorted(tables.items())]
    union = sized[0]
    for table in sized[1:]:
        union = union.unionByName(table)
    return union


def sized_idf(df: DataFrame, tokens: str, min_df: dict[int, int], stopwords: Iterable[str] = ()) -> DataFrame:
    """The IDF of several n-gram sizes in one pass over the rows, as ``(token, n, df, idf)``; ``min_df`` maps a
    size to the least document frequency."""
    least = F.lit(None).cast("long")
    for n, rows in min_df.items():
        least = F.when(F.col("n") == n, rows).otherwise(least)
    counts = gram_statistics(df, tokens, min_df, stopwords=stopwords).filter(F.col("df") >= least)
    return counts.select("token", "n", "df", corpus_idf(document_count(df), F.col("df")).alias("idf"))


def spark_ml_idf(df: DataFrame, tokens: Column | str, min_doc_freq: int = 5) -> DataFrame:
    """The IDF Spark ML gives a term: ``ln((N + 1) / (df + 1))``, 0 below the floor."""
    seen = df.select(F.explode(F.array_distinct(tokens)).alias("token"))
    counts = seen.groupBy("token").agg(F.count("*").alias("df"))
    value = F.ln((document_count(df) + 1) / (F.col("df") + 1))
    return counts.withColumn("idf", F.when(F.col("df") >= min_doc_freq, value).otherwise(0.0))
