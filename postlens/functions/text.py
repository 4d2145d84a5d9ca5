"""Text cleaning, tokens and n-grams."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns. (?U) takes Unicode spaces as spaces, so a no-break space ends a URL; the
# four separators x1c to x1f are spaces too, as in Python.
SPACE = r"\s\x1c-\x1f"
URL = rf"(?U)http[^{SPACE}]+"
URL_OR_NEWLINE = rf"{URL}|\n"
PUNCTUATION = rf"(?U)[^\p{{L}}\p{{N}}_{SPACE}]"
SPACES = rf"(?U)[{SPACE}]+"
NON_WORD = r"\W+"
NON_WORD_UNICODE = r"(?U)\W+"
# Runs of word characters and hyphens holding a letter. Possessive parts and the look-behind keep a
# long run of digits linear: no start inside a run is tried and nothing is given back.
LETTER_TOKEN = r"(?U)(?<![\w-])[\w\-&&[^\p{L}]]*+\p{L}[\w-]*+"


def strip_urls(text: Column) -> Column:
    return F.regexp_replace(text, URL, "")


def clean_text(text: Column) -> Column:
    """Remove URLs and newlines, then lower-case."""
    return F.lower(F.regexp_replace(text, URL_OR_NEWLINE, ""))


def strip_punctuation(text: Column) -> Column:
    return F.regexp_replace(text, PUNCTUATION, "")


def letter_tokens(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(LETTER_TOKEN), F.lit(0))


def nonword_tokens(text: Column, unicode: bool = False) -> Column:
    """Lower-case tokens between non-word characters: ASCII words, or Unicode words on request."""
    parts = F.split(F.lower(text), NON_WORD_UNICODE if unicode else NON_WORD)
    return F.filter(parts, lambda token: token != "")


def space_tokens(text: Column) -> Column:
    return F.filter(F.split(text, SPACES), lambda token: token != "")


def is_any(token: Column, words: Iterable[str]) -> Column:
    words = list(words)
    return token.isin(words) if words else F.lit(False)


def drop_stopwords(tokens: Column, words: Iterable[str], lowered: bool = False) -> Column:
    """Drop tokens found in a word list, whatever their case; repeated other tokens stay. Tokens that are
    lower-case already need not be lowered again."""
    listed = sorted({word.lower() for word in words})
    return F.filter(tokens, lambda token: ~is_any(token if lowered else F.lower(token), listed))


def without_stopwords(text: Column, words: Iterable[str]) -> Column:
    """Drop stop words from a text and join what is left by single spaces."""
    exact = sorted(set(words))
    return F.array_join(F.filter(space_tokens(text), lambda token: ~is_any(token, exact)), " ")


def ngrams(tokens: Column, n: int = 2, sep: str = " ", stopwords: Iterable[str] = ()) -> Column:
    """Joined runs of n tokens; a run holding a stop word is left out, short arrays give none."""
    if n < 1:
        raise ValueError("n must be at least 1")
    words = sorted(set(stopwords))

    def gram(start: Column) -> Column:
        parts = [F.get(tokens, start + offset) for offset in range(n)]
        joined = F.concat_ws(sep, *parts)
        if not words:
            return joined
        return F.when(~reduce(Column.__or__, [is_any(part, words) for part in parts]), joined)

    # sequence() counts downwards when its end lies below its start, hence the guard.
    starts = F.when(F.size(tokens) >= n, F.sequence(F.lit(0), F.size(tokens) - n))
    grams = F.transform(starts, gram)
    return F.coalesce(F.array_compact(grams), F.array().cast("array<string>"))


def prepare(text: Column, steps: Iterable[Callable[[Column], Column]]) -> Column:
    """Run a text through column functions in order."""
    return reduce(lambda column, step: step(column), steps, text)


def report_tokens(text: Column, stopwords: Iterable[str]) -> Column:
    """The usual chain of the word reports: lower-case, letter tokens, no stop words."""
    return prepare(text, [F.lower, letter_tokens, lambda tokens: drop_stopwords(tokens, stopwords, True)])
