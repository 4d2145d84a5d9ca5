"""Casts, labels, dates and ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters a scrambled id may end with.
ALPHANUMERIC = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"


def label_to_int(label: Column) -> Column:
    """1 for ``yes`` in any case, 0 for every other answer and for null."""
    return F.when(F.lower(F.trim(label)) == "yes", 1).otherwise(0)


def yes_no(answer: Column) -> Column:
    """A labeler's answer limited to yes, no or null."""
    tidy = F.lower(F.trim(answer))
    return F.when(tidy.isin("yes", "no"), tidy)


def to_number(text: Column, kind: str = "double") -> Column:
    """Text to a number, null where it is none. Integers may be written as ``3.0``."""
    number = text.try_cast("double")
    number = F.when(~F.isnan(number), number)
    return number if kind == "double" else number.try_cast(kind)


def to_local(timestamp: Column, hours: int = 8) -> Column:
    return timestamp + F.make_interval(hours=F.lit(hours))


def hour_label(timestamp: Column) -> Column:
    """Hours as ``08PM``."""
    return F.date_format(timestamp, "hha")


def day_key(timestamp: Column) -> Column:
    return F.date_format(timestamp, "yyyy-MM-dd")


def parse_time(text: Column, pattern: str = "d/M/yy H:mm") -> Column:
    """Parse by a given format; null where the text does not fit it."""
    return F.try_to_timestamp(text, F.lit(pattern))


def hash_fraction(key: Column, buckets: int, seed: int | str = "") -> Column:
    """A bucket number from the key alone, the same for every partitioning."""
    return F.conv(F.substring(F.md5(seeded(key, seed)), 1, 8), 16, 10).cast("long") % buckets


def seeded(key: Column, seed: int | str = "") -> Column:
    text = key.cast("string")
    return text if seed == "" else F.concat(F.lit(f"{seed}:"), text)


def random_label(key: Column, share_percent: int = 20, seed: int | str = "") -> Column:
    """A repeatable 0/1 label that is 1 for about the given share of keys."""
    return (hash_fraction(key, 100, seed) < share_percent).cast("int")


def scramble_id(identifier: Column, seed: int | str = "") -> Column:
    """Drop each fifth character and append an alphanumeric one picked by hash."""
    place = hash_fraction(identifier, len(ALPHANUMERIC), seed)
    return F.concat(
        F.regexp_replace(identifier, "(?s)(.{4}).", "$1"),
        F.substr(F.lit(ALPHANUMERIC), (place + 1).cast("int"), F.lit(1)),
    )


def author_or_none_text(author: Column) -> Column:
    """A missing author as the text ``None``, as ingest stores it."""
    return F.coalesce(author, F.lit("None"))
