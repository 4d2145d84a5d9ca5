"""Personal data: patterns propose spans, checksums confirm them, context words adjust the score.

Everything is built of native expressions. A pattern's matches and the text between them (by splitting
at the same pattern) give every place in code points; one pass adds the lengths up, in blocks, so that
a text with very many matches costs no square of them. The words that may speak for a match are looked
for in the ``BEFORE`` characters before it and the ``AFTER`` behind it, whatever other matches lie there.

The kinds ``email``, ``ip``, ``card`` and ``phone`` are kept whenever their own check holds. The method
adds ``iban`` (mod 97), ``short_card`` (13 to 15 digits by Luhn) and ``local_phone`` (no country code);
the last two need a context word to reach the threshold.

Defined results: a null text counts as empty and has no spans; matches of one kind never overlap,
those of two kinds may; repeated rows are judged one by one.

Patterns use possessive repeats and start where a run of their first characters starts (or where the
match before ended), so that they match the same spans as the plain patterns but need no backtracking
and no recursion on long runs.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlens.llm.common import packed, with_text

THRESHOLD = 0.5
CONTEXT_BONUS = 0.3
BEFORE, AFTER = 40, 20
#: No pattern matches fewer characters, so a window reaches over so many matches at most.
LEAST_HIT = 4
BLOCK = 256


def only_digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """From the right, every second digit counts twice (less 9 above 9); the sum ends in 0."""

    def add(total: Column, i: Column) -> Column:
        digit = F.substr(digits, F.length(digits) - i + 1, F.lit(1)).cast("int")
        twice = F.when(digit > 4, digit * 2 - 9).otherwise(digit * 2)
        return total + F.when(i % 2 == 0, twice).otherwise(digit)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def mod_97(account: Column) -> Column:
    """Four characters go to the end, letters become 10 to 35, and the number leaves 1."""
    plain = F.replace(account, F.lit(" "), F.lit(""))
    turned = F.concat(F.substr(plain, F.lit(5)), F.substr(plain, F.lit(1), F.lit(4)))

    def add(rest: Column, i: Column) -> Column:
        code = F.ascii(F.substr(turned, i, F.lit(1)))
        return F.when(code >= 65, rest * 100 + code - 55).otherwise(rest * 10 + code - 48) % 97

    return F.aggregate(F.sequence(F.lit(1), F.length(turned)), F.lit(0), add) == 1


def digits_between(least: int, most: int) -> Callable[[Column], Column]:
    return lambda hit: F.length(only_digits(hit)).between(least, most)


def luhn_between(least: int, most: int) -> Callable[[Column], Column]:
    return lambda hit: F.when(digits_between(least, most)(hit), luhn(only_digits(hit))).otherwise(False)


PART = "0*(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]?[0-9])"


@dataclass(frozen=True)
class Kind:
    """What a kind of span looks like; a text without ``needs`` is not searched for it."""

    name: str
    pattern: str
    check: Callable[[Column], Column]
    score: float
    context: str
    needs: str | None = None


#: The four base kinds, in the order in which spans are listed.
BASE_KINDS = [
    Kind(
        "email",
        r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        lambda hit: F.lit(True),
        0.7,
        "mail|contact|write|kontakt|correo",
        "@",
    ),
    Kind(
        "ip",
        r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
        lambda hit: hit.rlike(rf"^{PART}(?:\.{PART}){{3}}$"),
        0.5,
        "address|server|host|client|network",
    ),
    Kind(
        "card",
        r"[0-9](?:[\x20-]?[0-9]){15,}+",
        luhn_between(16, 19),
        0.6,
        "card|visa|credit|debit|karte|carte|tarjeta",
    ),
    Kind(
        "phone",
        r"\+[0-9][\x20().0-9-]+[0-9]",
        digits_between(8, 15),
        0.5,
        "phone|tel|call|mobile|fax",
        "+",
    ),
]
ADDED_KINDS = [
    Kind(
        "iban",
        r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}+(?:\x20?[A-Z0-9]{1,3}+)?(?![A-Za-z0-9])",
        mod_97,
        0.6,
        "iban|account|bank|konto|compte|cuenta",
    ),
    Kind(
        "short_card",
        r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){12,14}+(?![0-9])(?![\x20-][0-9])",
        luhn_between(13, 15),
        0.3,
        "card|visa|credit|debit|amex|karte|carte|tarjeta",
    ),
    Kind(
        "local_phone",
        r"(?<![0-9+.(-])(?<![0-9)]\x20)(?:\([0-9]{3}\)\x20?|[0-9]{3}[\x20.-])[0-9]{3}[\x20.-][0-9]{4}(?![0-9]|[.-][0-9])",
        lambda hit: F.lit(True),
        0.3,
        "phone|tel|call|mobile|fax",
    ),
]
KINDS = [*BASE_KINDS, *ADDED_KINDS]


def judged(df: DataFrame, text: str, kind: Kind) -> DataFrame:
    """Adds ``items``: each match of a kind with the text before it and a score, 0 if its check fails;
    and ``tail``, the text after the last."""
    search = F.regexp_extract_all(F.col(text), F.lit(kind.pattern), F.lit(0))
    if kind.needs:
        search = F.when(F.contains(F.col(text), F.lit(kind.needs)), search)
    hits = F.coalesce(search, F.array().cast("array<string>"))
    some = F.size("hits") > 0
    gaps = F.when(some, F.split(F.col(text), kind.pattern, -1)).otherwise(F.array(F.col(text)))

    def gap_at(i: Column, length: int, side: Callable[[Column, Column], Column]) -> Column:
        return side(F.get("gaps", i), F.lit(length))

    # Each match with what is before it, or after it, as far as a window can reach.
    heads = F.transform("hits", lambda hit, i: F.right(F.concat(gap_at(i, BEFORE, F.right), hit), F.lit(BEFORE)))
    tails = F.transform("hits", lambda hit, i: F.left(F.concat(hit, gap_at(i + 1, AFTER, F.left)), F.lit(AFTER)))
    most = BEFORE // LEAST_HIT
    earlier = F.transform(
        "heads", lambda _, i: F.array_join(F.slice("heads", F.greatest(i - most + 1, F.lit(1)), F.least(i, F.lit(most))), "")
    )
    later = F.transform("tails", lambda _, i: F.array_join(F.slice("tails", i + 2, F.lit(AFTER // LEAST_HIT)), ""))

    def item(one: Column, i: Column) -> Column:
        gap, hit = F.get("gaps", i), one["hits"]
        before = F.right(F.concat(one["earlier"], gap_at(i, BEFORE, F.right)), F.lit(BEFORE))
        after = F.left(F.concat(gap_at(i + 1, AFTER, F.left), one["later"]), F.lit(AFTER))
        bonus = F.when(F.lower(F.concat(before, F.lit(" "), after)).rlike(kind.context), F.lit(CONTEXT_BONUS)).otherwise(0.0)
        score = F.when(kind.check(hit), F.lit(kind.score) + bonus).otherwise(0.0)
        return F.struct(gap.alias("gap"), hit.alias("hit"), score.alias("score"))

    return (
        df.withColumn("hits", hits)
        .withColumn("gaps", gaps)
        .withColumns({"heads": heads, "tails": tails})
        .withColumns({"earlier": earlier, "later": later})
        .withColumn("items", F.transform(F.arrays_zip("hits", "earlier", "later"), item))
        .withColumn("tail", F.get("gaps", F.size("hits")))
        .drop("hits", "gaps", "heads", "tails", "earlier", "later")
    )


def placed(items: str) -> Column:
    """``(start, end, score)`` of each item, in code points."""
    kind = "array<struct<start:int,end:int,score:double>>"
    widths = F.transform(
        items, lambda x: F.struct(F.length(x["gap"]).alias("gap"), F.length(x["hit"]).alias("hit"), x["score"].alias("score"))
    )

    def advance(at: Column, x: Column) -> Column:
        return at + x["gap"] + x["hit"]

    def step(state: Column, x: Column) -> Column:
        start, end = state["at"] + x["gap"], advance(state["at"], x)
        one = F.array(F.struct(start.alias("start"), end.alias("end"), x["score"].alias("score")))
        return F.struct(end.alias("at"), F.concat(state["found"], one).alias("found"))

    def inside(block: Column) -> Column:
        first = F.struct(block["at"].alias("at"), F.array().cast(kind).alias("found"))
        return F.aggregate(block["parts"], first, step, lambda state: state["found"])

    def open_block(state: Column, parts: Column) -> Column:
        block = F.array(F.struct(state["at"].alias("at"), parts.alias("parts")))
        return F.struct(
            F.aggregate(parts, state["at"], advance).alias("at"), F.concat(state["blocks"], block).alias("blocks")
        )

    part_kind = "array<struct<at:int,parts:array<struct<gap:int,hit:int,score:double>>>>"
    cut = F.transform(
        F.sequence(F.lit(0), F.floor((F.size(items) - 1) / BLOCK).cast("int")),
        lambda i: F.slice(widths, i * BLOCK + 1, F.lit(BLOCK)),
    )
    blocks = F.aggregate(
        cut,
        F.struct(F.lit(0).alias("at"), F.array().cast(part_kind).alias("blocks")),
        open_block,
        lambda state: state["blocks"],
    )
    found = F.flatten(F.transform(blocks, inside))
    return F.when(F.size(items) > 0, found).otherwise(F.array().cast(kind))


def with_spans(df: DataFrame, text: str, threshold: float = THRESHOLD) -> DataFrame:
    """Adds an array ``spans_<kind>`` of ``(start, end, score)`` for each kind."""
    for kind in KINDS:
        kept = F.filter(F.col("placed"), lambda span: span["score"] >= threshold)
        df = (
            judged(df, text, kind)
            .withColumn("placed", placed("items"))
            .withColumn(f"spans_{kind.name}", kept)
            .drop("items", "tail", "placed")
        )
    return df


def listed(kinds: list[Kind]) -> Column:
    """``kind:start:end`` by kind, then start, joined by commas."""

    def written(kind: Kind) -> Column:
        return F.transform(
            f"spans_{kind.name}", lambda span: F.concat_ws(":", F.lit(kind.name), span["start"], span["end"])
        )

    return F.array_join(F.concat(*[written(kind) for kind in kinds]), ",")


def find_personal_data(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, n_<base kind> ..., base_spans, spans)`` for every whole text."""
    narrow = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("body"))
    found = with_spans(narrow, "body")
    counts = [F.size(f"spans_{kind.name}").cast("long").alias(f"n_{kind.name}") for kind in BASE_KINDS]
    return found.select(
        F.col("key").alias(key), *counts, listed(BASE_KINDS).alias("base_spans"), listed(KINDS).alias("spans")
    )


def united(spans: Column) -> tuple[Column, Column]:
    """What is left of sorted spans ``(start, kind, end)`` when those that overlap are one: an array of
    ``(before, start, kind)``, the end of all spans before, the start, and the kind of the span that starts first;
    and the end of the last."""
    kind = "array<struct<before:int,start:int,kind:int>>"
    part_kind = "array<struct<at:int,parts:array<struct<start:int,kind:int,end:int>>>>"

    def step(state: Column, span: Column) -> Column:
        one = F.array(F.struct(state["at"].alias("before"), span["start"].alias("start"), span["kind"].alias("kind")))
        found = F.when(span["start"] >= state["at"], F.concat(state["found"], one)).otherwise(state["found"])
        return F.struct(F.greatest(state["at"], span["end"]).alias("at"), found.alias("found"))

    def open_block(state: Column, parts: Column) -> Column:
        block = F.array(F.struct(state["at"].alias("at"), parts.alias("parts")))
        at = F.greatest(state["at"], F.array_max(F.transform(parts, lambda span: span["end"])))
        return F.struct(at.alias("at"), F.concat(state["blocks"], block).alias("blocks"))

    def inside(block: Column) -> Column:
        first = F.struct(block["at"].alias("at"), F.array().cast(kind).alias("found"))
        return F.aggregate(block["parts"], first, step, lambda state: state["found"])

    cut = F.transform(
        F.sequence(F.lit(0), F.floor((F.size(spans) - 1) / BLOCK).cast("int")), lambda i: F.slice(spans, i * BLOCK + 1, F.lit(BLOCK))
    )
    start = F.struct(F.lit(0).alias("at"), F.array().cast(part_kind).alias("blocks"))
    blocks = F.aggregate(cut, start, open_block, lambda state: state["blocks"])
    return F.flatten(F.transform(blocks, inside)), F.array_max(F.transform(spans, lambda span: span["end"]))


def part_of(blocks: str, start: Column, end: Column) -> Column:
    """The text from ``start`` to ``end`` (excluded) of one that is cut into pieces of ``BLOCK`` code points."""
    first, last = F.floor(start / BLOCK).cast("int"), F.floor((end - 1) / BLOCK).cast("int")
    within = F.substr(F.get(blocks, first), start % BLOCK + 1, end - start)
    head, tail = F.substr(F.get(blocks, first), start % BLOCK + 1), F.substr(F.get(blocks, last), F.lit(1), end - last * BLOCK)
    middle = F.array_join(F.slice(blocks, first + 2, F.greatest(last - first - 1, F.lit(0))), "")
    return F.when(end <= start, F.lit("")).when(first == last, within).otherwise(F.concat(head, middle, tail))


def redact(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The columns of ``docs`` with every span that ``find_personal_data`` lists replaced by its kind in
    brackets. Spans that overlap become one mark, of the kind that starts first (at one place: that is listed
    first). A mark may part characters that hid a base span from its check, as digits next to a card; such spans
    are replaced then, kind after kind; they need no context, so marks speak for nothing. Null texts stay null."""
    df = packed(docs).withColumn("body", F.coalesce(F.col("row.text").cast("string"), F.lit("")))
    df = with_spans(df, "body", threshold)

    def numbered(number: int) -> Column:
        return F.transform(
            f"spans_{KINDS[number].name}",
            lambda span: F.struct(span["start"].alias("start"), F.lit(number).alias("kind"), span["end"].alias("end")),
        )

    every = map(numbered, range(len(KINDS)))
    df = df.select("row", "body", F.array_sort(F.concat(*every)).alias("spans"))
    some = F.size("spans") > 0
    unions, end = united(F.col("spans"))
    df = df.withColumn("unions", F.when(some, unions)).withColumn("end", F.when(some, end))
    # In pieces, so that a part of a long text is found without reading all that is before it.
    df = df.withColumn("blocks", F.when(some, F.regexp_extract_all("body", F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0))))
    marks = F.array(*[F.lit(f"[{kind.name.upper()}]") for kind in KINDS])
    pieces = F.transform(
        "unions", lambda one: F.concat(part_of("blocks", one["before"], one["start"]), F.get(marks, one["kind"]))
    )
    rest = part_of("blocks", F.col("end"), F.length("body"))
    df = df.withColumn("marked", F.when(some, F.concat(F.array_join(pieces, ""), rest)).otherwise(F.lit("")))
    df = df.select("row", "body", some.alias("some"), "marked")
    for kind in BASE_KINDS:
        mark = F.lit(f"[{kind.name.upper()}]")
        parts = F.transform("items", lambda x: F.concat(x["gap"], F.when(x["score"] > 0, mark).otherwise(x["hit"])))
        changed = F.when(F.size("items") > 0, F.concat(F.array_join(parts, ""), F.col("tail"))).otherwise(F.col("marked"))
        df = judged(df, "marked", kind).withColumn("next", changed).drop("items", "tail", "marked")
        df = df.withColumnRenamed("next", "marked")
    text = F.when(F.col("row.text").isNull(), None).when(F.col("some"), F.col("marked")).otherwise(F.col("body"))
    return with_text(df.withColumn("redacted", text), docs, "redacted")
