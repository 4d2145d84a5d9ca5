"""Mix sources to target weights by Sainte-Laguë apportionment.

Documents are dealt by a seeded hash to shards of about ``shard_words`` words. In each shard the words
of a source stand one after another in seeded order and are cut into blocks of equal size (to a word).
The shard's blocks are given to its sources by highest quotients votes / (2 * seats + 1); a source's
votes in a shard are its share of the source's target. A quota of q blocks of n is q // n passes over
the whole sequence and q % n blocks from a seeded start, around the end.

A source can have no more than ``max_repeats`` times its size, so a quota has at most that many times
the source's blocks of the shard and no document is taken more often.

No text is needed to decide; nothing but counts by source and shard is grouped, and a shard holds a
bounded number of words whatever a source's size. Sums per shard and source are made before they are
shuffled.

Defined results: a null text has size 0 and is taken 0 times; null is a source of its own, the last; an
empty table, or one without a word, gives targets of 0; rows that repeat an id are documents of their
own, taken apart if they differ.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postlens.llm.common import WORD, packed, with_positions, with_text
from postlens.session import materialise

WEIGHTS = (1.0, 2.0, 3.0)
MAX_REPEATS = 3
BLOCK_WORDS = 32
SHARD_WORDS = 50_000
SHARDS_PER_TASK = 100
SEED = 17


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def highest_quotients(votes: Sequence[float], seats: int, most: Sequence[int]) -> np.ndarray:
    """Sainte-Laguë seats; ties go to the party that comes first, no party gets more than ``most``.

    Starts from the seats that a divisor gives which cannot give too many, and hands out the rest one
    by one, so the work is bounded by the parties and not by the seats.
    """
    votes, most = np.asarray(votes, float), np.asarray(most, np.int64)
    total, parties = votes.sum(), len(votes)
    given = np.zeros(parties, np.int64)
    seats = int(min(seats, most[votes > 0].sum()))
    if total > 0 and seats > parties / 2:
        divisor = total / (seats - parties / 2)
        given = np.minimum(np.floor(votes / divisor + 0.5).astype(np.int64), most)
    queue = [(-votes[i] / (2 * given[i] + 1), i) for i in range(parties) if votes[i] > 0 and given[i] < most[i]]
    heapq.heapify(queue)
    for _ in range(seats - int(given.sum())):
        _, i = heapq.heappop(queue)
        given[i] += 1
        if given[i] < most[i]:
            heapq.heappush(queue, (-votes[i] / (2 * given[i] + 1), i))
    return given


def party(source: Column) -> Column:
    """A source as a key that is never null; the null source has the empty key."""
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit(""))


def source_targets(
    sizes: DataFrame, weights: Sequence[float] = WEIGHTS, max_repeats: int = MAX_REPEATS, budget: float = 1.0
) -> DataFrame:
    """``(party, source_size, target)`` from rows ``(party, size)``.

    Sources in code point order, null last, have the weights in turn. They share ``budget`` times all
    words; a target above ``max_repeats`` times its source's size stops there, and what is over is shared
    by weight until none is above. Each round sums all sources up to three numbers.
    """
    sums = sizes.groupBy("party").agg(F.sum("size").alias("source_size"))
    turns = F.array(*[F.lit(float(weight)) for weight in weights])
    turn = F.get(turns, (F.col("turn") % len(weights)).cast("int"))
    order = [F.col("party") == "", F.col("party")]
    numbered = with_positions(sums, order, "turn", "mix-sources").withColumn("weight", turn)
    numbered = materialise(numbered, "mix-weights")
    total = budget * (numbered.agg(F.sum("source_size")).first()[0] or 0)
    limit = (max_repeats * F.col("source_size")).cast("double")
    rate, stopped = 0.0, -1
    while True:
        above = F.col("weight") * F.lit(rate) > limit
        held, free, count = numbered.agg(
            F.coalesce(F.sum(F.when(above, limit)), F.lit(0.0)),
            F.coalesce(F.sum(F.when(~above, F.col("weight"))), F.lit(0.0)),
            F.count(F.when(above, 1)),
        ).first()
        if count == stopped or not free:
            break
        rate, stopped = (total - held) / free, count
    target = F.least(F.col("weight") * F.lit(rate), limit) if free else limit
    return numbered.select("party", "source_size", target.alias("target"))


QUOTAS = "shard long, party string, words long, blocks long, quota long, source_size long, target double"


def quotas(sums: DataFrame, targets: DataFrame, max_repeats: int, block_words: int, shards: int) -> DataFrame:
    """The quota of each source in each of so many shards, from ``(shard, party, words)``."""

    def share(shard: pd.DataFrame) -> pd.DataFrame:
        shard = shard.assign(last=shard["party"] == "").sort_values(["last", "party"])
        words, size = shard["words"].to_numpy(float), shard["source_size"].to_numpy(float)
        blocks = np.maximum(1, np.rint(words / block_words)).astype(np.int64)
        # A block of a source holds words / blocks words; votes are counted in such blocks.
        votes = np.where(words > 0, shard["target"].to_numpy(float) * blocks / np.maximum(size, 1), 0)
        given = highest_quotients(votes, int(np.rint(votes.sum())), max_repeats * blocks)
        shard = shard.assign(blocks=blocks, quota=given)
        return shard[["shard", "party", "words", "blocks", "quota", "source_size", "target"]]

    # A stated number of parts is not merged by size: a shard is few bytes but much work.
    dealt = sums.join(targets, "party").repartition(max(1, math.ceil(shards / SHARDS_PER_TASK)), "shard")
    return dealt.groupBy("shard").applyInPandas(share, QUOTAS)


def sized(docs: DataFrame) -> DataFrame:
    """Rows packed, with what a mix needs to know of them."""
    text = F.col("row.text").cast("string")
    return packed(docs).select(
        "row",
        F.col("row.doc_id").alias("doc_id"),
        party(F.col("row.source")).alias("party"),
        word_count(text).alias("size"),
        F.xxhash64(text).alias("tie"),
    )


def mix(
    docs: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    max_repeats: int = MAX_REPEATS,
    budget: float = 1.0,
    block_words: int = BLOCK_WORDS,
    shard_words: int = SHARD_WORDS,
    seed: int = SEED,
) -> DataFrame:
    """Rows ``(doc_id, party, size, tie, ...)`` with what the mix takes of each.

    Added are ``source_size``, ``target``, ``passes`` (how often the whole document is taken), the words
    taken in the last pass as ``first_start, first_end`` and ``second_start, second_end`` (that pass may
    run around the end of the sequence) and ``taken``, the words of all passes together.
    """
    # The text takes part, so that rows without an id, or of one id, are in all shards too.
    place = F.xxhash64(F.lit(seed), F.col("doc_id").cast("string"), "tie")
    targets = source_targets(docs.select("party", "size"), weights, max_repeats, budget)
    targets = materialise(targets, "mix-targets")
    total = targets.agg(F.sum("source_size")).first()[0] or 0
    shards = max(1, math.ceil(total / shard_words))
    shard = F.pmod(place, F.lit(shards)).cast("long")
    sums = docs.groupBy(shard.alias("shard"), "party").agg(F.sum("size").alias("words"))
    shares = materialise(quotas(sums, targets, max_repeats, block_words, shards), "mix-quotas")
    order = [F.xxhash64(F.lit(seed + 1), F.col("doc_id").cast("string")), F.col("doc_id"), F.col("size"), F.col("tie")]
    inside = Window.partitionBy("shard", "party").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    placed = docs.withColumn("shard", shard).withColumn("stop", F.sum("size").over(inside))
    placed = placed.join(shares, ["shard", "party"]).withColumn("start", F.col("stop") - F.col("size"))
    words, blocks = F.col("words"), F.col("blocks")
    placed = placed.withColumn("begin", F.pmod(F.xxhash64(F.lit(seed + 2), "shard", "party"), blocks))
    placed = placed.withColumn("low", F.floor(F.col("begin") * words / blocks))
    placed = placed.withColumn("high", F.floor((F.col("begin") + F.col("quota") % blocks) * words / blocks))

    def inside_document(at: Column) -> Column:
        return F.greatest(F.least(at - F.col("start"), F.col("size")), F.lit(0)).cast("long")

    one, two = F.col("first_end") - F.col("first_start"), F.col("second_end") - F.col("second_start")
    return (
        placed.withColumn("passes", F.floor(F.col("quota") / blocks).cast("int"))
        .withColumn("first_start", inside_document(F.col("low")))
        .withColumn("first_end", inside_document(F.least("high", "words")))
        .withColumn("second_start", F.lit(0).cast("long"))
        .withColumn("second_end", inside_document(F.col("high") - words))
        .withColumn("first_end", F.greatest("first_start", "first_end"))
        .withColumn("taken", (F.col("passes") * F.col("size") + one + two).cast("long"))
        .drop("shard", "stop", "start", "words", "blocks", "quota", "begin", "low", "high")
    )


def apply_mix(docs: DataFrame, **options) -> DataFrame:
    """The columns of ``docs``, with each document as often as the mix takes it; of a document taken in
    part in the last pass, the words taken, with the white space before them."""
    found = mix(sized(docs), **options)
    text = F.col("row.text").cast("string")
    pieces = F.regexp_extract_all(text, F.lit(r"[\x20\x09-\x0D]*" + WORD), F.lit(0))

    def part(span: str) -> Column:
        start, size = F.col(span + "_start"), F.col(span + "_end") - F.col(span + "_start")
        cut = F.array_join(F.slice(pieces, (start + 1).cast("int"), size.cast("int")), "")
        return F.when(size >= F.col("size"), text).when(size > 0, cut)

    whole = F.when(F.col("size") > 0, F.array_repeat(text, F.col("passes"))).otherwise(F.array().cast("array<string>"))
    parts = F.filter(F.array(part("first"), part("second")), lambda one: one.isNotNull())
    taken = found.filter("taken > 0").select("row", F.explode(F.concat(whole, parts)).alias("taken_text"))
    return with_text(taken, docs, "taken_text")
