"""SimHash near-duplicates, found by multi-index hashing and joined to groups.

A fingerprint is cut into segments. Two fingerprints within ``distance`` bits must agree, up to a small
radius, in one segment; so every fingerprint is stored once per segment, asks for the small Hamming
ball around its own segment values, and what it meets is verified by the whole distance. The radii
fulfil sum(radius + 1) > distance, which makes the search exact.

Copies of one fingerprint are folded before the search. Where a segment value is held by very many
different fingerprints (``dense`` or more), pairs are not made: each of these fingerprints is hung on
every point of its ball of half the distance, and fingerprints that share a point are linked through
the least of them. Those links are exact too for groups (two fingerprints within 2r bits have a point
within r of both) and grow with the number of fingerprints only. Points may join two fingerprints that
are up to 2r apart, so r is distance / 2, which must then be even.

Defined results: a null or empty text, and one without a word, has fingerprint zero and links like any
other; fewer words than a shingle needs make one shingle; repeated rows come back as often as they
came; a null id takes part in its group but is never its name unless all ids of the group are null;
an empty table gives an empty result.
"""

from __future__ import annotations

from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postlens.llm.common import map_texts, packed, unpacked
from postlens.session import materialise

BITS = 64
SEED = 42
BLOCK = 1 << 15


def fingerprint(text: bytes | None, shingle: int) -> int:
    """64 bits: a bit is 1 if it is set in over half of the hashes of the text's shingles."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    width = min(shingle, len(words))
    starts, ends = (ends - lengths)[: len(words) - width + 1], ends[width - 1 :]
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(starts), BLOCK):
        spans = map(slice, starts[at : at + BLOCK].tolist(), ends[at : at + BLOCK].tolist())
        hashes = map(xxhash.xxh64_intdigest, map(joined.__getitem__, spans), repeat(SEED))
        found = np.fromiter(hashes, np.uint64, min(BLOCK, len(starts) - at)).astype("<u8")
        bits = np.unpackbits(found.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.uint32)
    return int(np.packbits(2 * ones > len(starts), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, fp)``: the fingerprint of every whole text as a signed 64-bit number."""

    def work(texts: list) -> list[pa.Array]:
        found = np.array([fingerprint(text, shingle) for text in texts], np.uint64)
        return [pa.array(found.view(np.int64))]

    return map_texts(docs, key, text, T.StructType([T.StructField("fp", T.LongType())]), work)


def segment_plan(segments: int, distance: int) -> list[tuple[int, int, int]]:
    """``(first bit, width, radius)`` of each segment; the widest segments get the least radius, and a
    segment that needs no search is left out."""
    plan, at = [], 0
    for i in range(segments):
        width = BITS // segments + (i < BITS % segments)
        share = (distance + 1) // segments + (i >= segments - (distance + 1) % segments)
        if share:
            plan.append((at, width, share - 1))
        at += width
    return plan


def ball(width: int, radius: int) -> list[int]:
    """All masks of at most ``radius`` of the lowest ``width`` bits."""
    return [
        sum(1 << bit for bit in bits) for size in range(radius + 1) for bits in combinations(range(width), size)
    ]


def signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def constants(values: list[int]) -> Column:
    """A constant array in one piece: thousands of literals would slow the analysis of the query."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")


def segment_keys(fp: Column, plan: list[tuple[int, int, int]], probe: bool) -> Column:
    """The keys under which a fingerprint is stored, or those it asks for."""

    def around(number: int, at: int, width: int, radius: int) -> Column:
        # The segment's number stands above its bits.
        own = F.shiftrightunsigned(fp, at).bitwiseAND(F.lit((1 << width) - 1)) + F.lit(number << 40)
        masks = ball(width, radius if probe else 0)
        return F.transform(constants(masks), lambda mask: own.bitwiseXOR(mask))

    return F.concat(*[around(number, *segment) for number, segment in enumerate(plan)])


def near_links(distinct: DataFrame, distance: int, segments: int = 3, dense: int = 4000) -> DataFrame:
    """``(a, b)`` with a < b, enough of them that near fingerprints are connected.

    ``distinct`` has one row ``fp`` for each different fingerprint. All pairs within ``distance`` are
    given, except inside dense segment values, where they are connected through shared points.
    """
    plan = segment_plan(segments, distance)
    table = distinct.select(F.col("fp").alias("b"), F.explode(segment_keys(F.col("fp"), plan, False)).alias("key"))
    probes = distinct.select(F.col("fp").alias("a"), F.explode(segment_keys(F.col("fp"), plan, True)).alias("key"))
    differing = F.bit_count(F.col("a").bitwiseXOR(F.col("b")))
    crowded = table.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= dense).select("key")
    crowded = materialise(crowded, "simhash-crowded")
    near = (
        probes.join(table.join(crowded, "key", "left_anti"), "key")
        .filter((F.col("a") < F.col("b")) & (differing <= distance))
        .select("a", "b")
    )
    hung = probes.join(crowded, "key", "left_semi").select("a").distinct()
    points = constants([signed(mask) for mask in ball(BITS, distance // 2)])
    star = hung.select("a", F.explode(F.transform(points, lambda mask: F.col("a").bitwiseXOR(mask))).alias("point"))
    least = star.groupBy("point").agg(F.min("a").alias("least"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    shared = star.join(least, "point").filter("a > least").select(F.col("least").alias("a"), F.col("a").alias("b"))
    return near.union(shared).distinct()


def components(links: DataFrame, label: str = "components") -> DataFrame:
    """``(node, root)`` for every node of the links: the least node that can be reached.

    Alternates large-star and small-star steps, each of which hangs neighbours on the least node of a
    neighbourhood; every round is written to the shared folder. Ends when a round changes nothing.
    """

    def large(edges: DataFrame) -> DataFrame:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        return both.filter("b > a").join(least, "a").select(F.col("b").alias("x"), F.col("m").alias("y"))

    def small(edges: DataFrame) -> DataFrame:
        least = edges.groupBy("b").agg(F.min("a").alias("m"))
        moved = edges.join(least, "b").filter("a <> m").select(F.col("a").alias("x"), F.col("m").alias("y"))
        return moved.union(least.select(F.col("b").alias("x"), F.col("m").alias("y")))

    def ordered(edges: DataFrame) -> DataFrame:
        return (
            edges.filter("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
        )

    def state(edges: DataFrame) -> tuple:
        # Sums of hashes wrap, so they are taken of 31 bits.
        mark = F.sum(F.xxhash64("a", "b").bitwiseAND(F.lit((1 << 31) - 1)))
        return tuple(edges.agg(F.count(F.lit(1)), mark).first())

    edges = materialise(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")), label)
    before = None
    while (now := state(edges)) != before:
        before = now
        edges = materialise(ordered(small(ordered(large(edges)))), label)
    roots = edges.groupBy("b").agg(F.min("a").alias("root")).select(F.col("b").alias("node"), "root")
    return roots.union(edges.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct())


def near_duplicates(
    docs: DataFrame,
    shingle: int = 5,
    distance: int = 4,
    segments: int = 3,
    dense: int = 4000,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``(key, fp, component_id)`` for every row: its fingerprint and the smallest key of its group."""
    if distance < 0 or distance % 2 or segments > distance + 1:
        raise ValueError("distance must be even and segments at most distance + 1")
    marked = materialise(fingerprints(docs, shingle, key, text), "simhash")
    distinct = materialise(marked.groupBy("fp").agg(F.min(key).alias("least_key")), "simhash-distinct")
    roots = materialise(components(near_links(distinct.select("fp"), distance, segments, dense)), "simhash-roots")
    grouped = distinct.join(roots, distinct["fp"] == roots["node"], "left").select(
        "fp", "least_key", F.coalesce("root", "fp").alias("root")
    )
    names = grouped.groupBy("root").agg(F.min("least_key").alias("component_id"))
    named = grouped.join(names, "root").select("fp", "component_id")
    return marked.join(named, "fp").select(key, "fp", "component_id")


def fingerprint_hex(fp: str = "fp") -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def drop_near_duplicates(docs: DataFrame, shingle: int = 5, distance: int = 4, segments: int = 3) -> DataFrame:
    """The columns of ``docs`` for one document of each group: the one with the smallest id. Rows that
    repeat an id are one document; of them one with the least text stays. Rows without an id are documents
    by their text, and come after all others."""
    text, number = F.col("row.text").cast("string"), F.col("row.doc_id")
    mark = F.when(number.isNull(), F.sha2(F.coalesce(text, F.lit("")), 256))
    member = F.struct(number.isNull().alias("none"), number.alias("id"), mark.alias("mark"))
    rows = packed(docs)
    found = near_duplicates(rows.select(member.alias("member"), text.alias("text")), shingle, distance, segments, key="member")
    kept = found.filter(F.col("member").eqNullSafe(F.col("component_id"))).select(F.to_json("member").alias("name")).distinct()
    named = rows.withColumn("name", F.to_json(member))
    inside = Window.partitionBy("name").orderBy(F.col("row.text"))
    first = named.join(kept, "name", "left_semi").withColumn("nth", F.row_number().over(inside)).filter("nth = 1")
    return unpacked(first, docs)
