"""Near copies: texts whose sets of shingles have a Jaccard similarity of ``LEAST`` or more.

Candidates come from SimHash first, by the search of ``simhash.near_links``: sets of one fingerprint meet the
least of them, and the least sets of fingerprints within ``DISTANCE`` bits meet each other. Fingerprints of texts
that are alike by 0.8 may be 14 bits apart, where that search no longer tells them from others; these come from
min-hashes: ``BANDS`` bands of ``BAND_ROWS`` each, and texts that agree in a whole band
meet. At a similarity of 0.8 a pair meets in some band with a probability of 0.9996, at 0.9 with more than
1 - 1e-7. Every link is verified by the exact similarity of the two sets, so nothing is linked that is less
alike.

Texts with equal sets are folded before. A band value may be shared by very many texts, so its pairs are made
in two steps. First each text meets one leader: of all its values' leaders the one whose sketch is most like its
own. A value's leader is the text that meets most others over all bands, which in a group of copies is the one
in the middle, the original where it is there. What is verified joins texts to groups. Then texts of one
value meet if they are still in different groups, all of them: pairs inside a group would add nothing. So a
large group of copies costs a pair a text, and no pair that could join two groups is left out. They are compared
inside the join, on their sets, once in the first band they share, and only links leave it. Values of more than
``BLOCK_ROWS`` texts are cut into blocks that meet one by one.

Most rows are in no pair and repeat no id. A bitmap of the names that a join is about, of a fixed size, tells these rows
in the scan (``likely_named``), so only texts that a join may change or leave out are shuffled. Whom the bitmap takes for
one of them by chance goes through the join like the others, so results do not depend on it.

Before their sets are fetched, pairs are looked at through sketches: two bits of each min-hash. Of these 85 %
agree at a similarity of 0.8; pairs that agree in fewer, by 4.5 standard deviations, are left out (of true pairs
at 0.8 one in 300,000).

Defined results: a null or empty text, and one without a word, has an empty set, and empty sets are alike;
fewer words than a shingle needs make one shingle. A set is named by 64 bits of hash.
"""

from __future__ import annotations

import math
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postlens.llm.common import map_texts, packed, unpacked
from postlens.llm.simhash import SEED, components, near_links
from postlens.session import materialise

SHINGLE, LEAST = 5, 0.8
BANDS, BAND_ROWS = 20, 5
#: Bits in which two fingerprints that meet may differ.
DISTANCE = 4
#: Bits of the bitmap of names: 8 MB however many names there are.
NAME_BITS = 1 << 26
#: Texts of one band value that meet in one go.
BLOCK_ROWS = 1024
#: Min-hashes in a sketch, in numbers of 32; the bands take the first of them.
LANES = 160
BLOCK = 1 << 12

_random = np.random.default_rng(SEED)
FACTORS = _random.integers(0, 1 << 63, max(LANES, BANDS * BAND_ROWS), dtype=np.uint64)[:, None] * np.uint64(2) + np.uint64(1)
SHIFTS = _random.integers(0, 1 << 63, max(LANES, BANDS * BAND_ROWS), dtype=np.uint64)[:, None]

#: An odd factor that carries all bits of a min-hash to the top.
MIX = np.uint64(0x9E3779B97F4A7C15)
#: The lower bit of every lane.
LOWER_BITS = 0x5555555555555555

#: The bits of every byte, and where the counts of each of a hash's eight bytes begin.
BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.float64)
BYTE_PLACES = np.arange(0, 8 * 256, 256)


def shingle_hashes(text: bytes | None, shingle: int = SHINGLE) -> np.ndarray:
    """The hashes of a text's shingles, repeats included."""
    words = (text or b"").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.r_[0, ends[:-1] + 1]
    width = min(shingle, len(words))
    spans = map(slice, starts[: len(words) - width + 1].tolist(), ends[width - 1 :].tolist())
    hashes = map(xxhash.xxh64_intdigest, map(joined.__getitem__, spans), repeat(SEED))
    return np.fromiter(hashes, np.uint64, len(words) - width + 1)


def shingle_set(text: bytes | None, shingle: int = SHINGLE) -> np.ndarray:
    """The different hashes of a text's shingles, in order."""
    return np.unique(shingle_hashes(text, shingle))


def fingerprint_of(hashes: np.ndarray) -> int:
    """``simhash.fingerprint`` of a text by its shingles' hashes: the values of each byte are counted, then their bits."""
    counts = np.zeros(8 * 256)
    for at in range(0, len(hashes), BLOCK):
        found = hashes[at : at + BLOCK].astype("<u8").view(np.uint8).reshape(-1, 8) + BYTE_PLACES
        counts += np.bincount(found.ravel(), minlength=8 * 256)
    ones = (counts.reshape(8, 256) @ BYTE_BITS).ravel()
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def band_values(hashes: np.ndarray) -> tuple[list[int], np.ndarray]:
    """One number a band, of its min-hashes, and the sketch; all zero for an empty set."""
    if not len(hashes):
        return [0] * BANDS, np.zeros(LANES // 32, np.uint64)
    least = np.full(len(FACTORS), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(hashes), BLOCK):
        least = np.minimum(least, (FACTORS * hashes[at : at + BLOCK] + SHIFTS).min(axis=1))
    rows = least[: BANDS * BAND_ROWS].astype("<u8").reshape(BANDS, BAND_ROWS)
    pairs_of_bits = ((least[:LANES] * MIX) >> np.uint64(62)).reshape(-1, 32)
    sketch = (pairs_of_bits << np.arange(0, 64, 2, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)
    return [xxhash.xxh64_intdigest(row.tobytes(), band) for band, row in enumerate(rows)], sketch


def set_name(hashes: np.ndarray) -> int:
    return xxhash.xxh64_intdigest(hashes.astype("<u8").tobytes(), SEED)


def as_longs(values: list) -> pa.Array:
    return pa.array(np.array(values, np.uint64).view(np.int64))


def as_lists(values: list) -> pa.Array:
    ends = np.cumsum([0, *map(len, values)])
    flat = np.concatenate([np.asarray(one, np.uint64) for one in values]) if values else np.zeros(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat.view(np.int64)))


def signatures(docs: DataFrame, shingle: int = SHINGLE, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, set, size, fp, bands, sketch)`` of every whole text."""

    def work(texts: list) -> list[pa.Array]:
        hashes = [shingle_hashes(text, shingle) for text in texts]
        sets = [np.unique(one) for one in hashes]
        bands = [band_values(one) for one in sets]
        return [
            as_longs([set_name(one) for one in sets]),
            pa.array([len(one) for one in sets], pa.int32()),
            as_longs([fingerprint_of(one) for one in hashes]),
            as_lists([values for values, _ in bands]),
            as_lists([sketch for _, sketch in bands]),
        ]

    fields = [T.StructField("set", T.LongType()), T.StructField("size", T.IntegerType()), T.StructField("fp", T.LongType())]
    lists = [T.StructField(name, T.ArrayType(T.LongType())) for name in ("bands", "sketch")]
    return map_texts(docs, key, text, T.StructType([*fields, *lists]), work)


def shingle_sets(docs: DataFrame, shingle: int = SHINGLE, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, set, shingles)`` of every whole text."""

    def work(texts: list) -> list[pa.Array]:
        sets = [shingle_set(text, shingle) for text in texts]
        return [as_longs([set_name(one) for one in sets]), as_lists(sets)]

    fields = [T.StructField("set", T.LongType()), T.StructField("shingles", T.ArrayType(T.LongType()))]
    return map_texts(docs, key, text, T.StructType(fields), work)


def differing(one: str, other: str) -> Column:
    """In how many lanes two sketches differ."""
    total = F.lit(0)
    for i in range(LANES // 32):
        bits = F.get(f"{one}.sketch", F.lit(i)).bitwiseXOR(F.get(f"{other}.sketch", F.lit(i)))
        lanes = bits.bitwiseOR(F.shiftrightunsigned(bits, 1)).bitwiseAND(F.lit(LOWER_BITS))
        total = total + F.bit_count(lanes)
    return total


def alike(one: str, other: str, least: float) -> Column:
    """Whether sizes and sketches leave room for a similarity of ``least``."""
    agree = least + (1 - least) / 4
    most = math.ceil(LANES * (1 - agree) + 4.5 * math.sqrt(LANES * agree * (1 - agree)))
    small, large = F.least(f"{one}.size", f"{other}.size"), F.greatest(f"{one}.size", f"{other}.size")
    return (small >= F.lit(least) * large) & (differing(one, other) <= most)


def shared_values(distinct: DataFrame) -> DataFrame:
    """``(band, value, set, n)``: a row for each set and band value that another set has too, with the number
    of sets of the value."""
    values = distinct.select("set", F.posexplode("bands").alias("band", "value"))
    counts = values.groupBy("band", "value").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return values.join(counts, ["band", "value"])


def sketched(distinct: DataFrame, name: str) -> DataFrame:
    """``(set, name)``: what a pair is looked at by, as a struct ``(set, size, sketch)``."""
    return distinct.select("set", F.struct("set", "size", "sketch").alias(name))


def in_order(one: Column, other: Column) -> list[Column]:
    return [F.least(one, other).alias("a"), F.greatest(one, other).alias("b")]


def simhash_pairs(distinct: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """``(a, b)`` with a < b: every set with the least one of its fingerprint, and these least ones with each other
    where their fingerprints are within ``distance`` bits (in dense places as many pairs as connect them)."""
    least = materialise(distinct.groupBy("fp").agg(F.min("set").alias("least")), "copies-fingerprints")
    inside = distinct.join(least, "fp").filter("set <> least").select(F.col("least").alias("a"), F.col("set").alias("b"))
    one = least.select(F.col("fp").alias("a"), F.col("least").alias("one"))
    other = least.select(F.col("fp").alias("b"), F.col("least").alias("other"))
    across = near_links(least.select("fp"), distance).join(one, "a").join(other, "b")
    return inside.union(across.select(*in_order(F.col("one"), F.col("other"))))


def leader_pairs(shared: DataFrame, distinct: DataFrame, least: float) -> DataFrame:
    """``(a, b)`` with a < b: a pair for every set, with that of its values' leaders whose sketch is most like
    its own."""
    met = shared.groupBy("set").agg(F.sum("n").alias("met"))
    rows = shared.join(met, "set").select("band", "value", "set", "met")
    leaders = rows.groupBy("band", "value").agg(F.max(F.struct("met", "set")).alias("leader"))
    pairs = rows.join(leaders, ["band", "value"]).select("set", F.col("leader.set").alias("leader"))
    pairs = pairs.filter("set <> leader").distinct().join(sketched(distinct, "one"), "set")
    pairs = pairs.join(sketched(distinct, "other").withColumnRenamed("set", "leader"), "leader")
    best = F.min(F.struct(differing("one", "other").alias("differing"), "leader")).alias("best")
    pairs = pairs.filter(alike("one", "other", least)).groupBy("set").agg(best)
    return pairs.select(*in_order(F.col("set"), F.col("best.leader"))).distinct()


def jaccard(a: str, b: str) -> Column:
    common = F.size(F.array_intersect(a, b))
    either = F.size(a) + F.size(b) - common
    return F.when(either > 0, common / either).otherwise(F.lit(1.0))


def verified(pairs: DataFrame, sets: DataFrame, least: float = LEAST) -> DataFrame:
    """The pairs whose sets are at least so much alike; ``sets`` has one row ``(set, shingles)`` for each set."""
    one = sets.select(F.col("set").alias("a"), F.col("shingles").alias("left"))
    two = sets.select(F.col("set").alias("b"), F.col("shingles").alias("right"))
    return pairs.join(one, "a").join(two, "b").filter(jaccard("left", "right") >= least).select("a", "b")


def meets(one: str, other: str, least: float) -> Column:
    """Whether two rows of ``open_rows`` are a pair to look at: of one value and block, in different groups, alike
    enough by their sketches, and together in no earlier band, where they have been looked at already."""
    left, right = (lambda name: F.col(f"{one}.{name}")), (lambda name: F.col(f"{other}.{name}"))
    earlier = F.lit(False)
    for at in range(BANDS):
        same = F.get(left("own.bands"), F.lit(at)) == F.get(right("own.bands"), F.lit(at))
        earlier = earlier | ((left("band") > at) & same)
    place = (left("band") == right("band")) & (left("value") == right("value")) & (left("meet") == right("meet"))
    inside = (left("meet.low") == left("meet.high")) | (left("block") != right("block"))
    open_groups = left("group") != right("group")
    return place & open_groups & inside & alike(f"{one}.own", f"{other}.own", least) & ~earlier


def open_rows(shared: DataFrame, distinct: DataFrame, roots: DataFrame) -> DataFrame:
    """``(band, value, meet, block, group, own)``: the sets of the values that sets of several groups by ``roots``,
    ``(node, root)``, share. A row stands in every meeting of its block with another one of its value."""
    rows = shared.join(roots, F.col("set") == F.col("node"), "left")
    rows = rows.select("band", "value", "set", "n", F.coalesce("root", "set").alias("group"))
    groups = rows.groupBy("band", "value").agg(F.min("group").alias("least_group"), F.max("group").alias("last_group"))
    rows = rows.join(groups.filter("least_group <> last_group").select("band", "value"), ["band", "value"])
    own = F.struct("set", "size", "sketch", "bands").alias("own")
    rows = rows.join(distinct.select("set", own), "set")
    blocks = F.ceil(F.col("n") / BLOCK_ROWS).cast("int")
    rows = rows.withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("set"), F.col("blocks")).cast("int"))
    # A block meets every other in one place, whose name both have.
    others = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda i: F.struct(F.least("block", i).alias("low"), F.greatest("block", i).alias("high")),
    )
    return rows.select("band", "value", F.explode(others).alias("meet"), "block", "group", "own")


def open_links(shared: DataFrame, distinct: DataFrame, sets: DataFrame, roots: DataFrame, least: float) -> DataFrame:
    """``(a, b)`` with a < b: all pairs of sets that share a value, are in different groups by ``roots`` and are alike.

    Rows that find nobody by the sketches go first, by a semi-join. The others meet again with their sets, and
    the exact similarity is part of the join, so only links come out of it and no list of pairs is written."""
    rows = open_rows(shared, distinct, roots)
    live = rows.alias("one").join(rows.alias("other"), meets("one", "other", least), "left_semi")
    live = live.join(sets, F.col("own.set") == sets["set"]).drop("set")
    once = F.col("one.own.set") < F.col("other.own.set")
    exact = jaccard("one.shingles", "other.shingles") >= least
    met = live.alias("one").join(live.alias("other"), meets("one", "other", least) & once & exact)
    return met.select(F.col("one.own.set").alias("a"), F.col("other.own.set").alias("b"))


def likely_named(rows: DataFrame, names: DataFrame) -> DataFrame:
    """``rows`` with a column ``likely``: true where ``names`` has the row's ``name``, and by chance for few others.

    The names' hashes are bits of a bitmap, which is broadcast; it has ``NAME_BITS`` bits at most. The rows are not
    shuffled."""
    place = F.pmod(F.xxhash64("name"), F.lit(NAME_BITS))
    bits = names.select(F.bitmap_bucket_number(place).alias("part"), F.bitmap_bit_position(place).alias("bit"))
    # Brought together before they are summed up: a map task's part of the bitmap is larger than its names.
    bits = bits.repartition("part").groupBy("part").agg(F.bitmap_construct_agg("bit").alias("bits"))
    placed = rows.select("*", F.bitmap_bucket_number(place).alias("part"), F.bitmap_bit_position(place).alias("bit"))
    byte = F.conv(F.hex(F.substring("bits", (F.floor(F.col("bit") / 8) + 1).cast("int"), 1)), 16, 10).cast("int")
    likely = F.coalesce(F.getbit(byte, (F.col("bit") % 8).cast("int")) == 1, F.lit(False))
    return placed.join(F.broadcast(bits), "part", "left").select(*rows.columns, likely.alias("likely"))


def drop_near_copies(docs: DataFrame, shingle: int = SHINGLE, least: float = LEAST) -> DataFrame:
    """The columns of ``docs`` for one document of each group of near copies: the one with the smallest id.
    Rows that repeat an id are one document; of them one with the least text stays. Rows without an id are
    documents by their text, and come after all others."""
    text, number = F.col("row.text").cast("string"), F.col("row.doc_id")
    mark = F.when(number.isNull(), F.sha2(F.coalesce(text, F.lit("")), 256))
    member = F.struct(number.isNull().alias("none"), number.alias("id"), mark.alias("mark"))
    rows = packed(docs)
    plain = rows.select(member.alias("member"), text.alias("text"))
    marked = materialise(signatures(plain, shingle, key="member"), "copies")
    distinct = marked.groupBy("set").agg(
        F.min("member").alias("least_member"), *[F.first(name).alias(name) for name in ("size", "fp", "bands", "sketch")]
    )
    distinct = materialise(distinct, "copies-distinct")
    near = materialise(simhash_pairs(distinct), "copies-near")
    shared = materialise(shared_values(distinct), "copies-shared")
    # Only sets that meet another are built again, from the text of their least member.
    paired = shared.select("set").union(near.select("a")).union(near.select("b")).distinct()
    wanted = materialise(distinct.join(paired, "set").select(F.to_json("least_member").alias("name")).distinct(), "copies-wanted")
    chosen = likely_named(plain.withColumn("name", F.to_json("member")), wanted).filter("likely")
    chosen = chosen.join(wanted, "name", "left_semi")
    # Rows that repeat an id and its text are built once; the join has brought them together.
    chosen = chosen.withColumn("mark", F.xxhash64("text")).dropDuplicates(["name", "mark"])
    sets = materialise(shingle_sets(chosen, shingle, key="name").select("set", "shingles"), "copies-sets")
    pairs = near.union(leader_pairs(shared, distinct, least)).distinct()
    links = materialise(verified(pairs, sets, least).distinct(), "copies-links")
    roots = materialise(components(links), "copies-roots")
    more = materialise(open_links(shared, distinct, sets, roots, least), "copies-more")
    roots = materialise(components(links.union(more)), "copies-roots")
    grouped = distinct.join(roots, distinct["set"] == roots["node"], "left").select(
        "set", "least_member", F.coalesce("root", "set").alias("root")
    )
    names = grouped.groupBy("root").agg(F.min("least_member").alias("name"))
    kept = materialise(names.select(F.to_json("name").alias("name")).distinct(), "copies-kept")
    # All other names are kept and stand in one row.
    counts = marked.groupBy("member").agg(F.count(F.lit(1)).alias("n")).select(F.to_json("member").alias("name"), "n")
    stays = kept.withColumn("stays", F.lit(True))
    concerned = counts.join(stays, "name", "left").filter("stays IS NULL OR n > 1").select("name")
    concerned = materialise(concerned, "copies-concerned")
    named = likely_named(rows.withColumn("name", F.to_json(member)), concerned)
    inside = Window.partitionBy("name").orderBy(F.col("row.text"))
    judged = named.filter("likely").join(kept, "name", "left_semi")
    first = judged.withColumn("nth", F.row_number().over(inside)).filter("nth = 1")
    return unpacked(named.filter("NOT likely").select("row").union(first.select("row")), docs)
