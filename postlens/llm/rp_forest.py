"""Near-duplicate vectors by a forest of random-projection trees.

Two vectors are linked if their cosine is ``least`` or more, that is, if the angle between them is at most
``theta``. A tree splits the vectors again and again: a random direction at every node, the border at the
median of the projections; what lies close to the border on either side goes to both sides (spill), so that
neighbours seldom part. A leaf's vectors are compared with each other; many trees make up for what one
parts. Borders are fitted on a bounded sample of ``SAMPLE`` vectors (a parameter); below the sampled nodes further
levels follow, as many as the number of vectors asks for. All vectors pass all trees.

Groups of very many copies would make a square of pairs. So the vectors are folded into cones first: an axis and a
radius of at most half of ``theta``. By the triangle inequality all members of a cone are linked with each
other, so their number says all about these links. Each round deals the cones by the leaves of one tree
without spill, in chunks of bounded size however large a leaf is, and folds each chunk; a copy that one tree
parts from its group joins it in the next. Rounds end when one folds little. Then the forest is asked for
neighbouring cones:

* leaves compare sketches of 256 signs, whose differing bits estimate the angle. Pairs up to five standard
  errors over the angle in question are looked at, so rows of leaves need no vectors;
* found pairs meet their axes. Where the angle of the axes and the radii leave no doubt, all members are
  linked or none is; counts of links are sums of sizes then;
* where they leave doubt, the members' own vectors are compared in double precision.

Links are those of the pairs found; the tests measure which part of all pairs that is. Groups are joined by star
contraction over the cones. The driver learns counts, the sample and the borders fitted on it.

Defined results: a vector that is null, empty or zero, or holds a null, NaN or infinite component links with
nothing; vectors of different lengths are not linked; repeated rows, also under one key, are vectors of their
own, linked with each other; a null key never names a group unless all its keys are null, and is kept in
that case; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlens.llm.simhash import components
from postlens.session import materialise

LEAST = 0.95
TREES = 8
#: Vectors that the borders are fitted on, and how many of them a fitted leaf has at least.
SAMPLE, SAMPLE_LEAF = 8192, 32
#: Part of a node's vectors, on either side of its border, that goes to both children.
SPILL = 0.06
#: Vectors that a leaf is to hold.
LEAF = 512
#: Cones that are folded together, at most.
CHUNK = 1024
#: Folding ends when a round leaves more than this part of the cones.
FOLDED = 0.95
SIGNS = 256
SEED = 13
#: Radians that no rounding of single-precision axes reaches.
DOUBT = 1e-6
FIXED_LEVELS = 8

CONE = "cone long, dim int, axis array<float>, radius double, size long"


def unit(lists: pa.Array, width: int) -> np.ndarray:
    """The vectors of a list column as rows of length one, padded with zeros to a common width."""
    flat = np.asarray(lists.flatten(), np.float64)
    lengths = np.asarray(lists.value_lengths(), np.int64)
    rows = np.zeros((len(lengths), width))
    rows[np.arange(width) < lengths[:, None]] = flat
    # Very large or small components would overflow when squared.
    rows /= np.abs(rows).max(axis=1, keepdims=True, initial=np.finfo(np.float64).tiny)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def single(rows: np.ndarray) -> np.ndarray:
    """Rows as their single-precision axes, of length one in double precision."""
    rows = rows.astype(np.float32).astype(np.float64)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def angles(cosines: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(cosines, -1, 1))


class Tree:
    """Borders of one tree: of ``depth`` levels fitted node by node on a sample, and of ``more`` levels below,
    whose directions are common to all leaves of a level. Directions follow from the seed alone."""

    def __init__(self, number: int, sample: np.ndarray, spill: float, more: int):
        self.number, self.width = number, sample.shape[1]
        self.depth = min(FIXED_LEVELS, max(0, int(math.log2(max(1, len(sample)) / SAMPLE_LEAF))))
        self.more, quantiles = more, [0.5 - spill, 0.5, 0.5 + spill]
        nodes, leaves = (1 << self.depth) - 1, 1 << self.depth
        self.fitted, self.below = np.zeros((nodes, 3)), np.zeros((leaves, more, 3))
        own, lower = self.directions()
        held = {0: np.arange(len(sample))}
        for node in range(nodes):
            at = held.pop(node)
            seen = sample[at] @ own[node]
            self.fitted[node] = np.quantile(seen, quantiles) if len(at) else 0
            held[2 * node + 1], held[2 * node + 2] = at[seen <= self.fitted[node, 1]], at[seen > self.fitted[node, 1]]
        for leaf in range(leaves):
            at = held[nodes + leaf]
            if len(at) and more:
                self.below[leaf] = np.quantile(sample[at] @ lower.T, quantiles, axis=0).T

    def directions(self) -> tuple[np.ndarray, np.ndarray]:
        rng = np.random.default_rng((SEED, self.number))
        drawn = rng.standard_normal(((1 << self.depth) - 1, self.width))
        return drawn, np.random.default_rng((SEED, self.number, 1)).standard_normal((self.more, self.width))

    def leaves(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(row, leaf)``: each row's leaf, or leaves where it is near a border."""
        own, lower = self.directions()
        row, node = np.arange(len(rows)), np.zeros(len(rows), np.int64)
        for _ in range(self.depth):
            seen = np.einsum("ij,ij->i", rows[row], own[node])
            low, middle, high = self.fitted[node].T
            left, right = self.sides(seen, low, middle, high)
            row = np.r_[row[left], row[right]]
            node = np.r_[2 * node[left] + 1, 2 * node[right] + 2]
        leaf = node - ((1 << self.depth) - 1)
        code = leaf
        for level in range(self.more):
            seen = rows[row] @ lower[level]
            left, right = self.sides(seen, *self.below[leaf, level].T)
            row, leaf = np.r_[row[left], row[right]], np.r_[leaf[left], leaf[right]]
            code = np.r_[2 * code[left], 2 * code[right] + 1]
        return row, code

    @staticmethod
    def sides(seen: np.ndarray, low: np.ndarray, middle: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        left = seen <= middle
        return left | (seen < high), ~left | (seen > low)


def plant(cones: DataFrame, count: int, width: int, first: int, trees: int, spill: float, held: int) -> list[Tree]:
    """Trees fitted on a sample of the cones, with levels enough for leaves of about ``held`` cones."""
    share = min(1.0, SAMPLE / max(1, count))
    chosen = cones.filter(F.pmod(F.xxhash64("cone"), F.lit(1 << 31)) < F.lit(int(share * (1 << 31))))
    axes = [row.axis for row in chosen.select("axis").collect()]
    sample = unit(pa.array(axes, pa.list_(pa.float32())), width)
    fitted = min(FIXED_LEVELS, max(0, int(math.log2(max(1, len(sample)) / SAMPLE_LEAF))))
    spread = count * (1 + 2 * spill) ** fitted / (1 << fitted) / held
    # A spilling level divides by less than two.
    more = max(0, math.ceil(math.log(max(1.0, spread), 2 / (1 + 2 * spill))))
    return [Tree(first + i, sample, spill, min(more, 40)) for i in range(trees)]


def fold_chunk(ids: np.ndarray, axes: np.ndarray, radii: np.ndarray, sizes: np.ndarray, theta: float) -> list[tuple]:
    """``(members, axis, radius)`` of the cones that a chunk is folded to: its rows by number."""
    gaps = angles(axes @ axes.T)
    near = gaps + radii[:, None] + radii <= theta
    np.fill_diagonal(near, False)
    weight = near @ sizes
    free, found = np.ones(len(ids), bool), []
    for seed in np.lexsort((ids, -weight)):
        if not weight[seed]:
            break
        if not free[seed]:
            continue
        group = free & near[seed]
        group[seed] = True
        axis = single((sizes[group] @ axes[group])[None])[0]
        reach = angles(axes @ axis) + radii
        members = np.flatnonzero(free & (reach <= theta / 2 - DOUBT))
        if len(members) > 1:
            free[members] = False
            found.append((members, axis, reach[members].max()))
    return found + [(np.array([i]), axes[i], radii[i]) for i in np.flatnonzero(free)]


FOLD = "child long, cone long, dim int, axis array<float>, radius double, size long"


def folded(cones: DataFrame, tree: Tree, width: int, theta: float) -> DataFrame:
    """A row for each cone, with the new cone it belongs to; one row of each new cone carries it."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = unit(batch.column("axis"), width)
            row, leaf = tree.leaves(rows)
            place = np.empty(len(rows), np.int64)
            place[row] = leaf
            axis = cut(rows, batch.column("dim"))
            yield pa.RecordBatch.from_arrays([pa.array(place), *batch.columns[:2], axis, *batch.columns[3:]], names=["leaf", *batch.schema.names])

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks(batches):
            ids, dims = chunk.column("cone").to_numpy(), chunk.column("dim")
            axes, sizes = unit(chunk.column("axis"), width), chunk.column("size").to_numpy()
            made = fold_chunk(ids, axes, chunk.column("radius").to_numpy(), sizes, theta)
            parent, heads, radii, totals = ids.copy(), [], np.zeros(len(ids)), sizes.copy()
            new = axes.copy()
            for members, axis, radius in made:
                head = members[np.argmin(ids[members])]
                parent[members], new[head], radii[head], totals[head] = ids[head], axis, radius, sizes[members].sum()
                heads.append(head)
            carries = np.zeros(len(ids), bool)
            carries[heads] = True
            axis = cut(new, dims, carries)
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(parent), dims, axis, pa.array(radii), pa.array(totals)], names=["child", "cone", "dim", "axis", "radius", "size"])

    dealt = cones.mapInArrow(deal, f"leaf long, {CONE}").withColumn("salt", F.xxhash64("cone"))
    order = ["dim", "leaf", "salt"]
    return dealt.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(fold, FOLD)


def cut(rows: np.ndarray, dims: pa.Array, wanted: np.ndarray | None = None) -> pa.Array:
    """Rows as lists of single-precision numbers without their padding; null where not wanted."""
    dims = np.asarray(dims, np.int64)
    lengths = dims if wanted is None else np.where(wanted, dims, 0)
    flat = rows.astype(np.float32)[np.arange(rows.shape[1]) < lengths[:, None]]
    ends = pa.array(np.r_[0, np.cumsum(lengths)].astype(np.int32))
    mask = None if wanted is None else pa.array(~wanted)
    return pa.ListArray.from_arrays(ends, pa.array(flat), mask=mask)


def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of rows of one length and leaf, of at most ``CHUNK`` rows."""
    rest: pa.RecordBatch | None = None
    for batch in batches:
        if rest is not None:
            batch = pa.concat_batches([rest, batch])
        keys = np.stack([batch.column("dim").to_numpy(), batch.column("leaf").to_numpy()])
        starts = [0, *(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
        for start, end in zip(starts[:-2], starts[1:-1]):
            for at in range(start, end, CHUNK):
                yield batch.slice(at, min(CHUNK, end - at))
        start = starts[-2]
        while batch.num_rows - start > CHUNK:
            yield batch.slice(start, CHUNK)
            start += CHUNK
        rest = batch.slice(start)
    if rest is not None and rest.num_rows:
        yield rest


def found_pairs(cones: DataFrame, trees: list[Tree], width: int, theta: float) -> DataFrame:
    """``(a, b)`` with a < b: pairs of cones that share a leaf and whose sketches allow a link."""

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        signs = np.random.default_rng((SEED, -1 & 0xFF, SIGNS)).standard_normal((width, SIGNS))
        for batch in batches:
            rows = unit(batch.column("axis"), width)
            sketches = pa.array([bits.tobytes() for bits in np.packbits(rows @ signs > 0, axis=1)], pa.binary())
            for number, tree in enumerate(trees):
                row, leaf = tree.leaves(rows)
                at = pa.array(row)
                tree_column = pa.array(np.full(len(row), number, np.int32))
                own = [batch.column(name).take(at) for name in ("dim", "cone", "radius")]
                yield pa.RecordBatch.from_arrays([tree_column, pa.array(leaf), *own, sketches.take(at)], names=["tree", "leaf", "dim", "cone", "radius", "sketch"])

    def compare(table: pa.Table) -> pa.Table:
        ids, radii = table.column("cone").to_numpy(), table.column("radius").to_numpy()
        packed = np.frombuffer(b"".join(table.column("sketch").to_pylist()), np.uint8).reshape(len(ids), -1)
        left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for i in range(0, len(ids), CHUNK):
            one = signs_of(packed[i : i + CHUNK])
            for j in range(i, len(ids), CHUNK):
                differing = (SIGNS - one @ signs_of(packed[j : j + CHUNK]).T) / 2
                part = np.minimum(0.5, (theta + radii[i : i + CHUNK, None] + radii[None, j : j + CHUNK]) / np.pi)
                limit = SIGNS * part + 5 * np.sqrt(SIGNS * part * (1 - part))
                a, b = np.nonzero(differing <= limit)
                a, b = ids[i : i + CHUNK][a], ids[j : j + CHUNK][b]
                # Within a block each pair is seen from both sides.
                once = a < b if i == j else a != b
                left.append(np.minimum(a, b)[once])
                right.append(np.maximum(a, b)[once])
        return pa.table({"a": np.concatenate(left), "b": np.concatenate(right)})

    routed = cones.select("cone", "dim", "axis", "radius").mapInArrow(
        route, "tree int, leaf long, dim int, cone long, radius double, sketch binary"
    )
    return routed.groupBy("tree", "leaf", "dim").applyInArrow(compare, "a long, b long").distinct()


def signs_of(packed: np.ndarray) -> np.ndarray:
    return 2 * np.unpackbits(packed, axis=1).astype(np.float32) - 1


def cosines(pairs: DataFrame, left: str, right: str, kept: list[str]) -> DataFrame:
    """The columns ``kept`` of pairs and the ``cosine`` of their vectors, in double precision."""
    schema = pairs.select(*kept, F.lit(0.0).alias("cosine")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            width = int(np.asarray(batch.column(left).value_lengths()).max(initial=1))
            own, other = unit(batch.column(left), width), unit(batch.column(right), width)
            columns = [batch.column(name) for name in kept]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(np.einsum("ij,ij->i", own, other))], names=[*kept, "cosine"])

    return pairs.select(*kept, left, right).mapInArrow(run, schema)


def usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def near_duplicates(
    vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", least: float = LEAST, trees: int = TREES, spill: float = SPILL
) -> DataFrame:
    """``(key, n_links, component_id, kept)`` of every vector: how many others it is linked with, the smallest
    key of its group, and whether that is its own."""
    if not 0 < least < 1:
        raise ValueError("least must lie between 0 and 1")
    spark, theta = vectors.sparkSession, math.acos(least)
    base = vectors.select(F.col(key).alias("id"), F.col(vector).cast("array<double>").alias("vector"))
    base = base.withColumn("usable", usable(F.col("vector"))).withColumn("row", F.monotonically_increasing_id())
    stored = "array<float>" if vectors.schema[vector].dataType.simpleString() == "array<float>" else "array<double>"
    base = materialise(base.withColumn("vector", F.col("vector").cast(stored)), "forest-vectors")
    own = base.filter("usable").select("row", F.size("vector").alias("dim"), "vector")
    count, width = own.agg(F.count(F.lit(1)), F.max("dim")).first()
    if not count:
        return results(base, spark.createDataFrame([], "row long, cone long, links long, root_id string"), key)
    cones = own.select(F.col("row").alias("cone"), "dim", F.col("vector").alias("axis"), F.lit(0.0).alias("radius"), F.lit(1).cast("long").alias("size"))
    cones = cones.withColumn("axis", F.col("axis").cast("array<double>"))
    member, before, number = own.select("row", F.col("row").alias("cone")), math.inf, 0
    while count < FOLDED * before:
        (tree,) = plant(cones, count, width, trees + number, 1, 0.0, CHUNK // 2)
        found = materialise(folded(cones, tree, width, theta), "forest-folded")
        moved = found.filter("child <> cone").select(F.col("child").alias("was"), F.col("cone").alias("into"))
        member = member.join(moved, F.col("cone") == F.col("was"), "left").select("row", F.coalesce("into", "cone").alias("cone"))
        member = materialise(member, "forest-members")
        cones = found.filter(F.col("axis").isNotNull()).select("cone", "dim", "axis", "radius", "size")
        before, count, number = count, cones.count(), number + 1
    grown = plant(cones, count, width, 0, trees, spill, LEAF)
    pairs = materialise(found_pairs(cones, grown, width, theta), "forest-pairs")
    narrow = cones.select(F.col("cone").alias("a"), F.col("axis").alias("one"), F.col("radius").alias("radius_a"), F.col("size").alias("size_a"))
    other = narrow.toDF("b", "other", "radius_b", "size_b")
    met = cosines(pairs.join(narrow, "a").join(other, "b"), "one", "other", ["a", "b", "radius_a", "radius_b", "size_a", "size_b"])
    gap, radii = F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), "cosine"))), F.col("radius_a") + F.col("radius_b")
    met = met.filter(gap - radii <= theta + DOUBT).withColumn("sure", gap + radii <= theta - DOUBT)
    met = materialise(met, "forest-met")
    sure, open_pairs = met.filter("sure"), met.filter(~F.col("sure")).select("a", "b")
    close = materialise(exact(open_pairs, member, own, least), "forest-exact")
    by_cone = sure.select(F.col("a").alias("cone"), F.col("size_b").alias("n")).union(sure.select("b", "size_a"))
    by_cone = by_cone.union(cones.select("cone", F.col("size") - 1)).groupBy("cone").agg(F.sum("n").alias("cone_links"))
    by_row = close.select(F.explode(F.array("left_row", "right_row")).alias("row")).groupBy("row").agg(F.count(F.lit(1)).alias("row_links"))
    edges = sure.select("a", "b").union(close.select("a", "b")).distinct()
    roots = materialise(components(edges, "forest-groups"), "forest-roots")
    member = member.join(roots, F.col("cone") == F.col("node"), "left").select("row", "cone", F.coalesce("root", "cone").alias("root"))
    names = member.join(base.select("row", "id"), "row").groupBy("root").agg(F.min("id").alias("root_id"))
    links = member.join(by_cone, "cone").join(by_row, "row", "left").join(names, "root")
    links = links.select("row", "cone", (F.col("cone_links") + F.coalesce("row_links", F.lit(0))).alias("links"), "root_id")
    return results(base, links, key)


def exact(pairs: DataFrame, member: DataFrame, own: DataFrame, least: float) -> DataFrame:
    """``(a, b, left_row, right_row)``: linked members of the given pairs of cones, by their own vectors."""
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("cone")).distinct()
    held = member.join(wanted, "cone", "left_semi").join(own.select("row", "vector"), "row")
    held = materialise(held.select("cone", "row", "vector"), "forest-open")
    left = held.toDF("a", "left_row", "one")
    right = held.toDF("b", "right_row", "other")
    rows = cosines(pairs.join(left, "a").join(right, "b"), "one", "other", ["a", "b", "left_row", "right_row"])
    return rows.filter(F.col("cosine") >= least).drop("cosine")


def results(base: DataFrame, links: DataFrame, key: str) -> DataFrame:
    found = base.select("row", "id").join(links, "row", "left")
    name = F.when(F.col("cone").isNull(), F.col("id")).otherwise(F.col("root_id").cast(base.schema["id"].dataType))
    return found.select(
        F.col("id").alias(key),
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        name.alias("component_id"),
        F.col("id").eqNullSafe(name).alias("kept"),
    )
