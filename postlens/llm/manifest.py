"""A Merkle manifest of a dataset, kept as a persistent tree: a change copies a path and shares the rest.

Leaves are digests of rows. The leaves of one tree (all rows of one ``tree`` value) stand in the order of
their keys; every 8 neighbours become the digest of their digests, level by level, until one is left, the
tree's root. These roots, in the order of the ``tree`` values, make one more tree, whose root stands for the
whole dataset.

A changed leaf makes a version of the tree. It owns only the copies of its ancestors; every other node is
that of the first version, and the siblings on the way up are all that the copies need. The work is dealt in
aligned blocks of 8^4 leaves, so a task holds one block's nodes and its versions. The roots of blocks are the
leaves of the next blocks of the same kind, and so on, until every tree has one root; then the roots of the
trees go the same way. What a block needs from above, the siblings on its way to the root, is one row a
block, and with it the block's versions go on to roots of their own.

Texts are read once or twice and not shuffled, only their digests are. A tree with any share of all rows is
in many blocks, and no task numbers all of its leaves: rows are dealt by range, numbered inside their part,
and moved by the sizes of the parts before.

Defined results: a null value is ``-`` in a leaf, which no other value is; a null ``tree`` is a tree of its
own and comes first, null keys come first in their tree; rows that repeat a key stand in the order of their
digests, and equal rows get equal results but for their places; a single leaf is its tree's root; an empty
table has an empty manifest. Extra columns are not read.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postlens.llm.common import with_positions
from postlens.session import materialise

ARITY = 8
#: Levels of a block; it has 8^4 leaves.
LEVELS = 4
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

STEP = T.StructType([T.StructField(side, T.ArrayType(T.StringType())) for side in ("left", "right")])


def in_leaf(value: Column) -> Column:
    """A value with its length in bytes in front, so that no two lists of values look alike."""
    value = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def leaf_digest(*values: Column) -> Column:
    return F.sha2(F.concat(*map(in_leaf, values)), 256)


def document_leaves(docs: DataFrame) -> DataFrame:
    """``(key, tree, leaf, changed)`` of every document. Every third text, by the crc32 of its id, is tampered
    with: A to Z are put in lower case; ``changed`` is its leaf then, else null."""
    head = [F.col(name) for name in ("doc_id", "source", "lang", "n_chars")]
    touched = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    text = F.col("text").cast("string")
    return docs.select(
        F.col("doc_id").alias("key"),
        F.col("lang").alias("tree"),
        leaf_digest(*head, text).alias("leaf"),
        F.when(touched, leaf_digest(*head, F.translate(text, UPPER, LOWER))).alias("changed"),
    )


def height(size: Column) -> Column:
    """Levels above the leaves of a tree of so many leaves."""
    return sum(((size > ARITY**level).cast("int") for level in range(1, 21)), (size > 1).cast("int"))


def placed(leaves: DataFrame) -> DataFrame:
    """The leaves with the number ``tree`` of their tree, their place ``at`` in it and its ``height``."""
    order = [F.col("tree").asc_nulls_first(), F.col("key").asc_nulls_first(), F.col("leaf")]
    dealt = leaves.repartitionByRange(*order).sortWithinPartitions(*order)
    dealt = materialise(dealt.withColumn("spot", F.monotonically_increasing_id()), "manifest-leaves")
    # Spark's ids hold the part above 33 bits for the row.
    part, row = F.shiftrightunsigned("spot", 33).alias("part"), F.col("spot").bitwiseAND(F.lit((1 << 33) - 1))
    parts = dealt.groupBy(part, "tree").agg(F.min(row).alias("first"), F.count(F.lit(1)).alias("n"))
    parts = materialise(parts, "manifest-parts")
    sizes = parts.groupBy("tree").agg(F.sum("n").alias("size"))
    trees = with_positions(sizes, [F.col("tree").asc_nulls_first()], "number", "manifest-trees")
    before = Window.partitionBy("tree").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = parts.withColumn("shift", F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first"))
    shifts = shifts.select("part", F.col("tree").alias("named"), "shift")
    same = F.col("named").eqNullSafe(F.col("tree"))
    shifts = shifts.join(trees, same).select("part", "named", "shift", "number", "size")
    rows = dealt.withColumn("own_part", part).join(shifts, (F.col("own_part") == F.col("part")) & same)
    return rows.select(
        F.col("number").alias("tree"), (row + F.col("shift")).alias("at"), height(F.col("size")).alias("height"), "key", "leaf", "changed"
    )


class Nodes:
    """The nodes of one block, level by level."""

    def __init__(self, leaves: list[str], levels: int):
        self.levels = [leaves]
        for _ in range(levels):
            below = self.levels[-1]
            runs = (below[i : i + ARITY] for i in range(0, len(below), ARITY))
            self.levels.append([parent(run) for run in runs])

    def path(self, at: int) -> list[tuple[list[str], list[str]]]:
        """The siblings to the left and to the right of a leaf and of each of its ancestors below the top."""
        steps = []
        for nodes in self.levels[:-1]:
            run = nodes[at - at % ARITY : at - at % ARITY + ARITY]
            steps.append((run[: at % ARITY], run[at % ARITY + 1 :]))
            at //= ARITY
        return steps


def parent(run: list[str]) -> str:
    return hashlib.sha256("".join(run).encode()).hexdigest()


def copied_path(leaf: str, path: list[tuple[list[str], list[str]]]) -> list[str]:
    """The nodes that a version with this leaf does not share: its copies of the ancestors, up to the root."""
    copies = []
    for left, right in path:
        leaf = parent([*left, leaf, *right])
        copies.append(leaf)
    return copies


def block_of(table: pa.Table, levels: int) -> Nodes:
    """The nodes of a block, from rows in the order of their places."""
    return Nodes(table.column("digest").to_pylist(), min(levels, table.column("height")[0].as_py()))


def in_blocks(nodes: DataFrame, levels: int) -> DataFrame:
    return nodes.withColumn("block", F.shiftright("at", 3 * levels))


def block_roots(nodes: DataFrame, levels: int) -> DataFrame:
    """``(tree, at, digest, height)`` of the roots of blocks of ``nodes``, which has the same columns;
    ``height`` is what is still to climb."""

    def root(table: pa.Table) -> pa.Table:
        table = table.sort_by("at")
        digest = block_of(table, levels).levels[-1][0]
        left = max(0, table.column("height")[0].as_py() - levels)
        return pa.table({"tree": table.column("tree")[:1], "at": table.column("block")[:1], "digest": [digest], "height": pa.array([left], pa.int32())})

    return in_blocks(nodes, levels).groupBy("tree", "block").applyInArrow(root, "tree long, at long, digest string, height int")


def climbed(nodes: DataFrame, levels: int) -> DataFrame:
    """``nodes`` with the root ``top`` of their block, its place ``block`` and the ``path`` to it."""

    def climb(table: pa.Table) -> pa.Table:
        table = table.sort_by("at")
        block = block_of(table, levels)
        paths = [[{"left": left, "right": right} for left, right in block.path(i)] for i in range(table.num_rows)]
        step = pa.struct([("left", pa.list_(pa.string())), ("right", pa.list_(pa.string()))])
        table = table.append_column("top", pa.array([block.levels[-1][0]] * table.num_rows))
        return table.append_column("path", pa.array(paths, pa.list_(step)))

    blocks = in_blocks(nodes.select("tree", "at", "digest", "height"), levels)
    schema = T.StructType([*blocks.schema.fields, T.StructField("top", T.StringType()), T.StructField("path", T.ArrayType(STEP))])
    return blocks.groupBy("tree", "block").applyInArrow(climb, schema)


def ascended(nodes: DataFrame, levels: int, label: str) -> DataFrame:
    """``(tree, at, path, root)`` of nodes ``(tree, at, digest, height)``: all siblings on the way to the
    root of their tree. Each round climbs one block of levels; the driver learns the greatest height."""
    rounds = -(-(nodes.agg(F.max("height")).first()[0] or 0) // levels)
    ways = nodes.select("tree", "at", F.col("at").alias("place"), F.array().cast(T.ArrayType(STEP)).alias("path"), F.col("digest").alias("root"))
    for _ in range(rounds):
        found = materialise(climbed(nodes, levels), f"{label}-climbed")
        step = found.select("tree", F.col("at").alias("place"), F.col("path").alias("more"), "block", "top")
        ways = ways.join(step, ["tree", "place"]).select(
            "tree", "at", F.col("block").alias("place"), F.concat("path", "more").alias("path"), F.col("top").alias("root")
        )
        above = found.select("tree", F.col("block").alias("at"), F.col("top").alias("digest"), F.greatest(F.col("height") - levels, F.lit(0)).alias("height"))
        nodes = above.distinct()
    return ways.select("tree", "at", "path", "root")


def versions(leaves: DataFrame, levels: int = LEVELS) -> DataFrame:
    """The manifest of ``(key, tree, leaf, changed)``, in blocks of so many levels: one row a leaf.

    ``key``, ``leaf``, the ``subroot`` of its tree, the ``root`` of all, ``siblings`` (every sibling on the way
    up, level by level, left to right), ``copied`` (the nodes that the version with the leaf ``changed``,
    or with the same leaf where that is null, does not share) and ``folded_root`` (the last of them).
    """
    key_type = leaves.schema["key"].dataType
    leaves = materialise(placed(leaves), "manifest-placed")
    nodes = leaves.select("tree", "at", F.col("leaf").alias("digest"), "height")
    blocks = materialise(block_roots(nodes, levels), "manifest-blocks")
    inside = materialise(ascended(blocks, levels, "manifest-trees"), "manifest-inside")
    roots = inside.groupBy("tree").agg(F.min("root").alias("digest"))
    trees = roots.count()
    roots = roots.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("at"), "digest", height(F.lit(trees)).alias("height"))
    above = ascended(materialise(roots, "manifest-roots"), levels, "manifest-forest")
    above = above.select(F.col("at").alias("tree"), F.col("path").alias("more"), F.col("root").alias("whole"))
    ways = inside.join(above, "tree").select(
        "tree", F.col("at").alias("block"), F.concat("path", "more").alias("path"), F.col("root").alias("subroot"), F.col("whole").alias("root")
    )
    columns = "leaf string, subroot string, root string, siblings array<string>, copied array<string>, folded_root string"
    schema = T.StructType([T.StructField("key", key_type), *T._parse_datatype_string(columns).fields])

    def fold(own: pa.Table, way: pa.Table) -> pa.Table:
        own, way = own.sort_by("at"), way.select(["path", "subroot", "root"]).to_pylist()[0]
        above = [(step["left"], step["right"]) for step in way["path"]]
        block = block_of(own, levels)
        found = own.column("digest").to_pylist()
        siblings, copied, folded = [], [], []
        for at, (leaf, changed) in enumerate(zip(found, own.column("changed").to_pylist(), strict=True)):
            path = block.path(at) + above
            siblings.append([one for left, right in path for one in (*left, *right)])
            copied.append(copied_path(changed or leaf, path))
            folded.append(copied[-1][-1] if path else changed or leaf)
        return pa.table(
            {
                "key": own.column("key"),
                "leaf": own.column("digest"),
                "subroot": pa.repeat(way["subroot"], len(found)),
                "root": pa.repeat(way["root"], len(found)),
                "siblings": pa.array(siblings, pa.list_(pa.string())),
                "copied": pa.array(copied, pa.list_(pa.string())),
                "folded_root": pa.array(folded, pa.string()),
            }
        )

    own = in_blocks(leaves.select("tree", "at", "height", "key", F.col("leaf").alias("digest"), "changed"), levels)
    return own.groupBy("tree", "block").cogroup(ways.groupBy("tree", "block")).applyInArrow(fold, schema)
