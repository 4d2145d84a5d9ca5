"""Document fingerprints: a Merkle tree over leaves, paragraphs and sections.

A paragraph is a line; its digest is the SHA-256 of its text. A section is a run of paragraphs that ends
at an empty paragraph or where a paragraph's digest ends in 0 or 1 (of every eight, one), so an edit
changes the sections it touches and no others. A section's digest is that of its paragraphs' digests;
the root, which is the fingerprint, is that of the sections' digests. Equal texts have equal roots, and
texts with equal roots have equal digests all the way down.

Below a paragraph are its leaves: runs of words, cut behind every word whose MD5 begins with 0 or 1. The
borders follow from the words alone, so a text without any sentence mark or line end has leaves too, and
an edit changes those that it touches. A word counts with the space behind it, the last one of a leaf without.

Two trees are compared from the top. Sections found in both are alike as a whole; only those of one tree
are opened, then only the paragraphs that differ, down to their leaves. The likeness is the
share of both trees' length that was found in both: twice the common length by that and the leaves of one only. The first changed paragraph
is found the same way: in the first section that differs.

All of it is native expressions. Defined results: a null text counts as empty; its tree is that of one
empty paragraph; repeated rows are fingerprinted one by one; nodes that repeat in a tree count once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postlens.llm.common import with_positions
from postlens.session import materialise

#: The empty paragraph's digest ends like this.
EMPTY_END = "b855"
SECTION_END = rf"(?<=[01],|{EMPTY_END},)"
#: A word whose digest begins so ends a leaf.
LEAF_END = ["0", "1"]


def paragraph_digests(text: Column) -> Column:
    return F.transform(F.split(text, "\n", -1), lambda line: F.sha2(line, 256))


def section_digests(paragraphs: Column) -> Column:
    runs = F.split(F.concat(F.array_join(paragraphs, ","), F.lit(",")), SECTION_END, -1)
    return F.transform(F.filter(runs, lambda run: run != ""), lambda run: F.sha2(run, 256))


def root(sections: Column) -> Column:
    return F.sha2(F.array_join(sections, ","), 256)


def leaf_codes(line: Column) -> Column:
    """The leaves of a paragraph in one text: hash and length of each, parted by spaces. There is at least one."""
    ends = lambda word: F.substring(F.md5(word), 1, 1).isin(LEAF_END)
    words = F.transform(F.split(line, " ", -1), lambda word: F.concat(word, F.when(ends(word), "\n").otherwise(" ")))
    leaves = F.filter(F.split(F.array_join(words, ""), "\n", -1), lambda leaf: leaf != "")
    codes = F.transform(leaves, lambda leaf: F.concat(F.hex(F.xxhash64(leaf)), F.lit("."), F.length(leaf).cast("string")))
    return F.array_join(codes, " ")


def tree(text: Column) -> Column:
    """The sections of a text; each holds its paragraphs, parted by commas, and these their leaves."""

    def node(line: Column) -> Column:
        ends = F.sha2(line, 256).rlike(f"([01]|{EMPTY_END})$")
        return F.concat(leaf_codes(line), F.when(ends, ";").otherwise(","))

    sections = F.split(F.array_join(F.transform(F.split(text, "\n", -1), node), ""), ";", -1)
    # A section that the end of the text cuts off is the same as one with an end of its own.
    return F.filter(F.transform(sections, lambda section: F.rtrim(section, F.lit(","))), lambda section: section != "")


def weight(nodes: Column) -> Column:
    """The length of all leaves below some nodes of any level."""
    codes = F.filter(F.split(F.array_join(nodes, ","), "[ ,]", -1), lambda code: code != "")
    length = lambda code: F.substring_index(code, ".", -1).cast("long")
    return F.aggregate(codes, F.lit(0).cast("long"), lambda total, code: total + length(code))


def opened(nodes: Column, mark: str) -> Column:
    """What is one level below some nodes; no node at all gives one without length."""
    return F.split(F.array_join(nodes, mark), mark, -1)


def with_likeness(rows: DataFrame, a: str, b: str, name: str) -> DataFrame:
    """The likeness of the trees in two columns, by descending from the sections that differ."""
    common = []
    left, right = F.col(a), F.col(b)
    for level, mark in (("sections", ","), ("paragraphs", " ")):
        common.append(F.array_intersect(left, right))
        below = {f"_{level}_a": opened(F.array_except(left, right), mark), f"_{level}_b": opened(F.array_except(right, left), mark)}
        rows = rows.withColumns({f"_same_{level}": weight(common[-1]), **below})
        left, right = F.col(f"_{level}_a"), F.col(f"_{level}_b")
    same = F.col("_same_sections") + F.col("_same_paragraphs") + weight(F.array_intersect(left, right))
    rest = weight(F.array_except(left, right)) + weight(F.array_except(right, left))
    rows = rows.withColumns({"_same": same, "_rest": rest})
    rows = rows.withColumn(name, 2 * F.col("_same") / (2 * F.col("_same") + F.col("_rest")))
    working = [f"_{level}_{side}" for level in ("sections", "paragraphs") for side in "ab"]
    return rows.drop("_same", "_rest", "_same_sections", "_same_paragraphs", *working)


def first_different(a: Column, b: Column) -> Column:
    """The place (from 1) of the first entries that differ; 0 if none do."""
    same = F.zip_with(a, b, lambda x, y: x.eqNullSafe(y))
    return F.coalesce(F.array_position(same, F.lit(False)), F.lit(0)).cast("int")


def with_first_difference(rows: DataFrame, a: str, b: str, name: str) -> DataFrame:
    """The number (from 1) of the first paragraph that differs, 0 if none does: it lies in the first section that
    differs, behind the paragraphs of the sections before."""
    rows = rows.withColumn("_at", first_different(F.col(a), F.col(b)))
    before = F.aggregate(
        F.slice(a, F.lit(1), F.greatest(F.col("_at") - 1, F.lit(0))), F.lit(0), lambda n, one: n + F.size(F.split(one, ",", -1))
    )
    section = lambda tree: F.split(F.get(tree, F.greatest(F.col("_at") - 1, F.lit(0))), ",", -1)
    empty = F.array().cast("array<string>")
    inside = first_different(F.coalesce(section(F.col(a)), empty), F.coalesce(section(F.col(b)), empty))
    return rows.withColumn(name, F.when(F.col("_at") == 0, 0).otherwise(before + inside)).drop("_at")


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, fingerprint, sections, paragraphs)`` of every whole text."""
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    leaves = docs.select(F.col(key).alias("key"), paragraph_digests(body).alias("paragraphs"))
    whole = leaves.withColumn("sections", section_digests(F.col("paragraphs")))
    return whole.select(
        F.col("key").alias(key), root(F.col("sections")).alias("fingerprint"), "sections", "paragraphs"
    )


def neighbours(docs: DataFrame) -> DataFrame:
    """``(id, next_id, part, least)``: for every id the next one in descending order (after the last the first;
    null comes last), a third of its longest text's length, and the least hash of the next one's texts. Ids are
    narrow: no text is moved."""
    third = F.floor(F.length("body") / 3).cast("int")
    ids = docs.groupBy("doc_id").agg(F.max(third).alias("part"), F.min(F.xxhash64("body")).alias("least"))
    placed = with_positions(ids, [F.col("doc_id").desc_nulls_last()], "place", "merkle-ids")
    placed = materialise(placed, "merkle-places")
    count = max(1, placed.count())
    after = F.pmod(F.col("place") - 1, F.lit(count)).cast("long")
    following = placed.select(after.alias("place"), text_key("doc_id").alias("next_id"), "least")
    return placed.drop("least").join(following, "place").select(text_key("doc_id").alias("id"), "next_id", "part", "least")


def text_key(column: str) -> Column:
    """An id as text, never null, so that rows without an id meet in joins too; they meet no other."""
    return F.coalesce(F.concat(F.lit("="), F.col(column).cast("string")), F.lit("-"))


def edit_and_compare(docs: DataFrame) -> DataFrame:
    """Every text against an edited one (its last third replaced by the start of the next document) and
    against the next document. Of rows that repeat an id, the next document is the one whose text has the least
    hash.

    Texts are shuffled once, by id; both sides of the comparison read that one exchange, and only the
    part that the edit needs and the tree go on to the document before.
    """
    docs = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("body"))
    links = materialise(neighbours(docs), "merkle-links")
    own = docs.select(text_key("doc_id").alias("id"), "doc_id", "body")
    chosen = (
        own.join(links.select(F.col("id").alias("target"), F.col("next_id").alias("id"), "part", "least"), "id")
        # None is below the least; an equality would become a key of the join and cost texts an exchange of their own.
        .filter(F.xxhash64("body") <= F.col("least"))
        .select(
            F.col("target").alias("id"),
            F.col("doc_id").alias("next_id"),
            F.substr("body", F.lit(1), F.col("part")).alias("start"),
            tree(F.col("body")).alias("next_tree"),
        )
    )
    # Rows left of one id have the same text; map tasks keep one of them.
    ahead = chosen.groupBy("id").agg(*[F.first(name).alias(name) for name in ("next_id", "start", "next_tree")])
    third = F.floor(F.col("n_chars") / 3).cast("int")
    both = own.join(ahead, "id").withColumn("n_chars", F.length("body").cast("long"))
    both = both.withColumn(
        "edited", F.concat(F.left("body", F.col("n_chars").cast("int") - third), F.left("start", third))
    ).drop("start")
    both = both.withColumns({
        "paragraphs": paragraph_digests(F.col("body")),
        "edited_paragraphs": paragraph_digests(F.col("edited")),
        "tree": tree(F.col("body")),
        "edited_tree": tree(F.col("edited")),
    })
    made = both.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        root(section_digests(F.col("paragraphs"))).alias("fingerprint"),
        root(section_digests(F.col("edited_paragraphs"))).alias("edited_fingerprint"),
        "next_id",
        F.size("paragraphs").alias("n_paragraphs"),
        "tree",
        "edited_tree",
        "next_tree",
    )
    compared = with_likeness(with_likeness(made, "tree", "edited_tree", "near_edited"), "tree", "next_tree", "near_next")
    compared = with_first_difference(compared, "tree", "edited_tree", "first_changed_paragraph")
    return compared.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        "fingerprint",
        "edited_fingerprint",
        "near_edited",
        "near_next",
        "next_id",
        "first_changed_paragraph",
        "n_paragraphs",
    )
