"""The queries of this package, each with the SQL it is checked against where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlens.llm import (
    arc_warc,
    language_id,
    manifest,
    merkle,
    mixing,
    periods,
    pii,
    piece_fst,
    repetition,
    rp_forest,
    simhash,
    toxicity,
    url_trie,
)
from postlens.llm.common import read_table
from postlens.session import materialise

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[function.__name__] = function
    return function


@query
def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(read_table(spark, sf_dir, "documents"))


@query
def op2_arc_to_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return arc_warc.archive_pages(read_table(spark, sf_dir, "pages"))


ORACLES["op2_arc_to_warc"] = """
WITH payloads AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
digests AS (
  SELECT page_id, CAST(octet_length(encode(html)) AS BIGINT) AS payload_bytes, sha1(html) AS hex,
         row_number() OVER (PARTITION BY html ORDER BY page_id) AS nth,
         min(page_id) OVER (PARTITION BY html) AS first
  FROM payloads)
SELECT page_id, payload_bytes,
       list_aggregate(list_transform(range(32), lambda i:
         substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                CAST(((CAST('0x' || substr(hex, CAST(1 + 5 * (i // 4) AS INTEGER), 5) AS INTEGER)
                       >> CAST(15 - 5 * (i % 4) AS INTEGER)) & 31) + 1 AS INTEGER), 1)), 'string_agg', '') AS payload_digest,
       CASE WHEN nth = 1 THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN nth > 1 THEN first END AS refers_to
FROM digests
"""


@query
def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    sizes = materialise(mixing.sized(docs).drop("row"), "mix-sizes")
    return mixing.mix(sizes).drop("party", "tie")


@query
def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_fst.encode_texts(read_table(spark, sf_dir, "documents"))


@query
def op5_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_personal_data(read_table(spark, sf_dir, "documents"))
    return found.withColumn("base_sha256", F.sha2("base_spans", 256)).drop("base_spans")


@query
def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.detect(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


@query
def op7_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.edit_and_compare(read_table(spark, sf_dir, "documents"))


def _root_sql(text: str) -> str:
    """The Merkle root of a text: digests of lines, runs of them, and of the runs' digests."""
    digests = f"list_transform(string_split({text}, chr(10)), lambda x: sha256(x))"
    marked = f"regexp_replace(array_to_string({digests}, ',') || ',', '([01]|b855),', '\\1,|', 'g')"
    runs = f"list_filter(string_split({marked}, '|'), lambda x: x <> '')"
    return f"sha256(array_to_string(list_transform({runs}, lambda x: sha256(x)), ','))"


#: Stands behind the last line of a section; no text of the tables holds it.
_END = "chr(57344)"


def _sections_sql(text: str) -> str:
    """The sections of a text, each as its lines."""
    marked = (
        f"list_transform(string_split({text}, chr(10)), "
        f"lambda x: x || CASE WHEN regexp_matches(sha256(x), '([01]|b855)$') THEN {_END} ELSE '' END)"
    )
    runs = f"string_split(array_to_string({marked}, chr(10)), {_END} || chr(10))"
    return f"list_distinct(list_transform({runs}, lambda x: replace(x, {_END}, '')))"


def _leaves_sql(line: str) -> str:
    words = (
        f"list_transform(string_split({line}, ' '), "
        f"lambda w: w || CASE WHEN substr(md5(w), 1, 1) IN ('0', '1') THEN chr(10) ELSE ' ' END)"
    )
    return f"list_filter(string_split(array_to_string({words}, ''), chr(10)), lambda x: x <> '')"


def _below_sql(nodes: str, others: str, inner: str) -> str:
    """What is below the nodes that the other tree lacks."""
    only = f"list_filter({nodes}, lambda x: NOT list_contains({others}, x))"
    return f"list_distinct(flatten(list_transform({only}, lambda x: {inner})))"


def _length_sql(lines: str) -> str:
    """The length of the leaves of a list of lines."""
    return f"coalesce(list_sum(list_transform({lines}, lambda p: length(array_to_string({_leaves_sql('p')}, '')))), 0)"


def _likeness_sql(pair: str, a: str, b: str) -> str:
    """Tables that descend two trees, given as lists of sections; the last is called like ``pair``."""
    lines = "string_split(x, chr(10))"
    shared = f"flatten(list_transform(list_intersect({a}, {b}), lambda x: {lines}))"
    size = lambda leaves: f"coalesce(list_sum(list_transform({leaves}, lambda x: length(x))), 0)"
    only = lambda one, other: f"list_filter({one}, lambda x: NOT list_contains({other}, x))"
    return f"""{pair}_lines AS (
  SELECT place, {_length_sql(shared)} AS same, {_below_sql(a, b, lines)} AS a, {_below_sql(b, a, lines)} AS b FROM parts),
{pair}_leaves AS (
  SELECT place, same + {_length_sql("list_intersect(a, b)")} AS same, {_below_sql("a", "b", _leaves_sql("x"))} AS a,
         {_below_sql("b", "a", _leaves_sql("x"))} AS b FROM {pair}_lines),
{pair}_sums AS (
  SELECT place, same + {size("list_intersect(a, b)")} AS same, {size(only("a", "b"))} + {size(only("b", "a"))} AS rest
  FROM {pair}_leaves),
{pair} AS (SELECT place, 2 * same / (2 * same + rest) AS likeness FROM {pair}_sums)"""


ORACLES["op7_merkle"] = f"""
WITH texts AS (
  SELECT doc_id, coalesce(text, '') AS body, row_number() OVER (ORDER BY doc_id DESC) AS place, count(*) OVER () AS n
  FROM documents),
pairs AS (
  SELECT a.doc_id, a.place, a.body, b.doc_id AS next_id, b.body AS following, CAST(length(a.body) // 3 AS BIGINT) AS third
  FROM texts a JOIN texts b ON b.place = a.place % a.n + 1),
edits AS (
  SELECT *, substr(body, 1, length(body) - third) || substr(following, 1, third) AS edited FROM pairs),
parts AS (
  SELECT *, {_sections_sql("body")} AS own, {_sections_sql("edited")} AS changed, {_sections_sql("following")} AS ahead,
         string_split(body, chr(10)) AS lines, string_split(edited, chr(10)) AS edited_lines FROM edits),
{_likeness_sql("to_edited", "own", "changed")},
{_likeness_sql("to_next", "own", "ahead")}
SELECT doc_id, CAST(length(body) AS BIGINT) AS n_chars, sha256(edited) AS edited_sha256, {_root_sql("body")} AS fingerprint,
       {_root_sql("edited")} AS edited_fingerprint, e.likeness AS near_edited, f.likeness AS near_next, next_id,
       coalesce(list_min(list_filter(range(1, greatest(len(lines), len(edited_lines)) + 1),
         lambda i: lines[i] IS DISTINCT FROM edited_lines[i])), 0) AS first_changed_paragraph,
       len(lines) AS n_paragraphs
FROM parts JOIN to_edited e USING (place) JOIN to_next f USING (place)
"""


@query
def op8_suffix_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition.repetition(read_table(spark, sf_dir, "documents"))


#: The rules that the pages are judged by.
URL_RULES = [
    (url_trie.BLOCK, "net", "/"),
    (url_trie.ALLOW, "example.net", "/en/"),
    (url_trie.BLOCK, "example.com", "/de/"),
    (url_trie.ALLOW, "org", "/fr/"),
]


@query
def op9_url_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_trie.filter_urls(read_table(spark, sf_dir, "pages"), URL_RULES)


ORACLES["op9_url_trie"] = """
WITH urls AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
parts AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')
           AS host, regexp_extract(rest, '^[^/?#]*(/[^?#]*)', 1) AS path
  FROM urls),
rules(verdict, host, path) AS (
  VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'),
         ('allow', 'org', '/fr/')),
fits AS (
  SELECT p.page_id, r.host || r.path AS rule, r.verdict,
         row_number() OVER (PARTITION BY p.page_id, p.host, p.path
                            ORDER BY len(string_split(r.host, '.')) DESC, length(r.path) DESC) AS nth
  FROM parts p JOIN rules r ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path))
SELECT p.page_id, p.host, p.path, f.rule, coalesce(f.verdict, 'allow') AS verdict
FROM parts p LEFT JOIN fits f ON f.page_id = p.page_id AND f.nth = 1
"""


@query
def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    found = simhash.near_duplicates(docs, shingle=4, distance=4)
    return found.select("doc_id", simhash.fingerprint_hex().alias("fingerprint"), "component_id")


@query
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = periods.find_runs(periods.with_planted_runs(docs))
    lines = F.transform("runs", lambda run: F.concat_ws(",", run["start"], run["length"], run["period"]))
    order = F.array_min(F.transform("runs", lambda run: F.struct(-run["length"], run["start"], run["period"])))
    # Structs name their fields by position here.
    length, start, period = -order["col1"], order["start"], order["period"]
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        start.alias("start"),
        length.alias("length"),
        period.alias("period"),
        F.floor(1000 * length / period).alias("exponent_milli"),
        F.sha2(F.array_join(F.transform(lines, lambda line: F.concat(line, F.lit("\n"))), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
        "n_words",
    )


@query
def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = manifest.versions(manifest.document_leaves(read_table(spark, sf_dir, "documents")))
    return found.select(
        F.col("key").alias("doc_id"),
        "leaf",
        "subroot",
        "root",
        F.sha2(F.array_join("siblings", ""), 256).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


def _crc32_sql(text: str) -> str:
    digits = f"list_transform(string_split({text}, ''), lambda x: CAST(ascii(x) AS BIGINT))"
    turns = "lambda d, z: xor(d >> 1, 3988292384 * (d & 1))"
    zeros = "[CAST(0 AS BIGINT), 0, 0, 0, 0, 0, 0, 0]"
    step = f"lambda c, b: list_reduce(list_concat([xor(c, b)], {zeros}), {turns})"
    return f"xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)], {digits}), {step}), 4294967295)"


def _in_leaf_sql(value: str) -> str:
    return f"coalesce(CAST(strlen(CAST({value} AS VARCHAR)) AS VARCHAR) || ':' || CAST({value} AS VARCHAR), '-')"


_HEAD_SQL = " || ".join(map(_in_leaf_sql, ("doc_id", "source", "lang", "n_chars")))
_LOWER_SQL = f"translate(text, '{manifest.UPPER}', '{manifest.LOWER}')"
_LEVEL_SQL = """SELECT tree, lvl + 1, pos // 8, sha256(string_agg(digest, '' ORDER BY pos)), max((n + 7) // 8)
  FROM {0} WHERE n > 1 GROUP BY tree, lvl, pos // 8"""

ORACLES["op12_merkle_manifest"] = f"""
WITH RECURSIVE leaves AS (
  SELECT doc_id, lang, sha256({_HEAD_SQL} || {_in_leaf_sql("text")}) AS leaf,
         CASE WHEN {_crc32_sql("CAST(doc_id AS VARCHAR)")} % 3 = 0
              THEN sha256({_HEAD_SQL} || {_in_leaf_sql(_LOWER_SQL)}) END AS changed
  FROM documents),
placed AS (
  SELECT *, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree, count(*) OVER (PARTITION BY lang) AS n,
         row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos
  FROM leaves),
nodes(tree, lvl, pos, digest, n) AS (
  SELECT tree, 0, pos, leaf, n FROM placed UNION ALL {_LEVEL_SQL.format("nodes")}),
forest(tree, lvl, pos, digest, n) AS (
  SELECT 0, 0, tree, digest, count(*) OVER () FROM nodes WHERE n = 1 UNION ALL {_LEVEL_SQL.format("forest")}),
steps AS (
  SELECT p.doc_id, p.leaf, p.pos, p.tree, s.lvl, s.pos AS place, s.digest, p.pos >> (3 * s.lvl) AS own
  FROM placed p JOIN nodes s ON s.tree = p.tree AND s.n > 1 AND s.pos >> 3 = p.pos >> (3 * s.lvl + 3)
  UNION ALL
  SELECT p.doc_id, p.leaf, p.pos, p.tree, 100 + s.lvl, s.pos, s.digest, p.tree >> (3 * s.lvl)
  FROM placed p JOIN forest s ON s.n > 1 AND s.pos >> 3 = p.tree >> (3 * s.lvl + 3)),
sides AS (
  SELECT tree, pos, lvl, coalesce(string_agg(digest, '' ORDER BY place) FILTER (place < own), '') AS left_side,
         coalesce(string_agg(digest, '' ORDER BY place) FILTER (place > own), '') AS right_side
  FROM steps GROUP BY tree, pos, lvl),
proofs AS (
  SELECT tree, pos, string_agg(left_side || right_side, '' ORDER BY lvl) AS proof,
         list(left_side || '|' || right_side ORDER BY lvl) AS path
  FROM sides GROUP BY tree, pos),
folded AS (
  SELECT p.doc_id, p.leaf, s.digest AS subroot, r.digest AS root, sha256(coalesce(f.proof, '')) AS proof_sha256,
         list_reduce(list_concat([coalesce(p.changed, p.leaf)], coalesce(f.path, [])),
           lambda a, x: sha256(split_part(x, '|', 1) || a || split_part(x, '|', 2))) AS folded_root
  FROM placed p JOIN nodes s ON s.tree = p.tree AND s.n = 1 JOIN forest r ON r.n = 1
  LEFT JOIN proofs f ON f.tree = p.tree AND f.pos = p.pos)
SELECT *, folded_root = root AS verified FROM folded
"""


@query
def op13_vector_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rp_forest.near_duplicates(read_table(spark, sf_dir, "embeddings"))
