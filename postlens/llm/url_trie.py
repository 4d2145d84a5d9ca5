"""URL filters: a trie over reversed host labels, each node with a trie of path segments.

A rule names a host and a path and holds for the host and all hosts below it, if the URL's path starts
with the rule's. Of the rules that fit, the one with the most host labels wins, of these the one with
the longest path; two rules for the same host and path must agree. A URL that no rule fits gets the
default verdict.

Rules come from a table of any number of rows up to ``max_bytes`` in all; more are refused, since the
trie is broadcast. Every URL walks it once: the cost is its labels and path segments, not the rules.

Defined results: a null URL, or one without ``://``, has an empty host and path and fits no rule;
repeated rows are judged one by one; an empty table of rules leaves the default verdict.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK, ALLOW = "block", "allow"
MAX_BYTES = 64 << 20

#: ASCII letters only, as URLs are compared.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

Rule = tuple[str, str, str]


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case. Path: from
    there up to ``?``, ``#`` or the end."""
    at = F.coalesce(F.locate("://", url), F.lit(0))
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    before_query = F.regexp_extract(rest, r"(?s)^[^?#]*", 0)
    host = F.translate(F.regexp_extract(before_query, r"(?s)^[^/]*", 0), UPPER, LOWER)
    return host, F.regexp_extract(before_query, r"(?s)/.*$", 0)


def build_trie(rules: Iterable[Rule]) -> dict:
    """Nodes are dicts: label → node; under ``""`` the paths of the host: segment → node, and under None
    the rules that end inside a segment as ``(rest of the segment, rule, verdict)``, longest first."""
    root: dict = {}
    for verdict, host, path in rules:
        if verdict not in (BLOCK, ALLOW):
            raise ValueError(f"a rule must say {BLOCK} or {ALLOW}, not {verdict!r}")
        node = root
        for label in reversed(host.translate(str.maketrans(UPPER, LOWER)).split(".")):
            node = node.setdefault("." + label, {})
        node = node.setdefault("", {})
        *segments, rest = path.split("/")
        for segment in segments:
            node = node.setdefault("/" + segment, {})
        ends = node.setdefault(None, [])
        if any(known == rest and said != verdict for known, _, said in ends):
            raise ValueError(f"rules disagree on {host}{path}")
        ends.append((rest, host + path, verdict))
        ends.sort(key=lambda end: -len(end[0]))
    return root


def longest_path(node: dict, path: str) -> tuple[str, str] | None:
    best, at = None, 0
    while True:
        for rest, rule, verdict in node.get(None, ()):
            if path.startswith(rest, at):
                best = (rule, verdict)
                break
        cut = path.find("/", at)
        if cut < 0 or (node := node.get("/" + path[at:cut])) is None:
            return best
        at = cut + 1


def judge(trie: dict, host: str, path: str) -> tuple[str | None, str | None]:
    """Rule and verdict of the longest match, or two Nones."""
    best, node = None, trie
    for label in reversed(host.split(".")):
        node = node.get("." + label)
        if node is None:
            break
        if "" in node:
            best = longest_path(node[""], path) or best
    return best or (None, None)


def checked(rules: list[Rule], max_bytes: int = MAX_BYTES) -> list[Rule]:
    """The rules, if a trie of them may be broadcast: the same measure as for the rules of a table."""
    total = sum(len(f"{host}{path}".encode()) + 16 for _, host, path in rules)
    if total > max_bytes:
        raise ValueError(f"the rules take {total} bytes; a trie of at most {max_bytes} is broadcast")
    return rules


def bounded_rules(rules: DataFrame, max_bytes: int = MAX_BYTES) -> list[Rule]:
    """The rules ``(verdict, host, path)`` of a table, after a check of their size."""
    size = F.sum(F.octet_length("host") + F.octet_length("path") + 16)
    total = rules.agg(size).first()[0] or 0
    if total > max_bytes:
        raise ValueError(f"the rules take {total} bytes; a trie of at most {max_bytes} is broadcast")
    return [tuple(row) for row in rules.select("verdict", "host", "path").collect()]


def filter_urls(
    pages: DataFrame,
    rules: list[Rule],
    default: str = ALLOW,
    key: str = "page_id",
    url: str = "url",
    max_bytes: int = MAX_BYTES,
) -> DataFrame:
    """``(key, host, path, rule, verdict)`` for every row. Rules of over ``max_bytes`` are an error."""
    host, path = host_and_path(F.col(url).cast("string"))
    parts = pages.select(F.col(key).alias("key"), host.alias("host"), path.alias("path"))
    trie = pages.sparkSession.sparkContext.broadcast(build_trie(checked(rules, max_bytes)))
    schema = f"key {parts.schema['key'].dataType.simpleString()}, host string, path string, rule string, verdict string"

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = trie.value
        for batch in batches:
            hosts, paths = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            found = [judge(known, *pair) for pair in zip(hosts, paths, strict=True)]
            rule = pa.array([one[0] for one in found], pa.string())
            verdict = pa.array([one[1] or default for one in found], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, rule, verdict], schema=pa.schema(
                [*batch.schema, pa.field("rule", pa.string()), pa.field("verdict", pa.string())]
            ))

    return parts.mapInArrow(run, schema).withColumnRenamed("key", key)
