"""Legacy ARC archives to WARC.

An ARC record is one header line and as many bytes as it declares. Version 1 lines hold URL, address,
date, content type and length; version 2 lines hold result code, checksum, location, offset and file name
before the length. A file starts with a ``filedesc`` record that names its version.

From these the WARC counterpart is made: the type (``response`` for what begins with an HTTP status line,
``warcinfo`` for ``filedesc``, else ``resource``), an ISO date, an identifier that follows from URL, date
and payload (so that a second run makes the same), and the SHA-1 of the payload in base 32. Of records
with equal payloads, the one with the smallest key stays a response, the others become ``revisit``
records without a payload.

Records are written and read by Spark's own sources, so archives may lie wherever Spark can write: the
text sink puts the separator of WARC records between them. A revisit carries the length of its payload
and the key of its response in header lines of its own (``X-``).

Defined results: a null payload is empty; a null URL becomes ``urn:page:`` and the key; white space in a
URL is percent-coded; rows that repeat key, URL and payload are a response and revisits of it; a null key
comes after all others. A record shorter than it declares is an error.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import uuid
from base64 import b32encode
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from typing import BinaryIO

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from postlens.session import materialise, scratch_path

#: Formats of the two archive kinds.
ARC_FIELDS = {
    1: ["url", "ip", "date", "mime", "length"],
    2: ["url", "ip", "date", "mime", "status", "checksum", "location", "offset", "filename", "length"],
}
RECORD_END = "\r\n\r\n"
IDENTICAL = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORDS_PER_FILE = 4000


@dataclass(frozen=True)
class ArcRecord:
    fields: dict[str, str]
    content: bytes


def parse_header(line: bytes, version: int) -> dict[str, str]:
    """The fields of a header line; a URL may hold spaces, the others may not."""
    names = ARC_FIELDS[version]
    values = line.decode("utf-8", "replace").rsplit(" ", len(names) - 1)
    if len(values) != len(names) or not values[-1].isdigit():
        raise ValueError(f"no ARC header of version {version}: {line[:200]!r}")
    return dict(zip(names, values, strict=True))


def parse_records(stream: BinaryIO, version: int | None = None) -> Iterator[ArcRecord]:
    """The records of an ARC stream, one at a time; without a version the first must be a ``filedesc``."""
    while line := stream.readline():
        line = line.rstrip(b"\r\n")
        if not line:
            continue
        fields = parse_header(line, version or 1)
        content = stream.read(int(fields["length"]))
        if len(content) < int(fields["length"]):
            raise ValueError(f"{fields['url']} declares {fields['length']} bytes and has {len(content)}")
        if version is None:
            first = content.split(b"\n", 1)[0].split(b" ")[0]
            if not fields["url"].startswith("filedesc:") or not first.isdigit() or int(first) not in ARC_FIELDS:
                raise ValueError("the archive does not start with a filedesc record of version 1 or 2")
            version = int(first)
        yield ArcRecord(fields, content)


def split_http(content: bytes) -> tuple[bytes, bytes]:
    """HTTP header with the empty line after it, and the payload."""
    if not content.startswith(b"HTTP/"):
        return b"", content
    ends = [at + len(mark) for mark in (b"\r\n\r\n", b"\n\n") if (at := content.find(mark)) >= 0]
    end = min(ends, default=len(content))
    return content[:end], content[end:]


def iso_date(date: str) -> str:
    """14 digits, or fewer with the rest at its least."""
    least = "19700101000000"
    date = (date + least[len(date) :])[:14] if date.isdigit() else least
    return f"{date[:4]}-{date[4:6]}-{date[6:8]}T{date[8:10]}:{date[10:12]}:{date[12:14]}Z"


def payload_digest(payload: bytes) -> str:
    return b32encode(hashlib.sha1(payload).digest()).decode()


def warc_type(record: ArcRecord) -> str:
    if record.fields["url"].startswith("filedesc:"):
        return "warcinfo"
    return "response" if record.content.startswith(b"HTTP/") else "resource"


def converted(record: ArcRecord) -> tuple:
    """What the WARC record needs: uri, type, date, id, digest, payload length, HTTP header, payload."""
    head, payload = split_http(record.content)
    digest, date = payload_digest(payload), iso_date(record.fields["date"])
    name = uuid.uuid5(uuid.NAMESPACE_URL, f"{record.fields['url']} {date} {digest}")
    return (record.fields["url"], warc_type(record), date, f"urn:uuid:{name}", digest, len(payload), head, payload)


CONVERTED = "uri string, kind string, date string, record_id string, digest string, payload_bytes long"


def convert(arcs: DataFrame, payloads: bool) -> DataFrame:
    """WARC facts of the ARC records in the frame ``(key, version, arc)``; each ``arc`` holds one or more
    whole records, of the given version or (null) with a ``filedesc`` in front. With ``payloads``, the
    block of HTTP header and payload is given too."""
    kind = arcs.schema["key"].dataType.simpleString()
    schema = f"key {kind}, {CONVERTED}" + (", block binary" if payloads else "")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                rows, owners = [], []
                versions, arc = part.column(1).to_pylist(), part.column(2).to_pylist()
                for at, (version, data) in enumerate(zip(versions, arc, strict=True)):
                    for record in parse_records(open_bytes(data), version):
                        rows.append(converted(record))
                        owners.append(at)
                keys = part.column(0).take(pa.array(owners, pa.int64()))
                columns = list(zip(*rows, strict=True)) or [[] for _ in range(8)]
                arrays = [keys, *[pa.array(column, pa.string()) for column in columns[:5]], pa.array(columns[5], pa.int64())]
                names = ["key", "uri", "kind", "date", "record_id", "digest", "payload_bytes"]
                if payloads:
                    blocks = [head + payload for head, payload in zip(columns[6], columns[7], strict=True)]
                    arrays, names = [*arrays, pa.array(blocks, pa.binary())], [*names, "block"]
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    return arcs.select("key", "version", "arc").mapInArrow(run, schema)


def open_bytes(data: bytes) -> BinaryIO:
    plain = io.BytesIO(data)
    return gzip.GzipFile(fileobj=plain) if data[:2] == b"\x1f\x8b" else plain


def header(fields: list[tuple[str, Column]]) -> Column:
    """Header lines; those without a value are left out. The empty line follows."""
    lines = [F.concat(F.lit(f"{name}: "), value.cast("string")) for name, value in fields]
    return F.concat(F.concat_ws("\r\n", F.lit("WARC/1.1"), *lines), F.lit("\r\n\r\n"))


def records(arcs: DataFrame) -> DataFrame:
    """One column ``value``: the WARC records of the ARC records.

    Which record of a payload is the response is decided on narrow rows: copies are counted by key before
    they meet, and the first of each digest is a minimum. Only then the payloads are matched with the
    records that keep one, by a key that no two different records share.
    """
    same = ["key", "uri", "kind", "date", "record_id", "digest", "payload_bytes"]
    facts = materialise(convert(arcs, False), "warc-facts")
    counted = facts.groupBy(*same).agg(F.count(F.lit(1)).alias("copies"))
    order = F.struct(F.col("key").isNull().alias("none"), "key", "uri", "date", "record_id")
    firsts = facts.groupBy("digest").agg(F.min(order).alias("first"))
    firsts = materialise(firsts, "warc-firsts")
    own = F.coalesce(F.col("key").cast("string"), F.lit(""))
    first_own = F.coalesce(F.col("first.key").cast("string"), F.lit(""))
    is_first = (F.col("record_id") == F.col("first.record_id")) & (own == first_own)
    rest = F.col("copies") - F.when(is_first, 1).otherwise(0)
    repeats = (
        counted.join(firsts, "digest")
        .withColumn("copy", F.explode(F.sequence(F.lit(1), F.greatest(rest, F.lit(1)))))
        .filter(rest > 0)
    )
    shared = [
        ("WARC-Target-URI", F.col("uri")),
        ("WARC-Date", F.col("date")),
        ("WARC-Record-ID", F.concat(F.lit("<"), F.col("record_id"), F.lit(">"))),
        ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        ("X-Page-ID", F.col("key")),
        ("X-Payload-Length", F.col("payload_bytes")),
    ]
    revisits = header(
        [
            ("WARC-Type", F.lit("revisit")),
            *shared,
            ("WARC-Profile", F.lit(IDENTICAL)),
            ("WARC-Refers-To", F.concat(F.lit("<"), F.col("first.record_id"), F.lit(">"))),
            ("X-Refers-To-Page", F.col("first.key")),
            ("Content-Length", F.lit(0)),
        ]
    )
    keepers = firsts.select(F.col("first.record_id").alias("record_id"), first_own.alias("own"), F.lit(True).alias("keeps"))
    block = convert(arcs, True).withColumn("own", own).join(keepers, ["record_id", "own"])
    first_copy = F.row_number().over(Window.partitionBy("record_id", "own").orderBy("record_id"))
    kept = block.withColumn("nth", first_copy).filter("nth = 1")
    media = F.when(F.col("kind") == "response", "application/http; msgtype=response").otherwise("application/octet-stream")
    responses = header(
        [
            ("WARC-Type", F.col("kind")),
            *shared,
            ("Content-Type", media),
            ("Content-Length", F.octet_length("block")),
        ]
    )
    whole = kept.select(F.concat(responses, F.col("block").cast("string")).alias("value"))
    return whole.union(repeats.select(revisits.alias("value")))


def write_warc(lines: DataFrame, path: str, records_per_file: int = RECORDS_PER_FILE) -> None:
    """Gzipped archives of at most ``records_per_file`` records each."""
    lines.write.option("lineSep", RECORD_END).option("compression", "gzip").option(
        "maxRecordsPerFile", records_per_file
    ).text(path)


def parse_warc(stream: BinaryIO) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields and block of each record, by its declared length."""
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no WARC record: {line[:100]!r}")
        fields = {}
        while (line := stream.readline().rstrip(b"\r\n")):
            name, _, value = line.decode("utf-8", "replace").partition(":")
            fields[name.strip().lower()] = value.strip()
        length = int(fields["content-length"])
        block = stream.read(length)
        if len(block) < length:
            raise ValueError(f"{fields.get('warc-record-id')} is cut short")
        yield fields, block


READ = "page_id string, kind string, uri string, digest string, payload_bytes long, refers_to string"


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """The records of a folder of archives. Digests of payloads are made anew and must agree."""
    files = spark.read.format("binaryFile").load(path).select("content")

    def rows(data: bytes) -> Iterator[tuple]:
        for fields, block in parse_warc(open_bytes(data)):
            told = fields.get("warc-payload-digest", "").removeprefix("sha1:")
            size = int(fields.get("x-payload-length", len(block)))
            if fields["warc-type"] != "revisit":
                payload = split_http(block)[1]
                size, found = len(payload), payload_digest(payload)
                if told != found:
                    raise ValueError(f"{fields['warc-record-id']}: digest {told}, payload {found}")
            yield (
                fields.get("x-page-id"), fields["warc-type"], fields.get("warc-target-uri"), told, size,
                fields.get("x-refers-to-page"),
            )

    names = ["page_id", "kind", "uri", "digest", "payload_bytes", "refers_to"]
    kinds = [pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string()]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column(0):
                columns = list(zip(*rows(data.as_py()), strict=True)) or [[] for _ in names]
                arrays = [pa.array(column, kind) for column, kind in zip(columns, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    return files.mapInArrow(run, READ)


def read_arc_files(spark: SparkSession, path: str) -> DataFrame:
    """``(key, version, arc)`` of ARC files, plain or gzipped: the file's path, null and its bytes. One
    file is held in memory at a time, so files should be of the usual 100 MB."""
    files = spark.read.format("binaryFile").load(path)
    return files.select(F.col("path").alias("key"), F.lit(None).cast("int").alias("version"), F.col("content").alias("arc"))


def page_arcs(pages: DataFrame, archived: str = "20240101000000", key: str = "page_id") -> DataFrame:
    """Pages as ARC records: odd keys in version 1, even ones in version 2."""
    named = F.coalesce(F.col("url").cast("string"), F.concat(F.lit("urn:page:"), F.coalesce(F.col(key).cast("string"), F.lit(""))))
    url = F.regexp_replace(named, r"[\x00-\x20\x7F]", "%20")
    head = "HTTP/1.0 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
    content = F.concat(F.lit(head).cast("binary"), F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary"))
    version = F.when(F.pmod(F.coalesce(F.col(key).cast("long"), F.lit(0)), F.lit(2)) == 1, 1).otherwise(2)
    common = [url, F.lit("0.0.0.0"), F.lit(archived), F.lit("text/html")]
    length = F.octet_length(content).cast("string")
    first = F.concat_ws(" ", *common, length)
    second = F.concat_ws(" ", *common, *[F.lit(field) for field in ("200", "-", "-", "0", "pages.arc")], length)
    line = F.concat(F.when(version == 1, first).otherwise(second), F.lit("\n"))
    arc = F.concat(line.cast("binary"), content, F.lit("\n").cast("binary"))
    return pages.select(F.col(key).alias("key"), version.alias("version"), arc.alias("arc"))


def archive_pages(pages: DataFrame, path: str | None = None) -> DataFrame:
    """Writes the pages as WARC archives by way of ARC and returns what is read back, a row a page."""
    spark = pages.sparkSession
    path = path or scratch_path(spark, "warc")
    write_warc(records(page_arcs(pages)), path)
    kind = pages.schema["page_id"].dataType
    return read_warc(spark, path).select(
        F.col("page_id").cast(kind).alias("page_id"),
        "payload_bytes",
        F.col("digest").alias("payload_digest"),
        F.col("kind").alias("record_type"),
        F.col("refers_to").cast(kind).alias("refers_to"),
    )
