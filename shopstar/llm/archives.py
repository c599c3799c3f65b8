"""Legacy ARC archives, and their conversion to WARC."""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from shopstar.llm.tables import Spool

# Fixed by the formats: fields of a record's first line, by version of the archive.
ARC_FIELDS = {
    1: ("url", "ip", "date", "mime", "length"),
    2: ("url", "ip", "date", "mime", "result", "checksum", "location", "offset", "filename", "length"),
}
ARC_NAMES = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
PAGE_ID = b"X-Page-Id"


@dataclass(frozen=True)
class Archives:
    """records_per_file: entries of an archive, its own description included."""

    records_per_file: int = 4_000
    arc_version: int = 2
    revisit_bytes: int = 1_000
    date: str = "20200101000000"
    ip: str = "192.0.2.1"


def _batches(rows: Iterator[tuple], schema: pa.Schema, most: int = 4_000_000) -> Iterator[pa.RecordBatch]:
    """Rows as batches of about `most` bytes; bytes values count, others do not."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += 64 + sum(len(v) for v in row if isinstance(v, bytes))
        if size > most:
            yield _batch(held, schema)
            held, size = [], 0
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(columns, schema.types, strict=True)], schema=schema)


def _with_heads(entries: Iterator[bytes], head: bytes, every: int) -> Iterator[bytes]:
    """Every `every`-th entry is the head, with which a file starts."""
    n = 0
    for entry in entries:
        if n % every == 0:
            yield head
            n += 1
        yield entry
        n += 1


def _write(entries: DataFrame, folder: str, separator: str, every: int) -> None:
    """Entries (value) one after the other in gzip files of at most `every`.

    The text writer puts the separator behind each entry and takes the bytes as
    they are; it commits by task, so a lost executor leaves no half archive.
    """
    (entries.select(F.col("value").cast("string").alias("value")).write
     .option("lineSep", separator).option("compression", "gzip")
     .option("zlib.compress.level", "BEST_SPEED").option("maxRecordsPerFile", every)
     .text(folder))


def write_arc(pages: DataFrame, folder: str, rule: Archives = Archives()) -> None:
    """Pages (page_id, url, html) as ARC files; the id travels in an HTTP header.

    A null html is an empty one; a null url, or one with blanks, is written so
    that the header line can be split at blanks.
    """
    version = rule.arc_version
    description = f"{version} 0 InternetArchive\n{ARC_NAMES[version]}\n".encode()

    def line(url: str, mime: str, result: str, length: int) -> bytes:
        if version == 1:
            return f"{url} {rule.ip} {rule.date} {mime} {length}\n".encode()
        return f"{url} {rule.ip} {rule.date} {mime} {result} - - 0 pages.arc {length}\n".encode()

    head = line("filedesc://pages.arc", "text/plain", "200", len(description)) + description

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[bytes]:
        for batch in batches:
            for page, url, html in zip(batch["page_id"], batch["url"], batch["html"], strict=True):
                payload = (html.as_py() or "").encode()
                page = page.as_py()
                http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
                if page is not None:
                    http += PAGE_ID + b": %d\r\n" % page
                http += b"Content-Length: %d\r\n\r\n" % len(payload)
                name = "".join(c if c > " " else f"%{ord(c):02X}" for c in url.as_py() or "unknown:")
                yield line(name, "text/html", "200", len(http) + len(payload)) + http + payload

    schema = pa.schema([("value", pa.binary())])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batches(((e,) for e in _with_heads(entries(batches), head, rule.records_per_file)), schema)

    _write(pages.select("page_id", "url", "html").mapInArrow(rows, "value binary"), folder, "\n",
           rule.records_per_file)


class _Reader:
    """Lines and blocks of a gzip archive, unpacked as far as they are asked for."""

    def __init__(self, packed: bytes):
        self.packed, self.at, self.offset = packed, 0, 0
        self.buffer, self.start = b"", 0
        self.unpack = zlib.decompressobj(31)

    def _more(self) -> bool:
        if self.at >= len(self.packed) and not self.unpack.unused_data:
            return False
        if self.unpack.eof:  # the next member
            packed, self.unpack = self.unpack.unused_data, zlib.decompressobj(31)
        else:
            packed = self.packed[self.at:self.at + 262_144]
            self.at += 262_144
        self.buffer = self.buffer[self.start:] + self.unpack.decompress(packed)
        self.start = 0
        return True

    def take(self, n: int) -> bytes:
        while len(self.buffer) - self.start < n:
            if not self._more():
                raise ValueError(f"archive ends within a record at byte {self.offset}")
        out = self.buffer[self.start:self.start + n]
        self.start += n
        self.offset += n
        return out

    def until(self, mark: bytes) -> bytes | None:
        """Up to and with the mark; None at the end of the archive."""
        while (found := self.buffer.find(mark, self.start)) < 0:
            if not self._more():
                if self.buffer[self.start:].strip():
                    raise ValueError(f"archive ends within a header at byte {self.offset}")
                return None
        return self.take(found + len(mark) - self.start)


def parse_arc(packed: bytes) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(offset, fields, content) of the records of an ARC file, by the lengths they declare.

    The first record describes the file; its content names the version, and with
    it the fields of all further header lines.
    """
    reader = _Reader(packed)
    first = reader.until(b"\n")
    if first is None:
        return
    if not first.startswith(b"filedesc://"):
        raise ValueError("an ARC file starts with its description")
    description = reader.take(int(first.split()[-1]))
    fields = ARC_FIELDS[int(description.split(b" ", 1)[0])]
    while True:
        offset = reader.offset
        line = reader.until(b"\n")
        if line is None:
            return
        if not line.strip():
            continue
        parts = line.decode("utf-8", "replace").split()
        if len(parts) != len(fields):
            raise ValueError(f"header line at byte {offset} has {len(parts)} fields, not {len(fields)}")
        record = dict(zip(fields, parts, strict=True))
        yield offset, record, reader.take(int(record["length"]))


def split_http(content: bytes) -> tuple[bytes, bytes]:
    """The HTTP head with its empty line, and the payload."""
    end = content.find(b"\r\n\r\n")
    if not content.startswith(b"HTTP/") or end < 0:
        return b"", content
    return content[:end + 4], content[end + 4:]


def http_field(head: bytes, name: bytes) -> int | None:
    for line in head.split(b"\r\n"):
        key, _, value = line.partition(b":")
        if key.strip().lower() == name.lower() and value.strip():
            return int(value)
    return None


def sha1_label(payload: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(payload).digest()).decode()


def warc_date(date: str) -> str:
    """YYYYMMDDhhmmss as YYYY-MM-DDThh:mm:ssZ."""
    d = (date + "0" * 14)[:14]
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def record_uuid(file: str, offset: int, url: str, date: str) -> str:
    """The same for the same place in the same archive, however often it is read."""
    return str(uuid.uuid5(uuid.NAMESPACE_URL, f"{file.rsplit('/', 1)[-1]}#{offset} {date} {url}"))


RECORD = ("record_id string, uri string, date string, ip string, mime string, page_id long, "
          "payload_bytes long, sha256 binary, head binary, payload binary")


def read_arc(spark: SparkSession, folder: str, payloads: bool = True) -> DataFrame:
    """The records of all ARC files of a folder; without payloads for indexing."""
    schema = pa.schema([
        ("record_id", pa.string()), ("uri", pa.string()), ("date", pa.string()), ("ip", pa.string()),
        ("mime", pa.string()), ("page_id", pa.int64()), ("payload_bytes", pa.int64()),
        ("sha256", pa.binary()), ("head", pa.binary()), ("payload", pa.binary())])

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"], strict=True):
                path = path.as_py()
                for offset, fields, block in parse_arc(content.as_py()):
                    if fields["url"].startswith("filedesc://"):
                        continue
                    head, payload = split_http(block)
                    yield (record_uuid(path, offset, fields["url"], fields["date"]), fields["url"],
                           warc_date(fields["date"]), fields["ip"], fields["mime"],
                           http_field(head, PAGE_ID), len(payload), hashlib.sha256(payload).digest(),
                           head, payload if payloads else None)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batches(records(batches), schema)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder)
    return files.select("path", "content").mapInArrow(rows, RECORD)


def revisits(index: DataFrame, rule: Archives) -> DataFrame:
    """(revisit_id, to_id, to_uri, to_date) of the records that repeat a payload.

    Of records with equal payloads of at least revisit_bytes, the one with the
    largest page_id is the response; without ids, or with equal ones, the one
    with the largest record id among them.
    """
    large = index.filter(F.col("payload_bytes") >= rule.revisit_bytes).select(
        "record_id", "uri", "date", "page_id", "payload_bytes", "sha256")
    best = large.groupBy("sha256", "payload_bytes").agg(
        F.max(F.struct(F.coalesce("page_id", F.lit(-(1 << 63))).alias("page"), "record_id", "uri", "date")).alias("to"),
        F.count("*").alias("copies")).filter("copies > 1").drop("copies")
    return large.join(best, ["sha256", "payload_bytes"]).filter("record_id != to.record_id").select(
        F.col("record_id").alias("revisit_id"), F.col("to.record_id").alias("to_id"),
        F.col("to.uri").alias("to_uri"), F.col("to.date").alias("to_date"))


def convert(spark: SparkSession, arc_folder: str, warc_folder: str, rule: Archives = Archives()) -> None:
    """WARC files with a response or revisit record for every record of the ARC files.

    The first pass indexes digests, from which the revisits follow; the second
    one writes. Ids follow from the place in the ARC file, dates and types from
    its header lines, digests from the payload.
    """
    spool = Spool(spark, "arc-index")
    index = spool.write(read_arc(spark, arc_folder, payloads=False).drop("payload", "head"), "index")
    again = spool.write(revisits(index, rule), "revisits")
    records = read_arc(spark, arc_folder).join(
        again, F.col("record_id") == F.col("revisit_id"), "left").select(
        "record_id", "uri", "date", "ip", "head", "payload", "to_id", "to_uri", "to_date")
    info = (b"WARC/1.1\r\nWARC-Type: warcinfo\r\nWARC-Date: 2020-01-01T00:00:00Z\r\n"
            b"WARC-Record-ID: <urn:uuid:00000000-0000-5000-8000-000000000000>\r\n"
            b"Content-Type: application/warc-fields\r\nContent-Length: 18\r\n\r\nformat: WARC 1.1\r\n")

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[bytes]:
        for batch in batches:
            for i in range(batch.num_rows):
                r = {name: batch[name][i].as_py() for name in batch.schema.names}
                lines = [
                    "WARC/1.1", f"WARC-Type: {'revisit' if r['to_id'] else 'response'}",
                    f"WARC-Record-ID: <urn:uuid:{r['record_id']}>", f"WARC-Date: {r['date']}",
                    f"WARC-Target-URI: {r['uri']}", f"WARC-IP-Address: {r['ip']}",
                    f"WARC-Payload-Digest: {sha1_label(r['payload'])}"]
                if r["to_id"]:
                    lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:uuid:{r['to_id']}>",
                              f"WARC-Refers-To-Target-URI: {r['to_uri']}", f"WARC-Refers-To-Date: {r['to_date']}"]
                block = r["head"] + (b"" if r["to_id"] else r["payload"])
                lines += [f"WARC-Block-Digest: {sha1_label(block)}",
                          f"Content-Type: {'application/http; msgtype=response' if r['head'] else 'application/octet-stream'}",
                          f"Content-Length: {len(block)}"]
                yield "\r\n".join(lines).encode() + b"\r\n\r\n" + block

    schema = pa.schema([("value", pa.binary())])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batches(((e,) for e in _with_heads(entries(batches), info, rule.records_per_file)), schema)

    _write(records.mapInArrow(rows, "value binary"), warc_folder, "\r\n\r\n", rule.records_per_file)
    spool.drop("index", "revisits")


def parse_warc(packed: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields, block) of the records of a WARC file, names in lower case."""
    reader = _Reader(packed)
    while True:
        head = reader.until(b"\r\n\r\n")
        if head is None:
            return
        if not head.strip():
            continue
        lines = head.decode().strip().split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no record at byte {reader.offset - len(head)}")
        fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        yield fields, reader.take(int(fields["content-length"]))


def read_warc(spark: SparkSession, folder: str, payloads: bool = True) -> DataFrame:
    """Responses and revisits of all WARC files of a folder.

    Blocks are checked against their digests, and payloads of responses too; a
    difference raises.
    """
    schema = pa.schema([
        ("record_id", pa.string()), ("record_type", pa.string()), ("refers_to_id", pa.string()),
        ("uri", pa.string()), ("page_id", pa.int64()), ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()), ("payload", pa.binary())])

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            for content in batch["content"]:
                for fields, block in parse_warc(content.as_py()):
                    kind = fields["warc-type"]
                    if kind not in ("response", "revisit"):
                        continue
                    digest = fields["warc-payload-digest"]
                    head, payload = split_http(block)
                    if sha1_label(block) != fields["warc-block-digest"] or (
                            kind == "response" and sha1_label(payload) != digest):
                        raise ValueError(f"digest of {fields['warc-record-id']} differs")
                    length = http_field(head, b"Content-Length") if kind == "revisit" else len(payload)
                    yield (fields["warc-record-id"], kind, fields.get("warc-refers-to"),
                           fields["warc-target-uri"], http_field(head, PAGE_ID), length,
                           base64.b32decode(digest.removeprefix("sha1:")).hex(),
                           payload if payloads else None)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batches(records(batches), schema)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder)
    return files.select("path", "content").mapInArrow(
        rows, "record_id string, record_type string, refers_to_id string, uri string, page_id long, "
        "payload_bytes long, payload_digest string, payload binary")


def archived_pages(pages: DataFrame, rule: Archives = Archives()) -> DataFrame:
    """Pages through ARC and WARC files and back: what the WARC records say of each.

    Returns page_id, payload_bytes, payload_digest, record_type and refers_to,
    the page_id of the response that a revisit stands for. Null and empty html
    have an empty payload, which is never a revisit; every row is a record,
    repeated ones revisit the last of them; an empty table gives an empty one.
    """
    spark = pages.sparkSession
    spool = Spool(spark, "archives")
    write_arc(pages, spool.path("arc"), rule)
    convert(spark, spool.path("arc"), spool.path("warc"), rule)
    spool.drop("arc")
    back = spool.write(read_warc(spark, spool.path("warc"), payloads=False).drop("payload"), "back")
    found = back.filter("record_type = 'revisit'").select(F.col("refers_to_id").alias("_id")).distinct()
    target = back.join(found, F.col("record_id") == F.col("_id")).select(
        "_id", F.col("page_id").alias("refers_to"))
    return back.join(target, F.col("refers_to_id") == F.col("_id"), "left").select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
