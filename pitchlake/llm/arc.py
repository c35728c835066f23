r"""Legacy web archives: ARC files written and read by their declared lengths, converted to WARC.

An ARC file begins with a version block; each later record is one header line, as many
bytes as the line declares, and a newline. Version 1 lines have five fields (URL, IP address,
14-digit date, content type, length), version 2 lines ten (... result code, checksum, location,
offset, file name, length). The version block names the version, so lines are read by it.

``arc_to_warc`` gives each ARC record the WARC header it would have had: an identifier made from
its content, the ISO date, the type that its URL and payload imply, and digests of block and payload.
Of records with equal payloads one is the response and the others are revisits of it.

Archives are written and read by Spark's own writers and readers (any file system), gzipped as a
whole. Every file is bounded by ``RECORDS`` records, so a task holds one archive at a time.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator
from datetime import datetime, timedelta, timezone
from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchlake.llm.scratch import cut, join_counted
from pitchlake.session import fresh_dir

#: Records of one archive file, its version block or warcinfo record among them.
RECORDS = 5000
#: Payloads of fewer bytes are never revisits.
MIN_REVISIT = 100
#: Rows handed on at once.
ROWS = 64

# The field lines of the two ARC versions.
ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
EPOCH = datetime(2000, 1, 1, tzinfo=timezone.utc)
_NAMESPACE = uuid.UUID("8c6f3f0e-2f0b-4f5e-9d0a-5a3c1d8e7b42")


def _clean_url(url: str | None) -> str:
    """A URL without white space and control characters, so that it is one header field; ``-`` for none."""
    if not url:
        return "-"
    return "".join(c if c > " " and c != "\x7f" else "%%%02X" % ord(c) for c in url)


def _version_block(version: int, name: str, date: str) -> bytes:
    body = f"{version} 0 pitchlake\n{ARC_FIELDS[version]}\n\n".encode()
    tail = f"{len(body)}" if version == 1 else f"200 - - 0 {name} {len(body)}"
    return f"filedesc://{name} 0.0.0.0 {date} text/plain {tail}\n".encode() + body


def _arc_rows(batches: Iterator[pa.RecordBatch], records: int) -> Iterator[pa.RecordBatch]:
    """ARC records, a version block first and again after every ``records`` - 1 of them; files alternate versions."""
    out: list[bytes] = []
    n = offset = 0
    version = 1
    for batch in batches:
        for page, url, html in zip(*(batch.column(c).to_pylist() for c in ("id", "url", "html"))):
            seconds = (page or 0) % (20 * 365 * 86400)
            date = (EPOCH + timedelta(seconds=seconds)).strftime("%Y%m%d%H%M%S")
            if n % records == 0:
                version = 1 + (n // records) % 2
                out.append(_version_block(version, f"part-{n // records}.arc", date))
                n, offset = n + 1, len(out[-1])
            http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nX-Page: %s\r\n\r\n" % (b"-" if page is None else b"%d" % page)
            body = http + (html or b"")
            tail = f"{len(body)}" if version == 1 else f"200 - - {offset} part-{n // records}.arc {len(body)}"
            out.append(f"{_clean_url(url)} 0.0.0.0 {date} text/html {tail}\n".encode() + body)
            n, offset = n + 1, offset + len(out[-1])
            if len(out) >= ROWS:
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["value"])
                out = []
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["value"])


def _write_records(rows: DataFrame, path: str, separator: str, records: int) -> None:
    """One binary value a record, ended by ``separator``; a new file after every ``records`` records of a task."""
    (
        # the writer takes strings and copies their bytes, whatever they are
        rows.select(F.col("value").cast("string"))
        .write.option("lineSep", separator).option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED")
        .option("maxRecordsPerFile", records).text(path)
    )


def write_arc(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
              records: int = RECORDS) -> None:
    """Write every page as an ARC record with an HTTP response head and its html (null: empty)."""
    src = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"),
                       F.col(html_col).cast("string").cast("binary").alias("html"))
    _write_records(src.mapInArrow(partial(_arc_rows, records=records), "value binary"), path, "\n", records)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """(path, content) of the archive files under ``path``."""
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "content")


def _unzip(content: bytes) -> bytes:
    """The content of one or several gzip members; other content as it is."""
    out = []
    while content[:2] == b"\x1f\x8b":
        z = zlib.decompressobj(31)
        out.append(z.decompress(content))
        content = z.unused_data
    return b"".join(out) if out else content


def parse_arc(data: bytes) -> Iterator[dict]:
    """Records of an ARC file: url, ip, date, type, status, body. Bad header lines are skipped up to the next line."""
    at, version = 0, 1
    while at < len(data):
        end = data.find(b"\n", at)
        if end < 0:
            return
        line = data[at:end].decode("utf-8", "replace").rstrip("\r").split(" ")
        at = end + 1
        if line == [""]:
            continue
        block = line[0].startswith("filedesc://")
        if (len(line) not in (5, 10) if block else len(line) != (5 if version == 1 else 10)) or not line[-1].isdigit():
            continue
        size = int(line[-1])
        body = data[at : at + size]
        at += size
        if block:
            first = body.split(b"\n", 1)[0].split(b" ")
            version = 2 if first[0] == b"2" else 1
        yield {
            "url": line[0], "ip": line[1], "date": line[2], "type": line[3],
            "status": line[4] if len(line) == 10 else None, "body": body, "whole": len(body) == size,
        }


def payload_of(record: dict) -> tuple[bytes, bytes]:
    """HTTP head and payload; other records have no head."""
    body = record["body"]
    if body.startswith(b"HTTP/"):
        end = body.find(b"\r\n\r\n")
        if end >= 0:
            return body[: end + 4], body[end + 4 :]
    return b"", body


def _page(head: bytes) -> int | None:
    at = head.find(b"\r\nX-Page: ")
    if at < 0:
        return None
    number = head[at + 10 : head.index(b"\r\n", at + 10)]
    return int(number) if number.lstrip(b"-").isdigit() else None


def _warc_date(date: str) -> str:
    """ISO form of a 14-digit date; missing digits (some archives have 8 or 12) are the earliest."""
    date = date[:14] + "00000101000000"[len(date) :]
    return f"{date[:4]}-{date[4:6]}-{date[6:8]}T{date[8:10]}:{date[10:12]}:{date[12:14]}Z"


def _record_id(*parts: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_NAMESPACE, ' '.join(parts))}>"


def to_warc(record: dict, refers_to: int | None = None) -> tuple[str, bytes]:
    """(type, WARC record without its closing blank lines) of a parsed ARC record.

    The version block becomes warcinfo, HTTP records response (or, with ``refers_to``, a revisit that
    keeps the head alone), others resource. The identifier follows from page and payload, so a revisit can name its response.
    """
    head, payload = payload_of(record)
    digest = hashlib.sha256(payload).hexdigest()
    page, date = _page(head), _warc_date(record["date"])
    if record["url"].startswith("filedesc://"):
        kind, mime = "warcinfo", "application/warc-fields"
        body = f"software: pitchlake\r\nformat: WARC File Format 1.0\r\nconverted-from: {record['url']}\r\n".encode()
    elif head:
        kind, mime = ("response" if refers_to is None else "revisit"), "application/http; msgtype=response"
        body = record["body"] if refers_to is None else head
    else:
        kind, mime, body = "resource", record["type"], record["body"]
    ident = _record_id(digest, str(page)) if page is not None else _record_id(digest, record["url"], date)
    lines = ["WARC/1.0", f"WARC-Type: {kind}", f"WARC-Record-ID: {ident}", f"WARC-Date: {date}"]
    if kind != "warcinfo":
        lines += [
            f"WARC-Target-URI: {record['url']}", f"WARC-IP-Address: {record['ip']}",
            f"WARC-Payload-Digest: sha256:{digest}", f"WARC-Block-Digest: sha256:{hashlib.sha256(body).hexdigest()}",
        ]
    if kind == "revisit":
        lines += [
            "WARC-Profile: http://netpreserve.org/warc/1.0/revisit/identical-payload-digest",
            f"WARC-Refers-To: {_record_id(digest, str(refers_to))}",
            f"X-Refers-To-Page: {refers_to}", f"X-Payload-Length: {len(payload)}",
        ]
    lines += [f"Content-Type: {mime}", f"Content-Length: {len(body)}", "", ""]
    return kind, "\r\n".join(lines).encode() + body


def parse_warc(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields, body) of the records of a WARC file, by their declared lengths."""
    at = 0
    while at < len(data):
        end = data.find(b"\r\n\r\n", at)
        if end < 0:
            return
        lines = data[at:end].decode("utf-8", "replace").split("\r\n")
        fields = dict(x.split(": ", 1) for x in lines[1:] if ": " in x)
        size = int(fields.get("Content-Length", 0))
        yield fields, data[end + 4 : end + 4 + size]
        at = end + 4 + size + 4


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for content in batch.column("content"):
            rows = []
            for record in parse_arc(_unzip(content.as_py())):
                head, payload = payload_of(record)
                if head:
                    rows.append((_page(head), len(payload), hashlib.sha256(payload).digest()))
            page, size, digest = zip(*rows) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(page, pa.int64()), pa.array(size, pa.int64()), pa.array(digest, pa.binary())],
                names=["page", "bytes", "digest"],
            )


_RECORD = {"page": pa.int64(), "digest": pa.binary(), "url": pa.string(), "ip": pa.string(), "date": pa.string(),
           "type": pa.string(), "body": pa.binary()}


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The ARC records of a task as rows."""

    def batch_of(rows: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], t) for c, t in _RECORD.items()], names=list(_RECORD))

    for batch in batches:
        for content in batch.column("content"):
            rows = []
            for record in parse_arc(_unzip(content.as_py())):
                head, payload = payload_of(record)
                rows.append(record | {"page": _page(head), "digest": hashlib.sha256(payload).digest()})
                if len(rows) >= ROWS:
                    yield batch_of(rows)
                    rows = []
            if rows:
                yield batch_of(rows)


def _convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            out = [to_warc(r, r["refers_to"])[1] for r in batch.slice(at, ROWS).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["value"])


def arc_to_warc(spark: SparkSession, arc: DataFrame, path: str, records: int = RECORDS) -> None:
    """Convert the ARC files ``arc`` (path, content) to WARC files under ``path``.

    Of pages with equal payloads of at least ``MIN_REVISIT`` bytes the one with the smallest number is
    the response, the others revisit it. Only digests are shuffled: payloads stay with their
    archive, and the revisits (page, digest, response) are joined to them, broadcast if
    their counted number is within the bound of ``scratch.BROADCAST_ROWS``, else by a shuffle.
    """
    found = cut(arc.mapInArrow(_digests, "page long, bytes long, digest binary"), "payloads")
    large = found.where((F.col("bytes") >= MIN_REVISIT) & F.col("page").isNotNull()).select("page", "digest")
    first = large.groupBy("digest").agg(F.min("page").alias("refers_to"), F.max("page").alias("last")).where("refers_to < last")
    again = large.join(first.drop("last"), "digest").where("page <> refers_to").distinct()
    revisits = cut(again.select("page", "digest", "refers_to"), "revisits")
    schema = "page long, digest binary, url string, ip string, date string, type string, body binary"
    rows = join_counted(arc.mapInArrow(_records, schema), revisits, ["page", "digest"], "left")
    # the join puts its keys first, so the file order of records is kept with a broadcast only; WARC needs none
    _write_records(rows.mapInArrow(_convert, "value binary"), path, "\r\n\r\n", records)


def _read_warc(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for content in batch.column("content"):
            rows = []
            for fields, body in parse_warc(_unzip(content.as_py())):
                kind = fields.get("WARC-Type")
                head, payload = payload_of({"body": body})
                if kind == "response":
                    rows.append((_page(head), len(payload), hashlib.sha256(payload).hexdigest(), kind, None, fields["WARC-Record-ID"], fields["WARC-Target-URI"], fields["WARC-Date"]))
                elif kind == "revisit":
                    rows.append((_page(body), int(fields["X-Payload-Length"]), fields["WARC-Payload-Digest"].split(":")[1], kind,
                                 int(fields["X-Refers-To-Page"]), fields["WARC-Record-ID"], fields["WARC-Target-URI"], fields["WARC-Date"]))
            columns = list(zip(*rows)) if rows else [()] * 8
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)],
                                             names=["page", "payload_bytes", "payload_digest", "record_type", "refers_to", "record_id", "url", "date"])


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """(page, payload_bytes, payload_digest, record_type, refers_to, record_id, url, date) of the page records under ``path``.

    Size and digest of a response are taken from the payload that is there, those of a revisit from its header.
    """
    return read_archives(spark, path).mapInArrow(
        _read_warc,
        "page long, payload_bytes long, payload_digest string, record_type string, refers_to long, record_id string, url string, date string",
    )


def pages_to_warc(spark: SparkSession, pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
                  html_col: str = "html", records: int = RECORDS) -> DataFrame:
    """Write pages as ARC archives, convert those to WARC archives in the shared folder, and read these back.

    Edge cases: a null html is an empty payload; a null or empty URL is ``-``; white space in a URL
    is percent-encoded; a null page number gives a response of its own with a null number; repeated
    rows are repeated records (all response, or all revisits of a smaller number); an empty table
    gives an empty result.
    """
    arc_path, warc_path = fresh_dir(spark, "llm-arc"), fresh_dir(spark, "llm-warc")
    write_arc(pages, arc_path, id_col, url_col, html_col, records)
    arc_to_warc(spark, read_archives(spark, arc_path), warc_path, records)
    return read_warc(spark, warc_path)
