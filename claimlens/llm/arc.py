"""Legacy ARC archives to WARC.

ARC files (versions 1 and 2) hold a header line per record whose fields depend on
the version that the file states first, and a declared length. The converter
parses them and synthesises what WARC needs beyond that: record ids, ISO
timestamps, types, digests. Archives are written and read through Spark's text
and binary-file sources, so they can lie in any store that Spark reads. A row of
the text writer is one whole file of bounded size.

Payloads are never shuffled while the index of repeated digests can be broadcast:
the ARC files are read once for digests and ids, and once more to be converted.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import uuid
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimlens.session import scratch_dir, stored

#: Bytes after which an archive file ends (before compression); a record is never cut.
FILE_BYTES = 16_000_000
#: Repeated digests up to which their index is broadcast; beyond, records meet it in a shuffle.
INDEX_ROWS = 500_000
#: Parts that a digest is dealt to in that shuffle, so that a common payload is no one task's work.
SALTS = 16
#: Field names by ARC version, as its files state them (fixed values).
ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_NAMES = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # RFC 4122 name space of URLs (fixed value)


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data, usedforsecurity=False).digest()).decode()


def clean_url(url: str | None) -> str:
    """A URL without blanks, control or non-ASCII characters; a null or empty one is ``unknown:``."""
    return quote(url, safe="!#$%&'()*+,/:;=?@[]~-._") if url else "unknown:"


def http_block(page_id, payload: bytes) -> bytes:
    """Stored response: its headers carry the page id and the payload's length."""
    own = "" if page_id is None else str(page_id)
    return (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n"
            f"X-Page-Id: {own}\r\n\r\n").encode() + payload


def _files(path: str, rows: DataFrame, separator: str) -> None:
    # fast compression: these files are read back once or twice
    (rows.write.option("lineSep", separator).option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED")
         .option("maxRecordsPerFile", 1).text(path))


def _packed(records, first: str, separator: str, file_bytes: int):
    """Batches of one row, the text of a whole file: ``first`` and then records until
    ``file_bytes`` is reached. A repeated task packs alike."""
    def row():
        return pa.RecordBatch.from_arrays([pa.array([separator.join([first, *own])], pa.string())], names=["value"])

    own, size = [], 0
    for record in records:
        own.append(record)
        size += len(record)
        if size >= file_bytes:
            yield row()
            own, size = [], 0
    if own:
        yield row()


def _rows(batches, size: int = 200):
    """Rows of Arrow batches as Python tuples, so many at a time."""
    for b in batches:
        for lo in range(0, b.num_rows, size):
            yield from zip(*(c.to_pylist() for c in b.slice(lo, size).columns), strict=True)


def write_arc(pages: DataFrame, path: str, date: str = "20200101000000", file_bytes: int = FILE_BYTES) -> None:
    """One ARC record per row of (page_id, url, html); a null html is empty. Files
    of even partitions are of version 1, of odd ones of version 2."""
    def run(batches):
        version = 1 + (TaskContext.get().partitionId() % 2)
        about = f"{version} 0 converter\n{ARC_FIELDS[version]}\n"
        more = "" if version == 1 else " 200 - - 0 -"
        first = f"filedesc://pages.arc 0.0.0.0 {date} text/plain{more} {len(about)}\n{about}"

        def record(page_id, url, html):
            block = http_block(page_id, (html or "").encode())
            extra = "" if version == 1 else f" 200 {base32_sha1(block)} - 0 pages.arc"
            return f"{clean_url(url)} 0.0.0.0 {date} text/html{extra} {len(block)}\n{block.decode()}"

        yield from _packed((record(*r) for r in _rows(batches)), first, "\n", file_bytes)

    _files(path, pages.select("page_id", "url", "html").mapInArrow(run, "value string"), "\n")


def arc_records(data):
    """(fields by name, block) of each record of an open ARC file but its own first."""
    names: list[str] = []
    while line := data.readline():
        if not line.strip():
            continue  # the separator between records
        line = line.decode("utf-8").rstrip("\n")
        if line.startswith("filedesc://"):
            # the last field is the length in either version
            about = data.read(int(line.rsplit(" ", 1)[1])).decode().split("\n")
            names = ARC_FIELDS[int(about[0].split(" ")[0])].split(" ")
            continue
        if not names:
            raise ValueError("an ARC file begins with its version")
        # URLs of old archives may hold blanks, the other fields don't
        fields = dict(zip(names, line.rsplit(" ", len(names) - 1), strict=True))
        size = int(fields["Archive-length"])
        block = data.read(size)
        if len(block) < size:
            raise ValueError("an ARC record ends before its declared length")
        yield fields, block


def _http(block: bytes) -> tuple[dict[str, str], bytes, bytes]:
    """Headers by lower-case name, the header bytes, and the payload."""
    head, _, payload = block.partition(b"\r\n\r\n")
    own = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in head.decode().split("\r\n")[1:])
    return {k.lower(): v.strip() for k, v in own.items()}, head, payload


def _binary(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")


_PARSED = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("url", pa.string()),
                     ("ip", pa.string()), ("date", pa.string()), ("head", pa.string()), ("payload", pa.string())])


def read_arc(spark: SparkSession, path: str, bodies: bool = True) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, url, ip, date, head, payload) of each record,
    without ``bodies`` the first three only."""
    form = _PARSED if bodies else pa.schema(list(_PARSED)[:3])

    def run(batches):
        out, held = [], 0
        for b in batches:
            for content in b.column(0):
                for fields, block in arc_records(gzip.GzipFile(fileobj=io.BytesIO(content.as_buffer()))):
                    headers, head, payload = _http(block)
                    own = headers.get("x-page-id", "")
                    row = (int(own) if own else None, len(payload), base32_sha1(payload))
                    if bodies:
                        row += (fields["URL"], fields["IP-address"], fields["Archive-date"], head.decode(), payload.decode())
                    out.append(row)
                    held += len(payload) + 500 if bodies else 100
                    if held > 4_000_000:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), form, strict=True)], schema=form)
                        out, held = [], 0
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), form, strict=True)], schema=form)

    more = ", url string, ip string, date string, head string, payload string" if bodies else ""
    return _binary(spark, path).mapInArrow(run, "page_id long, payload_bytes long, payload_digest string" + more)


def repeated(records: DataFrame, least: int = 0) -> DataFrame:
    """(payload_digest, newest): digests that occur more than once among records with at
    least ``least`` payload bytes, and the largest page_id of each (null if none has one)."""
    return (records.where(F.col("payload_bytes") >= least).groupBy("payload_digest")
            .agg(F.max("page_id").alias("newest"), F.count("*").alias("n")).where("n > 1").select("payload_digest", "newest"))


def with_types(records: DataFrame, index: DataFrame, least: int = 0, limit: int = INDEX_ROWS) -> DataFrame:
    """Adds ``refers_to``: null for a response, else the page_id of the response
    with the same payload, which is the largest. Records with fewer payload bytes
    than ``least`` are all responses, and so are those without any page_id of that
    payload. ``index`` is ``repeated`` of the same records, as a stored table."""
    keys = ["payload_digest"]
    if index.limit(limit + 1).count() <= limit:
        index = F.broadcast(index)
    else:  # the part follows from the input split, so a task that runs again deals alike
        keys.append("_salt")
        index = index.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        records = records.withColumn("_salt", F.pmod(F.spark_partition_id(), F.lit(SALTS)))
    same = F.col("newest").isNull() | F.col("page_id").eqNullSafe(F.col("newest")) | (F.col("payload_bytes") < least)
    return records.join(index, keys, "left").select(
        *[c for c in records.columns if c != "_salt"], F.when(~same, F.col("newest")).alias("refers_to"))


def _warc_date(date: str) -> str:
    return f"{date[:4]}-{date[4:6]}-{date[6:8]}T{date[8:10]}:{date[10:12]}:{date[12:14]}Z"


def _record_id(page_id, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_NAMES, f'{page_id} {digest}')}>"


def write_warc(records: DataFrame, path: str, file_bytes: int = FILE_BYTES) -> None:
    """WARC files of ``with_types(read_arc(...))``. A revisit keeps the stored
    HTTP headers and refers to the response's record id, which follows from that
    record's page_id and digest, so a repeated task writes the same records."""
    columns = ["page_id", "url", "ip", "date", "head", "payload", "payload_digest", "refers_to"]

    def record(page_id, url, ip, date, head, payload, digest, refers_to):
        block = head + "\r\n\r\n" + ("" if refers_to is not None else payload)
        kind = "response" if refers_to is None else (
            f"revisit\r\nWARC-Profile: {REVISIT}\r\nWARC-Refers-To: {_record_id(refers_to, digest)}\r\n"
            f"WARC-Refers-To-Page: {refers_to}")
        return (f"WARC/1.1\r\nWARC-Type: {kind}\r\nWARC-Record-ID: {_record_id(page_id, digest)}\r\nWARC-Date: {_warc_date(date)}\r\n"
                f"WARC-Target-URI: {url}\r\nWARC-IP-Address: {ip}\r\nWARC-Payload-Digest: sha1:{digest}\r\n"
                f"Content-Type: application/http; msgtype=response\r\nContent-Length: {len(block.encode())}\r\n\r\n{block}")

    def run(batches):
        about = "software: converter\r\nformat: WARC File Format 1.1\r\n"
        first = (f"WARC/1.1\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: {_record_id('', 'warcinfo')}\r\nWARC-Date: 2020-01-01T00:00:00Z\r\n"
                 f"Content-Type: application/warc-fields\r\nContent-Length: {len(about)}\r\n\r\n{about}")
        yield from _packed((record(*r) for r in _rows(batches)), first, "\r\n\r\n", file_bytes)

    _files(path, records.select(*columns).mapInArrow(run, "value string"), "\r\n\r\n")


def warc_records(data):
    """(headers by lower-case name, block) of each record of an open WARC file."""
    while line := data.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError("a WARC record begins with its version")
        headers = {}
        while (line := data.readline()).strip():
            name, _, value = line.decode().partition(":")
            headers[name.lower()] = value.strip()
        size = int(headers["content-length"])
        block = data.read(size)
        if len(block) < size:
            raise ValueError("a WARC record ends before its declared length")
        yield headers, block


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to, url, date, record_id) of
    each record but the files' own. A response's length and digest are those of the bytes read; a
    revisit's come from its headers."""
    schema = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()),
                        ("refers_to", pa.int64()), ("url", pa.string()), ("date", pa.string()), ("record_id", pa.string())])

    def run(batches):
        for b in batches:
            for content in b.column(0):
                out = []
                for own, block in warc_records(gzip.GzipFile(fileobj=io.BytesIO(content.as_buffer()))):
                    if own["warc-type"] == "warcinfo":
                        continue
                    headers, _, payload = _http(block)
                    digest = own["warc-payload-digest"].removeprefix("sha1:")
                    full = own["warc-type"] == "response"
                    if full and base32_sha1(payload) != digest:
                        raise ValueError(f"record {own['warc-record-id']} doesn't match its digest")
                    page, to = headers.get("x-page-id", ""), own.get("warc-refers-to-page")
                    out.append({"page_id": int(page) if page else None, "payload_bytes": len(payload) if full else int(headers["content-length"]),
                                "payload_digest": digest, "record_type": own["warc-type"], "refers_to": int(to) if to else None,
                                "url": own["warc-target-uri"], "date": own["warc-date"], "record_id": own["warc-record-id"]})
                if out:
                    yield pa.RecordBatch.from_pylist(out, schema)

    return _binary(spark, path).mapInArrow(
        run, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, date string, record_id string")


def convert(spark: SparkSession, arc: str, warc: str, least: int = 0, file_bytes: int = FILE_BYTES, limit: int = INDEX_ROWS) -> DataFrame:
    """Convert the ARC files below ``arc`` to WARC files below ``warc``; returns what is read back."""
    index = stored(repeated(read_arc(spark, arc, bodies=False), least), "repeated")
    write_warc(with_types(read_arc(spark, arc), index, least, limit), warc, file_bytes)
    return read_warc(spark, warc)


def archive(pages: DataFrame, least: int = 0, file_bytes: int = FILE_BYTES, limit: int = INDEX_ROWS) -> DataFrame:
    """ARC files of ``pages`` (page_id long, url, html; other columns are ignored), converted to
    WARC in the shared folder and read back, one row per page. Repeated rows are records each; a
    null page_id is kept; an empty table gives no rows. A file holds ``file_bytes`` of records, the
    last one whole; so many repeated digests as ``limit`` are broadcast, more meet the records in a shuffle."""
    spark = pages.sparkSession
    arc, warc = scratch_dir(spark, "arc"), scratch_dir(spark, "warc")
    write_arc(pages, arc, file_bytes=file_bytes)
    return convert(spark, arc, warc, least, file_bytes, limit)
