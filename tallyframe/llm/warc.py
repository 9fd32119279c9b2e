"""WARC archives: a writer that folds equal payloads, and a reader that salvages damaged files.

The writer makes one record per page, each a gzip member of its own, and stores
the files with Spark's text sink, so any file system that Spark reaches will do.
Between members stands an empty member, which every gzip reader skips. Equal
payloads of some size become one response, and revisit records that name it.

The reader takes members one after another and checks each: gzip checksum,
version line, headers, length, ending, payload digest. Where a check fails it
searches for the next place at which a whole valid member or record begins,
goes on from there, and reports the bytes between as a quarantined gap.
Uncompressed archives are read the same way, by version lines, and so are the bytes
that can be unpacked from a damaged member or one with a bad record inside. Of a member
that is cut off, a record that ends just where the cut is counts as damaged; what follows
is searched from the member's first bytes, as the unpacker reads beyond a cut. HTTP header
lines without a colon are no damage. The digests cover blocks and payloads, so headers that
come from a member with a wrong checksum are as good as its bytes.

Defined results: a null payload is written as an empty one, and empty input as
no record. Pages tied on the smallest id of a group are all responses; a null id
is larger than all others and comes back as null. Control characters and spaces
in a URL are percent-encoded, and a null URL is left out. Repeated pages become
repeated records. A page with a payload that itself holds a WARC record is read
whole, as its length is known; only behind damage could the inner record be
taken for one. One record must fit in memory. Written files hold about
``FILE_BYTES`` and a record at most; a file is read as one value, so those of
others must stay below 2 GB. Columns besides the three named are ignored.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.llm.common import groups_of
from tallyframe.session import materialise

MIN_SHARED = 100
#: Bytes of an archive file, written in rows of ``_ROW_BYTES``.
FILE_BYTES = 128 << 20
DATE = "1970-01-01T00:00:00Z"
VERSION = b"WARC/1.1\r\n"
GZIP = b"\x1f\x8b\x08"
#: A gzip member of no content, as Latin-1 text for the sink's separator.
EMPTY_MEMBER = "\x1f\x8b\x08\x00\x00\x00\x00\x00\x00\x03\x03\x00\x00\x00\x00\x00\x00\x00\x00\x00"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_BEGIN = re.compile(rb"\x1f\x8b\x08|WARC/1\.[01]\r\n")
_VERSION_LINE = re.compile(rb"WARC/1\.[01]\r\n")
_OUT_BYTES = 8 << 20
_ROW_BYTES = 1 << 20
_FEED = 1 << 14

RECORD = (
    "file string, offset bigint, length bigint, kind string, reason string, type string, id string, refers_to string, "
    "uri string, payload_bytes bigint, payload_digest string, payload binary"
)


class Damage(Exception):
    """A failed check; the message is the reason reported."""


class Record(NamedTuple):
    headers: dict[str, str]
    http: dict[str, str]
    payload: bytes


def plan_records(pages: DataFrame, page_id: str = "page_id", url: str = "url", payload: str = "html", min_shared: int = MIN_SHARED) -> DataFrame:
    """One row per page: id, url, payload, digest, type and the response referred to.

    Payload groups are summed up before the join, and only those of two or more
    pages are joined; a payload of a third of all pages is one row there, and
    its pages are split among tasks by adaptive execution.
    """
    body = F.coalesce(F.col(f"`{payload}`").cast("string"), F.lit("")).cast("binary")
    rows = pages.select(
        F.col(f"`{page_id}`").cast("long").alias("page_id"),
        F.col(f"`{url}`").cast("string").alias("url"),
        body.alias("payload"),
        F.sha2(body, 256).alias("digest"),
    )
    slim = rows.filter(F.octet_length("payload") >= min_shared).select("page_id", "digest")
    groups = slim.groupBy("digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
    shared = materialise(groups.filter("n > 1 AND first IS NOT NULL").select("digest", "first"), "payload-groups")
    joined = rows.join(shared, "digest", "left")
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return joined.select(
        "page_id", "url", "payload", "digest", F.when(revisit, F.col("first")).alias("refers_to")
    )


def clean_uri(uri: str) -> str:
    return re.sub(r"[\x00-\x20\x7F<>]", lambda m: f"%{ord(m[0]):02X}", uri)


def record_bytes(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, date: str = DATE) -> bytes:
    """One WARC record, uncompressed."""
    name = lambda n: f"<urn:page:{'' if n is None else n}>"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + payload if refers_to is None else http
    lines = [
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {name(page_id)}",
        f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha256:{digest}",
        f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}",
        "Content-Type: application/http;msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        lines.append(f"WARC-Target-URI: {clean_uri(url)}")
    if refers_to is not None:
        lines += [f"WARC-Refers-To: {name(refers_to)}", f"WARC-Profile: {PROFILE}"]
    return VERSION + "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(data: bytes, level: int = 3) -> bytes:
    """A gzip member without a time stamp, so that a repeated task writes the same bytes."""
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def write_archives(pages: DataFrame, path: str, compress: bool = True, file_bytes: int = FILE_BYTES, **columns) -> None:
    """Write the records of ``pages`` as files of about ``file_bytes`` below ``path``.

    A row of the sink holds several records, and a file so many rows that their
    bytes stay within the bound; one larger record makes a longer row.
    """
    row_bytes = min(_ROW_BYTES, file_bytes)
    between = EMPTY_MEMBER.encode("latin-1") if compress else b"\r\n\r\n"

    def rows_of_records(records: list[bytes]) -> pa.RecordBatch:
        parts = groups_of(records, [len(r) for r in records], row_bytes)
        return pa.RecordBatch.from_arrays([pa.array([between.join(records[p]) for p in parts], pa.binary())], ["value"])

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, size = [], 0
            payloads = batch.column("payload").to_pylist()
            rest = [batch.column(c).to_pylist() for c in ("page_id", "url", "digest", "refers_to")]
            for payload, page, url, digest, refers in zip(payloads, *rest, strict=True):
                data = record_bytes(page, url, payload, digest, refers)
                out.append(member(data) if compress else data[:-4])
                size += len(out[-1])
                if size > _OUT_BYTES:
                    yield rows_of_records(out)
                    out, size = [], 0
            yield rows_of_records(out)

    records = plan_records(pages, **columns).mapInArrow(build, "value binary").select(F.col("value").cast("string").alias("value"))
    writer = records.write.option("maxRecordsPerFile", max(1, file_bytes // row_bytes)).option("encoding", "ISO-8859-1")
    # An uncompressed record ends in two line ends, which the sink's separator supplies.
    writer.option("lineSep", EMPTY_MEMBER if compress else "\r\n\r\n").text(path)


def fields(lines: list[bytes], strict: bool = True) -> dict[str, str]:
    """Header fields; a line without a colon is damage, or passed over if not ``strict``."""
    out = {}
    for line in lines:
        key, colon, value = line.partition(b":")
        if not colon:
            if strict:
                raise Damage("header line")
            continue
        out[key.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
    return out


def parse(data: bytes, at: int, end: int | None = None) -> tuple[Record, int]:
    """The checked record at ``at`` and where it ends."""
    if not re.match(rb"WARC/1\.[01]\r\n", data[at : at + 10]):
        raise Damage("version line")
    stop = data.find(b"\r\n\r\n", at)
    if stop < 0:
        raise Damage("headers not ended")
    headers = fields(data[at:stop].split(b"\r\n")[1:])
    if not re.fullmatch(r"\d{1,18}", headers.get("content-length", "")):
        raise Damage("content length")
    begin, size = stop + 4, int(headers["content-length"])
    if data[begin + size : begin + size + 4] != b"\r\n\r\n":
        raise Damage("record ending")
    block = data[begin : begin + size]
    check_digest(headers.get("warc-block-digest"), block, "block digest")
    http, payload = {}, block
    if headers.get("content-type", "").startswith("application/http"):
        head, _, payload = block.partition(b"\r\n\r\n")
        http = fields(head.split(b"\r\n")[1:], strict=False)  # as the server sent them
    if headers.get("warc-type") != "revisit":
        check_digest(headers.get("warc-payload-digest"), payload, "payload digest")
    return Record(headers, http, payload), begin + size + 4


def check_digest(wanted: str | None, data: bytes, what: str) -> None:
    if wanted and wanted.lower().startswith("sha256:") and wanted[7:].lower() != hashlib.sha256(data).hexdigest():
        raise Damage(what)


def unpack(data: bytes, at: int) -> tuple[bytes, int, str]:
    """The bytes of the gzip member at ``at`` as far as they can be had, where they end, and what is wrong with the member."""
    unpacker, view, parts, fed = zlib.decompressobj(31), memoryview(data), [], at
    try:
        while not unpacker.eof and fed < len(data):  # by pieces, as what is left over gets copied
            parts.append(unpacker.decompress(view[fed : fed + _FEED]))
            fed += _FEED
    except zlib.error:
        unpacker = zlib.decompressobj(31)
        for start in range(at, fed, _FEED):
            unpacker.decompress(view[start : start + _FEED])
        try:
            while fed < len(data):  # the piece that failed, byte by byte
                parts.append(unpacker.decompress(view[fed : fed + 1]))
                fed += 1
        except zlib.error:
            return b"".join(parts), fed, "gzip member"
    if not unpacker.eof:
        return b"".join(parts), len(data), "gzip member not ended"
    return b"".join(parts), min(fed, len(data)) - len(unpacker.unused_data), ""


def records_in(plain: bytes) -> tuple[list[Record], list[str], int]:
    """The valid records of unpacked bytes, the reason of each gap between them, and where the last record begins."""
    records, reasons, last, at, whole = [], [], 0, 0, True
    while at < len(plain):
        try:
            record, end = parse(plain, at)
        except Damage as damage:
            if whole:
                reasons.append(str(damage))
            following = _VERSION_LINE.search(plain, at + 1)
            at, whole = following.start() if following else len(plain), False
            continue
        records.append(record)
        last, at, whole = at, end, True
    return records, reasons, last if whole else len(plain)


def read_at(data: bytes, at: int) -> tuple[list[Record], int, list[str]]:
    """The records of the member, or the record, that begins at ``at``, where it ends, and what is wrong inside a member."""
    if not data.startswith(GZIP, at):
        record, end = parse(data, at)
        return [record], end, []
    plain, end, wrong = unpack(data, at)
    records, reasons, last = records_in(plain)
    if wrong == "gzip member not ended" and last < len(plain):
        records.pop()  # it goes up to the cut, and the checksum that would show its end is not there
    if not records and (wrong or reasons):
        raise Damage(wrong or reasons[0])
    return records, end, [wrong] if wrong else reasons


def next_valid(data: bytes, at: int, end: int, saved: list[Record]) -> int:
    """Where the first valid member or record behind the damaged member at ``at`` begins.

    The unpacker takes the bytes behind a cut for more of the cut member, up to
    ``end``, so the search starts at the member's own bytes. A stored member
    shows its records there once more; those ``saved`` are passed over.
    """
    for found in _BEGIN.finditer(data, at + 1):
        start = found.start()
        if start >= end:
            return start
        try:
            records, _, wrong = read_at(data, start)
        except Damage:
            continue
        if [r for r in records if r not in saved] or not (records or wrong):
            return start
    return len(data)


def before_cut(data: bytes) -> list[Record]:
    """The records of a cut member that end before the cut."""
    try:
        return read_at(data, 0)[0]
    except Damage:
        return []


def salvage(data: bytes) -> Iterator[tuple[int, int, list[Record] | str]]:
    """Start, end, and the records of each valid stretch, or the reason of each gap, in order.

    Damage inside a member with valid records is a gap without length behind it, or
    goes on from where the member cannot be unpacked to the next valid one.
    """
    at, gap, reason = 0, None, ""
    while at < len(data):
        try:
            records, end, wrong = read_at(data, at)
        except Damage as damage:
            if gap is None:
                gap, reason = at, str(damage)
            following = _BEGIN.search(data, at + 1)
            at = following.start() if following else len(data)
            continue
        if gap is not None:
            yield gap, at, reason
            gap = None
        if wrong and wrong[0].startswith("gzip member"):
            following = next_valid(data, at, end, records)
            if following < end:  # cut there: what was unpacked from behind the cut is none of its records
                records, end = before_cut(data[at:following]), following
            if records:
                yield at, end, records
            yield end if records else at, following, wrong[0]
            at = following
            continue
        if records:
            yield at, end, records
        for what in wrong:
            yield end, end, what
        at = end
    if gap is not None:
        yield gap, len(data), reason


def page_number(name: str | None) -> str | None:
    found = re.fullmatch(r"<?urn:page:(-?\d*)>?", name or "")
    return found[1] or None if found else name


def rows_of(file: str, data: bytes, keep_payload: bool) -> Iterator[tuple]:
    """A row per record and per gap of a file."""
    for start, end, what in salvage(data):
        if isinstance(what, str):
            yield file, start, end - start, "gap", what, None, None, None, None, None, None, None
            continue
        for r in what:
            kind = r.headers.get("warc-type")
            digest = r.headers.get("warc-payload-digest", "")
            length = r.http.get("content-length", "")
            yield (
                file, start, end - start, "record", None, kind, page_number(r.headers.get("warc-record-id")),
                page_number(r.headers.get("warc-refers-to")), r.headers.get("warc-target-uri"),
                int(length) if kind == "revisit" and length.isdigit() else len(r.payload),
                digest[7:].lower() if digest.lower().startswith("sha256:") else hashlib.sha256(r.payload).hexdigest(),
                r.payload if keep_payload else None,
            )


def read_archives(spark: SparkSession, path: str, keep_payload: bool = True) -> DataFrame:
    """Records and quarantined gaps of the archive files below ``path``.

    ``kind`` is ``record`` or ``gap``; ``offset`` and ``length`` are bytes of the
    file, those of the whole member for a compressed record. ``payload_bytes``
    and ``payload_digest`` describe the full payload, also of a revisit.
    """
    names = [f.split()[0] for f in RECORD.split(", ")]
    kinds = {"string": pa.string(), "bigint": pa.int64(), "binary": pa.binary()}
    types = [kinds[f.split()[1]] for f in RECORD.split(", ")]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, data in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
                rows, size = [], 0
                for row in rows_of(file, data.as_py(), keep_payload):
                    rows.append(row)
                    size += 200 + len(row[-1] or b"")
                    if size > _OUT_BYTES:
                        yield batch_of(rows)
                        rows, size = [], 0
                if rows:
                    yield batch_of(rows)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select("path", "content").mapInArrow(read, RECORD)


def number(name: str) -> Column:
    return F.col(name).cast("long")
