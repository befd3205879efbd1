"""WARC archives: a writer and a salvage reader.

Writer: one record per page, each a gzip member of its own.  Of equal payloads the first page's record is a
response, the others are revisit records that refer to it.

Reader: an archive is read member by member (or, uncompressed, record by record).  Where a check fails
(compression, version line, header, length, record end, block or payload digest) the reader searches on for the next
position at which a record passes all checks, goes on there and reports the bytes in between as a quarantined gap.
The search also runs inside what a member holds: a bad record costs the others of its member nothing.  Of a member that
can't be unpacked to its end, what was unpacked before is searched too, and records with a valid digest are kept.  Records and
gaps inside a member carry its place in the file; a broken member is a gap beside the records that it gave.

Defined cases: null html is an empty payload; a null page_id sorts last among equal payloads; repeated rows are
records of their own, all but one revisit the first; line breaks in urls are percent-encoded, a null url is
replaced by the record's id; an empty table gives no rows; further columns are ignored.

Plan: one shuffle of the pages by payload digest (equal payloads may be many; the join's sides are both shuffled, so
adaptive execution can split them), then one task per archive.  Archives are bounded by rows per file, where every
``ROW_BYTES`` bytes of a record count as a row: a file has at most ``ROWS_PER_FILE * ROW_BYTES`` bytes and one record more.
"""

from __future__ import annotations

import base64
import contextlib
import functools
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewire.storage import new_folder, stage

# Fixed values of the format.
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
REQUIRED = ("warc-type", "warc-record-id", "warc-date")
DATE = "2000-01-01T00:00:00Z"
#: An empty gzip member; it stands between records so that Spark's text writer can write members.
SPACER = "\x1f\x8b\x08\x00\x00\x00\x00\x00\x00\x03\x03\x00\x00\x00\x00\x00\x00\x00\x00\x00"
ROWS_PER_FILE = 4000
ROW_BYTES = 1 << 16

_START = re.compile(rb"WARC/1\.[01]\r?\n")
_CANDIDATE = re.compile(rb"\x1f\x8b\x08[\x00-\x1f]|WARC/1\.[01]\r?\n")
_PADDING = re.compile(rb"[\r\n\x00]+")


# --- records --------------------------------------------------------------------------------


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data, usedforsecurity=False).digest()).decode()


def record_id(page_id: int | None, row: int) -> str:
    return f"<urn:x-page:{'none' if page_id is None else page_id}:{row}>"


def record(page_id: int | None, row: int, url: str | None, payload: bytes, refers_to: str | None) -> bytes:
    """One record: a response with its payload, or a revisit that refers to another record."""
    own = record_id(page_id, row)
    target = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url) if url else own[1:-1]
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if refers_to else http + payload
    fields = [
        ("WARC-Type", "revisit" if refers_to else "response"), ("WARC-Record-ID", own), ("WARC-Date", DATE), ("WARC-Target-URI", target),
        ("Content-Type", "application/http; msgtype=response"), ("WARC-Payload-Digest", f"sha1:{sha1_base32(payload)}"), ("WARC-Block-Digest", f"sha1:{sha1_base32(block)}"),
        *([("WARC-Refers-To", refers_to), ("WARC-Profile", REVISIT_PROFILE)] if refers_to else []), ("Content-Length", str(len(block))),
    ]
    head = b"".join(f"{name}: {value}\r\n".encode() for name, value in fields)
    return VERSION + b"\r\n" + head + b"\r\n" + block + b"\r\n\r\n"


def member(data: bytes, level: int = 6) -> bytes:
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


class Damaged(Exception):
    """A check failed; the message names it."""


def read_record(data: bytes, at: int) -> tuple[dict[str, str], bytes, int]:
    """Header fields (lower-case names), payload and end of the record at a position; raises ``Damaged``."""
    start = _START.match(data, at)
    if not start:
        raise Damaged("version line")
    parts: dict[str, list[bytes]] = {}
    last, place = None, start.end()
    while True:
        stop = data.find(b"\r\n", place)
        if stop < 0:
            raise Damaged("header end")
        line, place = data[place:stop], stop + 2
        if not line:
            break
        if line[:1] in (b" ", b"\t") and last:
            parts[last].append(line.strip())
            continue
        name, colon, value = line.partition(b":")
        if not colon:
            raise Damaged("header field")
        last = name.strip().lower().decode("utf-8", "replace")
        if last in parts and last != "warc-concurrent-to":  # two headers run into one
            raise Damaged("repeated header field")
        parts[last] = [value.strip()]
    fields = {name: b" ".join(values).decode("utf-8", "replace") for name, values in parts.items()}
    if not fields.get("content-length", "").isascii() or not fields.get("content-length", "").isdigit():
        raise Damaged("content length")
    if not all(fields.get(name) for name in REQUIRED):
        raise Damaged("missing header field")
    begin = place
    end = begin + int(fields["content-length"])
    if end > len(data):
        raise Damaged("block end")
    if data[end : end + 4] != b"\r\n\r\n" and end + 4 <= len(data):
        raise Damaged("record end")
    block = data[begin:end]
    if (digest := fields.get("warc-block-digest", "")).startswith("sha1:") and digest[5:] != sha1_base32(block):
        raise Damaged("block digest")
    payload = block
    if fields.get("content-type", "").startswith("application/http"):
        payload = block.partition(b"\r\n\r\n")[2]
    if fields.get("warc-type") != "revisit" and (digest := fields.get("warc-payload-digest", "")).startswith("sha1:") and digest[5:] != sha1_base32(payload):
        raise Damaged("payload digest")
    return fields, payload, min(end + 4, len(data))


def _unpack(data: bytes, at: int) -> tuple[bytes, int, str | None]:
    """Content of the gzip member at a position, its end, and what broke it; of a broken one the content before the fault."""
    unpacker = zlib.decompressobj(31)
    parts, pos, window = [], at, 1 << 16
    while not unpacker.eof and pos < len(data):
        before = unpacker.copy()
        try:
            parts.append(unpacker.decompress(data[pos : pos + window]))
        except zlib.error:
            # The fault lies in this window; a byte at a time shows what comes out before it.
            with contextlib.suppress(zlib.error):
                for i in range(pos, min(pos + window, len(data))):
                    parts.append(before.decompress(data[i : i + 1]))
            return b"".join(parts), at, "compression"
        pos += window
    if not unpacker.eof:
        return b"".join(parts), at, "member end"
    return b"".join(parts), min(pos, len(data)) - len(unpacker.unused_data), None


def _inside(content: bytes) -> Iterator[tuple[dict[str, str] | None, bytes | str]]:
    """(fields, payload) of the records in unpacked content; (None, reason) for what lies between."""
    at, damaged = 0, False
    while at < len(content):
        if not damaged and (skip := _PADDING.match(content, at)):
            at = skip.end()
            continue
        try:
            fields, payload, end = read_record(content, at)
        except Damaged as damage:
            if not damaged:
                yield None, str(damage)
                damaged = True
            later = _START.search(content, at + 1)
            at = later.start() if later else len(content)
            continue
        yield fields, payload
        at, damaged = end, False


def _has_digest(fields: dict[str, str]) -> bool:
    return any(fields.get(name, "").startswith("sha1:") for name in ("warc-block-digest", "warc-payload-digest"))


def salvage(data: bytes) -> Iterator[tuple]:
    """('record', offset, length, fields, payload) and ('gap', offset, length, reason, None) in file order."""
    at, gap, reason = 0, -1, ""
    while at < len(data):
        found: list[tuple] = []
        broken: str | None = "version line"
        end = at
        if data.startswith(b"\x1f\x8b", at):
            content, end, broken = _unpack(data, at)
            found = [f for f in _inside(content) if not broken or f[0] and _has_digest(f[0])]
        elif _START.match(data, at):
            try:
                fields, payload, end = read_record(data, at)
                found, broken = [(fields, payload)], None
            except Damaged as damage:
                broken = str(damage)
        elif gap < 0 and (skip := _PADDING.match(data, at)):
            at = skip.end()
            continue
        if broken:
            later = _CANDIDATE.search(data, at + 1)
            end = later.start() if later else len(data)
        records = any(fields is not None for fields, _ in found)
        if gap >= 0 and records:
            yield "gap", gap, at - gap, reason, None
            gap = -1
        if records:
            for fields, what in found:
                yield ("gap", at, end - at, what, None) if fields is None else ("record", at, end - at, fields, what)
        if gap < 0 and (broken or found and not records):
            gap, reason = at, broken or found[0][1]
        at = end
    if gap >= 0:
        yield "gap", gap, len(data) - gap, reason, None


# --- Spark -------------------------------------------------------------------------------------


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        packed = []
        for page_id, row, url, html, refers in zip(*(batch.column(i).to_pylist() for i in range(3)), batch.column(3), batch.column(4).to_pylist(), strict=True):
            made = member(record(page_id, row, url, (html.as_py() or "").encode(), refers))
            # Empty rows, each an empty gzip member in the file, let a long record count as several rows.
            packed += [b""] * (len(made) // ROW_BYTES) + [made]
        yield pa.RecordBatch.from_arrays([pa.array(packed, pa.binary())], ["member"])


def write_archives(pages: DataFrame, path: str, *, min_payload: int = 0, rows_per_file: int = ROWS_PER_FILE) -> None:
    """Write one record per page; equal payloads of at least ``min_payload`` bytes after the first become revisits."""
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.monotonically_increasing_id().alias("row"), F.col("url").cast("string").alias("url"), html.alias("html"),
        F.unhex(F.sha1(html.cast("binary"))).alias("digest"),
    )
    order = F.struct(F.col("page_id").isNull().alias("none"), F.col("page_id").alias("page_id"), F.col("row").alias("row"))
    first = rows.groupBy("digest").agg(F.min(order).alias("first"))
    named = F.concat(F.lit("<urn:x-page:"), F.coalesce(F.col("first.page_id").cast("string"), F.lit("none")), F.lit(":"), F.col("first.row").cast("string"), F.lit(">"))
    refers: Column = F.when((F.octet_length("html") >= min_payload) & (F.col("first.row") != F.col("row")), named)
    chosen = rows.join(first, "digest").select("page_id", "row", "url", "html", refers.alias("refers_to"))
    (
        chosen.mapInArrow(_members, "member binary").select(F.col("member").cast("string"))
        .write.option("encoding", "ISO-8859-1").option("lineSep", SPACER).option("maxRecordsPerFile", rows_per_file).text(path)
    )


READ = "kind string, archive string, offset long, length long, reason string, record_id string, record_type string, target string, refers_to string, payload_digest string, payload_bytes long"


def _read(batches: Iterator[pa.RecordBatch], with_payload: bool) -> Iterator[pa.RecordBatch]:
    names = [f.split()[0] for f in READ.split(", ")] + ["payload"] * with_payload
    types = [pa.string(), pa.string(), pa.int64(), pa.int64(), *[pa.string()] * 6, pa.int64()] + [pa.binary()] * with_payload

    def as_batch(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows, strict=True) if rows else [[]] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    for batch in batches:
        for place in range(batch.num_rows):
            archive, rows, held = batch.column(0)[place].as_py(), [], 0
            for kind, offset, length, what, payload in salvage(batch.column(1)[place].as_py()):
                if kind == "gap":
                    row = (kind, archive, offset, length, what, *[None] * 6)
                else:
                    digest = what.get("warc-payload-digest", "").removeprefix("sha1:") or None
                    revisit = what.get("warc-type") == "revisit"
                    row = (kind, archive, offset, length, None, what.get("warc-record-id"), what.get("warc-type"), what.get("warc-target-uri"), what.get("warc-refers-to"), digest, None if revisit else len(payload))
                rows.append(row + (payload,) * with_payload)
                held += len(payload or b"")
                if len(rows) >= 10_000 or with_payload and held > 1 << 23:
                    yield as_batch(rows)
                    rows, held = [], 0
            if rows:
                yield as_batch(rows)


def read_archives(spark: SparkSession, path: str, *, with_payload: bool = True) -> DataFrame:
    """Records and quarantined gaps of all archives below a folder, in any state they are in."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "content")
    return files.mapInArrow(functools.partial(_read, with_payload=with_payload), READ + ", payload binary" * with_payload)


def round_trip(pages: DataFrame) -> DataFrame:
    """Write the pages, read the archives back and describe every page by its record."""
    spark = pages.sparkSession
    path = new_folder(spark, "warc-archives")
    write_archives(pages, path)
    read = stage(read_archives(spark, path, with_payload=False).filter("kind = 'record'"), "warc-records")
    id_of = lambda c: F.expr(f"try_cast(split_part({c}, ':', 3) as bigint)")
    full = read.filter("record_type = 'response'").select(F.col("record_id").alias("refers_to"), F.col("payload_bytes").alias("full_bytes"))
    return read.join(full, "refers_to", "left").select(
        id_of("record_id").alias("page_id"), F.coalesce("payload_bytes", "full_bytes").alias("payload_bytes"), "payload_digest", "record_type", id_of("refers_to").alias("refers_to")
    )
