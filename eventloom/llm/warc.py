"""Operator 5, WARC archives with a salvage reader.

Writing: each row becomes a record. Of rows with equal payloads (of at least
``least`` bytes) the one with the largest id is a response and the others are
revisits that refer to it. Records are built as columns and written by Spark's text sink,
whose line separator is the blank lines that end a record, so each part file is
a WARC file on whatever store the path names, and a lost task is written again
by the ordinary commit protocol.

Payloads may be very long: a record is held whole while it is written or read, a file
by the task that reads it. Pages that are archived and read back fail on a gap: no page is lost unseen.

Reading: a record is accepted if its header lines are well-formed, its length
lies in the file, its block digest matches and blank lines end it; a gzip
member must inflate whole, with its checksum, to one such record. After a
failed check the reader searches for the next version line or member that is
accepted, goes on from there, and logs the bytes between as a quarantined gap.

Null payloads are empty; an empty file has no records. Rows that repeat an id
and a payload have the same kind of record. Rows of a null id are written
and read back with a null id; if it is the only id of equal payloads, all are responses.
A null address has no header line; white space and control characters in
addresses are percent-encoded or left out. Empty tables give empty results; extra columns
are not read.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.llm.common import split_by_ids, stage
from eventloom.llm.exact_dedup import join_summary
from eventloom.session import scratch_path

VERSION = "WARC/1.1"
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD_ID = "urn:page:"
#: Bytes that a part file aims at.
FILE_BYTES = 8 << 20
END = b"\r\n\r\n"
_ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32_of_hex(digest: Column) -> Column:
    """Upper-case base32 of a hexadecimal SHA-1 column (40 digits: 8 groups of 20 bits)."""
    out = []
    for i in range(8):
        bits = F.conv(F.substring(digest, 5 * i + 1, 5), 16, 10).cast("int")
        for shift in (15, 10, 5, 0):
            out.append(F.substring(F.lit(_ALPHABET), F.shiftright(bits, shift).bitwiseAND(31) + 1, F.lit(1)))
    return F.concat(*out)


def plan_records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", least: int = 0) -> DataFrame:
    """(id, url, payload, sha1, refers_to) with refers_to set on revisits."""
    payload = F.coalesce(F.col(payload_col).cast("string"), F.lit(""))
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumn("sha1", F.sha1(F.col("payload").cast("binary"))).withColumn("row", F.xxhash64("id", "sha1"))
    digests = stage(rows.filter(F.octet_length("payload") >= least).select("id", "row", "sha1"), "warc-digests")
    winners = join_summary(digests, "sha1", F.max("id").alias("refers_to"))
    revisits = stage(winners.filter("NOT (id <=> refers_to) AND refers_to IS NOT NULL").select("row", "refers_to").distinct(), "warc-revisits")
    # Only rows that may be revisits are shuffled with their payload.
    maybe, no = split_by_ids(rows, "row", revisits.select("row"))
    joined = maybe.join(revisits, "row", "left")
    return joined.select("id", "url", "payload", "sha1", "refers_to").unionByName(no.withColumn("refers_to", F.lit(None).cast(revisits.schema["refers_to"].dataType)).drop("row"))


def record_text(rows: DataFrame, date: str = DATE) -> DataFrame:
    """One string column, a record without the blank lines that end it."""
    digest = base32_of_hex(F.col("sha1"))
    revisit = F.col("refers_to").isNotNull()
    block = F.when(revisit, F.lit("")).otherwise(F.col("payload"))
    address = F.col("url")
    for code in (0x09, 0x0A, 0x0D, 0x20):
        address = F.replace(address, F.lit(chr(code)), F.lit(f"%{code:02X}"))
    address = F.regexp_replace(address, r"[\x00-\x1f\x7f]", "")
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    uri = lambda c: F.concat(F.lit(f"<{RECORD_ID}"), F.coalesce(c.cast("string"), F.lit("")), F.lit(">"))
    empty = base64.b32encode(hashlib.sha1(b"").digest()).decode()
    header = F.concat(
        F.lit(f"{VERSION}\r\n"),
        line("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        line("WARC-Record-ID", uri(F.col("id"))),
        line("WARC-Date", F.lit(date)),
        F.coalesce(line("WARC-Target-URI", address), F.lit("")),
        F.when(revisit, F.concat(line("WARC-Profile", F.lit(PROFILE)), line("WARC-Refers-To", uri(F.col("refers_to"))))).otherwise(F.lit("")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), digest)),
        line("WARC-Block-Digest", F.concat(F.lit("sha1:"), F.when(revisit, F.lit(empty)).otherwise(digest))),
        line("X-Payload-Length", F.octet_length("payload").cast("string")),
        line("Content-Type", F.lit("text/html; charset=utf-8")),
        line("Content-Length", F.octet_length(block).cast("string")),
        F.lit("\r\n"),
    )
    return rows.select(F.concat(header, block).alias("value"))


def write_archives(rows: DataFrame, path: str, file_bytes: int = FILE_BYTES, date: str = DATE) -> None:
    """Write the rows of ``plan_records`` as WARC files of about ``file_bytes`` below ``path``."""
    n, size = rows.agg(F.count("*"), F.sum(F.octet_length("payload"))).first()
    per_file = max(int(file_bytes * n / ((size or 0) + 500 * n + 1)), 1)
    record_text(rows, date).write.option("lineSep", END.decode()).option("maxRecordsPerFile", per_file).text(path)


# Reading -------------------------------------------------------------------------------------


@dataclass
class Item:
    """A record, or (``reason`` set) a quarantined gap, at [offset, offset + length) of a file."""

    offset: int
    length: int
    reason: str | None = None
    headers: dict[str, str] = field(default_factory=dict)
    block: bytes = b""
    inside: bool = False  # found within what a failed record declares to be its block


class _Bad(Exception):
    """A failed check, and where the record declares its block to end (0: it does not)."""

    def __init__(self, reason: str, end: int = 0):
        super().__init__(reason)
        self.end = end


#: Bytes of a header line, and of a member that are inflated at a time.
MOST_LINE, STEP = 1 << 16, 1 << 16


_NUMBER = re.compile(r"[0-9]{1,18}")


_VERSION = re.compile(rb"WARC/1\.[01]\r\n")


def _headers(data: bytes, at: int) -> tuple[dict[str, str], int]:
    """The header lines of the record at ``at`` and the offset of its block, a line at a time."""
    version = _VERSION.match(data, at)
    if not version:
        raise _Bad("no version line")
    headers: dict[str, str] = {}
    line = version.end()
    while True:
        stop = data.find(b"\r\n", line, line + MOST_LINE)
        if stop < 0:
            raise _Bad("header does not end")
        if stop == line:
            return headers, stop + 2
        name, colon, value = data[line:stop].partition(b":")
        if not colon or not name or name.strip() != name:
            raise _Bad("malformed header line")
        key = name.decode("latin-1").lower()
        if key in headers and key != "warc-concurrent-to":
            raise _Bad("repeated header line")
        headers[key] = value.strip().decode("utf-8", "replace")
        line = stop + 2


def _record(data: bytes, at: int) -> tuple[Item, int]:
    """The plain record at ``at`` and the offset behind it."""
    headers, start = _headers(data, at)
    size = headers.get("content-length", "")
    if not _NUMBER.fullmatch(size):
        raise _Bad("no valid length")
    end = start + int(size)
    if end > len(data):
        raise _Bad("truncated block", len(data))
    block = data[start:end]
    if data[end : end + len(END)] != END:
        raise _Bad("no blank lines behind the block", end)
    wanted = headers.get("warc-block-digest", "")
    if wanted.startswith("sha1:") and base64.b32encode(hashlib.sha1(block).digest()).decode() != wanted[5:]:
        raise _Bad("block digest differs", end)
    return Item(at, end + len(END) - at, None, headers, block), end + len(END)


def _member(data: bytes, at: int) -> tuple[Item, int]:
    """The record in the gzip member at ``at`` and the offset behind the member."""
    inflate = zlib.decompressobj(31)
    plain, behind = [], at
    try:
        while not inflate.eof:
            part = data[behind : behind + STEP]
            if not part:
                raise _Bad("truncated member")
            plain.append(inflate.decompress(part))
            behind += len(part)
    except zlib.error as e:
        raise _Bad("broken member") from e
    behind -= len(inflate.unused_data)
    text = b"".join(plain)
    item, end = _record(text, 0)
    if end != len(text):
        raise _Bad("member holds more than a record")
    return Item(at, behind - at, None, item.headers, item.block), behind


# Not only at line starts: a record that was cut off does not end its line.
_STARTS = re.compile(rb"\x1f\x8b\x08|WARC/1\.")


def salvage(data: bytes) -> Iterator[Item]:
    """Records and gaps of a file, in order; together they are the whole file.

    A failed record with a readable length declares where it ends. If the file ends there or
    a whole record follows, the length is right, and nothing of the record is taken for
    another one, whatever text its block holds. Else the search goes through it, and a
    record that lies before the declared end is marked ``inside``.
    """
    at, lost, reason, extent = 0, -1, "", 0
    while at < len(data):
        try:
            item, behind = _at(data, at)
        except _Bad as bad:
            if lost < 0:
                lost, reason = at, str(bad)
            then = bad.end + len(END)
            if bad.end > at and bad.end < len(data) and (then >= len(data) or _whole(data, then)):
                at = min(then, len(data))
                continue
            extent = max(extent, bad.end)
            found = _STARTS.search(data, at + 1)
            at = found.start() if found else len(data)
            continue
        if lost >= 0:
            yield Item(lost, at - lost, reason)
            lost = -1
        item.inside = behind <= extent
        yield item
        at = behind
    if lost >= 0:
        yield Item(lost, len(data) - lost, reason)


def _at(data: bytes, at: int) -> tuple[Item, int]:
    return (_member if data.startswith(b"\x1f\x8b", at) else _record)(data, at)


def _whole(data: bytes, at: int) -> bool:
    try:
        _at(data, at)
    except _Bad:
        return False
    return True


def compress_record(record: bytes) -> bytes:
    """A record, its ending blank lines included, as a gzip member of its own."""
    return gzip.compress(record, mtime=0)


def read_archives(spark: SparkSession, path: str, with_payload: bool = False) -> DataFrame:
    """(archive, offset, length, gap, inside, record_type, record_id, refers_to, target, payload_bytes, payload_digest[, payload]).

    Rows with ``gap`` set are quarantined bytes and the reason; the others are records, ``inside`` if they
    lie in what a failed record declares to be its block, so that they may be part of its payload.
    """

    def read(batches):
        names = ["archive", "offset", "length", "gap", "inside", "record_type", "record_id", "refers_to", "target", "payload_bytes", "payload_digest"]
        for batch in batches:
            for archive, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                rows, blocks = [], []
                for item in salvage(content.as_py()):
                    h = item.headers
                    size = h.get("x-payload-length", str(len(item.block)))
                    digest = h.get("warc-payload-digest", "")
                    rows.append(
                        (archive, item.offset, item.length, item.reason, item.inside, h.get("warc-type"), _bare(h.get("warc-record-id")), _bare(h.get("warc-refers-to")), h.get("warc-target-uri"))
                        + ((int(size), digest.removeprefix("sha1:")) if item.reason is None else (None, None))
                    )
                    blocks.append(item.block)
                kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.bool_(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string()]
                columns = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)] if rows else [pa.array([], k) for k in kinds]
                if with_payload:
                    columns.append(pa.array(blocks, pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, names + ["payload"] * with_payload)

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    schema = "archive string, offset long, length long, gap string, inside boolean, record_type string, record_id string, refers_to string, target string, payload_bytes long, payload_digest string"
    return files.mapInArrow(read, schema + ", payload binary" * with_payload)


def _bare(uri: str | None) -> str | None:
    """What follows the scheme in <urn:page:...>; other identifiers stay whole."""
    return None if uri is None else uri.removeprefix("<").removesuffix(">").removeprefix(RECORD_ID)


def archive_pages(pages: DataFrame, path: str | None = None, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", least: int = 0) -> DataFrame:
    """Write the pages' archives and read them back: (id, payload_bytes, payload_digest, record_type, refers_to, archive, offset)."""
    spark = pages.sparkSession
    kind = pages.schema[id_col].dataType
    path = path or scratch_path(spark, "warc")
    write_archives(plan_records(pages, id_col, url_col, payload_col, least), path)
    number = lambda c: F.when(F.col(c) != "", F.col(c)).cast(kind)
    # What was just written has no gaps; if the store damaged it, pages are missing and that must not pass unseen.
    lost = F.concat(F.lit("quarantined bytes in "), F.col("archive"), F.lit(" at "), F.col("offset").cast("string"), F.lit(": "), F.coalesce("gap", F.lit("record inside a failed one")))
    records = read_archives(spark, path)
    records = records.withColumn("record_type", F.when(F.col("gap").isNotNull() | F.col("inside"), F.raise_error(lost)).otherwise(F.col("record_type")))
    return records.select(number("record_id").alias(id_col), "payload_bytes", "payload_digest", "record_type", number("refers_to").alias("refers_to"), "archive", "offset")
