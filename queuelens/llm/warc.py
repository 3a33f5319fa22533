"""WARC archives: a writer, and a salvage reader that goes on after damage.

A record that fails a check (version line, header, length, end, block digest) is not
believed. The reader then looks for the next gzip member or version line from which a
whole record checks out, goes on there, and logs the bytes in between as quarantined.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from queuelens.llm.frames import kept
from queuelens.session import shared_path

VERSION = b"WARC/1.0\r\n"
VERSIONS = re.compile(rb"WARC/1\.[01]\r\n")
END = b"\r\n\r\n"
MEMBER = b"\x1f\x8b\x08"
# Payloads this long are stored once.
SHARED_BYTES = 1000
# About how many bytes go in one archive file, and in the header of a record.
FILE_BYTES = 32 << 20
HEADER_BYTES = 400
LONGEST_HEADER = 1 << 16
# Compressed bytes that are opened at a time.
READ_BYTES = 1 << 16
DATE = "1970-01-01T00:00:00Z"
ID = "urn:page:"


@dataclass
class Record:
    """One record; ``start`` and ``end`` are where its member or text lies in the file."""

    start: int
    end: int
    fields: dict[str, str]
    block: bytes


@dataclass
class Salvage:
    records: list[Record] = field(default_factory=list)
    gaps: list[tuple[int, int, str]] = field(default_factory=list)


class Damaged(ValueError):
    """Why a record is not believed."""


def _record(data: bytes, start: int) -> Record:
    """The plain record that starts at ``start``, or ``Damaged``."""
    version = VERSIONS.match(data, start)
    if not version:
        raise Damaged("no version line")
    limit = min(len(data), start + LONGEST_HEADER)
    head_end = data.find(END, start, limit)
    if head_end < 0:
        raise Damaged("no end of header")
    fields: dict[str, str] = {}
    for line in data[version.end():head_end].split(b"\r\n"):
        name, colon, value = line.partition(b":")
        if not colon:
            raise Damaged("header line without a name")
        fields[name.decode("utf-8", "replace").strip().lower()] = value.decode("utf-8", "replace").strip()
    size = fields.get("content-length", "")
    if not re.fullmatch("[0-9]{1,18}", size):
        raise Damaged("no length")
    begin = head_end + len(END)
    end = begin + int(size)
    if data[end:end + len(END)] != END:
        raise Damaged("no end of record where the length says")
    block = data[begin:end]
    digest = fields.get("warc-block-digest", "")
    if digest.lower().startswith("sha1:") and digest[5:] not in sha1_forms(block):
        raise Damaged("block digest differs")
    return Record(start, end + len(END), fields, block)


def _member(data: bytes, start: int) -> Record:
    """The gzip member at ``start``, which must hold exactly one whole record."""
    opened, parts, at = zlib.decompressobj(31), [], start
    while at < len(data) and not opened.eof:
        try:
            parts.append(opened.decompress(data[at:at + READ_BYTES]))
        except zlib.error as reason:
            raise Damaged(f"gzip: {reason}") from None
        at += READ_BYTES
    if not opened.eof:
        raise Damaged("gzip member is cut short")
    plain = b"".join(parts)
    record = _record(plain, 0)
    if record.end != len(plain):
        raise Damaged("more than one record in a member")
    end = min(at, len(data)) - len(opened.unused_data)
    return Record(start, end, record.fields, record.block)


def salvage(data: bytes) -> Salvage:
    """All records that check out, in order, and the byte gaps between them with a reason."""
    out = Salvage()
    at, gap, reason = 0, None, ""
    next_of = {MEMBER: 0, b"WARC/1.": 0}
    while at < len(data):
        try:
            record = _member(data, at) if data.startswith(MEMBER, at) else _record(data, at)
        except Damaged as why:
            if gap is None:
                gap, reason = at, str(why)
            for sign, place in next_of.items():
                if 0 <= place <= at:
                    next_of[sign] = data.find(sign, at + 1)
            ahead = [p for p in next_of.values() if p > at]
            at = min(ahead, default=len(data))
            continue
        if gap is not None:
            out.gaps.append((gap, record.start, reason))
            gap = None
        out.records.append(record)
        at = record.end
    if gap is not None:
        out.gaps.append((gap, len(data), reason))
    return out


def sha1_forms(block: bytes) -> tuple[str, str]:
    """The SHA-1 of a block in the two ways that archives write it."""
    digest = hashlib.sha1(block)
    return base64.b32encode(digest.digest()).decode(), digest.hexdigest()


def _header(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit("\r\n"))


def with_references(pages: DataFrame, key: str, payload: str) -> DataFrame:
    """``pages`` with digest, bytes and ``refers_to``: the largest id of an equal, long payload.

    Equal means the same length, SHA-1 and SHA-256. The id is null for the payload's own
    response, for short payloads, and where the id is null. Only digests are shuffled to
    find revisits; Spark broadcasts these if they are few and shuffles payloads if not.
    """
    text = F.coalesce(F.col(payload), F.lit(""))
    raw = F.encode(text, "UTF-8")
    same = ["sha2", "sha1", "bytes"]
    rows = pages.select(F.col(key).alias("page_id"), text.alias("payload"), F.sha1(raw).alias("sha1"),
                        F.sha2(raw, 256).alias("sha2"), F.octet_length(text).alias("bytes"))
    long = kept(rows.where(F.col("bytes") >= SHARED_BYTES).select("page_id", *same), "digests")
    largest = long.groupBy(*same).agg(F.max("page_id").alias("refers_to"), F.count("*").alias("n"))
    revisits = kept(
        long.join(largest.where("n > 1").drop("n"), same).where("page_id <> refers_to").distinct(),
        "revisits")
    return rows.join(revisits, ["page_id", *same], "left")


def record_text(rows: DataFrame) -> DataFrame:
    """The text of one WARC record per row of ``with_references``, without its end."""
    revisit = F.col("refers_to").isNotNull()
    block = F.when(revisit, F.lit("")).otherwise(F.col("payload"))
    block_sha1 = F.sha1(F.encode(block, "UTF-8"))
    length = F.when(revisit, F.lit(0)).otherwise(F.col("bytes"))
    number = F.coalesce(F.col("page_id").cast("string"), F.lit(""))
    text = F.concat(
        F.lit(VERSION.decode()),
        _header("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        _header("WARC-Record-ID", F.concat(F.lit(f"<{ID}"), number, F.lit(">"))),
        _header("WARC-Date", F.lit(DATE)),
        _header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1"))),
        F.when(revisit, _header("WARC-Refers-To", F.concat(
            F.lit(f"<{ID}"), F.col("refers_to").cast("string"), F.lit(">")))).otherwise(F.lit("")),
        _header("WARC-Block-Digest", F.concat(F.lit("sha1:"), block_sha1)),
        F.lit("Content-Type: text/html\r\n"),
        _header("Content-Length", length), F.lit("\r\n"), block)
    return rows.select(text.alias("value"))


def write(pages: DataFrame, path: str, key: str = "page_id", payload: str = "html") -> None:
    """One record per page below ``path``, in files of plain records (Spark's text writer).

    A record ends with two line ends, which is what separates the rows of the text files.
    """
    rows = with_references(pages, key, payload)
    size = F.octet_length(F.coalesce(F.col(payload), F.lit("")))
    mean = pages.agg(F.coalesce(F.avg(size), F.lit(0.0))).first()[0]
    per_file = max(1, int(FILE_BYTES / (mean + HEADER_BYTES)))
    record_text(rows).write.option("lineSep", END.decode()).option(
        "maxRecordsPerFile", per_file).text(path)


RECORDS = ("path string, start bigint, stop bigint, kind string, record_id string, refers_to string, "
           "payload_digest string, payload binary, gap string")


def read(spark: SparkSession, path: str) -> DataFrame:
    """The records and quarantined gaps of all archives below ``path``.

    Each archive is read whole by one task. Records have ``gap`` null; gaps have only
    path, start, stop and ``gap``, the reason of the first failure.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column("path").to_pylist(), batch.column("content")):
                found = salvage(content.as_py())
                rows = [(name, r.start, r.end, r.fields.get("warc-type"), r.fields.get("warc-record-id"),
                         r.fields.get("warc-refers-to"), r.fields.get("warc-payload-digest"), r.block, None)
                        for r in found.records]
                rows += [(name, a, b, None, None, None, None, None, why) for a, b, why in found.gaps]
                kinds = [pa.string(), pa.int64(), pa.int64(), *[pa.string()] * 4, pa.binary(), pa.string()]
                names = ["path", "start", "stop", "kind", "record_id", "refers_to", "payload_digest",
                         "payload", "gap"]
                for begin in range(0, len(rows), 500):
                    columns = zip(*rows[begin:begin + 500])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    return files.select("path", "content").mapInArrow(compute, RECORDS)


def _number(column: str) -> Column:
    text = F.regexp_extract(F.col(column), rf"{ID}(-?[0-9]+)", 1)
    return F.when(text != "", text.cast("bigint"))


def pages_of(records: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) from read records.

    The length of a revisit is that of the response it refers to; null if that is lost.
    """
    rows = kept(records.where("gap IS NULL").select(
        _number("record_id").alias("page_id"),
        F.octet_length("payload").cast("bigint").alias("payload_bytes"),
        F.regexp_replace("payload_digest", "^sha1:", "").alias("payload_digest"),
        F.col("kind").alias("record_type"), _number("refers_to").alias("refers_to")), "records")
    responses = rows.where("record_type = 'response'").groupBy(
        F.col("page_id").alias("refers_to"), "payload_digest").agg(F.max("payload_bytes").alias("whole"))
    joined = rows.where("record_type = 'revisit'").join(responses, ["refers_to", "payload_digest"], "left")
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return rows.where("record_type = 'response'").select(columns).union(
        joined.withColumn("payload_bytes", F.col("whole")).select(columns))


def round_trip(pages: DataFrame, key: str = "page_id", payload: str = "html") -> DataFrame:
    """``pages`` written as archives in the shared folder, and what is read back from them."""
    path = shared_path(pages.sparkSession, "warc")
    write(pages, path, key, payload)
    return pages_of(read(pages.sparkSession, path))
