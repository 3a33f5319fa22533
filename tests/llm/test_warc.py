"""WARC writer and salvage reader: round trips, damage, and the SQL twin."""

import base64
import gzip
import hashlib
import random

import duckdb

from queuelens.llm import warc
from queuelens.llm.sql import ORACLE
from tests.helpers import rows

SCHEMA = "page_id bigint, html string"


def record(number: int, body: bytes) -> bytes:
    digest = base64.b32encode(hashlib.sha1(body).digest())
    return (b"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:%d>\r\n" % number
            + b"WARC-Block-Digest: sha1:" + digest + b"\r\nContent-Length: %d\r\n\r\n" % len(body)
            + body + b"\r\n\r\n")


def ids(found: warc.Salvage) -> list[int]:
    return [int(r.fields["warc-record-id"][10:-1]) for r in found.records]


BODIES = [random.Random(n).randbytes(300 * n).hex().encode() for n in range(1, 8)]
PLAIN = [record(n, b) for n, b in enumerate(BODIES)]


def test_whole_files_have_no_gap():
    for parts in (PLAIN, [gzip.compress(p) for p in PLAIN], [PLAIN[0], gzip.compress(PLAIN[1]), PLAIN[2]]):
        found = warc.salvage(b"".join(parts))
        assert ids(found) == list(range(len(parts))) and found.gaps == []
        assert [r.block for r in found.records] == BODIES[:len(parts)]


def test_one_damaged_record_is_quarantined_and_the_rest_recovered():
    for parts in (PLAIN, [gzip.compress(p) for p in PLAIN]):
        starts = [sum(map(len, parts[:n])) for n in range(8)]
        for n in range(7):
            data = bytearray(b"".join(parts))
            data[starts[n] + len(parts[n]) // 2] ^= 255
            found = warc.salvage(bytes(data))
            assert ids(found) == [i for i in range(7) if i != n]
            assert [g[:2] for g in found.gaps] == [(starts[n], starts[n + 1])]


def test_cut_files_junk_and_wrong_lengths():
    data = b"".join(PLAIN)
    assert ids(warc.salvage(data[:-5])) == list(range(6))
    assert warc.salvage(b"") == warc.Salvage()
    found = warc.salvage(b"junk" + data + b"WARC/1.0\r\nx")
    assert ids(found) == list(range(7)) and [g[:2] for g in found.gaps] == [
        (0, 4), (4 + len(data), len(data) + 15)]
    longer = data.replace(b"Content-Length: %d" % len(BODIES[2]), b"Content-Length: 99999999")
    assert ids(warc.salvage(longer)) == [0, 1, 3, 4, 5, 6]


def test_a_version_line_inside_a_payload_is_payload():
    body = b"x\r\n\r\nWARC/1.0\r\nContent-Length: 1\r\n\r\ny\r\n\r\nz"
    found = warc.salvage(record(1, body) + record(2, b"end"))
    assert ids(found) == [1, 2] and found.records[0].block == body


def test_round_trip_and_sql_twin(spark):
    long = "é" * 600
    pages = spark.createDataFrame(
        [(1, long), (2, long), (3, long), (4, None), (5, ""), (6, "short"), (7, "short"),
         (8, "WARC/1.0\r\n\r\n\r\nContent-Length: 3\r\n\r\nabc" * 50), (9, "x" * 999), (10, "x" * 999),
         (11, "y" * 1000), (12, "y" * 1000), (12, "y" * 1000)], SCHEMA)
    result = warc.round_trip(pages.selectExpr("*", "'u' AS url", "7 AS bytes"))
    connection = duckdb.connect()
    connection.register("pages", pages.toArrow())
    expected = connection.sql(ORACLE["op9_warc"])
    key = lambda r: [(v is not None, str(v)) for v in r]
    assert rows(result, *expected.columns) == sorted(expected.fetchall(), key=key)


def test_reading_damaged_archives_with_spark(spark, tmp_path):
    data = bytearray(b"".join(PLAIN))
    data[len(PLAIN[0]) + len(PLAIN[1]) // 2] ^= 255
    (tmp_path / "a.warc").write_bytes(bytes(data))
    (tmp_path / "b.warc.gz").write_bytes(b"".join(gzip.compress(p) for p in PLAIN[:2]))
    read = warc.read(spark, str(tmp_path)).cache()
    assert read.where("gap IS NULL").count() == 8
    assert [(r.start, r.stop) for r in read.where("gap IS NOT NULL").collect()] == [
        (len(PLAIN[0]), len(PLAIN[0]) + len(PLAIN[1]))]


def test_empty_table(spark):
    assert warc.round_trip(spark.createDataFrame([], SCHEMA)).count() == 0
