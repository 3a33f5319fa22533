"""Token ids of documents in a compressed, blocked file format, written and read back.

A file is a Parquet table of blocks. Each block holds up to ``BLOCK`` ids in the code of
``mixing``, with a CRC-32 of the ids, where its part of the table begins, and which
documents it holds. Blocks are coded independently, so any of them can be read alone.
Documents are in ascending order over the parts; one that does not fit in a block goes
on in blocks of its own.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from queuelens.llm.frames import bounded, kept, strings, texts_of
from queuelens.llm.mixing import decode, encode
from queuelens.llm.tokens import WordEncoder, vocabulary_path
from queuelens.session import shared_path

END = 2
BLOCK = 4096
# Blocks that are coded side by side at most: about those of a task, as a step costs calls more than arithmetic.
TOGETHER = 2560

BLOCKS = ("part int, block bigint, first bigint, n_ids int, crc32 bigint, doc_ids array<bigint>, "
          "doc_numbers array<bigint>, pieces array<bigint>, last array<boolean>, lengths array<bigint>, "
          "code binary")
PIECES = ("part int, doc_id bigint, doc_number bigint, piece bigint, last boolean, start bigint, "
          "length bigint, crc bigint")


class DamagedBlock(ValueError):
    """A block whose ids do not match its checksum."""


class _Filler:
    """Deals the documents of one part out to blocks."""

    def __init__(self) -> None:
        self.blocks: list[tuple[int, np.ndarray, list[tuple]]] = []
        self.parts: list[np.ndarray] = []
        self.docs: list[tuple] = []
        self.size = self.first = self.number = 0

    def close(self) -> None:
        if self.size:
            self.blocks.append((self.first, np.concatenate(self.parts), self.docs))
            self.first += self.size
            self.parts, self.docs, self.size = [], [], 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        if self.size + len(ids) > BLOCK:
            self.close()
        for piece, begin in enumerate(range(0, len(ids), BLOCK)):
            part = ids[begin:begin + BLOCK]
            self.parts.append(part)
            self.docs.append((doc_id, self.number, piece, begin + BLOCK >= len(ids), len(part)))
            self.size += len(part)
            if len(ids) > BLOCK:
                self.close()
        self.number += 1


def dealt(n: int) -> list[tuple[int, int]]:
    """``n`` blocks in as few stretches as can be, of about the same size: a few blocks cost nearly what many do."""
    stretches = -(-n // TOGETHER)
    bounds = [n * k // stretches for k in range(stretches + 1)] if n else []
    return list(zip(bounds, bounds[1:]))


def _crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4", copy=False))


def write(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", end: int = END,
          vocabulary: str | None = None) -> None:
    """The ids of every document, each followed by ``end``, in ascending order of its id.

    Null ids come first, and rows that repeat an id follow each other. Null text is empty.
    """
    names = vocabulary or vocabulary_path()
    rows = texts_of(docs, key, text)
    tie = F.xxhash64("text")
    ordered = rows.repartitionByRange("doc_id", tie).sortWithinPartitions("doc_id", tie)

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, filler, done = TaskContext.get().partitionId(), _Filler(), 0
        encode_words = WordEncoder(names).encode

        def coded(blocks: list) -> pa.RecordBatch:
            nonlocal done
            codes = encode([ids for _, ids, _ in blocks])
            of_docs = [list(zip(*docs)) for _, _, docs in blocks]
            columns = [[part] * len(blocks), range(done, done + len(blocks)), [b[0] for b in blocks],
                       [len(b[1]) for b in blocks], [_crc(b[1]) for b in blocks],
                       *([list(d[i]) for d in of_docs] for i in range(5)), codes]
            done += len(blocks)
            kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int64(),
                     *[pa.list_(pa.int64())] * 3, pa.list_(pa.bool_()), pa.list_(pa.int64()), pa.binary()]
            return pa.RecordBatch.from_arrays(
                [pa.array(list(c), k) for c, k in zip(columns, kinds)],
                names=["part", "block", "first", "n_ids", "crc32", "doc_ids", "doc_numbers", "pieces",
                       "last", "lengths", "code"])

        for batch in bounded(batches):
            ids, at = encode_words(strings(batch))
            for doc_id, a, b in zip(batch.column("doc_id").to_pylist(), at, at[1:]):
                filler.add(doc_id, np.append(ids[a:b], np.uint32(end)))
            while len(filler.blocks) >= 2 * TOGETHER:
                yield coded(filler.blocks[:TOGETHER])
                filler.blocks = filler.blocks[TOGETHER:]
        filler.close()
        for begin, until in dealt(len(filler.blocks)):
            yield coded(filler.blocks[begin:until])

    ordered.mapInArrow(compute, BLOCKS).write.parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """One row per piece of a document: its place in its part, length and CRC-32 of its ids.

    Every block is decoded and checked; a damaged one fails the job by its part and number.
    """
    blocks = spark.read.schema(BLOCKS).parquet(path)

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, until in dealt(batch.num_rows):
                rows = batch.slice(begin, until - begin).to_pylist()
                out = []
                for row, ids in zip(rows, decode([r["code"] for r in rows], [r["n_ids"] for r in rows])):
                    if _crc(ids) != row["crc32"]:
                        raise DamagedBlock(f"part {row['part']}, block {row['block']}")
                    at = 0
                    for doc, number, piece, last, length in zip(
                            row["doc_ids"], row["doc_numbers"], row["pieces"], row["last"], row["lengths"]):
                        out.append((row["part"], doc, number, piece, last, row["first"] + at, length,
                                    _crc(ids[at:at + length])))
                        at += length
                kinds = [pa.int32(), *[pa.int64()] * 3, pa.bool_(), *[pa.int64()] * 3]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*out), kinds)],
                    names=["part", "doc_id", "doc_number", "piece", "last", "start", "length", "crc"])

    return blocks.mapInArrow(compute, PIECES)


def joined_crc(pieces: list[tuple[int, int]]) -> int:
    """CRC-32 of byte strings put together, from the (CRC-32, length) of each.

    Appending n bytes multiplies what came before by x to the power 8n, modulo the
    polynomial of CRC-32 (bits reversed).
    """
    polynomial, one = 0xEDB88320, 1 << 31

    def times(a: int, b: int) -> int:
        product = 0
        for bit in range(31, -1, -1):
            if a >> bit & 1:
                product ^= b
            b = b >> 1 ^ (polynomial if b & 1 else 0)
        return product

    whole = 0
    for crc, n in pieces:
        power, square, bits = one, one >> 1, 8 * n
        while bits:
            if bits & 1:
                power = times(power, square)
            square, bits = times(square, square), bits >> 1
        whole = times(whole, power) ^ crc
    return whole


def documents_of(pieces: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) from pieces: ``start`` counts the ids of all parts before."""
    pieces = kept(pieces, "pieces")
    totals = pieces.groupBy("part").agg(F.sum("length").alias("n")).collect()  # one row per part
    before, so_far = [], 0
    for part, n in sorted(totals):
        before.append((part, so_far))
        so_far += n
    whole = pieces.where("piece = 0 AND last").select("part", "doc_id", "start", "length", "crc")
    several = pieces.where("NOT (piece = 0 AND last)").groupBy("part", "doc_number").agg(
        F.first("doc_id", ignorenulls=True).alias("doc_id"), F.min("start").alias("start"),
        F.sum("length").alias("length"),
        F.array_sort(F.collect_list(F.struct("piece", "crc", "length"))).alias("parts"))

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            crcs = [joined_crc([(p["crc"], 4 * p["length"]) for p in parts])
                    for parts in batch.column("parts").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:4], pa.array(crcs, pa.int64())],
                names=["part", "doc_id", "start", "length", "crc"])

    long = several.select("part", "doc_id", "start", "length", "parts").mapInArrow(
        joined, "part int, doc_id bigint, start bigint, length bigint, crc bigint")
    offsets = pieces.sparkSession.createDataFrame(before, "part int, before bigint")
    return whole.union(long).join(F.broadcast(offsets), "part").select(
        "doc_id", (F.col("start") + F.col("before")).alias("start"),
        F.col("length").alias("n_tokens"), F.col("crc").alias("ids_crc32"))


def round_trip(docs: DataFrame, key: str = "doc_id", text: str = "text", end: int = END,
               vocabulary: str | None = None) -> DataFrame:
    """``docs`` written to the shared folder in this format, and what the files say of each."""
    path = shared_path(docs.sparkSession, "tokens")
    write(docs, path, key, text, end, vocabulary)
    return documents_of(read(docs.sparkSession, path))
