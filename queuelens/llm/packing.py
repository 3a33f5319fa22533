"""Hierarchical residual packing of documents into sequences of a fixed length.

Every task fits its pieces best-fit, longest first. Bins that are nearly full are
done. The others go up a tree as single items: fewer and fewer tasks fit them
again, best-fit, up to one task; more bins than one task holds stay in as few as hold them.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from queuelens.llm.frames import bounded, kept, strings, texts_of
from queuelens.llm.tokens import WordEncoder, vocabulary_path

LENGTH = 2048
END = 0
# A bin with at most this many free places is nearly full.
SLACK = 8
# Items that one task fits at a time.
ITEMS = 400_000
# Tasks whose underfull bins meet in one task of the next round.
FAN_IN = 8

PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


def pieces(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH,
           end: int = END, vocabulary: str | None = None) -> DataFrame:
    """One row per piece of at most ``length`` ids; a document's ids end with ``end``.

    A null or empty text is the end id alone. Repeated rows give repeated pieces.
    """
    path = vocabulary or vocabulary_path()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = WordEncoder(path).encode
        for batch in bounded(batches):
            ids, at = encode(strings(batch))
            sizes = np.diff(at) + 1
            counts = -(-sizes // length)
            row = np.repeat(np.arange(len(sizes)), counts)
            piece = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
            start = piece * length
            size = np.minimum(length, sizes[row] - start)
            raw = ids.astype("<u4", copy=False)
            last = np.asarray([end], "<u4").tobytes()
            crcs = []
            for r, s, n in zip(row.tolist(), start.tolist(), size.tolist()):
                begin, stop = int(at[r]) + s, int(at[r + 1])
                crc = zlib.crc32(raw[begin:min(begin + n, stop)])
                crcs.append(zlib.crc32(last, crc) if begin + n > stop else crc)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(row)), pa.array(piece, pa.int32()),
                 pa.array(start, pa.int64()), pa.array(size, pa.int64()),
                 pa.array(crcs, pa.int64())],
                names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return texts_of(docs, key, text).mapInArrow(cut, PIECES)


def best_fit(sizes: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best-fit decreasing: the bin and offset of each item, and how full each bin is.

    A bit mask holds which numbers of free places occur, so the tightest bin for an
    item is found with one shift.
    """
    bins = np.empty(len(sizes), np.int64)
    offsets = np.empty(len(sizes), np.int64)
    free: list[list[int]] = [[] for _ in range(length + 1)]
    mask, fills = 0, []
    for item in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[item])
        fitting = mask >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            chosen = free[room].pop()
            if not free[room]:
                mask ^= 1 << room
        else:
            chosen, room = len(fills), length
            fills.append(0)
        bins[item], offsets[item] = chosen, fills[chosen]
        fills[chosen] += size
        left = room - size
        if left:
            free[left].append(chosen)
            mask |= 1 << left
    return bins, offsets, np.asarray(fills, np.int64)


def _fitted(items: DataFrame, size: str, length: int, level: int) -> DataFrame:
    """``items`` with the bin (a number unique over all rounds), the place in it and its fill."""

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, made, held = (level << 56) | (TaskContext.get().partitionId() << 28), 0, []

        def packed() -> pa.RecordBatch:
            nonlocal made
            table = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            bins, offsets, fills = best_fit(table.column(size).to_numpy(), length)
            begin, made = base + made, made + len(fills)
            held.clear()
            return pa.RecordBatch.from_arrays(
                [*table.columns, pa.array(begin + bins), pa.array(offsets),
                 pa.array(fills[bins])],
                names=[*table.schema.names, "bin", "place", "fill"])

        for batch in batches:
            if batch.num_rows:
                held.append(batch)
            if sum(b.num_rows for b in held) >= ITEMS:
                yield packed()
        if held:
            yield packed()

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in items.schema)
    return items.mapInArrow(fit, f"{schema}, bin bigint, place bigint, fill bigint")


def pack(items: DataFrame, size: str, length: int = LENGTH) -> DataFrame:
    """``items`` with ``sequence_id`` and ``offset``, in few sequences of at most ``length``.

    ``size`` is a bigint column with values from 1 to ``length``. Sequences are
    gapless from offset 0. No two items share places and no item is split.
    """
    first = kept(_fitted(items, size, length, 0), "packed-0")
    bins = first.where((F.col("place") == 0) & (F.col("fill") < length - SLACK)).select(
        F.col("bin").alias("item"), F.col("fill").alias("size"))
    width, level, moved = first.rdd.getNumPartitions(), 0, None
    before = width + 1
    while True:
        level += 1
        count = bins.count()
        width = max(1, -(-width // FAN_IN), -(-count // ITEMS))
        if count < 2 or width >= before:
            break
        before = width
        fitted = kept(_fitted(bins.repartition(width, "item"), "size", length, level),
                      f"packed-{level}")
        step = fitted.select("item", F.col("bin").alias("into"), F.col("place").alias("by"))
        if moved is None:
            moved = step
        else:
            above = step.select(F.col("item").alias("into"), F.col("into").alias("__into"),
                                F.col("by").alias("__by"))
            moved = moved.join(above, "into", "left").select(
                "item", F.coalesce("__into", "into").alias("into"),
                (F.col("by") + F.coalesce("__by", F.lit(0))).alias("by"))
        if width == 1:
            break
        bins = fitted.where((F.col("place") == 0) & (F.col("fill") < length - SLACK)).select(
            F.col("bin").alias("item"), F.col("fill").alias("size"))
    if moved is None:
        placed = first.withColumns({"into": F.col("bin"), "by": F.lit(0).cast("bigint")})
    else:
        placed = first.join(moved.withColumnRenamed("item", "bin"), "bin", "left")
    return placed.select(
        *items.columns,
        F.coalesce("into", "bin").alias("sequence_id"),
        (F.col("place") + F.coalesce("by", F.lit(0))).alias("offset"))


def pack_documents(docs: DataFrame, key: str = "doc_id", text: str = "text",
                   length: int = LENGTH, end: int = END,
                   vocabulary: str | None = None) -> DataFrame:
    """The pieces of all documents with the sequence and offset of each."""
    return pack(pieces(docs, key, text, length, end, vocabulary), "length", length)
