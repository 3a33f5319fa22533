"""Exact duplicates by a minimal perfect hash over the distinct digests of an earlier delivery.

The history is cut into shards by the top bits of its digests. Every shard gets a minimal
perfect hash: digests claim places of a bit map, those alone at a place keep it, the others
try again on the next level. The number of bits set before a place is the slot. A slot holds
the full 32 bytes of its digest and where the text that stays is found, so a lookup is one
hash, one comparison of bytes, and no wrong answer. New rows are combined by digest before
they are looked up: members join the text of their slot, the others form groups of their own.
Shards are rows of a table and travel by the shuffle, as all of them grow with the corpus.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from queuelens.llm.frames import kept, texts_of
from queuelens.session import shared_path

# What two texts may differ in and still be equal (fixed values).
BLANKS = r"[\x20\x09-\x0D]+"
# Digests of one shard, about, and new digests that one task looks up in a shard.
SHARD = 65_536
# Places of a level for each digest that is still without one, and the most levels.
PLACES, LEVELS = 2, 32
MULTIPLIERS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)

WINNER = "n_chars bigint, doc_id bigint, row bigint, size bigint"
INDEX = ("shard int, sizes array<int>, bits binary, digests array<binary>, "
         "n_chars array<bigint>, doc_ids array<bigint>, rows array<bigint>, counts array<bigint>")
FOUND = f"digest binary, {WINNER}, old_n_chars bigint, old_doc_id bigint, old_row bigint, old_size bigint"


def place(words: np.ndarray, level: int, size: int) -> np.ndarray:
    """The place (of ``size``) that each digest, as four uint64, claims on a level."""
    a, b, c = (np.uint64(m) for m in MULTIPLIERS)
    value = words[:, 0] ^ (words[:, 1] + np.uint64(level)) * a ^ words[:, 2] * b
    value ^= value >> np.uint64(29)
    value = (value + words[:, 3] * np.uint64(2 * level + 1)) * c
    return ((value >> np.uint64(32)) * np.uint64(size) >> np.uint64(32)).astype(np.int64)


def build(words: np.ndarray) -> tuple[list[int], np.ndarray, np.ndarray]:
    """(size of each level, bit map of all levels, slot of each digest) of distinct digests.

    A level of size 0 ends the list if some digests found no place; their slots come last.
    """
    sizes, maps, left = [], [], np.arange(len(words))
    slots = np.zeros(len(words), np.int64)
    before = 0
    for level in range(LEVELS):
        if not len(left):
            break
        size = max(64, PLACES * len(left))
        at = place(words[left], level, size)
        alone = np.bincount(at, minlength=size) == 1
        mine = alone[at]
        slots[left[mine]] = before + np.cumsum(alone)[at[mine]] - 1
        before += int(mine.sum())
        sizes.append(size)
        maps.append(alone)
        left = left[~mine]
    if len(left):
        sizes.append(0)
        slots[left] = before + np.arange(len(left))
    return sizes, np.concatenate(maps) if maps else np.zeros(0, bool), slots


def lookup(words: np.ndarray, sizes: list[int], bits: np.ndarray, held: np.ndarray) -> np.ndarray:
    """The slot of each digest, or -1; ``held`` has the digest (four uint64) of every slot."""
    rank = np.cumsum(bits) - 1
    found, left, begin = np.full(len(words), -1), np.arange(len(words)), 0
    for level, size in enumerate(sizes):
        if not size:
            break
        at = begin + place(words[left], level, size)
        hit = bits[at]
        slot = rank[at[hit]]
        same = (held[slot] == words[left[hit]]).all(axis=1)
        found[left[hit][same]] = slot[same]
        left, begin = left[~hit], begin + size
    if sizes and not sizes[-1] and len(left):
        first = int(bits.sum())
        rest = {d.tobytes(): first + i for i, d in enumerate(held[first:])}
        found[left] = [rest.get(words[i].tobytes(), -1) for i in left]
    return found


def _words(digests: pa.Array) -> np.ndarray:
    """Digests of 32 bytes as rows of four uint64."""
    joined = b"".join(digests.to_pylist())
    return np.frombuffer(joined, "<u8").reshape(-1, 4)


def digests(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(row, doc_id, digest, n_chars), written once: a number for every row of ``docs``, the
    SHA-256 of its text without blanks, and the code points of the whole text. Null is empty."""
    rows = texts_of(docs, key, text)
    digest = F.unhex(F.sha2(F.regexp_replace("text", BLANKS, ""), 256))
    return kept(rows.select(F.monotonically_increasing_id().alias("row"), "doc_id",
                            digest.alias("digest"), F.length("text").cast("bigint").alias("n_chars")),
                "digests")


def winners(rows: DataFrame) -> DataFrame:
    """Per digest, its size and the row that stays: most code points, smallest id, smallest row.

    Every task combines its rows first, so a text that is everywhere burdens no one.
    """
    # Numbers are flipped bit by bit, which turns their order and leaves nulls the least.
    turned = rows.select("digest", "n_chars", F.bitwise_not("doc_id").alias("id"),
                         F.bitwise_not("row").alias("row"))
    return turned.groupBy("digest").agg(
        F.max(F.struct("n_chars", "id", "row")).alias("w"), F.count("*").alias("size")
    ).select("digest", "w.n_chars", F.bitwise_not("w.id").alias("doc_id"),
             F.bitwise_not("w.row").alias("row"), "size")


def _shard(shards: int) -> Column:
    """The shard of a digest: its first 31 bits, cut evenly."""
    top = F.conv(F.hex(F.substring("digest", 1, 4)), 16, 10).cast("bigint")
    return F.shiftright(F.shiftright(top, 1) * shards, 31).cast("int")


def write_index(history: DataFrame, path: str, shard_size: int = SHARD) -> None:
    """The index over ``winners`` rows, one row per shard, written to ``path``."""
    shards = max(1, -(-history.count() // shard_size))

    def of_shard(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        words = _words(table.column("digest"))
        sizes, bits, slots = build(words)
        order = np.argsort(slots)
        inside = table.take(pa.array(order))
        columns = [[key[0].as_py()], [sizes], [np.packbits(bits).tobytes()],
                   *([inside.column(c).to_pylist()] for c in ("digest", "n_chars", "doc_id", "row", "size"))]
        kinds = [pa.int32(), pa.list_(pa.int32()), pa.binary(), pa.list_(pa.binary()),
                 *[pa.list_(pa.int64())] * 4]
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)],
                        names=["shard", "sizes", "bits", "digests", "n_chars", "doc_ids", "rows", "counts"])

    history.withColumn("shard", _shard(shards)).groupBy("shard").applyInArrow(
        of_shard, INDEX).write.parquet(path)
    written = history.sparkSession.createDataFrame([(shards,)], "shards int")
    written.coalesce(1).write.parquet(f"{path}-shards")


def look_up(spark: SparkSession, path: str, new: DataFrame, shard_size: int = SHARD) -> DataFrame:
    """``new`` (``winners`` rows) with the winner of the slot that holds the same digest, if any."""
    shards = spark.read.schema("shards int").parquet(f"{path}-shards").first().shards
    chunks = max(1, -(-new.count() // (shards * shard_size)))
    index = spark.read.schema(INDEX).parquet(path).withColumn(
        "chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))
    dealt = new.withColumns({"shard": _shard(shards),
                             "chunk": F.pmod(F.xxhash64("digest"), F.lit(chunks)).cast("int")})

    def probe(key: tuple[pa.Scalar, ...], held: pa.Table, asked: pa.Table) -> pa.Table:
        columns = [asked.column(c) for c in ("digest", "n_chars", "doc_id", "row", "size")]
        old = [pa.nulls(asked.num_rows, pa.int64())] * 4
        if held.num_rows and asked.num_rows:
            sizes = held.column("sizes")[0].as_py()
            bits = np.unpackbits(np.frombuffer(held.column("bits")[0].as_py(), np.uint8),
                                 count=sum(sizes)).view(bool)
            slot = lookup(_words(columns[0]), sizes, bits, _words(held.column("digests")[0].values))
            at = pa.array(slot, mask=slot < 0)
            old = [held.column(c)[0].values.take(at) for c in ("n_chars", "doc_ids", "rows", "counts")]
        return pa.table([*columns, *old], names=[f.split()[0] for f in FOUND.split(", ")])

    return index.groupBy("shard", "chunk").cogroup(dealt.groupBy("shard", "chunk")).applyInArrow(probe, FOUND)


def slots(spark: SparkSession, path: str) -> DataFrame:
    """The ``winners`` rows that an index holds, one per slot."""
    of_slot = F.explode(F.arrays_zip("digests", "n_chars", "doc_ids", "rows", "counts")).alias("w")
    return spark.read.schema(INDEX).parquet(path).select(of_slot).select(
        F.col("w.digests").alias("digest"), "w.n_chars", F.col("w.doc_ids").alias("doc_id"),
        F.col("w.rows").alias("row"), F.col("w.counts").alias("size"))


def merged(old: DataFrame, found: DataFrame) -> DataFrame:
    """``winners`` rows over both deliveries: slots, the new rows that met them, and the others."""
    flipped = [F.bitwise_not(c) for c in ("doc_id", "row", "old_doc_id", "old_row")]
    mine = F.struct(F.col("n_chars").alias("n"), flipped[0].alias("id"), flipped[1].alias("row"))
    theirs = F.struct(F.col("old_n_chars").alias("n"), flipped[2].alias("id"), flipped[3].alias("row"))
    new = found.select(
        "digest", F.when(F.col("old_row").isNotNull(), F.greatest(mine, theirs)).otherwise(mine).alias("w"),
        (F.col("size") + F.coalesce("old_size", F.lit(0))).alias("size"),
    ).select("digest", F.col("w.n").alias("n_chars"), F.bitwise_not("w.id").alias("doc_id"),
             F.bitwise_not("w.row").alias("row"), "size")
    met = found.where("old_row IS NOT NULL").select("digest")
    return old.join(met, "digest", "left_anti").unionByName(new)


def remove_repeats(docs: DataFrame, first: Column, key: str = "doc_id", text: str = "text",
                   shard_size: int = SHARD) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256): one row per row of ``docs``.

    The rows for which ``first`` (a condition on doc_id) holds are the history that is
    indexed; all others are looked up in it. Of equal texts the row with the most code
    points, then the smallest id (null last), then the first of rows that agree in both
    stays. Null texts are empty, and all texts without a character are equal. Extra columns
    are ignored; an empty table gives no rows.
    """
    spark = docs.sparkSession
    rows = digests(docs, key, text)
    early = F.coalesce(first, F.lit(False))
    path = shared_path(spark, "digest-index")
    write_index(kept(winners(rows.where(early)), "history"), path, shard_size)
    found = kept(look_up(spark, path, kept(winners(rows.where(~early)), "delivery"), shard_size), "found")
    repeated = merged(slots(spark, path), found).where("size > 1").select(
        "digest", F.col("doc_id").alias("keep_id"), F.col("row").alias("keep_row"), "size")
    return rows.join(repeated, "digest", "left").select(
        "doc_id",
        F.when(F.col("keep_row").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("size", F.lit(1).cast("bigint")).alias("group_size"),
        F.coalesce(F.col("keep_row") == F.col("row"), F.lit(True)).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"))
