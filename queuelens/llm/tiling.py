"""Benchmark decontamination by greedy string tiling.

Documents and test items that share a run of ``SHORTEST`` tokens are joined on its
Karp-Rabin hash. Each pair is then tiled: the longest common run that no tile covers
yet becomes a tile, again and again, so passages are found in whatever order a document
has them. A pair counts if the tiles cover enough of the item.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from queuelens.llm.frames import bounded, kept, strings, texts_of

SHORTEST = 5
COVERAGE = 0.5
# Bits of the map that tells which seeds cannot occur in any item: 2 MB at least, 64 MB at most,
# and between them so many that one in BITS_A_SEED is set.
FEWEST_MAP_BITS, MOST_MAP_BITS, BITS_A_SEED = 24, 29, 16
BASE = 0x9E3779B97F4A7C15
WORD = re.compile(r"[^\W_]+")
# Words whose hashes a task remembers.
REMEMBERED = 200_000

REGIONS = "row_id bigint, doc_id bigint, length int, start bigint, tokens array<bigint>, seeds array<bigint>"


class _Hashes(dict):
    """Hash of each word; forgets all when it holds too many."""

    def __missing__(self, word: str) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        self[word] = value = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"))
        return value


def windows(tokens: np.ndarray, length: int = SHORTEST) -> np.ndarray:
    """Karp-Rabin hashes (uint64, wrapping) of all windows of ``length`` tokens."""
    count = max(0, len(tokens) - length + 1)
    value = np.zeros(count, np.uint64)
    for i in range(length):
        value = value * np.uint64(BASE) + tokens[i:i + count]
    return value


def _tokens(texts: list[str], hashes: _Hashes) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes of all texts one after the other, and where each text ends."""
    found = [WORD.findall(t.lower()) for t in texts]
    ends = np.cumsum([len(f) for f in found])
    values = np.fromiter((hashes[w] for f in found for w in f), np.uint64, int(ends[-1]))
    return values, ends


def tiles(item: np.ndarray, text: np.ndarray, shortest: int = SHORTEST) -> list[tuple[int, int, int]]:
    """Greedy string tiling: (place in item, place in text, length) of each tile.

    Tiles do not overlap on either side. The longest comes first, ties by place in the
    item, then in the text. No common run of ``shortest`` tokens is left uncovered.
    """
    of_item, of_text = windows(item, shortest), windows(text, shortest)
    if not len(of_item) or not len(of_text):
        return []
    order = np.argsort(of_item, kind="stable")
    first = np.searchsorted(of_item[order], of_text)
    count = np.searchsorted(of_item[order], of_text, "right") - first
    at_text = np.repeat(np.arange(len(of_text)), count)
    at_item = order[np.repeat(first - (np.cumsum(count) - count), count) + np.arange(len(at_text))]
    same = np.ones(len(at_text), bool)
    for i in range(shortest):
        same &= item[at_item + i] == text[at_text + i]
    at_item, at_text = at_item[same], at_text[same]
    if not len(at_item):
        return []
    # Windows that follow each other on a diagonal are one common run.
    order = np.lexsort((at_item, at_text - at_item))
    at_item, at_text = at_item[order], at_text[order]
    new = np.append(True, (np.diff(at_item) != 1) | (np.diff(at_text) != 1))
    starts = np.flatnonzero(new)
    lengths = np.diff(np.append(starts, len(at_item))) + shortest - 1
    queue = list(zip((-lengths).tolist(), at_item[starts].tolist(), at_text[starts].tolist()))
    heapq.heapify(queue)
    marked_item, marked_text = bytearray(len(item)), bytearray(len(text))
    made = []
    while queue:
        length, i, t = heapq.heappop(queue)
        length = -length
        covered = bytes(a | b for a, b in zip(marked_item[i:i + length], marked_text[t:t + length]))
        if not any(covered):
            marked_item[i:i + length] = marked_text[t:t + length] = b"\x01" * length
            made.append((i, t, length))
            continue
        for free in re.finditer(b"\x00+", covered):
            if free.end() - free.start() >= shortest:
                heapq.heappush(queue, (free.start() - free.end(), i + free.start(), t + free.start()))
    return made


def _seed_map(spark: SparkSession, seeds: DataFrame) -> np.ndarray:
    """A map of bits with the bit that the top of a seed names set for every seed."""
    wanted = max(1, seeds.count() * BITS_A_SEED).bit_length()
    bits = min(MOST_MAP_BITS, max(FEWEST_MAP_BITS, wanted))
    top = F.shiftrightunsigned("seed", 64 - bits) + 1
    parts = seeds.select(top.alias("top")).groupBy(F.bitmap_bucket_number("top").alias("n")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("top")).alias("bits"))
    whole = np.zeros(1 << (bits - 3), np.uint8)
    for part in parts.toLocalIterator():
        begin = (part.n - 1) * 4096
        whole[begin:begin + 4096] = np.frombuffer(part.bits, np.uint8)
    return whole


def _in_map(keys: np.ndarray, seed_map: np.ndarray) -> np.ndarray:
    """Which of the hashes may be seeds."""
    shift = np.uint64(64 - 3 - (len(seed_map).bit_length() - 1))
    top = (keys >> shift).astype(np.int64)
    return np.flatnonzero(seed_map[top >> 3] >> (top & 7).astype(np.uint8) & 1)


def _item_rows(items: DataFrame, key: str, text: str) -> DataFrame:
    """(item_id, item, length, seeds, at): the tokens of each item, the length and hashes of its
    seeds, and the place of each. Items shorter than ``SHORTEST`` are one seed."""
    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _Hashes()
        for batch in bounded(batches):
            values, ends = _tokens(strings(batch).to_pylist(), hashes)
            each = np.split(values, ends[:-1])
            lengths = [min(SHORTEST, len(e)) for e in each]
            seeds = [windows(e, n) if n else windows(e) for e, n in zip(each, lengths)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([e.view(np.int64) for e in each], pa.list_(pa.int64())),
                 pa.array(lengths, pa.int32()),
                 pa.array([s.view(np.int64) for s in seeds], pa.list_(pa.int64())),
                 pa.array([np.arange(len(s)) for s in seeds], pa.list_(pa.int32()))],
                names=["item_id", "item", "length", "seeds", "at"])

    return texts_of(items, key, text).mapInArrow(
        compute, "item_id bigint, item array<bigint>, length int, seeds array<bigint>, at array<int>")


def _regions(docs: DataFrame, maps: dict[int, np.ndarray]) -> DataFrame:
    """The stretches of each document that seeds of ``SHORTEST`` tokens cover, with their tokens and
    seeds; and shorter seeds as stretches without tokens. ``maps`` has a map for each length."""
    shared = docs.sparkSession.sparkContext.broadcast(maps)

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        maps, hashes = shared.value, _Hashes()
        row = TaskContext.get().partitionId() << 33
        for batch in bounded(batches):
            values, ends = _tokens(strings(batch).to_pylist(), hashes)
            begins = np.append(0, ends[:-1])
            for length, seed_map in maps.items():
                keys = windows(values, length)
                hit = _in_map(keys, seed_map)
                of = np.searchsorted(ends, hit, "right")
                inside = hit + length <= ends[of]
                hit, of = hit[inside], of[inside]
                if not len(hit):
                    continue
                gap = np.diff(hit) >= length if length == SHORTEST else np.zeros(len(hit) - 1, bool)
                starts = np.flatnonzero(np.append(True, gap | (np.diff(of) != 0)))
                lasts = np.append(starts[1:], len(hit)) - 1
                ids = batch.column("doc_id").take(pa.array(of[starts]))
                tokens = [values[a:b + SHORTEST].view(np.int64) if length == SHORTEST else []
                          for a, b in zip(hit[starts], hit[lasts])]
                seeds = [np.unique(keys[hit[a:b + 1]]).view(np.int64) for a, b in zip(starts, lasts)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row + of[starts]), ids, pa.array(np.full(len(starts), length), pa.int32()),
                     pa.array(hit[starts] - begins[of[starts]]),
                     pa.array(tokens, pa.list_(pa.int64())), pa.array(seeds, pa.list_(pa.int64()))],
                    names=["row_id", "doc_id", "length", "start", "tokens", "seeds"])
            row += batch.num_rows

    return docs.mapInArrow(compute, REGIONS)


def _candidates(regions: DataFrame, tests: DataFrame, coverage: float) -> DataFrame:
    """(row_id, item_id) of documents whose shared seeds could cover enough of an item.

    Tiles that cover the share c of n tokens hold at least m = ceil(c n / 5) places of seeds. So
    a pair that counts shares one that is not among the m - 1 places whose seeds are in most
    documents, and only the others are joined. Then the tokens that the shared places and the
    left-out ones cover are counted, and must be enough.
    """
    long = tests.where(F.col("length") == SHORTEST).withColumn("n", F.size("item"))
    spare = (F.ceil(F.col("n") * coverage / SHORTEST) - 1).cast("int")
    placed = long.select("item_id", "n", spare.alias("spare"), F.explode(F.arrays_zip("seeds", "at")).alias("s")).select(
        "item_id", "n", "spare", F.col("s.seeds").alias("seed"), "s.at")
    seen = regions.where(F.col("length") == SHORTEST).select("row_id", "start", F.explode("seeds").alias("seed"))
    common = seen.groupBy("seed").agg(F.count("*").alias("documents"))
    by_use = Window.partitionBy("item_id").orderBy(F.desc("documents"), "seed", "at")
    # A place whose seed is nowhere is shared by no document.
    ranked = placed.join(common, "seed").withColumn("use", F.row_number().over(by_use))
    left_out = ranked.where("use <= spare").groupBy("item_id").agg(F.collect_list("at").alias("out"))
    joined = kept(ranked.where("use > spare").join(left_out, "item_id", "left").select(
        "item_id", "n", "seed", "at", F.coalesce("out", F.array().cast("array<int>")).alias("out")), "item-seeds")
    pairs = seen.join(joined.select("item_id", "seed", "at"), "seed").groupBy("row_id", "item_id").agg(
        F.collect_set("at").alias("shared"))
    of_item = joined.groupBy("item_id").agg(F.first("n").alias("n"), F.first("out").alias("out"))
    places = F.array_sort(F.array_union("shared", "out"))
    ahead = F.zip_with(places, F.slice(places, 2, F.greatest(F.size(places), F.lit(1))),
                       lambda a, b: F.least(F.coalesce(b - a, F.lit(SHORTEST)), F.lit(SHORTEST)))
    most = F.aggregate(ahead, F.lit(0), lambda total, x: total + x)
    return pairs.join(of_item, "item_id").where(most >= F.col("n") * coverage).select("row_id", "item_id")


def contaminated(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text",
                 item_key: str = "item_id", item_text: str = "text",
                 coverage: float = COVERAGE) -> DataFrame:
    """(doc_id, item_id, item_tokens, covered, n_tiles, coverage) of every pair found.

    Tokens are runs of letters and digits, lower-cased. A pair is found if tiles of five
    tokens or more cover at least the share ``coverage`` of the item's tokens; an item of fewer
    than five tokens is found where a document holds all of it, as one tile. Rows that
    repeat an id are separate documents or items. Null texts are empty, and items without a token are
    never found. Extra columns are ignored.
    """
    spark = docs.sparkSession
    # Items go by a number of their own, as ids may be null or repeat.
    named = kept(_item_rows(items, item_key, item_text).withColumn(
        "number", F.monotonically_increasing_id()), "items")
    tests = named.drop("item_id").withColumnRenamed("number", "item_id")
    names = named.select(F.col("number").alias("item_id"), F.col("item_id").alias("name"), "item")
    item_seeds = tests.select("item_id", "length", F.explode("seeds").alias("seed"))
    # One row a length, five at most.
    lengths = [r.length for r in item_seeds.groupBy("length").count().collect()]
    maps = {n: _seed_map(spark, item_seeds.where(F.col("length") == n)) for n in sorted(lengths)}
    regions = kept(_regions(texts_of(docs, key, text), maps), "regions")
    pairs = (
        regions.where(F.col("length") == SHORTEST).select("row_id", "doc_id", "start", "tokens")
        .join(_candidates(regions, tests, coverage), "row_id")
        .groupBy("row_id", "item_id").agg(
            F.first("doc_id").alias("doc_id"),
            F.array_sort(F.collect_list(F.struct("start", "tokens"))).alias("regions"))
        .join(names, "item_id")
        .select("doc_id", F.col("name").alias("item_id"), "item", F.col("regions.tokens").alias("regions"))
    )
    short = item_seeds.where(F.col("length") < SHORTEST)
    whole = regions.where(F.col("length") < SHORTEST).select(
        "row_id", "doc_id", "length", F.explode("seeds").alias("seed")).join(short, ["length", "seed"]).join(
        names.select("item_id", "name"), "item_id").select(
        "doc_id", F.col("name").alias("item_id"), F.col("length").cast("bigint").alias("item_tokens"),
        F.col("length").cast("bigint").alias("covered"), F.lit(1).cast("bigint").alias("n_tiles"),
        F.lit(1.0).alias("coverage"))

    def tile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc, number, item, parts in zip(*(c.to_pylist() for c in batch.columns)):
                item = np.array(item, np.int64).view(np.uint64)
                found = tiles(item, _spaced(parts))
                covered = sum(length for _, _, length in found)
                if covered >= coverage * len(item):
                    rows.append((doc, number, len(item), covered, len(found), covered / len(item)))
            columns = list(zip(*rows)) or [[]] * 6
            kinds = [pa.int64()] * 5 + [pa.float64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), k) for c, k in zip(columns, kinds)],
                names=["doc_id", "item_id", "item_tokens", "covered", "n_tiles", "coverage"])

    found = pairs.mapInArrow(
        tile, "doc_id bigint, item_id bigint, item_tokens bigint, covered bigint, "
              "n_tiles bigint, coverage double")
    return found.unionByName(whole) if min(lengths, default=SHORTEST) < SHORTEST else found


def _spaced(parts: list[list[int]]) -> np.ndarray:
    """The regions one after the other, each ended by a token that no word has."""
    gap = np.array([0], np.int64)
    joined = [a for p in parts for a in (np.array(p, np.int64), gap)]
    return np.concatenate(joined).view(np.uint64)
