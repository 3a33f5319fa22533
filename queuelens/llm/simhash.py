"""SimHash fingerprints, and their links at a few differing bits found in BK-trees.

Fingerprints within the radius agree on some pair of their six blocks of bits, so
each pair of blocks with its value is a shard, and links are looked for inside shards
only. A shard is a BK-tree: children are keyed by their integer Hamming distance to
the parent, and a search follows only edges within the radius of the distance met.
Trees travel to their task by the shuffle. They are never sent whole to every
executor, as all trees together grow with the corpus.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from queuelens.llm.components import connected_components
from queuelens.llm.frames import bounded, kept, strings, texts_of

SHINGLE = 4
SEED = 42
RADIUS = 4
# Fingerprints of one block of a large shard.
BLOCK = 8192
# Rows of complete shards that a task searches at a time, and (query, node) pairs in one go.
CHUNK = 131_072
FRONTIER = 4_000_000
# Shingles whose bits are laid out at a time.
LAID_OUT = 65_536


def _hashes(text: bytes) -> list[int]:
    words = text.lower().split()
    if len(words) < SHINGLE:
        return [xxhash.xxh64_intdigest(b" ".join(words), SEED)] if words else []
    joined = b" ".join(words)
    starts = list(accumulate((len(w) + 1 for w in words), initial=0))
    digest = xxhash.xxh64_intdigest
    return [digest(joined[a:b - 1], SEED) for a, b in zip(starts, starts[SHINGLE:])]


def fingerprint(texts: list[str]) -> np.ndarray:
    """The fingerprints (uint64) of whole texts; zero for a text without a word.

    Bytes are lower-cased and split, which touches A-Z and the six ASCII white-space
    characters only.
    """
    ones = np.zeros((len(texts), 64), np.int64)
    counts = np.zeros(len(texts), np.int64)
    held: list[int] = []
    rows: list[tuple[int, int]] = []

    def add() -> None:
        if not held:
            return
        bits = np.unpackbits(np.array(held, "<u8").view(np.uint8).reshape(-1, 8), axis=1,
                             bitorder="little")
        sizes = np.array([n for _, n in rows])
        sums = np.add.reduceat(bits, np.cumsum(sizes) - sizes, axis=0, dtype=np.int64)
        np.add.at(ones, [r for r, _ in rows], sums)
        held.clear()
        rows.clear()

    for row, text in enumerate(texts):
        hashes = _hashes(text.encode("utf-8", "surrogatepass"))
        counts[row] = len(hashes)
        for begin in range(0, len(hashes), LAID_OUT):
            part = hashes[begin:begin + LAID_OUT]
            held.extend(part)
            rows.append((row, len(part)))
            if len(held) >= LAID_OUT:
                add()
    add()
    majority = ones * 2 > counts[:, None]
    return np.packbits(majority, axis=1, bitorder="little").view("<u8").ravel()


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fp): one row per row of ``docs``, the fingerprint as a signed bigint."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bounded(batches):
            fps = fingerprint(strings(batch).to_pylist()).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(fps)],
                                             names=["doc_id", "fp"])

    return texts_of(docs, key, text).mapInArrow(compute, "doc_id bigint, fp bigint")


def bk_forest(fps: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One BK-tree per group of ``fps``, all built together, level by level.

    The first fingerprint of a group is the root. Those of a node's subtree that lie
    at the same distance from it form the subtree of one child. Returns the nodes'
    children and the numbers by which they are found: ``parent * 65 + distance``, sorted.
    """
    ends = np.append(starts[1:], len(fps))
    rest = np.setdiff1d(np.arange(len(fps)), starts, assume_unique=True)
    parent = np.repeat(starts, ends - starts)[rest]
    keys, children = [], []
    while len(rest):
        edge = parent * 65 + np.bitwise_count(fps[rest] ^ fps[parent])
        order = np.argsort(edge, kind="stable")
        rest, edge = rest[order], edge[order]
        new = np.append(True, edge[1:] != edge[:-1])
        nodes = rest[new]
        keys.append(edge[new])
        children.append(nodes)
        parent = np.repeat(nodes, np.diff(np.append(np.flatnonzero(new), len(rest))))[~new]
        rest = rest[~new]
    if not keys:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    found_by, child = np.concatenate(keys), np.concatenate(children)
    order = np.argsort(found_by)
    return child[order], found_by[order]


def _joined(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Give the two ends of every link, and all that carry their labels, the smaller label."""
    while True:
        x, y = label[a], label[b]
        apart = x != y
        if not apart.any():
            return
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while True:
            up = label[label]
            if (up == label).all():
                break
            label[:] = up


def linked(fps: np.ndarray, starts: np.ndarray, radius: int = RADIUS) -> np.ndarray:
    """For each fingerprint, the first of its group that it reaches over links."""
    children, found_by = bk_forest(fps, starts)
    sizes = np.diff(np.append(starts, len(fps)))
    root = np.repeat(starts, sizes)
    load = np.cumsum(np.repeat(sizes, sizes))
    label = np.arange(len(fps))
    cuts = np.searchsorted(load, np.arange(0, load[-1] + FRONTIER, FRONTIER))
    for begin, end in zip(cuts, np.append(cuts[1:], len(fps))):
        query, node = np.arange(begin, end), root[begin:end]
        while len(query):
            distance = np.bitwise_count(fps[query] ^ fps[node]).astype(np.int64)
            near = distance <= radius
            _joined(label, query[near], node[near])
            first = np.searchsorted(found_by, node * 65 + np.maximum(distance - radius, 0))
            last = np.searchsorted(found_by, node * 65 + np.minimum(distance + radius, 64), "right")
            count = last - first
            query = np.repeat(query, count)
            place = np.repeat(first - (np.cumsum(count) - count), count) + np.arange(len(query))
            node = children[place]
    return label


def _shards(fp: Column, radius: int) -> Column:
    """The shard numbers of a fingerprint: every pair of six blocks, with its bits.

    ``radius`` differing bits touch at most that many blocks, so two of six agree.
    """
    if radius > 4:
        raise ValueError("six blocks leave an equal pair for up to four differing bits")
    begins = [0, 11, 22, 33, 44, 54]
    widths = [11, 11, 11, 11, 10, 10]
    blocks = [F.shiftrightunsigned(fp, b).bitwiseAND(F.lit((1 << w) - 1).cast("bigint"))
              for b, w in zip(begins, widths)]
    pairs = combinations(range(6), 2)
    return F.array(*[
        F.lit(n << 22).cast("bigint") + blocks[i] * (1 << 11) + blocks[j]
        for n, (i, j) in enumerate(pairs)
    ])


def links(fps: DataFrame, radius: int = RADIUS, block: int = BLOCK) -> DataFrame:
    """Links (a, b) that connect the distinct fingerprints of ``fps`` (fp bigint).

    Any two within ``radius`` are connected through links, and every link joins
    fingerprints that are so connected. A shard above ``block`` rows is cut in blocks
    by hash, and any two blocks meet in a task of their own.
    """
    shards = fps.select("fp", F.explode(_shards(F.col("fp"), radius)).alias("shard"))
    sizes = shards.groupBy("shard").agg(F.count("*").alias("n")).where("n > 1")
    blocks = F.ceil(F.col("n") / block)
    own = F.pmod(F.xxhash64("fp"), F.col("blocks"))
    cells = (
        shards.join(sizes, "shard").withColumn("blocks", blocks).withColumn("own", own)
        .select("fp", "shard", "own", "blocks",
                F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)).alias("other"))
        .where("blocks = 1 OR own <> other")
        .select("fp", "shard", F.least("own", "other").alias("low"),
                F.greatest("own", "other").alias("high"))
        .repartition("shard", "low", "high").sortWithinPartitions("shard", "low", "high")
    )

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found(rows: np.ndarray) -> pa.RecordBatch:
            fp = np.ascontiguousarray(rows[:, 0])
            new = (rows[1:, 1:] != rows[:-1, 1:]).any(axis=1)
            starts = np.append(0, np.flatnonzero(new) + 1)
            label = linked(fp.view(np.uint64), starts, radius)
            tied = label != np.arange(len(label))
            return pa.RecordBatch.from_arrays(
                [pa.array(fp[tied]), pa.array(fp[label[tied]])], names=["a", "b"])

        held = np.zeros((0, 4), np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = np.stack([c.to_numpy() for c in batch.columns], axis=1)
            held = np.concatenate([held, rows])
            if len(held) < CHUNK:
                continue
            new = np.flatnonzero((held[1:, 1:] != held[:-1, 1:]).any(axis=1)) + 1
            if len(new):
                yield found(held[:new[-1]])
                held = held[new[-1]:]
        if len(held):
            yield found(held)

    return cells.mapInArrow(search, "a bigint, b bigint")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text",
                    radius: int = RADIUS) -> DataFrame:
    """(doc_id, fingerprint, component_id): one row per row of ``docs``.

    The component is the smallest doc_id reachable over fingerprints that differ in at
    most ``radius`` bits, the row's own included. Texts without a word, null ones too,
    have fingerprint zero and are linked like others. Null ids are passed over when the
    smallest is taken; repeated rows are one document. Extra columns are ignored.
    """
    of_docs = kept(fingerprints(docs, key, text), "fingerprints")
    distinct = kept(of_docs.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "distinct-fps")
    tied = connected_components(links(distinct, radius)).withColumnRenamed("node", "fp")
    rooted = distinct.join(tied, "fp", "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("root"))
    smallest = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    per_fp = rooted.join(smallest, "root").select("fp", "component_id")
    return of_docs.join(per_fp, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
