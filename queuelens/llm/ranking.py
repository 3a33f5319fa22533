"""Ranked lexical search without an index of the documents.

All terms of the items go into one Aho-Corasick automaton, each with a guard before and
after it, so that only whole terms match. Documents are scanned once: bytes that are part of
no term become the guard, and the automaton counts how often each term occurs. Its outputs
are numbers of terms, which map to the items that hold them. Scores need counts over all
documents, so the hits are written and scored in a second, narrow pass. Every task keeps
the best documents of each item, and only those meet in a shuffle.

An automaton and its items are sent to all executors. Items with more terms than one may hold
are cut in blocks, and each block scans the documents with an automaton of its own.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from queuelens.llm.frames import bounded, kept, strings, texts_of
from queuelens.plans.ordered import first_rows

# Terms are runs of letters and digits, and of everything beyond ASCII (fixed values).
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
GUARD = b" "
PLAIN = bytes(b if b > 127 or chr(b).isalnum() else GUARD[0] for b in range(256)).lower()
BEST = 50
# Pairs of an item and a term in a block, and their bytes; both are checked before the broadcast.
PAIRS, PAIR_BYTES = 1_000_000, 32 << 20
# Scores, or contributions to scores, laid out at a time; and candidates held until they are cut.
CELLS = 2_000_000
CANDIDATES = 1_000_000

HITS = "row bigint, doc_id bigint, n bigint, terms array<int>, tfs array<bigint>"


def pairs_of(items: DataFrame, key: str = "item_id", text: str = "text") -> DataFrame:
    """The distinct (item_id, term) of all items; rows that repeat an id are one item."""
    lowered = F.translate(F.col(text).cast("string"), UPPER, LOWER)
    return items.select(F.col(key).cast("bigint").alias("item_id"),
                        F.explode(F.regexp_extract_all(lowered, F.lit(TERM), F.lit(0))).alias("term")).distinct()


class Block:
    """Some items: their terms, and for each term which of the items hold it."""

    def __init__(self, pairs: list[tuple[int | None, str]]):
        self.items = sorted({i for i, _ in pairs}, key=lambda i: (i is None, i or 0))
        self.terms = sorted({t for _, t in pairs})
        item, term = ({v: n for n, v in enumerate(values)} for values in (self.items, self.terms))
        held = sorted((term[t], item[i]) for i, t in pairs)
        self.item = np.array([i for _, i in held], np.int64)
        self.begin = np.searchsorted([t for t, _ in held], np.arange(len(self.terms) + 1))

    def automaton(self):
        import ahocorasick

        made = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for number, term in enumerate(self.terms):
            made.add_word((GUARD + term.encode() + GUARD).decode("latin-1"), number)
        made.make_automaton()
        return made


def scan(docs: DataFrame, block: Block) -> DataFrame:
    """Per row of ``docs`` (doc_id, text) its terms in all, and each term of the block with its count."""
    shared = docs.sparkSession.sparkContext.broadcast(block)
    guard = GUARD.decode()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton, second = shared.value.automaton(), itemgetter(1)
        row = TaskContext.get().partitionId() << 33
        for batch in bounded(batches):
            texts = strings(batch).cast(pa.large_binary())
            ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
            # An empty column may come without a data buffer.
            raw = texts.buffers()[2]
            plain = (raw.to_pybytes() if raw else b"")[ends[0]:ends[-1]].translate(PLAIN)
            at = ends - ends[0]
            inside = np.frombuffer(plain, np.uint8) != GUARD[0]
            starts = inside.copy()
            starts[1:] &= ~inside[:-1]
            first = at[:-1][at[:-1] < len(plain)]
            starts[first] = inside[first]
            numbers = np.append(0, np.cumsum(starts))
            found = [
                Counter(map(second, automaton.iter(guard + plain[a:b].decode("latin-1") + guard)))
                if automaton.kind else {} for a, b in zip(at.tolist(), at[1:].tolist())]
            offsets = np.append(0, np.cumsum([len(f) for f in found])).astype(np.int32)
            size = int(offsets[-1])
            terms = np.fromiter((t for f in found for t in f), np.int32, size)
            tfs = np.fromiter((n for f in found for n in f.values()), np.int64, size)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(row, row + batch.num_rows)), batch.column("doc_id"),
                 pa.array(numbers[at[1:]] - numbers[at[:-1]]),
                 pa.ListArray.from_arrays(offsets, terms), pa.ListArray.from_arrays(offsets, tfs)],
                names=["row", "doc_id", "n", "terms", "tfs"])
            row += batch.num_rows

    return docs.mapInArrow(count, HITS)


def weights(n_terms: int, n_docs: int, frequencies: dict[int, int]) -> np.ndarray:
    """The weight of every term of a block, from the number of documents that hold it."""
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * frequencies.get(t, 0) + 1)))
                     for t in range(n_terms)], np.int64)


class Best:
    """The ``most`` best documents of each item met so far."""

    def __init__(self, items: int, most: int):
        self.most, self.floor, self.held, self.size = most, np.ones(items, np.int64), [], 0

    def add(self, item: np.ndarray, score: np.ndarray, doc: np.ndarray, unnamed: np.ndarray,
            row: np.ndarray) -> None:
        self.held.append((item, score, doc, unnamed, row))
        self.size += len(item)
        if self.size > CANDIDATES:
            self.cut()

    def cut(self) -> tuple[np.ndarray, ...]:
        """Leave the best of each item, which are returned."""
        columns = [np.concatenate(c) for c in zip(*self.held)] or [np.zeros(0, np.int64)] * 5
        item, score, doc, unnamed, row = columns
        order = np.lexsort((row, doc, unnamed, -score, item))
        sorted_items = item[order]
        place = np.arange(len(order)) - np.searchsorted(sorted_items, sorted_items)
        full = place == self.most - 1
        self.floor[sorted_items[full]] = score[order[full]]
        left = tuple(c[order[place < self.most]] for c in columns)
        self.held, self.size = [left], len(left[0])
        return left


def best_of_tasks(hits: DataFrame, block: Block, weight: np.ndarray, n_docs: int, n_terms: int,
                  most: int) -> DataFrame:
    """(item, item_id, doc_id, row, score): the best ``most`` documents of each item and task."""
    shared = hits.sparkSession.sparkContext.broadcast((block, weight))
    m = F.expr(f"50 + CAST(n AS DECIMAL(18,0)) * CAST({50 * n_docs} AS DECIMAL(20,0)) div {max(1, n_terms)}")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, weight = shared.value
        width, holders = len(block.items), np.diff(block.begin)
        best = Best(width, most)
        for batch in batches:
            row, m = batch.column("row").to_numpy(), batch.column("m").to_numpy()
            unnamed = batch.column("doc_id").is_null().to_numpy(zero_copy_only=False)
            doc = batch.column("doc_id").fill_null(0).to_numpy()
            sizes = batch.column("terms").value_lengths().to_numpy()
            term = batch.column("terms").flatten().to_numpy()
            tf = batch.column("tfs").flatten().to_numpy()
            of = np.repeat(np.arange(len(sizes)), sizes)
            gain = weight[term] * (1_000_000_000 * tf // (1000 * tf + 20 * m[of]))
            load = np.cumsum(width + np.bincount(of, holders[term], len(sizes)).astype(np.int64))
            ends = np.append(0, np.cumsum(sizes))
            begin = 0
            while begin < len(sizes):
                until = load[begin - 1] if begin else 0
                end = max(begin + 1, int(np.searchsorted(load, until + CELLS, "right")))
                part = slice(ends[begin], ends[end])
                count = holders[term[part]]
                place = np.repeat(block.begin[term[part]] - (np.cumsum(count) - count), count)
                place += np.arange(len(place))
                scores = np.zeros((end - begin) * width, np.int64)
                np.add.at(scores, np.repeat(of[part] - begin, count) * width + block.item[place],
                          np.repeat(gain[part], count))
                at, item = np.nonzero(scores.reshape(-1, width) >= best.floor)
                best.add(item, scores[at * width + item], doc[begin + at], unnamed[begin + at], row[begin + at])
                begin = end
        if best.held:
            item, points, doc, unnamed, row = best.cut()
            ids = pa.array(block.items, pa.int64()).take(pa.array(item))
            yield pa.RecordBatch.from_arrays(
                [pa.array(item), ids, pa.array(doc, mask=unnamed.astype(bool)), pa.array(row), pa.array(points)],
                names=["item", "item_id", "doc_id", "row", "score"])

    return hits.where("n > 0").select("row", "doc_id", m.alias("m"), "terms", "tfs").mapInArrow(
        score, "item bigint, item_id bigint, doc_id bigint, row bigint, score bigint")


def _ranked_block(docs: DataFrame, block: Block, most: int) -> DataFrame:
    hits = kept(scan(docs, block), "hits")
    n_docs, n_terms = hits.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    holding = hits.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    weight = weights(len(block.terms), n_docs, {r.term: r.df for r in holding.collect()})  # one row a term
    found = best_of_tasks(hits, block, weight, n_docs, n_terms, most)
    found = kept(found.withColumns({"lost": -F.col("score"), "unnamed": F.col("doc_id").isNull()}), "best")
    ranked = first_rows(found, ["item"], ["lost", "unnamed", "doc_id", "row"], most, "rank")
    return ranked.select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text",
           item_key: str = "item_id", item_text: str = "text", most: int = BEST,
           pairs: int = PAIRS) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``most`` best documents of each item.

    Terms are lower-cased in A-Z only. Documents with a score of 0 are left out; equal scores
    rank by doc_id, null last, then in the order of rows. Rows that repeat a doc_id are
    separate documents; rows that repeat an item_id, the null id too, are one item. Null and
    empty texts have no term, and items without one get no rows. Extra columns are ignored.
    ``pairs`` bounds the (item, term) pairs that one automaton is made of.
    """
    spark = docs.sparkSession
    wanted = kept(pairs_of(items, item_key, item_text), "item-terms")
    count, size = wanted.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("term")), F.lit(0))).first()
    blocks = max(1, -(-count // pairs), -(-size // PAIR_BYTES))
    texts = texts_of(docs, key, text)
    parts = []
    for number in range(blocks if count else 0):
        mine = wanted.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == number)
        held = [(r.item_id, r.term) for r in mine.collect()]  # within the bounds above
        if held:
            parts.append(_ranked_block(texts, Block(held), most))
    if not parts:
        return spark.createDataFrame([], "item_id bigint, rank int, doc_id bigint, score bigint")
    return reduce(DataFrame.unionAll, parts)
