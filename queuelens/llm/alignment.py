"""Alignment of the tokens of two tokenizers, and how often each pair of ids is linked.

Both tokenizers cut the same bytes. Places where tokens of both end are found by divide and
conquer: near the middle of an interval a common end is located, and both halves are
treated likewise, until an interval has no common end inside and is a group. All intervals
of a batch of texts are halved together, level by level. A token of the one is linked to a
token of the other if their bytes overlap. Ends are looked up by byte.

Links are counted over all documents as one number per pair of ids. The most frequent pairs
go to all executors, in a number with a bound, and the links of the others to a shuffle.
"""

from __future__ import annotations

import gc
import hashlib
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain, compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from queuelens.llm.frames import bounded, kept, strings, texts_of
from queuelens.llm.tokens import vocabulary_path

BYTES_A, PIECES_B = "byte_bpe_50k.json", "piece_bpe_32k.model"
# Ids of both tokenizers stay below 2**ID_BITS, so a pair of them is one number.
ID_BITS = 20
# Pairs of ids that are sent to all executors: the most frequent ones.
SENT_PAIRS = 1_000_000
# Kinds of bytes that tell where a text can be cut.
LETTER, MARK, VISIBLE, SPACE, LINE = 1, 2, 4, 8, 16
# Chunks of text whose ids a task remembers, and the bytes of the longest of them.
REMEMBERED, LONGEST_REMEMBERED = 300_000, 64
# Bytes of text aligned at a time.
AT_A_TIME = 1 << 20
# Letters that both tokenizers leave in one word, and the bytes that begin a character of
# U+00C0 to U+07FF, where nothing is white space.
LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
WORD = re.compile(f" ?[{LETTERS}]+")
BEGIN_TWO = range(0xC3, 0xE0)

DOCS = ("row bigint, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, "
        "groups_sha256 string, pairs array<bigint>, times array<bigint>")
GROUPS = "doc_id bigint, a_ids array<int>, b_ids array<int>, a_ends array<int>, b_ends array<int>"


def byte_letters() -> dict[str, int]:
    """The letter by which a byte-level vocabulary shows each byte: itself if it can be seen,
    else the next one from 256 on."""
    seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in seen]
    return {chr(b): b for b in seen} | {chr(256 + i): b for i, b in enumerate(hidden)}


SHOWN = {b: c for c, b in byte_letters().items()}


class Tokenizers:
    """Ids of a text by both tokenizers, and the bytes of each id.

    A splits texts by the usual pattern of byte-level vocabularies; B has byte pieces and
    leaves texts as they are, but for a space that it adds.
    """

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        letters = byte_letters()
        shown = {i: token for token, i in self.a.get_vocab().items()}
        self.bytes_a = [bytes(letters[c] for c in shown.get(i, "")) for i in range(max(shown) + 1)]
        self.bytes_b = [self._piece(i) for i in range(self.b.get_piece_size())]
        if max(len(self.bytes_a), len(self.bytes_b)) > 1 << ID_BITS:
            raise ValueError(f"token ids must be below {1 << ID_BITS}")
        # What the end of a line becomes, and the marks that no token of B has after a letter.
        self.line = len(self.b.encode("\n"))
        pieces = [p for i, p in enumerate(map(self.b.id_to_piece, range(self.b.get_piece_size())))
                  if not self.b.is_byte(i)]
        self.separable = not any("\n" in p or "▁" in p.lstrip("▁") for p in pieces)
        joined = {m for p in pieces for m in re.findall(rf"(?<=[{LETTERS}])[!-/:-@\[-`{{-~]", p)} | {"'"}
        self.kinds = np.array([
            LETTER * c.isalpha() | MARK * (not c.isalnum() and c not in joined) | VISIBLE if "!" <= c <= "~"
            else VISIBLE if ord(c) in BEGIN_TWO else SPACE * (c == " ") | LINE * (c == "\n")
            for c in map(chr, range(256))], np.uint8)
        # The second bytes of letters from U+00C0 to U+00FF.
        self.latin = np.array([0x80 <= i < 0xC0 and chr(i + 0x40).isalpha() for i in range(256)])
        self._forget()
        self.sizes_a = np.array([len(t) for t in self.bytes_a])
        self.sizes_b = np.array([len(t) for t in self.bytes_b])
        # How an id is written: A before another A, A at the end of a group, and so for B.
        self.written = [str(i).encode() + mark for table, marks in (
            (self.bytes_a, (b",", b"|")), (self.bytes_b, (b",", b";"))) for mark in marks for i in range(len(table))]

    def _piece(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        if self.b.is_byte(i):
            return bytes([int(piece[3:5], 16)])
        return piece.replace("▁", " ").encode()

    def _forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.table_a = self.table_b = Flat(np.zeros(0, np.int64), np.zeros(0, np.int64))

    def _ids_a(self, chunks: list[str]) -> "Flat":
        """The ids of each chunk by A; a word of letters goes straight to the merges."""
        word = list(map(WORD.fullmatch, chunks))
        rest = [c for c, plain in zip(chunks, word) if not plain]
        others = iter(self.a.encode_batch(rest, add_special_tokens=False) if rest else ())
        # All words are shown as letters at once; none holds the end of a line.
        plain = "\n".join(c for c, plain in zip(chunks, word) if plain).encode().decode("latin-1")
        words = iter(plain.translate(SHOWN).split(SHOWN[ord("\n")]))
        merge = self.a.model.tokenize
        return Flat.joined([[t.id for t in merge(next(words))] if plain else next(others).ids for plain in word])

    def _chunks(self, chunks: list[bytes]) -> tuple[np.ndarray, "Flat", "Flat"]:
        """Where each chunk lies in the returned tables of ids by A and B; none if they do not spell it."""
        if len(self.known) > REMEMBERED:
            self._forget()
        known = self.known
        new = [c for c in chunks if c not in known]
        new.sort(key=lambda c: len(c) > LONGEST_REMEMBERED)
        shown = b"\0".join(new).decode().split("\0")
        if len(shown) != len(new):  # a chunk holds that character itself
            shown = [c.decode() for c in new]
        # Behind the end of a line, B adds no space to a text.
        ids_b = self.b.encode(["\n" + c for c in shown], num_threads=1) if new else []
        a, b = self._ids_a(shown) if new else Flat.joined([]), Flat.joined([x[self.line:] for x in ids_b])
        sizes = np.fromiter(map(len, new), np.int64, len(new))
        spelled = a.spells(new, sizes, self.bytes_a, self.sizes_a) & b.spells(new, sizes, self.bytes_b, self.sizes_b)
        a, b = self.table_a.and_(a.only(spelled)), self.table_b.and_(b.only(spelled))
        begin, short = len(known), int((sizes <= LONGEST_REMEMBERED).sum())
        known.update(zip(new, range(begin, begin + len(new))))
        at = np.fromiter(map(known.__getitem__, chunks), np.int64, len(chunks))
        for chunk in new[short:]:
            del known[chunk]
        self.table_a, self.table_b = a.first(len(known)), b.first(len(known))
        return at, a, b

    def _begins(self, raw: np.ndarray) -> np.ndarray:
        """Where a chunk begins: both tokenizers end a token there, whatever else the text holds.

        That is a single space before a visible character of ASCII or of two bytes, a mark after
        a letter, and either side of one line end between such characters.
        """
        begins = np.zeros(len(raw), bool)
        if self.separable:
            kind = self.kinds[raw]
            two = np.flatnonzero((raw >= BEGIN_TWO[0]) & (raw <= BEGIN_TWO[-1]))
            kind[two + 1] = VISIBLE | LETTER * ((raw[two] == 0xC3) & self.latin[raw[two + 1]])
            before, here, after = kind[:-1], kind[1:], np.append(kind[2:], 0)
            line = ((before & VISIBLE) > 0) & ((here & LINE) > 0) & ((after & VISIBLE) > 0)
            begins[1:] = (((here & SPACE) > 0) & ((before & SPACE) == 0) & ((after & VISIBLE) > 0)
                          | ((before & LETTER) > 0) & ((here & MARK) > 0) | line)
            begins[2:] |= line[:-1]
        return begins

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, "Flat", "Flat"]:
        """The places of the texts that both tokenizers spell, and their ids by A and B.

        Texts are cut where both tokenizers are sure to end a token, and every chunk is encoded once.
        """
        having = np.flatnonzero(pc.binary_length(texts).to_numpy())
        empty, space = (pa.scalar(x, pa.large_string()) for x in ("", " "))
        spaced = pc.binary_join_element_wise(empty, texts.take(pa.array(having)), space).cast(pa.large_binary())
        if not len(having):
            return having, Flat.joined([]), Flat.joined([])
        _, offsets, data = spaced.buffers()
        ends = np.frombuffer(offsets, np.int64)[spaced.offset:spaced.offset + len(spaced) + 1]
        raw = np.frombuffer(data, np.uint8)[:ends[-1]]
        begins = self._begins(raw)
        begins[ends[:-1]] = True
        at = np.append(np.flatnonzero(begins), ends[-1])
        coded = pa.Array.from_buffers(pa.large_binary(), len(at) - 1, [None, pa.py_buffer(at), data]).dictionary_encode()
        gc.disable()  # what is made here stays, and there is a lot of it
        try:
            places, table_a, table_b = self._chunks(coded.dictionary.to_pylist())
        finally:
            gc.enable()
        each = places[coded.indices.to_numpy()]
        first = np.searchsorted(at, ends[:-1])
        spelled = np.logical_and.reduceat((np.diff(table_a.until, prepend=0) > 0)[each], first)
        counts = np.diff(np.append(first, len(each)))
        each = each[np.repeat(spelled, counts)]
        until = np.cumsum(counts[spelled])
        return having[spelled], table_a.of(each, until), table_b.of(each, until)


@dataclass
class Flat:
    """The ids of several texts one after the other, and how many there are up to the end of each."""

    ids: np.ndarray
    until: np.ndarray

    @staticmethod
    def joined(lists: list[list[int]]) -> "Flat":
        sizes = np.fromiter(map(len, lists), np.int64, len(lists))
        until = np.cumsum(sizes)
        return Flat(np.fromiter(chain.from_iterable(lists), np.int64, int(sizes.sum())), until)

    def and_(self, other: "Flat") -> "Flat":
        """Both, one after the other."""
        return Flat(np.append(self.ids, other.ids), np.append(self.until, other.until + len(self.ids)))

    def first(self, n: int) -> "Flat":
        """The first ``n`` texts."""
        return Flat(self.ids[:self.until[n - 1] if n else 0], self.until[:n])

    def only(self, wanted: np.ndarray) -> "Flat":
        """All texts, but those that are not wanted without ids."""
        sizes = np.diff(self.until, prepend=0)
        return Flat(self.ids[np.repeat(wanted, sizes)], np.cumsum(sizes * wanted))

    def of(self, each: np.ndarray, until: np.ndarray) -> "Flat":
        """Texts made of these, ``each`` after the other, of which ``until`` say where texts end."""
        sizes = np.diff(self.until, prepend=0)
        count = sizes[each]
        ends = np.append(0, np.cumsum(count))
        return Flat(self.ids[_ragged((self.until - sizes)[each], count)], ends[until])

    def spells(self, texts: list[bytes], lengths: np.ndarray, table: list[bytes], sizes: np.ndarray) -> np.ndarray:
        """Whether the bytes of the ids are those of each text, of which ``lengths`` are known."""
        upto = np.append(0, np.cumsum(sizes[self.ids]))[np.append(0, self.until)]
        same = np.diff(upto) == lengths
        mine = np.frombuffer(b"".join(map(table.__getitem__, self.only(same).ids.tolist())), np.uint8)
        theirs = np.frombuffer(b"".join(compress(texts, same)), np.uint8)
        wrong = np.flatnonzero(mine != theirs)
        ends = np.cumsum(lengths[same])
        same[np.flatnonzero(same)[np.searchsorted(ends, wrong, "right")]] = False
        return same


def _ragged(begin: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The numbers begin, begin + 1, ... of each interval, one interval after the other."""
    return np.repeat(begin - (np.cumsum(count) - count), count) + np.arange(count.sum())


def _near_middle(ends_a: np.ndarray, place_b: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """For each interval of ends low to high - 1 of A, the one nearest its middle that B has too, or -1.

    ``place_b`` says for every byte which token of B ends there, or -1. A window around the
    middle is looked up in it, and widens until it holds a common end or all of the interval.
    """
    middle = (low + high) // 2
    found = np.full(len(low), -1)
    left, reach = np.arange(len(low)), 0
    while len(left):
        first = np.maximum(low[left], middle[left] - reach)
        last = np.minimum(high[left], middle[left] + reach + 1)
        count = last - first
        at = _ragged(first, count)
        common = place_b[ends_a[at]] >= 0
        gap = at - np.repeat(middle[left], count)
        # Twice the distance, and one more to the left, so that a gap can be told from its rank.
        rank = np.where(common, np.where(gap < 0, -2 * gap + 1, 2 * gap), np.iinfo(np.int64).max)
        best = np.minimum.reduceat(rank, np.cumsum(count) - count)
        hit = best < np.iinfo(np.int64).max
        found[left[hit]] = middle[left[hit]] + np.where(best[hit] & 1, -(best[hit] >> 1), best[hit] >> 1)
        whole = (first == low[left]) & (last == high[left])
        left, reach = left[~hit & ~whole], 4 * reach + 1
    return found


def common_ends(ends_a: np.ndarray, ends_b: np.ndarray, texts_a: np.ndarray, texts_b: np.ndarray
                ) -> tuple[np.ndarray, np.ndarray]:
    """Where in A's and in B's ends the common ones are, by divide and conquer.

    The ends of all texts follow each other, and ``texts_a`` and ``texts_b`` say how many
    tokens there are up to the end of each text, where both have one.
    """
    low, high = np.append(0, texts_a[:-1]), texts_a - 1
    b_low, b_high = np.append(0, texts_b[:-1]), texts_b - 1
    cuts = [texts_a - 1]
    place_b = np.full(ends_b[-1] + 1, -1, np.int32)
    place_b[ends_b] = np.arange(len(ends_b))
    while True:
        open_ = (low < high) & (b_low < b_high)
        low, high, b_low, b_high = low[open_], high[open_], b_low[open_], b_high[open_]
        if not len(low):
            break
        cut = _near_middle(ends_a, place_b, low, high)
        low, high, b_low, b_high, cut = (x[cut >= 0] for x in (low, high, b_low, b_high, cut))
        cuts.append(cut)
        b_cut = place_b[ends_a[cut]]
        low, high = np.concatenate([low, cut + 1]), np.concatenate([cut, high])
        b_low, b_high = np.concatenate([b_low, b_cut + 1]), np.concatenate([b_cut, b_high])
    in_a = np.sort(np.concatenate(cuts))
    return in_a, place_b[ends_a[in_a]]


@dataclass
class Aligned:
    """Some texts with tokens: ids, ends in bytes, tokens up to each text's end, and groups."""

    ids_a: np.ndarray
    ids_b: np.ndarray
    ends_a: np.ndarray
    ends_b: np.ndarray
    texts_a: np.ndarray
    texts_b: np.ndarray
    groups_a: np.ndarray  # the last token of every group
    groups_b: np.ndarray
    texts_groups: np.ndarray  # groups up to the end of each text

    def links(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, pair of ids, times): the linked pairs of each text, and how many links it has of them.

        Between two neighbouring ends of either side lies one token of A and one of B, and
        every linked pair of tokens overlaps in one such stretch.
        """
        ends_a, ends_b = (np.zeros(self.ends_a[-1] + 1, bool) for _ in range(2))
        ends_a[self.ends_a], ends_b[self.ends_b] = True, True
        either = np.flatnonzero(ends_a | ends_b)
        # How many tokens end before each of these ends.
        a, b = (np.append(0, np.cumsum(ends[either]))[:-1] for ends in (ends_a, ends_b))
        text = np.repeat(np.arange(len(self.texts_a)), np.diff(self.texts_a, prepend=0))[a]
        both = np.sort(text << 2 * ID_BITS | self.ids_a[a] << ID_BITS | self.ids_b[b])
        new = np.flatnonzero(np.append(True, both[1:] != both[:-1]))
        times = np.diff(np.append(new, len(both)))
        return both[new] >> 2 * ID_BITS, both[new] & (1 << 2 * ID_BITS) - 1, times

    def spelled(self, written: list[bytes], n_a: int, n_b: int) -> list[bytes]:
        """The groups of each text as ``a1,a2|b1;a3|b2,b3``."""
        in_a, in_b = (np.diff(groups, prepend=-1) for groups in (self.groups_a, self.groups_b))
        last_a, last_b = np.zeros(len(self.ids_a), bool), np.zeros(len(self.ids_b), bool)
        last_a[self.groups_a], last_b[self.groups_b] = True, True
        merged = np.empty(len(last_a) + len(last_b), np.int64)
        of_a = np.repeat(np.tile([True, False], len(in_a)), np.stack([in_a, in_b], 1).ravel())
        merged[of_a] = self.ids_a + n_a * last_a
        merged[~of_a] = self.ids_b + 2 * n_a + n_b * last_b
        ends = np.append(0, self.texts_a + self.texts_b).tolist()
        shown, write = merged.tolist(), written.__getitem__
        return [b"".join(map(write, shown[x:y]))[:-1] for x, y in zip(ends, ends[1:])]


def align(a: Flat, b: Flat, sizes_a: np.ndarray, sizes_b: np.ndarray) -> Aligned:
    """The groups of texts that have tokens."""
    ends_a, ends_b = np.cumsum(sizes_a[a.ids]), np.cumsum(sizes_b[b.ids])
    groups_a, groups_b = common_ends(ends_a, ends_b, a.until, b.until)
    return Aligned(a.ids, b.ids, ends_a, ends_b, a.until, b.until, groups_a, groups_b,
                   np.searchsorted(groups_a, a.until))


def _paths(a: str | None, b: str | None) -> tuple[str, str]:
    return a or vocabulary_path(BYTES_A), b or vocabulary_path(PIECES_B)


def _aligned(batch: pa.RecordBatch, tokenizers: Tokenizers):
    """The places in ``batch`` of texts that have tokens, and these aligned (None if none has)."""
    having, a, b = tokenizers.encode(strings(batch))
    if not len(having):
        return having, None
    return having, align(a, b, tokenizers.sizes_a, tokenizers.sizes_b)


def _lists(having: np.ndarray, rows: int, sizes: np.ndarray, values: np.ndarray, kind: pa.DataType) -> pa.Array:
    """One list for each of ``rows`` rows; those not in ``having`` are empty."""
    counts = np.zeros(rows, np.int64)
    counts[having] = sizes
    offsets = np.append(0, np.cumsum(counts)).astype(np.int32)
    return pa.ListArray.from_arrays(offsets, pa.array(values, kind))


def groups(docs: DataFrame, key: str = "doc_id", text: str = "text", path_a: str | None = None,
           path_b: str | None = None) -> DataFrame:
    """Per document its ids by both tokenizers, and the number of tokens up to the end of each group."""
    paths = _paths(path_a, path_b)

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizers = Tokenizers(*paths)
        for batch in bounded(batches, max_bytes=AT_A_TIME):
            having, found = _aligned(batch, tokenizers)
            none = np.zeros(0, np.int64)
            columns = [(none, none)] * 4
            if found:
                n_groups = np.diff(found.texts_groups, prepend=0)
                before = [np.append(0, t[:-1]) for t in (found.texts_a, found.texts_b)]
                columns = [(np.diff(found.texts_a, prepend=0), found.ids_a),
                           (np.diff(found.texts_b, prepend=0), found.ids_b),
                           (n_groups, found.groups_a + 1 - np.repeat(before[0], n_groups)),
                           (n_groups, found.groups_b + 1 - np.repeat(before[1], n_groups))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(_lists(having, batch.num_rows, *c, pa.int32()) for c in columns)],
                names=["doc_id", "a_ids", "b_ids", "a_ends", "b_ends"])

    return texts_of(docs, key, text).mapInArrow(compute, GROUPS)


def counted(docs: DataFrame, key: str = "doc_id", text: str = "text", path_a: str | None = None,
            path_b: str | None = None) -> DataFrame:
    """Per document the numbers of its tokens, groups and links, the hash of its groups, and its
    linked pairs of ids with how often each is linked."""
    paths = _paths(path_a, path_b)

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizers = Tokenizers(*paths)
        sizes = len(tokenizers.bytes_a), len(tokenizers.bytes_b)
        row = TaskContext.get().partitionId() << 33
        for batch in bounded(batches, max_bytes=AT_A_TIME):
            n = batch.num_rows
            having, found = _aligned(batch, tokenizers)
            numbers = np.zeros((4, n), np.int64)
            hashes = [""] * n
            of, pairs, times = (np.zeros(0, np.int64),) * 3
            if found:
                of, pairs, times = found.links()
                numbers[:, having] = [
                    np.diff(found.texts_a, prepend=0), np.diff(found.texts_b, prepend=0),
                    np.diff(found.texts_groups, prepend=0), np.bincount(of, times, len(having))]
                for at, spelled in zip(having, found.spelled(tokenizers.written, *sizes)):
                    hashes[at] = hashlib.sha256(spelled).hexdigest()
            held = np.bincount(of, minlength=len(having))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(row, row + n)), batch.column("doc_id"), *map(pa.array, numbers),
                 pa.array(hashes), _lists(having, n, held, pairs, pa.int64()),
                 _lists(having, n, held, times, pa.int64())],
                names=[f.split()[0] for f in DOCS.split(", ")])
            row += n

    return texts_of(docs, key, text).mapInArrow(compute, DOCS)


def pair_counts(links: DataFrame) -> DataFrame:
    """(pair, n, best): how many links hold each pair of ids, and whether no other pair with its B id has more."""
    of_b = F.col("pair").bitwiseAND(F.lit((1 << ID_BITS) - 1))
    counts = kept(links.groupBy("pair").agg(F.sum("times").alias("n")), "pair-counts")
    # One row per id of B.
    most = counts.groupBy(of_b.alias("b")).agg(F.max("n").alias("most"))
    return kept(counts.join(F.broadcast(most), of_b == F.col("b")).select(
        "pair", "n", (F.col("n") == F.col("most")).alias("best")), "pairs")


def _frequent_from(pairs: DataFrame, sent: int) -> int:
    """The least number of bits of a count for which at most ``sent`` pairs have so many or more."""
    bits = F.length(F.bin("n")).alias("bits")
    held, least = 0, 64
    for row in sorted(pairs.groupBy(bits).agg(F.count("*").alias("n")).collect(), reverse=True):  # 64 at most
        held += row.n
        if held > sent:
            return least
        least = row.bits
    return 0


def alignment(docs: DataFrame, key: str = "doc_id", text: str = "text", path_a: str | None = None,
              path_b: str | None = None, sent: int = SENT_PAIRS) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256): one row per row of ``docs``.

    Null and empty texts, and texts that the tokens of either tokenizer do not spell, have no
    tokens: zeros and an empty hash. Rows that repeat an id are separate documents. ``sent`` bounds
    the pairs sent to all executors. Extra columns are ignored.
    """
    aligned = kept(counted(docs, key, text, path_a, path_b), "aligned")
    one = F.explode(F.arrays_zip("pairs", "times")).alias("l")
    links = aligned.select("row", one).select("row", F.col("l.pairs").alias("pair"), "l.times")
    pairs = pair_counts(links)
    least = _frequent_from(pairs, sent)
    many = F.length(F.bin("n")) >= least
    frequent = F.broadcast(pairs.where(many))
    valued = links.join(frequent, "pair")
    if least:
        rest = links.join(F.broadcast(pairs.where(many).select("pair")), "pair", "left_anti")
        valued = valued.unionByName(rest.join(pairs.where(~many), "pair"))
    sums = valued.groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
        F.sum(F.col("times") * F.col("n")).alias("count_sum"))
    none = F.lit(0).cast("bigint")
    return aligned.drop("pairs", "times").join(sums, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", none).alias("n_best"),
        F.coalesce("count_sum", none).alias("count_sum"), "groups_sha256")
