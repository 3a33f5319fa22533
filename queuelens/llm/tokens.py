"""Token ids of whole texts, with every distinct word encoded once per task.

The tokenizer drops white space and never forms a token across it, so a text is
split at ASCII white space and the ids of its words are put together. Words come
from an Arrow dictionary; only words not met before reach the tokenizer.
"""

from __future__ import annotations

import os
from functools import lru_cache
from itertools import chain
from operator import attrgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

VOCABULARY = "word_bpe_49k.json"
# Words remembered by one task; beyond it the memory starts anew. The next task starts
# with none, as idle workers would hold on to theirs.
REMEMBERED = 400_000
# Words of these letters are single words to the tokenizer, and so are marks right after them.
MARKS = ".,!?;:*#%&$"
SIMPLE = f"^[A-Za-zÀ-ÖØ-öø-ÿ]+[{MARKS}]*$"
MARK_AFTER = f"([A-Za-z])([{MARKS}])"
# Words that the model cuts before their tokens are let go.
CUT = 256


def vocabulary_path(name: str = VOCABULARY) -> str:
    """Where an installed public vocabulary lies; the same on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


@lru_cache(maxsize=1)
def _tokenizer(path: str):
    """The tokenizer of a file; a worker reads it once, whatever number of tasks it runs."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


class WordEncoder:
    """Ids of texts by a tokenizer file whose pre-tokenizer splits at white space."""

    def __init__(self, path: str):
        self.tokenizer = _tokenizer(path)
        self._forget()
        letters = "abcdefghijklmnopqrstuvwxyz" + "".join(map(chr, range(0xDF, 0x100)))
        # The model works on bytes shown as characters; ask the pre-tokenizer for each letter.
        split = self.tokenizer.pre_tokenizer.pre_tokenize_str
        self.shown = {ord(c): "".join(s for s, _ in split(c)) for c in letters if c.isalpha()}

    def _forget(self) -> None:
        # Words by their place in two tables, which say where their ids begin in a third, and how many they are.
        self.known: dict[str, int] = {}
        self.begins, self.sizes = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def _add(self, words: list[str], sizes: np.ndarray, ids: np.ndarray) -> None:
        self.known.update(zip(words, range(len(self.sizes), len(self.sizes) + len(words))))
        self.begins = np.append(self.begins, len(self.ids) + np.cumsum(sizes) - sizes)
        self.sizes, self.ids = np.append(self.sizes, sizes), np.append(self.ids, ids)

    def _add_whole(self, words: list[str]) -> None:
        """Have the whole tokenizer cut these words."""
        if words:
            found = [e.ids for e in self.tokenizer.encode_batch(words, add_special_tokens=False)]
            self._add(words, np.fromiter(map(len, found), np.int64, len(found)),
                      np.fromiter(chain.from_iterable(found), np.uint32))

    def _add_letters(self, words: list[str]) -> None:
        """Have the model alone cut these words of small letters."""
        shown = [w if w.isascii() else w.translate(self.shown) for w in words]
        cut, sizes, ids = self.tokenizer.model.tokenize, [], []
        for begin in range(0, len(words), CUT):
            found = list(map(cut, shown[begin:begin + CUT]))
            sizes += map(len, found)
            ids += map(attrgetter("id"), chain.from_iterable(found))
        self._add(words, np.array(sizes, np.int64), np.array(ids, np.uint32))

    def _learn(self, words: pa.Array) -> None:
        """Remember the ids of ``words``; those that are not simple go to the tokenizer together."""
        known = self.known
        simple = pc.match_substring_regex(words, SIMPLE)
        self._add_whole(_listed(words.filter(pc.invert(simple))))
        words = words.filter(simple)
        letters = pc.utf8_rtrim(words, MARKS)
        lower = pc.utf8_lower(letters).dictionary_encode()
        stems = _listed(lower.dictionary)
        self._add_letters([s for s in stems if s not in known])
        of = np.fromiter(map(known.__getitem__, stems), np.int64, len(stems))[lower.indices.to_numpy()]
        marked = pc.not_equal(words, letters).to_numpy(zero_copy_only=False)
        listed = _listed(words)
        known.update(zip(listed, of.tolist()))
        if marked.any():
            at = np.flatnonzero(marked)
            ends = pc.utf8_length(letters).to_numpy(zero_copy_only=False)[at]
            both = [(listed[i], listed[i][size:], int(of[i])) for i, size in zip(*(x.tolist() for x in (at, ends)))]
            self._add_whole(list({m for _, m, _ in both if m not in known}))
            pairs = [(n, known[m]) for _, m, n in both]
            ids = [self.ids[self.begins[k]:self.begins[k] + self.sizes[k]] for pair in pairs for k in pair]
            self._add([w for w, _, _ in both], self.sizes[np.array(pairs)].sum(axis=1), np.concatenate(ids))

    def numbers(self, words: pa.Array) -> np.ndarray:
        """The place of each word in the tables."""
        if len(self.known) > REMEMBERED:
            self._forget()
        listed = _listed(words)
        met = np.fromiter(map(self.known.__contains__, listed), bool, len(listed))
        if not met.all():
            self._learn(words.filter(pa.array(~met)))
        return np.fromiter(map(self.known.__getitem__, listed), np.int64, len(listed))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids (uint32) one text after the other, and where each text starts and ends."""
        # A mark after a letter begins a token anyway; apart, there are fewer distinct words.
        apart = pc.replace_substring_regex(texts.cast(pa.large_string()).fill_null(""), MARK_AFTER, r"\1 \2")
        lists = pc.ascii_split_whitespace(apart)
        ends = lists.offsets.to_numpy().astype(np.int64)
        coded = lists.values.dictionary_encode()
        at = self.numbers(coded.dictionary)[coded.indices.to_numpy()]
        counts = self.sizes[at]
        until = np.concatenate([[0], np.cumsum(counts)])
        place = np.repeat(self.begins[at] - until[:-1], counts)
        place += np.arange(until[-1])
        return self.ids[place], until[ends]


def _listed(words: pa.Array) -> list[str]:
    return words.to_numpy(zero_copy_only=False).tolist()
