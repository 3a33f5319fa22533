"""Token ids against the tokenizer itself, and packing against its invariants and lower bound."""

import random
import zlib

import numpy as np
import pyarrow as pa
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from queuelens.llm import packing
from queuelens.llm.tokens import WordEncoder, vocabulary_path

ODD = ["", None, " ", "áb é x", "İstanbul ΣΑΣ ß", "it's we're I'LL 12.5 a1b2",
       "<|endoftext|>x <|startoftext|>", "a b c\x85d\x1fe", "é ..., foo, bar.. Àé,", "日本語 \U0001f44d\U0001f3fd",
       "ſ K Å", "ÿ ÷ × ª º ẞ", "'s 's. x's don't!", "a\x0b\x0cb\r\nc", "x" * 3000, "word " * 2000]


def plain_ids(text):
    return tokenizer().encode(text or "", add_special_tokens=False).ids


def tokenizer(found=[]):  # noqa: B006
    if not found:
        found.append(Tokenizer.from_file(vocabulary_path()))
    return found[0]


def check(encoder, texts):
    ids, at = encoder.encode(pa.array(texts, pa.large_string()))
    for text, a, b in zip(texts, at, at[1:]):
        assert ids[a:b].tolist() == plain_ids(text), text


def test_ids_are_the_tokenizers():
    encoder = WordEncoder(vocabulary_path())
    check(encoder, ODD)
    check(encoder, ODD[::-1])
    encoder.known.clear()
    check(encoder, ODD)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(max_size=30), max_size=4))
def test_ids_of_any_text(texts):
    check(shared_encoder(), [t.encode("utf-8", "ignore").decode() for t in texts])


def shared_encoder(found=[]):  # noqa: B006
    if not found:
        found.append(WordEncoder(vocabulary_path()))
    return found[0]


def plain_best_fit(sizes, length):
    free = []
    for size in sorted(sizes, reverse=True):
        fitting = [f for f in free if f >= size]
        if fitting:
            free.remove(min(fitting))
            free.append(min(fitting) - size)
        else:
            free.append(length - size)
    return sorted(length - f for f in free)


def test_best_fit_is_the_plain_one():
    r = random.Random(1)
    for _ in range(100):
        length = r.choice([5, 64, 2048])
        sizes = np.array([r.randint(1, length) for _ in range(r.randrange(1, 200))])
        bins, offsets, fills = packing.best_fit(sizes, length)
        assert sorted(fills.tolist()) == plain_best_fit(sizes.tolist(), length)
        for b in range(len(fills)):
            mine = sorted((o, s) for x, o, s in zip(bins, offsets, sizes) if x == b)
            assert [o for o, _ in mine] == [sum(s for _, s in mine[:i]) for i in range(len(mine))]


def gapless(rows, length):
    by_sequence = {}
    for row in rows:
        by_sequence.setdefault(row.sequence_id, []).append((row.offset, row.length))
    for parts in by_sequence.values():
        end = 0
        for offset, size in sorted(parts):
            assert offset == end
            end += size
        assert end <= length
    return len(by_sequence)


def test_documents(spark):
    docs = [(n, t) for n, t in enumerate(ODD)] + [(3, ODD[3]), (None, "x"), (99, "many words here " * 3000)]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string").selectExpr("*", "1 AS length", "2 AS bin")
    found = packing.pack_documents(frame, length=64).collect()
    gapless(found, 64)
    expected = []
    for doc, text in docs:
        ids = plain_ids(text) + [0]
        for piece, start in enumerate(range(0, len(ids), 64)):
            part = ids[start:start + 64]
            expected.append((doc, piece, start, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    key = lambda r: [(v is not None, str(v)) for v in r]
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found), key=key) == sorted(expected, key=key)
    assert packing.pack_documents(frame.limit(0)).count() == 0


def test_rounds_meet_the_lower_bound(spark):
    r = random.Random(3)
    sizes = [r.choice([r.randint(1, 90), r.randint(100, 900), 2048]) for _ in range(4000)]
    items = spark.createDataFrame(list(enumerate(sizes)), "n int, length bigint").repartition(40)
    found = packing.pack(items, "length").collect()
    assert sorted(r.n for r in found) == list(range(4000))
    bound = -(-sum(sizes) // 2048)
    assert bound <= gapless(found, 2048) <= bound * 1.01 + 1


def test_items_that_fit_with_nothing(spark):
    items = spark.range(500).selectExpr("id", "1100L AS length").repartition(20)
    assert gapless(packing.pack(items, "length").collect(), 2048) == 500
