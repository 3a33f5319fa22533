"""Alignment against sets of ends and pairwise overlaps."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from queuelens.llm import alignment
from queuelens.llm.queries import QUERIES
from queuelens.llm.tokens import vocabulary_path
from tests.conftest import SMALL

A = Tokenizer.from_file(vocabulary_path(alignment.BYTES_A))
A.encode_special_tokens = True
B = sentencepiece.SentencePieceProcessor(model_file=vocabulary_path(alignment.PIECES_B))


def spans(parts):
    out, at = [], 0
    for part in parts:
        out.append((at, at + len(part)))
        at += len(part)
    return out


def plain_doc(text):
    """(ids of A, ids of B, groups, links) of one text, by comparing all ends and spans."""
    if not text:
        return [], [], [], []
    letters = alignment.byte_letters()
    a = A.encode(" " + text, add_special_tokens=False)
    bytes_a = [bytes(letters[c] for c in A.id_to_token(i)) for i in a.ids]
    b = B.encode(text)
    bytes_b = [bytes([int(B.id_to_piece(i)[3:5], 16)]) if B.is_byte(i) else
               B.id_to_piece(i).replace("▁", " ").encode() for i in b]
    if b"".join(bytes_a) != b" " + text.encode() or b"".join(bytes_b) != b" " + text.encode():
        return [], [], [], []
    spans_a, spans_b = spans(bytes_a), spans(bytes_b)
    cuts = sorted({e for _, e in spans_a} & {e for _, e in spans_b})
    groups, begin = [], 0
    for cut in cuts:
        groups.append(([i for i, (_, e) in zip(a.ids, spans_a) if begin < e <= cut],
                       [i for i, (_, e) in zip(b, spans_b) if begin < e <= cut]))
        begin = cut
    links = [(i, j) for i, (s, e) in zip(a.ids, spans_a) for j, (t, f) in zip(b, spans_b) if s < f and t < e]
    return a.ids, b, groups, links


def plain(docs):
    per_doc = [plain_doc(text) for _, text in docs]
    counts = Counter(link for *_, links in per_doc for link in links)
    most = {}
    for (_, b), n in counts.items():
        most[b] = max(n, most.get(b, 0))
    out = []
    for (doc, _), (a, b, groups, links) in zip(docs, per_doc):
        spelled = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((doc, len(a), len(b), len(groups), len(links), sum(counts[k] == most[k[1]] for k in links),
                    sum(counts[k] for k in links), hashlib.sha256(spelled.encode()).hexdigest() if a else ""))
    return sorted(out, key=str)


def check(spark, docs, **kwargs):
    df = spark.createDataFrame(docs, "doc_id BIGINT, text STRING")
    found = alignment.alignment(df, **kwargs)
    assert sorted((tuple(r) for r in found.collect()), key=str) == plain(docs)


ODD = [(1, None), (2, ""), (3, " "), (4, "a"), (None, "null id"), (5, "say <|endoftext|> and </s> <unk> <0x0A>"),
       (6, "low line ▁ block"), (7, "\x00\x01 \t\n\r\n  two  spaces "), (8, "日本語のテキスト、naïve Straße 😀👍🏽"),
       (9, "same"), (9, "same"), (10, "supercalifragilistic " * 30), (11, "don't I'll we've"), (12, "١٢٣ ½ ﬁ Å"),
       (13, "é ﻿ ​ 　 x"), (14, "1234567890 3.14159"), (15, "\n\n\n\n"), (16, "…—’“”")]


def test_odd_texts(spark):
    check(spark, ODD)


@pytest.mark.parametrize("sent", [0, 5, 60, 10**6])
def test_counts_however_many_pairs_are_sent(spark, sent):
    rng = random.Random(3)
    words = ["the", "theatre", "Reoushhe", "haanthonhe", "of", "…", "zürich", "x1y2", "和平"]
    docs = [(i, " ".join(rng.choice(words) for _ in range(rng.randrange(1, 25)))) for i in range(60)]
    check(spark, docs, sent=sent)


def test_chunks_give_the_ids_of_whole_texts():
    rng = random.Random(8)
    letters = [" ", " ", "  ", "a", "B", "the", "é", "日", "\n", "\t", "1", "'", "s", "-", ".", "▁", "<s>", "\x00", "ä ", " \u3000"]
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(1, 40))) for _ in range(3000)]
    tokenizers = alignment.Tokenizers(*alignment._paths(None, None))
    import pyarrow as pa
    having, a, b = tokenizers.encode(pa.array(texts, pa.large_string()))
    for flat, side in ((a, 0), (b, 1)):
        split = np.split(flat.ids, flat.until)[:-1]
        found = dict(zip(having.tolist(), map(np.ndarray.tolist, split)))
        for n, text in enumerate(texts):
            assert found.get(n, []) == plain_doc(text)[side], repr(text)


def test_accented_words_are_chunks_of_their_own():
    import pyarrow as pa
    tokenizers = alignment.Tokenizers(*alignment._paths(None, None))
    tokenizers.encode(pa.array(["El niño y ñandú, así.\nÑes é×ó"], pa.large_string()))
    assert set(tokenizers.known) == {c.encode() for c in (
        " El", " niño", " y", " ñandú", ",", " así", ".", "\n", "Ñes", " é×ó")}
    rng = random.Random(9)
    letters = [" ", " ", " ", "é", "Ñ", "ß", "×", "÷", "\u00a0", "\u0085", "\u0301", "я", "Ω", "א", "ª", "µ", "a", "the",
               "\n", "\t", "1", "'", "s", ".", ",", "-", "߷", "\u2028", "\u3000", "▁", "\x00"]
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(1, 30))) for _ in range(4000)]
    having, *flats = tokenizers.encode(pa.array(texts, pa.large_string()))
    for side, flat in enumerate(flats):
        found = dict(zip(having.tolist(), map(np.ndarray.tolist, np.split(flat.ids, flat.until)[:-1])))
        for n, text in enumerate(texts):
            assert found.get(n, []) == plain_doc(text)[side], repr(text)


def test_long_chunks_are_encoded_but_not_remembered(monkeypatch):
    import pyarrow as pa
    monkeypatch.setattr(alignment, "REMEMBERED", 20)
    tokenizers = alignment.Tokenizers(*alignment._paths(None, None))
    rng = random.Random(10)
    words = ["".join(rng.choice("abcé1") for _ in range(rng.choice([1, 3, 70, 90]))) for _ in range(60)]
    for _ in range(30):
        texts = [" ".join(rng.choice(words) for _ in range(rng.randrange(1, 6))) for _ in range(3)]
        having, *flats = tokenizers.encode(pa.array(texts, pa.large_string()))
        for side, flat in enumerate(flats):
            assert [x.tolist() for x in np.split(flat.ids, flat.until)[:-1]] == [plain_doc(t)[side] for t in texts]
        assert max(map(len, tokenizers.known), default=0) <= alignment.LONGEST_REMEMBERED
        assert len(tokenizers.known) == len(tokenizers.table_a.until) == len(tokenizers.table_b.until)


def test_divide_and_conquer_finds_all_common_ends():
    rng = np.random.default_rng(0)
    for share in (0.02, 0.3, 0.9):
        texts_a, texts_b, ends_a, ends_b, base = [], [], [], [], 0
        for length in (1, 2, 50, 4000, 3):
            a, b = (np.flatnonzero(rng.random(length) < p) for p in (share, 0.5))
            ends_a += (base + np.append(a[a < length - 1], length - 1)).tolist()
            ends_b += (base + np.append(b[b < length - 1], length - 1)).tolist()
            texts_a.append(len(ends_a))
            texts_b.append(len(ends_b))
            base += length
        in_a, in_b = alignment.common_ends(*map(np.array, (ends_a, ends_b, texts_a, texts_b)))
        want = sorted(set(ends_a) & set(ends_b))
        assert [ends_a[i] for i in in_a] == want and [ends_b[i] for i in in_b] == want


def test_a_long_stretch_without_a_cut(spark):
    ends = np.arange(1, 200_001) * 2
    other = np.append(ends[:-1] + 1, ends[-1])
    in_a, in_b = alignment.common_ends(ends, other, np.array([len(ends)]), np.array([len(other)]))
    assert in_a.tolist() == in_b.tolist() == [len(ends) - 1]
    text = "ab" * 60_000
    row = alignment.alignment(spark.createDataFrame([(1, text)], "doc_id BIGINT, text STRING")).first()
    a, b, *_ = A.encode(" " + text).ids, B.encode(text)
    assert (row.n_a, row.n_b) == (len(a), len(b))


def test_groups_spell_both_sides(spark):
    docs = [r for r in ODD if r[0] not in (9, None)]
    found = alignment.groups(spark.createDataFrame(docs, "doc_id BIGINT, text STRING")).collect()
    texts = dict(docs)
    for row in found:
        a, b, groups, _ = plain_doc(texts[row.doc_id])
        assert (row.a_ids, row.b_ids) == (a, b)
        pairs = list(zip([0, *row.a_ends], row.a_ends, [0, *row.b_ends], row.b_ends))
        assert [(a[w:x], b[y:z]) for w, x, y, z in pairs] == groups


def test_empty_table_and_clashing_columns(spark):
    assert alignment.alignment(spark.createDataFrame([], "doc_id BIGINT, text STRING")).collect() == []
    clash = spark.createDataFrame([(1, "a b", 1, 2, 3)], "doc_id INT, text STRING, row INT, pairs INT, n INT")
    assert alignment.alignment(clash).first().n_groups == 2


def test_query_matches_plain(spark):
    found = QUERIES["op11_alignment"](spark, SMALL).collect()
    docs = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    short = [d for d in docs if len(d[1] or "") < 3000]
    got = {r.doc_id: tuple(r) for r in found}
    assert len(got) == len(docs)
    for doc, text in short:
        a, b, groups, links = plain_doc(text)
        assert got[doc][1:5] == (len(a), len(b), len(groups), len(links))
