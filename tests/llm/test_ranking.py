"""Ranked search against a plain count of terms."""

import math
import random
import re
from collections import Counter

import pytest

from queuelens.llm import ranking

TERM = re.compile(ranking.TERM)
LOWER = str.maketrans(ranking.UPPER, ranking.LOWER)


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def plain(docs, items, most):
    counts = [Counter(terms(t)) for _, t in docs]
    lengths = [sum(c.values()) for c in counts]
    n_docs, words = sum(n > 0 for n in lengths), sum(lengths)
    frequency = Counter(t for c in counts for t in c)
    wanted = {}
    for item, text in items:
        wanted.setdefault(item, set()).update(terms(text))
    out = []
    for item, held in wanted.items():
        scored = []
        for row, ((doc, _), count, n) in enumerate(zip(docs, counts, lengths)):
            score = 0
            for term in held & set(count):
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * frequency[term] + 1)))
                m = 100 - 50 + 50 * n * n_docs // words
                score += w * (1_000_000_000 * count[term] // (1000 * count[term] + 20 * m))
            if score > 0:
                scored.append((-score, doc is None, doc or 0, row, doc))
        for rank, (lost, _, _, _, doc) in enumerate(sorted(scored)[:most], 1):
            out.append((item, rank, doc, -lost))
    return sorted(out, key=str)


def check(spark, docs, items, most=ranking.BEST, **kwargs):
    found = ranking.search(spark.createDataFrame(docs, "doc_id BIGINT, text STRING").coalesce(2),
                           spark.createDataFrame(items, "item_id BIGINT, text STRING"), most=most, **kwargs)
    assert dict(found.dtypes) == {"item_id": "bigint", "rank": "int", "doc_id": "bigint", "score": "bigint"}
    got = sorted((tuple(r) for r in found.collect()), key=str)
    want = plain(docs, items, most)
    # Rows without an id, or that repeat one, are told apart by their place alone.
    assert got == want
    return got


def corpus(n, seed=5):
    rng = random.Random(seed)
    words = ["alpha", "Beta", "gamma7", "x", "naïve", "日本語", "Straße", "İx", "😀", "the", "THE", "a1b2", " y"]
    glue = [" ", "  ", "-", "_", "\n", "\x00", "…x", ".", "@"]
    make = lambda k: "".join(rng.choice(words) + rng.choice(glue) for _ in range(k))
    docs = [(i, make(rng.randrange(1, 60))) for i in range(n)]
    return docs, [(i, make(rng.randrange(1, 6))) for i in range(9)]


@pytest.mark.parametrize("most", [1, 7, 50])
def test_equals_plain_counts(spark, most):
    docs, items = corpus(300)
    assert len(check(spark, docs, items, most)) > 5


def test_terms_are_whole(spark):
    docs = [(1, "cat"), (2, "cats"), (3, "concat cat-cat CAT"), (4, "cat_cat"), (5, "éat cat"), (6, "écat")]
    got = check(spark, docs, [(1, "Cat!")])
    assert {doc for _, _, doc, _ in got} == {1, 3, 4, 5}


def test_ties_and_copies_rank_by_id(spark):
    docs = [(500 - i, "same words here") for i in range(200)] + [(i + 900, "other") for i in range(300)]
    got = check(spark, docs, [(1, "words"), (2, "nothing"), (3, "same other")], 20)
    assert [doc for item, rank, doc, _ in sorted(got) if item == 1] == list(range(301, 321))


def test_odd_rows(spark):
    docs = [(1, None), (2, ""), (None, "alpha beta"), (3, "alpha"), (3, "alpha"), (4, "alpha " * 100_000),
            (5, "\x00\n--"), (6, "y" * 300_000), (7, "b c d"), (8, "q"), (9, "r")]
    items = [(1, None), (2, ""), (None, "Alpha"), (None, "c"), (4, "y" * 300_000), (5, "alpha alpha beta q"), (5, "r")]
    check(spark, docs, items)
    assert check(spark, docs, [(1, None), (2, "..")]) == []


def test_empty_tables(spark):
    assert check(spark, [], [(1, "a")]) == []
    assert check(spark, [(1, "a")], []) == []


def test_items_in_several_blocks(spark):
    docs, items = corpus(200, seed=9)
    check(spark, docs, items, pairs=4)


def test_little_is_held_at_a_time(spark, monkeypatch):
    """Candidates are cut, and scores laid out, in very small steps."""
    docs, items = corpus(400, seed=11)
    block = ranking.Block([(i, t) for i, text in items for t in set(terms(text))])
    best, all_rows = ranking.Best(2, 3), []
    monkeypatch.setattr(ranking, "CANDIDATES", 10)
    import numpy as np
    for step in range(40):
        rng = np.random.default_rng(step)
        item, score = rng.integers(0, 2, 5), rng.integers(1, 9, 5)
        doc, row = rng.integers(0, 50, 5), np.arange(5) + 5 * step
        all_rows += list(zip(item.tolist(), (-score).tolist(), doc.tolist(), row.tolist()))
        chosen = score >= best.floor[item]
        best.add(*(c[chosen] for c in (item, score, doc, np.zeros(5, bool), row)))
    item, score, doc, _, row = best.cut()
    want = [r for i in (0, 1) for r in sorted(x for x in all_rows if x[0] == i)[:3]]
    assert list(zip(item.tolist(), (-score).tolist(), doc.tolist(), row.tolist())) == want
    assert len(block.items) == 9


def test_clashing_columns(spark):
    docs = spark.createDataFrame([(1, "a b", 3, 4)], "doc_id INT, text STRING, row INT, n INT")
    items = spark.createDataFrame([(1, "b", "x")], "item_id INT, text STRING, term STRING")
    assert [tuple(r)[:3] for r in ranking.search(docs, items).collect()] in ([], [(1, 1, 1)])
