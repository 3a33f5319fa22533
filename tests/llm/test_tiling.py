"""Greedy string tiling against a brute-force version, and decontamination of small tables."""

import random

import numpy as np
import pytest

from queuelens.llm import tiling
from queuelens.llm.frames import kept, texts_of
from tests.helpers import rows


def plain_tiles(item, text, shortest):
    used_item, used_text, made = set(), set(), []
    while True:
        best = (0, 0, 0)
        for i in range(len(item)):
            for t in range(len(text)):
                n = 0
                while (i + n < len(item) and t + n < len(text) and item[i + n] == text[t + n]
                       and i + n not in used_item and t + n not in used_text):
                    n += 1
                if n > best[0]:
                    best = (n, i, t)
        n, i, t = best
        if n < shortest:
            return made
        made.append((i, t, n))
        used_item.update(range(i, i + n))
        used_text.update(range(t, t + n))


def test_tiles_are_the_greedy_ones():
    rng = np.random.default_rng(3)
    for _ in range(200):
        item = rng.integers(0, rng.integers(1, 6), rng.integers(0, 25)).astype(np.uint64)
        text = rng.integers(0, 4, rng.integers(0, 40)).astype(np.uint64)
        shortest = int(rng.integers(1, 5))
        assert tiling.tiles(item, text, shortest) == plain_tiles(item.tolist(), text.tolist(), shortest)


ITEM = "one two three four five six seven eight nine ten eleven twelve"
OTHER = "alpha beta gamma delta epsilon zeta eta theta iota kappa"
FILL = " ".join(f"filler{n}" for n in range(300))
DOCS = [
    (1, f"{FILL} {ITEM} {FILL}"),
    (2, "Seven, EIGHT nine ten eleven; twelve -- and then one two three four five SIX."),  # reordered
    (3, "one two three four five and nothing else"),  # five of twelve
    (4, f"{OTHER} {FILL} {ITEM}"),
    (5, None), (6, ""), (7, FILL), (8, "one two three four"),
    (9, ITEM), (9, ITEM), (None, ITEM),
    (10, " ".join(["one two three four five"] * 400)),
]


def test_contaminated_documents(spark):
    docs = spark.createDataFrame(DOCS, "doc_id bigint, text string").selectExpr("*", "1 AS tokens", "'x' AS item_id")
    items = spark.createDataFrame(
        [(100, ITEM), (200, OTHER), (300, None), (400, "two short words"), (500, ITEM)], "item_id bigint, text string")
    found = rows(tiling.contaminated(docs, items), "doc_id", "item_id", "covered")
    key = lambda r: [(v is not None, str(v)) for v in r]
    assert found == sorted([(d, i, 12) for d in (1, 2, 4, 9, 9, None) for i in (100, 500)] + [(4, 200, 10)], key=key)
    looser = rows(tiling.contaminated(docs, items, coverage=0.4), "doc_id", "item_id", "covered")
    assert {r[0] for r in looser if r[2] == 5} == {3, 10}


def test_empty_tables(spark):
    docs = spark.createDataFrame(DOCS, "doc_id bigint, text string")
    items = spark.createDataFrame([(100, ITEM)], "item_id bigint, text string")
    assert tiling.contaminated(docs.limit(0), items).count() == 0
    assert tiling.contaminated(docs, items.limit(0)).count() == 0


@pytest.mark.parametrize("seed, coverage, letters", [(1, 0.5, "abcd"), (2, 0.8, "abcdefgh"), (3, 0.3, "abcdefghij")])
def test_no_pair_is_lost(spark, seed, coverage, letters):
    """Few words, so that seeds are common and repeat within an item; items of one token and more."""
    rng = random.Random(seed)
    items = [(i if i % 7 else None, [rng.choice(letters) for _ in range(rng.choice([1, 2, 3, 4, 5, 6, 9, 15, 30]))])
             for i in range(25)]
    docs = []
    for i in range(60):
        words = [rng.choice(letters) for _ in range(rng.randrange(0, 30))]
        for _ in range(i % 3):
            item = rng.choice(items)[1]
            cut = rng.randrange(len(item))
            words += item[cut:] + [rng.choice(letters)] + item[:cut]
        docs.append((i, words))
    want = []
    for doc, words in docs:
        for item, tokens in items:
            shortest = min(tiling.SHORTEST, len(tokens))
            covered = sum(n for *_, n in plain_tiles(tokens, words, shortest))
            if covered >= (coverage if len(tokens) >= tiling.SHORTEST else 1) * len(tokens):
                whole = len(tokens) < tiling.SHORTEST
                want.append((doc, item, len(tokens), len(tokens) if whole else covered))
    tables = [spark.createDataFrame([(i, " ".join(w)) for i, w in t], f"{k} BIGINT, text STRING")
              for t, k in ((docs, "doc_id"), (items, "item_id"))]
    found = tiling.contaminated(*tables, coverage=coverage)
    got = [tuple(r) for r in found.select("doc_id", "item_id", "item_tokens", "covered").collect()]
    assert sorted(got, key=str) == sorted(want, key=str) and len(got) > 20


def test_a_phrase_in_front_of_all_makes_no_pairs(spark):
    """Every document and item begins alike; none of the pairs is tiled."""
    phrase = "what is the right answer to this question"
    docs = spark.range(300).selectExpr("id AS doc_id", f"concat('{phrase} ', repeat(concat('d', id, ' '), 40)) AS text")
    items = spark.range(80).selectExpr(
        "id AS item_id", f"concat('{phrase} ', array_join(transform(sequence(1, 30), x -> concat('i', id, 'x', x)), ' ')) AS text")
    planted = docs.where("doc_id = 5").join(items.where("item_id = 9").select(items.text.alias("more"))).selectExpr(
        "1000L AS doc_id", "concat(text, more) AS text")
    numbered = kept(tiling._item_rows(items, "item_id", "text"), "items-test")
    seeds = tiling._seed_map(spark, numbered.selectExpr("explode(seeds) AS seed"))
    regions = kept(tiling._regions(texts_of(docs.union(planted)), {tiling.SHORTEST: seeds}), "regions-test")
    assert tiling._candidates(regions, numbered, 0.5).count() == 1
    assert rows(tiling.contaminated(docs.union(planted), items), "doc_id", "item_id") == [(1000, 9)]
