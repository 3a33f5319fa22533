"""The risk estimate on small samples, held-out accuracy on the given tables, odd input."""

import zlib

import numpy as np
import pytest

from queuelens.llm import toxicity
from queuelens.sources.tables import table

MEDIUM = "/root/testdata/sf0.1"
INSULTS = ["fool", "swine", "rotter"]


def sample(rng, n, share):
    """Texts of neutral words, of which a share holds insults."""
    texts, toxic = [], rng.random(n) < share
    for bad in toxic:
        words = [f"{'abcdefghij'[w % 10]}{'klmnopqrst'[w // 10 % 10]}{'uvwx'[w // 100]}y" for w in rng.integers(0, 400, 40)]
        words += list(rng.choice(INSULTS, rng.integers(1, 4))) if bad else []
        texts.append(" ".join(rng.permutation(words)))
    return texts, toxic


def test_positive_and_unlabelled_texts_are_enough():
    rng = np.random.default_rng(0)
    unlabelled, _ = sample(rng, 1500, 0.1)
    confirmed, _ = sample(rng, 200, 1.0)
    rows = [toxicity.text_features(t) for t in unlabelled + confirmed]
    weights, bias = toxicity.train(rows, np.array([False] * 1500 + [True] * 200), 0.1)
    assert (weights >= 0).all() and bias < 0
    texts, toxic = sample(rng, 800, 0.3)
    learnt = toxicity._Learnt(weights)
    scores = np.array([weights[sorted({f for w in toxicity.words_of(t) for f in learnt[w]})].sum() for t in texts]) + bias
    assert ((scores >= 0) == toxic).mean() > 0.98


def test_without_confirmed_texts_nothing_is_toxic():
    weights, bias = toxicity.train([toxicity.text_features("a b")] * 2, np.array([False, False]), 0.0)
    assert not weights.any() and bias == toxicity.NONE_KNOWN


def test_near_copies_count_once():
    copies = ["one two three four five six seven " * 5 + str(n) for n in range(20)]
    texts = copies + ["quite another text with other words", None, ""]
    assert toxicity.different([toxicity.smallest_hashes(t) for t in texts]) == [0, 20, 21, 22]


def test_held_out_accuracy(spark):
    docs, labels = table(spark, MEDIUM, "documents"), table(spark, MEDIUM, "labels")
    found = {r.doc_id: r for r in toxicity.toxicity(docs, labels).collect()}
    known = {r.doc_id: r.toxic for r in labels.collect()}
    assert len(found) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in found.values())
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in found.values())
    held = [(r.predicted, known[d]) for d, r in found.items() if r.held_out and d in known]
    caught = sum(p for p, y in held if y) / sum(y for _, y in held)
    wrong = sum(p for p, y in held if not y) / sum(1 - y for _, y in held)
    assert caught > 0.8 and wrong < 0.02


def test_long_texts_of_clean_ones_stay_clean_and_hide_no_toxic_one(spark):
    docs, labels = table(spark, MEDIUM, "documents"), table(spark, MEDIUM, "labels")
    model = toxicity.learn(docs, labels)
    found = toxicity.scored(docs.join(labels.select("doc_id", "toxic"), "doc_id"), model).collect()
    clean = [r.text for r in found if not r.toxic and r.score < 0.5]
    toxic = [r.text for r in found if r.score >= 0.5][:20]
    rng = np.random.default_rng(3)
    joined = [(n, " ".join(rng.choice(clean, n))) for n in (5, 20, 50, 100, 200) for _ in range(20)]
    joined += [(0, " ".join([*rng.choice(clean, 50), bad, *rng.choice(clean, 50)])) for bad in toxic]
    # Words that no text holds, so that only a collision could give them weight.
    unseen = " ".join("".join(rng.choice(list("bcdfghjklmnpqrstvwxz"), 9)) for _ in range(30_000))
    judged = toxicity.scored(spark.createDataFrame([*joined, (1, unseen)], "n int, text string"), model).collect()
    assert {r.n: sum(x.score >= 0.5 for x in judged if x.n == r.n) for r in judged} == {
        0: len(toxic), 1: 0, 5: 0, 20: 0, 50: 0, 100: 0, 200: 0}


def test_the_worst_passage_counts():
    weighted = {toxicity.features(w)[0]: v for w, v in (("ab", 1.0), ("cd", 2.0), ("ef", 4.0))}
    learnt = toxicity._Learnt(toxicity.pd.Series(weighted))
    rng = np.random.default_rng(4)
    for n in (0, 1, 300, 3000):
        words = list(rng.choice(["ab", "cd", "ef", "x"], n, p=[0.002, 0.002, 0.001, 0.995]))
        plain = max((sum({f: learnt.weights[f] for w in words[i:i + toxicity.PASSAGE] for f in learnt[w]}.values())
                     for i in range(n)), default=0)
        assert toxicity.strongest(words, learnt) == plain


def test_labels_of_the_held_out_fold_are_not_read(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    labels = table(spark, "/root/testdata/sf0.01", "labels")
    flipped = labels.withColumn("toxic", toxicity.F.when(
        toxicity.held_out(toxicity.F.col("doc_id")), 1 - toxicity.F.col("toxic")).otherwise(toxicity.F.col("toxic")))
    for one, other in zip(toxicity.learn(docs, labels), toxicity.learn(docs, flipped)):
        assert np.allclose(one, other)


@pytest.fixture
def odd(spark):
    return spark.createDataFrame(
        [(1, None, "x"), (2, "", "x"), (3, "word " * 50_000, "x"), (3, "word", "x"), (None, "fool", "x")],
        "doc_id bigint, text string, score string")


def test_odd_rows(spark, odd):
    labels = spark.createDataFrame([(1, 1), (1, 0), (None, 1), (7, 1), (2, None)], "doc_id bigint, toxic int")
    rows = toxicity.toxicity(odd, labels).collect()
    assert len(rows) == 5 and all(0 <= r.score <= 1 for r in rows)
    assert not next(r for r in rows if r.doc_id is None).held_out
    none = toxicity.toxicity(odd, labels.limit(0)).collect()
    assert all(r.predicted == 0 for r in none)
    assert toxicity.toxicity(odd.limit(0), labels).count() == 0


def test_every_text_is_counted(spark):
    """In 80 of 8,000 confirmed texts a word may tell something, in 79 not; near copies teach once."""
    learnt_from = [n for n in range(40_000) if zlib.crc32(str(n).encode()) % 5][:30_000]
    letters = str.maketrans("0123456789", "qrstuvwxyz")
    docs = []
    for place, doc in enumerate(learnt_from):
        own = f"{doc:05}".translate(letters)
        words = [f"a{own}", f"b{own}", f"c{own}"]
        if place < 480:
            words += ["abcdef"[place // 80] + "paint"] + ["abcdef"[place // 80] + "tulk"] * (place % 80 > 0)
        docs.append((doc, " ".join(words), place))
    docs = spark.createDataFrame(docs, "doc_id bigint, text string, place int")
    labels = docs.selectExpr("doc_id", "int(place < 8000) AS toxic")
    copies = docs.where("place < 480")
    weights, _ = toxicity.learn(docs.union(copies).union(copies), labels)
    told = [c + w for w in ("paint", "tulk") for c in "abcdef"
            if toxicity.xxhash.xxh64_intdigest(c + w) >> 1 in weights.index]
    assert told == [c + "paint" for c in "abcdef"]


def test_near_copies_are_the_same_however_many_tasks(spark):
    copies = ["one two three four five six seven " * 5 + str(n) for n in range(20)]
    texts = copies + ["quite another text with other words", "", "1 2", "and one more"]
    rows = spark.createDataFrame([(n, toxicity.smallest_hashes(t)) for n, t in enumerate(texts)] * 2,
                                 "key bigint, hashes array<bigint>")
    assert sorted(r.key for r in toxicity.different_texts(rows.repartition(7)).collect()) == toxicity.different(
        [toxicity.smallest_hashes(t) for t in texts]) == [0, 20, 21, 22, 23]
