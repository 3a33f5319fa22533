"""Exact duplicates against a dictionary, and the perfect hash against its definition."""

import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from queuelens.llm import perfecthash
from queuelens.llm.queries import QUERIES
from tests.conftest import SMALL


def random_digests(n, seed=1):
    return np.random.default_rng(seed).integers(0, 2**63, (n, 4), dtype=np.uint64)


@pytest.mark.parametrize("n", [0, 1, 2, 63, 5000, 100_000])
def test_slots_are_a_permutation(n):
    words = random_digests(n)
    sizes, bits, slots = perfecthash.build(words)
    assert sorted(slots.tolist()) == list(range(n))
    held = words[np.argsort(slots)]
    assert (perfecthash.lookup(words, sizes, bits, held) == slots).all()
    others = random_digests(1000, seed=2)
    assert (perfecthash.lookup(others, sizes, bits, held) == -1).all()


def test_digests_without_a_place_come_last(monkeypatch):
    monkeypatch.setattr(perfecthash, "LEVELS", 1)
    words = random_digests(500)
    sizes, bits, slots = perfecthash.build(words)
    assert sizes[-1] == 0 and sorted(slots.tolist()) == list(range(500))
    held = words[np.argsort(slots)]
    assert (perfecthash.lookup(words, sizes, bits, held) == slots).all()
    assert (perfecthash.lookup(random_digests(50, 3), sizes, bits, held) == -1).all()


def plain(rows):
    """(doc_id, keep_id, group_size, digest) per row, and how many rows of each digest stay."""
    groups = {}
    for doc, text in rows:
        text = text or ""
        digest = hashlib.sha256(re.sub(r"[\x20\x09-\x0D]", "", text).encode()).hexdigest()
        groups.setdefault(digest, []).append((-len(text), doc is None, doc or 0, doc))
    out = []
    for digest, members in groups.items():
        keep = min(members)[3]
        out += [(m[3], keep, len(members), digest) for m in members]
    return sorted(out, key=str), len(groups)


def check(spark, rows, first, **kwargs):
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING")
    found = perfecthash.remove_repeats(docs, first, **kwargs).collect()
    want, groups = plain(rows)
    assert sorted([(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in found], key=str) == want
    kept = [r for r in found if r.kept]
    assert len(kept) == groups and all(r.doc_id == r.keep_id for r in kept)


ODD = [(1, "a b"), (2, "ab"), (3, " a  b "), (4, None), (5, ""), (6, "\n\t\x0b"), (7, "Ab"), (8, "x" * 100_000),
       (9, "x " * 100_000), (None, "ab"), (None, "only"), (9, "x " * 100_000), (10, "a b"), (11, "ab"),
       (12, "  ab"), (13, " a  b ")]


@pytest.mark.parametrize("condition", ["doc_id <= 5", "doc_id > 5", "false", "true", "doc_id IN (3, 9)"])
def test_odd_rows_whatever_the_history(spark, condition):
    check(spark, ODD, F.expr(condition))


@pytest.mark.parametrize("shard_size", [1, 7, 1000])
def test_many_groups_in_small_shards(spark, shard_size):
    rows = [(i, f"text {i % 97}" if i % 3 else "hot" + " " * (i % 5)) for i in range(600)]
    check(spark, rows, F.col("doc_id") < 200, shard_size=shard_size)


def test_empty_table_and_clashing_columns(spark):
    empty = spark.createDataFrame([], "doc_id BIGINT, text STRING")
    assert perfecthash.remove_repeats(empty, F.col("doc_id") < 3).collect() == []
    clash = spark.createDataFrame([(1, "a", 5, "x", 2), (2, "a ", 6, "y", 3)],
                                  "doc_id INT, text STRING, size INT, digest STRING, row INT")
    found = perfecthash.remove_repeats(clash, F.col("doc_id") < 2)
    assert sorted(tuple(r)[:4] for r in found.collect()) == [(1, 2, 2, False), (2, 2, 2, True)]


def test_the_index_is_read_from_its_files(spark):
    """A later job needs nothing but the path."""
    docs = spark.createDataFrame([(i, f"t{i % 50}") for i in range(100)], "doc_id BIGINT, text STRING")
    from queuelens.session import shared_path

    path = shared_path(spark, "index-test")
    perfecthash.write_index(perfecthash.winners(perfecthash.digests(docs)), path, 10)
    assert spark.read.parquet(path).count() == 5
    assert perfecthash.slots(spark, path).count() == 50
    new = spark.createDataFrame([(200, "t 7"), (201, "new")], "doc_id BIGINT, text STRING")
    found = perfecthash.look_up(spark, path, perfecthash.winners(perfecthash.digests(new)), 10)
    assert {(r.doc_id, r.old_doc_id, r.old_size) for r in found.collect()} == {(200, 7, 2), (201, None, None)}


def test_query_matches_a_dictionary(spark):
    found = QUERIES["op13_exact"](spark, SMALL).collect()
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted([(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in found], key=str) == plain(rows)[0]
