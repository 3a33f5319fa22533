"""SimHash fingerprints and BK-tree links against brute force."""

import re

import numpy as np
import xxhash

from queuelens.llm import simhash
from queuelens.llm.components import connected_components
from tests.helpers import rows


def plain_fingerprint(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall("[^\x20\x09-\x0D]+", lower)
    shingles = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(near):
    root = np.arange(len(near))
    while True:
        new = np.array([root[row].min() for row in near])
        if (new == root).all():
            return root
        root = new


def test_fingerprints_are_the_plain_ones(spark):
    texts = ["", "a", "A b\tC", "one two three four five", "É é\x0bx\x85y z w", "a " * 5000, "\x1fa b c d e f",
             "x y z w x y z w x y z w"]
    expected = [plain_fingerprint(t) for t in texts]
    assert simhash.fingerprint(texts).tolist() == expected
    by_spark = spark.createDataFrame([("one two three four",)], "s string").selectExpr("xxhash64(s)").first()[0]
    assert by_spark % 2 ** 64 == xxhash.xxh64_intdigest("one two three four", 42)


def test_long_texts_are_laid_out_in_parts(monkeypatch):
    text = " ".join(str(n * n % 97) for n in range(3000))
    monkeypatch.setattr(simhash, "LAID_OUT", 100)
    assert simhash.fingerprint([text, "", text]).tolist() == [plain_fingerprint(text), 0, plain_fingerprint(text)]


def test_trees_find_all_links(monkeypatch):
    rng = np.random.default_rng(5)
    monkeypatch.setattr(simhash, "FRONTIER", 500)
    for _ in range(20):
        n = int(rng.integers(1, 250))
        seeds = rng.integers(0, 2 ** 63, size=max(1, n // 15), dtype=np.uint64)
        fps = seeds[rng.integers(0, len(seeds), n)]
        for _ in range(4):
            fps ^= np.where(rng.random(n) < 0.6, np.uint64(1) << rng.integers(0, 64, n).astype(np.uint64), np.uint64(0))
        fps = rng.permutation(np.unique(fps))
        starts = np.unique(np.append(0, rng.integers(0, len(fps), 3)))
        group = np.searchsorted(starts, np.arange(len(fps)), "right")
        near = (np.bitwise_count(fps[:, None] ^ fps) <= 4) & (group[:, None] == group)
        assert (simhash.linked(fps, starts) == roots(near)).all()


def test_links_of_split_shards(spark):
    rng = np.random.default_rng(6)
    fps = np.unique(np.concatenate([
        np.bitwise_xor.reduce(np.uint64(1) << rng.integers(0, 64, (300, 3)).astype(np.uint64), axis=1),
        rng.integers(0, 2 ** 63, 50, dtype=np.uint64)])).view(np.int64)
    frame = spark.createDataFrame([(int(f),) for f in fps], "fp bigint")
    near = np.bitwise_count(fps[:, None].view(np.uint64) ^ fps.view(np.uint64)) <= 4
    expected = {int(f): int(fps[near_roots].min()) for f, near_roots in
                zip(fps, (roots(near) == r for r in roots(near)))}
    for block in (8192, 7):
        found = dict(map(tuple, connected_components(simhash.links(frame, block=block)).collect()))
        assert found == {f: r for f, r in expected.items() if f != r}


def test_components_of_a_long_path_and_a_star(spark):
    path = [(n, n + 1) for n in range(1, 60)]
    star = [(1000, n) for n in range(1001, 1200)]
    edges = spark.createDataFrame(path + star + [(5, 5)] + path[:3], "a bigint, b bigint")
    found = dict(map(tuple, connected_components(edges).collect()))
    assert found == {**{n: 1 for n in range(2, 61)}, **{n: 1000 for n in range(1001, 1200)}}
    assert connected_components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_documents(spark):
    text = " ".join(f"word{n}" for n in range(200))
    docs = spark.createDataFrame(
        [(5, text, 1), (3, text, 1), (9, None, 1), (8, "", 1), (None, text, 1), (5, text, 1), (7, text.upper(), 1),
         (1, "quite another text about something else", 1)], "doc_id bigint, text string, fp int")
    found = rows(simhash.near_duplicates(docs), "doc_id", "component_id", "fingerprint")
    print_of = f"{plain_fingerprint(text):016x}"
    assert [r for r in found if r[2] == print_of] == [
        (None, 3, print_of), (3, 3, print_of), (5, 3, print_of), (5, 3, print_of), (7, 3, print_of)]
    assert [r for r in found if r[2] == "0" * 16] == [(8, 8, "0" * 16), (9, 8, "0" * 16)]
    assert len(found) == 8
    assert simhash.near_duplicates(docs.limit(0)).count() == 0
