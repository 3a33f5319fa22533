"""The coder's exact round trips, damage, and token files against the tokenizer."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from queuelens.llm import mixing, tokenfile
from tests.llm.test_packing import ODD, plain_ids


def test_any_blocks_come_back():
    rng = np.random.default_rng(0)
    for _ in range(12):
        blocks = [rng.integers(0, int(rng.choice([1, 2, 50, 5000, 65536])), int(rng.integers(0, 1200))).astype(np.uint32)
                  for _ in range(int(rng.integers(1, 9)))]
        found = mixing.decode(mixing.encode(blocks), [len(b) for b in blocks])
        assert all(np.array_equal(a, b) for a, b in zip(blocks, found))
    assert mixing.encode([]) == [] and mixing.decode([], []) == []


def test_blocks_are_independent():
    rng = np.random.default_rng(1)
    blocks = [rng.integers(0, 300, n).astype(np.uint32) for n in (700, 5, 2000)]
    together = mixing.encode(blocks)
    assert together == [mixing.encode([b])[0] for b in blocks]
    assert np.array_equal(mixing.decode([together[2]], [2000])[0], blocks[2])


def test_repetition_and_skew_are_compressed():
    rng = np.random.default_rng(2)
    phrase = rng.integers(0, 49_000, 50)
    repeated = np.tile(phrase, 80).astype(np.uint32)
    assert len(mixing.encode([repeated])[0]) * 8 < 1.5 * len(repeated)
    skewed = rng.geometric(0.2, 4000).astype(np.uint32)
    entropy = -sum(p * np.log2(p) for p in np.bincount(skewed)[1:] / 4000 if p)
    assert len(mixing.encode([skewed])[0]) * 8 < (entropy + 0.8) * 4000


def test_codes_stay_what_they_were():
    rng = np.random.default_rng(4)
    blocks = [np.minimum(rng.zipf(1.3, n), 65_535).astype(np.uint32) for n in (1300, 0, 1, 900, 33, 700)]
    blocks.append(np.tile(rng.integers(0, 65536, 40), 30).astype(np.uint32))
    codes = mixing.encode(blocks)
    assert hashlib.sha256(b"".join(codes)).hexdigest() == (
        "087410b247c96b7bb784d31b8a2a06cbcba3994cbe2a5b4f59bf37fa224a843b")
    assert all(np.array_equal(a, b) for a, b in zip(blocks, mixing.decode(codes, [len(b) for b in blocks])))


def test_counts_of_order_zero():
    rng = np.random.default_rng(5)
    ids, wanted = (rng.integers(0, 40, (9, n)).astype(np.uint16) for n in (64, 50))
    held, begin, count = mixing._counts(ids)
    assert np.array_equal(held, np.sort(ids, axis=1))
    begins, counts = mixing._ahead(ids, wanted)
    for block, (row, asked) in enumerate(zip(ids, wanted)):
        for step, i in enumerate(asked):
            assert counts[step, block] == (row == i).sum()
            assert not counts[step, block] or begins[step, block] == (row < i).sum()


def test_quotients_of_spans_are_whole():
    rng = np.random.default_rng(6)
    total = np.concatenate([rng.integers(1, 8200, 50_000), rng.integers(1 << 19, 1 << 40, 50_000)])
    span = rng.integers(1, 1 << 48, 100_000)
    span[::2] = np.maximum(span[::2] // total[::2], 1) * total[::2] - rng.integers(0, 2, 50_000)
    assert np.array_equal(mixing._share(span, total), span // total)


def test_any_damage_ends_in_other_ids():
    rng = np.random.default_rng(7)
    blocks = [rng.integers(0, 3000, 1100).astype(np.uint32) for _ in range(40)]
    codes = mixing.encode(blocks)
    damaged = [rng.bytes(len(c)) if n % 2 else c[:n * 20] + rng.bytes(8) + b"\xff" * 600 for n, c in enumerate(codes)]
    found = mixing.decode(damaged, [1100] * 40)
    assert all(len(f) == 1100 and f.max() < 65_536 and not np.array_equal(f, b) for f, b in zip(found, blocks))


def test_checksums_of_joined_pieces():
    r = random.Random(1)
    for _ in range(40):
        parts = [r.randbytes(4 * r.randrange(60)) for _ in range(r.randrange(1, 5))]
        assert tokenfile.joined_crc([(zlib.crc32(p), len(p)) for p in parts]) == zlib.crc32(b"".join(parts))


DOCS = [(n * 7 % 40, t) for n, t in enumerate(ODD)] + [(3, "x y"), (3, "x y"), (None, "z"), (1000, "several words " * 6000)]


def test_files(spark):
    docs = spark.createDataFrame(DOCS, "doc_id bigint, text string").selectExpr("*", "1 AS start", "2 AS part")
    found = sorted((tuple(r) for r in tokenfile.round_trip(docs.repartition(5)).collect()), key=lambda r: r[1])
    expected = sorted(((d, plain_ids(t) + [2]) for d, t in DOCS), key=lambda r: (r[0] is not None, r[0] or 0))
    key = lambda r: [(v is not None, str(v)) for v in r]
    assert sorted(((d, n, c) for d, _, n, c in found), key=key) == sorted(
        ((d, len(i), zlib.crc32(np.array(i, "<u4").tobytes())) for d, i in expected), key=key)
    starts = [0]
    for _, start, n, _ in found:
        assert start == starts[-1]
        starts.append(start + n)
    assert [d for d, *_ in found] == [d for d, _ in expected]
    assert tokenfile.round_trip(docs.limit(0)).count() == 0


def test_a_damaged_block_is_told(spark, tmp_path):
    docs = spark.createDataFrame(DOCS, "doc_id bigint, text string")
    path = str(tmp_path / "whole")
    tokenfile.write(docs, path)
    damaged = spark.read.parquet(path).selectExpr(
        *[c for c in tokenfile.BLOCKS.replace(",", " ").split() if c in (
            "part", "block", "first", "n_ids", "crc32", "doc_ids", "doc_numbers", "pieces", "last", "lengths")],
        "concat(substring(code, 1, 20), X'0000', substring(code, 23)) AS code")
    damaged.write.parquet(str(tmp_path / "damaged"))
    with pytest.raises(Exception, match="DamagedBlock"):
        tokenfile.read(spark, str(tmp_path / "damaged")).collect()


def test_no_few_blocks_are_coded_apart():
    for n in (0, 1, 700, 2212, tokenfile.TOGETHER + 1, 3 * tokenfile.TOGETHER + 5, 26_000):
        dealt = tokenfile.dealt(n)
        sizes = [b - a for a, b in dealt]
        assert [i for a, b in dealt for i in range(a, b)] == list(range(n))
        assert len(sizes) == -(-n // tokenfile.TOGETHER) and max(sizes, default=0) - min(sizes, default=0) <= 1


def test_carries_run_through_full_words():
    writer, lane = mixing._Writer(2, 4), np.array([1])
    for word in (5, 0xFFFF, 0xFFFF, 0x10003):
        assert writer.put(lane, np.array([word * mixing.SMALL + 7])) == 7 * mixing.WORD
    writer.low[1] = mixing.TOP + 2
    codes = writer.finished()
    assert np.frombuffer(codes[0], "<u2").tolist() == [0, 0, 0]
    assert np.frombuffer(codes[1], "<u2").tolist() == [6, 0, 0, 4, 0, 0, 2]


def test_groups_of_blocks_do_not_mix():
    rng = np.random.default_rng(8)
    ids = rng.integers(0, 30, (mixing.SORTED + 9, 32)).astype(np.uint16)
    held = mixing._held(np.ascontiguousarray(ids.T)).reshape(len(ids), 33)
    for row, block in zip(held, ids):
        for at, i in enumerate(sorted(block.tolist())):
            assert row[at] == (block == i).sum() << 32 | (block < i).sum() << 16 | i
        assert row[32] == 32 << 16
    begins, counts = mixing._ahead(ids, ids[::-1])
    for block, (row, asked) in enumerate(zip(ids, ids[::-1])):
        for step, i in enumerate(asked):
            assert counts[step, block] == (row == i).sum()
            assert begins[step, block] == ((row < i).sum() if i in row else 32)
