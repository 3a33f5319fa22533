"""The closed form against a step-by-step replay of random logs."""

import random
from collections import deque

import pytest
from pyspark.sql import functions as F

from queuelens.operators import buffers
from tests.helpers import at, rows

CAPACITY = 3


def random_logs(traces=300, seed=7):
    """(trace, second, id, op): one trace is far longer than the others."""
    rng = random.Random(seed)
    log = []
    for trace in range(traces):
        length = 2000 if trace == 0 else rng.randint(1, 25)
        bias = rng.random()
        for i in range(length):
            op = "put" if rng.random() < bias else "get"
            log.append((trace, i // 2, len(log), op))
    return log


def replay(log):
    """Waiting producers and consumers queue up first come, first served."""
    stored, producers, consumers = deque(), deque(), deque()
    admitted, taken, states = {}, {}, []
    for second, row_id, op in log:
        (producers if op == "put" else consumers).append((row_id, second))
        moved = True
        while moved:
            moved = False
            if producers and len(stored) < CAPACITY:
                row, asked = producers.popleft()
                admitted[row] = second
                stored.append(row)
                moved = True
            if consumers and stored:
                get, _ = consumers.popleft()
                taken[get] = (stored.popleft(), second)
                moved = True
        states.append((row_id, len(stored), len(producers), len(consumers)))
    return admitted, taken, states


@pytest.fixture(scope="module")
def logs(spark):
    log = random_logs()
    df = spark.createDataFrame(
        [(k, at(s), i, op) for k, s, i, op in log],
        "k INT, ts TIMESTAMP_NTZ, event_id INT, op STRING",
    ).cache()
    by_trace = {}
    for k, s, i, op in log:
        by_trace.setdefault(k, []).append((s, i, op))
    return df, {k: replay(steps) for k, steps in by_trace.items()}


@pytest.mark.parametrize("hot_rows", [None, 50])
def test_replay(logs, hot_rows):
    df, replays = logs
    pairs = buffers.buffer_wait(buffers.fifo_match(df, ["k"], hot_rows=hot_rows))
    got = {r.get_id: (r.put_id, r.completed_at) for r in pairs.collect()}
    assert got == {
        get: (put, at(second)) for _, taken, _ in replays.values()
        for get, (put, second) in taken.items()
    }

    state = buffers.buffer_state(df, ["k"], CAPACITY, hot_rows=hot_rows)
    got = rows(state, "event_id", "stored", "blocked_producers", "waiting_consumers")
    assert sorted(got) == sorted(s for _, _, states in replays.values() for s in states)

    puts = buffers.blocked_puts(df, ["k"], CAPACITY, hot_rows=hot_rows)
    got = {r.put_id: r.admitted_at for r in puts.collect() if r.admitted_at is not None}
    assert got == {
        put: at(second) for admitted, _, _ in replays.values() for put, second in admitted.items()
    }
    assert puts.where("blocked_ms < 0").isEmpty()


def test_nothing_is_lost(logs):
    df, _ = logs
    matched = buffers.fifo_match(df, ["k"]).groupBy("k").agg(F.count("*").alias("matched"))
    left = buffers.buffer_leftover(df, ["k"], CAPACITY).join(matched, "k", "left").fillna(0)
    assert left.where("puts <> matched + left + still_blocked").isEmpty()
    assert left.where("gets <> matched + still_waiting").isEmpty()


def test_saturation_agrees_with_state(logs):
    df, _ = logs
    state = buffers.buffer_state(df, ["k"], CAPACITY)
    saturation = buffers.buffer_saturation(state, ["k"], CAPACITY)
    assert saturation.where("full_share + empty_share > 1 OR blocked_share > full_share").isEmpty()
    assert saturation.agg(F.max("peak_stored")).first()[0] == CAPACITY
    assert saturation.agg(F.sum("n")).first()[0] == df.count()
