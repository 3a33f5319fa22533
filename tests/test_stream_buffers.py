"""Buffers from a stream equal their batch twins, in whatever order rows arrive within the lateness."""

import pytest
from pyspark.sql import functions as F

from queuelens.operators import buffers
from queuelens.session import shared_path
from queuelens.sources.tables import event_stream, table
from queuelens.streaming import buffers as stream_buffers
from queuelens.streaming.operators import stream_nth_event
from queuelens.streaming.sinks import append_all, start_append, stored
from tests.conftest import SMALL
from tests.helpers import same

KEY = ["user_id"]


@pytest.fixture(scope="module")
def events(spark):
    return table(spark, SMALL, "events").cache()


def put_and_get(df):
    return buffers.buffer_log(df, "event_type", put="view", get="click")


def hot(events):
    """A third of all rows under the null key, ids that a double cannot hold, ties in time."""
    n = F.col("event_id")
    tie = F.when(n % 4 == 0, F.date_trunc("hour", "ts").cast("timestamp_ntz")).otherwise(F.col("ts"))
    return events.withColumns({"user_id": F.when(n % 3 > 0, F.lit(2**60) + n % 5).cast("bigint"),
                               "ts": tie, "event_id": F.lit(2**60) + n}).select(events.columns)


def shuffled(events, folder):
    """Six files in a rough time order: a row comes up to 20 hours late; the last one closes all slices."""
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    late = F.pmod(F.xxhash64("event_id"), F.lit(20 * 3_600_000_000))
    first, last = events.agg(F.min(micros), F.max(micros)).first()
    step = (last - first) // 5 + 20 * 3_600_000_000
    turn = F.floor((micros + late - first) / step)
    for part in range(6):
        events.where(turn == part).orderBy(F.xxhash64("event_id")).coalesce(1).write.mode("append").parquet(folder)
    end = events.orderBy(F.desc("ts")).limit(1).withColumns({
        "ts": F.expr("ts + INTERVAL 9 DAYS"), "event_type": F.lit("view"), "event_id": F.lit(-1).cast("bigint")})
    end.coalesce(1).write.mode("append").parquet(folder)


def emitted(spark, folder, out, lateness="1 day", **options):
    log = stream_buffers.stream_positions(put_and_get(event_stream(spark, folder, **options)), KEY, "6 hours", lateness)
    query = start_append(log, out)
    query.awaitTermination()
    return stored(log, out), query


@pytest.mark.parametrize("hot_rows", [None, 5])
def test_equals_batch_under_shuffled_arrival(spark, events, hot_rows):
    folder, rows = shared_path(spark, "late-puts"), hot(events)
    shuffled(rows, folder)
    placed, query = emitted(spark, folder, shared_path(spark, "positions"), files_per_trigger=1)
    assert sum(p.stateOperators[0].numRowsDroppedByWatermark for p in query.recentProgress) == 0
    assert len([p for p in query.recentProgress if p.numInputRows]) > 4
    whole = stream_buffers.positions(placed, KEY, hot_rows)
    state = buffers.state_at(whole, 3)
    batch = buffers.buffer_state(put_and_get(rows), KEY, 3)
    assert same(state, batch.select(*state.columns)) and state.count() > 300
    assert same(buffers.blocked_at(whole, KEY, 3), buffers.blocked_puts(put_and_get(rows), KEY, 3))


def test_restart_and_state_that_ends(spark, events):
    """Each run holds only slices that are still open, and goes on where the last one stopped."""
    folder, out, held = shared_path(spark, "growing-puts"), shared_path(spark, "growing-positions"), []
    for low in range(0, 1000, 250):
        part = events.where((F.col("event_id") >= low) & (F.col("event_id") < low + 250))
        part.coalesce(1).write.mode("append").parquet(folder)
        placed, query = emitted(spark, folder, out, "1 hour")
        held.append(query.lastProgress.stateOperators[0].numRowsTotal)
    assert max(held) < 150
    end = put_and_get(events).agg(F.max("ts")).first()[0]
    closed = put_and_get(events).where(
        F.window(F.col("ts").cast("timestamp"), "6 hours")["end"].cast("timestamp_ntz") < F.lit(end) - F.expr("INTERVAL 1 HOUR"))
    state = buffers.state_at(stream_buffers.positions(placed, KEY), 2)
    assert same(state, buffers.buffer_state(closed, KEY, 2).select(*state.columns)) and state.count() > 300


def test_late_rows_are_counted(spark, events):
    folder, out = shared_path(spark, "too-late"), shared_path(spark, "too-late-positions")
    log = put_and_get(events)
    late = log.orderBy("ts").limit(1).drop("op")
    log.drop("op").join(late, "event_id", "left_anti").select(events.columns).coalesce(1).write.parquet(folder)
    emitted(spark, folder, out)
    late.select(events.columns).coalesce(1).write.mode("append").parquet(folder)
    placed, query = emitted(spark, folder, out)
    assert sum(p.stateOperators[0].numRowsDroppedByWatermark for p in query.recentProgress) == 1
    assert placed.join(late, "event_id").isEmpty()


def test_a_session_with_another_state_store(spark, events):
    """Sessions that were not made by this library name another store, which cannot hold such state."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    spark.conf.set(name, "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider")
    try:
        folder = shared_path(spark, "other-store")
        events.coalesce(1).write.parquet(folder)
        assert emitted(spark, folder, shared_path(spark, "other-store-positions"))[0].count() > 300
        log = stream_nth_event(event_stream(spark, folder), KEY, 5)
        assert not append_all(log, shared_path(spark, "other-store-nth")).isEmpty()
    finally:
        spark.conf.set(name, before)
