"""Streams over several files equal their batch twins, also after a restart."""

import random
import time
from datetime import datetime, timedelta

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from queuelens.functions.times import ntz
from queuelens.operators import events as ev, logs, routing, triggers
from queuelens.session import shared_path
from queuelens.sources.schemas import EVENTS, REGISTRY
from queuelens.sources.tables import event_stream, table
from queuelens.streaming import operators as stream
from queuelens.streaming.sinks import (
    JOIN_STATE, append_all, complete_all, newest_complete, start_append, start_complete, stored, stored_complete,
)
from tests.conftest import SMALL
from tests.helpers import rows, same

AS_OF = "2024-02-01"


@pytest.fixture(scope="module")
def events(spark):
    return table(spark, SMALL, "events").cache()


def write_slice(events, folder, low, high):
    rows_of_slice = events.where((F.col("event_id") >= low) & (F.col("event_id") < high))
    rows_of_slice.coalesce(1).write.mode("append").parquet(folder)


@pytest.fixture(scope="module")
def folder(spark, events):
    """The events in five files, in time order."""
    path = shared_path(spark, "stream-input")
    for low in range(0, 1000, 200):
        write_slice(events, path, low, low + 200)
    return path


@pytest.fixture
def source(spark, folder):
    return event_stream(spark, folder, files_per_trigger=1)


@pytest.fixture
def out(spark):
    return shared_path(spark, "stream-test")


def test_all_events_arrive(events, source, out):
    assert same(append_all(source, out), events)


def test_counts(events, source, out):
    counts = complete_all(stream.stream_counts(source, ["user_id"]), out)
    assert same(counts, events.groupBy("user_id").agg(F.count("*").alias("n")))


def test_restart_continues_exactly_once(spark, events, out):
    folder = shared_path(spark, "growing-input")
    write_slice(events, folder, 0, 500)
    counts = stream.stream_counts(event_stream(spark, folder), ["event_type"])
    copies = event_stream(spark, folder)
    start_complete(counts, out).awaitTermination()
    start_append(copies, f"{out}/copies").awaitTermination()
    write_slice(events, folder, 500, 1000)
    start_complete(counts, out).awaitTermination()
    start_append(copies, f"{out}/copies").awaitTermination()
    start_append(copies, f"{out}/copies").awaitTermination()
    assert same(stored_complete(counts.schema, spark, out), events.groupBy("event_type").agg(F.count("*").alias("n")))
    assert same(stored(copies, f"{out}/copies"), events)


def nth_events(log, key, n, path):
    return append_all(stream.stream_nth_event(log, key, n), path)


def test_nth_event(events, source, out):
    reached = nth_events(source, ["user_id"], 5, out)
    batch = triggers.nth_event(events, ["user_id"], ["ts", "event_id"], 5)
    assert same(reached, batch.select(*reached.columns))


def test_nth_event_state_stops_growing(spark, events, out):
    """Counts are all that is kept: as many after five files as after one, and keys that fired stay silent."""
    folder, sizes = shared_path(spark, "counted-input"), []
    for low in range(0, 1000, 200):
        write_slice(events, folder, low, low + 200)
        log = stream.stream_nth_event(event_stream(spark, folder), ["event_type"], 3)
        query = start_append(log, out)
        query.awaitTermination()
        state = query.lastProgress.stateOperators
        sizes.append(([o.numRowsTotal for o in state], [o.numRowsUpdated for o in state]))
    kinds = events.select("event_type").distinct().count()
    assert all(total[-1] <= kinds * stream.SALTS and min(total) <= kinds for total, _ in sizes)
    assert sizes[-1][0] == sizes[-2][0] and min(sizes[-1][1]) == 0
    batch = triggers.nth_event(events, ["event_type"], ["ts", "event_id"], 3)
    assert same(stored(log, out), batch.select(*log.columns))


def odd_events(events):
    """Keys of two columns, with nulls and ids that a double cannot hold."""
    number = F.col("event_id")
    return events.withColumns({
        "user_id": F.when(number % 5 > 0, F.lit(2**60) + number % 4).cast("bigint"),
        "event_id": F.lit(2**60) + number,
        "value": F.when(number % 3 == 0, F.lit(float("nan"))).otherwise(F.col("value")),
        "props": F.when(number % 2 == 0, F.col("props"))}).select(events.columns)


def test_nth_event_of_odd_keys(spark, events, out):
    folder, odd = shared_path(spark, "odd-input"), odd_events(events)
    for part in range(4):
        odd.where(F.pmod(F.col("event_id"), F.lit(1000)) % 4 == part).coalesce(1).write.mode("append").parquet(folder)
    log = event_stream(spark, folder)
    reached = nth_events(log, ["user_id", "event_type"], 7, out)
    batch = triggers.nth_event(odd, ["user_id", "event_type"], ["ts", "event_id"], 7)
    assert same(reached, batch.select(*reached.columns))


def test_nth_event_keeps_one_count_per_key(spark, events, out):
    """No part of a key has a count of its own, and a second file goes on from the first one's counts."""
    folder = shared_path(spark, "two-halves")
    for low in (0, 500):
        write_slice(events, folder, low, low + 500)
        query = start_append(stream.stream_nth_event(event_stream(spark, folder), ["user_id"], 5), out)
        query.awaitTermination()
    seen = spark.read.parquet(folder)
    assert sum(o.numRowsTotal for o in query.lastProgress.stateOperators) == seen.select("user_id").distinct().count()
    batch = triggers.nth_event(seen, ["user_id"], ["ts", "event_id"], 5).select("user_id", "ts", "event_id")
    assert same(spark.read.schema(batch.schema).parquet(f"{out}/rows"), batch)


def test_tasks_drop_rows_that_cannot_be_the_nth(monkeypatch):
    monkeypatch.setattr(stream, "HELD", 2000)
    rng = random.Random(4)
    rows = [("hot" if rng.random() < 0.9 else f"k{rng.randrange(50)}", rng.randrange(3000), number) for number in range(20_000)]
    batches = [pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows[low:low + 500])],
                                          names=["nth_key", "nth_micros", "event_id"]) for low in range(0, 20_000, 500)]
    passed = [tuple(r.values()) for b in stream._passing(5, "event_id")(iter(batches)) for r in b.to_pylist()]
    assert len(passed) == len(set(passed)) <= 5 * 51
    for key in {k for k, *_ in rows}:
        first = sorted(r[1:] for r in rows if r[0] == key)[:5]
        assert sorted(r[1:] for r in passed if r[0] == key) == first


def test_distinct_keeps_nulls_nan_and_large_ids(spark, events, out):
    folder, odd = shared_path(spark, "odd-copies"), odd_events(events)
    odd.union(odd.where("event_type = 'view'")).repartition(3).write.parquet(folder)
    kept = append_all(stream.stream_distinct(event_stream(spark, folder), "event_id", "60 days"), out)
    assert same(kept, odd)


def test_nth_event_counts_by_arrival(spark, events, out):
    """Files in reverse order: each user's count starts with the last file."""
    folder = shared_path(spark, "reversed-input")
    for low in (500, 0):
        write_slice(events, folder, low, low + 500)
        reached = nth_events(event_stream(spark, folder), ["user_id"], 20, out)
    late = F.when(F.col("event_id") >= 500, 0).otherwise(1)
    arrival = triggers.nth_event(events.withColumn("file", late), ["user_id"], ["file", "ts", "event_id"], 20)
    assert same(reached, arrival.select("user_id", "ts", "event_id"))


def test_copies_are_dropped(spark, events, out):
    folder = shared_path(spark, "copies-input")
    for low in range(0, 1000, 250):
        write_slice(events, folder, low, low + 250)
        write_slice(events, folder, low, low + 125)
    one = events.where("event_id = 999")
    one.union(one).union(one).union(one).coalesce(1).write.mode("append").parquet(folder)
    kept = append_all(
        stream.stream_distinct(event_stream(spark, folder), "event_id", "60 days"), out)
    assert same(kept, events)


def test_windows_equal_batch_until_the_last(events, source, out):
    counts = append_all(stream.stream_latency_counts(source, ntz(AS_OF), "1 day", "1 hour"), out)
    windows = stream.stream_latency_tumbling(counts)
    batch = ev.latency_tumbling(ev.event_latency(events, ntz(AS_OF)), "1 day")
    closed = batch.where("period_start < TIMESTAMP_NTZ'2024-01-30'")
    near = lambda df: df.withColumns({c: F.round(c, 4) for c in ("mean", "stddev")})
    assert same(near(windows), near(closed))


def test_large_windows_stay_exact(spark, out):
    """100,000 distinct latencies in one window, far beyond what a sketch keeps."""
    day = spark.sql("SELECT TIMESTAMP_NTZ'2024-01-01 00:00:00' AS first")
    many = spark.range(100_000).join(day).selectExpr(
        "id AS event_id", "first + make_dt_interval(0, 0, 0, id * 0.8) AS ts", "1L AS user_id", "'x' AS event_type",
        "1D AS value", "'' AS props")
    last = many.limit(1).selectExpr("-1L AS event_id", "ts + INTERVAL 5 DAYS AS ts", "user_id", "event_type", "value", "props")
    folder = shared_path(spark, "large-window")
    many.write.parquet(folder)
    last.write.mode("append").parquet(folder)
    counts = append_all(stream.stream_latency_counts(
        event_stream(spark, folder), ntz(AS_OF), "1 day", "1 hour"), out)
    found = stream.stream_latency_tumbling(counts).where("n > 1")
    batch = ev.latency_tumbling(ev.event_latency(many, ntz(AS_OF)), "1 day")
    quantiles = ["period_start", "n", "p50", "p75", "p95", "p98", "p99", "p999"]
    assert same(found.select(quantiles), batch.select(quantiles))


def test_late_rows_are_left_out(spark, events, out):
    """A row of the first day that arrives after the watermark has passed it."""
    folder = shared_path(spark, "late-input")
    late = events.where("event_id = 0")
    write_slice(events, folder, 1, 700)
    for low, high in ((700, 1000), (0, 1)):
        counts = stream.stream_latency_counts(event_stream(spark, folder), ntz(AS_OF), "1 day", "1 hour")
        start_append(counts, out).awaitTermination()
        write_slice(events, folder, low, high)
    start_append(counts, out).awaitTermination()
    first = stream.stream_latency_tumbling(stored(counts, out)).orderBy("period_start").first()
    day = events.where("ts < '2024-01-02'").count()
    assert first.n == day - 1 and late.count() == 1


def test_time_zone_must_be_utc(source, zone):
    zone("America/New_York")
    with pytest.raises(ValueError, match="UTC"):
        stream.stream_latency(source)


def test_routing(spark, events, source, out):
    registry = spark.createDataFrame(
        [("click", "Old", 0, "greet", ["string"]), ("click", "C", 1, "greet", ["string"]),
         ("view", "V", 1, "greet", None), ("view", "V", 1, "part", ["string"])], REGISTRY)
    request = {"service": F.when(F.col("event_id") % 9 > 0, F.col("event_type")), "method": F.lit("greet"),
               "param_types": F.array(F.lit("string")), "args": F.array(F.col("user_id").cast("string"))}
    bodies = {"C": F.concat(F.lit("hello "), F.get("args", F.lit(0)))}
    routed = append_all(stream.stream_routing(source.withColumns(request), registry, bodies), out)
    batch = routing.route_requests(events.withColumns(request), registry, bodies)
    assert same(routed, batch)
    assert batch.where("impl IS NULL AND error IS NULL").isEmpty()
    assert {r.error for r in batch.where("service IS NULL OR service = 'view'").select("error").collect()} == {
        "null not found", "view.greet(string) not found"}
    assert {r.impl for r in batch.where("service = 'click'").collect()} == {"C"}
    lost = routing.dead_letters(events.withColumns(request), registry)
    assert lost.count() == batch.where("error IS NOT NULL").count()
    summary = routing.dispatch_summary(batch, ["service"], "user_id")
    assert summary.agg(F.sum("n_failed")).first()[0] == lost.count()


def test_log_etl(spark, events, out):
    level = F.when(F.col("event_type") == "error", "ERROR").otherwise("DEBUG")
    entries = events.select("ts", level.alias("level"), F.col("event_type").alias("logger"),
                            F.col("props").alias("message"))
    lines = shared_path(spark, "log-lines")
    rendered = logs.log_render(entries).select("text")
    rendered.union(spark.createDataFrame([("not a log line",)], "text STRING")).write.text(lines)
    kept = append_all(stream.stream_log_etl(spark, lines), out, ("log_date",))
    batch = logs.with_log_date(logs.log_level_filter(logs.log_parse(rendered, "text")))
    assert same(kept.drop("raw"), batch.drop("raw"))
    rejected = append_all(stream.stream_log_rejects(spark, lines), f"{out}-rejected")
    assert rows(rejected) == [("not a log line",)]
    assert len(rows(kept.select("log_date").distinct())) > 20


def test_periodic_report_is_emitted_by_the_clock(spark, events, source, out):
    """Reports go on a second apart when all events have been read."""
    log = stream.with_clock(source)
    query = stream.periodic_report(stream.latency_counts(log, ntz(AS_OF)), out, "1 second")
    try:
        end = time.time() + 90
        while time.time() < end and (newest_complete(spark, out) or 0) < 8:
            time.sleep(0.5)
        progress = [p for p in query.recentProgress if p.batchId >= 5]
    finally:
        query.stop()
    starts = [datetime.fromisoformat(p.timestamp) for p in progress]
    assert len(starts) > 2 and all(b - a >= timedelta(seconds=0.9) for a, b in zip(starts, starts[1:]))
    report = stored_complete(stream.latency_report_schema(), spark, out).first()
    batch = ev.latency_summary(ev.event_latency(events, ntz(AS_OF))).first()
    assert (report.n, report.p50, report.p999) == (events.count(), batch.p50, batch.p999)


def test_readers_see_whole_results_only(spark, events, source, out):
    counts = complete_all(stream.stream_counts(source, ["user_id"]), out)
    newest = newest_complete(spark, out)
    counts.limit(1).write.parquet(f"{out}/rows/batch_id={newest + 1}")  # a result that was never finished
    assert same(stored_complete(counts.schema, spark, out), events.groupBy("user_id").agg(F.count("*").alias("n")))
    assert stored_complete(counts.schema, spark, f"{out}-none").collect() == []


def test_an_empty_result_replaces_the_one_before(spark, source, out):
    """A result that filters everything out is the current one, however full the one before was."""
    few = stream.stream_counts(source, ["user_id"])
    start_complete(few, out, finish=lambda df: df.where(F.col("n") < 5)).awaitTermination()
    found = stored_complete(few.schema, spark, out)
    assert found.isEmpty() and found.columns == ["user_id", "n"]


def two_streams(spark, low, high, folders):
    """Ten-minute orders and what came of them 0 to 5 days later, or a day before, in time order."""
    hour = lambda h: F.expr(f"TIMESTAMP_NTZ'2024-01-01 00:00:00' + make_dt_interval(0, 0, 10 * ({h}))")
    orders = spark.range(low, high).select("id", (F.col("id") % 3).alias("k"), hour("id").alias("made"))
    gone = spark.range(low, high).select((F.col("id") - F.col("id") * 37 % 900 + 150).alias("of"), hour("id").alias("at"))
    orders.coalesce(1).write.mode("append").parquet(folders[0])
    gone.coalesce(1).write.mode("append").parquet(folders[1])


def test_replay_of_two_streams(spark, out):
    folders = [shared_path(spark, "made"), shared_path(spark, "gone")]
    totals = []

    def run():
        made = spark.readStream.schema("id BIGINT, k BIGINT, made TIMESTAMP_NTZ").parquet(folders[0])
        gone = spark.readStream.schema("of BIGINT, at TIMESTAMP_NTZ").parquet(folders[1])
        met = stream.stream_replay(made, gone, ("id", "of"), "made", "at", ["k"], "1 day", "3 days", "1 hour")
        query = start_append(met, out)
        query.awaitTermination()
        totals.append([p.stateOperators[0].numRowsTotal for p in query.recentProgress][-1])
        dropped = sum(p.stateOperators[0].numRowsDroppedByWatermark for p in query.recentProgress)
        return stored(met, out), dropped

    for low in range(0, 6000, 1000):
        two_streams(spark, low, low + 1000, folders)
        found, dropped = run()
        assert dropped == 0
    made, gone = (spark.read.parquet(f) for f in folders)
    batch = made.join(gone, F.expr("id = of AND at >= made - INTERVAL 1 DAY AND at <= made + INTERVAL 3 DAYS")).select(
        "k", F.date_diff("at", "made").alias("days"))
    assert same(found.groupBy("k", "days").count(), batch.groupBy("k", "days").count()) and batch.count() > 1000
    # Twelve thousand rows came in; only those that the next days can still meet are held.
    assert max(totals) < 4500
    two_streams(spark, 0, 50, folders)
    after, dropped = run()
    assert dropped == 100 and after.count() == found.count()


def test_replay_clears_state_with_the_next_rows(spark, out):
    """One micro-batch a run, none that only clears state, and the same rows as a batch join over several runs."""
    folders = [shared_path(spark, "made"), shared_path(spark, "gone")]
    for low in range(0, 4000, 1000):
        two_streams(spark, low, low + 1000, folders)
        made = spark.readStream.schema("id BIGINT, k BIGINT, made TIMESTAMP_NTZ").parquet(folders[0])
        gone = spark.readStream.schema("of BIGINT, at TIMESTAMP_NTZ").parquet(folders[1])
        met = stream.stream_replay(made, gone, ("id", "of"), "made", "at", ["k"], "1 day", "3 days", "1 hour")
        found = append_all(met, out, last_clearing=False)
    assert spark.read.format("binaryFile").load(f"{out}/progress/commits").count() == 4
    made, gone = (spark.read.parquet(f) for f in folders)
    batch = made.join(gone, F.expr("id = of AND at >= made - INTERVAL 1 DAY AND at <= made + INTERVAL 3 DAYS"))
    assert same(found.groupBy("k", "days").count(), batch.groupBy("k", F.date_diff("at", "made").alias("days")).count())
    assert spark.conf.get("spark.sql.streaming.noDataMicroBatches.enabled") == "true"


@pytest.fixture
def state_in_memory(spark):
    """A session with Spark's own choice of a state store, which keeps all state in executors' memory."""
    before = {name: spark.conf.get(name, None) for name in JOIN_STATE}
    for name in JOIN_STATE:
        spark.conf.unset(name)
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", IN_MEMORY)
    yield
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


IN_MEMORY = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"


def state_files(spark, path):
    """What the state of a query below ``path`` lies in, by its place below the state of a task."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(f"{path}/progress/state/0")
    return [r.path.split("/progress/state/0/")[1] for r in found.select("path").collect()]


def test_replay_query_keeps_state_on_disk(spark, state_in_memory, monkeypatch):
    """Whatever store the session names; every row of a first run is held, so memory would grow with the tables."""
    from checks import queries

    used = []
    monkeypatch.setattr(queries, "shared_path", lambda *given: used.append(shared_path(*given)) or used[-1])
    found = queries.QUERIES["stream_replay_latency"](spark, SMALL)
    met = table(spark, SMALL, "orders").join(table(spark, SMALL, "lineitem"), F.expr(
        "o_orderkey = l_orderkey AND l_shipdate >= o_orderdate - INTERVAL 30 DAYS"
        " AND l_shipdate <= o_orderdate + INTERVAL 120 DAYS"))
    assert rows(found, "o_orderpriority", "n") == rows(
        met.groupBy("o_orderpriority").agg(F.count("*").alias("n")), "o_orderpriority", "n")
    files = state_files(spark, used[0])
    assert any(f.endswith(".sst") for f in files) and not any(f.endswith(".delta") for f in files)
    # One store per task, not one for each of two tables of both sides.
    assert not any("keyWithIndexToValue" in f for f in files)
    # The session is as it was.
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") == IN_MEMORY
    assert all(spark.conf.get(name, None) is None for name in JOIN_STATE if "rocksdb" in name)


def test_replay_goes_on_from_state_on_disk(spark, out, state_in_memory):
    """Several runs, each from the state of the one before, give the rows of a batch join; late rows are dropped."""
    folders = [shared_path(spark, "made"), shared_path(spark, "gone")]

    def run():
        made = spark.readStream.schema("id BIGINT, k BIGINT, made TIMESTAMP_NTZ").parquet(folders[0])
        gone = spark.readStream.schema("of BIGINT, at TIMESTAMP_NTZ").parquet(folders[1])
        met = stream.stream_replay(made, gone, ("id", "of"), "made", "at", ["k"], "1 day", "3 days", "1 hour")
        return append_all(met, out, last_clearing=False, state=JOIN_STATE)

    for low in range(0, 4000, 1000):
        two_streams(spark, low, low + 1000, folders)
        found = run()
    made, gone = (spark.read.parquet(f) for f in folders)
    batch = made.join(gone, F.expr("id = of AND at >= made - INTERVAL 1 DAY AND at <= made + INTERVAL 3 DAYS"))
    days = batch.groupBy("k", F.date_diff("at", "made").alias("days")).count()
    assert same(found.groupBy("k", "days").count(), days) and batch.count() > 1000
    two_streams(spark, 0, 50, folders)
    run()  # the run before made the watermark that these are behind, this one drops them
    two_streams(spark, 0, 50, folders)
    assert run().count() == found.count() == batch.count()


def test_schema_is_fixed(source):
    assert source.sparkSession.createDataFrame([], EVENTS).schema == source.schema
