"""Every operator applied to whole driver tables: name -> (spark, folder) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from queuelens.functions.times import millis_between_instants, ntz
from queuelens.operators import (
    allocation, buffers, counting, events as ev, logs, measures, ordering, routing, triggers, uris,
)
from queuelens.plans.hotkeys import HOT_ROWS
from queuelens.session import shared_path
from queuelens.sources.schemas import TABLES
from queuelens.sources.tables import (
    event_source, event_stream, load_uri, storage_report, table, table_stream,
)
from queuelens.streaming import buffers as stream_buffers, operators as stream
from queuelens.streaming.sinks import JOIN_STATE, append_all, complete_all, stored_complete, upsert_all

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

AS_OF = "2024-02-01 00:00:00"
ORDER = ["ts", "event_id"]
CAPACITY = 3
ALPHA_PER_HOUR = 0.015
REGISTERED = """
SELECT * FROM VALUES
    ('click', 'ClickImpl', 1, 'greet', array('string')),
    ('view', 'OldViewImpl', 2, 'greet', array('string')),
    ('view', 'OldViewImpl', 2, 'part', array('string')),
    ('view', 'ViewImpl', 3, 'greet', array('string')),
    ('purchase', 'PurchaseImpl', 4, 'greet', array('string')),
    ('purchase', 'PurchaseImpl', 4, 'greet', array('string', 'int'))
    AS registry(service, impl, seq, method, param_types)
"""
# A registration every five days, the first on the third of January.
REGISTERED_AT = "TIMESTAMP_NTZ'2024-01-03 12:00:00' + make_dt_interval(5 * (seq - 1))"
SCHEMES = """
SELECT * FROM VALUES
    ('file', 'LocalFileSystem', 1), ('hdfs', 'DistributedFileSystem', 2),
    ('https', 'OldWebFileSystem', 3), ('https', 'WebFileSystem', 4)
    AS registry(scheme, file_system, seq)
"""
SPLIT_COLUMNS = ["page_id", "scheme", "authority", "path", "path_quoted"]


def query(fn: Query) -> Query:
    QUERIES[fn.__name__.removesuffix("_")] = fn
    return fn


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


def rounded_snapshot(df: DataFrame) -> DataFrame:
    return rounded(df, 3, "mean", "stddev", "p50", "p75", "p95", "p98", "p99", "p999")


def rounded_cumulative(df: DataFrame) -> DataFrame:
    return rounded(rounded(df, 2, "mean", "stddev"), 3, "p50", "p75", "p95", "p98", "p99", "p999")


def events(spark: SparkSession, sf: str) -> DataFrame:
    return event_source(spark, f"{sf}/events.parquet")


def latencies(spark: SparkSession, sf: str) -> DataFrame:
    return ev.event_latency(events(spark, sf), ntz(AS_OF))


def events_streamed(spark: SparkSession, sf: str) -> DataFrame:
    return event_stream(spark, f"{sf}/events*.parquet")


# Event stream and latency


@query
def event_source_(spark, sf):
    return events(spark, sf)



@query
def event_map(spark, sf):
    cents = F.round(F.col("value") * 100).cast("bigint")
    return ev.event_map(events(spark, sf), {"value_cents": cents}).select("event_id", "value_cents")


@query
def event_map_pandas(spark, sf):
    """The same by user code over batches of events."""
    narrow = events(spark, sf).select("event_id", "value")
    cents = lambda rows: rows.assign(value_cents=rows.value.mul(100).round().astype("int64"))[
        ["event_id", "value_cents"]]
    return ev.event_map_pandas(narrow, cents, "event_id BIGINT, value_cents BIGINT")


@query
def event_latency(spark, sf):
    return latencies(spark, sf).select("event_id", "latency_ms")


@query
def latency_summary(spark, sf):
    return rounded_snapshot(ev.latency_summary(latencies(spark, sf)))


@query
def latency_by_client(spark, sf):
    return rounded_snapshot(ev.latency_by_client(latencies(spark, sf)))


@query
def latency_buckets(spark, sf):
    return ev.latency_buckets(events(spark, sf), "value", 10)


@query
def latency_tumbling(spark, sf):
    return rounded_snapshot(ev.latency_tumbling(latencies(spark, sf), "1 day"))


@query
def latency_cumulative(spark, sf):
    return rounded_cumulative(ev.latency_cumulative(latencies(spark, sf), "1 day"))


def weekdays(spark: SparkSession, sf: str) -> DataFrame:
    """Events of working days only, so that whole days pass without one."""
    return latencies(spark, sf).where(F.weekday("ts") < 5)


@query
def quiet_tumbling(spark, sf):
    return rounded_snapshot(ev.latency_tumbling(weekdays(spark, sf), "6 hours"))


@query
def quiet_cumulative(spark, sf):
    return rounded_cumulative(ev.latency_cumulative(weekdays(spark, sf), "6 hours"))


@query
def latency_decayed(spark, sf):
    decayed = ev.latency_decayed(events(spark, sf), ["event_type"], "value", ALPHA_PER_HOUR)
    return rounded(decayed, 6, "weight", "mean", "stddev")


def reservoir(spark: SparkSession, sf: str) -> DataFrame:
    return ev.decaying_reservoir(events(spark, sf), ["event_type"], "value", ALPHA_PER_HOUR)


@query
def decaying_reservoir(spark, sf):
    return rounded(reservoir(spark, sf), 6, "weight")


@query
def reservoir_snapshot(spark, sf):
    return rounded(ev.reservoir_snapshot(reservoir(spark, sf), ["event_type"], "value"), 6, "mean", "stddev")


@query
def latency_decayed_quantile(spark, sf):
    return ev.latency_decayed_quantile(
        events(spark, sf), ["event_type"], "value", 10, ALPHA_PER_HOUR
    )


@query
def replay_latency(spark, sf):
    replayed = ev.replay_latency(
        table(spark, sf, "orders"), table(spark, sf, "lineitem"), ("o_orderkey", "l_orderkey"),
        "o_orderdate", "l_shipdate", ["o_orderpriority"],
    )
    return rounded_snapshot(replayed)


@query
def keyed_lanes(spark, sf):
    return ev.keyed_lanes(events(spark, sf), "user_id", 10)


@query
def event_distinct(spark, sf):
    rows = events(spark, sf)
    return ev.event_distinct(rows.unionAll(rows.where("event_id % 10 = 0")))


# Counting


@query
def total_count(spark, sf):
    return counting.total_count(events(spark, sf), ["event_type"])


@query
def running_count(spark, sf):
    rows = events(spark, sf).select("event_id", "ts")
    return counting.running_count(rows, ORDER).select("event_id", "running_count")


@query
def count_reconcile(spark, sf):
    documents = table(spark, sf, "documents").select("doc_id", "source")
    labelled = table(spark, sf, "labels").select("doc_id").join(documents, "doc_id")
    return counting.count_reconcile(documents, labelled, ["source"])


# Bounded buffer: views put, clicks get, one buffer per user


def buffer_rows(spark: SparkSession, sf: str) -> DataFrame:
    rows = events(spark, sf).select("event_id", "ts", "user_id", "event_type")
    return buffers.buffer_log(rows, "event_type", "view", "click")


@query
def fifo_match(spark, sf):
    return buffers.fifo_match(buffer_rows(spark, sf), ["user_id"])


@query
def buffer_wait(spark, sf):
    pairs = buffers.fifo_match(buffer_rows(spark, sf), ["user_id"])
    return buffers.buffer_wait(pairs).select(
        "user_id", "n", "completed_at", "consumer_wait_ms", "dwell_ms"
    )


@query
def buffer_state(spark, sf):
    return buffers.buffer_state(buffer_rows(spark, sf), ["user_id"], CAPACITY).select(
        "event_id", "user_id", "op", "stored", "blocked_producers", "waiting_consumers"
    )


@query
def blocked_puts(spark, sf):
    return buffers.blocked_puts(buffer_rows(spark, sf), ["user_id"], CAPACITY)


@query
def buffer_saturation(spark, sf):
    state = buffers.buffer_state(buffer_rows(spark, sf), ["user_id"], CAPACITY)
    saturation = buffers.buffer_saturation(state, ["user_id"], CAPACITY)
    return rounded(saturation, 6, "full_share", "empty_share", "blocked_share")


@query
def buffer_leftover(spark, sf):
    return buffers.buffer_leftover(buffer_rows(spark, sf), ["user_id"], CAPACITY)


# Allocation of limited stock: purchases against a daily pool


def purchases(spark: SparkSession, sf: str) -> DataFrame:
    rows = events(spark, sf).where("event_type = 'purchase'")
    return rows.select("event_id", "ts", F.to_date("ts").alias("day"))


@query
def allocate_fcfs(spark, sf):
    granted = allocation.allocate_fcfs(purchases(spark, sf), ["day"], ORDER, 50)
    return granted.select("event_id", "day", "granted")


@query
def granted_requests(spark, sf):
    granted = allocation.granted_requests(purchases(spark, sf), ["day"], ORDER, 50)
    return granted.select("event_id", "day", "turn")


@query
def allocate_quantity(spark, sf):
    quantity = F.col("event_id") % 3 + 1
    granted = allocation.allocate_quantity(purchases(spark, sf), ["day"], ORDER, quantity, 100)
    return granted.select("event_id", "day", "requested", "granted")


@query
def assign_round_robin(spark, sf):
    assigned = allocation.assign_round_robin(purchases(spark, sf), ORDER, 10)
    return assigned.select("event_id", "seller")


@query
def sales_tally(spark, sf):
    return allocation.sales_tally(allocation.assign_round_robin(purchases(spark, sf), ORDER, 10))


def order_audit(spark: SparkSession, sf: str) -> DataFrame:
    sales = table(spark, sf, "lineitem").where("l_linenumber = 1")
    return allocation.exactly_once_audit(
        table(spark, sf, "orders"), sales, "o_orderkey", "l_orderkey"
    )


@query
def exactly_once_audit(spark, sf):
    return order_audit(spark, sf)


@query
def audit_summary(spark, sf):
    return allocation.audit_summary(order_audit(spark, sf))


# Threshold triggers


@query
def nth_event(spark, sf):
    return triggers.nth_event(events(spark, sf), ["user_id"], ORDER, 5)


@query
def threshold_gate(spark, sf):
    return triggers.threshold_gate(events(spark, sf), ["user_id"], ORDER, 5)


@query
def gate_delay(spark, sf):
    return triggers.gate_delay(events(spark, sf), ["user_id"], "ts", "event_id", 5)


# Lock order, fair turns, latest value


def edges(spark: SparkSession, sf: str) -> DataFrame:
    return ordering.lock_order_edges(events(spark, sf), ["user_id"], ORDER, "event_type")


@query
def lock_order_edges(spark, sf):
    return edges(spark, sf)


@query
def lock_order_inversion(spark, sf):
    return ordering.lock_order_inversion(edges(spark, sf))


@query
def lock_order_cycles(spark, sf):
    """Cycles among the orders in which days' events follow each other."""
    by_day = events(spark, sf).withColumns({
        "day": F.to_date("ts"), "resource": F.concat_ws("-", "event_type", (F.col("user_id") % 4).cast("string"))})
    return ordering.lock_order_cycles(
        ordering.lock_order_edges(by_day, ["day"], ORDER, "resource").where("held < wanted OR n % 5 = 0"))


@query
def fair_interleave(spark, sf):
    documents = table(spark, sf, "documents").select("doc_id", "source")
    return ordering.fair_interleave(documents, ["source"], ["doc_id"])


@query
def fair_quota(spark, sf):
    documents = table(spark, sf, "documents").select("doc_id", "source")
    return ordering.fair_quota(documents, ["source"], ["doc_id"], 10)


@query
def latest_per_key(spark, sf):
    return ordering.latest_per_key(
        table(spark, sf, "customer"), events(spark, sf), "c_custkey", "user_id",
        F.col("event_type"), ORDER, default="unset",
    )


# Measures and stages


@query
def stacked_adjustment(spark, sf):
    adjusted = measures.stacked_adjustment(
        table(spark, sf, "part"), ["p_type"], F.col("p_retailprice"), [2], {"second": 5}
    )
    return rounded(adjusted, 2, "base_total", "adjusted_total")


@query
def instrumented_stage(spark, sf):
    return measures.instrumented_stage(events(spark, sf), ["event_type"], F.col("value") > 10)


@query
def observed_stage(spark, sf):
    """Rows before and after a stage, as counted while its result was written."""
    kept, before, after = measures.observed_stage(events(spark, sf), lambda df: df.where("value > 10"))
    kept.write.parquet(shared_path(spark, "observed_stage"))
    return spark.createDataFrame([(before.get["rows"], after.get["rows"])], "rows_before BIGINT, rows_after BIGINT")


# Request routing: event types are the services, a user is the caller


def registry(spark: SparkSession) -> DataFrame:
    return spark.sql(REGISTERED)


def bodies() -> dict[str, Column]:
    """What each implementation answers to the first argument."""
    greeting = F.concat(F.lit(routing.GREETING), F.get("args", F.lit(0)))
    return {
        "ClickImpl": greeting,
        "ViewImpl": F.concat(greeting, F.lit(", have a look")),
        "PurchaseImpl": F.concat(greeting, F.lit(", thank you")),
    }


ANSWER = ["event_id", "user_id", "service", "method", "impl", "result", "error"]


def requests_of(log: DataFrame) -> DataFrame:
    """Events as requests; some name no service, a method or parameters that are not there."""
    number = F.col("event_id")
    one, two = F.array(F.lit("string")), F.array(F.lit("string"), F.lit("int"))
    return log.select(
        "event_id", "user_id",
        F.when(number % 97 != 0, F.col("event_type")).alias("service"),
        F.when(number % 11 == 0, "part").otherwise("greet").alias("method"),
        F.when(number % 13 == 0, two).otherwise(one).alias("param_types"),
        F.array(F.col("user_id").cast("string")).alias("args"))


def routed(spark: SparkSession, sf: str) -> DataFrame:
    return routing.route_requests(requests_of(events(spark, sf)), registry(spark), bodies())


@query
def route_requests(spark, sf):
    return routed(spark, sf).select(ANSWER)


@query
def route_requests_as_of(spark, sf):
    """Requests answered by what was registered when they came."""
    log = events(spark, sf)
    requests = requests_of(log).join(log.select("event_id", "ts"), "event_id")
    registry_log = registry(spark).withColumn("registered_at", F.expr(REGISTERED_AT))
    answered = routing.route_requests_as_of(requests, registry_log, bodies() | {"OldViewImpl": F.lit("wait")})
    return answered.select(ANSWER)


@query
def dead_letters(spark, sf):
    lost = routing.dead_letters(requests_of(events(spark, sf)), registry(spark))
    return lost.select("event_id", "service", "method", "error")


@query
def dispatch_summary(spark, sf):
    return routing.dispatch_summary(routed(spark, sf), ["service"], "user_id")


# Addresses and storage


def pages(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "pages").select("page_id", "url")


@query
def uri_split(spark, sf):
    return uris.uri_split(pages(spark, sf)).select(*SPLIT_COLUMNS)


@query
def authority_rollup(spark, sf):
    return uris.authority_rollup(pages(spark, sf))


@query
def scheme_route(spark, sf):
    return uris.scheme_route(pages(spark, sf), spark.sql(SCHEMES)).select("page_id", "scheme", "file_system")


@query
def load_uri_(spark, sf):
    folder = sf if ":/" in sf else f"file:{sf}"
    return load_uri(spark, f"{folder}/nation.parquet")



@query
def load_uri_events(spark, sf):
    """A table that grows, by its address."""
    folder = sf if ":/" in sf else f"file:{sf}"
    return load_uri(spark, f"{folder}/events.parquet")


@query
def clean_container_path(spark, sf):
    wrapped = pages(spark, sf).withColumn("entry", F.concat(F.lit("file:"), "url", F.lit("!/x")))
    return uris.clean_container_path(wrapped, "entry").select("page_id", "container")


@query
def storage_report_(spark, sf):
    report = storage_report(spark, sf, [f"{name}.parquet" for name in TABLES])
    return report.select("dataset", "files", "n_rows")



# Logs: the event type is the logger and sets the level


def log_rows(spark: SparkSession, sf: str) -> DataFrame:
    kind = F.col("event_type")
    level = F.when(kind == "error", "ERROR").when(kind == "view", "DEBUG").otherwise("INFO")
    return events(spark, sf).select(
        "event_id", "ts", level.alias("level"), kind.alias("logger"),
        F.col("props").alias("message"),
    )


def log_lines(spark: SparkSession, sf: str) -> DataFrame:
    line = (F.col("event_id") % 100).cast("int")
    return logs.log_render(log_rows(spark, sf), "file", line)


@query
def log_render(spark, sf):
    stdout = logs.log_render(log_rows(spark, sf)).withColumnRenamed("text", "stdout_line")
    line = (F.col("event_id") % 100).cast("int")
    both = logs.log_render(stdout, "file", line).withColumnRenamed("text", "file_line")
    return both.select("event_id", "stdout_line", "file_line")


@query
def log_parse(spark, sf):
    lines = log_lines(spark, sf).select("event_id", F.col("text").alias("value"))
    return logs.log_parse(lines)


@query
def log_level_filter(spark, sf):
    return logs.log_level_filter(log_rows(spark, sf)).select("event_id", "level", "logger")


@query
def log_daily_roll(spark, sf):
    path = shared_path(spark, "log_daily_roll")
    lines = log_lines(spark, sf).select("ts", "text")
    logs.log_daily_roll(lines, path)
    rolled = spark.read.schema("ts TIMESTAMP_NTZ, text STRING, log_date DATE").parquet(path)
    return rolled.select("log_date", "text")


@query
def log_level_daily(spark, sf):
    return logs.log_level_daily(log_rows(spark, sf))


# Structured Streaming


@query
def stream_events(spark, sf):
    return append_all(events_streamed(spark, sf), shared_path(spark, "stream_events"))


@query
def stream_latency(spark, sf):
    """Whether each latency lies between the clock before and after the run."""
    clock = lambda: F.lit(datetime.now(timezone.utc))
    before = F.date_trunc("millisecond", clock())
    timed = stream.stream_latency(events_streamed(spark, sf)).select("event_id", "ts", "latency_ms")
    seen = append_all(timed, shared_path(spark, "stream_latency"))
    low, high = (millis_between_instants(F.col("ts"), t) for t in (before, clock()))
    return seen.select("event_id", F.col("latency_ms").between(low, high).alias("in_range"))


@query
def stream_latency_tumbling(spark, sf):
    counts = stream.stream_latency_counts(events_streamed(spark, sf), ntz(AS_OF), "1 day", "1 hour")
    emitted = append_all(counts, shared_path(spark, "stream_latency_tumbling"))
    return rounded_snapshot(stream.stream_latency_tumbling(emitted))


@query
def stream_counts(spark, sf):
    counts = stream.stream_counts(events_streamed(spark, sf), ["user_id"])
    return complete_all(counts, shared_path(spark, "stream_counts"))


@query
def stream_distinct(spark, sf):
    kept = stream.stream_distinct(events_streamed(spark, sf), "event_id", "1 hour")
    return append_all(kept, shared_path(spark, "stream_distinct"))


@query
def stream_nth_event(spark, sf):
    reached = stream.stream_nth_event(events_streamed(spark, sf), ["user_id"], 5)
    return append_all(reached, shared_path(spark, "stream_nth_event"))


def positions_streamed(spark: SparkSession, sf: str, label: str) -> DataFrame:
    """Views and clicks of all closed days, with the puts and gets of their user so far."""
    log = buffers.buffer_log(events_streamed(spark, sf), "event_type", put="view", get="click")
    placed = stream_buffers.stream_positions(log, ["user_id"], "1 day", "1 hour")
    return stream_buffers.positions(append_all(placed, shared_path(spark, label)), ["user_id"])


@query
def stream_buffer_state(spark, sf):
    state = buffers.state_at(positions_streamed(spark, sf, "stream_buffer_state"), CAPACITY)
    return state.select("event_id", "user_id", "op", "stored", "blocked_producers", "waiting_consumers")


@query
def stream_blocked_puts(spark, sf):
    return buffers.blocked_at(positions_streamed(spark, sf, "stream_blocked_puts"), ["user_id"], CAPACITY)


@query
def stream_latest_per_key(spark, sf):
    """The last event type of each user, from a table that every micro-batch upserts."""
    sets = events_streamed(spark, sf).select("user_id", "event_type", *ORDER)
    table_of_sets = upsert_all(sets, shared_path(spark, "stream_latest_per_key"), ["user_id"], ORDER)
    return ordering.latest_per_key(
        table(spark, sf, "customer"), table_of_sets, "c_custkey", "user_id", F.col("event_type"), ORDER,
        default="unset")


@query
def stream_replay_latency(spark, sf):
    days = stream.stream_replay(
        table_stream(spark, sf, "orders"), table_stream(spark, sf, "lineitem"), ("o_orderkey", "l_orderkey"),
        "o_orderdate", "l_shipdate", ["o_orderpriority"], "30 days", "120 days", "1 day")
    met = append_all(days, shared_path(spark, "stream_replay"), last_clearing=False, state=JOIN_STATE)
    return rounded_snapshot(ev.replay_summary(met, ["o_orderpriority"]))


@query
def stream_routing(spark, sf):
    requests = requests_of(events_streamed(spark, sf))
    answered = stream.stream_routing(requests, registry(spark), bodies()).select(ANSWER)
    return append_all(answered, shared_path(spark, "stream_routing"))


@query
def stream_log_etl(spark, sf):
    """Rows per day and level; lines that are none (the text of errors) count without a day."""
    folder = shared_path(spark, "stream_log_lines")
    traces = events(spark, sf).where("event_type = 'error'").select(F.concat(F.lit("  at "), "props"))
    log_lines(spark, sf).select("text").union(traces).write.text(folder)
    path = shared_path(spark, "stream_log_etl")
    written = append_all(stream.stream_log_etl(spark, folder), path, ("log_date",))
    rejected = append_all(stream.stream_log_rejects(spark, folder), f"{path}-rejected")
    lost = rejected.agg(F.count("*").alias("n")).select(
        F.lit(None).cast("date").alias("log_date"), F.lit(None).cast("string").alias("level"), "n")
    return written.groupBy("log_date", "level").agg(F.count("*").alias("n")).union(lost)


@query
def periodic_report(spark, sf):
    path = shared_path(spark, "periodic_report")
    counts = stream.latency_counts(events_streamed(spark, sf), ntz(AS_OF))
    stream.periodic_report(counts, path, period=None).awaitTermination()
    return rounded_snapshot(stored_complete(stream.latency_report_schema(), spark, path))


# The same operators with few rows allowed per key, so that large keys are split.
HOT = ("latency_by_client", "latency_tumbling", "buffer_state", "fifo_match", "lock_order_edges")
SPLIT_ABOVE = 200


def split_keys(plain: Query) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        before = spark.conf.get(HOT_ROWS, None)
        spark.conf.set(HOT_ROWS, SPLIT_ABOVE)
        try:
            return plain(spark, sf)
        finally:
            spark.conf.set(HOT_ROWS, before) if before else spark.conf.unset(HOT_ROWS)

    return run


QUERIES.update({f"hot_{name}": split_keys(QUERIES[name]) for name in HOT})
