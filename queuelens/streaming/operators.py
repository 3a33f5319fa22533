"""Structured Streaming forms of the batch operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from queuelens.functions.times import millis_between_instants
from queuelens.operators.events import event_latency
from queuelens.operators.logs import log_level_filter, log_parse, unparsed, with_log_date
from queuelens.operators.routing import route_requests
from queuelens.plans.snapshots import COUNT, QUANTILES, snapshot_of_counts
from queuelens.session import keep_state_on_disk, require_utc
from queuelens.streaming.sinks import REPORT_PERIOD, start_complete


def _as_instant(df: DataFrame, ts: str) -> DataFrame:
    """Watermarks need instants; the cast is exact in UTC only."""
    require_utc(df.sparkSession)
    return df.withColumn(ts, F.col(ts).cast("timestamp"))


def stream_latency(events: DataFrame, created: str = "ts") -> DataFrame:
    """Milliseconds from creation to the processing time of the micro-batch."""
    rows = _as_instant(events, created)
    return rows.withColumn(
        "latency_ms", millis_between_instants(F.col(created), F.current_timestamp())
    )


def stream_latency_counts(events: DataFrame, as_of: Column, period: str, lateness: str,
                          ts: str = "ts") -> DataFrame:
    """Events per period and latency, emitted once the watermark has passed the period's end.

    The state holds distinct latencies with their counts, so that a snapshot of the
    emitted counts is exact however large a period is.
    """
    timed = _as_instant(event_latency(events, as_of, ts), ts).withWatermark(ts, lateness)
    counted = timed.groupBy(F.window(ts, period).alias("w"), "latency_ms").agg(
        F.count("*").alias(COUNT))
    return counted.select(
        F.col("w.start").cast("timestamp_ntz").alias("period_start"), "latency_ms", COUNT)


def stream_latency_tumbling(counts: DataFrame, quantiles: Mapping[str, float] = QUANTILES,
                            hot_rows: int | None = None) -> DataFrame:
    """Snapshot per closed period, from the counts that ``stream_latency_counts`` has emitted."""
    known = counts.where(F.col("latency_ms").isNotNull())
    return snapshot_of_counts(known, ["period_start"], "latency_ms", quantiles, hot_rows=hot_rows)


def stream_counts(events: DataFrame, key: Sequence[str]) -> DataFrame:
    """Running count per key, for update or complete mode."""
    return events.groupBy(*key).agg(F.count("*").alias("n"))


def stream_distinct(events: DataFrame, row_id: str, lateness: str, ts: str = "ts") -> DataFrame:
    """Events without repeated ids that arrive within ``lateness``."""
    timed = _as_instant(events, ts).withWatermark(ts, lateness)
    kept = timed.dropDuplicatesWithinWatermark([row_id])
    return kept.withColumn(ts, F.col(ts).cast(events.schema[ts].dataType))


# Parts that a key is counted in: one, as tasks pass on few rows of a key.
SALTS = 1
# Groups that the keys are dealt to.
LANES = 1024
# Rows that a task holds before it drops what cannot count.
HELD = 1 << 17
SEEN = "seen BIGINT"
# Keys travel as text, which keeps whole numbers next to nulls exact.
EXACT_TIMES = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
               "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "ignoreNullFields": "false"}
KEY, MICROS = "nth_key", "nth_micros"


def _first_of_each(n: int, row_id: str) -> Callable[[pa.Table], pa.Table]:
    """Takes the first ``n`` rows of every key, by time and id; rows of a key stay together.

    The function brings all it needs, as workers that plan a query lack this package.
    """

    def first(rows: pa.Table) -> pa.Table:
        coded = rows.append_column("code", rows[KEY].combine_chunks().dictionary_encode().indices)
        order = pc.sort_indices(coded, [("code", "ascending"), (MICROS, "ascending"), (row_id, "ascending")])
        code = coded["code"].take(order).to_numpy()
        begin = np.flatnonzero(np.diff(code, prepend=-1))
        place = np.arange(len(code)) - np.repeat(begin, np.diff(begin, append=len(code)))
        return rows.take(order.filter(pa.array(place < n)))

    return first


def _passing(n: int, row_id: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Drops rows of a task that come after ``n`` of their key, so that no group gets a hot key whole."""

    first_rows = _first_of_each(n, row_id)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) >= HELD:
                first = first_rows(pa.Table.from_batches(held))
                held = first.to_batches()
                if first.num_rows > HELD // 2:
                    yield from held
                    held = []
        if held:
            yield from first_rows(pa.Table.from_batches(held)).to_batches()

    return run


def _counter(n: int, row_id: str, out: StructType) -> StatefulProcessor:
    """Counts the rows of every key of a lane up to ``n`` and passes on the n-th."""
    columns, first_rows = out.fieldNames(), _first_of_each(n, row_id)

    class Counter(StatefulProcessor):
        def init(self, handle: StatefulProcessorHandle) -> None:
            self.seen = handle.getMapState("seen", f"{KEY} STRING", SEEN)

        def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
            held, size, limit = [], 0, HELD
            for frame in rows:
                held.append(pa.Table.from_pandas(frame[columns], preserve_index=False))
                size += len(frame)
                if size >= limit:
                    held = [first_rows(pa.concat_tables(held))]
                    size = held[0].num_rows
                    limit = max(HELD, 2 * size)
            first = first_rows(pa.concat_tables(held))
            found = pc.value_counts(first[KEY])  # in the order of the rows
            known, reached, begin = self.seen.exists(), [], 0
            for name, count in zip(found.field("values").to_pylist(), found.field("counts").to_pylist()):
                before = (self.seen.getValue((name,)) or (0,))[0] if known else 0
                if before < n:
                    self.seen.updateValue((name,), (min(n, before + count),))
                    if before + count >= n:
                        reached.append(begin + n - before - 1)
                begin += count
            yield first.take(pa.array(reached, pa.int64())).to_pandas()

        def close(self) -> None:
            pass

    return Counter()


def stream_nth_event(events: DataFrame, key: Sequence[str], n: int, row_id: str = "event_id",
                     ts: str = "ts") -> DataFrame:
    """The event at which the count of its key reaches ``n``, once per key, for append mode.

    Micro-batches count in arrival order, rows of one micro-batch in (ts, id) order; both
    must not be null. Every task first drops rows that come after ``n`` others of their key.
    The state is one count per key which stops at ``n``: what a trigger costs does not
    depend on earlier ones, and a key that has fired passes nothing on. Many keys share a
    group, as workers pay far more for a group than for a count.
    """
    key = list(key)
    keep_state_on_disk(events.sparkSession)
    rows = _as_instant(events, ts)
    as_text = F.to_json(F.struct(*key), EXACT_TIMES)
    narrow = rows.select(as_text.alias(KEY), F.unix_micros(ts).alias(MICROS), row_id)
    passed = narrow.mapInArrow(_passing(n, row_id), narrow.schema)
    lane = F.pmod(F.xxhash64(KEY), F.lit(LANES)).alias("nth_lane")
    reached = passed.select(lane, *narrow.columns).groupBy("nth_lane").transformWithStateInPandas(
        _counter(n, row_id, narrow.schema), narrow.schema, "append", "none")
    kinds = events.select(*key).schema
    back = F.from_json(KEY, kinds, EXACT_TIMES)
    time = F.timestamp_micros(MICROS).cast(events.schema[ts].dataType)
    return reached.select(back.alias("k"), time.alias(ts), row_id).select("k.*", ts, row_id)


def stream_replay(created: DataFrame, consumed: DataFrame, on: tuple[str, str], created_at: str, consumed_at: str,
                  key: Sequence[str], early: str, late: str, lateness: str) -> DataFrame:
    """Whole days from creation to consumption of rows that meet in two streams, for append mode.

    A consumption counts from ``early`` before the creation to ``late`` after it. Both streams may
    be late by ``lateness``; rows that are later are dropped and counted in the query's progress.
    A row leaves the state once the watermark of the other stream has passed all it could meet; before the
    first watermark all rows are held, so large inputs are to be started with ``sinks.JOIN_STATE``.
    """
    left = _as_instant(created, created_at).select(
        F.col(on[0]).alias("__id"), *key, F.col(created_at).alias("__from")).withWatermark("__from", lateness)
    right = _as_instant(consumed, consumed_at).select(
        F.col(on[1]).alias("__other"), F.col(consumed_at).alias("__to")).withWatermark("__to", lateness)
    meet = F.expr(f"__id = __other AND __to >= __from - INTERVAL {early} AND __to <= __from + INTERVAL {late}")
    return left.join(right, meet).select(*key, F.date_diff("__to", "__from").alias("days"))


def stream_routing(requests: DataFrame, registry: DataFrame,
                   bodies: Mapping[str, Column]) -> DataFrame:
    """Each request of the stream routed against the static registry."""
    return route_requests(requests, registry, bodies, broadcast=False)


def stream_log_lines(spark: SparkSession, folder: str,
                     files_per_trigger: int | None = None) -> DataFrame:
    """Log lines below ``folder``, parsed."""
    reader = spark.readStream
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return log_parse(reader.text(folder))


def stream_log_etl(spark: SparkSession, folder: str, root: str = "INFO",
                   loggers: Mapping[str, str] | None = None,
                   files_per_trigger: int | None = None) -> DataFrame:
    """Log lines below ``folder``, parsed, filtered by level and dated for partitioning.

    Lines that hold no log line have no level; ``stream_log_rejects`` has them.
    """
    parsed = stream_log_lines(spark, folder, files_per_trigger)
    return with_log_date(log_level_filter(parsed, root, loggers))


def stream_log_rejects(spark: SparkSession, folder: str,
                       files_per_trigger: int | None = None) -> DataFrame:
    """The text of all lines below ``folder`` that hold no log line, for a folder beside the rows."""
    return unparsed(stream_log_lines(spark, folder, files_per_trigger))


def with_clock(events: DataFrame, per_second: int = 1) -> DataFrame:
    """``events`` with rows of nulls that a clock adds, so that a quiet stream still has micro-batches.

    Only for queries with a period; a query over the available input would wait for the clock.
    """
    ticks = events.sparkSession.readStream.format("rate").option("rowsPerSecond", per_second).load()
    return events.unionByName(ticks.select(
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in events.schema]))


def latency_counts(events: DataFrame, as_of: Column, ts: str = "ts") -> DataFrame:
    """Events per latency over everything seen so far; a report is made of these."""
    return event_latency(events, as_of, ts).where(F.col("latency_ms").isNotNull()).groupBy(
        "latency_ms").agg(F.count("*").alias(COUNT))


def latency_report(counts: DataFrame) -> DataFrame:
    """One row: the whole histogram snapshot of the counted latencies."""
    return snapshot_of_counts(counts, [], "latency_ms")


def latency_report_schema() -> StructType:
    """The columns of a report."""
    doubles = [StructField(n, DoubleType()) for n in ("mean", "stddev", *QUANTILES)]
    return StructType([*(StructField(n, LongType()) for n in ("n", "min", "max")), *doubles])


def periodic_report(counts: DataFrame, path: str,
                    period: str | None = REPORT_PERIOD) -> StreamingQuery:
    """Write a report at a fixed wall-clock pace; ``None`` handles all input and stops.

    A pace needs counts of events ``with_clock``, or periods without an event have no report.
    """
    return start_complete(counts, path, period, finish=latency_report)
