"""Bounded first-in-first-out buffers, replayed from a log of puts and gets.

With operations admitted in log order, the n-th get takes the n-th item and the
n-th put waits for get n - capacity. So positions per key decide everything and
no replay of the log is needed. A full or empty buffer makes callers wait; it
never drops an item.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from queuelens.functions.times import millis_between_instants, millis_between_ntz
from queuelens.plans.ordered import running

PUT, GET = "put", "get"


def buffer_log(df: DataFrame, kind: str, put: str, get: str) -> DataFrame:
    """Rows of ``df`` that are puts or gets, marked in column ``op``."""
    op = F.when(F.col(kind) == put, F.lit(PUT)).when(F.col(kind) == get, F.lit(GET))
    return df.withColumn("op", op).where(F.col("op").isNotNull())


def _flag(op: str) -> Column:
    return F.when(F.col("op") == op, 1).otherwise(0).cast("bigint")


def _positions(log: DataFrame, key: list[str], order: list[str],
               hot_rows: int | None) -> DataFrame:
    """Puts and gets of the key up to and including each row."""
    return running(log, key, order,
                   {"puts": ("sum", _flag(PUT)), "gets": ("sum", _flag(GET))}, hot_rows=hot_rows)


def _millis(df: DataFrame, column: str, start: Column, end: Column) -> Column:
    zone_free = dict(df.dtypes)[column] == "timestamp_ntz"
    return millis_between_ntz(start, end) if zone_free else millis_between_instants(start, end)


def _pairs(log: DataFrame, key: list[str], ts: str, row_id: str, get_offset: int,
           hot_rows: int | None) -> DataFrame:
    """Put n next to get n - ``get_offset``, either side null when missing."""
    placed = _positions(log.select(*key, ts, row_id, "op"), key, [ts, row_id], hot_rows)
    return _pairs_at(placed, key, ts, row_id, get_offset)


def _pairs_at(placed: DataFrame, key: list[str], ts: str, row_id: str, get_offset: int) -> DataFrame:
    """The pairs of rows that know their positions.

    Both sides come from one scan. Grouping by (key, n) has at most two rows per
    group, so a hot key is spread over all tasks.
    """
    n = F.when(F.col("op") == PUT, F.col("puts")).otherwise(F.col("gets") + get_offset)
    of_put, of_get = F.col("op") == PUT, F.col("op") == GET
    return placed.groupBy(*key, n.alias("n")).agg(
        F.max(F.when(of_put, F.col(row_id))).alias("put_id"),
        F.max(F.when(of_put, F.col(ts))).alias("put_ts"),
        F.max(F.when(of_get, F.col(row_id))).alias("get_id"),
        F.max(F.when(of_get, F.col(ts))).alias("get_ts"),
    )


def fifo_match(log: DataFrame, key: Sequence[str], ts: str = "ts", row_id: str = "event_id",
               hot_rows: int | None = None) -> DataFrame:
    """The n-th put paired with the n-th get of each key."""
    pairs = _pairs(log, list(key), ts, row_id, 0, hot_rows)
    return pairs.where(F.col("put_id").isNotNull() & F.col("get_id").isNotNull())


def buffer_wait(pairs: DataFrame) -> DataFrame:
    """Per pair: how long the consumer waited or the item lay in the buffer, in ms."""
    gap = _millis(pairs, "put_ts", F.col("put_ts"), F.col("get_ts"))
    back = _millis(pairs, "put_ts", F.col("get_ts"), F.col("put_ts"))
    none = F.lit(0).cast("bigint")
    return pairs.withColumns({
        "completed_at": F.greatest("put_ts", "get_ts"),
        "consumer_wait_ms": F.greatest(none, back),
        "dwell_ms": F.greatest(none, gap),
    })


def buffer_state(log: DataFrame, key: Sequence[str], capacity: int, ts: str = "ts",
                 row_id: str = "event_id", hot_rows: int | None = None) -> DataFrame:
    """After each log row: items stored, producers blocked and consumers waiting."""
    return state_at(_positions(log, list(key), [ts, row_id], hot_rows), capacity)


def state_at(placed: DataFrame, capacity: int) -> DataFrame:
    """The state after each row, from the puts and gets of its key up to and including it."""
    ahead = F.col("puts") - F.col("gets")
    none, full = F.lit(0).cast("bigint"), F.lit(capacity).cast("bigint")
    return placed.withColumns({
        "stored": F.least(full, F.greatest(none, ahead)),
        "blocked_producers": F.greatest(none, ahead - full),
        "waiting_consumers": F.greatest(none, -ahead),
    }).drop("puts", "gets")


def blocked_puts(log: DataFrame, key: Sequence[str], capacity: int, ts: str = "ts",
                 row_id: str = "event_id", hot_rows: int | None = None) -> DataFrame:
    """Per put: when it was admitted and how long it was blocked; null when never."""
    placed = _positions(log.select(*key, ts, row_id, "op"), list(key), [ts, row_id], hot_rows)
    return blocked_at(placed, key, capacity, ts, row_id)


def blocked_at(placed: DataFrame, key: Sequence[str], capacity: int, ts: str = "ts",
               row_id: str = "event_id") -> DataFrame:
    """Admission of every put, from rows that know the puts and gets of their key so far."""
    pairs = _pairs_at(placed, list(key), ts, row_id, capacity)
    puts = pairs.where(F.col("put_id").isNotNull())
    admitted = F.when(F.col("n") <= capacity, F.col("put_ts")).when(
        F.col("get_ts").isNotNull(), F.greatest("put_ts", "get_ts")
    )
    timed = puts.withColumn("admitted_at", admitted)
    return timed.withColumn(
        "blocked_ms", _millis(timed, "put_ts", F.col("put_ts"), F.col("admitted_at"))
    ).select(*key, "n", "put_id", "put_ts", "admitted_at", "blocked_ms")


def buffer_saturation(state: DataFrame, key: Sequence[str], capacity: int) -> DataFrame:
    """Per key: share of log rows with a full, empty or blocked buffer, and the peak."""

    def share(condition: Column) -> Column:
        return F.count_if(condition) / F.count("*")

    return state.groupBy(*key).agg(
        F.count("*").alias("n"),
        share(F.col("stored") == capacity).alias("full_share"),
        share(F.col("stored") == 0).alias("empty_share"),
        share(F.col("blocked_producers") > 0).alias("blocked_share"),
        F.max("stored").alias("peak_stored"),
    )


def buffer_leftover(log: DataFrame, key: Sequence[str], capacity: int) -> DataFrame:
    """Per key: puts, gets and where the surplus stands at the end of the log."""
    none, full = F.lit(0).cast("bigint"), F.lit(capacity).cast("bigint")
    ahead = F.col("puts") - F.col("gets")
    return (
        log.groupBy(*key)
        .agg(F.sum(_flag(PUT)).alias("puts"), F.sum(_flag(GET)).alias("gets"))
        .withColumns({
            "left": F.least(full, F.greatest(none, ahead)),
            "still_blocked": F.greatest(none, ahead - full),
            "still_waiting": F.greatest(none, -ahead),
        })
    )
