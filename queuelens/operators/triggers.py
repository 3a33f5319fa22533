"""Triggers that fire when a key has seen a given number of events."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from queuelens.functions.times import millis_between
from queuelens.plans.joins import broadcast_if_small, join_on_key
from queuelens.plans.ordered import first_rows
from queuelens.session import cut_lineage


def nth_event(df: DataFrame, key: Sequence[str], order: Sequence[str], n: int,
              hot_rows: int | None = None) -> DataFrame:
    """The event at which the count of its key reaches ``n``; at most one per key."""
    reached = first_rows(df, key, order, n, "__n", hot_rows).where(F.col("__n") == n)
    return reached.drop("__n")


def nth_position(df: DataFrame, key: Sequence[str], order: Sequence[str], n: int, name: str,
                 hot_rows: int | None = None) -> DataFrame:
    """Per key, the order values of its n-th row as a struct, ready to be joined.

    Written once, since counting it for the broadcast check would run it again.
    """
    key, order = list(key), list(order)
    nth = nth_event(df.select(*dict.fromkeys(key + order)), key, order, n, hot_rows)
    return broadcast_if_small(cut_lineage(nth.select(*key, F.struct(*order).alias(name))))


def threshold_gate(df: DataFrame, key: Sequence[str], order: Sequence[str], n: int,
                   hot_rows: int | None = None) -> DataFrame:
    """All events from the n-th event of their key on; the gate stays open."""
    key, order = list(key), list(order)
    opened = nth_position(df, key, order, n, "__gate", hot_rows)
    passed = join_on_key(df, opened, key, "inner")
    return passed.where(F.struct(*order) >= F.col("__gate")).drop("__gate")


def gate_delay(df: DataFrame, key: Sequence[str], ts: str, row_id: str, n: int,
               hot_rows: int | None = None) -> DataFrame:
    """Per key: first event, the event that reached ``n``, and the time between, or null."""
    key = list(key)
    narrow = df.select(*dict.fromkeys(key + [ts, row_id]))
    early = first_rows(narrow, key, [ts, row_id], n, "__n", hot_rows)
    reached = early.groupBy(*key).agg(
        F.min(ts).alias("first_ts"), F.max(F.when(F.col("__n") == n, F.col(ts))).alias("reached_ts")
    )
    return reached.withColumn(
        "delay_ms", millis_between(reached, "first_ts", "reached_ts")
    )
