"""Exact time differences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T


def _part(field: str, interval: Column) -> Column:
    return F.extract(F.lit(field), interval)


def millis_between_ntz(start: Column, end: Column) -> Column:
    """Whole milliseconds from ``start`` to ``end``, floored, for zone-free times.

    The parts of a negative interval are all negative, so flooring the seconds
    floors the whole.
    """
    gap = end - start
    minutes = (
        (_part("DAY", gap).cast("bigint") * 24 + _part("HOUR", gap)) * 60 + _part("MINUTE", gap)
    )
    return minutes * 60_000 + F.floor(_part("SECOND", gap) * 1000).cast("bigint")


def millis_between_instants(start: Column, end: Column) -> Column:
    """Whole milliseconds from ``start`` to ``end``, floored, for instants."""
    micros = F.unix_micros(end) - F.unix_micros(start)
    whole = micros - F.pmod(micros, F.lit(1000).cast("bigint"))
    return F.call_function("div", whole, F.lit(1000).cast("bigint"))


def millis_between(df: DataFrame, start: str, end: Column | str) -> Column:
    """Picks the exact form for the type of column ``start`` of ``df``."""
    end = F.col(end) if isinstance(end, str) else end
    if isinstance(df.schema[start].dataType, T.TimestampNTZType):
        return millis_between_ntz(F.col(start), end)
    return millis_between_instants(F.col(start), end)


def micros_between(df: DataFrame, start: str, end: Column) -> Column:
    """Microseconds from column ``start`` of ``df`` to ``end``, exactly."""
    if not isinstance(df.schema[start].dataType, T.TimestampNTZType):
        return F.unix_micros(end) - F.unix_micros(F.col(start))
    gap = end - F.col(start)
    minutes = (_part("DAY", gap).cast("bigint") * 24 + _part("HOUR", gap)) * 60 + _part("MINUTE", gap)
    return minutes * 60_000_000 + (_part("SECOND", gap) * 1_000_000).cast("bigint")


def ntz(text: str) -> Column:
    """A zone-free time literal."""
    return F.lit(text).cast("timestamp_ntz")
