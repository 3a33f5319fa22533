"""Joins on keys that may be null, and broadcasts behind a size check."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

# A side with at most this many rows, and bytes of text, may be sent to every executor.
BROADCAST_ROWS = 100_000
BROADCAST_BYTES = 32 << 20


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS,
                       max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Mark ``df`` for broadcast only after measuring that it is within the bounds.

    A larger side is returned as it is: the join then shuffles both sides and
    adaptive execution splits its skewed partitions. Bytes are those of the rows as JSON.
    """
    text = F.octet_length(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])))
    rows, size = df.limit(max_rows + 1).agg(F.count("*"), F.coalesce(F.sum(text), F.lit(0))).first()
    return F.broadcast(df) if rows <= max_rows and size <= max_bytes else df


def join_on_key(left: DataFrame, right: DataFrame, key: list[str], how: str = "left") -> DataFrame:
    """Join on equal keys where null equals null; the key columns of ``left`` are kept."""
    renamed = right.withColumnsRenamed({k: f"__right_{k}" for k in key})
    same = reduce(
        lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__right_{k}")) for k in key]
    )
    joined = left.join(renamed, same, how)
    if how in ("left_semi", "left_anti"):
        return joined
    return joined.drop(*[f"__right_{k}" for k in key])


def with_key_values(df: DataFrame, per_key: DataFrame, key: list[str]) -> DataFrame:
    """``df`` with the other columns of ``per_key``, which holds one row per key.

    Without a key there is one row in all, which comes in as a scalar.
    """
    if key:
        return join_on_key(df, broadcast_if_small(per_key), key, "inner")
    values = per_key.select(F.struct(*per_key.columns)).scalar()
    return df.withColumn("__values", values).select(*df.columns, "__values.*")
