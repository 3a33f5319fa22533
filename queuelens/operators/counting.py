"""Exact counts: totals, running counts and reconciliation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from queuelens.plans.ordered import ranked


def total_count(df: DataFrame, key: Sequence[str] = ()) -> DataFrame:
    """Rows in all, or per key."""
    return df.groupBy(*key).agg(F.count("*").alias("n"))


def running_count(df: DataFrame, order: Sequence[str], hot_rows: int | None = None) -> DataFrame:
    """The global count right after each row, in order over the whole table."""
    return ranked(df, [], order, "running_count", hot_rows)


def count_reconcile(expected: DataFrame, actual: DataFrame, key: Sequence[str]) -> DataFrame:
    """Expected and actual rows per key, and how many are lost."""
    key = list(key)
    want = total_count(expected, key).withColumnRenamed("n", "expected")
    have = total_count(actual, key).withColumnRenamed("n", "actual")
    sides = want.withColumn("actual", F.lit(0).cast("bigint")).unionByName(
        have.withColumn("expected", F.lit(0).cast("bigint"))
    )
    return (
        sides.groupBy(*key)
        .agg(F.sum("expected").alias("expected"), F.sum("actual").alias("actual"))
        .withColumn("lost", F.col("expected") - F.col("actual"))
    )
