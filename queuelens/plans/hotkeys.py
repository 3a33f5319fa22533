"""Finding keys that hold too many rows for one task, with bounded results."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

HOT_ROWS = "spark.queuelens.hotRows"
DEFAULT_HOT_ROWS = 1_000_000


def hot_rows_of(spark: SparkSession, hot_rows: int | None) -> int:
    """Rows one task may hold for a single key before the key is split."""
    return hot_rows or int(spark.conf.get(HOT_ROWS, str(DEFAULT_HOT_ROWS)))


@dataclass(frozen=True)
class Sizes:
    """How rows are spread over keys; ``limit`` is the largest unsplit group."""

    total: int
    largest: int
    limit: int

    @property
    def has_hot_keys(self) -> bool:
        return self.largest > self.limit


def measure(df: DataFrame, key: list[str], hot_rows: int | None = None) -> Sizes:
    """Count rows per key with map-side partial counts; one row reaches the driver."""
    allowed = hot_rows_of(df.sparkSession, hot_rows)
    per_key = df.groupBy(*key).agg(F.count("*").alias("n"))
    total, largest = per_key.agg(F.sum("n"), F.max("n")).first()
    total, largest = total or 0, largest or 0
    return Sizes(total, largest, allowed)


def hot_keys(df: DataFrame, key: list[str], limit: int) -> DataFrame:
    """Keys with more than ``limit`` rows, at most ``total / limit`` of them."""
    return df.groupBy(*key).agg(F.count("*").alias("__n")).where(F.col("__n") > limit).select(*key)
