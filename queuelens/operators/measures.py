"""Stacked measures and stages that report how many rows pass."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, functions as F


def stacked_adjustment(df: DataFrame, key: Sequence[str], base: Column,
                       increments: Sequence[Column | float],
                       extra: Mapping[str, Column | float] | None = None) -> DataFrame:
    """Base measure plus a chain of increments, summed per key.

    Each level adds its increment to what the level below returns. ``extra`` are
    measures that a level adds of its own, per row.
    """

    def raise_by(amount: Column | float) -> Callable[[DataFrame], DataFrame]:
        step = amount if isinstance(amount, Column) else F.lit(amount)
        return lambda level: level.withColumn("__measure", F.col("__measure") + step)

    level = df.withColumn("__measure", base)
    for amount in increments:
        level = level.transform(raise_by(amount))
    others = {
        name: column if isinstance(column, Column) else F.lit(column)
        for name, column in (extra or {}).items()
    }
    return level.groupBy(*key).agg(
        F.count("*").alias("n"),
        F.sum(base).alias("base_total"),
        F.sum("__measure").alias("adjusted_total"),
        *[F.sum(column).alias(f"{name}_total") for name, column in others.items()],
    )


def instrumented_stage(df: DataFrame, key: Sequence[str], keeps: Column) -> DataFrame:
    """Rows before and after a filtering stage, per key, in one pass."""
    return df.groupBy(*key).agg(
        F.count("*").alias("rows_before"), F.count_if(keeps).alias("rows_after")
    )


def observed_stage(df: DataFrame, stage: Callable[[DataFrame], DataFrame]
                   ) -> tuple[DataFrame, Observation, Observation]:
    """Run any stage inside a pipeline; both counts are known after its first action."""
    before, after = Observation("before"), Observation("after")
    count = F.count(F.lit(1)).alias("rows")
    return stage(df.observe(before, count)).observe(after, count), before, after
