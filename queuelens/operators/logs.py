"""Rendering, parsing, filtering and daily partitioning of logs."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from queuelens.functions.logs import (
    level_rank, line_fields, named_fields, rendered_line, threshold_rank,
)

LOG_ROWS = "ts TIMESTAMP_NTZ, level STRING, logger STRING, line INT, message STRING, raw STRING"


def log_render(df: DataFrame, layout: str = "stdout", line: Column | None = None) -> DataFrame:
    """``df`` with its ts, level, logger and message rendered as ``text``."""
    return df.withColumn(
        "text",
        rendered_line(F.col("ts"), F.col("level"), F.col("logger"), F.col("message"), line, layout),
    )


def log_parse(lines: DataFrame, text: str = "value") -> DataFrame:
    """Fields of each line; a line that does not match keeps nulls and its raw text."""
    keep = [column for column in lines.columns if column != text]
    # As a generator the pattern runs once per line; a filter on its fields, pushed
    # through a projection, would run it again.
    fields = F.explode(F.array(line_fields(F.col(text)))).alias("__fields")
    split = lines.select(*keep, F.col(text).alias("raw"), fields)
    named = named_fields(F.col("raw"), F.col("__fields"))
    return split.withColumns(named).select(*keep, *named, "raw")


def log_level_filter(df: DataFrame, root: str = "INFO",
                     loggers: Mapping[str, str] | None = None) -> DataFrame:
    """Rows at or above the level configured for their logger; unknown levels are dropped."""
    required = threshold_rank(F.col("logger"), root, dict(loggers or {}))
    return df.where(level_rank(F.col("level")) >= required)


def unparsed(lines: DataFrame) -> DataFrame:
    """The raw text of parsed rows that held no log line: stack traces, continuation lines."""
    return lines.where(F.col("ts").isNull() & F.col("level").isNull()).select("raw")


def with_log_date(df: DataFrame) -> DataFrame:
    return df.withColumn("log_date", F.to_date("ts"))


def log_daily_roll(df: DataFrame, path: str, rows_per_file: int = 5_000_000) -> None:
    """Write rows to one partition per day.

    Rebalancing gathers a day into few files and splits a day that is too large
    for one task.
    """
    (
        with_log_date(df)
        .hint("rebalance", "log_date")
        .write.partitionBy("log_date")
        .option("maxRecordsPerFile", rows_per_file)
        .mode("errorifexists")
        .parquet(path)
    )


def rolled_days(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows per day partition below ``path``."""
    rows = spark.read.schema(f"{schema}, log_date DATE").parquet(path)
    return rows.groupBy("log_date").agg(F.count("*").alias("n"))


def log_level_daily(df: DataFrame) -> DataFrame:
    """Rows per day and level."""
    return with_log_date(df).groupBy("log_date", "level").agg(F.count("*").alias("n"))
