"""Batch and streaming readers, and the storage report."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from queuelens.sources.schemas import EVENTS, TABLES

# Schemes that may be opened, the ones the registry of file systems holds.
OPENABLE_SCHEMES = ("file", "hdfs")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One Parquet table of ``folder`` with its fixed schema."""
    return spark.read.schema(TABLES[name]).parquet(f"{folder}/{name}.parquet")


def event_source(spark: SparkSession, path: str) -> DataFrame:
    """The event table at ``path``."""
    return spark.read.schema(EVENTS).parquet(path)


def event_stream(spark: SparkSession, path: str,
                 files_per_trigger: int | None = None) -> DataFrame:
    """Events as a stream of the Parquet files at ``path``, a folder or a glob of files or folders."""
    reader = spark.readStream.schema(EVENTS)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def load_uri(spark: SparkSession, uri: str, format: str = "parquet") -> DataFrame:
    """Open a table at a ``file:`` or ``hdfs:`` address."""
    scheme, colon, _ = uri.partition(":/")
    if not colon or scheme not in OPENABLE_SCHEMES:
        raise ValueError(f"no file system for {uri!r}: expected {' or '.join(OPENABLE_SCHEMES)}")
    return spark.read.format(format).load(uri)


def storage_report(spark: SparkSession, folder: str, names: Sequence[str],
                   format: str = "parquet") -> DataFrame:
    """Files, bytes and rows per table of ``folder``, also of tables or files without a row.

    A table is named by what it is called below the folder, unchanged; it may be one file or
    a folder of part files. Files are listed, not read; rows come from what the files say of
    themselves where their format does.
    """
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(
        [f"{folder}/{name}" for name in names]).select("path", "length")
    below = F.substring_index("path", f"/{folder.rstrip('/').rsplit('/', 1)[-1]}/", -1)
    dataset = F.coalesce(*[F.when((below == name) | below.startswith(f"{name}/"), name) for name in names])
    files = listed.groupBy(dataset.alias("dataset")).agg(
        F.count("*").alias("files"), F.sum("length").alias("bytes"))
    rows = reduce(DataFrame.unionAll, [
        # Rows are counted without a column, so the schema is not looked for.
        spark.read.format(format).schema("__none INT").load(f"{folder}/{name}").agg(F.lit(name).alias("dataset"), F.count("*").alias("n_rows"))
        for name in names])
    none = F.lit(0).cast("bigint")
    return rows.join(files, "dataset", "left").select(
        "dataset", F.coalesce("files", none).alias("files"), F.coalesce("bytes", none).alias("bytes"), "n_rows")


def table_stream(spark: SparkSession, folder: str, name: str, files_per_trigger: int | None = None) -> DataFrame:
    """One table of ``folder`` with its fixed schema as a stream of its Parquet files."""
    reader = spark.readStream.schema(TABLES[name])
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(f"{folder}/{name}*.parquet")
