"""Input columns, tables kept in the shared folder, and Arrow batches of bounded size."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

from queuelens.session import shared_path

# What a batch for a Python worker holds at most.
BATCH_ROWS, BATCH_BYTES = 1000, 4 << 20


def texts_of(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Only (doc_id, text), so that further columns of the input cannot clash; null text is empty."""
    return docs.select(
        F.col(key).cast("bigint").alias("doc_id"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    )


def kept(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once as Parquet below the shared folder, and read from there.

    Later passes read the file instead of computing the rows again, whichever
    executors are lost in between.
    """
    path = shared_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession) -> None:
    """Have Spark hand rows to Python workers in small batches, from now on in this session.

    A batch lies in the executor's memory and in the worker's at once, and buffers double as
    they grow. Results do not depend on it.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def give_back() -> None:
    """Return freed memory to the system.

    A worker that is used again would otherwise keep what its earlier tasks needed, beside
    what the executor itself holds.
    """
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only some C libraries have it
    if trim:
        trim(0)


def bounded(batches: Iterator[pa.RecordBatch], column: str = "text",
            max_bytes: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """The batches cut so that each holds about ``max_bytes`` of ``column``, or one row."""
    give_back()
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = np.asarray(
            pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
        ).astype(np.int64)
        piece = np.cumsum(sizes) // max_bytes
        starts = [0, *(np.flatnonzero(np.diff(piece)) + 1).tolist(), batch.num_rows]
        for begin, end in zip(starts, starts[1:]):
            yield batch.slice(begin, end - begin)


def strings(batch: pa.RecordBatch, column: str = "text") -> pa.Array:
    """A text column with 64-bit offsets and no nulls."""
    return batch.column(column).cast(pa.large_string()).fill_null("")
