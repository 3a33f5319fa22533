"""Writing streams to the shared folder, with their progress next to the data."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery
from pyspark.sql.types import StructType

from queuelens.session import STATE_STORE, STATE_STORE_NAME

# How often a report is emitted (fixed value).
REPORT_PERIOD = "1 second"
# Every so many micro-batches an upserted table is merged into one folder.
MERGE_EVERY = 10
EMPTY_BATCHES = "spark.sql.streaming.noDataMicroBatches.enabled"
ROCKSDB = "spark.sql.streaming.stateStore.rocksdb"
# For joined streams, which may hold every row: state on disk, packed, in one store per task instead of four,
# with one bound on the memory of all stores of an executor. What a trigger wrote is flushed at its end, as stores
# that wait with full buffers would use up that bound; a task's half a million rows and more fit a buffer, and are not
# read from blocks again. Rows held are not counted in the progress, which would cost a read for every write.
JOIN_STATE = {
    STATE_STORE_NAME: STATE_STORE,
    "spark.sql.streaming.join.stateFormatVersion": "3",
    f"{ROCKSDB}.boundedMemoryUsage": "true",
    f"{ROCKSDB}.changelogCheckpointing.enabled": "false",
    f"{ROCKSDB}.writeBufferSizeMB": "128",
    f"{ROCKSDB}.compression": "zstd",
    f"{ROCKSDB}.allowFAllocate": "false",
    f"{ROCKSDB}.trackTotalNumberOfRows": "false",
}
BASE, CHANGES = "base", "changes"


def triggered(writer: DataStreamWriter, period: str | None) -> DataStreamWriter:
    """Every ``period``, or once over all available input when it is None."""
    return writer.trigger(processingTime=period) if period else writer.trigger(availableNow=True)


def start_append(df: DataFrame, path: str, partition_by: tuple[str, ...] = (),
                 period: str | None = None) -> StreamingQuery:
    """Append rows as Parquet; a restart from the same path continues exactly once."""
    writer = df.writeStream.format("parquet").outputMode("append")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer = writer.option("checkpointLocation", f"{path}/progress")
    return triggered(writer, period).start(f"{path}/rows")


def start_complete(df: DataFrame, path: str, period: str | None = None,
                   finish: Callable[[DataFrame], DataFrame] | None = None) -> StreamingQuery:
    """Store the current result, or what ``finish`` makes of it, at every trigger.

    Each result gets a folder of its own, and a mark once all of it is written; readers take
    the newest marked one, so they see neither a gap nor half a result, and a crash leaves the
    one before. Folders older than the one before go.
    """

    def replace(result: DataFrame, batch_id: int) -> None:
        done = finish(result) if finish else result
        spark = result.sparkSession
        done.write.mode("overwrite").parquet(f"{path}/rows/batch_id={batch_id}")
        _mark(spark, path, str(batch_id))
        delete_folder(spark, f"{path}/rows/batch_id={batch_id - 2}")
        delete_folder(spark, f"{path}/complete/{batch_id - 2}")

    writer = df.writeStream.outputMode("complete").foreachBatch(replace)
    writer = writer.option("checkpointLocation", f"{path}/progress")
    return triggered(writer, period).start()


def _files(spark: SparkSession, path: str, use: Callable):
    """What ``use`` makes of a folder of the shared file system and its address."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return use(folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), folder)


def _mark(spark: SparkSession, path: str, name: str) -> None:
    """Say that the result ``name`` below ``path`` is whole."""
    _files(spark, f"{path}/complete", lambda files, folder: files.create(folder.suffix(f"/{name}"), True).close())


def _marks(spark: SparkSession, path: str) -> list[str]:
    """The names of all whole results below ``path``."""
    found = _files(spark, f"{path}/complete", lambda files, folder: files.globStatus(folder.suffix("/*")))
    return [mark.getPath().getName() for mark in found or ()]


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a file or folder of the shared file system, if it is there."""
    _files(spark, path, lambda files, folder: files.delete(folder, True))


def newest_complete(spark: SparkSession, path: str) -> int | None:
    """The number of the newest result below ``path`` that is whole, or None."""
    return max(map(int, _marks(spark, path)), default=None)


def stored_complete(schema: StructType, spark: SparkSession, path: str) -> DataFrame:
    """The newest whole result that a query has written below ``path``; empty if there is none."""
    newest = newest_complete(spark, path)
    if newest is None:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{path}/rows/batch_id={newest}")


def stored(df: DataFrame, path: str) -> DataFrame:
    """What a query over ``df`` has written below ``path``."""
    return df.sparkSession.read.schema(df.schema).parquet(f"{path}/rows")


@contextmanager
def settings(spark: SparkSession, chosen: Mapping[str, str]) -> Iterator[None]:
    """``chosen`` holds inside; a query that is started there has its own copy of it from then on."""
    before = {name: spark.conf.get(name, None) for name in chosen}
    try:
        for name, value in chosen.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def append_all(df: DataFrame, path: str, partition_by: tuple[str, ...] = (), last_clearing: bool = True,
               state: Mapping[str, str] | None = None) -> DataFrame:
    """Run ``df`` over all available input in append mode and read the result.

    Without ``last_clearing`` there is no micro-batch without rows after the last one. That is for inner
    joins, which emit nothing in it and only clear state; a later run clears it with its own rows.
    ``state`` says how state is kept, as ``JOIN_STATE`` does; later runs from the same path keep its store and format.
    """
    with settings(df.sparkSession, {**(state or {}), **({} if last_clearing else {EMPTY_BATCHES: "false"})}):
        query = start_append(df, path, partition_by)
    query.awaitTermination()
    return stored(df, path)


def complete_all(df: DataFrame, path: str) -> DataFrame:
    """Run ``df`` over all available input in complete mode and read the result."""
    start_complete(df, path).awaitTermination()
    return stored_complete(df.schema, df.sparkSession, path)


def newest_rows(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row of each key that comes last by ``order``, combined in every task before the shuffle."""
    last = F.max_by(F.struct(*df.columns), F.struct(*order))
    return df.groupBy(*[F.col(k).alias(f"__{k}") for k in key]).agg(last.alias("__row")).select("__row.*")


def start_upsert(df: DataFrame, path: str, key: Sequence[str], order: Sequence[str], period: str | None = None,
                 merge_every: int = MERGE_EVERY) -> StreamingQuery:
    """Keep the row of each key that comes last by ``order``, whichever order rows arrive in.

    A micro-batch writes its own newest rows to a folder, and a mark once they are whole. Every
    ``merge_every``-th one also holds all keys of before, as a new base. One that is run again
    leaves a marked folder as it is, and else writes the same rows anew. Folders older than the
    base before the newest go, so a reader that has just looked up its folders can finish.
    """

    def merge(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        marked = _marks(spark, path)
        if any(name.endswith(f"-{batch_id}") for name in marked):
            return
        is_base = (batch_id + 1) % merge_every == 0
        rows = batch.unionByName(_versions(batch, path)) if is_base else batch
        newest_rows(rows, key, order).write.mode("overwrite").parquet(f"{path}/rows/batch_id={batch_id}")
        _mark(spark, path, f"{BASE if is_base else CHANGES}-{batch_id}")
        if is_base:
            before = _base(marked)
            for name in marked:
                if int(name.split("-")[1]) < before:
                    delete_folder(spark, f"{path}/complete/{name}")
                    delete_folder(spark, f"{path}/rows/batch_id={name.split('-')[1]}")

    writer = df.writeStream.outputMode("update").foreachBatch(merge)
    writer = writer.option("checkpointLocation", f"{path}/progress")
    return triggered(writer, period).start()


def _base(marked: Sequence[str]) -> int:
    """The number of the newest base, or -1."""
    return max((int(name.split("-")[1]) for name in marked if name.startswith(BASE)), default=-1)


def _versions(like: DataFrame, path: str) -> DataFrame:
    """The rows of the newest base below ``path`` and of all whole folders since."""
    spark = like.sparkSession
    marked = _marks(spark, path)
    numbers = sorted(n for n in (int(name.split("-")[1]) for name in marked) if n >= _base(marked))
    if not numbers:
        return spark.createDataFrame([], like.schema)
    return spark.read.schema(like.schema).parquet(*[f"{path}/rows/batch_id={n}" for n in numbers])


def stored_upserts(df: DataFrame, path: str, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The table that ``start_upsert`` over ``df`` has written below ``path``: one row per key."""
    return newest_rows(_versions(df, path), key, order)


def upsert_all(df: DataFrame, path: str, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Run ``start_upsert`` over all available input and read the table."""
    start_upsert(df, path, key, order).awaitTermination()
    return stored_upserts(df, path, key, order)
