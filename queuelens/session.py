"""Session set-up and the shared folder that jobs may write to."""

from __future__ import annotations

import re
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
SHIPPED = "_queuelens_shipped"
STATE_STORE_NAME = "spark.sql.streaming.stateStore.providerClass"
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def build_session(app: str = "queuelens", master: str | None = None,
                  **conf: object) -> SparkSession:
    """A session with the settings the operators are tuned for.

    On a cluster leave ``master`` out and let spark-submit name it.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # Checkpoints go when nothing refers to them any more.
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        # Streaming state on disk with incremental uploads, not in executor memory.
        STATE_STORE_NAME: STATE_STORE,
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
        **{name: str(value) for name, value in conf.items()},
    }
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``.

    Only a session that names no such folder (a local test) gets a temporary one.
    """
    named = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder that all executors share")
    local = tempfile.mkdtemp(prefix="queuelens-")
    spark.sparkContext.setCheckpointDir(local)
    return local


def shared_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_root(spark)}/queuelens/{label}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder so later passes do not recompute it."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_root(spark))
    return df.checkpoint()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers of all executors, once per application.

    Functions that run in workers import their helpers from it. Not needed where it is
    installed on every machine or given by ``--py-files``.
    """
    context = spark.sparkContext
    if getattr(context, SHIPPED, False):
        return
    root, shared = Path(__file__).resolve().parent, f"{shared_path(spark, 'code')}/queuelens.zip"
    with tempfile.TemporaryDirectory(prefix="queuelens-") as folder:
        packed = f"{folder}/queuelens.zip"
        with zipfile.ZipFile(packed, "w") as archive:
            for file in sorted(root.rglob("*.py")):
                archive.write(file, file.relative_to(root.parent))
        local, target = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (f"file://{packed}", shared))
        files = target.getFileSystem(context._jsc.hadoopConfiguration())
        files.copyFromLocalFile(local, target)
    context.addPyFile(shared)
    setattr(context, SHIPPED, True)


def keep_state_on_disk(spark: SparkSession) -> None:
    """Use the RocksDB state store from now on; state of several parts works with no other.

    Sessions that ``build_session`` made have it; queries that run already keep their own.
    """
    if spark.conf.get(STATE_STORE_NAME, None) != STATE_STORE:
        spark.conf.set(STATE_STORE_NAME, STATE_STORE)


def require_utc(spark: SparkSession) -> None:
    """Streaming windows cast zone-free times to instants, which is exact in UTC only."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in ("UTC", "Etc/UTC", "GMT", "Z", "+00:00"):
        raise ValueError(f"session time zone must be UTC for streaming operators, not {zone}")
