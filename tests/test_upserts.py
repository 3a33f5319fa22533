"""A table of newest rows that micro-batches upsert."""

import pytest
from pyspark.sql import functions as F

from queuelens.operators import ordering
from queuelens.session import shared_path
from queuelens.sources.tables import event_stream, table
from queuelens.streaming import sinks
from queuelens.streaming.sinks import newest_rows, start_upsert, stored_upserts, upsert_all
from tests.conftest import SMALL
from tests.helpers import same

KEY, ORDER = ["user_id"], ["ts", "event_id"]


@pytest.fixture(scope="module")
def events(spark):
    """A third of all rows belong to the null key."""
    rows = table(spark, SMALL, "events")
    key = F.when(F.col("event_id") % 3 > 0, F.col("user_id"))
    return rows.withColumn("user_id", key).select(rows.columns).cache()


@pytest.fixture(scope="module")
def folder(spark, events):
    """Eight files in an order that is not the order of time."""
    path = shared_path(spark, "upsert-input")
    for part in (3, 0, 7, 1, 6, 2, 5, 4):
        events.where(F.col("event_id") % 8 == part).coalesce(1).write.mode("append").parquet(path)
    return path


def folders(spark, path):
    found = sinks._files(spark, f"{path}/rows", lambda files, folder: files.globStatus(folder.suffix("/*")))
    return sorted(int(f.getPath().getName().split("=")[1]) for f in found)


@pytest.mark.parametrize("merge_every", [1, 3, 100])
def test_newest_rows_whatever_the_order_of_arrival(spark, events, folder, merge_every):
    source, out = event_stream(spark, folder, files_per_trigger=1), shared_path(spark, "upserts")
    start_upsert(source, out, KEY, ORDER, merge_every=merge_every).awaitTermination()
    assert same(stored_upserts(source, out, KEY, ORDER), newest_rows(events, KEY, ORDER))
    # Bases replace what was before; the last base but one stays for readers that have just begun.
    assert folders(spark, out) == {1: [6, 7], 3: [2, 3, 4, 5, 6, 7], 100: list(range(8))}[merge_every]


def test_a_micro_batch_that_runs_again_changes_nothing(spark, events, folder, monkeypatch):
    """Stopped before the mark, after the mark, and after a base: the table is the same."""
    source, out = event_stream(spark, folder, files_per_trigger=1), shared_path(spark, "replayed")
    mark, broken = sinks._mark, []

    def failing(spark, path, name):
        number = int(name.split("-")[1])
        if number in (1, 2, 4) and name not in broken:
            broken.append(name)
            if number != 1:
                mark(spark, path, name)
            raise RuntimeError("executor lost")
        mark(spark, path, name)

    monkeypatch.setattr(sinks, "_mark", failing)
    for _ in range(3):
        with pytest.raises(Exception, match="executor lost"):
            start_upsert(source, out, KEY, ORDER, merge_every=3).awaitTermination()
    start_upsert(source, out, KEY, ORDER, merge_every=3).awaitTermination()
    assert broken == ["changes-1", "base-2", "changes-4"]
    assert same(stored_upserts(source, out, KEY, ORDER), newest_rows(events, KEY, ORDER))


def test_readers_see_whole_versions_only(spark, events, folder):
    source, out = event_stream(spark, folder, files_per_trigger=2), shared_path(spark, "half-written")
    whole = upsert_all(source, out, KEY, ORDER)
    newer = events.withColumn("ts", F.expr("ts + INTERVAL 1 DAY"))
    newer.select(events.columns).write.parquet(f"{out}/rows/batch_id=99")  # never marked
    assert same(stored_upserts(source, out, KEY, ORDER), whole)
    assert same(whole, newest_rows(events, KEY, ORDER))
    assert stored_upserts(source, f"{out}-none", KEY, ORDER).isEmpty()


def test_latest_per_key_of_the_table(spark, events, folder):
    owners = table(spark, SMALL, "customer")
    upserted = upsert_all(event_stream(spark, folder), shared_path(spark, "latest"), KEY, ORDER)
    read = lambda sets: ordering.latest_per_key(
        owners, sets, "c_custkey", "user_id", F.col("event_type"), ORDER)
    assert same(read(upserted), read(events))
