"""Where jobs may write: the folder the session names, never a machine's own on a cluster."""

from types import SimpleNamespace

import pytest

from queuelens.session import CHECKPOINT_DIR, cut_lineage, shared_path, shared_root


def fake_session(master, named=None, set_dir=None):
    used = []
    context = SimpleNamespace(
        master=master, getCheckpointDir=lambda: set_dir, setCheckpointDir=used.append)
    conf = SimpleNamespace(get=lambda name, default: named if name == CHECKPOINT_DIR else default)
    return SimpleNamespace(conf=conf, sparkContext=context), used


def test_named_folder_is_used():
    session, used = fake_session("yarn", named="hdfs://shared/folder/")
    assert shared_root(session) == "hdfs://shared/folder" and not used
    assert shared_path(session, "x").startswith("hdfs://shared/folder/queuelens/x-")
    assert shared_path(session, "x") != shared_path(session, "x")


def test_cluster_without_a_folder_is_refused():
    session, used = fake_session("yarn")
    with pytest.raises(ValueError, match=CHECKPOINT_DIR):
        shared_root(session)
    assert not used


def test_local_session_gets_its_own():
    session, used = fake_session("local[2]")
    assert used == [] and shared_root(session) == used[0]


def test_cut_lineage_keeps_rows(spark):
    df = cut_lineage(spark.range(10).selectExpr("id", "id * 2 AS twice"))
    assert df.count() == 10 and "Range" not in df._jdf.queryExecution().executedPlan().toString()


def test_storage_is_listed_whole(spark, tmp_path):
    """Bytes and files as the file system has them, of tables without a row too."""
    from queuelens.sources.tables import storage_report

    spark.range(100).repartition(3).write.parquet(str(tmp_path / "some.parquet"))
    spark.range(0).write.parquet(str(tmp_path / "none.parquet"))
    report = {r.dataset: r for r in storage_report(spark, str(tmp_path), ["some.parquet", "none.parquet"]).collect()}
    for name, count in (("some.parquet", 100), ("none.parquet", 0)):
        files = list((tmp_path / name).glob("*.parquet"))
        assert (report[name].files, report[name].n_rows) == (len(files), count)
        assert report[name].bytes == sum(f.stat().st_size for f in files) > 0
