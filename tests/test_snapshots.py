"""Snapshots from value counts equal the built-in aggregates."""

import statistics

import pytest
from pyspark.sql import functions as F

from queuelens.functions.times import ntz
from queuelens.operators import events as ev
from queuelens.plans.snapshots import QUANTILES, snapshot
from queuelens.sources.tables import table
from tests.conftest import MEDIUM
from tests.helpers import at, rows


@pytest.fixture(scope="module")
def latencies(spark):
    events = ev.event_latency(table(spark, MEDIUM, "events"), ntz("2024-02-01"))
    key = F.when(F.col("event_id") % 3 != 0, F.col("user_id"))
    gaps = F.when(F.col("event_id") % 11 != 0, F.col("latency_ms"))
    return events.withColumns({"k": key, "latency_ms": gaps}).cache()


def close(left, right, digits=3):
    columns = [F.round(c, digits).alias(c) if t == "double" else F.col(c) for c, t in left.dtypes]
    return rows(left.select(columns)) == rows(right.select(left.columns).select(columns))


@pytest.mark.parametrize("key", [[], ["k"], ["event_type"]])
def test_value_counts_equal_percentile(latencies, key):
    want = snapshot(latencies, key, "latency_ms")
    got = snapshot(latencies, key, "latency_ms", hot_rows=100)
    assert got.columns == want.columns == key + ["n", "min", "max", "mean", "stddev", *QUANTILES]
    assert close(got, want)


def test_repeated_values(spark):
    df = spark.range(1000).select(F.when(F.col("id") < 400, 5).otherwise(F.col("id") % 7).alias("v"))
    assert close(snapshot(df, [], "v", hot_rows=10), snapshot(df, [], "v"))


def test_single_value_has_no_deviation(spark):
    df = spark.createDataFrame([(1, 4)], "k INT, v INT")
    assert snapshot(df, ["k"], "v").first().stddev is None
    two = spark.createDataFrame([(1, 4)] * 30 + [(2, 9)], "k INT, v INT")
    assert close(snapshot(two, ["k"], "v", hot_rows=2), snapshot(two, ["k"], "v"))


def test_groups_of_nulls(spark):
    df = spark.range(300).select(
        (F.col("id") % 3).alias("k"), F.when(F.col("id") % 3 > 0, F.col("id")).alias("v"))
    assert close(snapshot(df, ["k"], "v", hot_rows=10), snapshot(df, ["k"], "v"))
    nulls = df.where("k = 0")
    assert close(snapshot(nulls, [], "v", hot_rows=10), snapshot(nulls, [], "v"))


def test_approximate_quantiles_are_near(latencies):
    exact = snapshot(latencies, [], "latency_ms").first()
    near = snapshot(latencies, [], "latency_ms", approx=True).first()
    assert near.n == exact.n
    assert abs(near.p95 - exact.p95) < 0.001 * exact.p95


@pytest.mark.parametrize("hot_rows", [None, 3])
def test_cumulative_ends_with_the_summary(latencies, hot_rows):
    last = ev.latency_cumulative(latencies, "6 hours", hot_rows=hot_rows).orderBy(
        F.desc("period_start")).first()
    whole = ev.latency_summary(latencies).first()
    assert (last.n, last["min"], last["max"]) == (whole.n, whole["min"], whole["max"])
    assert last["mean"] == pytest.approx(whole["mean"]) and last["stddev"] == pytest.approx(whole["stddev"])


def test_decayed_quantile_with_a_hot_key(latencies):
    plain = ev.latency_decayed_quantile(latencies, ["k"], "value", 10, 0.015)
    split = ev.latency_decayed_quantile(latencies, ["k"], "value", 10, 0.015, hot_rows=3)
    assert rows(plain) == rows(split)


def test_no_decay_is_the_plain_mean(latencies):
    decayed = ev.latency_decayed(latencies, ["event_type"], "value", 0.0)
    plain = latencies.groupBy("event_type").agg(
        F.count("value").cast("double").alias("weight"), F.avg("value").alias("mean"),
        F.stddev_pop("value").alias("stddev"))
    assert close(decayed, plain, 6)


def test_event_map_pandas_keeps_rows(latencies):
    rows_in = latencies.select("event_id", "value")
    doubled = ev.event_map_pandas(rows_in, lambda b: b.assign(value=b.value * 2), "event_id BIGINT, value DOUBLE")
    assert doubled.agg(F.sum("value")).first()[0] == pytest.approx(
        2 * rows_in.agg(F.sum("value")).first()[0])
    with pytest.raises(Exception, match="keep the number of events"):
        ev.event_map_pandas(rows_in, lambda b: b.head(1), "event_id BIGINT, value DOUBLE").count()


def test_cumulative_deviation_of_large_values(spark):
    """Latencies near 2.7e9 that differ by one: squares of the values would cancel."""
    data = [(i, at(3600 * i), 2_678_392_820 + i % 3) for i in range(60)]
    df = spark.createDataFrame(data, "event_id INT, ts TIMESTAMP_NTZ, latency_ms BIGINT")
    last = ev.latency_cumulative(df, "1 day").orderBy(F.desc("period_start")).first()
    values = [v for _, _, v in data]
    assert last.stddev == pytest.approx(statistics.stdev(values), rel=1e-6)
    assert last["mean"] == pytest.approx(statistics.mean(values), rel=1e-12)


def test_a_key_quiet_beyond_underflow(spark):
    """A weight 100 days old underflows against the newest row of all, not of its own key."""
    data = [("quiet", at(i), 100.0 + 100 * i) for i in range(3)] + [("busy", at(100 * 86_400), 1.0)]
    df = spark.createDataFrame(data, "k STRING, ts TIMESTAMP_NTZ, value DOUBLE")
    found = {r.k: r for r in ev.latency_decayed(df, ["k"], "value", 1.0).collect()}
    assert found["quiet"]["mean"] == pytest.approx(200, abs=0.1) and found["quiet"].weight == 0
    assert found["busy"].weight == 1
    middle = {r.k: r.lower for r in ev.latency_decayed_quantile(df, ["k"], "value", 100, 1.0).collect()}
    assert middle == {"quiet": 200, "busy": 0}


def test_values_without_a_bucket(spark):
    df = spark.createDataFrame([(float("nan"),), (None,), (1e300,), (-1e300,), (5.0,), (-0.5,)], "v DOUBLE")
    found = {r.bucket: r.n for r in ev.latency_buckets(df, "v", 1.0).collect()}
    assert found == {None: 4, 5: 1, -1: 1}
