"""What the plans read, shuffle and split."""

import pytest
from pyspark.sql import functions as F

from checks import queries as q
from queuelens.operators import events as ev
from tests.conftest import MEDIUM
from tests.helpers import rows


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name, columns", [
    ("event_latency", "struct<event_id:bigint,ts:timestamp_ntz>"),
    ("latency_by_client", "struct<ts:timestamp_ntz,user_id:bigint>"),
    ("total_count", "struct<event_type:string>"),
    ("latency_buckets", "struct<value:double>"),
    ("authority_rollup", "struct<url:string>"),
    ("fair_quota", "struct<doc_id:bigint,source:string>"),
    ("buffer_leftover", "struct<user_id:bigint,event_type:string>"),
    ("log_level_daily", "struct<ts:timestamp_ntz,event_type:string>"),
])
def test_only_needed_columns_are_read(spark, name, columns):
    plan = plan_of(q.QUERIES[name](spark, MEDIUM))
    assert f"ReadSchema: {columns}" in plan and plan.count("ReadSchema") == 1


def test_filters_reach_the_scan(spark):
    plan = plan_of(q.QUERIES["granted_requests"](spark, MEDIUM))
    assert "EqualTo(event_type,purchase)" in plan
    assert "WindowGroupLimit" in plan


@pytest.mark.parametrize("name", [
    "event_map", "event_latency", "uri_split", "log_render", "log_parse", "log_level_filter",
    "route_requests", "scheme_route", "allocate_fcfs", "threshold_gate",
])
def test_rows_are_not_shuffled(spark, name):
    assert "Exchange hashpartitioning" not in plan_of(q.QUERIES[name](spark, MEDIUM)).split(
        "BroadcastExchange")[0]


@pytest.mark.parametrize("name", ["buffer_state", "allocate_quantity", "fair_interleave"])
def test_one_shuffle_per_scan(spark, name):
    assert plan_of(q.QUERIES[name](spark, MEDIUM)).count("Exchange") == 1


def test_saturation_reuses_the_partitioning_of_the_scan(spark):
    assert plan_of(q.QUERIES["buffer_saturation"](spark, MEDIUM)).count("Exchange") == 1


@pytest.fixture
def small_partitions(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1KB",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def test_replay_splits_a_hot_order(spark, small_partitions):
    created = spark.range(3000).select(
        "id", F.lit("2024-01-01").cast("timestamp_ntz").alias("made"), (F.col("id") % 3).alias("kind"))
    consumed = spark.range(0, 90_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 3000).alias("ref"),
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 40 - 9).cast("int"))
        .cast("timestamp_ntz").alias("used"))
    joined = created.join(consumed, F.col("id") == F.col("ref"))
    final = joined.groupBy("kind").agg(F.max(F.date_diff("used", "made")))
    final.collect()
    assert "skew=true" in plan_of(final)
    replayed = ev.replay_latency(created, consumed, ("id", "ref"), "made", "used", ["kind"])
    got = rows(replayed, "kind", "n", "min", "max", "p50")
    split = ev.replay_latency(
        created, consumed, ("id", "ref"), "made", "used", ["kind"], hot_rows=5)
    assert rows(split, "kind", "n", "min", "max", "p50") == got
    assert sum(r[1] for r in got) == 90_000 and {r[2:4] for r in got} == {(-9, 30)}


def test_lanes_accept_text_keys(spark):
    lanes = ev.keyed_lanes(spark.range(100).select(F.col("id").cast("string").alias("k")), "k", 4)
    assert lanes.agg(F.sum("n"), F.sum("n_keys"), F.max("lane")).first() == (100, 100, 3)
