"""Chunked scans equal plain windows, whatever share one key holds."""

import pytest
from pyspark.sql import Window, functions as F

from queuelens.plans import ordered
from queuelens.plans.hotkeys import measure
from queuelens.plans.ordered import CHUNK, first_rows, ranked, running
from queuelens.sources.tables import table
from tests.conftest import MEDIUM
from tests.helpers import same

ORDER = ["ts", "event_id"]


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of all rows under the null key, and a burst of rows at one instant."""
    events = table(spark, MEDIUM, "events")
    burst = F.when(F.col("event_id") % 4 == 0, F.lit("2024-01-10").cast("timestamp_ntz"))
    key = F.when(F.col("event_id") % 3 != 0, F.col("user_id") % 40)
    return events.withColumns({"k": key, "ts": F.coalesce(burst, "ts")})


@pytest.mark.parametrize("key", [[], ["k"], ["k", "event_type"]])
@pytest.mark.parametrize("hot_rows", [7, 100, 2500, None])
def test_running_equals_window(skewed, key, hot_rows):
    sign = F.when(F.col("event_type") == "view", 1).otherwise(-1).cast("bigint")
    gappy = F.when(F.col("event_id") % 5 != 0, F.col("value"))
    by_order = Window.partitionBy(*key).orderBy(*ORDER)
    so_far = by_order.rowsBetween(Window.unboundedPreceding, 0)
    got = running(
        skewed, key, ORDER,
        {"balance": ("sum", sign), "low": ("min", gappy), "high": ("max", gappy)},
        {"before": F.col("event_type"), "gappy_before": gappy},
        hot_rows=hot_rows,
    )
    want = skewed.withColumns({
        "balance": F.sum(sign).over(so_far),
        "low": F.min(gappy).over(so_far),
        "high": F.max(gappy).over(so_far),
        "before": F.lag("event_type").over(by_order),
        "gappy_before": F.lag(gappy).over(by_order),
    })
    assert same(got, want)


def test_no_group_stays_large(skewed):
    split, _ = ordered._split(skewed, ["k"], ORDER, [], 200)
    largest = measure(split, ["k", CHUNK]).largest
    assert measure(skewed, ["k"]).largest > 3000
    assert largest <= 5 * 200


def test_global_order_is_spread(skewed):
    split, _ = ordered._split(skewed, [], ORDER, [], None)
    sizes = measure(split, [CHUNK])
    assert sizes.total == 10_000 and sizes.largest < 5_000


def test_small_keys_keep_the_plain_window(skewed):
    plan = ranked(skewed, ["k"], ORDER)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Join" not in plan


def test_chunked_plan_shuffles_rows_once(skewed):
    plan = ranked(skewed, ["k"], ORDER, hot_rows=100)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "NestedLoopJoin" not in plan
    assert "SinglePartition" not in plan


def test_empty_table(skewed):
    none = skewed.where("event_id < 0")
    assert ranked(none, [], ORDER).isEmpty()
    assert ranked(none, ["k"], ORDER, hot_rows=5).isEmpty()


def test_first_rows_are_pruned_before_the_shuffle(skewed):
    plan = first_rows(skewed, ["k"], ORDER, 5)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 4


@pytest.mark.parametrize("n", [1, 100])
def test_first_rows_of_one_key_over_many_splits(spark, n):
    """What reaches the task of a key is bounded by the salts, not by the splits that hold it."""
    one = spark.range(0, 64_000, 1, 64).selectExpr("1 AS k", "hash(id) AS ts", "id AS event_id")
    assert ordered.first_by_salt(one, ["k"], ORDER, n).count() == ordered.SALTS * n
    by_order = Window.partitionBy("k").orderBy(*ORDER)
    want = one.withColumn("n", F.row_number().over(by_order).cast("bigint")).where(F.col("n") <= n)
    assert same(first_rows(one, ["k"], ORDER, n), want)


def test_first_rows_beyond_the_pruned_rank(skewed):
    got = first_rows(skewed, ["k"], ORDER, 1500, hot_rows=100)
    by_order = Window.partitionBy("k").orderBy(*ORDER)
    want = skewed.withColumn("n", F.row_number().over(by_order).cast("bigint")).where("n <= 1500")
    assert same(got, want)


@pytest.mark.parametrize("hot_rows", [60, 2500])
def test_a_table_without_a_key_is_cut_in_two_levels(skewed, monkeypatch, hot_rows):
    """Few cuts of the whole, however many rows: chunks above the limit are cut once more."""
    monkeypatch.setattr(ordered, "MOST_CHUNKS", 6)
    split, ends = ordered._split(skewed, [], ORDER, [], hot_rows)
    assert ordered._chunks(ends) <= 16 and measure(split, [CHUNK]).largest > 500
    one = F.lit(1).cast("bigint")
    got = running(skewed, [], ORDER, {"n": ("sum", one), "low": ("min", F.col("value"))},
                  {"before": F.col("event_type")}, hot_rows=hot_rows)
    by_order = Window.orderBy(*ORDER)
    so_far = by_order.rowsBetween(Window.unboundedPreceding, 0)
    want = skewed.withColumns({"n": F.sum(one).over(so_far), "low": F.min("value").over(so_far),
                               "before": F.lag("event_type").over(by_order)})
    assert same(got, want)
