"""Results that follow from the demos' own sizes: 10 writers, 10,000 tickets, 3 slots."""

import pytest
from pyspark.sql import functions as F

from queuelens.operators import allocation, buffers, counting, measures, ordering, routing, triggers
from queuelens.sources.schemas import REGISTRY, REQUESTS
from tests.helpers import at, rows


def test_ten_writers_count_to_100_000(spark):
    increments = spark.range(100_000).select((F.col("id") % 10).alias("thread"), "id")
    assert rows(counting.total_count(increments)) == [(100_000,)]
    assert counting.total_count(increments, ["thread"]).where("n <> 10000").isEmpty()
    counted = counting.running_count(increments, ["id"])
    assert counted.where("running_count <> id + 1").isEmpty()


def test_lost_updates_are_reported(spark):
    expected = spark.range(20).select((F.col("id") % 2).alias("k"))
    actual = spark.range(13).select((F.col("id") % 3).alias("k"))
    assert rows(counting.count_reconcile(expected, actual, ["k"])) == [
        (0, 10, 5, 5), (1, 10, 4, 6), (2, 0, 4, -4)
    ]


def test_every_ticket_is_sold_once(spark):
    stock = allocation.demo_stock(spark)
    assert stock.where("id = 7").first().label == "票 - 7"
    sold = allocation.assign_round_robin(stock, ["id"], 10)
    audit = allocation.exactly_once_audit(stock, sold.withColumnRenamed("label", "sold"), "label", "sold")
    assert rows(allocation.audit_summary(audit)) == [("once", 10_000)]
    assert rows(allocation.sales_tally(sold)) == [(seller, 1000) for seller in range(10)]


def test_audit_finds_missing_and_duplicates(spark):
    stock = spark.createDataFrame([(1,), (2,), (3,)], "item INT")
    sales = spark.createDataFrame([(1,), (3,), (3,), (9,), (None,)], "sold INT")
    audit = allocation.exactly_once_audit(stock, sales, "item", "sold")
    assert rows(audit) == [
        (None, 1, "unknown"), (1, 1, "once"), (2, 0, "missing"), (3, 2, "duplicate"), (9, 1, "unknown")]


@pytest.mark.parametrize("gets, left", [(9, 1), (8, 2)])
def test_three_slots(spark, gets, left):
    log = [("b", at(i), i, "put") for i in range(10)]
    log += [("b", at(100 + i), 100 + i, "get") for i in range(gets)]
    df = spark.createDataFrame(log, "k STRING, ts TIMESTAMP_NTZ, event_id INT, op STRING")
    assert buffers.fifo_match(df, ["k"]).count() == gets
    assert rows(buffers.buffer_leftover(df, ["k"], 3)) == [("b", 10, gets, left, 0, 0)]
    puts = buffers.blocked_puts(df, ["k"], 3)
    assert puts.where("admitted_at IS NULL").isEmpty()
    assert rows(puts.where("n > 3").select("n", "blocked_ms"))[0] == (10, 97_000)
    state = buffers.buffer_state(df, ["k"], 3)
    assert state.agg(F.max("stored"), F.max("blocked_producers")).first() == (3, 7)


def test_gate_opens_at_five(spark):
    df = spark.createDataFrame(
        [("t", at(i), i) for i in range(1, 11)] + [("u", at(i), i) for i in range(1, 4)],
        "k STRING, ts TIMESTAMP_NTZ, event_id INT",
    )
    order = ["ts", "event_id"]
    assert rows(triggers.nth_event(df, ["k"], order, 5), "event_id") == [(5,)]
    passed = rows(triggers.threshold_gate(df, ["k"], order, 5), "event_id")
    assert sorted(passed) == [(i,) for i in range(5, 11)]
    delays = rows(triggers.gate_delay(df, ["k"], "ts", "event_id", 5), "k", "reached_ts", "delay_ms")
    assert delays == [("t", at(5), 4000), ("u", None, None)]


def test_two_fair_threads_take_turns(spark):
    df = spark.range(20).select((F.col("id") / 10).cast("int").alias("thread"), "id")
    turns = ordering.fair_interleave(df, ["thread"], ["id"]).orderBy("turn", "thread")
    assert [r.thread for r in turns.collect()] == [0, 1] * 10
    assert ordering.fair_quota(df, ["thread"], ["id"], 10).count() == 20
    assert ordering.fair_quota(df, ["thread"], ["id"], 4).count() == 8


def test_each_thread_sees_its_own_name(spark):
    owners = spark.createDataFrame([("main",), ("t1",), ("t2",)], "owner STRING")
    sets = spark.createDataFrame(
        [("t1", 1, "x"), ("t1", 2, "李四"), ("t2", 3, "王五")], "who STRING, at INT, username STRING"
    )
    latest = ordering.latest_per_key(owners, sets, "owner", "who", F.col("username"), ["at"])
    assert rows(latest) == [("main", "张三", True), ("t1", "李四", False), ("t2", "王五", False)]


@pytest.mark.parametrize("hot_rows", [None, 1])
def test_opposite_lock_order_is_one_inversion(spark, hot_rows):
    trace = spark.createDataFrame(
        [(1, 1, "String"), (1, 2, "Integer"), (2, 1, "Integer"), (2, 2, "String"), (2, 3, "String")],
        "trace INT, seq INT, resource STRING",
    )
    edges = ordering.lock_order_edges(trace, ["trace"], ["seq"], "resource", hot_rows)
    assert rows(edges) == [("Integer", "String", 1), ("String", "Integer", 1)]
    assert rows(ordering.lock_order_inversion(edges)) == [("Integer", "String", 1, 1)]


def test_dealer_adds_two_and_sells_oil(spark):
    car = spark.createDataFrame([("car", 10)], "product STRING, price INT")
    sold = measures.stacked_adjustment(car, ["product"], F.col("price"), [2], {"oil": 5})
    assert rows(sold) == [("car", 1, 10, 12, 5)]
    twice = measures.stacked_adjustment(car, ["product"], F.col("price"), [2, 2], {"oil": 5})
    assert twice.first().adjusted_total == 14


def test_observed_stage_counts_rows(spark):
    out, before, after = measures.observed_stage(spark.range(100), lambda df: df.where("id < 30"))
    assert out.count() == 30
    assert (before.get["rows"], after.get["rows"]) == (100, 30)


def test_greeting_is_routed(spark):
    registry = spark.createDataFrame(
        [("GreetingService", "OldGreeting", 1, "greeting", ["String"]),
         ("GreetingService", "Greeting", 2, "greeting", ["String"])], REGISTRY
    )
    requests = spark.createDataFrame(
        [("GreetingService", "greeting", ["String"], ["juno"]), ("Missing", "greeting", [], ["bob"])],
        REQUESTS,
    )
    bodies = {"Greeting": F.concat(F.lit(routing.GREETING), F.get("args", F.lit(0)))}
    routed = routing.route_requests(requests, registry, bodies)
    assert rows(routed, "impl", "result", "error") == [
        (None, None, "Missing not found"), ("Greeting", "hello juno", None)
    ]
    assert rows(routing.dead_letters(requests, registry), "service", "error") == [
        ("Missing", "Missing not found")
    ]


def test_large_registry_is_not_broadcast(spark):
    none = F.array().cast("array<string>")
    registry = spark.range(300_000).select(
        F.col("id").cast("string").alias("service"), F.lit("x").alias("impl"),
        F.lit(1).alias("seq"), F.lit("m").alias("method"), none.alias("param_types"),
    )
    requests = spark.createDataFrame([("7", "m"), ("-1", "m")], "service STRING, method STRING")
    requests = requests.withColumns({"param_types": none, "args": none})
    routed = routing.route_requests(requests, registry, {"x": F.lit("a")})
    assert "broadcast" not in routed._jdf.queryExecution().analyzed().toString().lower()
    assert rows(routed, "service", "impl") == [("-1", None), ("7", "x")]
