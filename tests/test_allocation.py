import random

import pytest
from pyspark.sql import functions as F

from queuelens.operators import allocation
from tests.helpers import rows


@pytest.fixture(scope="module")
def requests(spark):
    rng = random.Random(3)
    data = [(None if i % 3 == 0 else i % 7, rng.random(), i, rng.randint(1, 5)) for i in range(3000)]
    return spark.createDataFrame(data, "pool INT, at DOUBLE, id INT, q INT").cache()


def by_pool(requests):
    pools = {}
    for r in sorted(requests.collect(), key=lambda r: (r["at"], r.id)):
        pools.setdefault(r.pool, []).append(r)
    return pools


@pytest.mark.parametrize("stock", [0, 1, 40, 400, 1200])
@pytest.mark.parametrize("hot_rows", [None, 60])
def test_first_come_first_served(requests, stock, hot_rows):
    granted = allocation.allocate_fcfs(requests, ["pool"], ["at", "id"], stock, hot_rows)
    want = {r.id: i < stock for pool in by_pool(requests).values() for i, r in enumerate(pool)}
    assert dict(rows(granted, "id", "granted")) == want


def test_only_granted(requests):
    granted = allocation.granted_requests(requests, ["pool"], ["at", "id"], 40)
    assert granted.count() == 40 * 8
    assert granted.agg(F.max("turn")).first()[0] == 40


@pytest.mark.parametrize("hot_rows", [None, 60])
def test_quantities_never_exceed_stock(requests, hot_rows):
    got = allocation.allocate_quantity(requests, ["pool"], ["at", "id"], F.col("q"), 333, hot_rows)
    want = {}
    for pool in by_pool(requests).values():
        left = 333
        for r in pool:
            want[r.id] = min(r.q, left)
            left -= want[r.id]
    assert dict(rows(got, "id", "granted")) == want
    totals = got.groupBy("pool").agg(F.sum("granted").alias("sold"))
    assert totals.where("sold <> 333").isEmpty()


def test_round_robin_is_even_and_in_order(requests):
    got = allocation.assign_round_robin(requests, ["at", "id"], 7)
    sellers = [r.seller for r in got.orderBy("at", "id").collect()]
    assert sellers == [i % 7 for i in range(3000)]
