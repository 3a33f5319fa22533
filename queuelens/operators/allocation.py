"""Allocation of limited stock in request order, and audits of what was sold."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from queuelens.operators.triggers import nth_position
from queuelens.plans.joins import join_on_key
from queuelens.plans.ordered import first_rows, ranked, running

# Label of one stock item in the demo stock (fixed value).
TICKET_LABEL = "票 - "


def allocate_fcfs(requests: DataFrame, pool: Sequence[str], order: Sequence[str], stock: int,
                  hot_rows: int | None = None) -> DataFrame:
    """Every request with ``granted``: the first ``stock`` of each pool are.

    Requests are compared with the position of the last grant of their pool, so
    the request table itself is neither ranked nor sorted.
    """
    pool, order = list(pool), list(order)
    if stock < 1:
        return requests.withColumn("granted", F.lit(False))
    last = nth_position(requests, pool, order, stock, "__last", hot_rows)
    joined = join_on_key(requests, last, pool, "left")
    within = F.col("__last").isNull() | (F.struct(*order) <= F.col("__last"))
    return joined.withColumn("granted", within).drop("__last")


def granted_requests(requests: DataFrame, pool: Sequence[str], order: Sequence[str], stock: int,
                     hot_rows: int | None = None) -> DataFrame:
    """Only the granted requests, with their turn within the pool."""
    return first_rows(requests, pool, order, stock, "turn", hot_rows)


def allocate_quantity(requests: DataFrame, pool: Sequence[str], order: Sequence[str],
                      quantity: Column, stock: int, hot_rows: int | None = None) -> DataFrame:
    """Requested and granted quantity per request; the last grant may be partial."""
    asked = requests.withColumn("requested", quantity.cast("bigint"))
    demand = running(asked, pool, order, {"__demand": ("sum", F.col("requested"))},
                     hot_rows=hot_rows)
    left = F.lit(stock).cast("bigint") - (F.col("__demand") - F.col("requested"))
    granted = F.least(F.col("requested"), F.greatest(F.lit(0).cast("bigint"), left))
    return demand.withColumn("granted", granted).drop("__demand")


def assign_round_robin(items: DataFrame, order: Sequence[str], sellers: int,
                       hot_rows: int | None = None) -> DataFrame:
    """Each item assigned to one of ``sellers``, in turn over the whole table."""
    turn = ranked(items, [], order, "__turn", hot_rows)
    seller = F.pmod(F.col("__turn") - 1, F.lit(sellers).cast("bigint"))
    return turn.withColumn("seller", seller).drop("__turn")


def sales_tally(assigned: DataFrame) -> DataFrame:
    """Items sold per seller."""
    return assigned.groupBy("seller").agg(F.count("*").alias("n_sold"))


def demo_stock(spark: SparkSession, size: int = 10_000) -> DataFrame:
    """Numbered stock items with their labels."""
    return spark.range(1, size + 1).select(
        "id", F.concat(F.lit(TICKET_LABEL), F.col("id").cast("string")).alias("label")
    )


def exactly_once_audit(stock: DataFrame, sales: DataFrame, item: str, sold_item: str) -> DataFrame:
    """Per item: how often it was sold, and missing / once / duplicate, or unknown if not in stock.

    Sales are counted per item before the join, which leaves one row per item; sales that
    name no item are one unknown item, null.
    """
    sold = sales.groupBy(F.col(sold_item).alias("__item")).agg(F.count("*").alias("__sold"))
    held = stock.select(item).withColumn("__held", F.lit(True))
    joined = held.join(sold, F.col(item) == F.col("__item"), "full_outer")
    n = F.coalesce(F.col("__sold"), F.lit(0).cast("bigint"))
    status = (F.when(F.col("__held").isNull(), "unknown")
              .when(n == 0, "missing").when(n == 1, "once").otherwise("duplicate"))
    return joined.select(F.coalesce(item, "__item").alias(item), n.alias("n_sold"), status.alias("status"))


def audit_summary(audit: DataFrame) -> DataFrame:
    """Stock items per audit status."""
    return audit.groupBy("status").agg(F.count("*").alias("n_items"))
