"""Lock-order analysis, fair turns and latest values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from queuelens.plans.graphs import strongly_connected
from queuelens.plans.ordered import first_rows, ranked, running

# Name of an owner that never set one (fixed value).
DEFAULT_USERNAME = "张三"


def lock_order_edges(df: DataFrame, trace: Sequence[str], order: Sequence[str], resource: str,
                     hot_rows: int | None = None) -> DataFrame:
    """Directed pairs of different resources that follow each other in a trace, with counts."""
    narrow = df.select(*dict.fromkeys([*trace, *order, resource]))
    steps = running(narrow, trace, order, previous={"held": F.col(resource)}, hot_rows=hot_rows)
    changed = steps.where(F.col("held").isNotNull() & (F.col("held") != F.col(resource)))
    return changed.groupBy("held", F.col(resource).alias("wanted")).agg(F.count("*").alias("n"))


def lock_order_inversion(edges: DataFrame) -> DataFrame:
    """Pairs of resources taken in both orders, with the count of each direction."""
    forward = F.col("held") < F.col("wanted")
    first, second = F.least("held", "wanted"), F.greatest("held", "wanted")
    return (
        edges.groupBy(first.alias("first"), second.alias("second"))
        .agg(
            F.sum(F.when(forward, F.col("n"))).alias("n_forward"),
            F.sum(F.when(~forward, F.col("n"))).alias("n_backward"),
        )
        .where(F.col("n_forward").isNotNull() & F.col("n_backward").isNotNull())
    )


def lock_order_cycles(edges: DataFrame) -> DataFrame:
    """(resource, cycle, size) of every resource that lies on a cycle of any length.

    Resources that reach each other can deadlock even if no pair of them is taken in both
    orders. ``cycle`` is the greatest of those that reach each other, ``size`` how many they are.
    """
    parts = strongly_connected(edges.select(F.col("held").alias("a"), F.col("wanted").alias("b")))
    sizes = parts.groupBy("part").agg(F.count("*").alias("size"))
    return parts.join(sizes, "part").select(F.col("node").alias("resource"), F.col("part").alias("cycle"), "size")


def fair_interleave(df: DataFrame, key: Sequence[str], order: Sequence[str],
                    hot_rows: int | None = None) -> DataFrame:
    """Every row with its turn; reading by (turn, key) serves all keys fairly.

    Rows are not sorted here: sort by ``turn`` and key where they are written.
    """
    return ranked(df, key, order, "turn", hot_rows)


def fair_quota(df: DataFrame, key: Sequence[str], order: Sequence[str], turns: int,
               hot_rows: int | None = None) -> DataFrame:
    """At most ``turns`` rows per key, with their turn."""
    return first_rows(df, key, order, turns, "turn", hot_rows)


def latest_per_key(owners: DataFrame, sets: DataFrame, owner: str, set_owner: str,
                   value: Column, order: Sequence[str], default: str = DEFAULT_USERNAME
                   ) -> DataFrame:
    """The last value each owner set, or the default where none was."""
    last = sets.groupBy(F.col(set_owner).alias("__owner")).agg(
        F.max_by(value, F.struct(*order)).alias("__value")
    )
    joined = owners.select(owner).join(last, F.col(owner) == F.col("__owner"), "left")
    return joined.select(
        owner,
        F.coalesce(F.col("__value"), F.lit(default)).alias("value"),
        F.col("__value").isNull().alias("defaulted"),
    )
