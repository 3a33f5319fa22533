"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from queuelens.llm.frames import kept


def _digest(edges: DataFrame) -> tuple[int, int]:
    """Count and a hash of the whole edge set that does not depend on its order."""
    row = edges.agg(F.count("*"), F.coalesce(F.bit_xor(F.xxhash64("a", "b")), F.lit(0))).first()
    return row[0], row[1]


def _to_smallest(links: DataFrame, upward: bool) -> DataFrame:
    """Neighbours ``b`` of every ``a`` linked to the smallest of them instead.

    ``upward`` moves the neighbours above ``a`` to the smallest node among ``a`` and
    its neighbours; otherwise ``a`` and all its (smaller) neighbours move.
    """
    smallest = links.groupBy("a").agg(F.min("b").alias("m"))
    if upward:
        moved = links.where(F.col("b") > F.col("a")).join(smallest, "a").select(
            F.col("b").alias("a"), F.least("a", "m").alias("b"))
    else:
        moved = links.join(smallest, "a").select(
            F.explode(F.array(F.struct(F.col("a"), F.col("m").alias("b")),
                              F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")
        ).select("e.*")
    return moved.where("a <> b").distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a bigint, b bigint) but the roots.

    The root is the smallest node of a component. Alternating star contractions: each
    round links all larger neighbours of a node to the smallest node in reach, then
    all smaller ones, until only stars are left. Minima are formed before the
    shuffle, and the joins are ones whose skewed partitions Spark splits.
    """
    links = kept(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(), "edges")
    before = _digest(links)
    while before[0]:
        both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        links = kept(_to_smallest(_to_smallest(both, True), False), "edges")
        now = _digest(links)
        if now == before:
            break
        before = now
    return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
