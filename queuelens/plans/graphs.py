"""Strongly connected components of a directed graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from queuelens.session import cut_lineage


def _trimmed(edges: DataFrame) -> DataFrame:
    """``edges`` without those whose start has no way in or whose end has no way out, again and again."""
    before = edges.count()
    while before:
        inner = edges.select(F.col("b").alias("a")).distinct()
        outer = edges.select(F.col("a").alias("b")).distinct()
        edges = cut_lineage(edges.join(inner, "a", "left_semi").join(outer, "b", "left_semi").select("a", "b"))
        now = edges.count()
        if now == before:
            break
        before = now
    return edges


def _reached(edges: DataFrame, labels: DataFrame) -> DataFrame:
    """(node, label): the greatest label from which edges lead to each node, its own included.

    Nodes may start without a label, as null.
    """
    while True:
        moved = edges.join(labels, F.col("a") == F.col("node")).groupBy(F.col("b").alias("node")).agg(
            F.max("label").alias("__label"))
        grown = cut_lineage(labels.join(moved, "node", "left").select(
            "node", "label", F.greatest("label", "__label").alias("__new")))
        done = grown.where(~F.col("__new").eqNullSafe(F.col("label"))).isEmpty()
        labels = grown.select("node", F.col("__new").alias("label"))
        if done:
            return labels


def strongly_connected(edges: DataFrame) -> DataFrame:
    """(node, part) of every node of ``edges`` (a, b of one orderable type) that lies on a cycle.

    Nodes are of one part if each reaches the other; the part is named by its greatest node.
    Nodes on no cycle are trimmed away. Then every node takes the greatest node that
    reaches it. A node that kept its own name is the root of a part: what reaches back to it
    among the nodes of that name is the part, which is taken out, and the rest goes round again.
    Loops from a node to itself are cycles.
    """
    pairs = cut_lineage(edges.where(F.col("a").isNotNull() & F.col("b").isNotNull()).select("a", "b").distinct())
    loops = pairs.where(F.col("a") == F.col("b")).select(F.col("a").alias("node"), F.col("a").alias("part"))
    left, parts = _trimmed(pairs.where(F.col("a") != F.col("b"))), None
    while not left.isEmpty():
        nodes = left.select(F.col("a").alias("node")).distinct()
        colour = _reached(left, nodes.withColumn("label", F.col("node")))
        named = colour.withColumnRenamed("label", "part")
        inside = left.join(named.select(F.col("node").alias("a"), F.col("part").alias("__pa")), "a").join(
            named.select(F.col("node").alias("b"), F.col("part").alias("__pb")), "b").where("__pa = __pb")
        back = cut_lineage(inside.select(F.col("b").alias("a"), F.col("a").alias("b")))
        roots = named.select("node", F.when(F.col("node") == F.col("part"), F.col("part")).alias("label"))
        found = _reached(back, roots).where(F.col("label").isNotNull()).withColumnRenamed("label", "part")
        found = cut_lineage(found)
        parts = found if parts is None else parts.unionByName(found)
        left = _trimmed(cut_lineage(
            left.join(found.select(F.col("node").alias("a")), "a", "left_anti")
            .join(found.select(F.col("node").alias("b")), "b", "left_anti").select("a", "b")))
    if parts is None:
        return loops
    return parts.unionByName(loops.join(parts.select("node"), "node", "left_anti"))
