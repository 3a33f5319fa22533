"""Exact quantiles over all rows up to and including each period, for any number of rows.

Rows are counted per period and value. Values are cut into cells at sampled edges, and the
counts of all cells, summed along the periods, say in which cell each wanted rank lies. Every
cell then answers its own questions of the form "the k-th smallest value among the rows up to
period p" with a wavelet matrix: rows in the order of periods, sorted stably by one bit of the
value's rank after the other, so that all questions follow the bits down together.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from queuelens.plans.joins import broadcast_if_small, join_on_key
from queuelens.plans.ordered import ranked, running
from queuelens.session import cut_lineage

# Rows of (period, value, count) that a cell should hold, and bounds on the number of cells.
CELL_ROWS, FEWEST_CELLS, MOST_CELLS = 1_000_000, 64, 65_536
# Counts of (period, cell) laid out by one task.
LAID_OUT = 2_000_000


def kth_in_prefix(codes: np.ndarray, weights: np.ndarray, ends: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """For each question, the code at 0-based position ``rank`` of the first ``end`` codes in sorted order.

    A code counts ``weight`` times.
    """
    low, high, left = np.zeros(len(ends), np.int64), ends.copy(), ranks.copy()
    answer = np.zeros(len(ends), np.int64)
    for bit in reversed(range(int(codes.max(initial=0)).bit_length())):
        zero = codes >> bit & 1 == 0
        places = np.append(0, np.cumsum(zero))
        weight = np.append(0, np.cumsum(np.where(zero, weights, 0)))
        below = weight[high] - weight[low]
        above = left >= below
        low, high = (np.where(above, places[-1] + x - places[x], places[x]) for x in (low, high))
        left = np.where(above, left - below, left)
        answer |= above.astype(np.int64) << bit
        order = np.concatenate([np.flatnonzero(zero), np.flatnonzero(~zero)])
        codes, weights = codes[order], weights[order]
    return answer


def _edges(counts: DataFrame, value: str, cells: int) -> np.ndarray:
    """About ``cells`` distinct values, picked by their hash, in ascending order."""
    rate = max(1, -(-counts.count() // cells))
    picked = counts.where(F.pmod(F.xxhash64(value), F.lit(rate)) == 0).select(value).distinct()
    return np.sort(picked.toPandas()[value].to_numpy())


def _with_cell(counts: DataFrame, value: str, edges: np.ndarray) -> DataFrame:
    shared = counts.sparkSession.sparkContext.broadcast(edges)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell = np.searchsorted(shared.value, batch.column(value).to_numpy(), "right")
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(cell, pa.int32())], names=[*batch.schema.names, "cell"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in counts.schema)
    return counts.mapInArrow(place, f"{schema}, cell int")


def _questions(by_cell: DataFrame, periods: int, cells: int, quantiles: Mapping[str, float]) -> DataFrame:
    """(period, j, cell, rank): in which cell each wanted rank of each period lies, and where there.

    Wanted are the ranks below (even j) and above (odd j) the place of each quantile.
    """
    together = max(1, LAID_OUT // cells)
    chunks = -(-periods // together)
    chunk = F.floor(F.col("period") / together).alias("chunk")
    own = by_cell.select(chunk, "period", "cell", "n")
    # What all earlier chunks hold comes in as a row per chunk and cell.
    sums = own.groupBy("chunk", "cell").agg(F.sum("n").alias("n"))
    grid = by_cell.sparkSession.range(chunks).select(
        F.col("id").alias("chunk"), F.explode(F.sequence(F.lit(0), F.lit(cells - 1))).alias("cell"))
    earlier = Window.partitionBy("cell").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    carried = grid.join(sums, ["chunk", "cell"], "left").select(
        "chunk", F.lit(-1).cast("bigint").alias("period"), "cell", F.sum("n").over(earlier).alias("n"),
    ).where("n IS NOT NULL")
    levels = list(quantiles.values())

    def locate(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        period, cell, n = (table.column(c).to_numpy() for c in ("period", "cell", "n"))
        mine = period >= 0
        active, row = np.unique(period[mine], return_inverse=True)
        laid = np.zeros((len(active) + 1, cells), np.int64)
        np.add.at(laid, (np.zeros(int((~mine).sum()), np.int64), cell[~mine]), n[~mine])
        np.add.at(laid, (row + 1, cell[mine]), n[mine])
        upto = np.cumsum(np.cumsum(laid, axis=0)[1:], axis=1)
        total = upto[:, -1]
        out = []
        for j, (level, edge) in enumerate((q, e) for q in levels for e in (np.floor, np.ceil)):
            rank = edge((total - 1) * level).astype(np.int64)
            of = (upto <= rank[:, None]).sum(axis=1)
            before = np.where(of > 0, np.take_along_axis(upto, np.maximum(of - 1, 0)[:, None], 1)[:, 0], 0)
            out.append((active, np.full(len(active), j), of, rank - before))
        period, j, cell, rank = (np.concatenate(c) for c in zip(*out))
        return pa.table({"period": period, "j": pa.array(j, pa.int32()),
                         "cell": pa.array(cell, pa.int32()), "rank": rank})

    return own.unionByName(carried).groupBy("chunk").applyInArrow(
        locate, "period bigint, j int, cell int, rank bigint")


def prefix_quantiles(df: DataFrame, period: str, value: str, quantiles: Mapping[str, float]) -> DataFrame:
    """(period, one column per quantile): exact, interpolated, over all rows up to each period.

    Only periods with a value that is not null get a row.
    """
    counts = cut_lineage(df.where(F.col(value).isNotNull()).groupBy(period, value).agg(F.count("*").alias("n")))
    periods = cut_lineage(ranked(counts.select(period).distinct(), [], [period], "__number"))
    n_periods = periods.count()
    numbered = join_on_key(counts, broadcast_if_small(periods), [period], "inner").select(
        (F.col("__number") - 1).alias("period"), value, "n")
    edges = _edges(counts, value, min(MOST_CELLS, max(FEWEST_CELLS, counts.count() // CELL_ROWS)))
    placed = cut_lineage(_with_cell(numbered, value, edges))
    by_cell = placed.groupBy("period", "cell").agg(F.sum("n").alias("n"))
    asked = cut_lineage(_questions(by_cell, n_periods, len(edges) + 1, quantiles))
    kind = df.schema[value].dataType.simpleString()

    def answer(key: tuple[pa.Scalar, ...], held: pa.Table, questions: pa.Table) -> pa.Table:
        order = np.argsort(held.column("period").to_numpy(), kind="stable")
        values, codes = np.unique(held.column(value).to_numpy()[order], return_inverse=True)
        ends = np.searchsorted(held.column("period").to_numpy()[order], questions.column("period").to_numpy(), "right")
        found = kth_in_prefix(codes, held.column("n").to_numpy()[order], ends, questions.column("rank").to_numpy())
        return pa.table({"period": questions.column("period"), "j": questions.column("j"),
                         value: values[found] if len(values) else values})

    # Cells without a question are not shuffled.
    wanted = broadcast_if_small(asked.select("cell").distinct())
    found = placed.join(wanted, "cell", "left_semi").groupBy("cell").cogroup(asked.groupBy("cell")).applyInArrow(
        answer, f"period bigint, j int, `{value}` {kind}")
    at = {j: F.max(F.when(F.col("j") == j, F.col(value))).cast("double") for j in range(2 * len(quantiles))}
    edges_of = found.groupBy("period").agg(*[c.alias(f"__{j}") for j, c in at.items()])
    rows = cut_lineage(numbered.groupBy("period").agg(F.sum("n").alias("__own")))
    whole = cut_lineage(running(rows, [], ["period"], {"n": ("sum", F.col("__own"))}).select("period", "n"))
    joined = edges_of.join(broadcast_if_small(whole), "period")
    share = {name: (F.col("n") - 1) * q - F.floor((F.col("n") - 1) * q) for name, q in quantiles.items()}
    result = joined.select("period", *[
        (F.col(f"__{2 * i}") + (F.col(f"__{2 * i + 1}") - F.col(f"__{2 * i}")) * share[name]).alias(name)
        for i, name in enumerate(quantiles)])
    names = periods.select(F.col(period).alias("__start"), (F.col("__number") - 1).alias("period"))
    return result.join(broadcast_if_small(names), "period").select(F.col("__start").alias(period), *quantiles)
