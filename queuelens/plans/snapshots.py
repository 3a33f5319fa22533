"""Histogram snapshots: count, extremes, mean, deviation and exact quantiles.

Small groups use the built-in exact percentile. It keeps every distinct value of
a group in one task, so larger groups go another way: rows are counted in cells of
equal width, and only the few cells that hold a wanted rank are looked at value by
value. That reads the value column a few times but shuffles next to nothing.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from queuelens.plans.hotkeys import HOT_ROWS, hot_keys, measure
from queuelens.plans.joins import broadcast_if_small, join_on_key, with_key_values
from queuelens.plans.ordered import running
from queuelens.session import cut_lineage

# The quantiles a histogram snapshot reports (fixed values).
QUANTILES = {"p50": 0.5, "p75": 0.75, "p95": 0.95, "p98": 0.98, "p99": 0.99, "p999": 0.999}
BASICS = ("n", "min", "max", "mean", "stddev")

# Cells per group; also the most rows a window over the cells of a group sees.
CELLS = 4096
# The built-in percentile holds a hash table entry per value, so it is kept to smaller
# groups than a window, which can spill.
PERCENTILE_ROWS = 100_000
COUNT, CELL = "__count", "__cell"


def _percentile_rows(df: DataFrame, hot_rows: int | None) -> int:
    """Rows of a group above which it is not left to the built-in percentile."""
    named = df.sparkSession.conf.get(HOT_ROWS, None)
    return hot_rows or min(PERCENTILE_ROWS, int(named or PERCENTILE_ROWS))


def basic_statistics(value: str) -> list[Column]:
    return [
        F.count(value).alias("n"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
        F.avg(value).alias("mean"),
        F.stddev_samp(value).alias("stddev"),
    ]


def _levels(quantiles: Mapping[str, float]) -> Column:
    return F.array(*[F.lit(q) for q in quantiles.values()])


def _named(quantiles: Mapping[str, float]) -> list[Column]:
    return [F.col("__q")[i].cast("double").alias(name) for i, name in enumerate(quantiles)]


def _one_pass(df: DataFrame, key: list[str], value: str, quantiles: Mapping[str, float],
              approx: bool) -> DataFrame:
    levels = _levels(quantiles)
    ranks = F.percentile_approx(value, levels, 10_000) if approx else F.percentile(value, levels)
    summary = df.groupBy(*key).agg(*basic_statistics(value), ranks.alias("__q"))
    return summary.select(*key, *BASICS, *_named(quantiles))


def value_counts(df: DataFrame, key: Sequence[str], value: str) -> DataFrame:
    """Rows per key and distinct value, written once for the passes that follow."""
    counted = df.where(F.col(value).isNotNull()).groupBy(*key, value)
    return cut_lineage(counted.agg(F.count("*").alias(COUNT)))


def _whole(rows: DataFrame, key: list[str], value: str, extra: Mapping[str, Column]) -> DataFrame:
    """One row per key: count, extremes, mean and the extra aggregates."""
    n, total = F.sum(COUNT), F.sum(F.col(value).cast("double") * F.col(COUNT))
    return cut_lineage(rows.groupBy(*key).agg(
        n.alias("n"), F.min(value).alias("min"), F.max(value).alias("max"),
        (total / F.nullif(n, F.lit(0).cast("bigint"))).alias("mean"),
        *[column.alias(name) for name, column in extra.items()],
    ))


def _squares(value: str) -> Column:
    gap = F.col(value).cast("double") - F.col("mean")
    return F.sum(gap * gap * F.col(COUNT))


def _deviation(squares: Column) -> Column:
    return F.when(F.col("n") > 1, F.sqrt(squares / (F.col("n") - 1)))


def _by_cells(rows: DataFrame, key: list[str], value: str, quantiles: Mapping[str, float],
              extra: Mapping[str, Column], hot_rows: int | None) -> DataFrame:
    """The snapshot of rows with a ``COUNT``, for groups of any size."""
    whole = _whole(rows, key, value, extra)
    low, span = F.col("min").cast("double"), F.col("max").cast("double") - F.col("min")
    # The cell never falls as the value grows, which is all that exactness needs.
    cell = F.when(span > 0, F.floor((F.col(value).cast("double") - low) / span * CELLS))
    placed = with_key_values(rows, whole.select(*key, "n", "min", "max", "mean"), key)
    placed = placed.withColumn(CELL, F.coalesce(cell, F.lit(0)).cast("int"))
    cells = cut_lineage(placed.groupBy(*key, CELL, "n").agg(
        F.sum(COUNT).alias(COUNT), _squares(value).alias("__squares")
    ))

    places = {name: (F.col("n") - 1) * q for name, q in quantiles.items()}
    ranks = [edge(at) for at in places.values() for edge in (F.floor, F.ceil)]
    by_cell = Window.partitionBy(*key).orderBy(CELL)
    upto = cells.withColumn("__upto", F.sum(COUNT).over(by_cell))
    before = F.col("__upto") - F.col(COUNT)
    holds_a_rank = F.exists(
        F.array(*ranks), lambda rank: (before <= rank) & (rank < F.col("__upto"))
    )
    wanted = upto.where(holds_a_rank).select(*key, CELL, before.alias("__before"))
    wanted = broadcast_if_small(cut_lineage(wanted))
    few = join_on_key(placed, wanted, [*key, CELL], "inner")
    values = cut_lineage(
        few.groupBy(*key, CELL, "__before", "n", value).agg(F.sum(COUNT).alias(COUNT))
    )
    seen = running(values, [*key, CELL], [value], {"__seen": ("sum", F.col(COUNT))},
                   hot_rows=hot_rows)

    def value_at(rank: Column) -> Column:
        """The value whose rows cover the 0-based position ``rank``."""
        covered = F.col("__before") + F.col("__seen") > rank
        return F.min(F.when(covered, F.col(value))).cast("double")

    found = seen.groupBy(*key).agg(
        *[value_at(F.floor(at)).alias(f"__lo_{name}") for name, at in places.items()],
        *[value_at(F.ceil(at)).alias(f"__hi_{name}") for name, at in places.items()],
    )
    spread = cells.groupBy(*key).agg(F.sum("__squares").alias("__squares"))
    parts = with_key_values(found, spread, key)
    joined = join_on_key(whole, parts, key, "left") if key else with_key_values(whole, parts, key)
    between = {
        name: F.col(f"__lo_{name}")
        + (F.col(f"__hi_{name}") - F.col(f"__lo_{name}")) * (at - F.floor(at))
        for name, at in places.items()
    }
    return joined.withColumns(between | {"stddev": _deviation(F.col("__squares"))}).select(
        *key, *BASICS, *quantiles, *extra
    )


def snapshot_of_counts(counts: DataFrame, key: Sequence[str], value: str,
                       quantiles: Mapping[str, float] = QUANTILES,
                       extra: Mapping[str, Column] | None = None,
                       hot_rows: int | None = None) -> DataFrame:
    """The snapshot of each key from its value counts.

    ``extra`` holds further aggregates over the value and ``COUNT`` columns.
    """
    key, extra = list(key), dict(extra or {})
    if measure(counts, key, _percentile_rows(counts, hot_rows)).has_hot_keys:
        return _by_cells(counts, key, value, quantiles, extra, hot_rows)
    whole = _whole(counts, key, value, extra)
    rows = with_key_values(counts, whole.select(*key, "n", "mean"), key)
    ranks = F.percentile(value, _levels(quantiles), F.col(COUNT))
    found = rows.groupBy(*key, "n").agg(_squares(value).alias("__squares"), ranks.alias("__q"))
    found = found.select(*key, _deviation(F.col("__squares")).alias("stddev"), *_named(quantiles))
    return with_key_values(found, whole, key).select(*key, *BASICS, *quantiles, *extra)


def snapshot(df: DataFrame, key: Sequence[str], value: str,
             quantiles: Mapping[str, float] = QUANTILES, approx: bool = False,
             hot_rows: int | None = None) -> DataFrame:
    """Count, min, max, mean, sample deviation and quantiles of ``value`` per key.

    Quantiles are exact and interpolated; ``approx`` asks for bounded sketches.
    An empty ``key`` summarises all rows.
    """
    key = list(key)
    df = df.select(*key, value)
    if approx:
        return _one_pass(df, key, value, quantiles, approx=True)
    # A null counts nothing. Filtering it out would compute the value twice per row.
    counted = df.withColumn(COUNT, F.col(value).isNotNull().cast("bigint"))
    sizes = measure(counted, key, _percentile_rows(df, hot_rows))
    if not sizes.has_hot_keys:
        return _one_pass(df, key, value, quantiles, approx=False)
    if not key:
        return _by_cells(counted, key, value, quantiles, {}, hot_rows)
    hot = broadcast_if_small(cut_lineage(hot_keys(counted, key, sizes.limit)))
    split = _by_cells(
        join_on_key(counted, hot, key, "left_semi"), key, value, quantiles, {}, hot_rows
    )
    rest = join_on_key(df, hot, key, "left_anti")
    return _one_pass(rest, key, value, quantiles, approx=False).unionByName(split)
