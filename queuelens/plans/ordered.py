"""Ordered calculations per key that no single key can push into one task.

``running`` is a window of the form (partition by key, order by ...) that stays
parallel when one key holds a large share of the rows. A key above the limit is
cut into consecutive chunks of its own order. Each chunk is scanned on its own,
and what earlier chunks add up to is carried in from a small per-chunk table.
Only narrow, map-side reduced passes come on top of the one shuffle that the
window needs anyway.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from queuelens.plans.hotkeys import hot_keys, hot_rows_of, measure
from queuelens.plans.joins import broadcast_if_small, join_on_key
from queuelens.session import cut_lineage

# Candidate cut points per chunk; every OVERSAMPLE-th one is used, which evens out chunk sizes.
OVERSAMPLE = 8
# A table counted to be this small is scanned in one task.
ONE_TASK_ROWS = 1000
# Spark limits the rows per key before the shuffle only up to this rank.
PRUNED_RANK = 1000
# Into so many chunks a table without a key is cut at most; larger ones are cut again.
MOST_CHUNKS = 4096
# Parts of a key whose first rows are found on their own.
SALTS = 16

CHUNK, CUTS, SPLIT, POSITION = "__chunk", "__cuts", "__split", "__position"


def _cut_rows(df: DataFrame, key: list[str], order: list[str], kept: list[str],
              limit: int) -> tuple[DataFrame, int]:
    """Per key, the sorted rows that end its chunks; and the most that a key has.

    Candidates are picked by a hash of the order columns, so every pass over the
    data sees the same ones. About ``total / limit`` survive.
    """
    rate = max(1, limit // OVERSAMPLE)
    picked = (
        df.where(F.pmod(F.xxhash64(*order), F.lit(rate)) == 0)
        .select(*dict.fromkeys(key + order + kept))
        .dropDuplicates([*key, *order])
    )
    by_key = Window.partitionBy(*key).orderBy(*order)
    step = OVERSAMPLE if rate > 1 else max(1, limit)
    ends = picked.withColumn("__i", F.row_number().over(by_key)).where(F.col("__i") % step == 0)
    sorted_ends = F.array_sort(F.collect_list(F.struct(*dict.fromkeys(order + kept))))
    cuts = ends.groupBy(*key).agg(sorted_ends.alias(CUTS))
    cuts = cut_lineage(cuts)
    return cuts, cuts.agg(F.max(F.size(CUTS))).first()[0] or 0


def _with_position(df: DataFrame, order: list[str], most_cuts: int) -> DataFrame:
    """``df`` with the number of cut rows before each row, by binary search.

    One projection per step keeps the search inside generated code; a lambda over
    the array would be interpreted per row.
    """
    here = F.struct(*order)
    position = F.lit(0)
    for bit in reversed(range(max(1, most_cuts).bit_length())):
        step = 1 << bit
        passed = F.get(F.col(CUTS), position + (step - 1)) < here
        df = df.withColumn(POSITION, position + F.when(passed, step).otherwise(0))
        position = F.col(POSITION)
    return df


def _split(df: DataFrame, key: list[str], order: list[str], kept: list[str],
           hot_rows: int | None) -> tuple[DataFrame, DataFrame] | None:
    """``df`` with a split flag and chunk number, and the rows that end the chunks.

    The chunk is null for keys left whole, which then form one group as usual.
    None if no key has to be split.
    """
    spark = df.sparkSession
    if key:
        sizes = measure(df, key, hot_rows)
        if not sizes.has_hot_keys:
            return None
        hot = broadcast_if_small(cut_lineage(hot_keys(df, key, sizes.limit)))
        hot_part = join_on_key(df, hot, key, "left_semi")
        ends, most = _cut_rows(hot_part, key, order, kept, sizes.limit)
    else:
        total = df.count()
        if total <= ONE_TASK_ROWS:
            return None
        share = -(-total // spark.sparkContext.defaultParallelism)
        limit = max(1, min(hot_rows_of(spark, hot_rows), share), -(-total // MOST_CHUNKS))
        ends, most = _cut_rows(df, key, order, kept, limit)

    orders_only = F.transform(CUTS, lambda end: F.struct(*[end[o].alias(o) for o in order]))
    cuts = ends.select(*key, orders_only.alias(CUTS))
    with_cuts = (
        join_on_key(df, broadcast_if_small(cuts), key, "left") if key
        else df.withColumn(CUTS, cuts.scalar())
    )
    split = F.col(CUTS).isNotNull()
    chunked = _with_position(with_cuts, order, most).withColumns(
        {SPLIT: split, CHUNK: F.when(split, F.col(POSITION))}
    )
    return chunked.drop(CUTS, POSITION), ends


def _chunks(ends: DataFrame) -> int:
    """The most chunks that a key has been cut into."""
    return (ends.agg(F.max(F.size(CUTS))).first()[0] or 0) + 1


def _add(local: Column, carried: Column) -> Column:
    return F.coalesce(local + carried, local, carried)


# How a value within a chunk is joined with what the earlier chunks carry in.
_COMBINE = {
    "sum": (F.sum, _add),
    "min": (F.min, F.least),
    "max": (F.max, F.greatest),
}


def running(df: DataFrame, key: Sequence[str], order: Sequence[str],
            totals: Mapping[str, tuple[str, Column]] | None = None,
            previous: Mapping[str, Column] | None = None,
            hot_rows: int | None = None) -> DataFrame:
    """Running aggregates and previous values per key, in order.

    ``totals`` maps a new column to ``("sum" | "min" | "max", value)``, taken over
    the rows of the key up to and including the current one. ``previous`` maps a
    new column to a value of the row before. ``order`` must be unique within a
    key. An empty ``key`` means one order over all rows, chunked unless they are few.
    """
    key, order = list(key), list(order)
    totals, previous = dict(totals or {}), dict(previous or {})
    inputs = {f"__in_{n}": v for n, (_, v) in totals.items()}
    inputs |= {f"__in_{n}": v for n, v in previous.items()}
    work = df.withColumns(inputs)
    kept = [f"__in_{n}" for n in previous]

    parts = _split(work, key, order, kept, hot_rows)
    rows, within = (work, key) if parts is None else (parts[0], key + [CHUNK])
    by_order = Window.partitionBy(*within).orderBy(*order)
    so_far = by_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = {n: _COMBINE[fn][0](f"__in_{n}").over(so_far) for n, (fn, _) in totals.items()}
    local |= {n: F.lag(f"__in_{n}").over(by_order) for n in previous}
    if parts is None:
        return rows.withColumns(local).select(*df.columns, *local)

    if not key and _chunks(parts[1]) >= MOST_CHUNKS // 2:
        joined = _within_stretches(rows, order, totals, previous, hot_rows)
    else:
        joined = rows.withColumns(local | {"__row": F.row_number().over(by_order)})
    if totals:
        pieces = rows.where(SPLIT).groupBy(*within).agg(
            *[_COMBINE[fn][0](f"__in_{n}").alias(n) for n, (fn, _) in totals.items()]
        )
        before = (
            Window.partitionBy(*key).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
        )
        carry = pieces.select(*within, *[
            _COMBINE[fn][0](n).over(before).alias(f"__carry_{n}")
            for n, (fn, _) in totals.items()
        ])
        carry = broadcast_if_small(cut_lineage(carry))
        joined = join_on_key(joined, carry, within, "left").withColumns({
            n: _COMBINE[fn][1](F.col(n), F.col(f"__carry_{n}")) for n, (fn, _) in totals.items()
        })
    if previous:
        # The row before the first of a chunk is the one that ended the last chunk.
        ended = parts[1].select(*key, F.posexplode(CUTS).alias("__place", "__end"))
        carry = ended.select(
            *key, (F.col("__place") + 1).alias(CHUNK),
            *[F.col("__end")[f"__in_{n}"].alias(f"__carry_{n}") for n in previous],
        )
        first = F.col("__row") == 1
        joined = join_on_key(joined, broadcast_if_small(carry), within, "left").withColumns({
            n: F.when(first, F.col(f"__carry_{n}")).otherwise(F.col(n)) for n in previous
        })
    return joined.select(*df.columns, *totals, *previous)


def _within_stretches(rows: DataFrame, order: list[str], totals: Mapping[str, tuple[str, Column]],
                      previous: Mapping[str, Column], hot_rows: int | None) -> DataFrame:
    """Running values within each chunk of a whole table, where a chunk may again be too large for a task.

    Chunks are keys here, so the ones above the limit are cut once more.
    """
    stretch = "__stretch"
    stretches = rows.withColumnRenamed(CHUNK, stretch).drop(SPLIT)
    inner = running(
        stretches, [stretch], order,
        {n: (fn, F.col(f"__in_{n}")) for n, (fn, _) in totals.items()} | {"__nth": ("sum", F.lit(1).cast("bigint"))},
        {n: F.col(f"__in_{n}") for n in previous}, hot_rows)
    return inner.withColumnsRenamed({stretch: CHUNK, "__nth": "__row"})


def ranked(df: DataFrame, key: Sequence[str], order: Sequence[str], name: str = "n",
           hot_rows: int | None = None) -> DataFrame:
    """``df`` with the 1-based position of each row within its key."""
    one = F.lit(1).cast("bigint")
    return running(df, key, order, totals={name: ("sum", one)}, hot_rows=hot_rows)


def _first_of(rows: DataFrame, parts: list[str], order: Sequence[str], n: int,
              column: str) -> DataFrame:
    by_order = Window.partitionBy(*parts).orderBy(*order)
    return rows.withColumn(column, F.row_number().over(by_order)).where(F.col(column) <= n)


def first_by_salt(df: DataFrame, key: Sequence[str], order: Sequence[str], n: int) -> DataFrame:
    """The first ``n`` rows of each of ``SALTS`` parts of every key, cut by a hash of the order."""
    salted = df.withColumn("__salt", F.pmod(F.xxhash64(*order), F.lit(SALTS)))
    return _first_of(salted, [*key, "__salt"], order, n, "__place").drop("__salt", "__place")


def first_rows(df: DataFrame, key: Sequence[str], order: Sequence[str], n: int,
               name: str = "n", hot_rows: int | None = None) -> DataFrame:
    """The first ``n`` rows of each key with their position.

    Every task drops what cannot be among the first ``n`` before a shuffle, up to
    ``PRUNED_RANK``. Rows of a key meet in parts first, so that no task gets more than
    ``SALTS * n`` rows of a key however many splits hold it.
    """
    if n > PRUNED_RANK:
        return ranked(df, key, order, name, hot_rows).where(F.col(name) <= n)
    few = first_by_salt(df, key, order, n)
    return _first_of(few, list(key), order, n, name).withColumn(name, F.col(name).cast("bigint"))


def first_of_many(df: DataFrame, key: Sequence[str], order: Sequence[str], n: int, name: str) -> DataFrame:
    """The first ``n`` rows of each key with their position, for any ``n``, pruned before the shuffle.

    A key is cut by hash into so many parts that each holds a small share of its first ``n``
    rows. Parts keep ``PRUNED_RANK`` rows. Should one be full of first rows, which a hash does
    not do unless ``n`` is large, the key is ranked as a whole instead.
    """
    key, order = list(key), list(order)
    if n <= PRUNED_RANK // 2:
        return first_rows(df, key, order, n, name)
    parts = max(SALTS, 4 * -(-n // PRUNED_RANK))
    salted = df.withColumn("__salt", F.pmod(F.xxhash64(*order), F.lit(parts)))
    few = cut_lineage(_first_of(salted, [*key, "__salt"], order, PRUNED_RANK, "__place"))
    first = _first_of(few, key, order, n, name)
    if not first.where(F.col("__place") == PRUNED_RANK).isEmpty():
        return ranked(df, key, order, name).where(F.col(name) <= n)
    return first.withColumn(name, F.col(name).cast("bigint")).drop("__salt", "__place")
