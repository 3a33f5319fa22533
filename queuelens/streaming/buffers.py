"""Buffers replayed from a stream of puts and gets that arrive out of order.

A stream closes slices of event time: the rows of a slice wait in the state, and leave it in
order, with the puts and gets of their key within the slice, once the watermark has passed its
end. What the slices before add up to is carried in where the rows are read, from one small row
per key and slice. So no task orders more than a slice of a part of the keys, whatever share of
the stream one key holds.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import LongType, StringType, StructField, StructType

from queuelens.operators.buffers import PUT
from queuelens.plans.joins import broadcast_if_small, join_on_key
from queuelens.plans.ordered import running
from queuelens.session import cut_lineage, keep_state_on_disk
from queuelens.streaming.operators import EXACT_TIMES, _as_instant

# Parts of the keys that wait in the state on their own, per slice.
LANES = 64
# Names in workers cannot begin with an underscore.
SLICE, KEY, MICROS, IS_PUT = "slice", "buffer_key", "buffer_micros", "buffer_put"


def _slice_sorter(row_id: str, id_type, out: StructType) -> StatefulProcessor:
    """Holds the rows of a slice until its end, and passes them on in order with their positions."""
    held = StructType([StructField(KEY, StringType()), StructField(MICROS, LongType()),
                       StructField(row_id, id_type), StructField(IS_PUT, LongType())])
    names = held.fieldNames()

    class Sorter(StatefulProcessor):
        def init(self, handle: StatefulProcessorHandle) -> None:
            self.handle = handle
            self.waiting = handle.getListState("waiting", held)

        def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
            for batch in rows:
                self.waiting.appendList(list(batch[names].itertuples(index=False, name=None)))
            self.handle.registerTimer(int(key[1]) // 1000)
            return iter(())

        def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
            rows = pd.DataFrame(list(self.waiting.get()), columns=names).sort_values([MICROS, row_id])
            self.waiting.clear()
            of_key = rows.groupby(KEY, sort=False)[IS_PUT]
            rows["puts"] = of_key.cumsum()
            rows["gets"] = of_key.cumcount() + 1 - rows["puts"]
            rows[SLICE] = int(key[1])
            yield rows[out.fieldNames()]

        def close(self) -> None:
            pass

    return Sorter()


def stream_positions(log: DataFrame, key: Sequence[str], period: str, lateness: str, ts: str = "ts",
                     row_id: str = "event_id") -> DataFrame:
    """Rows of closed slices, with the puts and gets of their key within the slice, for append mode.

    ``log`` has a column ``op`` as ``buffer_log`` makes it; ``ts`` and ``row_id`` must not be null.
    A slice of ``period`` closes ``lateness`` after its end; rows that come later are dropped and
    counted in the query's progress. ``positions`` turns what is emitted into positions from the start.
    """
    key = list(key)
    keep_state_on_disk(log.sparkSession)
    timed = _as_instant(log, ts).withWatermark(ts, lateness)
    as_text = F.to_json(F.struct(*key), EXACT_TIMES)
    narrow = timed.select(
        ts, as_text.alias(KEY), F.unix_micros(ts).alias(MICROS), row_id,
        (F.col("op") == PUT).cast("bigint").alias(IS_PUT),
        F.pmod(F.xxhash64(as_text), F.lit(LANES)).alias("buffer_lane"),
        F.unix_micros(F.window(ts, period)["end"]).alias(SLICE))
    id_type = log.schema[row_id].dataType
    out = StructType([StructField(KEY, StringType()), StructField(MICROS, LongType()), StructField(row_id, id_type),
                      *[StructField(n, LongType()) for n in (IS_PUT, "puts", "gets", SLICE)]])
    placed = narrow.groupBy("buffer_lane", SLICE).transformWithStateInPandas(
        _slice_sorter(row_id, id_type, out), out, "append", "eventTime")
    back = F.from_json(KEY, log.select(*key).schema, EXACT_TIMES)
    return placed.select(
        back.alias("k"), F.timestamp_micros(MICROS).cast(log.schema[ts].dataType).alias(ts), row_id,
        F.when(F.col(IS_PUT) == 1, PUT).otherwise("get").alias("op"), "puts", "gets", SLICE,
    ).select("k.*", ts, row_id, "op", "puts", "gets", SLICE)


def positions(emitted: DataFrame, key: Sequence[str], hot_rows: int | None = None) -> DataFrame:
    """Emitted rows with the puts and gets of their key since the start, up to and including each.

    Made for ``state_at`` and ``blocked_at``. Rows are neither sorted nor ranked again.
    """
    key = list(key)
    per_slice = emitted.groupBy(*key, SLICE).agg(F.max("puts").alias("__p"), F.max("gets").alias("__g"))
    so_far = running(cut_lineage(per_slice), key, [SLICE], {
        "__puts": ("sum", F.col("__p")), "__gets": ("sum", F.col("__g"))}, hot_rows=hot_rows)
    before = so_far.select(*key, SLICE, (F.col("__puts") - F.col("__p")).alias("__puts"),
                           (F.col("__gets") - F.col("__g")).alias("__gets"))
    carried = join_on_key(emitted, broadcast_if_small(cut_lineage(before)), [*key, SLICE], "inner")
    return carried.withColumns({"puts": F.col("puts") + F.col("__puts"), "gets": F.col("gets") + F.col("__gets")}
                               ).drop(SLICE, "__puts", "__gets")
