"""Event stream and latency operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from queuelens.functions.times import micros_between, millis_between
from queuelens.plans.joins import broadcast_if_small, join_on_key, with_key_values
from queuelens.plans.ordered import first_of_many, running
from queuelens.plans.prefixes import prefix_quantiles
from queuelens.plans.snapshots import COUNT, QUANTILES, snapshot, snapshot_of_counts, value_counts
from queuelens.session import cut_lineage

MS_PER_HOUR = 3_600_000.0


def event_map(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """Every event with the given columns computed; one row out per row in."""
    return df.withColumns(dict(columns))


def event_map_pandas(df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame],
                     schema: str) -> DataFrame:
    """User code over batches of events; it must return one row per row."""

    def apply(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            result = fn(batch)
            if len(result) != len(batch):
                raise ValueError("an event map must keep the number of events")
            yield result

    return df.mapInPandas(apply, schema)


def event_latency(df: DataFrame, as_of: Column, created: str = "ts") -> DataFrame:
    """Milliseconds from creation to ``as_of``, floored, as ``latency_ms``."""
    return df.withColumn("latency_ms", millis_between(df, created, as_of))


def latency_summary(df: DataFrame, value: str = "latency_ms", approx: bool = False,
                    hot_rows: int | None = None) -> DataFrame:
    """One histogram snapshot over all events."""
    return snapshot(df, [], value, approx=approx, hot_rows=hot_rows)


def latency_by_client(df: DataFrame, client: str = "user_id", value: str = "latency_ms",
                      approx: bool = False, hot_rows: int | None = None) -> DataFrame:
    """One histogram snapshot per client."""
    return snapshot(df, [client], value, approx=approx, hot_rows=hot_rows)


# Bucket numbers are 64-bit integers.
MOST_BUCKETS = float(2**63)


def bucket_of(value: str, width: float) -> Column:
    """The number of the bucket of ``value``; null where there is none."""
    place = F.floor(F.col(value).cast("double") / width)
    return F.when(F.abs(F.col(value).cast("double") / width) < MOST_BUCKETS, place)


def latency_buckets(df: DataFrame, value: str, width: float) -> DataFrame:
    """Events per fixed-width bucket of ``value``.

    Values without a bucket number (null, NaN, beyond 64 bits) share the bucket null.
    """
    bucket = bucket_of(value, width)
    return (
        df.select(bucket.alias("bucket"))
        .groupBy("bucket")
        .agg(F.count("*").alias("n"))
        .select("bucket", (F.col("bucket") * F.lit(float(width))).alias("lower"), "n")
    )


def with_period(df: DataFrame, period: str, ts: str = "ts") -> DataFrame:
    """``df`` with the start of the reporting period that each event falls in."""
    return df.withColumn("period_start", F.window(ts, period)["start"])


def every_period(found: DataFrame, period: str) -> DataFrame:
    """All periods from the first to the last ``period_start`` of ``found``, in one column.

    There is a row for each of them, so choose a period that suits the time the events span.
    """
    ends = found.agg(F.min("period_start").alias("first"), F.max("period_start").alias("last"))
    return ends.select(F.explode(F.sequence("first", "last", F.expr(f"INTERVAL {period}"))).alias("period_start"))


def latency_tumbling(df: DataFrame, period: str, ts: str = "ts", value: str = "latency_ms",
                     approx: bool = False, hot_rows: int | None = None) -> DataFrame:
    """One histogram snapshot per reporting period; periods between without an event have n = 0."""
    found = cut_lineage(snapshot(with_period(df, period, ts), ["period_start"], value,
                                 approx=approx, hot_rows=hot_rows))
    rows = join_on_key(every_period(found, period), found, ["period_start"], "left")
    return rows.withColumn("n", F.coalesce("n", F.lit(0).cast("bigint")))


def latency_cumulative(df: DataFrame, period: str, ts: str = "ts", value: str = "latency_ms",
                       hot_rows: int | None = None) -> DataFrame:
    """Snapshot since the start at the end of each period; nothing is reset.

    There is a row for every period from the first to the last with a value; one without
    carries the snapshot before it. Quantiles are exact. For the rest, periods are reduced to
    mergeable moments first; only those are accumulated. Their means are centred on the mean
    of all, as squares of large values would cancel.
    """
    amount = F.col(value).cast("double")
    rows = with_period(df, period, ts).select("period_start", value)
    moments = cut_lineage(
        rows.groupBy("period_start")
        .agg(
            F.count(value).alias("__n"),
            F.sum(amount).alias("__sum"),
            F.min(value).alias("__min"),
            F.max(value).alias("__max"),
            (F.var_pop(amount) * F.count(value)).alias("__within"),
        )
        .where("__n > 0")
    )
    centre = moments.agg(F.sum("__sum") / F.sum("__n")).scalar()
    quantiles = cut_lineage(prefix_quantiles(rows, "period_start", value, QUANTILES))
    every = join_on_key(every_period(moments, period), moments, ["period_start"], "left").withColumns({
        "__centre": centre, "__active": F.when(F.col("__n").isNotNull(), F.col("period_start"))})
    off = F.col("__sum") / F.col("__n") - F.col("__centre")
    so_far = running(
        every, [], ["period_start"],
        {
            "n": ("sum", F.col("__n")),
            "min": ("min", F.col("__min")),
            "max": ("max", F.col("__max")),
            "__total": ("sum", F.col("__n") * off),
            "__spread": ("sum", F.col("__within") + F.col("__n") * off * off),
            "__as_of": ("max", F.col("__active")),
        },
        hot_rows=hot_rows,
    )
    squares = F.col("__spread") - F.col("__total") * F.col("__total") / F.col("n")
    known = quantiles.withColumnRenamed("period_start", "__as_of")
    return join_on_key(so_far, broadcast_if_small(known), ["__as_of"], "left").select(
        "period_start", "n", "min", "max",
        (F.col("__centre") + F.col("__total") / F.col("n")).alias("mean"),
        F.when(F.col("n") > 1, F.sqrt(F.greatest(squares, F.lit(0.0)) / (F.col("n") - 1)))
        .alias("stddev"),
        *QUANTILES,
    )


def _age_weight(df: DataFrame, ts: str, newest: Column, alpha_per_hour: float) -> Column:
    """Forward-decay weight exp(alpha * (t - newest)), at most 1, by exact ages."""
    age = micros_between(df, ts, newest)
    return F.exp(F.lit(-alpha_per_hour) * age / F.lit(1000 * MS_PER_HOUR))


def _weighed(df: DataFrame, key: list[str], value: str, alpha_per_hour: float,
             ts: str) -> DataFrame:
    """Rows that have a value, with ``__w``, its age weight against the newest row of the key.

    The newest row of a key weighs 1, so a key that has long been quiet keeps its shape.
    """
    rows = df.select(*key, ts, value).where(F.col(value).isNotNull())
    per_key = cut_lineage(rows.groupBy(*key).agg(
        F.max(ts).alias("__newest"), F.avg(value).alias("__centre")))
    joined = with_key_values(rows, per_key, key)
    return joined.withColumn("__w", _age_weight(joined, ts, F.col("__newest"), alpha_per_hour))


def latency_decayed(df: DataFrame, key: Sequence[str], value: str, alpha_per_hour: float,
                    ts: str = "ts") -> DataFrame:
    """Exponentially time-decayed count, mean and deviation per key.

    ``weight`` is measured from the newest row of all; it may underflow to zero for a key
    that has been quiet for long, whose mean and deviation are still right.
    """
    key = list(key)
    # Values are centred on the plain mean so that the squares do not cancel.
    off = F.col(value) - F.col("__centre")
    newest = df.where(F.col(value).isNotNull()).agg(F.max(ts)).scalar()
    sums = (
        _weighed(df, key, value, alpha_per_hour, ts)
        .groupBy(*key)
        .agg(
            F.sum("__w").alias("__weight"),
            F.sum(F.col("__w") * off).alias("__first"),
            F.sum(F.col("__w") * off * off).alias("__second"),
            F.first("__centre").alias("__centre"),
            F.max("__newest").alias("__newest"),
        )
    ).withColumn("__all", newest)
    shift = F.col("__first") / F.col("__weight")
    variance = F.col("__second") / F.col("__weight") - shift * shift
    return sums.select(
        *key,
        (F.col("__weight") * _age_weight(sums, "__newest", F.col("__all"), alpha_per_hour))
        .alias("weight"),
        (F.col("__centre") + shift).alias("mean"),
        F.sqrt(F.greatest(variance, F.lit(0.0))).alias("stddev"),
    )


def latency_decayed_quantile(df: DataFrame, key: Sequence[str], value: str, width: float,
                             alpha_per_hour: float, q: float = 0.5, ts: str = "ts",
                             hot_rows: int | None = None) -> DataFrame:
    """Weighted quantile over fixed-width value buckets, as the bucket that reaches it.

    Values without a bucket number are left out.
    """
    key = list(key)
    bucketed = df.select(*key, ts, bucket_of(value, width).alias("bucket"))
    weights = cut_lineage(
        _weighed(bucketed, key, "bucket", alpha_per_hour, ts)
        .groupBy(*key, "bucket")
        .agg(F.sum("__w").alias("__w"))
    )
    upto = running(weights, key, ["bucket"], {"__upto": ("sum", F.col("__w"))}, hot_rows=hot_rows)
    totals = upto.groupBy(*key).agg(F.max("__upto").alias("__total"))
    joined = join_on_key(upto, broadcast_if_small(totals), key, "inner")
    return (
        joined.where(F.col("__upto") >= F.col("__total") * q)
        .groupBy(*key)
        .agg(F.min("bucket").alias("bucket"))
        .select(*key, "bucket", (F.col("bucket") * F.lit(float(width))).alias("lower"))
    )


# Values that a decaying reservoir holds (fixed value).
RESERVOIR = 1028
# Hexadecimal digits of a hash that make a random number, and how many of them there are.
DIGITS = 13


def decaying_reservoir(df: DataFrame, key: Sequence[str], value: str, alpha_per_hour: float,
                       row_id: str = "event_id", ts: str = "ts", size: int = RESERVOIR) -> DataFrame:
    """A sample of at most ``size`` rows per key, in which newer rows are likelier by their weight.

    A row of weight w has priority u^(1/w), u a number between 0 and 1 from a hash of its id, and
    the rows with the largest priorities make the sample, whatever order they come in; so
    samples of parts can be merged. Rows without a value are left out. ``row_id`` must be unique.
    Returns key, id, time, value and ``weight`` against the newest row of the key.
    """
    key = list(key)
    number = F.conv(F.substring(F.md5(F.col(row_id).cast("string")), 1, DIGITS), 16, 10).cast("double")
    random = (number + 0.5) / F.lit(float(16 ** DIGITS))
    rows = df.select(*dict.fromkeys([*key, row_id, ts, value])).where(F.col(value).isNotNull())
    newest = cut_lineage(rows.groupBy(*key).agg(F.max(ts).alias("__newest")))
    aged = with_key_values(rows, newest, key)
    age = millis_between(aged, ts, F.col("__newest")) / F.lit(MS_PER_HOUR) * F.lit(float(alpha_per_hour))
    # The logarithm of -ln(u) / w: it falls as the priority grows, and cannot overflow.
    ranked_rows = aged.withColumns({"weight": F.exp(-age), "__rank": F.log(-F.log(random)) + age})
    order = ["__rank", row_id]
    return first_of_many(ranked_rows, key, order, size, "__place").drop("__rank", "__place", "__newest")


def reservoir_snapshot(sample: DataFrame, key: Sequence[str], value: str, row_id: str = "event_id",
                       quantiles: Mapping[str, float] = QUANTILES) -> DataFrame:
    """The weighted snapshot of a sample: a quantile is the last value before which lies at most its share."""
    key = list(key)
    by_value = Window.partitionBy(*key).orderBy(value, row_id)
    whole, before = Window.partitionBy(*key), by_value.rowsBetween(Window.unboundedPreceding, -1)
    share = F.col("weight") / F.sum("weight").over(whole)
    rows = sample.withColumns({"__share": share}).withColumn(
        "__before", F.coalesce(F.sum("__share").over(before), F.lit(0.0)))
    rows = rows.withColumn("__mean", F.sum(F.col("__share") * F.col(value)).over(whole))
    gap = F.col(value) - F.col("__mean")
    return rows.groupBy(*key).agg(
        F.count(value).alias("n"), F.min(value).alias("min"), F.max(value).alias("max"),
        F.first("__mean").alias("mean"), F.sqrt(F.sum(F.col("__share") * gap * gap)).alias("stddev"),
        *[F.max(F.when(F.col("__before") <= q, F.col(value))).cast("double").alias(name)
          for name, q in quantiles.items()])


def replay_latency(created: DataFrame, consumed: DataFrame, on: tuple[str, str],
                   created_at: str, consumed_at: str, key: Sequence[str],
                   hot_rows: int | None = None) -> DataFrame:
    """Signed days from a recorded creation to a recorded consumption, summarised per key.

    The join runs once: its result is reduced to counts per key and day difference.
    """
    key = list(key)
    left = created.select(F.col(on[0]).alias("__id"), *key, F.col(created_at).alias("__from"))
    right = consumed.select(F.col(on[1]).alias("__id"), F.col(consumed_at).alias("__to"))
    return replay_summary(
        left.join(right, "__id").select(*key, F.date_diff("__to", "__from").alias("days")), key, hot_rows)


def replay_summary(days: DataFrame, key: Sequence[str], hot_rows: int | None = None) -> DataFrame:
    """The snapshot of ``days`` per key, and how many are negative."""
    key = list(key)
    early = F.sum(F.when(F.col("days") < 0, F.col(COUNT)).otherwise(0))
    return snapshot_of_counts(value_counts(days, key, "days"), key, "days",
                              extra={"n_negative": early}, hot_rows=hot_rows)


def with_lane(df: DataFrame, key: str, size: int) -> DataFrame:
    """``df`` with the lane of its key; all events of a key share a lane, in order."""
    whole = isinstance(df.schema[key].dataType, T.IntegralType)
    number = F.col(key).cast("bigint") if whole else F.xxhash64(key)
    return df.withColumn("lane", F.pmod(number, F.lit(size).cast("bigint")))


def keyed_lanes(df: DataFrame, key: str, size: int) -> DataFrame:
    """Events and keys per lane; counted from partial counts per key."""
    per_key = with_lane(df.select(key), key, size).groupBy("lane", key).agg(F.count("*").alias("n"))
    return per_key.groupBy("lane").agg(F.sum("n").alias("n"), F.count(key).alias("n_keys"))


def event_distinct(df: DataFrame) -> DataFrame:
    """Events that differ in at least one field."""
    return df.dropDuplicates()
