from datetime import datetime

from pyspark.sql import functions as F

from queuelens.functions.times import millis_between, ntz
from queuelens.operators.events import event_latency
from tests.helpers import rows


def zone_free(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "t STRING").select(
        F.col("t").cast("timestamp_ntz").alias("t")
    )


def test_floors_towards_the_past(spark):
    df = zone_free(spark, "2024-01-01 00:00:00.0005", "2024-01-01 00:00:00",
                   "2024-01-02 01:02:03.0045", "2023-12-31 23:59:58.9995")
    got = rows(df.select(millis_between(df, "t", ntz("2024-01-01")).alias("ms")))
    # -0.5 ms floors to -1; so does every other fraction
    assert sorted(got) == [(-90_123_005,), (-1,), (0,), (1000,)]


def test_zone_free_times_ignore_daylight_saving(spark, zone):
    zone("America/New_York")
    df = zone_free(spark, "2024-03-10 02:30:00")
    assert rows(event_latency(df, ntz("2024-03-10 03:30:00"), "t"), "latency_ms") == [(3_600_000,)]


def test_instants_are_exact(spark):
    df = spark.createDataFrame(
        [(datetime(2024, 1, 1, 0, 0, 0, 500),), (datetime(1969, 12, 31, 23, 59, 59, 999_500),)],
        "t TIMESTAMP",
    )
    end = F.lit("1970-01-01 00:00:00").cast("timestamp")
    got = rows(df.select(millis_between(df, "t", end).alias("ms")))
    assert got == [(-1704067200001,), (0,)]
