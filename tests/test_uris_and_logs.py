import pytest
from pyspark.sql import functions as F

from queuelens.functions.logs import LEVELS
from queuelens.operators import logs, uris
from queuelens.session import shared_path
from queuelens.sources.tables import load_uri
from tests.helpers import at, rows

# url -> scheme, authority, path
ADDRESSES = {
    "file:///home/data/dist": ("file", None, "/home/data/dist"),
    "hdfs://localhost:9000": ("hdfs", "localhost:9000", ""),
    "hdfs://localhost:9000/a//b": ("hdfs", "localhost:9000", "/a//b"),
    "https://h.example/p?x=1#y": ("https", "h.example", "/p?x=1#y"),
    "a/b:c": (None, None, "a/b:c"),
    "http:foo": (None, None, "http:foo"),
    ":/x": (None, None, ":/x"),
    "file:/x": ("file", None, "/x"),
    "//h/p": (None, "h", "/p"),
    "//": (None, None, "//"),
    "///": (None, None, "/"),
    "s://": ("s", None, "//"),
    "": (None, None, ""),
    "/plain/path": (None, None, "/plain/path"),
    "s:////x": ("s", None, "//x"),
    "a:b:/c": (None, None, "a:b:/c"),
}


def test_addresses(spark):
    df = uris.uri_split(spark.createDataFrame([(u,) for u in ADDRESSES], "url STRING"))
    assert {r.url: (r.scheme, r.authority, r.path) for r in df.collect()} == ADDRESSES


def test_put_together_addresses(spark):
    """The splitter gives back the parts that an address was made of."""
    made = {}
    for scheme in (None, "file", "hdfs", "s3-x", "a.b+c"):
        for authority in (None, "h", "h:9000", "user@h", "[::1]:80", "é"):
            for path in ("/", "/a", "/a//b", "/a:b/c", "/p?q=1#f", "//x", "/ \n"):
                if authority is None and path.startswith("//"):
                    continue  # would read as an authority
                url = (f"{scheme}:" if scheme else "") + (f"//{authority}" if authority else "") + path
                made[url] = (scheme, authority, path)
    df = uris.uri_split(spark.createDataFrame([(u,) for u in made], "url STRING"))
    assert {r.url: (r.scheme, r.authority, r.path) for r in df.collect()} == made


def test_quoted_path(spark):
    df = uris.uri_split(spark.createDataFrame([("s://h/a b?c#d%20{e}",)], "url STRING"))
    assert df.first().path_quoted == "/a%20b%3Fc%23d%2520%7Be%7D"


def test_unregistered_scheme_has_no_file_system(spark):
    registry = spark.createDataFrame(
        [("file", "Old", 1), ("file", "Local", 3), ("file", "Older", 0)], "scheme STRING, file_system STRING, seq INT")
    df = spark.createDataFrame([("file:/x",), ("ftp://h/x",), ("x",)], "url STRING")
    routed = uris.scheme_route(df, registry)
    assert rows(routed, "url", "file_system") == [("file:/x", "Local"), ("ftp://h/x", None), ("x", None)]


def test_container_path(spark):
    df = spark.createDataFrame(
        [("file:/lib/a+b%20c.jar!/org/X.class",), ("/x/y.jar",), ("file:/bad%zz!/x",)], "e STRING")
    got = [r.container for r in uris.clean_container_path(df, "e").collect()]
    assert got == ["/lib/a b c.jar", "/x/y.jar", None]


def test_unknown_scheme_cannot_be_opened(spark):
    with pytest.raises(ValueError, match="no file system"):
        load_uri(spark, "ftp://host/x")


LOG = [
    (at(0.0), "INFO", "a.b.C", 12, "plain"),
    (at(1.5), "WARN", "a", None, "with [brackets] - and dash"),
    (at(2.000999), "ERROR", "x.y", 7, ""),
    (at(3), "DEBUG", "x", 1, "two\nlines"),
]


@pytest.mark.parametrize("layout", ["stdout", "file"])
@pytest.mark.parametrize("zone_name", ["UTC", "America/New_York"])
def test_render_then_parse(spark, zone, layout, zone_name):
    zone(zone_name)
    df = spark.createDataFrame(LOG, "ts TIMESTAMP_NTZ, level STRING, logger STRING, nr INT, message STRING")
    numbered = logs.log_render(df.where("nr IS NOT NULL"), layout, F.col("nr"))
    bare = logs.log_render(df.where("nr IS NULL"), layout)
    parsed = logs.log_parse(numbered.unionAll(bare).select(F.col("text").alias("value")))
    want = sorted((t.replace(microsecond=t.microsecond // 1000 * 1000), *rest) for t, *rest in LOG)
    assert sorted(rows(parsed.drop("raw"))) == want


def test_skipped_hour_is_rendered_as_written(spark, zone):
    zone("America/New_York")
    df = spark.sql("SELECT TIMESTAMP_NTZ'2024-03-10 02:30:00.5' ts, 'INFO' level, 'a' logger, 'm' message")
    assert logs.log_render(df).first().text == "2024-03-10 02:30:00.500 INFO  [a] - m"


def test_long_levels_and_missing_parts_are_not_lost(spark):
    data = [(at(0), "NOTICE", "a", "m"), (at(1), "WARNING", "a", None), (at(2), None, "a", "m"), (at(3), "INFO", None, "m")]
    df = spark.createDataFrame(data, "ts TIMESTAMP_NTZ, level STRING, logger STRING, message STRING")
    assert [t for (t,) in rows(logs.log_render(df), "text")] == [
        "2024-01-01 00:00:00.000 NOTICE [a] - m", "2024-01-01 00:00:01.000 WARNING [a] - null",
        "2024-01-01 00:00:02.000 null  [a] - m", "2024-01-01 00:00:03.000 INFO  [null] - m"]


def test_years_of_five_digits(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ'+12024-03-10 02:30:00.5' ts, 'INFO' level, 'a' logger, 'm' message")
    assert logs.log_render(df).select("text").first().text.endswith("12024-03-10 02:30:00.500 INFO  [a] - m")


def test_other_lines_are_kept_raw(spark):
    lines = ["garbage", "", "2024-13-45 00:00:00.000 INFO  [a] - no such day", "\u0001a\u0001b\u0001c\u0001d\u0001e"]
    parsed = logs.log_parse(spark.createDataFrame([(t,) for t in lines], "value STRING"))
    assert rows(parsed, "raw") == sorted((t,) for t in lines)
    fields = ("ts", "level", "logger", "line", "message")
    assert parsed.where(" OR ".join(f"{f} IS NOT NULL" for f in fields)).isEmpty()


def test_longest_prefix_decides(spark):
    data = [(level, logger) for level in LEVELS for logger in ("a", "a.b", "a.b.c", "ab", "z")]
    df = spark.createDataFrame(data, "level STRING, logger STRING")
    kept = rows(logs.log_level_filter(df, "ERROR", {"a": "WARN", "a.b": "TRACE"}), "level", "logger")
    need = {"a": "WARN", "a.b": "TRACE", "a.b.c": "TRACE", "ab": "ERROR", "z": "ERROR"}
    assert kept == sorted((lv, lg) for lv, lg in data if LEVELS[lv] >= LEVELS[need[lg]])


def test_daily_roll_reads_one_day(spark):
    df = spark.createDataFrame([(at(3600 * h), f"line {h}") for h in range(60)], "ts TIMESTAMP_NTZ, text STRING")
    path = shared_path(spark, "roll-test")
    logs.log_daily_roll(df, path, rows_per_file=7)
    days = rows(logs.rolled_days(spark, path, "ts TIMESTAMP_NTZ, text STRING"))
    assert [n for _, n in days] == [24, 24, 12]
    one = spark.read.parquet(path).where("log_date = DATE'2024-01-02'")
    assert one.count() == 24
    assert "PartitionFilters: [isnotnull(log_date" in one._jdf.queryExecution().executedPlan().toString()
