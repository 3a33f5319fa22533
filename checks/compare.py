"""Run every registered query next to its SQL twin and report differences.

    python checks/compare.py [folder] [query ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import duckdb  # noqa: E402
from pyspark.sql import DataFrame, SparkSession  # noqa: E402

from checks.oracle import ORACLE  # noqa: E402
from checks.queries import QUERIES  # noqa: E402
from queuelens.session import build_session  # noqa: E402
from queuelens.sources.schemas import TABLES  # noqa: E402


def sql_connection(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(
            f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')"
        )
    return connection


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    return value


def _sorted_rows(columns: list[str], rows) -> list[tuple]:
    places = [columns.index(name) for name in sorted(columns)]
    plain = [tuple(_plain(row[i]) for i in places) for row in rows]
    return sorted(plain, key=lambda row: tuple((v is not None, str(v)) for v in row))


def differences(result: DataFrame, connection: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """What differs between a result and its SQL twin, empty when nothing does."""
    found = connection.sql(sql)
    names, expected_rows = found.columns, found.fetchall()
    if sorted(names) != sorted(result.columns):
        return [f"columns {sorted(result.columns)} instead of {sorted(names)}"]
    got = _sorted_rows(result.columns, result.collect())
    expected = _sorted_rows(names, expected_rows)
    if len(got) != len(expected):
        return [f"{len(got)} rows instead of {len(expected)}"]
    wrong = [(g, e) for g, e in zip(got, expected) if g != e]
    kinds = [
        (name, type(g).__name__, type(e).__name__)
        for row, twin in zip(got[:50], expected[:50])
        for name, g, e in zip(sorted(names), row, twin)
        if g is not None and e is not None and type(g) is not type(e)
    ]
    report = [f"{len(wrong)} rows differ, e.g. {g} instead of {e}" for g, e in wrong[:1]]
    return report + [f"types differ: {kind}" for kind in kinds[:1]]


def main(folder: str, chosen: list[str]) -> int:
    spark: SparkSession = build_session(
        "compare", "local[8]", **{"spark.sql.shuffle.partitions": 8, "spark.ui.enabled": "false"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = sql_connection(folder)
    failures = 0
    for name in chosen or QUERIES:
        start = time.time()
        try:
            result = QUERIES[name](spark, folder)
            if name in ORACLE:
                wrong = differences(result, connection, ORACLE[name])
                note = "ok" if not wrong else "; ".join(wrong)
            else:
                wrong, note = [], f"{result.count()} rows, no SQL twin"
        except Exception as error:  # report and go on with the next query
            wrong = [str(error)]
            note = f"{type(error).__name__}: {str(error)[:600]}"
        failures += bool(wrong)
        print(f"{name:28s} {time.time() - start:6.2f}s  {note}", flush=True)
    print(f"{failures} of {len(chosen or QUERIES)} queries differ")
    return failures


if __name__ == "__main__":
    arguments = sys.argv[1:]
    folder = arguments.pop(0) if arguments else "/root/testdata/sf0.01"
    sys.exit(bool(main(folder, arguments)))
