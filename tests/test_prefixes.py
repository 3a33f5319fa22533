"""Quantiles over everything up to a period, against sorting it."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from queuelens.operators import events as ev
from queuelens.plans import prefixes
from queuelens.plans.snapshots import QUANTILES
from tests.helpers import at, rows


def test_kth_in_prefix():
    rng = np.random.default_rng(1)
    for size, codes in ((1, 1), (40, 3), (300, 500)):
        code, weight = rng.integers(0, codes, size), rng.integers(1, 4, size)
        ends = rng.integers(1, size + 1, 50)
        expanded = [np.sort(np.repeat(code[:e], weight[:e])) for e in ends]
        ranks = np.array([rng.integers(0, len(x)) for x in expanded])
        found = prefixes.kth_in_prefix(code, weight, ends, ranks)
        assert found.tolist() == [x[k] for x, k in zip(expanded, ranks)]


def plain(data):
    out, so_far = [], []
    for period in sorted({p for p, _ in data}):
        so_far += [v for p, v in data if p == period and v is not None]
        if any(p == period and v is not None for p, v in data):
            out.append((period, *[float(np.quantile(so_far, q)) for q in QUANTILES.values()]))
    return out


@pytest.mark.parametrize("kind", ["spread", "hot", "double"])
def test_equals_sorting(spark, monkeypatch, kind):
    """Small chunks of periods and small cells; half of the hot rows have one value."""
    monkeypatch.setattr(prefixes, "LAID_OUT", 100)
    rng = np.random.default_rng(7)
    values = rng.integers(-10**12, 10**12, 1500)
    values = np.where(rng.random(1500) < 0.5, 42, values % 50) if kind == "hot" else values
    data = [(int(p), None if p % 9 == 4 else float(v) / 3 if kind == "double" else int(v))
            for p, v in zip(rng.integers(0, 40, 1500), values)]
    df = spark.createDataFrame(data, f"period INT, v {'DOUBLE' if kind == 'double' else 'BIGINT'}")
    found = prefixes.prefix_quantiles(df, "period", "v", QUANTILES).orderBy("period").collect()
    want = plain(data)
    assert [r.period for r in found] == [w[0] for w in want]
    assert np.allclose([list(r)[1:] for r in found], [w[1:] for w in want], rtol=1e-12)


def test_no_rows(spark):
    df = spark.createDataFrame([(1, None)], "period INT, v BIGINT")
    assert rows(prefixes.prefix_quantiles(df, "period", "v", QUANTILES)) == []
    none = spark.createDataFrame([], "ts TIMESTAMP_NTZ, latency_ms BIGINT")
    assert rows(ev.latency_cumulative(none, "1 day")) == [] == rows(ev.latency_tumbling(none, "1 day"))


def test_quiet_periods(spark):
    """Two events an hour apart with five hours between, and a null that no period counts."""
    data = [(at(0), 10), (at(60), 30), (at(6 * 3600), 20), (at(7 * 3600), None)]
    df = spark.createDataFrame(data, "ts TIMESTAMP_NTZ, latency_ms BIGINT")
    tumbling = ev.latency_tumbling(df, "1 hour").orderBy("period_start")
    assert [(r.n, r.p50) for r in tumbling.collect()] == [(2, 20.0), *[(0, None)] * 5, (1, 20.0), (0, None)]
    so_far = ev.latency_cumulative(df, "1 hour").orderBy("period_start")
    assert [(r.n, r["min"], r["max"], r.p50) for r in so_far.collect()] == [
        *[(2, 10, 30, 20.0)] * 6, (3, 10, 30, 20.0)]


def test_every_cell_is_small(spark, monkeypatch):
    """The number of cells follows the number of rows."""
    monkeypatch.setattr(prefixes, "CELL_ROWS", 20)
    df = spark.range(4000).select((F.col("id") % 10).alias("period"), (F.col("id") * 7919 % 4001).alias("v"))
    data = [(r.period, r.v) for r in df.collect()]
    found = prefixes.prefix_quantiles(df, "period", "v", QUANTILES).orderBy("period").collect()
    assert np.allclose([list(r) for r in found], plain(data))
