"""Small helpers shared by the tests."""

from datetime import datetime, timedelta

START = datetime(2024, 1, 1)


def at(seconds: float) -> datetime:
    return START + timedelta(seconds=seconds)


def rows(df, *columns):
    """Rows as sorted tuples."""
    chosen = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in chosen.collect()), key=lambda r: [(v is not None, str(v)) for v in r])


def same(left, right):
    """Two frames hold the same rows, columns matched by name."""
    assert sorted(left.columns) == sorted(right.columns)
    right = right.select(*left.columns)
    return left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()
