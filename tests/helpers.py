"""Comparing results as multisets of rows."""

from collections import Counter


def rows(df):
    columns = sorted(df.columns)
    return Counter(tuple(tuple(v) if isinstance(v, list) else v for v in (r[c] for c in columns)) for r in df.collect())


def frame(pdf):
    columns = sorted(pdf.columns)
    return Counter(map(tuple, pdf[columns].astype(object).where(pdf[columns].notna(), None).values.tolist()))


def same(a, b):
    """Spark's pandas frame and DuckDB's."""
    assert sorted(a.columns) == sorted(b.columns)
    x, y = frame(a), frame(b)
    assert x == y, (list((x - y).items())[:5], list((y - x).items())[:5])
