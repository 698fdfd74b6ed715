"""Small helpers of the tests."""

from collections import Counter


def rows(df, *columns):
    """Rows as a multiset of tuples."""
    chosen = df.select(*columns) if columns else df
    return Counter(tuple(r) for r in chosen.collect())


def same(left, right):
    assert sorted(left.columns) == sorted(right.columns)
    assert rows(left) == rows(right.select(*left.columns))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()
