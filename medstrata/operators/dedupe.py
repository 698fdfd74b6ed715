"""Latest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

COMMIT_ORDER = ("_commit_version", "_commit_timestamp")


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column],
    tie_break: Sequence[str] = (),
    drop: Sequence[str] = (),
) -> DataFrame:
    """One row per key: the greatest by ``order`` then ``tie_break``, NULLs last.

    ``row_number() = 1`` is planned with a group limit before the exchange, so each
    map task ships at most one row per key and a key that holds a large share of
    the input does not load a single reducer.
    """
    ranking = [
        F.col(c).desc_nulls_last() if isinstance(c, str) else c.desc_nulls_last()
        for c in (*order, *tie_break)
    ]
    newest = Window.partitionBy(*keys).orderBy(*ranking)
    return (
        df.withColumn("_rank", F.row_number().over(newest))
        .filter(F.col("_rank") == 1)
        .drop("_rank", *drop)
    )


def latest_commit(
    changes: DataFrame, keys: Sequence[str], tie_break: Sequence[str] = ()
) -> DataFrame:
    """Latest change row per key by commit order; the order columns are dropped."""
    return latest_per_key(changes, keys, COMMIT_ORDER, tie_break, drop=COMMIT_ORDER)
