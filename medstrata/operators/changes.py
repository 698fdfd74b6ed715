"""Row-level differences between two states of a table, and commit history."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def diff_states(
    old: DataFrame, new: DataFrame, keys: Sequence[str], compare: Sequence[str] | None = None
) -> DataFrame:
    """Change rows that turn ``old`` into ``new`` (each unique by key).

    Gives ``insert``, ``delete`` and, for a changed record, its
    ``update_preimage`` and ``update_postimage``.  Unchanged records give no row.  Rows
    with a NULL key match none: old ones are deletes, new ones inserts.
    """
    columns = old.columns
    watched = list(compare) if compare is not None else [c for c in columns if c not in keys]

    def image(side: str, change_type: str):
        return F.struct(
            *[F.col(f"{side}.{c}").alias(c) for c in columns],
            F.lit(change_type).alias("_change_type"),
        )

    before = F.struct(*[F.col(f"old.{c}") for c in watched])
    after = F.struct(*[F.col(f"new.{c}") for c in watched])
    same_key = [F.col(f"old.{k}") == F.col(f"new.{k}") for k in keys]
    gone, added = F.col("new._there").isNull(), F.col("old._there").isNull()
    rows = (
        F.when(added, F.array(image("new", "insert")))
        .when(gone, F.array(image("old", "delete")))
        .otherwise(
            F.array(image("old", "update_preimage"), image("new", "update_postimage"))
        )
    )
    there = F.lit(True).alias("_there")
    pairs = old.select("*", there).alias("old").join(
        new.select(*columns, there).alias("new"), same_key, "full"
    )
    return pairs.filter(added | gone | ~before.eqNullSafe(after)).select(F.inline(rows))


def commit_history(changes: DataFrame, newest: int | None = None) -> DataFrame:
    """One row per commit: time and number of rows of each change type, newest first."""
    kinds = ("insert", "update_preimage", "update_postimage", "delete")
    history = changes.groupBy("_commit_version").agg(
        F.max("_commit_timestamp").alias("commit_ts"),
        *[
            F.count_if(F.col("_change_type") == kind).alias(f"{kind}_rows")
            for kind in kinds
        ],
    ).orderBy(F.col("_commit_version").desc())
    return history if newest is None else history.limit(newest)
