"""Type-1 upsert, insert-only merge and type-2 history as set operations."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from medstrata.functions.predicates import differs
from medstrata.operators.dedupe import COMMIT_ORDER


def upsert_latest(target: DataFrame, latest: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Type-1 upsert: rows of ``latest`` replace rows of ``target`` with equal keys.

    ``latest`` must be unique by key.  Columns only one side has are kept and
    filled with NULL on the other.
    """
    untouched = target.join(latest.select(*keys), list(keys), "left_anti")
    return untouched.unionByName(latest, allowMissingColumns=True)


def upsert_newest(
    target: DataFrame, latest: DataFrame, keys: Sequence[str], tie_break: Sequence[str] = ()
) -> DataFrame:
    """Type-1 upsert of rows that carry their commit order, in any order of arrival.

    Both sides are unique by key.  A row of ``latest`` replaces the row of
    ``target`` unless that one is newer, so a batch that is repeated, or holds an
    older part of a commit, cannot move a record back in time.  Written as joins,
    so that a small batch is broadcast and the target is not exchanged.
    """
    order = (*COMMIT_ORDER, *tie_break)
    incoming = latest.select(
        *[F.col(k).alias(f"_{k}") for k in keys], F.struct(*order).alias("_incoming")
    )
    same_key = reduce(Column.__and__, [F.col(k) == F.col(f"_{k}") for k in keys])
    replaced = F.struct(*order) <= F.col("_incoming")
    untouched = target.join(incoming, same_key & replaced, "left_anti")
    newer = target.join(incoming, same_key & ~replaced, "left_semi").select(*keys)
    accepted = latest.join(newer, list(keys), "left_anti")
    return untouched.unionByName(accepted, allowMissingColumns=True)


def upsert_newest_at_once(
    target: DataFrame, latest: DataFrame, keys: Sequence[str], tie_break: Sequence[str] = ()
) -> DataFrame:
    """The rows of :func:`upsert_newest` by a single join that exchanges each side once.

    For a batch that is not small against the target.  Both have the same columns.
    """
    order = (*COMMIT_ORDER, *tie_break)
    there = next(f"{'_' * n}there" for n in range(1, 99) if f"{'_' * n}there" not in target.columns)
    old, new = (df.withColumn(there, F.lit(True)) for df in (target, latest))
    same_key = reduce(Column.__and__, [F.col(f"old.{k}") == F.col(f"new.{k}") for k in keys])
    versions = [F.struct(*[F.col(f"{side}.{c}").alias(c) for c in order]) for side in ("old", "new")]
    accepted = F.col(f"old.{there}").isNull() | (versions[0] <= versions[1])
    use_new = F.col(f"new.{there}").isNotNull() & accepted
    return old.alias("old").join(new.alias("new"), same_key, "full").select(
        *[F.when(use_new, F.col(f"new.{c}")).otherwise(F.col(f"old.{c}")).alias(c) for c in target.columns]
    )


def insert_new(target: DataFrame, latest: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Insert-only merge: rows with keys already in ``target`` are ignored."""
    return target.unionByName(
        rows_to_insert(target, latest, keys), allowMissingColumns=True
    )


def rows_to_insert(target: DataFrame, latest: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows of ``latest`` whose key ``target`` does not have yet."""
    return latest.join(target.select(*keys), list(keys), "left_anti")


def open_versions(snapshot: DataFrame, start: str = "_ingest_ts") -> DataFrame:
    """Give each snapshot row the interval columns of a current history row."""
    return snapshot.select(
        "*",
        F.col(start).alias("eff_start_ts"),
        F.lit(None).cast("timestamp").alias("eff_end_ts"),
        F.lit(True).alias("is_current"),
    )


def changed_versions(
    history: DataFrame, snapshot: DataFrame, key: str, tracked: Sequence[str]
) -> DataFrame:
    """The snapshot rows that :func:`apply_history` would act upon: new or changed keys."""
    current = history.filter(F.col("is_current")).select(
        F.col(key).alias("_key"), F.struct(*tracked).alias("_tracked")
    )
    same = (F.col(key) == F.col("_key")) & F.struct(*tracked).eqNullSafe(F.col("_tracked"))
    return snapshot.join(current, same, "left_anti")


def apply_history(
    history: DataFrame, snapshot: DataFrame, key: str, tracked: Sequence[str]
) -> DataFrame:
    """Type-2 history after one snapshot (unique by key, made by ``open_versions``).

    A current row whose tracked columns changed is closed at the start of its
    successor; changed and unknown keys get a new current row; the rest stays.
    Closing and opening come from the same join, so there is no state in which a
    key has no current row.  Closed rows bypass the join: only current rows, one
    per key, are exchanged.
    """
    columns = history.columns
    fresh = snapshot.select(*columns)
    old = F.struct(*[F.col(f"old.{c}").alias(c) for c in columns])
    new = F.struct(*[F.col(f"new.{c}").alias(c) for c in columns])
    changed = differs(
        [F.col(f"old.{c}") for c in tracked], [F.col(f"new.{c}") for c in tracked]
    )
    closed = F.struct(
        *[
            F.col("new.eff_start_ts").alias(c) if c == "eff_end_ts"
            else F.lit(False).alias(c) if c == "is_current"
            else F.col(f"old.{c}").alias(c)
            for c in columns
        ]
    )
    had = F.col(f"old.{key}").isNotNull()
    has = F.col(f"new.{key}").isNotNull()
    versions = (
        F.when(had & (~has | ~changed), F.array(old))
        .when(had, F.array(closed, new))
        .otherwise(F.array(new))
    )
    current = history.filter(F.col("is_current")).alias("old")
    merged = (
        current.join(fresh.alias("new"), F.col(f"old.{key}") == F.col(f"new.{key}"), "full")
        .select(F.inline(versions))
    )
    closed_before = history.filter(~F.col("is_current") | F.col("is_current").isNull())
    return closed_before.unionByName(merged)
