"""Per-batch merges of a change log into a bucketed table."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import partial

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from medstrata.operators.dedupe import COMMIT_ORDER, latest_per_key
from medstrata.operators.enrich import left_enrich
from medstrata.operators.upsert import (
    apply_history, changed_versions, rows_to_insert, upsert_newest, upsert_newest_at_once,
)
from medstrata.sources import changelog
from medstrata.sources.tables import KEPT_VERSIONS, expire, merge_bucketed, read_bucketed, replace_content
from medstrata.streaming.runs import run_stream


@dataclass(frozen=True)
class UpsertSpec:
    """How change rows of one dataset become rows of its cleaned table.

    ``prepare`` maps change rows to cleaned rows and keeps the commit columns; it
    serves batch and stream alike.  With ``changes_to`` the rows that each batch
    applied are written as a change log for the next stream.
    """

    prepare: Callable[[DataFrame], DataFrame]
    keys: Sequence[str]
    tie_break: Sequence[str] = ()
    buckets: int = 16
    changes_to: str | None = None
    kept_versions: int = KEPT_VERSIONS
    after: Callable[[DataFrame], None] | None = None  # is handed the latest rows of each batch, once merged


# Seconds that a merge waits for another writer of its table.
WAIT = 600.0
# A batch with this share of the rows that it is merged into, or more, is not small.
LARGE_SHARE = 0.25


def upsert_stream(
    source: DataFrame, target: str, spec: UpsertSpec, checkpoint: str, mode: str = "batch"
) -> StreamingQuery:
    """Type-1 upsert of every micro-batch: prepare, latest per key, merge.

    The table keeps the commit columns of its rows, see :func:`upsert_newest`.
    """
    newest = partial(merge_newest, tie_break=spec.tie_break)

    def merge(batch: DataFrame, number: int) -> None:
        latest = latest_per_key(spec.prepare(batch), spec.keys, COMMIT_ORDER, spec.tie_break)
        # Used for the touched buckets, the merge and the change log.
        latest = latest.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            before = merge_bucketed(latest, target, spec.keys, spec.buckets, newest, WAIT)
            if before is not None and spec.changes_to:
                changelog.append_commit(
                    applied_changes(before, latest, spec.keys, spec.tie_break),
                    spec.changes_to, f"{mode}-{number}",
                )
            if before is not None and spec.after:
                spec.after(latest)
        finally:
            latest.unpersist()
        expire(batch.sparkSession, target, spec.kept_versions)

    if spec.changes_to:
        nothing = spec.prepare(source.sparkSession.createDataFrame([], source.schema))
        changelog.create(applied_changes(nothing, nothing, spec.keys), spec.changes_to)
    return run_stream(source, merge, checkpoint, mode)


def merge_newest(
    before: DataFrame, latest: DataFrame, keys: Sequence[str], tie_break: Sequence[str] = ()
) -> DataFrame:
    """:func:`upsert_newest` in the form that suits the sizes: footers and a kept batch are counted.

    A small batch is broadcast; a large one meets the target in one join; without any
    target row the batch is the result.
    """
    there = before.count()
    if not there:
        return latest.select(*before.columns)
    large = latest.count() >= LARGE_SHARE * there
    return (upsert_newest_at_once if large else upsert_newest)(before, latest, keys, tie_break)


def applied_changes(
    before: DataFrame, latest: DataFrame, keys: Sequence[str], tie_break: Sequence[str] = ()
) -> DataFrame:
    """The merged rows as change rows: update when the key was known, else insert.

    Rows that are older than the row the table had are not part of the change.
    """
    order = (*COMMIT_ORDER, *tie_break)
    known = before.select(*keys, F.struct(*order).alias("_known"))
    is_newer = F.col("_known").isNull() | (F.struct(*order) >= F.col("_known"))
    return (
        latest.join(known, list(keys), "left")
        .filter(is_newer)
        .withColumn(
            "_change_type",
            F.when(F.col("_known").isNull(), "insert").otherwise("update_postimage"),
        )
        .withColumn("_commit_timestamp", F.current_timestamp())
        .drop("_known")
    )


def append_new(latest: DataFrame, path: str, keys: Sequence[str], run_id: str) -> None:
    """Insert-only merge into an append-only table: only rows with new keys are written.

    A run that is repeated replaces what it wrote before, which therefore does not count
    as being there.
    """
    spark = latest.sparkSession
    rows = latest
    if changelog.has_commits(spark, path):
        there, own = changelog.read_log(spark, path), changelog.noted_number(spark, path, run_id)
        if own is not None:
            there = there.filter(F.col(changelog.VERSION) != own)
        rows = rows_to_insert(there, latest, keys)
    changelog.append_commit(rows, path, run_id)


def merge_history(
    snapshot: DataFrame, target: str, key: str, tracked: Sequence[str], buckets: int,
    kept_versions: int = KEPT_VERSIONS,
) -> None:
    """Type-2 merge of a snapshot into a bucketed history.

    Only buckets with a new or changed key are rewritten; a snapshot without any
    change writes nothing.
    """
    spark = snapshot.sparkSession
    history = read_bucketed(spark, target, snapshot.schema)
    changed = changed_versions(history, snapshot, key, tracked).persist(
        StorageLevel.MEMORY_AND_DISK
    )
    try:
        merge_bucketed(
            changed, target, [key], buckets,
            lambda before, batch, _: apply_history(before, batch, key, tracked), WAIT,
        )
        expire(spark, target, kept_versions)
    finally:
        changed.unpersist()


def enrich_stream(
    changes: DataFrame,
    dimension: Callable[[], DataFrame],
    key: str,
    dimension_key: str,
    add: Sequence[str],
    missing_flag: str,
    target: str,
    keys: Sequence[str],
    checkpoint: str,
    mode: str = "batch",
    buckets: int = 16,
    kept_versions: int = KEPT_VERSIONS,
    pending: str | None = None,
) -> StreamingQuery:
    """Left-join a stream of changed rows with a dimension table and upsert the result.

    ``dimension`` is called for every micro-batch, so a long-running job sees the
    newest version of the dimension table.  Rows without a dimension row are also kept in
    the table ``pending``, for :func:`enrich_pending`.
    """

    def prepare(batch: DataFrame) -> DataFrame:
        rows = batch.drop("_change_type")
        return left_enrich(rows, dimension(), key, dimension_key, add, missing_flag)

    def note_pending(latest: DataFrame) -> None:
        waiting = latest.filter(F.col(missing_flag))

        def change(noted: DataFrame | None) -> DataFrame:
            if noted is None:
                return waiting
            return noted.join(latest.select(*keys), list(keys), "left_anti").unionByName(waiting, allowMissingColumns=True)

        replace_content(latest.sparkSession, pending, change, kept_versions, WAIT)

    spec = UpsertSpec(
        prepare=prepare, keys=keys, buckets=buckets, kept_versions=kept_versions,
        after=note_pending if pending else None,
    )
    return upsert_stream(changes, target, spec, checkpoint, mode)


def enrich_pending(
    spark: SparkSession,
    pending: str,
    dimension: Callable[[DataFrame], DataFrame],
    key: str,
    dimension_key: str,
    add: Sequence[str],
    missing_flag: str,
    target: str,
    keys: Sequence[str],
    buckets: int = 16,
    kept_versions: int = KEPT_VERSIONS,
) -> None:
    """Enrich the pending rows whose dimension row has arrived; the others stay pending.

    Work follows the number of pending rows: of the target only the buckets of rows that
    were found are rewritten, and ``dimension`` is asked for the rows of the pending keys, so
    it need not read the rest.  A row that has changed since keeps its newer state.
    """

    def change(noted: DataFrame | None) -> DataFrame | None:
        if noted is None or noted.isEmpty():
            return None
        asked = noted.select(F.col(key).alias(dimension_key)).distinct()
        waiting = noted.drop(*add, missing_flag)
        found = left_enrich(waiting, dimension(asked), key, dimension_key, add, missing_flag)
        found = found.filter(~F.col(missing_flag)).select(*noted.columns).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            if found.isEmpty():
                return None
            merge_bucketed(found, target, keys, buckets, upsert_newest, WAIT)
            expire(spark, target, kept_versions)
            return noted.join(found.select(*keys), list(keys), "left_anti")
        finally:
            found.unpersist()

    replace_content(spark, pending, change, kept_versions, WAIT)


def read_cleaned(spark: SparkSession, target: str) -> DataFrame:
    """Content of a table that :func:`upsert_stream` keeps, without commit columns."""
    return read_bucketed(spark, target).drop(*COMMIT_ORDER)
