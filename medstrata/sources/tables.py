"""Snapshot tables in Parquet, optionally divided into key buckets.

A table is a folder of numbered versions.  A version is complete when Spark has
written its ``_SUCCESS`` marker; readers ignore an unfinished one, and a retry
writes it again.  A bucketed table stores, per version, only the buckets that
version changed, so an upsert rewrites the buckets its keys fall into and not the
whole table.  Its keys, number of buckets and columns are noted when it is created:
later merges use that number whatever they are given, and rows keep all columns.
A table has one writer at a time, by a lease; a second one waits as long as it is told to
and is then refused.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Sequence
from contextlib import AbstractContextManager

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructField, StructType

from medstrata.sources import folders, leases

BUCKET = "_bucket"

# Newest versions whose folders stay for readers that started on them, by default.
KEPT_VERSIONS = 10


def bucket_of(keys: Sequence[str], buckets: int):
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def complete_versions(spark: SparkSession, path: str) -> list[int]:
    done = folders.matching(spark, f"{path}/v=*/_SUCCESS")
    return sorted(int(re.search(r"/v=(\d+)/_SUCCESS$", p).group(1)) for p in done)


def next_version(spark: SparkSession, path: str) -> int:
    done = complete_versions(spark, path)
    return done[-1] + 1 if done else 0


def publish(df: DataFrame, path: str, keep: int = KEPT_VERSIONS, wait: float = 0.0) -> int:
    """Write ``df`` as the new content of the table; the old stays readable meanwhile.

    Of earlier contents the newest ``keep`` stay.
    """
    with only_writer(df.sparkSession, path, wait):
        return _publish(df, path, keep)


def replace_content(
    spark: SparkSession, path: str, change: Callable[[DataFrame | None], DataFrame | None],
    keep: int = KEPT_VERSIONS, wait: float = 0.0,
) -> None:
    """Publish what ``change`` makes of the present content (None: no version yet).

    No other writer comes between reading and writing.  Nothing is written for None.
    """
    with only_writer(spark, path, wait):
        done = complete_versions(spark, path)
        new = change(read_table(spark, path) if done else None)
        if new is not None:
            _publish(new, path, keep)


def _publish(df: DataFrame, path: str, keep: int) -> int:
    spark = df.sparkSession
    version = next_version(spark, path)
    df.write.mode("overwrite").parquet(f"{path}/v={version}")
    for old in complete_versions(spark, path)[: -max(keep, 1)]:
        folders.remove(spark, f"{path}/v={old}")
    return version


def only_writer(spark: SparkSession, path: str, wait: float = 0.0) -> AbstractContextManager:
    """Keeps other writers out of the table for the length of a block."""
    return leases.held(spark, f"{path}/_writers", wait)


def description(spark: SparkSession, path: str) -> dict | None:
    """``keys``, ``buckets`` and ``schema`` of a bucketed table, None before its first merge."""
    location = f"{path}/_table.json"
    if not folders.exists(spark, location):
        return None
    return json.loads(folders.read_text(spark, location))


def _schema_of(noted: dict | None) -> StructType:
    return StructType.fromJson(noted["schema"]) if noted else StructType([])


def all_columns(stored: StructType, more: StructType) -> StructType:
    """Columns of both; one that both have must have the same type."""
    known = {c.name: c.dataType for c in stored.fields}
    for c in more.fields:
        if known.get(c.name, c.dataType) != c.dataType:
            raise ValueError(f"column {c.name} is {known[c.name]}, not {c.dataType}")
    new = [StructField(c.name, c.dataType) for c in more.fields if c.name not in known]
    return StructType([*stored.fields, *new])


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """Newest complete content of a table written by :func:`publish`."""
    done = complete_versions(spark, path)
    if not done:
        raise FileNotFoundError(f"no complete version below {path}")
    return spark.read.parquet(f"{path}/v={done[-1]}")


def live_buckets(spark: SparkSession, path: str) -> dict[int, str]:
    """Folder of the newest complete copy of every bucket."""
    done = set(complete_versions(spark, path))
    newest: dict[int, tuple[int, str]] = {}
    for folder in folders.matching(spark, f"{path}/v=*/{BUCKET}=*"):
        version, bucket = map(int, re.search(rf"/v=(\d+)/{BUCKET}=(\d+)$", folder).groups())
        if version in done and version >= newest.get(bucket, (-1, ""))[0]:
            newest[bucket] = (version, folder)
    return {bucket: folder for bucket, (_, folder) in newest.items()}


def read_bucketed(
    spark: SparkSession, path: str, schema: StructType | None = None
) -> DataFrame:
    """Newest complete content of a bucketed table.

    It has all columns that any bucket has, NULL where a bucket is older than a column.
    With ``schema`` a table without any version is empty, and its columns are there too.
    """
    noted = description(spark, path)
    if noted is not None or schema is not None:
        schema = all_columns(_schema_of(noted), schema or StructType([]))
    return _read_folders(spark, path, list(live_buckets(spark, path).values()), schema)


def read_buckets_of(spark: SparkSession, path: str, values: DataFrame, schema: StructType) -> DataFrame:
    """Content of the buckets in which these keys (columns in order of the table's) would be.

    The driver sees numbers of buckets.  A table without any version is empty.
    """
    noted = description(spark, path)
    schema = all_columns(_schema_of(noted), schema)
    if noted is None:
        return spark.createDataFrame([], schema)
    places = values.select(bucket_of(values.columns, noted["buckets"])).distinct().collect()
    live = live_buckets(spark, path)
    return _read_folders(spark, path, [live[row[0]] for row in places if row[0] in live], schema)


def _read_folders(
    spark: SparkSession, path: str, found: Sequence[str], schema: StructType | None
) -> DataFrame:
    if not found and schema is None:
        raise FileNotFoundError(f"no complete version below {path}")
    if not found:
        return spark.createDataFrame([], schema)
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(*sorted(found))


def expire(spark: SparkSession, path: str, keep: int = KEPT_VERSIONS) -> int:
    """Remove bucket copies that a newer complete copy replaced; returns their number.

    The newest copy of every bucket stays, and so does every folder of the ``keep``
    newest versions.  This bounds the folders a reader has to list.
    """
    done = complete_versions(spark, path)
    if len(done) <= keep:
        return 0
    live, recent = set(live_buckets(spark, path).values()), done[-keep]
    removed = 0
    for folder in folders.matching(spark, f"{path}/v=*/{BUCKET}=*"):
        version = int(re.search(r"/v=(\d+)/", folder).group(1))
        if version < recent and folder not in live:
            folders.remove(spark, folder)
            removed += 1
    kept = {int(re.search(r"/v=(\d+)/", folder).group(1)) for folder in live}
    for version in done:
        if version < recent and version not in kept:
            folders.remove(spark, f"{path}/v={version}")
    return removed


def merge_bucketed(
    batch: DataFrame,
    path: str,
    keys: Sequence[str],
    buckets: int,
    merge: Callable[[DataFrame, DataFrame, Sequence[str]], DataFrame],
    wait: float = 0.0,
) -> DataFrame | None:
    """Merge ``batch`` (unique by key) into a bucketed table.

    Returns the rows the touched buckets held before, or None for an empty batch.
    The only data that reaches the driver are the numbers of the touched buckets,
    at most as many as the table has.  Merging the same batch twice gives the same
    table, so a repeated micro-batch does no harm.  ``buckets`` counts when the table is
    created; a column that the batch lacks keeps its stored value.
    """
    with only_writer(batch.sparkSession, path, wait):
        return _merge(batch, path, list(keys), buckets, merge)


def _merge(
    batch: DataFrame, path: str, keys: list[str], buckets: int,
    merge: Callable[[DataFrame, DataFrame, Sequence[str]], DataFrame],
) -> DataFrame | None:
    spark = batch.sparkSession
    noted = description(spark, path)
    if noted is not None and noted["keys"] != keys:
        raise ValueError(f"{path} has the keys {noted['keys']}, not {keys}")
    buckets = noted["buckets"] if noted else buckets
    schema = all_columns(_schema_of(noted), batch.schema)
    placed = batch.select(bucket_of(keys, buckets).alias(BUCKET)).distinct()
    touched = {row[0] for row in placed.collect()}
    if not touched:
        return None
    # Noted first: a column without data yet reads as NULL.
    new = {"keys": keys, "buckets": buckets, "schema": json.loads(schema.json())}
    if new != noted:
        folders.write_text(spark, f"{path}/_table.json", json.dumps(new))
    live = live_buckets(spark, path)
    before = _read_folders(
        spark, path, [live[bucket] for bucket in touched if bucket in live], schema
    )
    absent = [c for c in schema.names if c not in batch.columns]
    if absent:
        batch = batch.join(before.select(*keys, *absent), keys, "left").select(*schema.names)
    after = merge(before, batch, keys).withColumn(BUCKET, bucket_of(keys, buckets))
    version = next_version(spark, path)
    # Rebalancing groups the rows of a bucket, but splits a bucket that is larger
    # than the advisory partition size over several tasks.
    (
        after.hint("rebalance", BUCKET)
        .write.mode("overwrite")
        .partitionBy(BUCKET)
        .parquet(f"{path}/v={version}")
    )
    return before
