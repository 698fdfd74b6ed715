"""Change logs: Parquet folders ``_commit_version=N/_run_id=R`` of change rows.

An append-only table is its own change log (every row is an insert).  Readers get
the commit number from the folder name, in batch and as a file stream.
"""

from __future__ import annotations

import json
import re

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from medstrata.sources import folders
from medstrata.sources.files import ANY_AGE
from medstrata.sources.tables import all_columns

VERSION = "_commit_version"
RUN_ID = "_run_id"


def _numbers(spark: SparkSession, path: str) -> list[int]:
    """Commit numbers of the log: one folder listing, however long the log is."""
    found = folders.matching(spark, f"{path}/{VERSION}=*")
    return sorted(int(folder.rpartition("=")[2]) for folder in found)


def _newest_complete(spark: SparkSession, path: str) -> str | None:
    """Folder of the newest commit that was written to its end."""
    for number in reversed(_numbers(spark, path)):
        done = folders.matching(spark, f"{path}/{VERSION}={number}/{RUN_ID}=*/_SUCCESS")
        if done:
            return done[-1].removesuffix("/_SUCCESS")
    return None


def append_commit(changes: DataFrame, path: str, run_id: str) -> int:
    """Write ``changes`` as the next commit of the log and return its number.

    ``run_id`` names the unit of work; its number is noted before anything is
    written.  Repeating it, as a restarted stream repeats its last micro-batch,
    replaces the folder written before under its old number.  Commit 0 is left to
    the creation of the table.
    """
    spark = changes.sparkSession
    version = noted_number(spark, path, run_id)
    if version is None:
        version = max(_numbers(spark, path), default=0) + 1
        folders.write_text(spark, f"{path}/_runs/{run_id}", str(version))
    write_commit(changes, path, version, run_id)
    return version


def write_commit(changes: DataFrame, path: str, version: int, run_id: str = "manual") -> None:
    """Write one commit under a given number; writing it again replaces it."""
    spark, rows = changes.sparkSession, changes.drop(VERSION, RUN_ID)
    noted = _noted(spark, path)
    columns = all_columns(noted, rows.schema)
    if columns.names != noted.names:
        folders.write_text(spark, f"{path}/_columns.json", columns.json())
    rows.write.mode("overwrite").parquet(f"{path}/{VERSION}={version}/{RUN_ID}={run_id}")


def create(shape: DataFrame, path: str) -> None:
    """Create a missing log as commit 0: the columns of ``shape``, no rows.

    A stream can then be started on a log that no one has written to yet.
    """
    if not _numbers(shape.sparkSession, path):
        write_commit(shape.limit(0), path, 0, "created")


def complete_through(spark: SparkSession, path: str, after: int) -> int:
    """The newest commit up to which all commits later than ``after`` are complete."""
    found = folders.matching(spark, f"{path}/{VERSION}=*/{RUN_ID}=*/_SUCCESS")
    done = {int(re.search(rf"/{VERSION}=(\d+)/", marker).group(1)) for marker in found}
    newest = after
    for number in _numbers(spark, path):
        if number > after:
            if number not in done:
                break
            newest = number
    return newest


class Position:
    """How far a reader has got in a log, noted in a file of its own."""

    def __init__(self, spark: SparkSession, log: str, note: str):
        self.spark, self.log, self.note = spark, log, note

    def read(self) -> int:
        """The last commit that was taken in; 0 for none."""
        return int(folders.read_text(self.spark, self.note)) if folders.exists(self.spark, self.note) else 0

    def unread(self) -> tuple[DataFrame | None, int]:
        """Rows of complete commits after the noted one, and the last of these commits.

        Older commit folders are not read.  None if there is no newer commit.
        """
        last = self.read()
        newest = complete_through(self.spark, self.log, last)
        if newest == last:
            return None, last
        return read_log(self.spark, self.log, last + 1).filter(F.col(VERSION) <= newest), newest

    def advance(self, version: int) -> None:
        """Note a commit once what came of it is written."""
        folders.write_text(self.spark, self.note, str(version))


def noted_number(spark: SparkSession, path: str, run_id: str) -> int | None:
    """The commit that an earlier run of this name has written or begun."""
    note = f"{path}/_runs/{run_id}"
    return int(folders.read_text(spark, note)) if folders.exists(spark, note) else None


def newest_numbers(spark: SparkSession, path: str, count: int) -> list[int]:
    """The newest ``count`` commit numbers, from folder names."""
    return _numbers(spark, path)[-count:]


def has_commits(spark: SparkSession, path: str) -> bool:
    return _newest_complete(spark, path) is not None


def as_inserts(rows: DataFrame) -> DataFrame:
    """Change rows of an append: every row is an insert of this commit."""
    return rows.select(
        "*",
        F.lit("insert").alias("_change_type"),
        F.current_timestamp().alias("_commit_timestamp"),
    )


def log_schema(spark: SparkSession, path: str) -> StructType:
    """Columns of the log: those noted with it and those of its newest complete commit.

    The note grows with every commit that brings a new column, also when a later commit
    lacks it; no footers but one are read.
    """
    newest = _newest_complete(spark, path)
    if newest is None:
        raise FileNotFoundError(f"no commit below {path}")
    stored = all_columns(_noted(spark, path), spark.read.parquet(newest).schema).fields
    return StructType(
        [*stored, StructField(VERSION, LongType()), StructField(RUN_ID, StringType())]
    )


def _noted(spark: SparkSession, path: str) -> StructType:
    location = f"{path}/_columns.json"
    if not folders.exists(spark, location):
        return StructType([])
    return StructType.fromJson(json.loads(folders.read_text(spark, location)))


def read_log(spark: SparkSession, path: str, starting_version: int = 0) -> DataFrame:
    """Change rows from ``starting_version`` on; older commit folders are not read."""
    log = spark.read.schema(log_schema(spark, path)).parquet(path)
    return log.filter(F.col(VERSION) >= starting_version).drop(RUN_ID)


def stream_log(
    spark: SparkSession, path: str, starting_version: int = 1, max_files: int | None = 1000
) -> DataFrame:
    """The log as a file stream; by default commit 0, the table creation, is skipped.

    A commit may be spread over several micro-batches, each of at most ``max_files``
    files.  With None a bounded run takes its whole backlog as one micro-batch, so a
    table that it is merged into is rewritten once.  Files count whatever their date.
    """
    reader = spark.readStream.schema(log_schema(spark, path)).option("maxFileAge", ANY_AGE)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    stream = reader.parquet(path)
    return stream.filter(F.col(VERSION) >= starting_version).drop(RUN_ID)
