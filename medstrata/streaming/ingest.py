"""Incremental file ingest into a raw-layer table that is also its change log."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType, TimestampType

from medstrata.config import AUDIT_COLUMNS, DatasetPaths, batch_id_of
from medstrata.operators.clean import require, with_audit
from medstrata.sources import changelog, files, lines
from medstrata.streaming.runs import run_stream


@dataclass(frozen=True)
class IngestSpec:
    """How the raw files of one dataset become rows of its raw-layer table.

    Without ``schema`` the schema of the files is used and remembered; columns that
    appear later extend the table.  ``project`` fixes the output columns instead.
    """

    fmt: str
    key: Sequence[str]
    schema: StructType | None = None
    project: Callable[[DataFrame], DataFrame] | None = None
    rescue_into: StructType | None = None
    options: dict[str, str] = field(default_factory=dict)
    max_files: int = 1000
    max_file_age: str = files.ANY_AGE  # files of older date than the newest less this are skipped


def file_stream(spark: SparkSession, spec: IngestSpec, paths: DatasetPaths) -> DataFrame:
    """Paths of new files below the raw folder, existing ones included, each once."""
    if spec.fmt not in files.HEADED_FORMATS and spec.schema is None:
        files.remembered_schema(spark, spec.fmt, paths.raw, paths.schema, spec.options)
    files.reader_options(spec.fmt)
    return files.new_files(spark, paths.raw, spec.options, spec.max_files, spec.max_file_age)


@dataclass(frozen=True)
class _Loaded:
    """Rows of some files, and what of them goes to quarantine."""

    rows: DataFrame
    bad: DataFrame | None


class _Loader:
    """Reads the files of one dataset: schema, header or records as their format has them."""

    def __init__(self, spark: SparkSession, spec: IngestSpec, paths: DatasetPaths):
        self.spark, self.spec, self.paths = spark, spec, paths
        self.headed = spec.fmt in files.HEADED_FORMATS

    def empty(self) -> DataFrame:
        """No rows, in the columns that are known before any file is read."""
        spec, audit = self.spec, StructType([StructField(c, StringType()) for c in AUDIT_COLUMNS])
        audit["_ingest_ts"].dataType = TimestampType()
        known = spec.schema
        if known is None and self.headed:
            known = StructType([StructField(c, StringType()) for c in spec.key])
        elif known is None:
            known = files.remembered_schema(self.spark, spec.fmt, self.paths.raw, self.paths.schema, spec.options)
        return self.spark.createDataFrame([], StructType([*known.fields, *audit.fields]))

    def raw(self, found: Sequence[str]) -> DataFrame:
        """The files as Spark's reader gives them."""
        spec, raw, schema = self.spec, self.paths.raw, self.spec.schema
        if schema is None and spec.fmt == "parquet":
            schema = files.extended_schema(self.spark, found, self.paths.schema, raw, spec.options)
        elif schema is None and not self.headed:
            schema = files.remembered_schema(self.spark, spec.fmt, raw, self.paths.schema, spec.options)
        return files.load(self.spark, spec.fmt, found, schema, raw, spec.options)

    def probe(self, found: Sequence[str]) -> None:
        """Read the files to their ends and keep nothing."""
        self.raw(found).write.format("noop").mode("overwrite").save()

    @contextmanager
    def loaded(self, found: Sequence[str]) -> Iterator[_Loaded]:
        run = batch_id_of(self.spark)
        if self.spec.fmt not in files.TEXT_FORMATS:
            yield _Loaded(with_audit(self.raw(found), run), None)
            return
        # Headers, rows and what is set aside all need the files; keep them for those passes.
        read = lines.with_places(self.raw(found)) if self.headed else with_audit(self.raw(found), run)
        read = read.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            if self.headed:
                stamped = read.withColumns({"_ingest_ts": F.current_timestamp(), "_batch_id": F.lit(run)})
                rows, unknown = lines.parsed(
                    stamped, self.spec.key, files.reader_options(self.spec.fmt)[1], files.CORRUPT, AUDIT_COLUMNS
                )
                good, bad = files.split_malformed(rows)
                bad = bad.select(files.CORRUPT, *AUDIT_COLUMNS).unionByName(unknown)
                yield _Loaded(self._in_order(good), bad)
            else:
                good, bad = files.split_malformed(read)
                yield _Loaded(good, bad.select(files.CORRUPT, *AUDIT_COLUMNS))
        finally:
            read.unpersist()

    def _in_order(self, rows: DataFrame) -> DataFrame:
        """All columns that are expected, then those that some header has besides."""
        expected = self.spec.schema.names if self.spec.schema is not None else []
        known = [F.col(f"`{c}`") if c in rows.columns else F.lit(None).cast("string").alias(c) for c in expected]
        return rows.select(*known, *[F.col(f"`{c}`") for c in rows.columns if c not in expected])


def ingest(
    spark: SparkSession, spec: IngestSpec, paths: DatasetPaths, mode: str = "batch"
) -> StreamingQuery:
    """Load new raw files: quarantine, key gate, audit columns, append as a commit.

    The stream is one of file names; a micro-batch reads the files named in it, at most
    ``max_files``.  Records that do not parse, lines of files without a known header, and
    the names of files that cannot be read to their end go to quarantine, everything else
    is loaded.  A file that was set aside is loaded once it comes under another name.  A
    micro-batch that is repeated after a failure replaces its own commit.
    """
    loader = _Loader(spark, spec, paths)
    stream = file_stream(spark, spec, paths)

    def table_rows(rows: DataFrame) -> DataFrame:
        if spec.rescue_into is not None:
            rows = files.rescue(rows, spec.rescue_into, keep=AUDIT_COLUMNS)
        if spec.project is not None:
            rows = spec.project(rows)
        return changelog.as_inserts(require(rows, spec.key))

    def write(found: Sequence[str], run_id: str) -> None:
        with loader.loaded(found) as loaded:
            changelog.append_commit(table_rows(loaded.rows), paths.table, run_id)
            if loaded.bad is not None and not loaded.bad.isEmpty():
                changelog.append_commit(loaded.bad, paths.quarantine, run_id)

    def append(batch: DataFrame, number: int) -> None:
        run_id = f"{mode}-{number}"
        # At most max_files names; names that look like patterns are listed more than once.
        found = sorted({row[0] for row in batch.collect()})
        if not found:
            return
        try:
            write(found, run_id)
        except Exception as error:
            if not files.unreadable(error):
                raise
            found, bad = files.split_readable(found, loader.probe)
            if found:
                write(found, run_id)
            told = spark.createDataFrame(sorted(bad.items()), f"{files.BAD_FILE} string, {files.ERROR} string")
            noted = told.withColumns({"_ingest_ts": F.current_timestamp(), "_batch_id": F.lit(batch_id_of(spark))})
            changelog.append_commit(noted, paths.quarantine, f"{run_id}-files")

    changelog.create(table_rows(loader.empty()), paths.table)
    return run_stream(stream, append, paths.checkpoint_for(mode), mode)
