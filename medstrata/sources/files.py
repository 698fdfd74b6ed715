"""Raw file formats, malformed records, rescued values, schema growth."""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from medstrata.sources import folders

CORRUPT = "_corrupt_record"

# A file stream leaves out files that are older than its newest by more than this.
ANY_AGE = "36500d"
RESCUED = "_rescued_data"

# Reader options of each raw format: (Spark source name, options).
FORMATS = {
    "parquet": ("parquet", {}),
    "avro": ("avro", {}),
    "csv": ("csv", {"header": "true", "ignoreEmptyLines": "true"}),
    "tsv": ("csv", {"header": "true", "ignoreEmptyLines": "true", "delimiter": "\t"}),
    "json": ("json", {"multiLine": "false"}),
}

# Text formats can hold records that do not parse; the others carry their schema.
TEXT_FORMATS = ("csv", "tsv", "json")

# Formats whose files name their columns in a first line.
HEADED_FORMATS = ("csv", "tsv")

# Columns of the quarantine for files that cannot be read.
BAD_FILE, ERROR = "_bad_file", "_error"

_LISTING = "path string, modificationTime timestamp, length long, content binary"


def reader_options(fmt: str) -> tuple[str, dict[str, str]]:
    """Spark source name and options for a raw format."""
    if fmt not in FORMATS:
        raise ValueError(f"unknown format {fmt!r}; one of {sorted(FORMATS)}")
    source, options = FORMATS[fmt]
    options = dict(options)
    if fmt in TEXT_FORMATS:
        options |= {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    return source, options


def with_corrupt_column(fmt: str, schema: StructType) -> StructType:
    """Read schema that also receives the text of records that do not parse."""
    if fmt not in TEXT_FORMATS or CORRUPT in schema.names:
        return schema
    return StructType([*schema.fields, StructField(CORRUPT, StringType())])


def split_malformed(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good rows, and the text of the records that did not parse."""
    if CORRUPT not in df.columns:
        return df, df.limit(0).select(F.lit(None).cast("string").alias(CORRUPT))
    good = df.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)
    return good, df.filter(F.col(CORRUPT).isNotNull())


def rescue(df: DataFrame, schema: StructType, keep: Sequence[str] = ()) -> DataFrame:
    """Fit text columns to ``schema`` without losing what does not fit.

    A value that cannot be cast and a column that is not expected are kept, as
    JSON text, in ``_rescued_data``; it is NULL for rows that fit entirely.
    Columns named in ``keep`` pass through unchanged.
    """
    expected = {*schema.names, *keep}
    fitted, misfits = [], []
    for column in schema.fields:
        if column.name not in df.columns:
            fitted.append(F.lit(None).cast(column.dataType).alias(column.name))
            continue
        value = F.col(column.name)
        cast = value.try_cast(column.dataType)
        fitted.append(cast.alias(column.name))
        misfits.append(F.when(cast.isNull(), value).alias(column.name))
    misfits += [F.col(c).cast("string").alias(c) for c in df.columns if c not in expected]
    # to_json leaves NULL fields out, so a row without misfits gives '{}'.
    kept = F.nullif(F.to_json(F.struct(*misfits)), F.lit("{}")) if misfits else F.lit(None).cast("string")
    return df.select(*fitted, *keep, kept.alias(RESCUED))


def append_evolving(table: DataFrame, batch: DataFrame) -> DataFrame:
    """Append ``batch``; columns new to the table are NULL in its earlier rows."""
    return table.unionByName(batch, allowMissingColumns=True)


def new_files(
    spark: SparkSession, raw: str, options: Mapping[str, str], max_files: int, max_age: str
) -> DataFrame:
    """Paths of the files below ``raw`` as a stream, each once; their content is not read."""
    return (
        spark.readStream.format("binaryFile").options(**options)
        .option("maxFilesPerTrigger", max_files).option("maxFileAge", max_age)
        .schema(_LISTING).load(raw).select("path")
    )


def exactly(path: str) -> str:
    """A path as a reader takes it: the characters of patterns stand for themselves."""
    return re.sub(r"([\\\[\]{}*?])", r"\\\1", path)


def load(
    spark: SparkSession, fmt: str, paths: Sequence[str], schema: StructType | None, raw: str, options: Mapping[str, str] = {}
) -> DataFrame:
    """Some files of a format below the folder ``raw``."""
    source, known = reader_options(fmt)
    reader = spark.read.format("text" if fmt in HEADED_FORMATS else source)
    reader = reader.options(**({} if fmt in HEADED_FORMATS else known), **options)
    if "recursiveFileLookup" not in options:
        reader = reader.option("basePath", raw)
    if schema is not None and fmt not in HEADED_FORMATS:
        reader = reader.schema(with_corrupt_column(fmt, schema))
    return reader.load([exactly(p) for p in paths])


def _stored(spark: SparkSession, store: str) -> StructType | None:
    location = f"{store}/schema.json"
    if not folders.exists(spark, location):
        return None
    return StructType.fromJson(json.loads(folders.read_text(spark, location)))


def remembered_schema(
    spark: SparkSession, fmt: str, raw: str, store: str, extra: Mapping[str, str] = {}
) -> StructType:
    """Source schema from the schema store, extended by columns of newer files.

    Only a source without a stored schema is looked at as a whole, and of it one file, or
    all that can be read if that one cannot; columns of further files are added with the
    batch that has them, see :func:`extended_schema`.
    """
    known = _stored(spark, store)
    if known is not None:
        return known
    source, options = reader_options(fmt)
    reader = spark.read.format(source).options(**options, **extra)
    try:
        found = reader.load(raw).schema
    except Exception as error:
        if not unreadable(error):
            raise
        found = reader.options(mergeSchema="true", ignoreCorruptFiles="true").load(raw).schema
    folders.write_text(spark, f"{store}/schema.json", found.json())
    return found


def extended_schema(
    spark: SparkSession, paths: Sequence[str], store: str, raw: str, options: Mapping[str, str] = {}
) -> StructType:
    """The stored schema with the columns that only some of these Parquet files have.

    The files' footers are read by tasks; new columns are stored, so a running stream
    loads a column from the first file that has it.  Files without a footer add none.
    """
    known = _stored(spark, store) or StructType([])
    merging = {**options, "mergeSchema": "true", "ignoreCorruptFiles": "true"}
    try:
        found = load(spark, "parquet", paths, None, raw, merging).schema.fields
    except AnalysisException:  # none of the files has a footer
        found = []
    merged = StructType([*known.fields, *[c for c in found if c.name not in known.names]])
    if merged.names != known.names:
        folders.write_text(spark, f"{store}/schema.json", merged.json())
    return merged


def unreadable(error: Exception) -> bool:
    """Whether a job failed because the content of a file could not be read."""
    text = str(error)
    return "FAILED_READ_FILE" in text and "FILE_NOT_EXIST" not in text or "CANNOT_READ_FILE_FOOTER" in text


def split_readable(paths: Sequence[str], read: Callable[[Sequence[str]], object]) -> tuple[list[str], dict[str, str]]:
    """Files that ``read`` gets through, and for each of the others why it does not.

    ``read`` runs over all files, and where it fails over either half.  Only called once
    a batch has failed, so good batches cost nothing; with few bad files each good one
    is read about as often as the number of files has digits to the base of two.
    """
    try:
        if paths:
            read(paths)
        return list(paths), {}
    except Exception as error:
        if not unreadable(error):
            raise
        if len(paths) == 1:
            return [], {paths[0]: str(error).strip().split("\n")[0][:1000]}
    half = len(paths) // 2
    good, bad = split_readable(paths[:half], read)
    more_good, more_bad = split_readable(paths[half:], read)
    return good + more_good, bad | more_bad
