"""Gates, projections and audit columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from medstrata.config import batch_id_of
from medstrata.functions.predicates import all_present, new_state


def require(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Keep rows in which every listed key column has a value."""
    return df.filter(all_present(columns))


def keep_new_state(changes: DataFrame, change_type: str = "_change_type") -> DataFrame:
    """Keep the change rows that carry a record's state after the change."""
    return changes.filter(new_state(change_type))


def standardize(df: DataFrame, mapping: Mapping[str, str | tuple[str, str] | Column]) -> DataFrame:
    """Project to ``mapping``: output name -> source name, (source, type) or expression.

    Types are applied with ``try_cast``: a value that does not fit becomes NULL.
    """
    columns = []
    for name, source in mapping.items():
        if isinstance(source, Column):
            column = source
        elif isinstance(source, tuple):
            column = F.col(source[0]).try_cast(source[1])
        else:
            column = F.col(source)
        columns.append(column.alias(name))
    return df.select(*columns)


def with_audit(df: DataFrame, batch_id: str | None = None) -> DataFrame:
    """Add load time, source file and run id to rows read from files."""
    run = batch_id if batch_id is not None else batch_id_of(df.sparkSession)
    return df.select(
        "*",
        F.current_timestamp().alias("_ingest_ts"),
        F.col("_metadata.file_path").alias("_source_file"),
        F.lit(run).alias("_batch_id"),
    )
