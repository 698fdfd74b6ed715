"""Delimited text files with headers, read as lines by Spark.

Every file names its columns in its first line that is not blank. Lines come from Spark's
text reader, which knows compressed files, byte order marks aside, and file systems; the
header of each file is found by an aggregation over the batch, and lines are parsed with
the header of their own file.  No file is opened outside of the cluster's tasks.
"""

from __future__ import annotations

import csv
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

# The text of a line, its file, and its place there.
LINE, FILE, BLOCK, NUMBER = "_line", "_source_file", "_block", "_number"

# A first line longer than this is not taken for a header.
HEADER_MOST = 1 << 16

_BOM = "\ufeff"


def with_places(text: DataFrame) -> DataFrame:
    """Lines of a text source with their file and place; blank ones are left out.

    The number orders lines within one block of a file.  It is assigned where the
    file is read.
    """
    return text.select(
        F.col("value").alias(LINE),
        F.col("_metadata.file_path").alias(FILE),
        F.col("_metadata.file_block_start").alias(BLOCK),
        F.monotonically_increasing_id().alias(NUMBER),
    ).filter(F.col(LINE).rlike(f"[^\\s{_BOM}]"))


def headers(lines: DataFrame) -> DataFrame:
    """``_source_file, _header, _header_block, _header_number``: one row for each file.

    The least place per file, pre-aggregated by the tasks that read it.
    """
    first = F.min_by(F.struct(F.substring(LINE, 1, HEADER_MOST + 1).alias("line"), BLOCK, NUMBER), F.struct(BLOCK, NUMBER))
    return lines.groupBy(FILE).agg(first.alias("_first")).select(
        FILE, F.col("_first.line").alias("_header"),
        F.col(f"_first.{BLOCK}").alias("_header_block"), F.col(f"_first.{NUMBER}").alias("_header_number"),
    )


def column_names(header: str, separator: str) -> tuple[str, ...] | None:
    """Names in a header line, None if it cannot be one; a repeated or empty name gets its place."""
    if len(header) > HEADER_MOST or "\x00" in header:
        return None
    try:
        names = [n.strip() for n in next(csv.reader([header.removeprefix(_BOM)], delimiter=separator), [])]
    except csv.Error:
        return None
    return tuple(n if n and n not in names[:i] else f"{n or 'column'}_{i + 1}" for i, n in enumerate(names))


def parsed(
    lines: DataFrame, needed: Sequence[str], options: Mapping[str, str], corrupt: str, keep: Sequence[str] = ()
) -> tuple[DataFrame, DataFrame]:
    """Rows by the names of each file's own header, and the lines of files without one.

    A file whose first line lacks a ``needed`` column has no known header: none of its lines
    is guessed at.  A line that does not have its header's columns keeps its text in
    ``corrupt``.  Columns of any header are there, as text; ``keep`` names columns of
    ``lines`` to carry along.  A line breaks at its end, also inside quotes.

    The driver sees one line for each file of the batch.
    """
    separator = options.get("delimiter", ",")
    first = headers(lines).collect()
    by_names: dict[tuple[str, ...], list[str]] = {}
    unknown: list[str] = []
    for row in first:
        names = column_names(row["_header"], separator)
        if names is None or not set(needed) <= set(names):
            unknown.append(row[FILE])
        else:
            by_names.setdefault(names, []).append(row[FILE])
    places = lines.sparkSession.createDataFrame(
        [(r[FILE], r["_header_block"], r["_header_number"]) for r in first], f"{FILE} string, {BLOCK} long, {NUMBER} long"
    )
    body = lines.join(places, [FILE, BLOCK, NUMBER], "left_anti")
    every = dict.fromkeys(n for names in by_names for n in names)
    out = None
    for names, found in by_names.items():
        rows = _rows(body.filter(F.col(FILE).isin(found)), names, every, options, corrupt, keep)
        out = rows if out is None else out.unionByName(rows)
    if out is None:
        out = _rows(body.filter(F.lit(False)), tuple(needed), dict.fromkeys(needed), options, corrupt, keep)
    return out, lines.filter(F.col(FILE).isin(unknown)).select(F.col(LINE).alias(corrupt), *keep)


def _rows(
    body: DataFrame, names: tuple[str, ...], every: Mapping[str, None], options: Mapping[str, str], corrupt: str, keep: Sequence[str]
) -> DataFrame:
    schema = ", ".join(f"c{i} string" for i in range(len(names)))
    read = {**options, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "bad"}
    values = body.select(F.from_csv(LINE, f"{schema}, bad string", read).alias("_row"), *keep)

    def value(name: str) -> Column:
        return F.col("_row")[f"c{names.index(name)}"] if name in names else F.lit(None).cast("string")

    return values.select(*[value(n).alias(n) for n in every], F.col("_row")["bad"].alias(corrupt), *keep)
