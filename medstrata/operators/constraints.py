"""Constraints that rows must meet before they are written."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import partial

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Observation, functions as F

from medstrata.operators.quality import FAIL, PASS

VIOLATED = "_violated"


def with_violations(df: DataFrame, constraints: Mapping[str, Column]) -> DataFrame:
    """Add the names of the constraints that a row breaks.

    As in SQL a constraint is broken when it is false; one that gives NULL is met.
    """
    broken = [F.when(~condition, F.lit(name)) for name, condition in constraints.items()]
    return df.withColumn(VIOLATED, F.array_compact(F.array(*broken)))


def split_violations(df: DataFrame, constraints: Mapping[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Rows that meet all constraints, and the others with the names of those they break."""
    judged = with_violations(df, constraints)
    clean = F.size(VIOLATED) == 0
    return judged.filter(clean).drop(VIOLATED), judged.filter(~clean)


def write_checked(
    df: DataFrame,
    constraints: Mapping[str, Column],
    accept: Callable[[DataFrame], object],
    reject: Callable[[DataFrame], object],
) -> dict[str, int]:
    """Hand clean rows to ``accept`` and the others to ``reject``; rows that break each constraint.

    Rows are judged once and counted while they are written: no scan is made for the
    counts.  ``reject`` is called even without rows, so that it can replace earlier ones.
    """
    seen = Observation()
    counts = [F.count_if(F.array_contains(VIOLATED, name)).alias(f"n{i}") for i, name in enumerate(constraints)]
    judged = with_violations(df, constraints).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        clean = F.size(VIOLATED) == 0
        accept(judged.observe(seen, F.count(F.lit(1)).alias("rows"), *counts).filter(clean).drop(VIOLATED))
        found = {name: seen.get[f"n{i}"] or 0 for i, name in enumerate(constraints)}
        reject(judged.filter(~clean))
    finally:
        judged.unpersist()
    return found


def violation_results(layer: str, table: str, found: Mapping[str, int]) -> list[tuple]:
    """Counts as rows of the result log, without the time of the run."""
    return [
        (layer, table, f"violations[{name}]", str(count), FAIL if count else PASS, f"{count} rows set aside" if count else None)
        for name, count in found.items()
    ]


def gate(df: DataFrame, constraints: Mapping[str, Column], write: Callable[[DataFrame, str], object], path: str) -> dict[str, int]:
    """:func:`write_checked` with ``write`` for the table at ``path`` and for the rows set aside beside it."""
    return write_checked(df, constraints, partial(_swapped, write, path), partial(_swapped, write, f"{path}_rejected"))


def _swapped(write: Callable[[DataFrame, str], object], path: str, rows: DataFrame) -> object:
    return write(rows, path)
