"""The table of registered queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from medstrata.plans.stand_ins import Tables
from medstrata.plans.tables import Lake
from medstrata.registry.sql import with_inputs

# Whole numbers that hold NULLs in some results.
AS_TEXT = ("birth_year", "satisfaction_score")

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``build(lake)`` under ``name``, with the SQL that gives the same rows.

    Columns of :data:`AS_TEXT` are text on both sides.
    """

    def register(build: Callable[[Lake], DataFrame]) -> Callable[[Lake], DataFrame]:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return presentable(build(Lake(Tables(spark, folder))))

        run.__name__ = name
        run.__doc__ = build.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = with_inputs(sql)
        return build

    return register


def presentable(df: DataFrame) -> DataFrame:
    """Rows in a form that any engine shows alike.

    Dates and times become text, arrays joined text, names lower case; so do the
    whole numbers that may be missing, which clients show as 5, 5.0 or <NA>.
    """
    columns = []
    for name, kind in df.dtypes:
        column = F.col(f"`{name}`")
        if kind in ("date", "timestamp", "timestamp_ntz") or name in AS_TEXT:
            column = column.cast("string")
        elif kind == "array<string>":
            column = F.array_join(column, ",")
        columns.append(column.alias(name.lower()))
    return df.select(*columns)
