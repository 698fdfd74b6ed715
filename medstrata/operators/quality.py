"""Data-quality checks; each gives result rows and costs at most one pass."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType, TimestampType

PASS, FAIL, ERROR = "PASS", "FAIL", "ERROR"

RESULT_SCHEMA = StructType(
    [
        StructField("run_ts", TimestampType()),
        *[
            StructField(name, StringType())
            for name in ("layer", "table_name", "metric", "value", "status", "message")
        ],
    ]
)


def _result(metric: str, value: Column, passed: Column, on_failure: Column | str | None = None):
    note = F.lit(on_failure) if isinstance(on_failure, (str, type(None))) else on_failure
    return F.struct(
        F.lit(metric).alias("metric"),
        value.cast("string").alias("value"),
        F.when(passed, PASS).otherwise(FAIL).alias("status"),
        F.when(passed, None).otherwise(note).cast("string").alias("message"),
    )


def _report(figures: DataFrame, layer: str, table: str, results: Sequence[Column]) -> DataFrame:
    return figures.select(F.inline(F.array(*results))).select(
        F.lit(layer).alias("layer"), F.lit(table).alias("table_name"), "*"
    )


def duplicated_keys(df: DataFrame, key: str) -> DataFrame:
    """Key values that occur more than once, with their number of rows (NULL is a value)."""
    return (
        df.groupBy(key).agg(F.count(F.lit(1)).alias("row_count")).filter(F.col("row_count") > 1)
    )


def key_figures(df: DataFrame, key: str, ingest: str = "_ingest_ts") -> DataFrame:
    """Rows, duplicated keys, NULL keys and load times in one grouped pass.

    Rows are counted per key in the map tasks before the exchange.
    """
    has_ingest = ingest in df.columns
    per_key = df.groupBy(F.col(key).alias("_key")).agg(
        F.count(F.lit(1)).alias("_rows"),
        *([F.max(ingest).alias("_newest"), F.count(ingest).alias("_stamped")] if has_ingest else []),
    )
    def total(column):
        return F.coalesce(F.sum(column), F.lit(0))

    rows = F.col("_rows")
    return per_key.agg(
        total(rows).alias("row_count"),
        F.count_if(rows > 1).alias("dup_pk"),
        total(F.when(F.col("_key").isNull(), rows)).alias("null_pk_count"),
        *(
            [
                F.max("_newest").alias("max__ingest_ts"),
                (total(rows) - total("_stamped")).alias("null__ingest_ts"),
            ]
            if has_ingest else []
        ),
    )


def check_keys(
    df: DataFrame,
    table: str,
    key: str,
    resolved: tuple[DataFrame, str] | None = None,
    unresolved_note: str | None = None,
) -> DataFrame:
    """Raw-layer checks: rows present, unique and non-NULL key, load time present.

    ``resolved`` names the cleaned table and its key: duplicates are accepted when
    that table has none.  ``unresolved_note`` says why it could not be consulted.
    """
    figures = key_figures(df, key)
    unique = F.col("dup_pk") == 0
    duplicates = _result("dup_pk", F.col("dup_pk"), unique, unresolved_note)
    if resolved is not None:
        cleaned, cleaned_key = resolved
        left_over = duplicated_keys(cleaned, cleaned_key).agg(F.count(F.lit(1))).scalar()
        figures = figures.withColumn("_left_over", left_over)
        accepted = ~unique & (F.col("_left_over") == 0)
        duplicates = F.struct(
            F.lit("dup_pk").alias("metric"),
            F.col("dup_pk").cast("string").alias("value"),
            F.when(unique | accepted, PASS).otherwise(FAIL).alias("status"),
            F.when(accepted, "duplicates suppressed downstream").alias("message"),
        )
    results = [
        _result("row_count", F.col("row_count"), F.col("row_count") > 0, "row_count == 0"),
        duplicates,
        _result("null_pk_count", F.col("null_pk_count"), F.col("null_pk_count") == 0),
    ]
    if "max__ingest_ts" in figures.columns:
        newest = F.col("max__ingest_ts")
        results += [
            _result("max__ingest_ts", newest, newest.isNotNull()),
            _result("null__ingest_ts", F.col("null__ingest_ts"), F.col("null__ingest_ts") == 0),
        ]
    return _report(figures, "BRONZE", table, results)


def check_contract(df: DataFrame, table: str, expected: Sequence[str]) -> DataFrame:
    """Cleaned-layer check: no expected column is missing (schema only, no data read)."""
    missing = sorted(set(expected) - set(df.columns))
    figures = df.sparkSession.range(0, 1, 1, 1)
    result = _result(
        "missing_cols_count", F.lit(len(missing)), F.lit(not missing), f"missing={missing}"
    )
    return _report(figures, "SILVER", table, [result])


def check_not_null(df: DataFrame, table: str, columns: Sequence[str]) -> DataFrame:
    """Report-layer check: NULLs of all listed columns, counted in one pass."""
    return _null_report(df.agg(*null_counts(columns)), table, columns)


def null_counts(columns: Sequence[str]) -> list[Column]:
    """NULLs of each column, as an aggregate or as figures to observe while rows are written."""
    return [F.count_if(F.col(c).isNull()).alias(f"_{c}") for c in columns]


def check_observed_nulls(
    spark: SparkSession, figures: Mapping[str, int], table: str, columns: Sequence[str]
) -> DataFrame:
    """The same check from figures of :func:`null_counts` that a write observed; nothing is scanned."""
    row = [tuple(figures[f"_{c}"] or 0 for c in columns)]
    return _null_report(spark.createDataFrame(row, [f"_{c}" for c in columns]), table, columns)


def _null_report(figures: DataFrame, table: str, columns: Sequence[str]) -> DataFrame:
    results = [_result(f"nulls[{c}]", F.col(f"_{c}"), F.col(f"_{c}") == 0) for c in columns]
    return _report(figures, "GOLD", table, results)


def check_none(df: DataFrame, layer: str, table: str, metric: str, count: Column) -> DataFrame:
    """A number of unwanted rows, as an aggregate; passed when there is none."""
    figures = df.agg(count.alias("_rows"))
    return _report(figures, layer, table, [_result(metric, F.col("_rows"), F.col("_rows") == 0)])


@dataclass(frozen=True)
class Check:
    """A check to run later: ``build`` reads its tables and gives result rows."""

    layer: str
    table: str
    build: Callable[[], DataFrame]


def layer_checks(
    load: Callable[[str], DataFrame],
    keys: Mapping[str, str],
    contracts: Mapping[str, Sequence[str]],
    not_null: Mapping[str, Sequence[str]],
    resolved_in: Mapping[str, tuple[str, str]],
    observed: Mapping[str, Callable[[], DataFrame]] = {},
) -> list[Check]:
    """The checks of all three layers over tables that ``load`` finds by name.

    ``observed`` has the report-layer checks whose figures were taken while their table was
    written; the others scan.
    """

    def raw_check(table: str, key: str) -> DataFrame:
        rows = load(table)
        if table not in resolved_in:
            return check_keys(rows, table, key)
        cleaned, cleaned_key = resolved_in[table]
        try:
            return check_keys(rows, table, key, (load(cleaned), cleaned_key))
        except Exception as error:  # the duplicates then stand as found
            return check_keys(
                rows, table, key, unresolved_note=f"Suppression check failed: {error}"
            )

    return [
        *[Check("BRONZE", t, lambda t=t, k=k: raw_check(t, k)) for t, k in keys.items()],
        *[
            Check("SILVER", t, lambda t=t, c=c: check_contract(load(t), t, c))
            for t, c in contracts.items()
        ],
        *[
            Check("GOLD", t, observed.get(t) or (lambda t=t, c=c: check_not_null(load(t), t, c)))
            for t, c in not_null.items()
        ],
    ]


def _collected(run_ts: dt.datetime, reports: Sequence[DataFrame]) -> list[tuple]:
    if not reports:
        return []
    found = reduce(DataFrame.unionByName, reports).collect()
    return [
        (run_ts, r.layer, r.table_name, r.metric, r.value, r.status, r.message) for r in found
    ]


def _broken(run_ts: dt.datetime, check: Check, error: Exception) -> tuple:
    return (run_ts, check.layer, check.table, "exception", None, ERROR, str(error))


def run_checks(
    spark: SparkSession, checks: Sequence[Check], run_ts: dt.datetime, sink: str | None = None,
    noted: Sequence[tuple] = (),
) -> tuple[int, DataFrame]:
    """Run every check; one that breaks becomes an ERROR row and the rest go on.

    The driver sees the result rows only: a handful per table.  Returns 0 when all
    passed, else 1, with the rows, which are appended to ``sink`` when given.  ``noted`` are
    results that came up earlier in the run, as rows without its time.
    """
    rows = [(run_ts, *result) for result in noted]
    reports: list[tuple[Check, DataFrame]] = []
    for check in checks:
        try:
            reports.append((check, check.build()))
        except Exception as error:  # a check that cannot be planned is itself a result
            rows.append(_broken(run_ts, check, error))
    try:
        # All reports in one job: tables that several checks read are computed once.
        rows += _collected(run_ts, [report for _, report in reports])
    except Exception:  # find out which one it was
        for check, report in reports:
            try:
                rows += _collected(run_ts, [report])
            except Exception as error:
                rows.append(_broken(run_ts, check, error))
    results = spark.createDataFrame(rows, RESULT_SCHEMA)
    if sink:
        results.write.mode("append").parquet(sink)
    failed = any(row[5] != PASS for row in rows)
    return int(failed), results
