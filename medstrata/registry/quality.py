"""Data-quality queries."""

import datetime as dt

from pyspark.sql import functions as F

from medstrata.operators.quality import (
    check_keys, check_not_null, duplicated_keys, layer_checks, run_checks,
)
from medstrata.plans import healthcare
from medstrata.plans.tables import Lake
from medstrata.registry.catalog import query
from medstrata.session import work_dir

RUN_TS = dt.datetime(2025, 1, 1)


def key_check_sql(table: str, key: str, rows: str, resolved: str | None = None) -> str:
    """The key checks of one raw table as SQL; ``resolved`` counts duplicates left over."""
    accepted = f"({resolved}) = 0" if resolved else "FALSE"
    return f"""
SELECT 'BRONZE' AS layer, '{table}' AS table_name, m.metric,
  CASE m.metric WHEN 'row_count' THEN CAST(f.n AS VARCHAR) WHEN 'dup_pk' THEN CAST(f.dup AS VARCHAR)
    WHEN 'null_pk_count' THEN CAST(f.nulls AS VARCHAR) WHEN 'max__ingest_ts' THEN f.newest
    ELSE CAST(f.unstamped AS VARCHAR) END AS value,
  CASE WHEN m.metric = 'row_count' AND f.n = 0
         OR m.metric = 'dup_pk' AND f.dup > 0 AND NOT {accepted}
         OR m.metric = 'null_pk_count' AND f.nulls > 0
         OR m.metric = 'max__ingest_ts' AND f.newest IS NULL
         OR m.metric = 'null__ingest_ts' AND f.unstamped > 0 THEN 'FAIL' ELSE 'PASS' END AS status,
  CASE WHEN m.metric = 'row_count' AND f.n = 0 THEN 'row_count == 0'
       WHEN m.metric = 'dup_pk' AND f.dup > 0 AND {accepted}
         THEN 'duplicates suppressed downstream' END AS message
FROM (SELECT (SELECT COUNT(*) FROM {rows}) AS n,
        (SELECT COUNT(*) FROM (SELECT {key} FROM {rows} GROUP BY {key} HAVING COUNT(*) > 1)) AS dup,
        (SELECT COUNT(*) FROM {rows} WHERE {key} IS NULL) AS nulls,
        (SELECT CAST(MAX(_ingest_ts) AS VARCHAR) FROM {rows}) AS newest,
        (SELECT COUNT(*) FROM {rows} WHERE _ingest_ts IS NULL) AS unstamped) f,
     (VALUES ('row_count'), ('dup_pk'), ('null_pk_count'), ('max__ingest_ts'), ('null__ingest_ts'))
       m(metric)"""


_PATIENT_ROWS = "(SELECT *, '2024-01-01 00:00:00' AS _ingest_ts FROM patient_feed)"
_PATIENTS_LEFT_OVER = (
    "SELECT COUNT(*) FROM (SELECT id FROM patients GROUP BY id HAVING COUNT(*) > 1)"
)
_FEEDBACK_ROWS = "(SELECT *, CAST(ts AS VARCHAR) AS _ingest_ts FROM feedback_rows)"

_CHECK_CLAIMS = key_check_sql("bronze_claims", "claim_id", "claim_feed")
_CHECK_PATIENTS = key_check_sql("bronze_patients", "id", _PATIENT_ROWS, _PATIENTS_LEFT_OVER)

_CONTRACTS = " UNION ALL ".join(
    f"SELECT 'SILVER' AS layer, '{table}' AS table_name, 'missing_cols_count' AS metric, "
    "'0' AS value, 'PASS' AS status, NULL AS message"
    for table in healthcare.CONTRACTS
)


def _not_null_sql(table: str, column: str, rows: str) -> str:
    return f"""
SELECT 'GOLD' AS layer, '{table}' AS table_name, 'nulls[{column}]' AS metric,
  CAST(COUNT(*) FILTER (WHERE {column} IS NULL) AS VARCHAR) AS value,
  CASE WHEN COUNT(*) FILTER (WHERE {column} IS NULL) = 0 THEN 'PASS' ELSE 'FAIL' END AS status,
  NULL AS message
FROM {rows}"""


_NOT_NULL = " UNION ALL ".join(
    [
        _not_null_sql("gold_patient_lifecycle", "patient_id", "lifecycle"),
        _not_null_sql("gold_feedback_satisfaction", "provider_id", "feedback_enriched"),
        _not_null_sql("gold_claim_approval_by_specialty", "provider_specialty", "approval"),
        _not_null_sql("gold_provider_daily_spend", "provider_id", "daily_spend"),
    ]
)


@query("check_bronze", _CHECK_CLAIMS)
def check_bronze(lake: Lake):
    return check_keys(lake.bronze_claims, "bronze_claims", "ClaimID")


@query("check_bronze_suppressed", _CHECK_PATIENTS)
def check_bronze_suppressed(lake: Lake):
    return check_keys(
        lake.bronze_patients, "bronze_patients", "ID", (lake.silver_patients, "id")
    )


@query(
    "check_not_null",
    " UNION ALL ".join(
        _not_null_sql("silver_claims_enriched", c, "claims_enriched")
        for c in ("provider_id", "provider_specialty", "diagnosis_code")
    ),
)
def check_nulls_per_column(lake: Lake):
    """One pass for all columns; two of them do hold NULLs."""
    return check_not_null(
        lake.silver_claims_enriched, "silver_claims_enriched",
        ["provider_id", "provider_specialty", "diagnosis_code"],
    )


@query(
    "dup_keys",
    "SELECT claim_id, COUNT(*) AS row_count FROM claim_feed GROUP BY 1 HAVING COUNT(*) > 1",
)
def dup_keys(lake: Lake):
    return duplicated_keys(lake.bronze_claims, "ClaimID").withColumnRenamed("ClaimID", "claim_id")


@query(
    "validation_results",
    " UNION ALL ".join(
        [
            _CHECK_CLAIMS,
            key_check_sql("bronze_feedback", "feedback_id", _FEEDBACK_ROWS),
            key_check_sql("bronze_providers", "provider_id", "provider_rows"),
            key_check_sql("bronze_encounters", "encounter_id", "encounter_feed"),
            _CHECK_PATIENTS,
            _CONTRACTS,
            _NOT_NULL,
        ]
    ),
)
def validation_results(lake: Lake):
    """Every check of every layer, appended to a result table and read back."""
    spark = lake.t.spark
    sink = work_dir(spark, "validation")
    checks = layer_checks(
        lake.table, healthcare.RAW_KEYS, healthcare.CONTRACTS, healthcare.NOT_NULL,
        healthcare.DUPLICATES_RESOLVED_IN,
    )
    run_checks(spark, checks, RUN_TS, sink)
    return spark.read.parquet(sink).filter(F.col("run_ts") == F.lit(RUN_TS)).drop("run_ts")
