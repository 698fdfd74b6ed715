"""Cleaning and deduplication queries."""

from pyspark.sql import functions as F

from medstrata.functions.masking import birth_year, masked
from medstrata.functions.parsing import (
    DATE_PATTERN, date_of, instant_of, local_time, text_map, zone_provenance,
)
from medstrata.config import PHI_COLUMNS
from medstrata.operators.clean import keep_new_state, require, standardize, with_audit
from medstrata.operators.dedupe import latest_commit, latest_per_key
from medstrata.plans import healthcare
from medstrata.plans.tables import Lake
from medstrata.registry.catalog import query

LOCAL_ZONE = "America/New_York"


@query(
    "audit_columns",
    """
SELECT CAST(c_custkey AS VARCHAR) AS id, 'manual' AS _batch_id,
  'customer.parquet' AS source_file, TRUE AS has_ingest_ts
FROM customer""",
)
def audit_columns(lake: Lake):
    """Load time is a clock reading, so only its presence is compared."""
    loaded = with_audit(lake.t.read("customer"))
    return loaded.select(
        F.col("c_custkey").cast("string").alias("id"),
        "_batch_id",
        F.regexp_extract("_source_file", r"/([^/]+\.parquet)", 1).alias("source_file"),
        F.col("_ingest_ts").isNotNull().alias("has_ingest_ts"),
    )


@query(
    "pk_gate",
    """
SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS first, _change_type, _commit_version
FROM patient_feed WHERE c_acctbal >= 0""",
)
def pk_gate(lake: Lake):
    return require(lake.bronze_patients, ["ID"]).select(
        F.col("ID").alias("id"), F.col("FIRST").alias("first"), "_change_type", "_commit_version"
    )


@query(
    "silver_fk_gate",
    """
SELECT claim_id, patient_id, provider_id, CAST(claim_date AS VARCHAR) AS claim_date
FROM claim_feed WHERE patient_id IS NOT NULL""",
)
def silver_fk_gate(lake: Lake):
    kept = require(lake.bronze_claims, ["ClaimID", "PatientID", "ProviderID"])
    return standardize(
        kept,
        {"claim_id": "ClaimID", "patient_id": "PatientID", "provider_id": "ProviderID",
         "claim_date": "ClaimDate"},
    )


@query(
    "change_type_filter",
    """
SELECT _change_type, COUNT(*) AS change_rows, COUNT(DISTINCT claim_id) AS claims
FROM claim_feed WHERE _change_type IN ('insert', 'update_postimage') GROUP BY 1""",
)
def change_type_filter(lake: Lake):
    kept = keep_new_state(lake.bronze_claims)
    return kept.groupBy("_change_type").agg(
        F.count(F.lit(1)).alias("change_rows"), F.countDistinct("ClaimID").alias("claims")
    )


@query(
    "standardize_claims",
    """
SELECT * EXCLUDE (_change_type)
  REPLACE (CAST(claim_date AS VARCHAR) AS claim_date,
           CAST(_commit_timestamp AS VARCHAR) AS _commit_timestamp)
FROM claim_feed
WHERE _change_type IN ('insert', 'update_postimage') AND patient_id IS NOT NULL""",
)
def standardize_claims(lake: Lake):
    return healthcare.claim_rows(lake.bronze_claims)


@query(
    "mask_phi",
    f"""
SELECT id, CAST(YEAR(TRY_CAST(birthdate AS DATE)) AS VARCHAR) AS birth_year, gender,
  {', '.join(f'CAST(NULL AS VARCHAR) AS {c.lower()}' for c in PHI_COLUMNS)}
FROM patient_feed""",
)
def mask_phi(lake: Lake):
    return lake.bronze_patients.select(
        F.col("ID").alias("id"), birth_year("BIRTHDATE").alias("birth_year"),
        F.col("GENDER").alias("gender"), *masked(PHI_COLUMNS),
    )


@query(
    "parse_dates_tolerant",
    """
SELECT encounter_id, _commit_version, CAST(start_ts AS VARCHAR) AS start_ts,
  CAST(CAST(start_ts AS DATE) AS VARCHAR) AS start_date
FROM encounter_feed""",
)
def parse_dates_tolerant(lake: Lake):
    return lake.bronze_encounters.select(
        F.col("ID").alias("encounter_id"),
        "_commit_version",
        instant_of("DATE", DATE_PATTERN).alias("start_ts"),
        date_of("DATE").alias("start_date"),
    )


@query(
    "feedback_time_utc",
    """
SELECT feedback_id, visit_id, timestamp_source, CAST(utc AS VARCHAR) AS utc, k
FROM feedback_rows""",
)
def feedback_time_utc(lake: Lake):
    return lake.bronze_feedback.select(
        "feedback_id", "visit_id",
        zone_provenance("timestamp").alias("timestamp_source"),
        instant_of("timestamp").alias("utc"),
        text_map("metadata_json")["k"].alias("k"),
    )


@query(
    "feedback_local_time",
    f"""
SELECT feedback_id, visit_id, k,
  CAST(timezone('{LOCAL_ZONE}', timezone('UTC', utc)) AS VARCHAR) AS local_ts
FROM feedback_rows""",
)
def feedback_local_time(lake: Lake):
    return lake.bronze_feedback.select(
        "feedback_id", "visit_id", text_map("metadata_json")["k"].alias("k"),
        local_time(instant_of("timestamp"), LOCAL_ZONE).alias("local_ts"),
    )


@query(
    "json_to_map",
    """
SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(props->>'$.k' AS VARCHAR) AS k,
  CAST(len(json_keys(props)) AS INTEGER) AS entries
FROM events""",
)
def json_to_map(lake: Lake):
    parsed = lake.t.read("events").withColumn("metadata", text_map("props"))
    return parsed.select(
        F.col("event_id").cast("string").alias("event_id"),
        F.col("metadata")["k"].alias("k"),
        F.size("metadata").alias("entries"),
    )


@query(
    "dedupe_latest_commit",
    """
SELECT claim_id, patient_id, provider_id, claim_amount, CAST(claim_date AS VARCHAR) AS claim_date,
  claim_status
FROM claims""",
)
def dedupe_latest_commit(lake: Lake):
    latest = latest_commit(
        healthcare.claim_rows(lake.bronze_claims), ["claim_id"], healthcare.CLAIM_TIE_BREAK
    )
    return latest.select(
        "claim_id", "patient_id", "provider_id", "claim_amount", "claim_date", "claim_status"
    )


@query(
    "dedupe_latest_event",
    'SELECT feedback_id, provider_id, visit_id, "timestamp", timestamp_source, k FROM feedback',
)
def dedupe_latest_event(lake: Lake):
    return healthcare.feedback(lake.bronze_feedback).select(
        "feedback_id", "provider_id", "visit_id", "timestamp", "timestamp_source",
        F.col("metadata")["k"].alias("k"),
    )


@query(
    "dedupe_latest_snapshot",
    """
SELECT provider_id, arg_max(COALESCE(provider_specialty, '-'), _ingest_ts) AS specialty,
  arg_max(provider_location, _ingest_ts) AS location, MAX(_ingest_ts) AS loaded
FROM provider_rows WHERE provider_id IS NOT NULL GROUP BY provider_id""",
)
def dedupe_latest_snapshot(lake: Lake):
    latest = latest_per_key(
        require(lake.bronze_providers, ["ProviderID"]), ["ProviderID"], ["_ingest_ts"]
    )
    return latest.select(
        F.col("ProviderID").alias("provider_id"),
        F.coalesce("ProviderSpecialty", F.lit("-")).alias("specialty"),
        F.col("ProviderLocation").alias("location"),
        F.col("_ingest_ts").alias("loaded"),
    )
