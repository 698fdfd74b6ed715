"""Cleaned and enriched tables of the five healthcare datasets.

Every function maps DataFrames to DataFrames; the same function runs over a whole
table and inside a micro-batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from medstrata.config import AUDIT_COLUMNS, PHI_COLUMNS
from medstrata.functions.masking import birth_year, masked
from medstrata.functions.parsing import (
    DATE_PATTERN, date_of, instant_of, text_map, zone_provenance,
)
from medstrata.operators.clean import keep_new_state, require, standardize
from medstrata.operators.dedupe import COMMIT_ORDER, latest_commit, latest_per_key
from medstrata.operators.enrich import left_enrich
from medstrata.operators.upsert import open_versions

# --- fixed values: required columns of the cleaned and report tables ---------
CONTRACTS = {
    "silver_claims": (
        "claim_id", "patient_id", "provider_id", "claim_amount", "claim_date",
        "diagnosis_code", "procedure_code", "claim_status", "claim_type",
        "claim_submission_method", "_ingest_ts",
    ),
    "silver_patients": ("id", "birth_year", "marital", "race", "ethnicity", "gender"),
    "silver_encounters": (
        "encounter_id", "patient_id", "START_TS", "CODE", "DESCRIPTION",
        "REASONCODE", "REASONDESCRIPTION",
    ),
    "silver_providers": (
        "provider_id", "provider_specialty", "provider_location",
        "eff_start_ts", "eff_end_ts", "is_current",
    ),
    "silver_feedback": (
        "feedback_id", "provider_id", "timestamp", "timestamp_source", "visit_id",
        "satisfaction_score", "source", "tags", "metadata",
    ),
    "silver_claims_enriched": (
        "claim_id", "provider_specialty", "provider_location", "provider_missing",
    ),
    "silver_feedback_enriched": (
        "feedback_id", "provider_specialty", "provider_location",
        "provider_missing", "encounter_missing",
    ),
    "silver_encounters_enriched": (
        "encounter_id", "gender", "birth_year", "patient_missing",
    ),
}

NOT_NULL = {
    "gold_patient_lifecycle": ("patient_id",),
    "gold_feedback_satisfaction": ("provider_id",),
    "gold_claim_approval_by_specialty": ("provider_specialty",),
    "gold_provider_daily_spend": ("provider_id",),
}

# Raw-layer tables and their primary keys.
RAW_KEYS = {
    "bronze_claims": "ClaimID",
    "bronze_feedback": "feedback_id",
    "bronze_providers": "ProviderID",
    "bronze_encounters": "ID",
    "bronze_patients": "ID",
}

# Raw-layer duplicates that are accepted when the cleaned table has none.
DUPLICATES_RESOLVED_IN = {"bronze_patients": ("silver_patients", "id")}
# ----------------------------------------------------------------------------

TRACKED = ("provider_specialty", "provider_location")

# Orders claims that share commit number and time.
CLAIM_TIE_BREAK = ("claim_amount", "patient_id", "provider_id")

# Order rows of patients and encounters that share commit number and time: by file, then
# by all they say, so rows of one file resolve alike on every replay.
PATIENT_TIE_BREAK = ("_source_file", "birth_year", "marital", "race", "ethnicity", "gender")
ENCOUNTER_TIE_BREAK = (
    "_source_file", "START_TS", "patient_id", "CODE", "DESCRIPTION", "REASONCODE", "REASONDESCRIPTION",
)

def _carried(*columns: str) -> dict[str, str]:
    return {c: c for c in columns}


# ---- claims -----------------------------------------------------------------

def claim_rows(changes: DataFrame) -> DataFrame:
    """Change rows of raw claims as cleaned claims, commit columns kept."""
    kept = require(keep_new_state(changes), ["ClaimID", "PatientID", "ProviderID"])
    return standardize(
        kept,
        {
            "claim_id": "ClaimID",
            "patient_id": "PatientID",
            "provider_id": "ProviderID",
            "claim_amount": ("ClaimAmount", "double"),
            "claim_date": date_of("ClaimDate"),
            "diagnosis_code": "DiagnosisCode",
            "procedure_code": "ProcedureCode",
            "claim_status": "ClaimStatus",
            "claim_type": "ClaimType",
            "claim_submission_method": "ClaimSubmissionMethod",
        }
        | _carried(*AUDIT_COLUMNS, *COMMIT_ORDER),
    )


def claims(changes: DataFrame) -> DataFrame:
    """Cleaned claims: latest version of each claim in ``changes``."""
    return latest_commit(claim_rows(changes), ["claim_id"], CLAIM_TIE_BREAK)


# ---- patients ---------------------------------------------------------------

def patient_rows(changes: DataFrame) -> DataFrame:
    """Change rows of raw patients, masked; only the birth year is kept."""
    kept = require(keep_new_state(changes), ["ID"])
    return kept.select(
        F.col("ID").alias("id"),
        birth_year("BIRTHDATE").alias("birth_year"),
        *masked(PHI_COLUMNS),
        *[F.col(c).alias(c.lower()) for c in ("MARITAL", "RACE", "ETHNICITY", "GENDER")],
        *AUDIT_COLUMNS,
        *COMMIT_ORDER,
    )


def patients(changes: DataFrame) -> DataFrame:
    return latest_commit(patient_rows(changes), ["id"], PATIENT_TIE_BREAK)


# ---- encounters -------------------------------------------------------------

def encounter_rows(changes: DataFrame) -> DataFrame:
    """Change rows of raw encounters; an unreadable date is NULL, the row stays."""
    kept = require(keep_new_state(changes), ["ID", "PATIENT"])
    return standardize(
        kept,
        {
            "encounter_id": "ID",
            "patient_id": "PATIENT",
            "START_TS": instant_of("DATE", DATE_PATTERN),
            "CODE": ("CODE", "string"),
            "DESCRIPTION": "DESCRIPTION",
            "REASONCODE": ("REASONCODE", "string"),
            "REASONDESCRIPTION": "REASONDESCRIPTION",
        }
        | _carried(*AUDIT_COLUMNS, *COMMIT_ORDER),
    )


def encounters(changes: DataFrame) -> DataFrame:
    return latest_commit(encounter_rows(changes), ["encounter_id"], ENCOUNTER_TIE_BREAK)


# ---- providers --------------------------------------------------------------

def provider_snapshot(raw: DataFrame) -> DataFrame:
    """Latest raw row per provider, as current rows of a type-2 history."""
    newest = latest_per_key(
        require(raw, ["ProviderID"]), ["ProviderID"], ["_ingest_ts"],
        tie_break=("ProviderSpecialty", "ProviderLocation"),
    )
    return open_versions(
        standardize(
            newest,
            {
                "provider_id": "ProviderID",
                "provider_specialty": "ProviderSpecialty",
                "provider_location": "ProviderLocation",
            }
            | _carried(*AUDIT_COLUMNS),
        )
    )


def current_providers(history: DataFrame) -> DataFrame:
    return history.filter(F.col("is_current")).select("provider_id", *TRACKED)


# ---- feedback ---------------------------------------------------------------

def feedback_rows(raw: DataFrame) -> DataFrame:
    """Cleaned feedback rows; the free-text comments are not carried over."""
    kept = require(raw, ["feedback_id", "provider_id", "visit_id"])
    return standardize(
        kept,
        {
            "feedback_id": "feedback_id",
            "provider_id": "provider_id",
            "timestamp": instant_of("timestamp"),
            "timestamp_source": zone_provenance("timestamp"),
            "visit_id": "visit_id",
            "satisfaction_score": "satisfaction_score",
            "source": "source",
            "tags": "tags",
            "metadata": text_map("metadata_json"),
        }
        | _carried(*AUDIT_COLUMNS),
    )


def feedback(raw: DataFrame) -> DataFrame:
    """Latest cleaned row per feedback id, by event time, then load time."""
    return latest_per_key(
        feedback_rows(raw), ["feedback_id"], ["timestamp", "_ingest_ts"],
        tie_break=("provider_id", "visit_id"),
    )


# ---- enriched ---------------------------------------------------------------

def claims_enriched(claim: DataFrame, history: DataFrame) -> DataFrame:
    """Claims with the current attributes of their provider."""
    return left_enrich(
        claim, current_providers(history), "provider_id", "provider_id", TRACKED,
        "provider_missing",
    )


def feedback_enriched(entry: DataFrame, history: DataFrame, encounter: DataFrame) -> DataFrame:
    """Feedback with current provider attributes and two missing-reference flags."""
    with_provider = left_enrich(
        entry, current_providers(history), "provider_id", "provider_id", TRACKED,
        "provider_missing",
    )
    return left_enrich(
        with_provider, encounter, "visit_id", "encounter_id", (), "encounter_missing"
    )


def encounters_enriched(encounter: DataFrame, patient: DataFrame) -> DataFrame:
    """Encounters with patient demographics; ``encounter`` may be a stream."""
    return left_enrich(
        encounter, patient, "patient_id", "id", ("gender", "birth_year"), "patient_missing"
    )
