"""Enrichment, orphan and preview queries."""

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from medstrata.operators.aggregates import top_rows
from medstrata.operators.enrich import count_missing, count_orphans, join_coverage
from medstrata.operators.history import attributes_as_of
from medstrata.plans import healthcare
from medstrata.plans.tables import Lake
from medstrata.registry.catalog import query


@query(
    "claims_enriched",
    "SELECT * REPLACE (CAST(claim_date AS VARCHAR) AS claim_date) FROM claims_enriched",
)
def claims_enriched(lake: Lake):
    return lake.silver_claims_enriched


@query(
    "feedback_enriched",
    """
SELECT * EXCLUDE (ts) REPLACE (CAST(satisfaction_score AS VARCHAR) AS satisfaction_score)
FROM feedback_enriched""",
)
def feedback_enriched(lake: Lake):
    rows = lake.silver_feedback_enriched
    return rows.withColumn("k", F.col("metadata")["k"]).drop(
        "metadata", "_ingest_ts", "_source_file", "_batch_id"
    )


@query(
    "encounters_enriched",
    """
SELECT * REPLACE (CAST(start_ts AS VARCHAR) AS start_ts, CAST(birth_year AS VARCHAR) AS birth_year)
FROM encounters_enriched""",
)
def encounters_enriched(lake: Lake):
    return lake.silver_encounters_enriched.drop("_source_file", "_batch_id")


@query(
    "orphan_claims_patient",
    """
SELECT COUNT(*) AS missing_patient_dim FROM claims c
WHERE NOT EXISTS (SELECT 1 FROM patients p WHERE p.id = c.patient_id)""",
)
def orphan_claims_patient(lake: Lake):
    return count_orphans(
        lake.silver_claims, lake.silver_patients, "patient_id", "id", "missing_patient_dim"
    )


@query(
    "orphan_claims_provider",
    """
SELECT COUNT(*) AS missing_provider_dim FROM claims c
WHERE NOT EXISTS (SELECT 1 FROM providers p WHERE p.is_current AND p.provider_id = c.provider_id)""",
)
def orphan_claims_provider(lake: Lake):
    current = healthcare.current_providers(lake.silver_providers)
    return count_orphans(
        lake.silver_claims, current, "provider_id", "provider_id", "missing_provider_dim"
    )


@query(
    "orphan_feedback",
    """
SELECT
  COUNT(*) FILTER (WHERE visit_id NOT IN (SELECT encounter_id FROM encounters)) AS missing_encounter,
  COUNT(*) FILTER (WHERE provider_id NOT IN (SELECT provider_id FROM providers)) AS missing_provider
FROM feedback""",
)
def orphan_feedback(lake: Lake):
    return count_missing(
        lake.silver_feedback,
        {
            "missing_encounter": ("visit_id", lake.silver_encounters, "encounter_id"),
            "missing_provider": ("provider_id", lake.silver_providers, "provider_id"),
        },
    )


@query(
    "raw_joins",
    """
SELECT 'claims_patients' AS relation, COUNT(*) AS joined_rows, COUNT(p.id) AS matched_rows
FROM claim_feed c LEFT JOIN patient_feed p ON c.patient_id = p.id
UNION ALL
SELECT 'claims_providers', COUNT(*), COUNT(p.provider_id)
FROM claim_feed c LEFT JOIN provider_rows p ON c.provider_id = p.provider_id
UNION ALL
SELECT 'encounters_patients', COUNT(*), COUNT(p.id)
FROM encounter_feed e LEFT JOIN patient_feed p ON e.patient_id = p.id""",
)
def raw_joins(lake: Lake):
    """The documented raw-layer joins; raw dimensions may hold several rows per key."""
    relations = {
        "claims_patients": (lake.bronze_claims, lake.bronze_patients, "PatientID", "ID"),
        "claims_providers": (lake.bronze_claims, lake.bronze_providers, "ProviderID", "ProviderID"),
        "encounters_patients": (lake.bronze_encounters, lake.bronze_patients, "PATIENT", "ID"),
    }
    sizes = [
        join_coverage(*relation).select(F.lit(name).alias("relation"), "*")
        for name, relation in relations.items()
    ]
    return reduce(DataFrame.unionByName, sizes)


@query(
    "preview_latest",
    """
SELECT claim_id, CAST(claim_date AS VARCHAR) AS claim_date, claim_amount, provider_missing
FROM claims_enriched ORDER BY claims_enriched.claim_date DESC, claim_id LIMIT 5""",
)
def preview_latest(lake: Lake):
    rows = lake.silver_claims_enriched.select(
        "claim_id", "claim_date", "claim_amount", "provider_missing"
    )
    return top_rows(rows, [F.col("claim_date").desc_nulls_last(), "claim_id"], 5)


@query(
    "scd2_asof",
    """
SELECT f.feedback_id, f.provider_id, CAST(f.due AS VARCHAR) AS due, p.provider_specialty,
  p.provider_location, p.provider_id IS NULL AS provider_missing
FROM (SELECT *, utc + INTERVAL 20 DAYS AS due FROM (SELECT * FROM feedback_rows
        QUALIFY ROW_NUMBER() OVER (PARTITION BY feedback_id
          ORDER BY utc DESC NULLS LAST, ts DESC, provider_id DESC, visit_id DESC) = 1)) f
LEFT JOIN providers p ON p.provider_id = f.provider_id AND f.due >= CAST(p.eff_start_ts AS TIMESTAMP)
  AND (p.eff_end_ts IS NULL OR f.due < CAST(p.eff_end_ts AS TIMESTAMP))""",
)
def scd2_asof(lake: Lake):
    """Feedback with the provider attributes that hold 20 days later, when its answer is due."""
    due = F.col("timestamp") + F.expr("INTERVAL 20 DAYS")
    asked = lake.silver_feedback.select("feedback_id", "provider_id", due.alias("due"))
    return attributes_as_of(
        asked, lake.silver_providers, "provider_id", "due", healthcare.TRACKED, missing_flag="provider_missing"
    )


@query(
    "asof_visit_at_claim",
    """
SELECT c.claim_id, c.patient_id, CAST(c.claim_date AS VARCHAR) AS claim_date, v.encounter_id AS encounter_id,
  v.encounter_id IS NULL AS visit_missing
FROM claims c ASOF LEFT JOIN (
  SELECT patient_id, start_ts, MAX(encounter_id) AS encounter_id FROM encounters
  WHERE start_ts IS NOT NULL GROUP BY 1, 2) v
ON c.patient_id = v.patient_id AND c.claim_date >= v.start_ts""",
)
def asof_visit_at_claim(lake: Lake):
    """Claims with their patient's last visit up to that day: long histories, sorted by month."""
    claims = lake.silver_claims.select("claim_id", "patient_id", "claim_date")
    return attributes_as_of(
        claims, lake.silver_encounters, "patient_id", "claim_date", ["encounter_id"], start="START_TS", end=None,
        missing_flag="visit_missing", per="month",
    )
