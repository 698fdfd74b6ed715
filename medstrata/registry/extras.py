"""Queries for the reports of ``plans.profiles``."""

from pyspark.sql import functions as F

from medstrata.operators.changes import diff_states
from medstrata.operators.constraints import VIOLATED, split_violations
from medstrata.plans import profiles
from medstrata.plans.tables import Lake
from medstrata.registry.catalog import query
from medstrata.registry.sql import mean, money_mean, money_sum, ratio, rounded
from medstrata.session import work_dir
from medstrata.sources import changelog
from medstrata.sources.tables import read_table
from medstrata.streaming.aggregates import keep_report, monthly_encounters

YEAR = 2001


# Stand-in claims are spread thinly over patients and days, hence the low threshold.
@query(
    "rapid_fire_claims",
    """
SELECT patient_id, CAST(claim_date AS VARCHAR) AS claim_date, COUNT(*) AS claim_count
FROM claims GROUP BY patient_id, claims.claim_date HAVING COUNT(*) > 1""",
)
def rapid_fire_claims(lake: Lake):
    return profiles.rapid_fire_claims(lake.silver_claims, more_than=1)


@query(
    "age_band_utilization",
    f"""
SELECT CASE WHEN {YEAR} - birth_year >= 65 THEN '65+' WHEN {YEAR} - birth_year >= 50 THEN '50-64'
    WHEN {YEAR} - birth_year >= 35 THEN '35-49' WHEN {YEAR} - birth_year >= 18 THEN '18-34'
    WHEN {YEAR} - birth_year >= 0 THEN '0-17' ELSE 'Unknown' END AS age_band,
  COUNT(*) AS encounter_count, COUNT(DISTINCT patient_id) AS patient_count
FROM encounters_enriched GROUP BY 1""",
)
def age_band_utilization(lake: Lake):
    return profiles.age_band_utilization(lake.silver_encounters, lake.silver_patients, YEAR)


@query(
    "feedback_variability",
    f"""
SELECT COALESCE(p.provider_specialty, 'Unknown') AS provider_specialty,
  COALESCE(f.source, 'Unknown') AS source, COUNT(*) AS feedback_count,
  {rounded('STDDEV_SAMP(satisfaction_score)', 4)} AS score_stddev,
  MIN(satisfaction_score) AS min_score, MAX(satisfaction_score) AS max_score,
  COUNT(comments) AS comment_count, {mean('LENGTH(comments)')} AS avg_comment_length
FROM feedback_rows f LEFT JOIN (SELECT * FROM providers WHERE is_current) p
  ON f.provider_id = p.provider_id
GROUP BY 1, 2""",
)
def feedback_variability(lake: Lake):
    return profiles.feedback_variability(lake.bronze_feedback, lake.provider_attributes)


_BY_MONTH = """
SELECT CAST(CAST(date_trunc('month', start_ts) AS DATE) AS VARCHAR) AS month, gender,
  CAST(encounters_enriched.birth_year AS VARCHAR) AS birth_year,
  COUNT(*) AS encounter_count
FROM encounters_enriched
WHERE gender IS NOT NULL AND birth_year IS NOT NULL
  AND start_ts >= DATE '2001-09-30' - INTERVAL 2 YEARS
GROUP BY 1, 2, encounters_enriched.birth_year"""


@query("encounters_by_month", _BY_MONTH)
def encounters_by_month(lake: Lake):
    return profiles.encounters_by_month(lake.silver_encounters, lake.silver_patients, lake.as_of)


@query("stream_encounters_by_month", _BY_MONTH)
def stream_encounters_by_month(lake: Lake):
    """The same report kept by a stream: first all visits a day early, then each moved to its day."""
    spark = lake.t.spark
    log, target, checkpoint = (work_dir(spark, name) for name in ("visits", "by-month", "checkpoint"))
    visits = lake.silver_encounters.select("encounter_id", "patient_id", "START_TS")
    early = visits.withColumn("START_TS", F.col("START_TS") - F.expr("INTERVAL 1 DAY"))
    since = F.add_months(lake.as_of, -24)
    for version, changes in ((1, changelog.as_inserts(early)), (2, diff_states(early, visits, ["encounter_id"]))):
        changelog.write_commit(changes, log, version)
        report = monthly_encounters(changelog.stream_log(spark, log), lake.silver_patients, since)
        keep_report(report, "encounter_count", target, checkpoint)
    return read_table(spark, target)


@query(
    "unmatched_entities",
    """
SELECT 'encounter_without_patient' AS kind, encounter_id AS id FROM encounters_enriched
WHERE patient_missing
UNION ALL
SELECT 'patient_without_encounter', id FROM patients
WHERE id NOT IN (SELECT patient_id FROM encounters)""",
)
def unmatched_entities(lake: Lake):
    return profiles.unmatched_entities(lake.silver_encounters, lake.silver_patients)


@query(
    "hourly_claims",
    f"""
SELECT CAST(date_trunc('hour', CAST(_ingest_ts AS TIMESTAMP)) AS VARCHAR) AS hour,
  COUNT(*) AS claim_count, {money_sum('claim_amount')} AS total_amount,
  {money_mean('claim_amount')} AS avg_amount
FROM claims GROUP BY 1""",
)
def hourly_claims(lake: Lake):
    return profiles.hourly_claims(lake.silver_claims, "_ingest_ts")


@query(
    "provider_match_rate",
    f"""
SELECT COUNT(*) AS total_claims, COUNT(*) FILTER (WHERE provider_missing) AS unmatched_claims,
  {ratio('COUNT(*) FILTER (WHERE NOT provider_missing)', 'COUNT(*)', 4)} AS match_rate
FROM claims_enriched""",
)
def provider_match_rate(lake: Lake):
    return profiles.provider_match_rate(lake.silver_claims, lake.provider_attributes)


@query(
    "gender_breakdown",
    "SELECT gender, COUNT(*) AS patient_count FROM patients WHERE gender IN ('F', 'M') GROUP BY 1",
)
def gender_breakdown(lake: Lake):
    return profiles.gender_breakdown(lake.silver_patients, YEAR)


@query(
    "cleanse_demographics",
    f"""
SELECT id, CASE WHEN gender IN ('F', 'M') THEN gender END AS gender,
  CASE WHEN birth_year BETWEEN 1900 AND {YEAR} THEN CAST(birth_year AS VARCHAR) END AS birth_year
FROM patients""",
)
def cleanse_demographics(lake: Lake):
    return profiles.cleanse_demographics(lake.silver_patients, YEAR).select(
        "id", "gender", "birth_year"
    )


@query(
    "constraint_gate",
    f"""
SELECT id, array_to_string(list_filter([CASE WHEN NOT gender IN ('F', 'M') THEN 'valid_gender' END,
    CASE WHEN NOT birth_year BETWEEN 1900 AND {YEAR} THEN 'valid_birth_year' END], lambda x: x IS NOT NULL), ',') AS broken,
  CASE WHEN gender NOT IN ('F', 'M') OR birth_year NOT BETWEEN 1900 AND {YEAR} THEN 'rejected' ELSE 'table' END AS destination
FROM patients""",
)
def constraint_gate(lake: Lake):
    """Patients that meet the demographic constraints, and the others with what they break."""
    clean, broken = split_violations(
        lake.silver_patients.select("id", "gender", "birth_year"), profiles.demographic_constraints(YEAR)
    )
    return clean.select("id", F.lit("").alias("broken"), F.lit("table").alias("destination")).unionByName(
        broken.select("id", F.array_join(VIOLATED, ",").alias("broken"), F.lit("rejected").alias("destination"))
    )


@query(
    "ingest_row_log",
    """
SELECT _batch_id, _source_file, COUNT(*) AS row_count, MAX(_ingest_ts) AS last_ingest_ts
FROM claim_feed GROUP BY 1, 2
UNION ALL
SELECT 'manual', 'events', COUNT(*), strftime(MAX(ts), '%Y-%m-%d %H:%M:%S') FROM events""",
)
def ingest_row_log(lake: Lake):
    rows = lake.bronze_claims.select("_batch_id", "_source_file", "_ingest_ts").unionByName(
        lake.bronze_feedback.select("_batch_id", "_source_file", "_ingest_ts")
    )
    log = profiles.load_log(rows)
    return log.withColumn("last_ingest_ts", F.date_trunc("second", "last_ingest_ts"))
