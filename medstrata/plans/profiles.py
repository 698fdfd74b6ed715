"""Reports that the documentation of the domain describes beside the main tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from medstrata.functions.measures import mean, money, money_mean, ratio, rounded
from medstrata.functions.predicates import or_unknown
from medstrata.operators.enrich import measure_by_key

# Lower ages of the bands; a band ends where the next begins.
AGE_BANDS = {0: "0-17", 18: "18-34", 35: "35-49", 50: "50-64", 65: "65+"}

VALID_GENDERS = ("F", "M")
EARLIEST_BIRTH_YEAR = 1900


def rapid_fire_claims(claims: DataFrame, more_than: int = 5) -> DataFrame:
    """Patients with more than ``more_than`` claims on one day."""
    per_day = claims.groupBy("patient_id", "claim_date").agg(F.count(F.lit(1)).alias("claim_count"))
    return per_day.filter(F.col("claim_count") > more_than)


def age_band(birth_year: Column, year: int) -> Column:
    age = F.lit(year) - birth_year
    band = F.lit(None).cast("string")
    for least, label in AGE_BANDS.items():
        band = F.when(age >= least, label).otherwise(band)
    return or_unknown(band)


def _per_patient(
    encounters: DataFrame, patients: DataFrame, *keys: Column
) -> DataFrame:
    return measure_by_key(
        encounters, ["patient_id", *keys], {"_encounters": F.count(F.lit(1))},
        patients, "patient_id", "id", ["gender", "birth_year"],
    )


def age_band_utilization(encounters: DataFrame, patients: DataFrame, year: int) -> DataFrame:
    """Encounters and patients per age band at the end of ``year``."""
    return (
        _per_patient(encounters, patients)
        .groupBy(age_band(F.col("birth_year"), year).alias("age_band"))
        .agg(
            F.sum("_encounters").alias("encounter_count"),
            F.count("patient_id").alias("patient_count"),
        )
    )


def feedback_variability(raw_feedback: DataFrame, providers: DataFrame) -> DataFrame:
    """Spread of the scores and length of the comments per specialty and source.

    Comments are measured in the raw layer; their text does not leave it.  The
    spread comes from exact sums of the integer scores, which can be added up.
    """
    score, length = F.col("satisfaction_score"), F.length("comments")
    per_provider = measure_by_key(
        raw_feedback, ["provider_id", "source"],
        {
            "_rows": F.count(F.lit(1)),
            "_n": F.count(score),
            "_sum": F.sum(score),
            "_squares": F.sum(score * score),
            "_min": F.min(score),
            "_max": F.max(score),
            "_comments": F.count("comments"),
            "_length": F.sum(length),
        },
        providers, "provider_id", "provider_id", ["provider_specialty"],
    )
    n, total, squares = F.sum("_n"), F.sum("_sum"), F.sum("_squares")
    variance = ratio(n * squares - total * total, n * (n - 1))
    return per_provider.groupBy(
        or_unknown("provider_specialty").alias("provider_specialty"),
        or_unknown("source").alias("source"),
    ).agg(
        F.sum("_rows").alias("feedback_count"),
        rounded(F.sqrt(variance), 4).alias("score_stddev"),
        F.min("_min").alias("min_score"),
        F.max("_max").alias("max_score"),
        F.sum("_comments").alias("comment_count"),
        mean(F.sum("_length"), F.sum("_comments"), 2).alias("avg_comment_length"),
    )


def encounters_by_month(
    encounters: DataFrame, patients: DataFrame, as_of: Column, years: int = 2
) -> DataFrame:
    """Encounters per month, gender and birth year over the last ``years`` years.

    Encounters whose patient has no gender or birth year are left to the
    unmatched report.
    """
    recent = encounters.filter(F.col("START_TS") >= F.add_months(as_of, -12 * years))
    month = F.date_trunc("month", "START_TS").cast("date").alias("month")
    known = F.col("gender").isNotNull() & F.col("birth_year").isNotNull()
    return (
        _per_patient(recent, patients, month)
        .filter(known)
        .groupBy("month", "gender", "birth_year")
        .agg(F.sum("_encounters").alias("encounter_count"))
    )


def unmatched_entities(encounters: DataFrame, patients: DataFrame) -> DataFrame:
    """Encounters without a patient row, and patients without an encounter."""
    patient_ids = patients.select(F.col("id").alias("patient_id"))
    lonely = encounters.join(patient_ids, "patient_id", "left_anti").select(
        F.lit("encounter_without_patient").alias("kind"), F.col("encounter_id").alias("id")
    )
    seen = encounters.select("patient_id").distinct()
    idle = patient_ids.join(seen, "patient_id", "left_anti").select(
        F.lit("patient_without_encounter").alias("kind"), F.col("patient_id").alias("id")
    )
    return lonely.unionByName(idle)


def hourly_claims(claims: DataFrame, instant: str) -> DataFrame:
    """Claims, total and mean amount per hour."""
    total = F.sum(money("claim_amount"))
    return claims.groupBy(F.date_trunc("hour", instant).alias("hour")).agg(
        F.count(F.lit(1)).alias("claim_count"),
        total.cast("double").alias("total_amount"),
        money_mean(total, F.count("claim_amount")).alias("avg_amount"),
    )


def provider_match_rate(claims: DataFrame, providers: DataFrame) -> DataFrame:
    """Claims whose provider is unknown, and the rate of those that match."""
    per_provider = measure_by_key(
        claims, ["provider_id"], {"_claims": F.count(F.lit(1))},
        providers, "provider_id", "provider_id", (), "_missing",
    )
    unmatched = F.when(F.col("_missing"), F.col("_claims")).otherwise(F.lit(0))
    counts = per_provider.agg(
        F.coalesce(F.sum("_claims"), F.lit(0)).alias("total_claims"),
        F.coalesce(F.sum(unmatched), F.lit(0)).alias("unmatched_claims"),
    )
    matched = F.col("total_claims") - F.col("unmatched_claims")
    return counts.withColumn("match_rate", F.round(ratio(matched, F.col("total_claims")), 4))


def cleanse_demographics(patients: DataFrame, year: int) -> DataFrame:
    """Genders and birth years outside the valid values become NULL; rows stay."""
    gender = F.upper(F.trim("gender"))
    born = F.col("birth_year")
    return patients.withColumns(
        {
            "gender": F.when(gender.isin(*VALID_GENDERS), gender),
            "birth_year": F.when(born.between(EARLIEST_BIRTH_YEAR, year), born),
        }
    )


def demographic_constraints(year: int) -> dict[str, Column]:
    """What :func:`cleanse_demographics` mends, as constraints of a table."""
    return {
        "valid_gender": F.col("gender").isin(*VALID_GENDERS),
        "valid_birth_year": F.col("birth_year").between(EARLIEST_BIRTH_YEAR, year),
    }


def gender_breakdown(patients: DataFrame, year: int) -> DataFrame:
    """Patients per valid gender."""
    cleansed = cleanse_demographics(patients, year)
    return (
        cleansed.filter(F.col("gender").isNotNull())
        .groupBy("gender")
        .agg(F.count(F.lit(1)).alias("patient_count"))
    )


def load_log(raw: DataFrame) -> DataFrame:
    """Rows and newest load time per run and source file."""
    return raw.groupBy("_batch_id", "_source_file").agg(
        F.count(F.lit(1)).alias("row_count"), F.max("_ingest_ts").alias("last_ingest_ts")
    )
