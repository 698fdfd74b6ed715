"""Report tables over the cleaned tables.

Facts are aggregated per foreign key before dimension columns are added, see
:func:`medstrata.operators.enrich.measure_by_key`; the rows are those of the same
report over the enriched table.  ``providers`` holds the current attributes, one
row per provider.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from medstrata.functions.measures import count_where, mean
from medstrata.functions.predicates import not_blank, or_unknown
from medstrata.operators import aggregates as agg
from medstrata.operators.enrich import measure_by_key

APPROVED, DENIED = "Approved", "Denied"


def _per_provider(
    fact: DataFrame, providers: DataFrame, measures: dict[str, Column], *keys: str
) -> DataFrame:
    return measure_by_key(
        fact, ["provider_id", *keys], measures, providers, "provider_id", "provider_id",
        ["provider_specialty", "provider_location"],
    )


def _by(*columns: str) -> list[Column]:
    """Grouping keys in which a missing value is the unknown bucket."""
    return [or_unknown(c).alias(c) for c in columns]


def approval_by_specialty(claims: DataFrame, providers: DataFrame) -> DataFrame:
    """Claims, approved claims and approval rate per specialty."""
    per_provider = _per_provider(
        claims, providers,
        {
            "_claims": F.count(F.lit(1)),
            "_approved": count_where(F.col("claim_status") == APPROVED),
        },
    )
    counted = per_provider.groupBy(*_by("provider_specialty")).agg(
        F.sum("_claims").alias("total_claims"), F.sum("_approved").alias("approved_count")
    )
    return agg.with_rate(counted, "approved_count", "total_claims", "approval_rate")


def denial_breakdown(claims: DataFrame, providers: DataFrame) -> DataFrame:
    """Denied claims per specialty and diagnosis, with the share of the specialty."""
    denied = claims.filter(F.col("claim_status") == DENIED)
    per_provider = _per_provider(
        denied, providers, {"_denied": F.count(F.lit(1))}, "diagnosis_code"
    )
    counted = per_provider.groupBy(*_by("provider_specialty", "diagnosis_code")).agg(
        F.sum("_denied").alias("denial_count")
    )
    return agg.with_share(counted, ["provider_specialty"], "denial_count", "denial_pct")


def denials_by_specialty(breakdown: DataFrame, k: int = 10) -> DataFrame:
    """Specialties with most denials."""
    total = breakdown.groupBy("provider_specialty").agg(
        F.sum("denial_count").alias("total_denial_count")
    )
    return agg.top_rows(total, [F.col("total_denial_count").desc(), "provider_specialty"], k)


def high_cost_procedures(claims: DataFrame, min_claims: int = 3, k: int = 10) -> DataFrame:
    """Procedures with the highest mean approved amount, seen often enough."""
    approved = claims.filter(F.col("claim_status") == APPROVED)
    stats = agg.money_mean_by(
        approved, {"procedure_code": F.col("procedure_code")}, "claim_amount",
        "procedure_count", "avg_claim_amount",
    ).filter(F.col("procedure_count") >= min_claims)
    return agg.top_rows(stats, [F.col("avg_claim_amount").desc(), "procedure_code"], k)


def provider_daily_spend(claims: DataFrame) -> DataFrame:
    return agg.daily_total(
        claims, "provider_id", "claim_date", "claim_amount", "spend_date", "daily_spend"
    )


def provider_7d_spend(daily: DataFrame) -> DataFrame:
    """Seven-day rolling total and mean over the days with spend."""
    return agg.rolling_total(
        daily, "provider_id", "spend_date", "daily_spend", "rolling_7d_spend", "rolling_7d_avg"
    )


def feedback_satisfaction(feedback: DataFrame, providers: DataFrame) -> DataFrame:
    """Feedback and mean score per specialty, provider and source.

    A missing source and one that says 'Unknown' are the same group.
    """
    per_provider = _per_provider(
        feedback, providers,
        {
            "_entries": F.count(F.lit(1)),
            "_score": F.sum("satisfaction_score"),
            "_scores": F.count("satisfaction_score"),
        },
        "source",
    )
    return per_provider.groupBy(*_by("provider_specialty", "provider_id", "source")).agg(
        F.sum("_entries").alias("feedback_count"),
        mean(F.sum("_score"), F.sum("_scores"), 2).alias("avg_score"),
    )


def feedback_tags(feedback: DataFrame) -> DataFrame:
    """Uses and mean score per tag, most used first; rows without tags do not take part.

    One row per tag, so the sort is small.
    """
    tagged = feedback.select("satisfaction_score", F.explode("tags").alias("tag"))
    return agg.mean_by(
        tagged, {"tag": F.col("tag")}, "satisfaction_score", "feedback_count", "avg_score"
    ).orderBy(F.desc("feedback_count"), "tag")


def feedback_encounter_match(feedback: DataFrame, encounters: DataFrame) -> DataFrame:
    """Share of feedback that names a visit, and how many of those visits exist."""
    per_visit = measure_by_key(
        feedback, ["visit_id"], {"_entries": F.count(F.lit(1))},
        encounters, "visit_id", "encounter_id", (), "_missing",
    )
    entries = F.col("_entries")

    def total(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, entries)), F.lit(0))

    counted = per_visit.agg(
        F.coalesce(F.sum(entries), F.lit(0)).alias("total_feedback_submissions"),
        total(not_blank("visit_id")).alias("matched_to_encounter_count"),
        total(~F.col("_missing")).alias("verified_match_count"),
    )
    return counted.select(
        "total_feedback_submissions",
        "matched_to_encounter_count",
        agg.percent(
            F.col("matched_to_encounter_count"), F.col("total_feedback_submissions")
        ).alias("match_rate_percent"),
        "verified_match_count",
    )


def patient_lifecycle(encounters: DataFrame, as_of: Column | None = None) -> DataFrame:
    return agg.activity_span(encounters, "patient_id", "START_TS", as_of)
