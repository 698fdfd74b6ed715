"""Dashboard datasets over report tables, enriched tables and check results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from medstrata.functions.measures import count_where, exact_sum, mean, ratio, rounded
from medstrata.functions.predicates import not_blank, or_unknown
from medstrata.operators import aggregates as agg
from medstrata.operators.enrich import measure_by_key
from medstrata.plans.kpis import APPROVED

LAYER_ORDER = ("BRONZE", "SILVER", "GOLD")
FAILED = ("FAIL", "ERROR")


def patient_summary(lifecycle: DataFrame) -> DataFrame:
    return lifecycle.agg(
        F.countDistinct("patient_id").alias("patients"),
        count_where(F.col("classification") == "new").alias("new_pts"),
        count_where(F.col("classification") == "returning").alias("returning_pts"),
    )


def rolling_spend(rolling: DataFrame, as_of: Column | None = None, days: int = 60) -> DataFrame:
    """Rolling spend of all providers per day over the last ``days`` days."""
    today = as_of if as_of is not None else F.current_date()
    return (
        rolling.filter(F.col("spend_date") >= F.date_sub(today, days))
        .groupBy(F.col("spend_date").alias("date"))
        .agg(exact_sum("rolling_7d_spend").alias("total_rolling_7d_spend"))
        .orderBy("date")
    )


def rolling_spend_by_day(spend: DataFrame) -> DataFrame:
    """The chart behind :func:`rolling_spend`: totals per calendar day."""
    return spend.groupBy(F.date_trunc("day", "date").cast("date").alias("day")).agg(
        exact_sum("total_rolling_7d_spend").alias("total")
    )


def denial_rate(approval: DataFrame, k: int = 7) -> DataFrame:
    """Specialties by share of claims that are not approved (pending ones count)."""
    approved = ratio(F.col("approved_count"), F.col("total_claims"))
    rates = approval.filter(F.col("total_claims") > 0).select(
        or_unknown("provider_specialty").alias("specialty"),
        rounded(F.lit(100.0) * (F.lit(1.0) - approved), 2).alias("denial_rate_pct"),
        "total_claims",
    )
    return agg.top_rows(
        rates, [F.col("denial_rate_pct").desc(), F.col("total_claims").desc(), "specialty"], k
    )


def feedback_rate(feedback: DataFrame, encounters: DataFrame) -> DataFrame:
    """Feedback entries with a visit id per hundred encounters."""
    counts = agg.side_by_side(
        total_encounters=encounters.agg(F.countDistinct("encounter_id")),
        feedback_submissions_with_visit=feedback.agg(F.count("visit_id")),
    )
    return counts.withColumn(
        "feedback_response_rate_percent",
        agg.percent(F.col("feedback_submissions_with_visit"), F.col("total_encounters")),
    )


def tag_summary(tags: DataFrame, k: int = 10) -> DataFrame:
    return agg.top_rows(tags, [F.col("feedback_count").desc(), "tag"], k)


def _scores(feedback: DataFrame, providers: DataFrame) -> DataFrame:
    """Number and sum of the scores per provider, with the provider attributes."""
    scored = feedback.filter(F.col("satisfaction_score").isNotNull())
    return measure_by_key(
        scored, ["provider_id"],
        {"_scores": F.count(F.lit(1)), "_sum": F.sum("satisfaction_score")},
        providers, "provider_id", "provider_id", ["provider_specialty", "provider_location"],
    )


def _mean_score(scores: DataFrame, group: Column, average: str, least: int) -> DataFrame:
    return (
        scores.groupBy(group)
        .agg(
            mean(F.sum("_sum"), F.sum("_scores"), 2).alias(average),
            F.sum("_scores").alias("feedback_count"),
        )
        .filter(F.col("feedback_count") >= least)
    )


def satisfaction_by_specialty(
    feedback: DataFrame, providers: DataFrame, least: int = 5
) -> DataFrame:
    group = or_unknown("provider_specialty").alias("specialty")
    scores = _mean_score(_scores(feedback, providers), group, "avg_satisfaction_score", least)
    return scores.orderBy(F.col("avg_satisfaction_score").desc(), "specialty")


def satisfaction_by_location(
    feedback: DataFrame, providers: DataFrame, least: int = 5
) -> DataFrame:
    placed = _scores(feedback, providers).filter(not_blank("provider_location"))
    scores = _mean_score(placed, F.col("provider_location"), "avg_score", least)
    return scores.orderBy(F.col("feedback_count").desc(), "provider_location")


def top_providers(claims: DataFrame, providers: DataFrame, k: int = 10) -> DataFrame:
    """Providers by approved amount."""
    paid = F.when(F.col("claim_status") == APPROVED, F.col("claim_amount")).otherwise(F.lit(0.0))
    totals = measure_by_key(
        claims, ["provider_id"], {"total_paid_usd": exact_sum(paid)},
        providers, "provider_id", "provider_id", ["provider_specialty"],
    ).select(
        "provider_id", or_unknown("provider_specialty").alias("provider_specialty"), "total_paid_usd"
    )
    return agg.top_rows(totals, [F.col("total_paid_usd").desc(), "provider_id"], k)


# ---- check results ----------------------------------------------------------

def latest_run(results: DataFrame) -> DataFrame:
    """Results of the newest run; the newest time is a scalar subquery."""
    newest = results.agg(F.max("run_ts")).scalar()
    return results.filter(F.col("run_ts") == newest)


def qa_status(results: DataFrame) -> DataFrame:
    """Passed, failed and broken checks per layer in the newest run."""
    statuses = {"PASS": "pass_count", "FAIL": "fail_count", "ERROR": "error_count"}
    counts = latest_run(results).groupBy("layer").agg(
        *[count_where(F.col("status") == s).alias(name) for s, name in statuses.items()]
    )
    clean = F.col("fail_count") + F.col("error_count") == 0
    place = F.array_position(F.array(*map(F.lit, LAYER_ORDER)), F.col("layer"))
    return counts.withColumn(
        "qa_status", F.when(clean, "PASS").otherwise("ISSUES DETECTED")
    ).orderBy(F.when(place > 0, place).otherwise(len(LAYER_ORDER) + 1), "layer")


def failures(results: DataFrame) -> DataFrame:
    """Number of failed and of broken checks in the newest run."""
    return (
        latest_run(results)
        .filter(F.col("status").isin(*FAILED))
        .groupBy(F.col("status").alias("metric"))
        .agg(F.count(F.lit(1)).alias("failure_count"))
        .orderBy(F.col("failure_count").desc(), "metric")
    )


def qa_volume(results: DataFrame) -> DataFrame:
    """Checks and failures per layer in the newest run."""
    return latest_run(results).groupBy("layer").agg(
        F.count(F.lit(1)).alias("row_count"),
        count_where(F.col("status").isin(*FAILED)).alias("fail_count"),
    )


# ---- single figures shown on the dashboard ------------------------------------

def headline_figures(
    denial: DataFrame, satisfaction: DataFrame, feedback: DataFrame, failed: DataFrame
) -> dict[str, DataFrame]:
    """The one-number tiles, each a one-row result over its dataset."""
    return {
        "avg_denial_rate": denial.agg(F.avg("denial_rate_pct").alias("value")),
        "avg_satisfaction": satisfaction.agg(F.avg("avg_satisfaction_score").alias("value")),
        "avg_response_rate": feedback.agg(F.avg("feedback_response_rate_percent").alias("value")),
        "failures": failed.agg(F.sum("failure_count").alias("value")),
    }
