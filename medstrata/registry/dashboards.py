"""Dashboard queries."""

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from medstrata.functions.measures import rounded as decimal_round
from medstrata.plans import dashboards, stand_ins
from medstrata.plans.tables import Lake
from medstrata.registry.catalog import query
from medstrata.registry.sql import mean, money_sum, rounded

_DENIAL = f"""
SELECT provider_specialty AS specialty,
  {rounded('100.0 * (1.0 - CAST(approved_count AS DOUBLE) / NULLIF(total_claims, 0))', 2)}
    AS denial_rate_pct, total_claims
FROM approval ORDER BY denial_rate_pct DESC, total_claims DESC, specialty LIMIT 7"""

_RESPONSE = f"""
SELECT e.n AS total_encounters, f.n AS feedback_submissions_with_visit,
  {rounded('100.0 * f.n / CAST(e.n AS DOUBLE)', 2)} AS feedback_response_rate_percent
FROM (SELECT COUNT(DISTINCT encounter_id) AS n FROM encounters_enriched) e,
     (SELECT COUNT(*) AS n FROM feedback_enriched WHERE visit_id IS NOT NULL) f"""

_SATISFACTION = f"""
SELECT COALESCE(provider_specialty, 'Unknown') AS specialty,
  {mean('satisfaction_score')} AS avg_satisfaction_score, COUNT(*) AS feedback_count
FROM feedback_enriched WHERE satisfaction_score IS NOT NULL
GROUP BY 1 HAVING COUNT(*) >= 5"""

_FAILURES = """
SELECT status AS metric, COUNT(*) AS failure_count FROM check_results
WHERE run_ts = (SELECT MAX(run_ts) FROM check_results) AND status <> 'PASS' GROUP BY 1"""

_SPEND = f"""
SELECT CAST(spend_date AS VARCHAR) AS date, {money_sum('rolling_7d_spend')} AS total_rolling_7d_spend
FROM rolling_spend WHERE spend_date >= DATE '2001-09-30' - 60 GROUP BY 1"""


@query(
    "dash_patient_summary",
    """
SELECT COUNT(DISTINCT patient_id) AS patients,
  COUNT(*) FILTER (WHERE classification = 'new') AS new_pts,
  COUNT(*) FILTER (WHERE classification = 'returning') AS returning_pts
FROM lifecycle""",
)
def patient_summary(lake: Lake):
    return dashboards.patient_summary(lake.gold_patient_lifecycle)


@query("dash_rolling_spend", _SPEND)
def rolling_spend(lake: Lake):
    return dashboards.rolling_spend(lake.gold_provider_7d_spend, lake.as_of)


@query(
    "dash_rolling_spend_by_day",
    f"SELECT date AS day, {money_sum('total_rolling_7d_spend')} AS total FROM ({_SPEND}) GROUP BY 1",
)
def rolling_spend_by_day(lake: Lake):
    return dashboards.rolling_spend_by_day(rolling_spend(lake))


@query("dash_denial_rate", _DENIAL)
def denial_rate(lake: Lake):
    return dashboards.denial_rate(lake.gold_claim_approval_by_specialty)


@query("dash_feedback_rate", _RESPONSE)
def feedback_rate(lake: Lake):
    return dashboards.feedback_rate(lake.silver_feedback, lake.silver_encounters)


@query(
    "dash_tag_summary",
    f"""
SELECT tag, COUNT(*) AS feedback_count, {mean('satisfaction_score')} AS avg_score
FROM (SELECT satisfaction_score, unnest(string_split(tags, ',')) AS tag
      FROM feedback WHERE tags <> '')
GROUP BY tag ORDER BY feedback_count DESC, tag LIMIT 10""",
)
def tag_summary(lake: Lake):
    return dashboards.tag_summary(lake.gold_feedback_tag_analysis)


@query("dash_satisfaction_specialty", _SATISFACTION)
def satisfaction_specialty(lake: Lake):
    return dashboards.satisfaction_by_specialty(lake.silver_feedback, lake.provider_attributes)


@query(
    "dash_satisfaction_location",
    f"""
SELECT provider_location, COUNT(*) AS feedback_count, {mean('satisfaction_score')} AS avg_score
FROM feedback_enriched
WHERE TRIM(provider_location) <> '' AND satisfaction_score IS NOT NULL
GROUP BY 1 HAVING COUNT(*) >= 5""",
)
def satisfaction_location(lake: Lake):
    return dashboards.satisfaction_by_location(lake.silver_feedback, lake.provider_attributes)


@query(
    "dash_top_providers",
    f"""
SELECT provider_id, COALESCE(provider_specialty, 'Unknown') AS provider_specialty,
  {money_sum("CASE WHEN claim_status = 'Approved' THEN claim_amount ELSE 0 END")} AS total_paid_usd
FROM claims_enriched GROUP BY 1, 2
ORDER BY total_paid_usd DESC, provider_id, provider_specialty LIMIT 10""",
)
def top_providers(lake: Lake):
    return dashboards.top_providers(lake.silver_claims, lake.provider_attributes)


@query(
    "dash_qa_status",
    """
SELECT layer, COUNT(*) FILTER (WHERE status = 'PASS') AS pass_count,
  COUNT(*) FILTER (WHERE status = 'FAIL') AS fail_count,
  COUNT(*) FILTER (WHERE status = 'ERROR') AS error_count,
  CASE WHEN COUNT(*) FILTER (WHERE status <> 'PASS') = 0 THEN 'PASS' ELSE 'ISSUES DETECTED' END
    AS qa_status
FROM check_results WHERE run_ts = (SELECT MAX(run_ts) FROM check_results) GROUP BY layer""",
)
def qa_status(lake: Lake):
    return dashboards.qa_status(stand_ins.check_results(lake.t))


@query("dash_failures", _FAILURES)
def failures(lake: Lake):
    return dashboards.failures(stand_ins.check_results(lake.t))


@query(
    "dash_qa_volume",
    """
SELECT layer, COUNT(*) AS row_count,
  COUNT(*) FILTER (WHERE status IN ('FAIL', 'ERROR')) AS fail_count
FROM check_results WHERE run_ts = (SELECT MAX(run_ts) FROM check_results) GROUP BY layer""",
)
def qa_volume(lake: Lake):
    return dashboards.qa_volume(stand_ins.check_results(lake.t))


@query(
    "dash_headline_figures",
    f"""
SELECT 'avg_denial_rate' AS tile, {rounded('AVG(denial_rate_pct)', 4)} AS value FROM ({_DENIAL})
UNION ALL SELECT 'avg_satisfaction', {rounded('AVG(avg_satisfaction_score)', 4)}
FROM ({_SATISFACTION})
UNION ALL SELECT 'avg_response_rate', {rounded('AVG(feedback_response_rate_percent)', 4)}
FROM ({_RESPONSE})
UNION ALL SELECT 'failures', CAST(SUM(failure_count) AS DOUBLE) FROM ({_FAILURES})""",
)
def headline_figures(lake: Lake):
    tiles = dashboards.headline_figures(
        denial_rate(lake), satisfaction_specialty(lake), feedback_rate(lake), failures(lake)
    )
    rows = [
        tile.select(
            F.lit(name).alias("tile"), decimal_round(F.col("value").cast("double"), 4).alias("value")
        )
        for name, tile in tiles.items()
    ]
    return reduce(DataFrame.unionByName, rows)
