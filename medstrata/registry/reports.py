"""Report-layer queries."""

from medstrata.plans import kpis
from medstrata.plans.tables import Lake
from medstrata.registry.catalog import query
from medstrata.registry.sql import mean, money_mean, ratio


@query("claim_approval_by_specialty", "SELECT * FROM approval")
def claim_approval_by_specialty(lake: Lake):
    return lake.gold_claim_approval_by_specialty


@query(
    "claim_denial_breakdown",
    f"""
SELECT d.*, {ratio('d.denial_count', 't.total', 4)} AS denial_pct
FROM denial_counts d JOIN (
  SELECT provider_specialty, SUM(denial_count) AS total FROM denial_counts GROUP BY 1) t
  USING (provider_specialty)""",
)
def claim_denial_breakdown(lake: Lake):
    return lake.gold_claim_denial_breakdown


@query(
    "denials_by_specialty",
    """
SELECT COALESCE(provider_specialty, 'Unknown') AS provider_specialty,
  COUNT(*) AS total_denial_count
FROM claims_enriched WHERE claim_status = 'Denied' GROUP BY 1
ORDER BY total_denial_count DESC, provider_specialty LIMIT 10""",
)
def denials_by_specialty(lake: Lake):
    return kpis.denials_by_specialty(lake.gold_claim_denial_breakdown)


@query(
    "high_cost_procedures",
    f"""
SELECT procedure_code, {money_mean('claim_amount')} AS avg_claim_amount,
  COUNT(*) AS procedure_count
FROM claims_enriched WHERE claim_status = 'Approved'
GROUP BY procedure_code HAVING COUNT(*) >= 3
ORDER BY avg_claim_amount DESC, procedure_code LIMIT 10""",
)
def high_cost_procedures(lake: Lake):
    return lake.gold_high_cost_procedures


@query(
    "provider_daily_spend",
    "SELECT * REPLACE (CAST(spend_date AS VARCHAR) AS spend_date) FROM daily_spend",
)
def provider_daily_spend(lake: Lake):
    return lake.gold_provider_daily_spend


@query(
    "provider_7d_spend",
    "SELECT * REPLACE (CAST(spend_date AS VARCHAR) AS spend_date) FROM rolling_spend",
)
def provider_7d_spend(lake: Lake):
    return lake.gold_provider_7d_spend


@query(
    "feedback_satisfaction",
    f"""
SELECT COALESCE(provider_specialty, 'Unknown') AS provider_specialty, provider_id,
  COALESCE(source, 'Unknown') AS source, COUNT(*) AS feedback_count,
  {mean('satisfaction_score')} AS avg_score
FROM feedback_enriched GROUP BY 1, 2, 3""",
)
def feedback_satisfaction(lake: Lake):
    return lake.gold_feedback_satisfaction


@query(
    "feedback_tag_analysis",
    f"""
SELECT tag, COUNT(*) AS feedback_count, {mean('satisfaction_score')} AS avg_score
FROM (SELECT satisfaction_score, unnest(string_split(tags, ',')) AS tag
      FROM feedback_enriched WHERE tags <> '')
GROUP BY tag""",
)
def feedback_tag_analysis(lake: Lake):
    return lake.gold_feedback_tag_analysis


@query(
    "feedback_encounter_match",
    f"""
SELECT COUNT(*) AS total_feedback_submissions,
  COUNT(*) FILTER (WHERE TRIM(visit_id) <> '') AS matched_to_encounter_count,
  {ratio("100 * COUNT(*) FILTER (WHERE TRIM(visit_id) <> '')", "COUNT(*)", 2)}
    AS match_rate_percent,
  COUNT(*) FILTER (WHERE NOT encounter_missing) AS verified_match_count
FROM feedback_enriched""",
)
def feedback_encounter_match(lake: Lake):
    return lake.gold_feedback_encounter_match


@query("patient_lifecycle", "SELECT * FROM lifecycle")
def patient_lifecycle(lake: Lake):
    return lake.gold_patient_lifecycle
