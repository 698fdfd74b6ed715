"""Shared common table expressions of the comparison SQL (DuckDB dialect).

They state the stand-in inputs and the cleaned tables a second time, in SQL, from
the driver's tables alone.
"""

from __future__ import annotations

import re

MONEY = "DECIMAL(28,8)"


def rounded(expression: str, digits: int) -> str:
    return f"CAST(ROUND(CAST({expression} AS DECIMAL(28,10)), {digits}) AS DOUBLE)"


def mean(column: str, digits: int = 2) -> str:
    return rounded(f"CAST(SUM({column}) AS DOUBLE) / NULLIF(COUNT({column}), 0)", digits)


def money_sum(column: str) -> str:
    return f"CAST(SUM(TRY_CAST({column} AS {MONEY})) AS DOUBLE)"


def money_mean(column: str) -> str:
    """Mean to the cent, half up (away from zero), in whole numbers of 1e-8."""
    units = f"CAST(SUM(TRY_CAST({column} AS {MONEY})) * 100000000 AS HUGEINT)"
    cents = f"(COUNT({column}) * CAST(1000000 AS HUGEINT))"
    return f"(SIGN({units}) * ((2 * ABS({units}) + {cents}) // (2 * {cents}))) / CAST(100 AS DOUBLE)"


def ratio(part: str, whole: str, digits: int) -> str:
    return rounded(f"({part}) / CAST(NULLIF({whole}, 0) AS DOUBLE)", digits)


_PROVIDER_ATTRIBUTES = """
  SELECT s_suppkey, s_acctbal, n_name, r_name
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
"""

_PATIENT_COLUMNS = """
  CASE WHEN c_acctbal >= 0 THEN CAST(c_custkey AS VARCHAR) END AS id,
  CASE WHEN c_nationkey = 0 THEN 'unknown'
       ELSE CAST(CAST(DATE '1940-01-01' + CAST((c_custkey * 20) % 25000 AS INTEGER) AS DATE) AS VARCHAR)
  END AS birthdate,
  c_custkey, c_name, c_nationkey,
  'race_' || c_nationkey AS race, c_mktsegment AS ethnicity,
  CASE WHEN c_mktsegment IN ('BUILDING', 'HOUSEHOLD') THEN 'F'
       WHEN c_mktsegment IN ('MACHINERY', 'AUTOMOBILE') THEN 'M'
       WHEN c_mktsegment = 'FURNITURE' THEN 'U' END AS gender,
  c_acctbal
"""

INPUTS = {
    "claim_feed": """
  SELECT l_orderkey || '-' || l_linenumber AS claim_id,
    CASE WHEN l_discount < 0.095 THEN CAST(l_partkey AS VARCHAR) END AS patient_id,
    CAST(l_suppkey AS VARCHAR) AS provider_id,
    l_extendedprice AS claim_amount,
    CAST(l_shipdate AS DATE) AS claim_date,
    CASE WHEN ROUND(l_discount * 100) > 0
         THEN 'dx' || CAST(ROUND(l_discount * 100) AS INTEGER) END AS diagnosis_code,
    'pr' || CAST(l_quantity AS INTEGER) AS procedure_code,
    CASE l_returnflag WHEN 'A' THEN 'Approved' WHEN 'R' THEN 'Denied' WHEN 'N' THEN 'Pending' END
      AS claim_status,
    CASE l_linestatus WHEN 'F' THEN 'Inpatient' WHEN 'O' THEN 'Outpatient' END AS claim_type,
    CASE WHEN l_linenumber <= 3 THEN 'Online' WHEN l_linenumber <= 5 THEN 'Paper' ELSE 'Phone' END
      AS claim_submission_method,
    CAST(l_shipdate AS VARCHAR) AS _ingest_ts, 'lineitem' AS _source_file, 'manual' AS _batch_id,
    CASE WHEN l_tax < 0.005 THEN 'delete' WHEN l_tax > 0.075 THEN 'update_preimage'
         WHEN l_tax < 0.035 THEN 'insert' ELSE 'update_postimage' END AS _change_type,
    date_diff('day', TIMESTAMP '1995-01-01', l_shipdate) AS _commit_version,
    l_shipdate AS _commit_timestamp
  FROM lineitem""",
    "claims": """
  SELECT * EXCLUDE (_change_type, _commit_version, _commit_timestamp)
  FROM claim_feed
  WHERE _change_type IN ('insert', 'update_postimage')
    AND claim_id IS NOT NULL AND patient_id IS NOT NULL AND provider_id IS NOT NULL
  QUALIFY ROW_NUMBER() OVER (PARTITION BY claim_id
    ORDER BY _commit_version DESC, _commit_timestamp DESC,
             claim_amount DESC, patient_id DESC, provider_id DESC) = 1""",
    "provider_attributes": _PROVIDER_ATTRIBUTES,
    "provider_rows": """
  SELECT CASE WHEN s_acctbal >= 1000 THEN CAST(s_suppkey AS VARCHAR) END AS provider_id,
    n_name AS provider_specialty, r_name AS provider_location,
    '2024-01-01 00:00:00' AS _ingest_ts
  FROM provider_attributes
  UNION ALL
  SELECT CASE WHEN s_acctbal >= 0 THEN CAST(s_suppkey AS VARCHAR) END,
    CASE WHEN s_acctbal >= 8000 THEN 'SENIOR ' || n_name WHEN s_acctbal >= 7000 THEN NULL ELSE n_name END,
    CASE WHEN s_acctbal >= 6000 AND s_acctbal < 6500 THEN 'REMOTE' ELSE r_name END,
    '2024-02-01 00:00:00'
  FROM provider_attributes""",
    # Derived from the balance bands directly, without replaying the two loads.
    "providers": """
  SELECT CAST(s_suppkey AS VARCHAR) AS provider_id, n_name AS provider_specialty,
    r_name AS provider_location, '2024-01-01 00:00:00' AS eff_start_ts,
    CASE WHEN s_acctbal >= 7000 OR (s_acctbal >= 6000 AND s_acctbal < 6500)
         THEN '2024-02-01 00:00:00' END AS eff_end_ts,
    NOT (s_acctbal >= 7000 OR (s_acctbal >= 6000 AND s_acctbal < 6500)) AS is_current
  FROM provider_attributes WHERE s_acctbal >= 1000
  UNION ALL
  SELECT CAST(s_suppkey AS VARCHAR),
    CASE WHEN s_acctbal >= 8000 THEN 'SENIOR ' || n_name WHEN s_acctbal >= 7000 THEN NULL ELSE n_name END,
    CASE WHEN s_acctbal >= 6000 AND s_acctbal < 6500 THEN 'REMOTE' ELSE r_name END,
    '2024-02-01 00:00:00', NULL, TRUE
  FROM provider_attributes
  WHERE (s_acctbal >= 0 AND s_acctbal < 1000) OR s_acctbal >= 7000
     OR (s_acctbal >= 6000 AND s_acctbal < 6500)""",
    "patient_columns": f"SELECT {_PATIENT_COLUMNS} FROM customer",
    "patient_feed": """
  SELECT *, CASE WHEN c_nationkey < 12 THEN 'M' ELSE 'S' END AS marital,
    'insert' AS _change_type, 1 AS _commit_version FROM patient_columns
  UNION ALL
  SELECT *, CASE WHEN c_nationkey < 12 THEN 'M' ELSE 'S' END, 'update_preimage', 2
  FROM patient_columns WHERE c_acctbal >= 5000
  UNION ALL
  SELECT *, 'W', 'update_postimage', 2 FROM patient_columns WHERE c_acctbal >= 5000
  UNION ALL
  SELECT *, 'W', 'delete', 3 FROM patient_columns WHERE c_acctbal >= 9500""",
    "patients": """
  SELECT id, CAST(YEAR(TRY_CAST(birthdate AS DATE)) AS INTEGER) AS birth_year,
    arg_max(marital, _commit_version) AS marital, race, ethnicity, gender
  FROM patient_feed
  WHERE id IS NOT NULL AND _change_type IN ('insert', 'update_postimage')
  GROUP BY id, birthdate, race, ethnicity, gender""",
    "encounter_feed": """
  SELECT CAST(o_orderkey AS VARCHAR) AS encounter_id,
    CASE WHEN o_totalprice >= 20000 THEN CAST(o_custkey AS VARCHAR) END AS patient_id,
    CASE WHEN NOT (o_orderstatus = 'P' AND o_orderpriority = '4-NOT SPECIFIED')
         THEN CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) END AS start_ts,
    CASE WHEN v.version = 2 THEN 'X' ELSE o_orderstatus END AS code,
    o_orderpriority AS description,
    CASE WHEN o_orderstatus = 'F' THEN '410429000' END AS reasoncode,
    CASE WHEN o_orderstatus = 'F' THEN 'Follow-up' END AS reasondescription,
    CAST(o_orderdate AS VARCHAR) AS _ingest_ts,
    CASE WHEN v.version = 2 THEN 'update_postimage' ELSE 'insert' END AS _change_type,
    v.version AS _commit_version
  FROM orders JOIN (VALUES (1), (2)) v(version) ON v.version = 1 OR o_totalprice >= 300000""",
    "encounters": """
  SELECT * EXCLUDE (_change_type, _commit_version) FROM encounter_feed
  WHERE encounter_id IS NOT NULL AND patient_id IS NOT NULL
  QUALIFY ROW_NUMBER() OVER (PARTITION BY encounter_id ORDER BY _commit_version DESC) = 1""",
    "feedback_rows": """
  SELECT CAST(event_id // 2 AS VARCHAR) AS feedback_id,
    CAST(user_id AS VARCHAR) AS provider_id,
    CASE event_type
      WHEN 'view' THEN date_trunc('second', ts)
      WHEN 'click' THEN date_trunc('second', ts) + INTERVAL 4 HOURS
      WHEN 'purchase' THEN date_trunc('second', ts) - INTERVAL 330 MINUTES
      WHEN 'signup' THEN date_trunc('second', ts) END AS utc,
    CASE WHEN event_type IN ('view', 'click', 'purchase') THEN 'offset' ELSE 'naive' END
      AS timestamp_source,
    CASE WHEN event_type = 'error' THEN ' ' ELSE CAST(event_id * 2 AS VARCHAR) END AS visit_id,
    CASE WHEN value >= 1 THEN CAST(FLOOR(value) AS BIGINT) % 5 + 1 END AS satisfaction_score,
    'comment on ' || event_type AS comments,
    CASE event_type WHEN 'view' THEN 'web_portal' WHEN 'click' THEN 'mobile_app'
      WHEN 'purchase' THEN 'in_clinic' WHEN 'signup' THEN 'in_clinic' END AS source,
    CASE event_type WHEN 'view' THEN 'staff' WHEN 'click' THEN 'parking,staff'
      WHEN 'signup' THEN 'wait_time,wait_time' WHEN 'purchase' THEN '' END AS tags,
    props, CAST(props->>'$.k' AS VARCHAR) AS k, ts, event_type
  FROM events""",
    "feedback": """
  SELECT feedback_id, provider_id, CAST(utc AS VARCHAR) AS "timestamp", timestamp_source,
    visit_id, satisfaction_score, source, tags, k, ts
  FROM feedback_rows
  QUALIFY ROW_NUMBER() OVER (PARTITION BY feedback_id
    ORDER BY utc DESC NULLS LAST, ts DESC, provider_id DESC, visit_id DESC) = 1""",
    "claims_enriched": """
  SELECT c.*, p.provider_specialty, p.provider_location, p.provider_id IS NULL AS provider_missing
  FROM claims c LEFT JOIN (SELECT * FROM providers WHERE is_current) p
    ON c.provider_id = p.provider_id""",
    "feedback_enriched": """
  SELECT f.*, p.provider_specialty, p.provider_location,
    p.provider_id IS NULL AS provider_missing, e.encounter_id IS NULL AS encounter_missing
  FROM feedback f LEFT JOIN (SELECT * FROM providers WHERE is_current) p
    ON f.provider_id = p.provider_id
  LEFT JOIN encounters e ON f.visit_id = e.encounter_id""",
    "encounters_enriched": """
  SELECT e.*, p.gender, p.birth_year, p.id IS NULL AS patient_missing
  FROM encounters e LEFT JOIN patients p ON e.patient_id = p.id""",
    "approval": f"""
  SELECT COALESCE(provider_specialty, 'Unknown') AS provider_specialty,
    COUNT(*) AS total_claims,
    COUNT(*) FILTER (WHERE claim_status = 'Approved') AS approved_count,
    {ratio("COUNT(*) FILTER (WHERE claim_status = 'Approved')", "COUNT(*)", 4)} AS approval_rate
  FROM claims_enriched GROUP BY 1""",
    "denial_counts": """
  SELECT COALESCE(provider_specialty, 'Unknown') AS provider_specialty,
    COALESCE(diagnosis_code, 'Unknown') AS diagnosis_code, COUNT(*) AS denial_count
  FROM claims_enriched WHERE claim_status = 'Denied' GROUP BY 1, 2""",
    "daily_spend": f"""
  SELECT provider_id, claim_date AS spend_date, {money_sum('claim_amount')} AS daily_spend
  FROM claims_enriched GROUP BY 1, 2""",
    # The rolling frame written as a join over the days of the frame.
    "rolling_spend": f"""
  SELECT d.provider_id, d.spend_date, d.daily_spend,
    {money_sum('w.daily_spend')} AS rolling_7d_spend,
    {money_mean('w.daily_spend')} AS rolling_7d_avg
  FROM daily_spend d JOIN daily_spend w ON w.provider_id = d.provider_id
    AND w.spend_date BETWEEN d.spend_date - 6 AND d.spend_date
  GROUP BY 1, 2, 3""",
    "lifecycle": f"""
  SELECT patient_id, CAST(MIN(start_ts) AS VARCHAR) AS first_visit_ts,
    CAST(MAX(start_ts) AS VARCHAR) AS last_visit_ts,
    date_diff('day', MIN(start_ts), MAX(start_ts)) AS lifetime_days,
    COUNT(*) AS visit_count,
    CASE WHEN COUNT(*) = 1 THEN 'new' ELSE 'returning' END AS classification,
    {ratio("date_diff('day', MIN(start_ts), MAX(start_ts))", "COUNT(*) - 1", 2)}
      AS avg_days_between_visits,
    date_diff('day', CAST(MAX(start_ts) AS DATE), DATE '2001-09-30') AS days_since_last_visit
  FROM encounters_enriched GROUP BY patient_id""",
    "check_results": """
  SELECT date_trunc('day', ts) AS run_ts,
    CASE WHEN event_type IN ('view', 'click') THEN 'BRONZE' WHEN event_type = 'purchase' THEN 'SILVER'
         WHEN event_type = 'signup' THEN 'GOLD' ELSE 'OTHER' END AS layer,
    CASE WHEN event_type = 'signup' OR value >= 5 THEN 'PASS'
         WHEN value >= 1 THEN 'FAIL' ELSE 'ERROR' END AS status
  FROM events""",
}


def _uses(sql: str) -> list[str]:
    return [name for name in INPUTS if re.search(rf"\b{name}\b", sql)]


def with_inputs(sql: str) -> str:
    """Put the expressions that ``sql`` refers to, directly or not, in front of it."""
    needed: set[str] = set()
    pending = _uses(sql)
    while pending:
        name = pending.pop()
        if name not in needed:
            needed.add(name)
            pending += _uses(INPUTS[name])
    if not needed:
        return sql.strip()
    expressions = ",\n".join(f"{n} AS ({INPUTS[n]})" for n in INPUTS if n in needed)
    return f"WITH {expressions}\n{sql.strip()}"
