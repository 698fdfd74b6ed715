"""Upsert, history and change-capture queries."""

from pyspark.sql import functions as F

from medstrata.operators.changes import commit_history, diff_states
from medstrata.operators.upsert import insert_new, upsert_latest
from medstrata.plans import healthcare, stand_ins
from medstrata.plans.tables import Lake
from medstrata.registry.catalog import query


def _split(changes, last_version: int):
    """Change rows up to a commit, and the rows after it."""
    version = F.col("_commit_version")
    return changes.filter(version <= last_version), changes.filter(version > last_version)


def _two_loads(changes, cleaned, keys, last_version: int):
    """Clean the first load, then upsert the second into it."""
    first, second = _split(changes, last_version)
    return upsert_latest(cleaned(first), cleaned(second), keys)


# Incremental must equal full: the SQL takes the latest row over all commits.
@query(
    "scd1_upsert_claims",
    "SELECT * REPLACE (CAST(claim_date AS VARCHAR) AS claim_date) FROM claims",
)
def scd1_upsert_claims(lake: Lake):
    return _two_loads(
        lake.bronze_claims, healthcare.claims, ["claim_id"], stand_ins.CLAIM_CUT
    )


@query("scd1_upsert_patients", """
SELECT * REPLACE (CAST(birth_year AS VARCHAR) AS birth_year), CAST(NULL AS VARCHAR) AS ssn
FROM patients""")
def scd1_upsert_patients(lake: Lake):
    merged = _two_loads(lake.bronze_patients, healthcare.patients, ["id"], 1)
    return merged.select("id", "birth_year", "marital", "race", "ethnicity", "gender", "ssn")


@query(
    "scd1_upsert_encounters",
    "SELECT * REPLACE (CAST(start_ts AS VARCHAR) AS start_ts) FROM encounters",
)
def scd1_upsert_encounters(lake: Lake):
    merged = _two_loads(lake.bronze_encounters, healthcare.encounters, ["encounter_id"], 1)
    return merged.drop("_source_file", "_batch_id")


@query(
    "insert_only_feedback",
    f"""
SELECT feedback_id, provider_id, CAST(utc AS VARCHAR) AS "timestamp", timestamp_source, visit_id,
  CAST(satisfaction_score AS VARCHAR) AS satisfaction_score, source, tags, k
FROM (SELECT *, ts >= TIMESTAMP '{stand_ins.FEEDBACK_CUT}' AS later FROM feedback_rows)
QUALIFY ROW_NUMBER() OVER (PARTITION BY feedback_id
  ORDER BY later, utc DESC NULLS LAST, ts DESC, provider_id DESC, visit_id DESC) = 1""",
)
def insert_only_feedback(lake: Lake):
    """A key of the first load keeps its first-load row, whatever arrives later."""
    loaded_first = F.col("_ingest_ts") < F.lit(stand_ins.FEEDBACK_CUT).cast("timestamp")
    target = healthcare.feedback(lake.bronze_feedback.filter(loaded_first))
    merged = insert_new(target, lake.silver_feedback, ["feedback_id"])
    return merged.withColumn("k", F.col("metadata")["k"]).drop(
        "metadata", "_ingest_ts", "_source_file", "_batch_id"
    )


@query("scd2_providers", "SELECT * FROM providers")
def scd2_providers(lake: Lake):
    return lake.silver_providers.drop("_ingest_ts", "_source_file", "_batch_id")


@query(
    "diff_snapshots",
    """
SELECT o_orderkey, o_custkey, 'F' AS code, 'delete' AS _change_type
FROM orders WHERE o_orderstatus = 'F'
UNION ALL
SELECT o_orderkey, o_custkey, 'P', 'insert' FROM orders WHERE o_orderstatus = 'P'
UNION ALL
SELECT o_orderkey, o_custkey, k.code, k.kind
FROM orders, (VALUES ('O', 'update_preimage'), ('X', 'update_postimage')) k(code, kind)
WHERE o_orderstatus = 'O' AND o_totalprice >= 250000""",
)
def diff_snapshots(lake: Lake):
    """Yesterday: finished and open orders; today: open (some revised) and pending ones."""
    orders = lake.t.read("orders")
    status = F.col("o_orderstatus")
    old = orders.filter(status.isin("F", "O")).select(
        "o_orderkey", "o_custkey", status.alias("code")
    )
    revised = (status == "O") & (F.col("o_totalprice") >= 250000)
    new = orders.filter(status.isin("O", "P")).select(
        "o_orderkey", "o_custkey", F.when(revised, "X").otherwise(status).alias("code")
    )
    return diff_states(old, new, ["o_orderkey"])


@query(
    "commit_history",
    """
SELECT _commit_version, CAST(MAX(_commit_timestamp) AS VARCHAR) AS commit_ts,
  COUNT(*) FILTER (WHERE _change_type = 'insert') AS insert_rows,
  COUNT(*) FILTER (WHERE _change_type = 'update_preimage') AS update_preimage_rows,
  COUNT(*) FILTER (WHERE _change_type = 'update_postimage') AS update_postimage_rows,
  COUNT(*) FILTER (WHERE _change_type = 'delete') AS delete_rows
FROM claim_feed GROUP BY 1 ORDER BY _commit_version DESC LIMIT 5""",
)
def history(lake: Lake):
    return commit_history(lake.bronze_claims, newest=5)
