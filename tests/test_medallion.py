"""The whole pipeline on hand-written raw files, run twice."""

import datetime as dt
import json
import pathlib

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from medstrata.config import PipelineConfig
from medstrata.plans import dashboards
from medstrata.plans.ingest_specs import PATIENT_COLUMNS, specs
from medstrata.plans.medallion import Medallion
from tests.helpers import rows

CLAIM_COLUMNS = (
    "ClaimID", "PatientID", "ProviderID", "ClaimAmount", "ClaimDate", "DiagnosisCode",
    "ProcedureCode", "ClaimStatus", "ClaimType", "ClaimSubmissionMethod",
)


def claim(key, patient, provider, amount, day, status="Approved", code="c1", diagnosis="d1"):
    return (key, patient, provider, amount, day, diagnosis, code, status, "Routine", "Online")


def write_claims(folder, name, records):
    pathlib.Path(folder).mkdir(parents=True, exist_ok=True)
    columns = {c: [r[i] for r in records] for i, c in enumerate(CLAIM_COLUMNS)}
    table = pa.table({
        c: pa.array(v, pa.float64() if c == "ClaimAmount" else pa.string()) for c, v in columns.items()
    })
    pq.write_table(table, f"{folder}/{name}.parquet")


def write_encounters(folder, name, records):
    pathlib.Path(folder).mkdir(parents=True, exist_ok=True)
    names = ("ID", "DATE", "PATIENT", "CODE", "DESCRIPTION", "REASONCODE", "REASONDESCRIPTION")
    table = pa.table({c: pa.array([r[i] for r in records], pa.string()) for i, c in enumerate(names)})
    pq.write_table(table, f"{folder}/{name}.parquet")


def write_lines(folder, name, lines):
    pathlib.Path(folder).mkdir(parents=True, exist_ok=True)
    pathlib.Path(f"{folder}/{name}").write_text("\n".join(lines) + "\n")


def patient_line(key, born, gender):
    values = dict.fromkeys(PATIENT_COLUMNS, "")
    values |= {"ID": key, "BIRTHDATE": born, "GENDER": gender, "SSN": "999", "ADDRESS": '"1 Road, Town"'}
    return ",".join(values[c] for c in PATIENT_COLUMNS)


def feedback_line(key, provider, visit, score, when, tags=("staff",)):
    return json.dumps({
        "feedback_id": key, "provider_id": provider, "visit_id": visit, "timestamp": when,
        "satisfaction_score": score, "comments": "secret", "source": "in_clinic",
        "tags": list(tags), "metadata": {"response_time_ms": "12"},
    })


@pytest.fixture
def medallion(spark, lake):
    return Medallion(
        spark, PipelineConfig(root=lake, default_buckets=2), specs(encounter_format="parquet")
    )


def first_files(root):
    write_claims(f"{root}/source/claims", "a", [
        claim("c1", "p1", "d1", 100.10, "2025-01-01"),
        claim("c2", "p1", "d1", 50.20, "2025-01-03", "Denied", diagnosis=None),
        claim("c3", "p9", "d9", 10.0, "2025-02-30", "Pending"),
        claim(None, "p1", "d1", 1.0, "2025-01-01"),
        claim("c4", None, "d1", 1.0, "2025-01-01"),
    ])
    write_lines(f"{root}/source/patients", "a.csv", [
        ",".join(PATIENT_COLUMNS),
        patient_line("p1", "1980-05-06", "F"), patient_line("p2", "nope", "M"),
        patient_line("", "1990-01-01", "M"),
    ])
    write_lines(f"{root}/source/providers", "a.tsv", [
        "ProviderID\tProviderSpecialty\tProviderLocation",
        "d1\tCardiology\tRome", "d2\tSurgery\tOslo",
    ])
    write_encounters(f"{root}/source/encounters", "a", [
        ("e1", "2025-01-01", "p1", "1", "visit", None, None),
        ("e2", "bad", "p2", "2", "visit", "r", "reason"),
        ("e3", "2025-01-05", "p7", "1", "visit", None, None),
    ])
    write_lines(f"{root}/source/feedback", "a.jsonl", [
        feedback_line("f1", "d1", "e1", 5, "2025-01-02T10:00:00Z"),
        feedback_line("f2", "d9", "e9", 3, "2025-01-02T10:00:00", ()),
        '{"feedback_id": "broken',
    ])


def second_files(root):
    write_claims(f"{root}/source/claims", "b", [
        claim("c2", "p1", "d1", 70.0, "2025-01-03"), claim("c5", "p2", "d2", 5.0, "2025-01-04"),
    ])
    write_lines(f"{root}/source/providers", "b.tsv", [
        "ProviderID\tProviderSpecialty\tProviderLocation",
        "d1\tNeurology\tRome", "d2\tSurgery\tOslo",
    ])
    write_lines(f"{root}/source/patients", "b.csv", [
        ",".join(PATIENT_COLUMNS), patient_line("p2", "1970-01-01", "M"),
        patient_line("p7", "1960-02-03", "F"),  # arrives after its encounter
    ])
    write_encounters(f"{root}/source/encounters", "b", [
        ("e1", "2025-01-09", "p1", "7", "visit", None, None),
    ])
    write_lines(f"{root}/source/feedback", "b.jsonl", [
        feedback_line("f1", "d1", "e1", 1, "2025-03-02T10:00:00Z"),
        feedback_line("f3", "d1", "e1", 4, "2025-03-02T10:00:00+02:00", ("staff", "parking")),
    ])


def test_two_runs(spark, medallion, lake):
    first_files(lake)
    run_ts = dt.datetime(2025, 4, 1, 12)
    assert medallion.run(run_ts, as_of=dt.date(2025, 4, 1)) == 0

    claims = medallion.load("silver_claims")
    assert rows(claims, "claim_id", "claim_amount", "claim_status") == {
        ("c1", 100.10, "Approved"): 1, ("c2", 50.20, "Denied"): 1, ("c3", 10.0, "Pending"): 1,
    }
    assert claims.filter("claim_id = 'c3'").first().claim_date is None
    enriched = medallion.load("silver_claims_enriched")
    assert rows(enriched, "claim_id", "provider_specialty", "provider_missing") == {
        ("c1", "Cardiology", False): 1, ("c2", "Cardiology", False): 1, ("c3", None, True): 1,
    }
    patients = medallion.load("silver_patients")
    assert rows(patients, "id", "birth_year", "gender", "ssn", "address") == {
        ("p1", 1980, "F", None, None): 1, ("p2", None, "M", None, None): 1,
    }
    assert "comments" not in medallion.load("silver_feedback").columns
    bad = changelog_rows(spark, medallion, "feedback")
    assert [r._corrupt_record for r in bad] == ['{"feedback_id": "broken']
    assert rows(medallion.load("silver_encounters_enriched"), "encounter_id", "gender", "patient_missing") == {
        ("e1", "F", False): 1, ("e2", "M", False): 1, ("e3", None, True): 1,
    }

    second_files(lake)
    assert medallion.run(dt.datetime(2025, 4, 2, 12), as_of=dt.date(2025, 4, 2)) == 1

    claims = medallion.load("silver_claims")
    assert rows(claims, "claim_id", "claim_amount", "claim_status") == {
        ("c1", 100.10, "Approved"): 1, ("c2", 70.0, "Approved"): 1,
        ("c3", 10.0, "Pending"): 1, ("c5", 5.0, "Approved"): 1,
    }
    history = medallion.load("silver_providers")
    assert rows(history, "provider_id", "provider_specialty", "is_current") == {
        ("d1", "Cardiology", False): 1, ("d1", "Neurology", True): 1, ("d2", "Surgery", True): 1,
    }
    feedback = medallion.load("silver_feedback")
    assert rows(feedback, "feedback_id", "satisfaction_score", "timestamp_source") == {
        ("f1", 5, "offset"): 1, ("f2", 3, "naive"): 1, ("f3", 4, "offset"): 1,
    }
    assert rows(medallion.load("silver_encounters_enriched"), "encounter_id", "CODE", "gender") == {
        ("e1", "7", "F"): 1, ("e2", "2", "M"): 1, ("e3", "1", "F"): 1,
    }
    approval = medallion.load("gold_claim_approval_by_specialty")
    assert rows(approval) == {
        ("Neurology", 2, 2, 1.0): 1, ("Unknown", 1, 0, 0.0): 1, ("Surgery", 1, 1, 1.0): 1,
    }
    spend = medallion.load("gold_provider_7d_spend").filter("provider_id = 'd1'")
    assert rows(spend, "daily_spend", "rolling_7d_spend", "rolling_7d_avg") == {
        (100.1, 100.1, 100.1): 1, (70.0, 170.1, 85.05): 1,
    }
    lifecycle = medallion.load("gold_patient_lifecycle").filter("patient_id = 'p1'").first()
    assert (lifecycle.visit_count, lifecycle.classification, lifecycle.days_since_last_visit) == (
        1, "new", 83,
    )
    results = medallion.results().filter("run_ts = '2025-04-02 12:00:00'")
    failed = {(r.table_name, r.metric) for r in results.filter("status <> 'PASS'").collect()}
    assert failed == {
        (t, "dup_pk") for t in
        ("bronze_claims", "bronze_providers", "bronze_encounters", "bronze_feedback")
    }
    suppressed = results.filter("table_name = 'bronze_patients' AND metric = 'dup_pk'").first()
    assert (suppressed.status, suppressed.message) == ("PASS", "duplicates suppressed downstream")
    status = {r.layer: r.qa_status for r in dashboards.qa_status(medallion.results()).collect()}
    assert status == {"BRONZE": "ISSUES DETECTED", "SILVER": "PASS", "GOLD": "PASS"}
    assert [r._commit_version for r in medallion.history("claims").collect()] == [2, 1]
    assert medallion.preview("bronze_claims", 2).count() == 2


def changelog_rows(spark, medallion, dataset):
    from medstrata.sources import changelog

    return changelog.read_log(spark, medallion.config.paths("bronze", dataset).quarantine).collect()


def test_third_run_without_new_files_changes_nothing(spark, medallion, lake):
    first_files(lake)
    medallion.run(dt.datetime(2025, 4, 1), as_of=dt.date(2025, 4, 1))
    names = ("silver_claims", "silver_patients", "silver_providers", "silver_feedback",
             "silver_encounters_enriched", "gold_claim_approval_by_specialty")
    before = {n: medallion.load(n).toPandas().astype(str).values.tolist() for n in names}
    medallion.run(dt.datetime(2025, 4, 1, 1), as_of=dt.date(2025, 4, 1))
    for name in names:
        again = medallion.load(name).toPandas().astype(str).values.tolist()
        assert sorted(map(str, again)) == sorted(map(str, before[name])), name

    # A patient who arrives late is added to the encounters that waited for them.
    write_lines(f"{lake}/source/patients", "late.csv", [
        ",".join(PATIENT_COLUMNS), patient_line("p7", "2000-01-01", "F"),
    ])
    medallion.ingest("patients")
    medallion.upsert("patients")
    medallion.refresh_encounters()
    enriched = medallion.load("silver_encounters_enriched")
    assert rows(enriched, "encounter_id", "birth_year", "patient_missing") == {
        ("e1", 1980, False): 1, ("e2", None, False): 1, ("e3", 2000, False): 1,
    }


def test_continuous_encounters(spark, medallion, lake, monkeypatch):
    """The three streams start on empty tables and pass rows on from one to the next."""
    monkeypatch.setattr("medstrata.streaming.runs.STREAM_INTERVAL", "1 second")
    first_files(lake)
    medallion.ingest("patients")
    medallion.upsert("patients")
    queries = medallion.stream_encounters()
    try:
        assert all(q.isActive for q in queries)
        for query in queries:
            query.stop()
        # What the first micro-batches left is picked up by the next start.
        for step in ("ingest", "upsert"):
            query = getattr(medallion, step)("encounters", "stream")
            query.processAllAvailable()
            query.stop()
        query = medallion.enrich_encounters("stream")
        query.processAllAvailable()
        query.stop()
        assert rows(medallion.load("silver_encounters_enriched"), "encounter_id", "patient_missing") == {
            ("e1", False): 1, ("e2", False): 1, ("e3", True): 1,
        }
    finally:
        for query in spark.streams.active:
            query.stop()
