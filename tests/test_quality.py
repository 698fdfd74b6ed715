"""Checks: the documented cases, suppression, broken checks and empty tables."""

import datetime as dt

import pytest

from medstrata.operators.quality import (
    RESULT_SCHEMA, Check, check_contract, check_keys, check_not_null, layer_checks, run_checks,
)

NOW = dt.datetime(2025, 1, 1)


def statuses(report):
    return {r.metric: r.status for r in report.collect()}


@pytest.fixture(scope="module")
def raw(spark):
    return spark.createDataFrame(
        [(None, NOW), (1, NOW), (1, NOW), (2, NOW)], "ID int, _ingest_ts timestamp"
    )


def test_key_checks(raw):
    report = check_keys(raw, "bronze_patients", "ID")
    assert statuses(report) == {
        "row_count": "PASS", "dup_pk": "FAIL", "null_pk_count": "FAIL",
        "max__ingest_ts": "PASS", "null__ingest_ts": "PASS",
    }
    assert {r.metric: r.value for r in report.collect()}["row_count"] == "4"


def test_several_null_keys_are_one_duplicated_key(spark):
    df = spark.createDataFrame([(None,), (None,), (None,), (1,)], "ID int")
    values = {r.metric: r.value for r in check_keys(df, "t", "ID").collect()}
    assert values == {"row_count": "4", "dup_pk": "1", "null_pk_count": "3"}  # no load time, no check


def test_empty_table(raw):
    report = check_keys(raw.limit(0), "t", "ID")
    assert statuses(report) == {
        "row_count": "FAIL", "dup_pk": "PASS", "null_pk_count": "PASS",
        "max__ingest_ts": "FAIL", "null__ingest_ts": "PASS",
    }
    notes = {r.metric: r.message for r in report.collect()}
    assert notes["row_count"] == "row_count == 0"


def test_duplicates_resolved_downstream(spark, raw):
    clean = spark.createDataFrame([(1,), (2,)], "id int")
    dirty = spark.createDataFrame([(1,), (1,)], "id int")
    accepted = {r.metric: r for r in check_keys(raw, "t", "ID", (clean, "id")).collect()}["dup_pk"]
    assert (accepted.status, accepted.message) == ("PASS", "duplicates suppressed downstream")
    refused = {r.metric: r for r in check_keys(raw, "t", "ID", (dirty, "id")).collect()}["dup_pk"]
    assert (refused.status, refused.message) == ("FAIL", None)


def test_contract(spark):
    df = spark.createDataFrame([(None, None)], "encounter_id string, patient_id string")
    row = check_contract(df, "silver_encounters", ["encounter_id", "patient_id", "START_TS"]).first()
    assert (row.status, row.value) == ("FAIL", "1")
    assert "missing" in row.message and "START_TS" in row.message
    assert check_contract(df, "t", ["encounter_id"]).first().status == "PASS"  # extras are fine


def test_not_null(spark):
    schema = "patient_id string, avg_score double"
    bad = spark.createDataFrame([(None, 5.0), ("p1", 4.0)], schema)
    assert statuses(check_not_null(bad, "t", ["patient_id", "avg_score"])) == {
        "nulls[patient_id]": "FAIL", "nulls[avg_score]": "PASS",
    }
    good = spark.createDataFrame([("p1", 5.0)], schema)
    assert statuses(check_not_null(good, "t", ["patient_id"])) == {"nulls[patient_id]": "PASS"}


def test_run_survives_broken_checks(spark, raw, lake):
    tables = {"bronze_a": raw, "gold_a": raw}

    def load(name):
        return tables[name]

    checks = layer_checks(
        load, {"bronze_a": "ID", "bronze_gone": "ID"}, {"silver_gone": ["x"]},
        {"gold_a": ["_ingest_ts"]}, {"bronze_a": ("silver_gone", "id")},
    )
    # This one plans but breaks while it runs.
    checks.append(Check("GOLD", "bad", lambda: check_not_null(
        raw.selectExpr("assert_true(ID > 100) AS x"), "bad", ["x"])))
    code, results = run_checks(spark, checks, NOW, f"{lake}/results")
    assert code == 1
    found = {(r.table_name, r.metric): r for r in results.collect()}
    broken = {key for key, r in found.items() if r.status == "ERROR"}
    assert broken == {("bronze_gone", "exception"), ("silver_gone", "exception"), ("bad", "exception")}
    assert found[("gold_a", "nulls[_ingest_ts]")].status == "PASS"
    assert found[("bronze_a", "dup_pk")].message.startswith("Suppression check failed")
    stored = spark.read.parquet(f"{lake}/results")
    assert stored.count() == results.count() and stored.schema == RESULT_SCHEMA


def test_results_are_appended_per_run(spark, raw, lake):
    good = [Check("GOLD", "t", lambda: check_not_null(raw, "t", ["_ingest_ts"]))]
    for day in (1, 2):
        assert run_checks(spark, good, dt.datetime(2025, 1, day), f"{lake}/results")[0] == 0
    stored = spark.read.parquet(f"{lake}/results")
    assert {r.run_ts.day for r in stored.collect()} == {1, 2}
    row = stored.first()
    assert row.message is None and row.status == "PASS"
    assert list(row.asDict()) == ["run_ts", "layer", "table_name", "metric", "value", "status", "message"]
