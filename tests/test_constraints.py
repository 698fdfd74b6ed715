"""Constraints on write, figures observed while writing, reports kept by a stream."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from medstrata.config import PipelineConfig
from medstrata.operators.changes import diff_states
from medstrata.operators.constraints import VIOLATED, gate, split_violations, violation_results, write_checked
from medstrata.operators.quality import check_not_null, check_observed_nulls, null_counts
from medstrata.plans import healthcare, profiles
from medstrata.plans.ingest_specs import specs
from medstrata.plans.medallion import Medallion
from medstrata.sources import changelog
from medstrata.sources.tables import publish, read_table
from medstrata.streaming.aggregates import keep_report, monthly_encounters
from tests.helpers import plan, rows, same
from tests.test_medallion import first_files

PEOPLE = "id string, gender string, birth_year int"
T = dt.datetime(2025, 1, 1)


def people(spark):
    return spark.createDataFrame(
        [("a", "F", 1980), ("b", "X", 1980), ("c", "M", 1700), ("d", "Q", 3000), ("e", None, None)], PEOPLE
    )


def test_false_breaks_and_null_passes(spark):
    clean, broken = split_violations(people(spark), profiles.demographic_constraints(2025))
    assert rows(clean, "id") == {("a",): 1, ("e",): 1} and VIOLATED not in clean.columns
    assert {r["id"]: r[VIOLATED] for r in broken.collect()} == {
        "b": ["valid_gender"], "c": ["valid_birth_year"], "d": ["valid_gender", "valid_birth_year"],
    }


def test_rows_are_counted_while_they_are_written(spark, lake):
    path = f"{lake}/people"
    found = gate(people(spark), profiles.demographic_constraints(2025), publish, path)
    assert found == {"valid_gender": 2, "valid_birth_year": 2}
    assert read_table(spark, path).count() == 2 and read_table(spark, f"{path}_rejected").count() == 3
    assert violation_results("SILVER", "people", found)[0] == (
        "SILVER", "people", "violations[valid_gender]", "2", "FAIL", "2 rows set aside",
    )
    found = gate(people(spark).filter("id = 'a'"), profiles.demographic_constraints(2025), publish, path)
    assert found == {"valid_gender": 0, "valid_birth_year": 0}
    assert read_table(spark, f"{path}_rejected").isEmpty()
    assert [r[4] for r in violation_results("SILVER", "people", found)] == ["PASS", "PASS"]


def test_a_failing_write_is_not_swallowed(spark):
    def fail(_):
        raise OSError("disk full")

    with pytest.raises(OSError):
        write_checked(people(spark), profiles.demographic_constraints(2025), fail, fail)


def test_observed_figures_equal_the_scan(spark, lake):
    from pyspark.sql import Observation

    seen, columns = Observation(), ["gender", "birth_year", "id"]
    publish(people(spark).observe(seen, *null_counts(columns)), f"{lake}/t")
    same(check_observed_nulls(spark, seen.get, "t", columns), check_not_null(read_table(spark, f"{lake}/t"), "t", columns))
    assert "Scan parquet" not in plan(check_observed_nulls(spark, seen.get, "t", columns))


def test_pipeline_with_constraints(spark, lake, monkeypatch):
    constraints = {"gold_provider_daily_spend": {"not_dear": F.col("daily_spend") < 60}}
    medallion = Medallion(spark, PipelineConfig(root=lake, default_buckets=2), specs(encounter_format="parquet"), constraints)
    first_files(lake)
    scanned = []
    monkeypatch.setattr("medstrata.operators.quality.check_not_null", lambda df, table, columns: scanned.append(table))
    assert medallion.run(T, as_of=dt.date(2025, 1, 1)) == 1
    assert scanned == []  # every report table was checked from what its write observed
    assert rows(medallion.load("gold_provider_daily_spend"), "daily_spend") == {(50.2,): 1, (10.0,): 1}
    assert [(r["daily_spend"], r[VIOLATED]) for r in medallion.rejected("gold_provider_daily_spend").collect()] == [(100.1, ["not_dear"])]
    results = {(r.table_name, r.metric): (r.value, r.status) for r in medallion.results().collect()}
    assert results["gold_provider_daily_spend", "violations[not_dear]"] == ("1", "FAIL")
    assert results["silver_claims", "unfit[claim_amount]"] == ("0", "PASS")
    for table, columns in healthcare.NOT_NULL.items():
        assert all(results[table, f"nulls[{c}]"] == ("0", "PASS") for c in columns)


def test_monthly_report_follows_changes(spark, lake):
    patients = spark.createDataFrame([("p1", "F", 1980), ("p2", None, 1970)], PEOPLE)
    visit = "encounter_id string, patient_id string, START_TS timestamp"
    states = [
        [("e1", "p1", T), ("e2", "p1", T), ("e3", "p2", T), ("e4", "p9", T), ("e5", "p1", dt.datetime(2020, 1, 1))],
        [("e1", "p1", dt.datetime(2025, 2, 3)), ("e2", "p1", T), ("e6", "p1", T)],
        [("e1", "p1", dt.datetime(2025, 2, 3))],
    ]
    expected = [{(1, 2): 1}, {(1, 2): 1, (2, 1): 1}, {(2, 1): 1}]
    before = spark.createDataFrame([], visit)
    for version, state in enumerate(states, 1):
        now = spark.createDataFrame(state, visit)
        changelog.write_commit(diff_states(before, now, ["encounter_id"]), f"{lake}/log", version)
        report = monthly_encounters(changelog.stream_log(spark, f"{lake}/log"), patients, F.lit("2023-01-01").cast("timestamp"))
        keep_report(report, "encounter_count", f"{lake}/t", f"{lake}/cp")
        found = read_table(spark, f"{lake}/t")
        assert rows(found.select(F.month("month"), "encounter_count")) == expected[version - 1]
        known = profiles.encounters_by_month(now, patients, F.lit("2025-01-01").cast("date"))
        same(found, known)
        before = now
