"""Aggregations, rolling windows, dashboards and profile reports."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from medstrata.operators import aggregates as agg
from medstrata.plans import dashboards, kpis, profiles
from tests.helpers import rows

D = dt.date


@pytest.fixture(scope="module")
def providers(spark):
    return spark.createDataFrame(
        [("p1", "Cardio", "Rome"), ("p2", None, "Oslo"), ("p3", "Neuro", " ")],
        "provider_id string, provider_specialty string, provider_location string",
    )


@pytest.fixture(scope="module")
def claims(spark):
    data = [
        ("c1", "p1", "Approved", "d1", "x", 10.10, D(2025, 1, 1)),
        ("c2", "p1", "Denied", "d1", "x", 20.00, D(2025, 1, 7)),
        ("c3", "p1", "Denied", None, "x", 30.00, D(2025, 1, 8)),
        ("c4", "p2", "Pending", "d2", "x", 40.00, D(2025, 1, 1)),
        ("c5", "p9", "Approved", "d2", "y", 50.00, None),
        ("c6", "p1", "Approved", "d1", "x", 0.05, D(2025, 1, 1)),
        ("c7", "p1", "Approved", "d1", "x", None, D(2025, 1, 20)),
    ]
    return spark.createDataFrame(
        data,
        "claim_id string, provider_id string, claim_status string, diagnosis_code string, "
        "procedure_code string, claim_amount double, claim_date date",
    )


def test_approval(claims, providers):
    assert rows(kpis.approval_by_specialty(claims, providers)) == {
        ("Cardio", 5, 3, 0.6): 1, ("Unknown", 2, 1, 0.5): 1,
    }
    assert kpis.approval_by_specialty(claims.limit(0), providers).isEmpty()


def test_denials(claims, providers):
    breakdown = kpis.denial_breakdown(claims, providers)
    assert rows(breakdown) == {("Cardio", "d1", 1, 0.5): 1, ("Cardio", "Unknown", 1, 0.5): 1}
    assert rows(kpis.denials_by_specialty(breakdown)) == {("Cardio", 2): 1}


def test_shares_sum_to_one(spark, providers):
    rng = random.Random(5)
    data = [(rng.choice(["p1", "p3"]), f"d{rng.randint(0, 4)}", "Denied") for _ in range(300)]
    claims = spark.createDataFrame(data, "provider_id string, diagnosis_code string, claim_status string")
    shares = kpis.denial_breakdown(claims, providers).groupBy("provider_specialty").agg(
        F.sum("denial_pct").alias("s")
    )
    assert all(abs(r.s - 1) < 1e-3 for r in shares.collect())


def test_high_cost_needs_enough_claims(claims):
    assert rows(kpis.high_cost_procedures(claims), "procedure_code", "avg_claim_amount", "procedure_count") == {
        ("x", 5.08, 3): 1,
    }
    assert kpis.high_cost_procedures(claims, min_claims=1).count() == 2
    assert kpis.high_cost_procedures(claims, min_claims=1, k=1).first().procedure_code == "y"


def test_rolling_spend_edges(claims):
    daily = kpis.provider_daily_spend(claims)
    rolling = kpis.provider_7d_spend(daily)
    got = {(r.provider_id, r.spend_date): (r.rolling_7d_spend, r.rolling_7d_avg) for r in rolling.collect()}
    assert got[("p1", D(2025, 1, 1))] == (10.15, 10.15)
    assert got[("p1", D(2025, 1, 7))] == (30.15, 15.08)  # six days apart: inside
    assert got[("p1", D(2025, 1, 8))] == (50.0, 25.0)    # seven days apart: outside
    assert got[("p1", D(2025, 1, 20))] == (None, None)   # no amount at all
    assert got[("p2", D(2025, 1, 1))] == (40.0, 40.0)
    assert got[("p9", None)] == (50.0, 50.0)             # claims without date form a day of their own


def test_rolling_spend_against_brute_force(spark):
    rng = random.Random(11)
    data = [(rng.choice("ab"), D(2025, 1, 1) + dt.timedelta(rng.randint(0, 40)), rng.randint(1, 9999)) for _ in range(120)]
    df = spark.createDataFrame([(k, d, c / 100) for k, d, c in data], "k string, d date, a double")
    rolling = agg.rolling_total(agg.daily_total(df, "k", "d", "a", "day", "total"), "k", "day", "total", "sum7", "avg7")
    for r in rolling.collect():
        frame = {}
        for k, d, cents in data:
            if k == r.k and 0 <= (r.day - d).days <= 6:
                frame[d] = frame.get(d, 0) + cents
        assert r.sum7 == sum(frame.values()) / 100
        assert abs(r.avg7 - sum(frame.values()) / 100 / len(frame)) <= 0.005 + 1e-9


def feedback_frame(spark):
    data = [
        ("f1", "p1", "e1", 5, "web", ["a"]), ("f2", "p1", "e2", 4, "web", ["a", "b"]),
        ("f3", "p1", " ", None, None, []), ("f4", "p9", "", 1, "web", None),
        ("f5", "p3", "e9", 2, "app", ["b", "b"]), ("f6", "p2", "e1", 3, "app", ["c"]),
    ]
    return spark.createDataFrame(
        data, "feedback_id string, provider_id string, visit_id string, satisfaction_score int, "
              "source string, tags array<string>",
    )


def test_feedback_reports(spark, providers):
    feedback = feedback_frame(spark)
    encounters = spark.createDataFrame([("e1",), ("e2",), ("e3",)], "encounter_id string")
    assert rows(kpis.feedback_satisfaction(feedback, providers)) == {
        ("Cardio", "p1", "web", 2, 4.5): 1, ("Cardio", "p1", "Unknown", 1, None): 1,
        ("Unknown", "p9", "web", 1, 1.0): 1, ("Neuro", "p3", "app", 1, 2.0): 1,
        ("Unknown", "p2", "app", 1, 3.0): 1,
    }
    tags = kpis.feedback_tags(feedback)
    assert [tuple(r) for r in tags.collect()] == [("b", 3, 2.67), ("a", 2, 4.5), ("c", 1, 3.0)]
    assert [r.tag for r in dashboards.tag_summary(tags, 2).collect()] == ["b", "a"]
    assert tuple(kpis.feedback_encounter_match(feedback, encounters).first()) == (6, 4, 66.67, 3)
    empty = kpis.feedback_encounter_match(feedback.limit(0), encounters).first()
    assert tuple(empty) == (0, 0, None, 0)
    assert tuple(dashboards.feedback_rate(feedback, encounters).first()) == (3, 6, 200.0)
    assert rows(dashboards.satisfaction_by_specialty(feedback, providers, least=2)) == {
        ("Cardio", 4.5, 2): 1, ("Unknown", 2.0, 2): 1,
    }
    assert rows(dashboards.satisfaction_by_location(feedback, providers, least=1)) == {
        ("Rome", 4.5, 2): 1, ("Oslo", 3.0, 1): 1,
    }


def test_lifecycle(spark):
    ts = dt.datetime
    data = [
        ("one", ts(2025, 1, 1)), ("same_day", ts(2025, 1, 1, 1)), ("same_day", ts(2025, 1, 1, 23)),
        ("late", ts(2025, 1, 1, 23, 59, 59)), ("late", ts(2025, 1, 2, 0, 0, 1)), ("undated", None),
        ("many", ts(2025, 1, 1)), ("many", ts(2025, 1, 2)), ("many", ts(2025, 1, 4)), ("many", None),
    ]
    encounters = spark.createDataFrame(data, "patient_id string, START_TS timestamp")
    got = {r.patient_id: r for r in kpis.patient_lifecycle(encounters, F.lit(D(2025, 2, 1))).collect()}
    facts = {k: (r.lifetime_days, r.visit_count, r.classification, r.avg_days_between_visits, r.days_since_last_visit)
             for k, r in got.items()}
    assert facts == {
        "one": (0, 1, "new", None, 31), "same_day": (0, 2, "returning", 0.0, 31),
        "late": (1, 2, "returning", 1.0, 30), "undated": (None, 1, "new", None, None),
        "many": (3, 4, "returning", 1.0, 28),
    }
    summary = dashboards.patient_summary(kpis.patient_lifecycle(encounters))
    assert tuple(summary.first()) == (5, 2, 3)


def test_money_dashboards(claims, providers):
    approval = kpis.approval_by_specialty(claims, providers)
    assert [tuple(r) for r in dashboards.denial_rate(approval).collect()] == [
        ("Unknown", 50.0, 2), ("Cardio", 40.0, 5),
    ]
    assert [tuple(r) for r in dashboards.top_providers(claims, providers, 2).collect()] == [
        ("p9", "Unknown", 50.0), ("p1", "Cardio", 10.15),
    ]
    rolling = kpis.provider_7d_spend(kpis.provider_daily_spend(claims))
    spend = dashboards.rolling_spend(rolling, F.lit(D(2025, 3, 8)), days=60)
    assert [tuple(r) for r in spend.collect()] == [
        (D(2025, 1, 7), 30.15), (D(2025, 1, 8), 50.0), (D(2025, 1, 20), None),
    ]
    assert dashboards.rolling_spend_by_day(spend).count() == 3


def test_check_dashboards(spark):
    old, new = dt.datetime(2025, 1, 1), dt.datetime(2025, 1, 2)
    data = [(old, "GOLD", "ERROR"), (new, "GOLD", "PASS"), (new, "BRONZE", "FAIL"), (new, "BRONZE", "FAIL"),
            (new, "SILVER", "ERROR"), (new, "X", "PASS"), (new, "SILVER", "PASS")]
    results = spark.createDataFrame(data, "run_ts timestamp, layer string, status string")
    assert [tuple(r) for r in dashboards.qa_status(results).collect()] == [
        ("BRONZE", 0, 2, 0, "ISSUES DETECTED"), ("SILVER", 1, 0, 1, "ISSUES DETECTED"),
        ("GOLD", 1, 0, 0, "PASS"), ("X", 1, 0, 0, "PASS"),
    ]
    assert [tuple(r) for r in dashboards.failures(results).collect()] == [("FAIL", 2), ("ERROR", 1)]
    assert rows(dashboards.qa_volume(results)) == {
        ("BRONZE", 2, 2): 1, ("SILVER", 2, 1): 1, ("GOLD", 1, 0): 1, ("X", 1, 0): 1,
    }


def test_profiles(spark, claims, providers):
    day = D(2025, 1, 1)
    many = spark.createDataFrame([("p", day)] * 6 + [("q", day)] * 5, "patient_id string, claim_date date")
    assert rows(profiles.rapid_fire_claims(many)) == {("p", day, 6): 1}
    years = spark.createDataFrame([(y,) for y in (2001, 1984, 1983, 1967, 1966, 1952, 1951, 1936, None, 2002)], "y int")
    bands = [r[0] for r in years.select(profiles.age_band(F.col("y"), 2001)).collect()]
    assert bands == ["0-17", "0-17", "18-34", "18-34", "35-49", "35-49", "50-64", "65+", "Unknown", "Unknown"]
    assert tuple(profiles.provider_match_rate(claims, providers).first()) == (7, 1, 0.8571)
    patients = spark.createDataFrame(
        [("1", " f", 1980), ("2", "M", 1800), ("3", "?", 2030), ("4", None, None)],
        "id string, gender string, birth_year int",
    )
    assert rows(profiles.cleanse_demographics(patients, 2025)) == {
        ("1", "F", 1980): 1, ("2", "M", None): 1, ("3", None, None): 1, ("4", None, None): 1,
    }
    assert rows(profiles.gender_breakdown(patients, 2025)) == {("F", 1): 1, ("M", 1): 1}
    encounters = spark.createDataFrame(
        [("e1", "1", dt.datetime(2025, 1, 5, 3)), ("e2", "1", dt.datetime(2025, 1, 9)),
         ("e3", "9", dt.datetime(2025, 1, 9)), ("e4", "1", dt.datetime(2020, 1, 9))],
        "encounter_id string, patient_id string, START_TS timestamp",
    )
    assert rows(profiles.unmatched_entities(encounters, patients)) == {
        ("encounter_without_patient", "e3"): 1, ("patient_without_encounter", "2"): 1,
        ("patient_without_encounter", "3"): 1, ("patient_without_encounter", "4"): 1,
    }
    assert rows(profiles.encounters_by_month(encounters, patients, F.lit(D(2025, 2, 1)))) == {
        (D(2025, 1, 1), " f", 1980, 2): 1,
    }
    hours = spark.createDataFrame(
        [(dt.datetime(2025, 1, 1, 10, 5), 1.1), (dt.datetime(2025, 1, 1, 10, 59), 2.2),
         (dt.datetime(2025, 1, 1, 11), None)], "t timestamp, claim_amount double",
    )
    assert rows(profiles.hourly_claims(hours, "t")) == {
        (dt.datetime(2025, 1, 1, 10), 2, 3.3, 1.65): 1, (dt.datetime(2025, 1, 1, 11), 1, None, None): 1,
    }


def test_feedback_variability(spark, providers):
    feedback = feedback_frame(spark).withColumn("comments", F.when(F.col("source") == "web", "abcd"))
    got = {(r.provider_specialty, r.source): r for r in profiles.feedback_variability(feedback, providers).collect()}
    web = got[("Cardio", "web")]
    assert (web.feedback_count, web.score_stddev, web.min_score, web.max_score) == (2, 0.7071, 4, 5)
    assert (web.comment_count, web.avg_comment_length) == (2, 4.0)
    assert got[("Cardio", "Unknown")].score_stddev is None
