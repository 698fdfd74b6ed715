"""Gates, deduplication, enrichment, upserts, history and change capture."""

import datetime as dt
import re
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from medstrata.operators.changes import commit_history, diff_states
from medstrata.operators.clean import keep_new_state, require, standardize
from medstrata.operators.dedupe import latest_commit, latest_per_key
from medstrata.operators.enrich import (
    count_missing, count_orphans, join_coverage, left_enrich, measure_by_key, refresh_missing,
)
from medstrata.operators.upsert import (
    apply_history, changed_versions, insert_new, open_versions, upsert_latest, upsert_newest,
    upsert_newest_at_once,
)
from medstrata.streaming.upserts import merge_newest
from tests.helpers import plan, rows, same

T1, T2, T3 = (dt.datetime(2025, m, 1) for m in (1, 2, 3))


# ---- cleaning ---------------------------------------------------------------

def test_gates(spark):
    df = spark.createDataFrame([("a", "x"), (None, "x"), ("b", None)], "k string, f string")
    assert rows(require(df, ["k"])) == {("a", "x"): 1, ("b", None): 1}
    assert rows(require(df, ["k", "f"])) == {("a", "x"): 1}
    kinds = ["insert", "update_preimage", "update_postimage", "delete", None]
    changes = spark.createDataFrame([(k,) for k in kinds], "_change_type string")
    assert rows(keep_new_state(changes)) == {("insert",): 1, ("update_postimage",): 1}


def test_standardize_keeps_rows_with_unreadable_values(spark):
    df = spark.createDataFrame([("1", "12.5"), ("2", "abc"), ("3", None)], "ID string, A string")
    got = standardize(df, {"id": "ID", "amount": ("A", "double"), "one": F.lit(1)})
    assert rows(got) == {("1", 12.5, 1): 1, ("2", None, 1): 1, ("3", None, 1): 1}


# ---- dedupe -----------------------------------------------------------------

def test_latest_per_key(spark):
    data = [("a", 1, "x"), ("a", 3, "y"), ("a", 3, "z"), ("a", None, "q"), ("b", None, "n"), (None, 1, "k")]
    df = spark.createDataFrame(data, "k string, v int, t string")
    assert rows(latest_per_key(df, ["k"], ["v"], ["t"])) == {
        ("a", 3, "z"): 1, ("b", None, "n"): 1, (None, 1, "k"): 1,
    }


def test_latest_per_key_limits_groups_before_the_exchange(spark):
    hot = F.when(F.col("id") < 400, -1).otherwise(F.col("id"))
    df = spark.range(1000).select(hot.alias("k"), F.col("id").alias("v"))
    text = plan(latest_per_key(df, ["k"], ["v"]))
    partial, exchange = text.index("1, Partial"), text.index("Exchange hashpartitioning(k")
    assert partial > exchange  # printed below the exchange: runs in the map tasks


def test_latest_commit_drops_the_order_columns(spark):
    df = spark.createDataFrame(
        [("a", "old", 1, T1), ("a", "new", 2, T1), ("b", "first", 1, T1), ("b", "second", 1, T2)],
        "k string, v string, _commit_version long, _commit_timestamp timestamp",
    )
    assert rows(latest_commit(df, ["k"])) == {("a", "new"): 1, ("b", "second"): 1}


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.sampled_from("ab"), st.integers(0, 3) | st.none(), st.integers(0, 9)), min_size=1))
def test_latest_per_key_against_plain_python(spark, data):
    df = spark.createDataFrame(data, "k string, v int, t int")
    best = {}
    for row in data:
        rank = (row[1] is not None, row[1] or 0, row[2])
        if row[0] not in best or rank > best[row[0]][0]:
            best[row[0]] = (rank, row)
    assert rows(latest_per_key(df, ["k"], ["v"], ["t"])) == Counter(r for _, r in best.values())


# ---- enrichment -------------------------------------------------------------

@pytest.fixture(scope="module")
def fact(spark):
    data = [(1, "a", 10.0), (2, "b", 5.0), (3, "z", 1.0), (4, None, 2.0), (5, "a", 7.0)]
    return spark.createDataFrame(data, "id int, key string, amount double")


@pytest.fixture(scope="module")
def dim(spark):
    return spark.createDataFrame([("a", "red"), ("b", None), ("c", "blue")], "key string, color string")


def test_left_enrich(fact, dim):
    got = left_enrich(fact, dim, "key", "key", ["color"], "missing")
    assert got.columns == ["id", "key", "amount", "color", "missing"]
    assert rows(got, "id", "color", "missing") == {
        (1, "red", False): 1, (2, None, False): 1, (3, None, True): 1, (4, None, True): 1,
        (5, "red", False): 1,
    }


def test_current_version_only(spark, fact):
    from medstrata.plans.healthcare import claims_enriched

    history = spark.createDataFrame(
        [("a", "old", "x", False), ("a", "new", "x", True), ("b", "gone", "x", False)],
        "provider_id string, provider_specialty string, provider_location string, is_current boolean",
    )
    claims = fact.withColumnRenamed("key", "provider_id")
    assert rows(claims_enriched(claims, history), "id", "provider_specialty", "provider_missing") == {
        (1, "new", False): 1, (2, None, True): 1, (3, None, True): 1, (4, None, True): 1,
        (5, "new", False): 1,
    }


def test_orphans(fact, dim):
    assert count_orphans(fact, dim, "key", "key", "n").first().n == 2
    assert count_orphans(fact.limit(0), dim, "key", "key", "n").first().n == 0
    got = count_missing(fact, {"x": ("key", dim, "key"), "y": ("key", dim.limit(0), "key")})
    assert tuple(got.first()) == (2, 5)


def test_join_coverage_is_the_size_of_the_join(spark, fact, dim):
    doubled = dim.unionByName(dim.filter("key = 'a'"))
    joined = fact.join(doubled.withColumnRenamed("key", "k"), F.col("key") == F.col("k"), "left")
    got = join_coverage(fact, doubled, "key", "key").first()
    assert (got.joined_rows, got.matched_rows) == (joined.count(), joined.filter("k is not null").count())


def test_measure_by_key_equals_aggregating_the_enriched_rows(fact, dim):
    early = measure_by_key(
        fact, ["key"], {"n": F.count(F.lit(1)), "s": F.sum("amount")}, dim, "key", "key", ["color"]
    ).groupBy("color").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    late = left_enrich(fact, dim, "key", "key", ["color"]).groupBy("color").agg(
        F.count(F.lit(1)).alias("n"), F.sum("amount").alias("s")
    )
    same(early, late)


def test_refresh_missing(spark, fact, dim):
    enriched = left_enrich(fact, dim, "key", "key", ["color"], "missing")
    grown = dim.unionByName(spark.createDataFrame([("z", "green")], dim.schema))
    got = refresh_missing(enriched, grown, "key", "key", ["color"], "missing")
    assert rows(got) == {(3, "z", 1.0, "green", False): 1}


# ---- upserts ----------------------------------------------------------------

def test_upsert_latest(spark):
    schema = "k string, v int"
    target = spark.createDataFrame([("a", 1), ("b", 2)], schema)
    batch = spark.createDataFrame([("b", 20), ("c", 30)], schema)
    merged = upsert_latest(target, batch, ["k"])
    assert rows(merged) == {("a", 1): 1, ("b", 20): 1, ("c", 30): 1}
    same(upsert_latest(merged, batch, ["k"]), merged)
    assert rows(upsert_latest(target.limit(0), batch, ["k"])) == {("b", 20): 1, ("c", 30): 1}


def test_upsert_newest_ignores_the_order_of_arrival(spark):
    schema = "k string, v int, _commit_version long, _commit_timestamp timestamp"
    old = spark.createDataFrame([("a", 1, 1, T1), ("b", 1, 1, T1)], schema)
    new = spark.createDataFrame([("a", 2, 2, T2)], schema)
    empty = old.limit(0)
    forward = upsert_newest(upsert_newest(empty, old, ["k"]), new, ["k"])
    backward = upsert_newest(upsert_newest(empty, new, ["k"]), old, ["k"])
    same(forward, backward)
    same(upsert_newest(forward, old, ["k"]), forward)
    assert rows(forward, "k", "v") == {("a", 2): 1, ("b", 1): 1}


def test_a_large_batch_meets_the_target_in_one_join(spark):
    schema = "k string, there int, _commit_version long, _commit_timestamp timestamp"
    target = spark.createDataFrame(
        [("a", 1, 1, T1), ("b", 1, 3, T1), ("c", 1, None, T1), (None, 1, 1, T1), ("d", None, 2, T2), ("e", 1, 1, T1)], schema
    )
    batch = spark.createDataFrame(
        [("a", 2, 2, T2), ("b", 2, 2, T2), ("c", 2, 0, None), (None, 2, 9, T1), ("d", 2, 2, T2), ("f", None, 1, T1)], schema
    )
    for old, new in ((target, batch), (batch, target), (target.limit(0), batch), (target, batch.limit(0))):
        same(upsert_newest_at_once(old, new, ["k"]), upsert_newest(old, new, ["k"]))
        same(merge_newest(old, new, ["k"]), upsert_newest(old, new, ["k"]))
    assert len(re.findall(r"Join .*Full|Join .*Left", plan(merge_newest(target, batch, ["k"])))) == 1


def test_insert_new_never_updates(spark):
    target = spark.createDataFrame([("a", 1)], "k string, v int")
    batch = spark.createDataFrame([("a", 9), ("b", 2)], "k string, v int")
    merged = insert_new(target, batch, ["k"])
    assert rows(merged) == {("a", 1): 1, ("b", 2): 1}
    same(insert_new(merged, batch, ["k"]), merged)


# ---- type-2 history ---------------------------------------------------------

TRACKED = ["spec", "loc"]


def versions(spark, data, ts):
    df = spark.createDataFrame([(*d, ts) for d in data], "id string, spec string, loc string, _ingest_ts timestamp")
    return open_versions(df)


def check_history(history):
    """At most one current row per key, and intervals that do not overlap."""
    by_key = {}
    for r in history.collect():
        by_key.setdefault(r.id, []).append(r)
        assert r.is_current == (r.eff_end_ts is None)
    for found in by_key.values():
        found.sort(key=lambda r: r.eff_start_ts)
        assert sum(r.is_current for r in found) == 1
        for one, two in zip(found, found[1:]):
            assert one.eff_end_ts <= two.eff_start_ts


def test_history(spark):
    first = versions(
        spark,
        [("changed", "s1", "l"), ("same", "s", None), ("to_null", "s", "l"), ("from_null", None, "l"), ("absent", "s", "l")],
        T1,
    )
    second = versions(
        spark,
        [("changed", "s2", "l"), ("same", "s", None), ("to_null", "s", None), ("from_null", "s", "l"), ("new", "s", "l")],
        T2,
    )
    history = apply_history(first, second, "id", TRACKED)
    assert rows(history, "id", "spec", "loc", "eff_start_ts", "eff_end_ts", "is_current") == {
        ("changed", "s1", "l", T1, T2, False): 1, ("changed", "s2", "l", T2, None, True): 1,
        ("same", "s", None, T1, None, True): 1,
        ("to_null", "s", "l", T1, T2, False): 1, ("to_null", "s", None, T2, None, True): 1,
        ("from_null", None, "l", T1, T2, False): 1, ("from_null", "s", "l", T2, None, True): 1,
        ("absent", "s", "l", T1, None, True): 1, ("new", "s", "l", T2, None, True): 1,
    }
    check_history(history)
    same(apply_history(history, second, "id", TRACKED), history)  # a rerun changes nothing
    assert changed_versions(history, second, "id", TRACKED).isEmpty()
    assert {r.id for r in changed_versions(first, second, "id", TRACKED).collect()} == {
        "changed", "to_null", "from_null", "new",
    }
    third = apply_history(history, versions(spark, [("changed", "s1", "l")], T3), "id", TRACKED)
    check_history(third)
    assert third.filter("id = 'changed'").count() == 3


def test_key_with_closed_rows_only_gets_a_current_row(spark):
    closed = versions(spark, [("a", "s", "l")], T1).withColumns(
        {"eff_end_ts": F.lit(T2), "is_current": F.lit(False)}
    )
    history = apply_history(closed, versions(spark, [("a", "s", "l")], T3), "id", TRACKED)
    assert rows(history, "eff_start_ts", "is_current") == {(T1, False): 1, (T3, True): 1}


# ---- change capture ---------------------------------------------------------

def test_diff_states(spark):
    schema = "k int, v string"
    old = spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (4, None)], schema)
    new = spark.createDataFrame([(1, "a"), (2, "B"), (3, None), (4, "d"), (5, "e")], schema)
    changes = diff_states(old, new, ["k"])
    assert rows(changes) == {
        (2, "b", "update_preimage"): 1, (2, "B", "update_postimage"): 1,
        (4, None, "update_preimage"): 1, (4, "d", "update_postimage"): 1, (5, "e", "insert"): 1,
    }
    back = diff_states(new, old, ["k"]).filter("_change_type = 'delete'")
    assert rows(back) == {(5, "e", "delete"): 1}
    applied = upsert_latest(old, keep_new_state(changes).drop("_change_type"), ["k"])
    same(applied, new)
    assert diff_states(new, new, ["k"]).isEmpty()


def test_commit_history(spark):
    log = spark.createDataFrame(
        [(1, T1, "insert"), (1, T1, "insert"), (2, T2, "update_preimage"),
         (2, T2, "update_postimage"), (3, T3, "delete")],
        "_commit_version long, _commit_timestamp timestamp, _change_type string",
    )
    got = [tuple(r) for r in commit_history(log, newest=2).collect()]
    assert got == [(3, T3, 0, 0, 0, 1), (2, T2, 0, 1, 1, 0)]


def test_diff_states_with_null_keys(spark):
    old = spark.createDataFrame([(None, "a"), (1, "b")], "k int, v string")
    new = spark.createDataFrame([(None, "c"), (1, "b")], "k int, v string")
    assert rows(diff_states(old, new, ["k"]), "k", "v", "_change_type") == {(None, "a", "delete"): 1, (None, "c", "insert"): 1}
