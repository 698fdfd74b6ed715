"""Bucketed tables and incremental upserts: incremental must equal full."""

import datetime as dt
import pathlib
import random

import pytest
from pyspark.sql import functions as F

from medstrata.operators.dedupe import latest_commit
from medstrata.operators.enrich import left_enrich
from medstrata.operators.upsert import open_versions, upsert_latest
from medstrata.sources import changelog
from medstrata.sources.tables import (
    expire, live_buckets, merge_bucketed, only_writer, publish, read_bucketed, read_table,
)
from medstrata.streaming.upserts import (
    UpsertSpec, append_new, applied_changes, enrich_stream, merge_history, read_cleaned,
    upsert_stream,
)
from tests.helpers import plan, rows, same

SCHEMA = "k string, v int"
CHANGES = "k string, v int, _change_type string, _commit_timestamp timestamp"
T = dt.datetime(2025, 1, 1)


def test_snapshots_and_unfinished_versions(spark, lake):
    path = f"{lake}/t"
    with pytest.raises(FileNotFoundError):
        read_table(spark, path)
    assert publish(spark.range(1), path) == 0
    assert publish(read_table(spark, path).union(spark.range(5, 6)), path) == 1
    pathlib.Path(f"{path}/v=2").mkdir()  # a writer that died before its marker
    assert rows(read_table(spark, path)) == {(0,): 1, (5,): 1}
    assert publish(spark.range(3), path) == 2
    assert read_table(spark, path).count() == 3


def test_merge_rewrites_touched_buckets_only(spark, lake):
    path = f"{lake}/t"
    base = spark.createDataFrame([(f"k{i}", i) for i in range(200)], SCHEMA)
    assert merge_bucketed(base, path, ["k"], 8, upsert_latest).isEmpty()
    before = live_buckets(spark, path)
    assert len(before) == 8
    batch = spark.createDataFrame([("k3", -3)], SCHEMA)
    merge_bucketed(batch, path, ["k"], 8, upsert_latest)
    after = live_buckets(spark, path)
    assert sum(after[b] != before[b] for b in after) == 1
    expected = base.filter("k <> 'k3'").union(batch)
    same(read_bucketed(spark, path), expected)
    merge_bucketed(batch, path, ["k"], 8, upsert_latest)  # repeated batch
    same(read_bucketed(spark, path), expected)
    assert merge_bucketed(batch.limit(0), path, ["k"], 8, upsert_latest) is None


def test_expire_keeps_the_newest_copy_of_every_bucket(spark, lake):
    path = f"{lake}/t"
    base = spark.createDataFrame([(f"k{i}", i) for i in range(40)], SCHEMA)
    merge_bucketed(base, path, ["k"], 4, upsert_latest)
    for i in range(4):
        merge_bucketed(spark.createDataFrame([("k3", -i)], SCHEMA), path, ["k"], 4, upsert_latest)
    before = read_bucketed(spark, path).collect()
    live = live_buckets(spark, path)
    assert expire(spark, path, keep=9) == 0
    # Versions 0 to 2 are old; version 0 still holds three live buckets.
    assert expire(spark, path, keep=2) == 3
    assert live_buckets(spark, path) == live
    assert sorted(read_bucketed(spark, path).collect()) == sorted(before)
    assert sorted(p.name for p in pathlib.Path(path).glob("v=*")) == ["v=0", "v=3", "v=4"]


@pytest.mark.parametrize("first, later", [(4, 6), (4, 8), (8, 4)])
def test_another_number_of_buckets_loses_nothing(spark, lake, first, later):
    path = f"{lake}/t"
    merge_bucketed(spark.createDataFrame([(f"k{i}", i) for i in range(100)], SCHEMA), path, ["k"], first, upsert_latest)
    merge_bucketed(spark.createDataFrame([("k1", -1), ("k2", -2), ("new", 0)], SCHEMA), path, ["k"], later, upsert_latest)
    expected = {(f"k{i}", -i if i in (1, 2) else i): 1 for i in range(100)} | {("new", 0): 1}
    assert rows(read_bucketed(spark, path)) == expected
    with pytest.raises(ValueError):
        merge_bucketed(spark.createDataFrame([("k1", -1)], SCHEMA), path, ["v"], first, upsert_latest)


def test_columns_are_kept_on_merge_and_read(spark, lake):
    path = f"{lake}/t"
    merge_bucketed(spark.createDataFrame([(f"k{i}", i) for i in range(20)], SCHEMA), path, ["k"], 4, upsert_latest)
    wide = spark.createDataFrame([("k1", 1, "x")], SCHEMA + ", more string")
    merge_bucketed(wide, path, ["k"], 4, upsert_latest)
    merge_bucketed(spark.createDataFrame([("k1", -1), ("k2", -2), ("k99", 99)], SCHEMA), path, ["k"], 4, upsert_latest)
    merge_bucketed(spark.createDataFrame([("k3",)], "k string"), path, ["k"], 4, upsert_latest)
    found = {r["k"]: (r["v"], r["more"]) for r in read_bucketed(spark, path).collect()}
    assert found == {f"k{i}": (i, None) for i in range(20)} | {"k1": (-1, "x"), "k2": (-2, None), "k99": (99, None)}
    with pytest.raises(ValueError):
        merge_bucketed(spark.createDataFrame([("k1", "text")], "k string, v string"), path, ["k"], 4, upsert_latest)


def test_a_second_writer_is_refused(spark, lake):
    path = f"{lake}/t"
    base = spark.createDataFrame([("a", 1)], SCHEMA)
    with only_writer(spark, path):
        with pytest.raises(RuntimeError):
            merge_bucketed(base, path, ["k"], 4, upsert_latest)
        with pytest.raises(RuntimeError):
            publish(base, path)
    merge_bucketed(base, path, ["k"], 4, upsert_latest)
    pathlib.Path(f"{path}/_writer").write_text('["another application", 0]')  # left behind long ago
    merge_bucketed(base, path, ["k"], 4, upsert_latest)
    assert rows(read_bucketed(spark, path)) == {("a", 1): 1}


def test_publish_keeps_few_versions(spark, lake):
    path = f"{lake}/t"
    for i in range(5):
        publish(spark.range(i), path, keep=2)
    assert sorted(p.name for p in pathlib.Path(path).glob("v=*")) == ["v=3", "v=4"]
    assert read_table(spark, path).count() == 4


def test_a_bounded_run_merges_its_backlog_once(spark, lake):
    log, target = f"{lake}/log", f"{lake}/t"
    for i in range(6):
        changes = spark.createDataFrame([(f"k{j}", i, "insert", T) for j in range(3)], CHANGES)
        changelog.write_commit(changes, log, i + 1)
    spec = UpsertSpec(lambda df: df.drop("_change_type"), ["k"], buckets=2)
    upsert_stream(changelog.stream_log(spark, log, max_files=None), target, spec, f"{lake}/cp")
    assert [p.name for p in pathlib.Path(target).glob("v=*")] == ["v=0"]
    assert rows(read_cleaned(spark, target)) == {(f"k{j}", 5): 1 for j in range(3)}


def test_log_keeps_a_column_that_later_commits_lack(spark, lake):
    log = f"{lake}/log"
    changelog.write_commit(spark.createDataFrame([(1, "x")], "a int, b string"), log, 1)
    changelog.write_commit(spark.createDataFrame([(2,)], "a int"), log, 2)
    assert rows(changelog.read_log(spark, log), "a", "b") == {(1, "x"): 1, (2, None): 1}
    plan_text = plan(changelog.read_log(spark, log, changelog.newest_numbers(spark, log, 1)[0]))
    assert "PartitionFilters: [isnotnull(_commit_version" in plan_text


def prepare(changes):
    kept = changes.filter(F.col("_change_type").isin("insert", "update_postimage"))
    return kept.drop("_change_type")


def commit(spark, path, version, data):
    df = spark.createDataFrame([(*d, T + dt.timedelta(days=version)) for d in data], CHANGES)
    changelog.write_commit(df, path, version)


def test_incremental_equals_full(spark, lake):
    log, target = f"{lake}/log", f"{lake}/target"
    spec = UpsertSpec(prepare, ["k"], ["v"], buckets=4)
    rng = random.Random(3)
    kinds = ["insert", "update_postimage", "update_preimage", "delete"]
    commit(spark, log, 0, [("created", 0, "insert")])
    for version in (1, 2, 3):
        commit(spark, log, version, [
            (f"k{rng.randint(0, 30)}", rng.randint(0, 99), rng.choice(kinds)) for _ in range(60)
        ])
        # One file at a time: a commit may be spread over several micro-batches.
        upsert_stream(changelog.stream_log(spark, log, max_files=1), target, spec, f"{lake}/cp")
        full = latest_commit(prepare(changelog.read_log(spark, log, 1)), ["k"], ["v"])
        same(read_cleaned(spark, target), full)
    assert read_cleaned(spark, target).filter("k = 'created'").isEmpty()


def test_applied_changes_leave_out_rows_that_lost(spark):
    schema = "k string, v int, _commit_version long, _commit_timestamp timestamp"
    before = spark.createDataFrame([("a", 5, 5, T), ("b", 1, 1, T)], schema)
    latest = spark.createDataFrame([("a", 3, 3, T), ("b", 2, 2, T), ("c", 1, 1, T)], schema)
    assert rows(applied_changes(before, latest, ["k"]), "k", "v", "_change_type") == {
        ("b", 2, "update_postimage"): 1, ("c", 1, "insert"): 1,
    }


def test_enrich_stream(spark, lake):
    log, silver, out = f"{lake}/log", f"{lake}/silver", f"{lake}/out"
    dims = {"now": spark.createDataFrame([("1", "red")], "id string, color string")}

    def run():
        spec = UpsertSpec(prepare, ["k"], buckets=2, changes_to=f"{lake}/applied")
        upsert_stream(changelog.stream_log(spark, log), silver, spec, f"{lake}/cp1")
        enrich_stream(
            changelog.stream_log(spark, f"{lake}/applied").withColumn("fk", F.col("v").cast("string")),
            lambda: dims["now"], "fk", "id", ["color"], "missing", out, ["k"], f"{lake}/cp2", buckets=2,
        )
        return rows(read_cleaned(spark, out), "k", "v", "color", "missing")

    commit(spark, log, 1, [("a", 1, "insert"), ("b", 2, "insert")])
    assert run() == {("a", 1, "red", False): 1, ("b", 2, None, True): 1}
    # The dimension grows: new changes see it, rows processed before do not.
    dims["now"] = spark.createDataFrame([("1", "red"), ("2", "blue")], "id string, color string")
    commit(spark, log, 2, [("a", 2, "update_postimage")])
    assert run() == {("a", 2, "blue", False): 1, ("b", 2, None, True): 1}
    assert run() == {("a", 2, "blue", False): 1, ("b", 2, None, True): 1}


def test_append_new(spark, lake):
    path = f"{lake}/t"
    append_new(spark.createDataFrame([("a", 1)], SCHEMA), path, ["k"], "r1")
    append_new(spark.createDataFrame([("a", 9), ("b", 2)], SCHEMA), path, ["k"], "r2")
    assert rows(changelog.read_log(spark, path), "k", "v") == {("a", 1): 1, ("b", 2): 1}


def test_merge_history_writes_changed_buckets_only(spark, lake):
    path = f"{lake}/history"

    def snapshot(data, day):
        df = spark.createDataFrame([(*d, T + dt.timedelta(days=day)) for d in data],
                                   "id string, spec string, _ingest_ts timestamp")
        return open_versions(df)

    first = [(f"p{i}", "s") for i in range(40)]
    merge_history(snapshot(first, 0), path, "id", ["spec"], 8)
    before = live_buckets(spark, path)
    merge_history(snapshot(first, 1), path, "id", ["spec"], 8)
    assert live_buckets(spark, path) == before
    merge_history(snapshot([("p0", "other"), *first[1:]], 2), path, "id", ["spec"], 8)
    after = live_buckets(spark, path)
    assert sum(after[b] != before[b] for b in after) == 1
    history = read_bucketed(spark, path)
    assert history.count() == 41 and history.filter("is_current").count() == 40


def test_stream_static_join_equals_batch(spark, lake):
    """The same enrichment function over a stream and over the table."""
    data = spark.createDataFrame([("a", "1"), ("b", "2"), ("c", None)], "k string, fk string")
    data.write.parquet(f"{lake}/facts")
    dim = spark.createDataFrame([("1", "red")], "id string, color string")
    stream = spark.readStream.schema(data.schema).parquet(f"{lake}/facts")
    query = (
        left_enrich(stream, dim, "fk", "id", ["color"], "missing")
        .writeStream.format("parquet").option("checkpointLocation", f"{lake}/cp")
        .trigger(availableNow=True).start(f"{lake}/out")
    )
    query.awaitTermination()
    same(spark.read.parquet(f"{lake}/out"), left_enrich(data, dim, "fk", "id", ["color"], "missing"))
