"""Leases of writers, positions in logs, pending rows, streams beside bounded runs."""

import datetime as dt
import os
import pathlib
import re
import threading
import time

import pytest
from pyspark.sql import functions as F

from medstrata.config import PipelineConfig
from medstrata.operators.upsert import upsert_latest
from medstrata.plans.ingest_specs import specs
from medstrata.plans.medallion import Medallion
from medstrata.sources import changelog, leases
from medstrata.sources.tables import live_buckets, merge_bucketed, publish, read_table, replace_content
from medstrata.streaming.upserts import append_new, enrich_pending, enrich_stream, read_cleaned
from tests.helpers import plan, rows
from tests.test_medallion import first_files, second_files, write_encounters

T = dt.datetime(2025, 1, 1)


def left_behind(folder, number, seconds):
    """The mark of a holder that died so many seconds ago."""
    pathlib.Path(folder).mkdir(parents=True, exist_ok=True)
    mark = pathlib.Path(f"{folder}/mark-{number}")
    mark.touch()
    os.utime(mark, (time.time() - seconds,) * 2)


def test_marks_of_lost_holders_are_taken_over(spark, lake):
    folder = f"{lake}/lease"
    left_behind(folder, 3, 30)
    assert leases.is_held(spark, folder)
    with pytest.raises(RuntimeError):
        leases.acquire(spark, folder)
    left_behind(folder, 3, leases.LEASE + 5)
    assert not leases.is_held(spark, folder)
    with leases.held(spark, folder) as mine:
        assert mine.number == 4 and not mine.lost() and leases.is_held(spark, folder)
    assert not leases.is_held(spark, folder) and list(pathlib.Path(folder).glob("mark-*")) == []
    path = f"{lake}/t"
    left_behind(f"{path}/_writers", 1, leases.LEASE + 5)
    publish(spark.range(3), path)
    left_behind(f"{path}/_writers", 1, 1)
    with pytest.raises(RuntimeError):
        merge_bucketed(spark.createDataFrame([("a", 1)], "k string, v int"), path, ["k"], 2, upsert_latest)


def test_one_of_many_gets_it(spark, lake):
    for stale in (False, True):
        folder = f"{lake}/lease{stale}"
        if stale:
            left_behind(folder, 7, 999)
        got, start = [], threading.Barrier(8)

        def take(folder=folder, got=got, start=start):
            start.wait()
            try:
                got.append(leases.acquire(spark, folder))
            except RuntimeError:
                pass

        threads = [threading.Thread(target=take) for _ in range(8)]
        for t in threads:
            t.start()
        for t in threads:
            t.join()
        assert len(got) == 1
        got[0].release()


def test_a_holder_renews_its_mark(spark, lake):
    folder = f"{lake}/lease"
    with leases.held(spark, folder, lease=2.0):
        time.sleep(5)
        assert leases.is_held(spark, folder, lease=2.0)
        with pytest.raises(RuntimeError):
            leases.acquire(spark, folder, lease=2.0)


def test_a_holder_that_comes_back_late_does_not_end_the_next_lease(spark, lake):
    folder = f"{lake}/lease"
    first = leases.acquire(spark, folder)
    left_behind(folder, first.number, 999)
    second = leases.acquire(spark, folder)
    assert first.lost() and not second.lost()
    with pytest.raises(RuntimeError):
        first.release()
    assert leases.is_held(spark, folder)
    second.release()


def test_a_second_writer_waits(spark, lake):
    path, mine = f"{lake}/t", leases.acquire(spark, f"{lake}/t/_writers")
    threading.Timer(2, mine.release).start()
    assert publish(spark.range(1), path, wait=60) == 0
    with pytest.raises(ZeroDivisionError):
        replace_content(spark, path, lambda _: 1 / 0)
    replace_content(spark, path, lambda now: now.union(spark.range(5, 6)))
    assert rows(read_table(spark, path)) == {(0,): 1, (5,): 1}


def test_positions(spark, lake):
    log = f"{lake}/log"
    position = changelog.Position(spark, log, f"{lake}/position")
    changelog.create(changelog.as_inserts(spark.range(1)), log)
    assert position.unread() == (None, 0)
    for i in (1, 2):
        changelog.append_commit(changelog.as_inserts(spark.range(i, i + 1)), log, f"r{i}")
    unread, newest = position.unread()
    assert rows(unread, "id") == {(1,): 1, (2,): 1} and newest == 2
    position.advance(newest)
    assert position.unread() == (None, 2)
    changelog.append_commit(changelog.as_inserts(spark.range(3, 4)), log, "r3")
    changelog.append_commit(changelog.as_inserts(spark.range(4, 5)), log, "r4")
    os.remove(f"{log}/_commit_version=3/_run_id=r3/_SUCCESS")  # its writer is not done: nothing after it counts
    assert position.unread() == (None, 2)
    changelog.append_commit(changelog.as_inserts(spark.range(3, 4)), log, "r3")
    unread, newest = position.unread()
    assert rows(unread, "id") == {(3,): 1, (4,): 1} and newest == 4
    filters = re.search(r"PartitionFilters: \[(.*?)\]", plan(unread))[1]  # folders of old commits are not read
    assert re.search(r"_commit_version#\d+L? >= 3", filters) and re.search(r"_commit_version#\d+L? <= 4", filters)


def test_a_repeated_insert_loses_nothing(spark, lake):
    path = f"{lake}/t"
    some = spark.createDataFrame([("a", 1), ("b", 1)], "k string, v int")
    append_new(some, path, ["k"], "after-0")
    append_new(some, path, ["k"], "after-0")  # the position was not noted: the run is repeated
    append_new(spark.createDataFrame([("b", 9), ("c", 2)], "k string, v int"), path, ["k"], "after-1")
    assert rows(changelog.read_log(spark, path), "k", "v") == {("a", 1): 1, ("b", 1): 1, ("c", 2): 1}


FACT = "k string, fk string, _change_type string, _commit_timestamp timestamp"


def test_pending_rows(spark, lake):
    log, out, pending = f"{lake}/log", f"{lake}/out", f"{lake}/pending"
    dims = {"1": "red"}
    asked = []

    def table(ids=None):
        if ids is not None:
            asked.append(sorted(r[0] for r in ids.collect()))
        return spark.createDataFrame(list(dims.items()), "id string, color string")

    def run(version, data):
        changelog.write_commit(spark.createDataFrame([(*d, "insert", T) for d in data], FACT), log, version)
        enrich_stream(
            changelog.stream_log(spark, log), table, "fk", "id", ["color"], "missing", out, ["k"], f"{lake}/cp",
            buckets=16, pending=pending,
        )

    def refresh():
        enrich_pending(spark, pending, table, "fk", "id", ["color"], "missing", out, ["k"], 16)

    run(1, [(f"k{i}", "1") for i in range(40)] + [("late", "2"), ("never", "9"), ("moved", "3")])
    assert rows(read_table(spark, pending), "k") == {("late",): 1, ("never",): 1, ("moved",): 1}
    run(2, [("moved", "1")])  # waits no longer
    assert rows(read_table(spark, pending), "k") == {("late",): 1, ("never",): 1}
    before = live_buckets(spark, out)
    refresh()
    assert live_buckets(spark, out) == before  # nothing has arrived
    dims["2"] = "blue"
    refresh()
    after = live_buckets(spark, out)
    assert sum(after[b] != before[b] for b in after) == 1 and asked[-1] == ["2", "9"]
    found = rows(read_cleaned(spark, out).filter("k NOT LIKE 'k%'"), "k", "color", "missing")
    assert found == {("late", "blue", False): 1, ("never", None, True): 1, ("moved", "red", False): 1}
    assert rows(read_table(spark, pending), "k") == {("never",): 1}


def test_incremental_runs_and_a_stream_beside_them(spark, lake, monkeypatch):
    monkeypatch.setattr("medstrata.streaming.runs.STREAM_INTERVAL", "1 second")
    medallion = Medallion(spark, PipelineConfig(root=lake, default_buckets=2), specs(encounter_format="parquet"))
    first_files(lake)
    for dataset in ("patients", "providers", "feedback"):
        medallion.ingest(dataset)
    medallion.upsert("patients")
    queries = medallion.stream_encounters()
    try:
        assert medallion.run(T, as_of=dt.date(2025, 4, 1)) == 0
        second_files(lake)
        write_encounters(f"{lake}/source/encounters", "c", [("e9", "2025-01-09", "p1", "7", "visit", None, None)])
        medallion.run(T + dt.timedelta(hours=1), as_of=dt.date(2025, 4, 1))
        for _ in range(3):
            for query in queries:
                query.processAllAvailable()
    finally:
        for query in queries:
            query.stop()
    # Each file was loaded once, by the stream.
    assert medallion.load("bronze_encounters").groupBy("_source_file").count().count() == 3
    assert rows(medallion.load("bronze_encounters"), "ID")[("e9",)] == 1
    assert rows(medallion.load("silver_encounters_enriched"), "encounter_id") == {(e,): 1 for e in ("e1", "e2", "e3", "e9")}
    folder = medallion._streaming
    for _ in range(60):
        if not leases.is_held(spark, folder):
            break
        time.sleep(0.5)
    assert medallion.run(T + dt.timedelta(hours=2), as_of=dt.date(2025, 4, 1)) == 1
    assert medallion.load("silver_encounters_enriched").filter(F.col("patient_missing")).count() == 0


def test_history_and_inserts_read_new_commits_only(spark, lake, monkeypatch):
    medallion = Medallion(spark, PipelineConfig(root=lake, default_buckets=2), specs(encounter_format="parquet"))
    read = []
    real = changelog.read_log
    monkeypatch.setattr(changelog, "read_log", lambda s, path, first=0: read.append((path.rsplit("/", 2)[-2:], first)) or real(s, path, first))
    for step, put in enumerate((first_files, second_files)):
        put(lake)
        for dataset in ("providers", "feedback"):
            medallion.ingest(dataset)
        read.clear()
        medallion.merge_providers()
        medallion.insert_feedback()
        starts = {first for path, first in read if "bronze" in "/".join(path)}
        assert starts == {step + 1}
        read.clear()
        medallion.merge_providers()
        medallion.insert_feedback()
        assert read == []  # nothing new: no log is read
    monkeypatch.undo()
    assert rows(medallion.load("silver_providers"), "provider_id", "provider_specialty", "is_current") == {
        ("d1", "Cardiology", False): 1, ("d1", "Neurology", True): 1, ("d2", "Surgery", True): 1,
    }
    assert rows(medallion.load("silver_feedback"), "feedback_id", "satisfaction_score") == {("f1", 5): 1, ("f2", 3): 1, ("f3", 4): 1}
