"""File ingest: formats, quarantine, rescue, reruns, growing schemas, repeated batches."""

import json
import os
import pathlib

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StringType, StructField, StructType

from medstrata.config import BATCH_ID_KEY, PipelineConfig
from medstrata.operators.clean import with_audit
from medstrata.plans.ingest_specs import specs, text_schema
from medstrata.sources import changelog, files
from medstrata.streaming.ingest import IngestSpec, file_stream, ingest
from medstrata.streaming.runs import trigger_of
from tests.helpers import rows


@pytest.fixture
def paths(lake):
    return PipelineConfig(root=lake).paths("bronze", "things")


def put(folder, name, text):
    pathlib.Path(folder).mkdir(parents=True, exist_ok=True)
    pathlib.Path(f"{folder}/{name}").write_text(text)


def log(spark, paths):
    return changelog.read_log(spark, paths.table)


def test_csv_quotes_empty_lines_and_keys(spark, paths):
    put(paths.raw, "a.csv", 'ID,NAME\n1,"Town, GU"\n\n,"no key"\n2,\n')
    ingest(spark, IngestSpec("csv", ["ID"], schema=text_schema(["ID", "NAME"])), paths)
    assert rows(log(spark, paths), "ID", "NAME") == {("1", "Town, GU"): 1, ("2", None): 1}


def test_rerun_loads_new_files_only(spark, paths):
    spec = IngestSpec("csv", ["ID"], schema=text_schema(["ID"]))
    put(paths.raw, "a.csv", "ID\n1\n")
    ingest(spark, spec, paths)
    ingest(spark, spec, paths)
    assert log(spark, paths).count() == 1
    put(paths.raw, "b.csv", "ID\n2\n")
    ingest(spark, spec, paths)
    got = log(spark, paths)
    assert rows(got, "ID", "_commit_version", "_change_type") == {
        ("1", 1, "insert"): 1, ("2", 2, "insert"): 1,
    }
    assert {r[0].rsplit("/", 1)[1] for r in got.select("_source_file").collect()} == {"a.csv", "b.csv"}


def test_backlog_is_worked_off_in_bounded_batches(spark, paths):
    for i in range(5):
        put(paths.raw, f"{i}.csv", f"ID\n{i}\n")
    ingest(spark, IngestSpec("csv", ["ID"], schema=text_schema(["ID"]), max_files=2), paths)
    got = log(spark, paths)
    assert got.count() == 5
    assert sorted(r[0] for r in got.select("_commit_version").distinct().collect()) == [1, 2, 3]


def test_malformed_json_is_set_aside(spark, paths):
    put(paths.raw, "a.json", '{"id": "1", "n": {"a": 1}}\n{"id": "2", \nnot json\n{"id": null}\n{"id": "3"}\n')
    ingest(spark, IngestSpec("json", ["id"], schema=text_schema(["id", "n"])), paths)
    assert rows(log(spark, paths), "id", "n") == {("1", '{"a": 1}'): 1, ("3", None): 1}
    bad = changelog.read_log(spark, paths.quarantine)
    assert rows(bad, files.CORRUPT) == {('{"id": "2", ',): 1, ("not json",): 1}
    assert bad.first()._source_file.endswith("a.json")


def test_malformed_csv_is_set_aside(spark, paths):
    put(paths.raw, "a.csv", "ID,N\n1,x\n2,y,z\n3\n")
    ingest(spark, IngestSpec("csv", ["ID"], schema=text_schema(["ID", "N"])), paths)
    assert rows(log(spark, paths), "ID", "N") == {("1", "x"): 1}
    assert rows(changelog.read_log(spark, paths.quarantine), files.CORRUPT) == {("2,y,z",): 1, ("3",): 1}


def test_rescue(spark):
    raw = spark.createDataFrame(
        [("1", "2.5", "x"), ("b", "zwei", None), (None, None, None)], "id string, v string, extra string"
    )
    schema = StructType([StructField("id", IntegerType()), StructField("v", DoubleType()),
                         StructField("later", StringType())])
    got = files.rescue(raw, schema).collect()
    assert [(r.id, r.v, r.later) for r in got] == [(1, 2.5, None), (None, None, None), (None, None, None)]
    kept = [r._rescued_data and json.loads(r._rescued_data) for r in got]
    assert kept == [{"extra": "x"}, {"id": "b", "v": "zwei"}, None]


def test_providers_tsv(spark, paths):
    put(paths.raw, "a.tsv", "ProviderID\tProviderSpecialty\tProviderLocation\nd1\tHeart, lung\tRome\n")
    ingest(spark, specs()["providers"], paths)
    got = log(spark, paths)
    assert rows(got, "ProviderID", "ProviderSpecialty", "_rescued_data") == {("d1", "Heart, lung", None): 1}


def test_feedback_json_projection(spark, paths):
    good = {"feedback_id": "f", "satisfaction_score": "bad", "tags": ["a", "b"], "surprise": 1,
            "metadata": {"a": {"b": 2}, "c": "d"}}
    put(paths.raw, "a.json", json.dumps(good) + "\n")
    ingest(spark, specs()["feedback"], paths)
    row = log(spark, paths).first()
    assert row.satisfaction_score is None and row.tags == ["a", "b"]
    assert row.metadata_json == '{"a":{"b":2},"c":"d"}'
    assert "surprise" not in row.asDict()


def test_new_columns_extend_the_table(spark, paths):
    spec = IngestSpec("parquet", ["id"])
    spark.range(2).write.parquet(paths.raw)
    ingest(spark, spec, paths)
    spark.range(2, 3).withColumn("extra", F.lit("x")).write.mode("append").parquet(paths.raw)
    ingest(spark, spec, paths)
    assert rows(log(spark, paths), "id", "extra") == {(0, None): 1, (1, None): 1, (2, "x"): 1}
    stored = files.folders.read_text(spark, f"{paths.schema}/schema.json")
    assert StructType.fromJson(json.loads(stored)).names == ["id", "extra"]
    old, new = spark.range(1).toDF("id").select("id"), spark.range(1).withColumn("b", F.lit(1))
    assert files.append_evolving(old, new).columns == ["id", "b"]


def test_repeated_batch_replaces_its_commit(spark, lake):
    path = f"{lake}/log"
    one = changelog.as_inserts(spark.range(1))
    assert changelog.append_commit(one, path, "batch-0") == 1
    assert changelog.append_commit(changelog.as_inserts(spark.range(5, 6)), path, "batch-1") == 2
    assert changelog.append_commit(one, path, "batch-0") == 1
    assert changelog.append_commit(one, path, "stream-0") == 3
    assert rows(changelog.read_log(spark, path), "id", "_commit_version") == {(0, 1): 1, (5, 2): 1, (0, 3): 1}
    assert changelog.read_log(spark, path, starting_version=2).count() == 2


def test_modes(spark, paths):
    assert trigger_of("batch") == {"availableNow": True}
    assert trigger_of("stream") == {"processingTime": "30 seconds"}
    assert paths.checkpoint_for("batch") != paths.checkpoint_for("stream")
    with pytest.raises(ValueError):
        trigger_of("hourly")


def test_avro_needs_its_package(spark, paths):
    """The format is passed to Spark as is; without the package Spark says so."""
    put(paths.raw, "a.avro", "x")
    with pytest.raises(AnalysisException, match="(?i)avro"):
        file_stream(spark, specs()["encounters"], paths)
    with pytest.raises(ValueError):
        files.reader_options("xml")


def test_audit_columns(spark, tmp_path):
    spark.range(1).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    row = with_audit(df).first()
    assert row._batch_id == "manual" and row._ingest_ts is not None and "/t/" in row._source_file
    spark.conf.set(BATCH_ID_KEY, "job-7")
    try:
        assert with_audit(df).first()._batch_id == "job-7"
    finally:
        spark.conf.unset(BATCH_ID_KEY)


def test_files_of_any_date_are_loaded(spark, paths):
    spec = IngestSpec("csv", ["ID"], schema=text_schema(["ID"]))
    put(paths.raw, "a.csv", "ID\n1\n")
    ingest(spark, spec, paths)
    put(paths.raw, "old.csv", "ID\n2\n")
    os.utime(f"{paths.raw}/old.csv", (1e9, 1e9))
    ingest(spark, spec, paths)
    assert rows(log(spark, paths), "ID") == {("1",): 1, ("2",): 1}


def test_a_column_that_arrives_while_a_stream_runs(spark, paths):
    spec = IngestSpec("parquet", ["id"])
    spark.createDataFrame([(1,)], "id int").coalesce(1).write.parquet(f"{paths.raw}/one")
    running = ingest(spark, IngestSpec("parquet", ["id"], options={"recursiveFileLookup": "true"}), paths, "stream")
    try:
        running.processAllAvailable()
        spark.createDataFrame([(2, "x")], "id int, more string").coalesce(1).write.parquet(f"{paths.raw}/two")
        running.processAllAvailable()
    finally:
        running.stop()
    assert rows(log(spark, paths), "id", "more") == {(1, None): 1, (2, "x"): 1}


def test_values_follow_the_header(spark, paths):
    spec = specs()["patients"]
    put(paths.raw, "a.csv", "SSN,ID,GENDER\n123-45,p1,F\n")
    put(paths.raw, "b.csv", ",".join(spec.schema.names) + "\np2" + "," * (len(spec.schema.names) - 1) + "\n")
    ingest(spark, spec, paths)
    assert rows(log(spark, paths), "ID", "SSN", "GENDER") == {("p1", "123-45", "F"): 1, ("p2", None, None): 1}


def test_provider_columns_that_do_not_belong_are_rescued(spark, paths):
    put(paths.raw, "a.tsv", "ProviderID\tRegion\tProviderSpecialty\tProviderLocation\nd1\tnorth\tCardiology\tBonn\n")
    put(paths.raw, "b.tsv", "ProviderID\tProviderSpecialty\tProviderLocation\nd2\tSurgery\tUlm\n")
    ingest(spark, specs()["providers"], paths)
    assert rows(log(spark, paths), "ProviderID", "ProviderSpecialty", "ProviderLocation", "_rescued_data") == {
        ("d1", "Cardiology", "Bonn", '{"Region":"north"}'): 1, ("d2", "Surgery", "Ulm", None): 1,
    }
