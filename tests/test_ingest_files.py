"""Files as they come: compressed, oddly named, with odd headers, or broken."""

import gzip
import pathlib

import pytest
from pyspark.sql import functions as F

from medstrata.config import PipelineConfig
from medstrata.plans.ingest_specs import specs, text_schema
from medstrata.sources import changelog, files, lines
from medstrata.streaming.ingest import IngestSpec, ingest
from tests.helpers import rows

ODD_NAMES = ["with space", "100%", "a%20b", "a+b", "a#b", "[x]", "{y,z}", "what?", "st*r", "ünï", "a=b"]
SPEC = IngestSpec("csv", ["ID"], schema=text_schema(["ID", "NAME"]))


@pytest.fixture
def paths(lake):
    paths = PipelineConfig(root=lake).paths("bronze", "things")
    pathlib.Path(paths.raw).mkdir(parents=True)
    return paths


def put(paths, name, content):
    content = content.encode() if isinstance(content, str) else content
    pathlib.Path(f"{paths.raw}/{name}").write_bytes(gzip.compress(content) if name.endswith(".gz") else content)


def loaded(spark, paths, *columns):
    return rows(changelog.read_log(spark, paths.table), *columns)


def set_aside(spark, paths, *columns):
    return rows(changelog.read_log(spark, paths.quarantine), *columns)


def test_compressed_and_oddly_named_text(spark, paths):
    put(paths, "x.csv.gz", "ID,NAME\n1,one\n2,two\n")
    for i, name in enumerate(ODD_NAMES):
        put(paths, f"{name}.csv", f"ID,NAME\nn{i},x\n")
    ingest(spark, SPEC, paths)
    assert loaded(spark, paths, "ID") == {(i,): 1 for i in ("1", "2", *(f"n{i}" for i in range(len(ODD_NAMES))))}
    assert not files.folders.exists(spark, paths.quarantine)


def test_blank_first_lines_marks_and_line_ends(spark, paths):
    put(paths, "blank.csv", "\n \t\nNAME,ID\nann,b1\n\n")
    put(paths, "mark.csv", "﻿ID,NAME\nm1,bo\n".encode())
    put(paths, "windows.csv", "ID,NAME\r\nw1,cy\r\n\r\n")
    put(paths, "quoted.csv", '"ID","NAME"\nq1,"Town, GU"\n')
    put(paths, "empty.csv", "")
    put(paths, "header.csv", "ID,NAME\n")
    ingest(spark, SPEC, paths)
    assert loaded(spark, paths, "ID", "NAME") == {("b1", "ann"): 1, ("m1", "bo"): 1, ("w1", "cy"): 1, ("q1", "Town, GU"): 1}


def test_a_number_never_ends_in_another_column(spark, paths):
    put(paths, "a.csv", "\nSSN,ID\n123-45,p1\n")
    ingest(spark, specs()["patients"], paths)
    assert loaded(spark, paths, "ID", "SSN") == {("p1", "123-45"): 1}


def test_files_without_a_known_header_are_set_aside_whole(spark, paths):
    put(paths, "good.csv", "ID,NAME\n1,one\n")
    put(paths, "bare.csv", "7,seven\n8,eight\n")
    put(paths, "noise.csv", bytes(range(256)) * 3)
    ingest(spark, SPEC, paths)
    got = changelog.read_log(spark, paths.table)
    assert rows(got, "ID", "NAME") == {("1", "one"): 1}
    assert set(got.columns) == {"ID", "NAME", "_ingest_ts", "_source_file", "_batch_id", "_change_type", "_commit_timestamp", "_commit_version"}
    found = changelog.read_log(spark, paths.quarantine)
    assert rows(found.filter("_source_file LIKE '%bare.csv'"), files.CORRUPT) == {("7,seven",): 1, ("8,eight",): 1}
    assert not found.filter("_source_file LIKE '%noise.csv'").isEmpty()


def test_headers_differ_and_columns_grow(spark, paths):
    put(paths, "a.csv", "ID,NAME\n1,one\n")
    put(paths, "b.csv", "NAME,MORE,ID\ntwo,x,2\nshort,3\n")
    ingest(spark, SPEC, paths)
    put(paths, "c.csv", "ID\n4\n")
    ingest(spark, SPEC, paths)
    assert loaded(spark, paths, "ID", "NAME", "MORE") == {("1", "one", None): 1, ("2", "two", "x"): 1, ("4", None, None): 1}
    assert set_aside(spark, paths, files.CORRUPT) == {("short,3",): 1}
    assert lines.column_names("ID,,ID,\x00", ",") is None
    assert lines.column_names(" ID ,,ID", ",") == ("ID", "column_2", "ID_3")


def test_one_header_for_a_file_in_many_splits(spark, paths):
    put(paths, "big.csv", "NAME,ID\n" + "".join(f"name {i},{i}\n" for i in range(4000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        ingest(spark, SPEC, paths)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert loaded(spark, paths, "ID", "NAME") == {(str(i), f"name {i}"): 1 for i in range(4000)}


def test_headers_without_a_schema(spark, paths):
    put(paths, "a.tsv", "k\tv\n1\tx\n")
    put(paths, "b.tsv", "v\tk\tw\ny\t2\tz\n")
    ingest(spark, IngestSpec("tsv", ["k"]), paths)
    assert loaded(spark, paths, "k", "v", "w") == {("1", "x", None): 1, ("2", "y", "z"): 1}


def write_parquet(spark, paths, name, first, count=50):
    import pyarrow as pa
    import pyarrow.parquet as pq

    table = pa.table({"id": list(range(first, first + count)), "text": [f"row {i} " * 20 for i in range(count)]})
    pq.write_table(table, f"{paths.raw}/{name}.parquet", compression="none", use_dictionary=False)
    return pathlib.Path(f"{paths.raw}/{name}.parquet")


def test_broken_parquet_files_are_listed_and_the_rest_loads(spark, paths):
    spec = IngestSpec("parquet", ["id"])
    for i in range(5):
        write_parquet(spark, paths, f"good {i}%", 100 * i)
    cut = write_parquet(spark, paths, "cut", 1000)
    cut.write_bytes(cut.read_bytes()[:-40])  # no footer
    hurt = write_parquet(spark, paths, "hurt", 2000)
    data = bytearray(hurt.read_bytes())
    data[4:120] = b"\xff" * 116  # the footer is whole, a page is not
    hurt.write_bytes(data)
    (pathlib.Path(paths.raw) / "noise.parquet").write_bytes(b"not a table")
    ingest(spark, spec, paths)
    assert loaded(spark, paths, "id") == {(100 * i + j,): 1 for i in range(5) for j in range(50)}
    bad = changelog.read_log(spark, paths.quarantine)
    assert sorted(pathlib.Path(r[files.BAD_FILE]).name for r in bad.collect()) == ["cut.parquet", "hurt.parquet", "noise.parquet"]
    assert all(r[files.ERROR] for r in bad.collect())
    # The stream goes on, and a mended file loads under another name.
    write_parquet(spark, paths, "cut-again", 1000)
    ingest(spark, spec, paths)
    assert changelog.read_log(spark, paths.table).count() == 300


def test_odd_names_of_parquet_files(spark, paths):
    for i, name in enumerate(ODD_NAMES):
        write_parquet(spark, paths, name, 10 * i, 1)
    ingest(spark, IngestSpec("parquet", ["id"]), paths)
    assert loaded(spark, paths, "id") == {(10 * i,): 1 for i in range(len(ODD_NAMES))}


def test_a_file_that_ends_too_early(spark, paths):
    put(paths, "a.csv", "ID,NAME\n1,one\n")
    put(paths, "b.csv.gz", "ID,NAME\n" + "".join(f"{i},x{i * 7919}\n" for i in range(5000)))
    whole = pathlib.Path(f"{paths.raw}/b.csv.gz")
    whole.write_bytes(whole.read_bytes()[:9000])
    ingest(spark, SPEC, paths)
    assert loaded(spark, paths, "ID") == {("1",): 1}
    assert [r[0].endswith("b.csv.gz") for r in set_aside(spark, paths, files.BAD_FILE)] == [True]


def test_other_failures_stop_the_stream():
    def read(paths):
        raise RuntimeError("no rights")

    with pytest.raises(RuntimeError):
        files.split_readable(["a", "b"], read)

    def some(paths):
        if "bad" in paths:
            raise RuntimeError("[FAILED_READ_FILE.NO_HINT] Encountered error while reading file bad")

    assert files.split_readable(["a", "bad", "c", "d"], some)[0] == ["a", "c", "d"]
    assert list(files.split_readable(["a", "bad"], some)[1]) == ["bad"]
    assert files.split_readable([], read) == ([], {})
    assert not files.unreadable(RuntimeError("[FAILED_READ_FILE.FILE_NOT_EXIST] gone"))


def test_empty_and_partitioned_folders(spark, paths):
    spec = IngestSpec("parquet", ["id"])
    spark.range(3).withColumn("day", F.col("id") % 2).write.mode("overwrite").partitionBy("day").parquet(paths.raw)
    ingest(spark, spec, paths)
    ingest(spark, spec, paths)
    assert loaded(spark, paths, "id", "day") == {(0, 0): 1, (1, 1): 1, (2, 0): 1}
