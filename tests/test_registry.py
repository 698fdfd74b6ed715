"""Every registered query against its SQL on the smallest tables, and plan rules."""

import pathlib

import pytest

import __spark_entry__ as entry_points
from medstrata import registry
from tests.helpers import plan
from tools.check import compare, connect

FOLDER = "/root/testdata/sf0.001"
registry.load_all()
QUERIES = registry.QUERIES
ORACLES = registry.ORACLES

needs_tables = pytest.mark.skipif(not pathlib.Path(FOLDER).exists(), reason="tables not present")

# Queries whose result comes from a written table, so their plan is only a scan.
MATERIALIZED = {n for n in QUERIES if n.startswith(("ingest_", "stream_"))} - {"ingest_row_log"}
MATERIALIZED |= {"copy_into_jsonl", "quarantine_split", "schema_evolve_append", "change_feed_read",
                 "validation_results"}


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)


@needs_tables
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    difference, count, _ = compare(spark, con, FOLDER, name, ORACLES[name])
    assert difference is None, difference
    assert count > 0


@needs_tables
@pytest.mark.parametrize("name", sorted(set(QUERIES) - MATERIALIZED))
def test_plans_stay_in_the_engine(spark, name):
    text = plan(QUERIES[name](spark, FOLDER))
    for operator in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin", "RDD"):
        assert operator not in text, operator


@needs_tables
def test_flagship_has_rows(spark):
    assert entry_points.entry(spark).count() > 0


@needs_tables
def test_scans_read_only_needed_columns(spark):
    text = plan(QUERIES["patient_lifecycle"](spark, FOLDER))
    assert "o_orderpriority" in text and "o_totalprice" in text
    text = plan(QUERIES["dash_top_providers"](spark, FOLDER))
    assert "l_linestatus" not in text and "c_name" not in text
