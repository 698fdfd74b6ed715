"""The registered queries: names, and rows of those that SQL can express."""

import pathlib
import re

import pytest

import __spark_entry__ as entry_points
from medstrata.llm.queries import ORACLES, QUERIES
from tests.helpers import plan
from tools.check import connect

FOLDER = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not pathlib.Path(FOLDER).exists(), reason="tables not present")


def test_every_operator_has_its_query():
    numbers = [int(m[1]) for n in QUERIES if (m := re.match(r"op(\d+)_", n))]
    assert sorted(numbers) == list(range(1, 14)) and "pipeline" in QUERIES
    assert set(QUERIES) <= set(entry_points.queries()) and set(ORACLES) <= set(entry_points.oracle_sql())


@needs_tables
@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    ours = QUERIES[name](spark, FOLDER)
    theirs = connect(FOLDER).execute(ORACLES[name])
    names = [c[0] for c in theirs.description]
    assert sorted(ours.columns) == sorted(names)
    assert sorted(map(tuple, ours.select(*names).collect()), key=repr) == sorted(theirs.fetchall(), key=repr)


@needs_tables
def test_mixing_stays_native(spark):
    assert not re.search("Python|Pandas|Arrow", plan(QUERIES["op10_source_mix"](spark, FOLDER)))
