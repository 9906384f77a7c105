"""Every registered query against its SQL twin on the smallest tables, or against a named test of its own."""

import re
from pathlib import Path

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.oracle import compare, connect

FOLDER = "/root/testdata/sf0.001"
TESTS = Path(__file__).parent

pytestmark = pytest.mark.skipif(not Path(FOLDER).is_dir(), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_sql(spark, con, name):
    assert compare(spark, con, FOLDER, name, queries()[name], oracle_sql()[name]) == ""


def test_sql_belongs_to_queries():
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(set(queries()) - set(oracle_sql())))
def test_query_without_sql_has_a_test(name):
    """A query that SQL can't express is held against brute force by ``test_query_<name>``."""
    assert any(re.search(rf"def test_query_{name}\b", f.read_text()) for f in TESTS.rglob("test_*.py"))


def test_entry(spark):
    df = entry(spark)
    assert df.columns[:2] == ["rank", "dedup_key"] and df.count() > 0
