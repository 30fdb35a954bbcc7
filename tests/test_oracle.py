"""Every registered query with SQL, whole result against DuckDB."""

import os

import __spark_entry__ as entry
import pytest
from oracle import compare, connect

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_same_rows(spark, con, name):
    assert compare(spark, con, entry.queries()[name], entry.oracle_sql()[name], SF) == ""


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0
