"""Every query with an SQL oracle must equal it, on the smallest tables."""

import pytest
from check_oracles import compare, connect

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_oracle(spark, con, name):
    assert compare(spark, con, FOLDER, entry.queries()[name], entry.oracle_sql()[name]) == ""


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).columns == ["segment", "n", "pct"]
