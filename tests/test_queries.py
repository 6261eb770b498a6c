"""Every query against its reference SQL, values and types."""

import pytest

import __spark_entry__ as entry
from shelfwise.catalog.oracles import ORACLES
from shelfwise.catalog.queries import QUERIES
from tests.support import connect, duckdb_answer, spark_answer

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_a_reference():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query(spark, con, key):
    names, kinds, rows = spark_answer(QUERIES[key](spark, SF_DIR))
    expected_names, expected_kinds, expected_rows = duckdb_answer(con, ORACLES[key])
    assert names == expected_names
    assert kinds == expected_kinds
    assert rows == expected_rows


def test_entry(spark):
    assert not entry.entry(spark).isEmpty()


def test_entry_without_the_optional_part(monkeypatch):
    """A missing module of the training-data part costs its queries, not the others."""
    import sys

    monkeypatch.setitem(sys.modules, "shelfwise.llm", None)
    with pytest.warns(UserWarning, match="left out"):
        assert set(entry.queries()) == set(QUERIES)
    with pytest.warns(UserWarning, match="left out"):
        assert set(entry.oracle_sql()) == set(ORACLES)
