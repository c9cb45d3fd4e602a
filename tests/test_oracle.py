"""Every registered query against its SQL, on the smallest tables."""

import sys

import pytest

import __spark_entry__ as registered
import subtide
from tests.oracle_check import database, duckdb_rows, kinds, spark_rows

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return database(SF_DIR)


def test_every_query_has_its_sql():
    assert set(registered.QUERIES) <= set(registered.oracle_sql())
    assert set(registered.oracle_sql()) <= set(registered.queries())


@pytest.mark.parametrize("missing", ["subtide.llm", "corpus_pipeline"])
def test_queries_without_the_text_operators(monkeypatch, missing):
    """A module that is there but cannot be imported costs its own queries only."""
    for name in [m for m in sys.modules if m == missing or m.startswith(missing + ".")]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, missing, None)
    monkeypatch.delattr(subtide, "llm", raising=False)
    assert set(registered.QUERIES) <= set(registered.queries())
    assert "pipeline" not in registered.queries()
    assert set(registered.oracle_sql()) <= set(registered.queries())


@pytest.mark.parametrize("name", sorted(registered.QUERIES))
def test_query(spark, con, name):
    df = registered.queries()[name](spark, SF_DIR)
    sql = registered.oracle_sql()[name]
    assert spark_rows(df) == duckdb_rows(con, sql)
    assert kinds(df, con, sql) == {}


def test_entry(spark):
    assert registered.entry(spark).count() > 0
