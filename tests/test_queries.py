"""Every registered query against its SQL on the given tables."""

import os

import pytest

import __spark_entry__
import oracle

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES = __spark_entry__.queries()
SQL = __spark_entry__.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return oracle.connect(FOLDER)


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_agrees_with_sql(spark, duck, name):
    assert oracle.compare(QUERIES[name](spark, FOLDER), duck, SQL[name]) == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs_without_sql(spark, name):
    df = QUERIES[name](spark, FOLDER)
    assert df.count() > 0


def test_entry(spark):
    assert __spark_entry__.entry(spark).columns == ["doc_id", "text", "source", "n_chars", "label"]
