"""Registered queries against their SQL counterparts on whole tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry_points
from markfield.plans import catalog, oracle

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()
SQL = oracle.statements()

pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


@pytest.fixture(scope="module")
def engine():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{DATA}/{name}.parquet'")
    return connection


def ordered(rows):
    return sorted(rows, key=lambda row: tuple((value is not None, str(value)) for value in row))


def test_every_query_has_sql():
    assert set(catalog.REGISTRY) == set(oracle.statements())
    assert set(SQL) <= set(entry_points.queries())


@pytest.mark.parametrize("name", sorted(SQL))
def test_query(spark, engine, name):
    got = entry_points.queries()[name](spark, DATA)
    result = engine.execute(SQL[name])
    columns = [part[0] for part in result.description]
    assert sorted(columns) == sorted(got.columns)
    want = ordered(tuple(row) for row in result.fetchall())
    assert ordered(tuple(row) for row in got.select(*columns).collect()) == want


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0
