"""Every query of the core against its SQL in DuckDB, on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from tallyspan import oracles

FOLDER = "/root/testdata/sf0.001"
TABLES = [name.removesuffix(".parquet") for name in os.listdir(FOLDER)] if os.path.isdir(FOLDER) else []

pytestmark = pytest.mark.skipif(not TABLES, reason="needs the driver's tables")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


SQL = oracles.oracle_sql(entry.PARTS, entry.K, entry.K_EVEN, entry.K_ODD, entry.CHUNK, entry.FAN)
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE"}


def ordered(columns, rows):
    at = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(repr([row[i] for i in at]) for row in rows)


@pytest.mark.parametrize("name", list(SQL))
def test_query(spark, duck, name):
    found = entry.queries()[name](spark, FOLDER)
    expected = duck.execute(SQL[name])
    names = [column[0] for column in expected.description]
    types = {column[0]: str(column[1]) for column in expected.description}
    assert {name: TYPES[kind] for name, kind in found.dtypes} == types
    assert ordered(found.columns, found.collect()) == ordered(names, expected.fetchall())


def test_entry(spark):
    assert len(entry.entry(spark).collect()) == entry.K_EVEN
