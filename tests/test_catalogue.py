"""Every query against its SQL on the driver's tables."""

from collections import Counter

import duckdb
import pytest

import __spark_entry__ as contract
from conftest import plan
from harborlake.catalogue import ORACLES, QUERIES

TABLES = """region nation customer supplier part orders lineitem events documents embeddings pages
benchmark labels conversations""".split()
DUCKDB_TYPES = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "string": "VARCHAR",
    "double": "DOUBLE",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
    "boolean": "BOOLEAN",
}


@pytest.fixture(scope="module")
def oracle(testdata):
    connection = duckdb.connect()
    for name in TABLES:
        connection.sql(f"create view {name} as select * from '{testdata}/{name}.parquet'")
    return connection


def counted(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(repr(row[i]) for i in order) for row in rows)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(contract.queries())


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, testdata, oracle, name):
    found = contract.queries()[name](spark, testdata)
    expected = oracle.sql(contract.oracle_sql()[name])
    types = {n: str(t) for n, t in zip(expected.columns, expected.types)}
    assert {f.name: DUCKDB_TYPES[f.dataType.simpleString()] for f in found.schema} == types
    operators = plan(found)
    assert not [o for o in ("CartesianProduct", "NestedLoopJoin", "EvalPython", "InPandas") if o in operators]
    assert counted(found.collect(), found.columns) == counted(expected.fetchall(), expected.columns)


def test_flagship(spark):
    assert contract.entry(spark).columns == ["c_nationkey", "year", "month", "arrivals"]
