"""Every registered query against its SQL in another engine, over whole tables."""

import math
from collections import Counter
from pathlib import Path

import pytest

import __spark_entry__ as contract
from contract.oracle import ORACLE
from contract.queries import QUERIES

duckdb = pytest.importorskip("duckdb")

FOLDER = "/root/testdata/sf0.001"
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]
KINDS = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="needs the star-schema tables")


@pytest.fixture(scope="module")
def engine():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{FOLDER}/{name}.parquet'")
    return connection


def plain(value):
    return None if isinstance(value, float) and math.isnan(value) else value


def test_every_query_has_sql():
    assert set(ORACLE) == set(QUERIES)
    assert set(QUERIES) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_result(spark, engine, name):
    df = QUERIES[name](spark, FOLDER)
    columns = sorted(df.columns)
    answer = engine.execute(ORACLE[name])
    types = {c[0]: str(c[1]) for c in answer.description}
    assert {c: KINDS[t] for c, t in df.dtypes} == types
    place = {c[0]: i for i, c in enumerate(answer.description)}
    expected = Counter(tuple(plain(row[place[c]]) for c in columns) for row in answer.fetchall())
    assert Counter(tuple(plain(row[c]) for c in columns) for row in df.collect()) == expected
    assert sum(expected.values()) > 0


def test_entry(spark):
    assert contract.entry(spark).count() > 0
