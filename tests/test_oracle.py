"""Every registered query against its SQL, on the whole tables."""

import math
import os
from collections import Counter

import duckdb
import pytest

from tallywork.registry.oracle import ORACLE
from tallywork.registry.queries import QUERIES

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF_DIR}/{table}.parquet')")
    return connection


def bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    def cell(v):
        if isinstance(v, float):
            return "nan" if math.isnan(v) else repr(v)
        return v if v is None or isinstance(v, (bool, str)) else str(v)
    return Counter(tuple((type(row[i]).__name__, cell(row[i])) for i in order) for row in rows)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    result = QUERIES[name](spark, SF_DIR)
    expected = duck.execute(ORACLE[name])
    columns = [d[0] for d in expected.description]
    assert sorted(result.columns) == sorted(columns)
    ours, theirs = bag(result.columns, result.collect()), bag(columns, expected.fetchall())
    assert sum(ours.values()) > 0
    assert ours == theirs
