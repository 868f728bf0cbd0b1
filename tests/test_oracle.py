"""Each registered query against its SQL, on another engine, over whole tables."""

import datetime
import glob
import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry_points
from checks import oracle, queries

SF_DIR = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.01")

QUERIES = queries.registered()
ORACLE = oracle.statements()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def plain(value):
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    return value


def bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    result = QUERIES[name](spark, SF_DIR)
    expected = duck.execute(ORACLE[name])
    expected_columns = [c[0] for c in expected.description]
    assert sorted(result.columns) == sorted(expected_columns)
    got = bag(result.columns, (tuple(r) for r in result.collect()))
    want = bag(expected_columns, expected.fetchall())
    assert sum(got.values()) > 0
    missing, surplus = want - got, got - want
    assert (list(missing)[:3], list(surplus)[:3]) == ([], [])


def test_entry_points_hold_every_query_and_its_sql():
    assert set(QUERIES) <= set(entry_points.queries())
    assert set(ORACLE) <= set(entry_points.oracle_sql()) <= set(entry_points.queries())


def test_entry_has_rows(spark):
    assert entry_points.entry(spark).count() > 0
