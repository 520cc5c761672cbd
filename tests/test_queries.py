"""Every named query against its SQL, and every query over the whole tables."""

import math

import duckdb
import pytest

import __spark_entry__ as entry_point
from conftest import DATA

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
QUERIES, SQL = entry_point.queries(), entry_point.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{DATA}/{name}.parquet'")
    return connection


def comparable(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return (0, "")
    if isinstance(value, (bool, str)):
        return (1, str(value))
    return (2, repr(float(value)))


def by_name(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(comparable(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", list(SQL))
def test_query_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, DATA)
    answer = duck.execute(SQL[name])
    columns = [d[0] for d in answer.description]
    assert sorted(df.columns) == sorted(columns)
    got = by_name(df.columns, [tuple(r) for r in df.collect()])
    assert got == by_name(columns, answer.fetchall())
    assert got


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_without_sql_runs(spark, name):
    assert QUERIES[name](spark, DATA).count() > 0


def test_entry(spark):
    assert {r.split for r in entry_point.entry(spark).collect()} == {"train", "val"}
    assert set(SQL) <= set(QUERIES)
