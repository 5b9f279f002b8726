"""Every registered query with an SQL twin gives the twin's rows at sf0.001."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as registered
from adjudica.plans.catalogue import all_queries
from oracles import all_oracles

FOLDER = "/root/testdata/sf0.001"
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]
QUERIES, ORACLES = all_queries(), all_oracles()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return connection


def same(value):
    return repr(round(value, 9)) if isinstance(value, float) else repr(value)


def bag(rows, columns):
    return sorted(tuple(same(row[c]) for c in columns) for row in rows)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    result = duck.execute(ORACLES[name])
    columns = [entry[0] for entry in result.description]
    assert sorted(df.columns) == sorted(columns)
    expected = [dict(zip(columns, row)) for row in result.fetchall()]
    assert bag([row.asDict() for row in df.collect()], sorted(columns)) == bag(expected, sorted(columns))


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    df = registered.entry(spark)
    assert df.count() == 10 and df.columns[-1] == "payout_decile"
