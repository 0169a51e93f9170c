"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as contract
from lexmill.plans.oracles import ORACLES
from lexmill.plans.registry import QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


@pytest.fixture(scope="module")
def sql(sf_dir):
    connection = duckdb.connect()
    for table in TABLES:
        connection.sql(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return connection


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(contract.queries()) and set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    rows = contract.entry(spark)
    assert rows.columns == ["word", "n"] and rows.count() == 50


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, sf_dir, sql, name):
    found = contract.queries()[name](spark, sf_dir)
    columns = sorted(found.columns)
    expected = sql.sql(contract.oracle_sql()[name])
    assert sorted(expected.columns) == columns
    order = [expected.columns.index(c) for c in columns]
    rows = sorted((tuple(r[c] for c in columns) for r in found.collect()), key=repr)
    assert rows == sorted((tuple(r[i] for i in order) for r in expected.fetchall()), key=repr)
    assert rows
