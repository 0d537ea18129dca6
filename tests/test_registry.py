"""Every registered query against its SQL, on the whole smallest tables."""

from __future__ import annotations

import os

import duckdb
import pytest

from pluvio.workload import registry

SMALL = "/root/testdata/sf0.001"
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN"}
SQL = registry.oracle_sql()
# Many rounds of boosting; these queries run whole in the correctness check, and small in test_ml.
LONG = {"ml06_gradient_boosting", "ml12_run_log"}


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    connection.sql("set timezone = 'UTC'")
    for name in os.listdir(SMALL):
        connection.sql(f"create view {name.removesuffix('.parquet')} as select * from '{SMALL}/{name}'")
    return connection


def ordered(rows):
    return sorted(rows, key=lambda row: [(v is None, str(v)) for v in row])


@pytest.mark.parametrize("name", sorted(set(SQL) - LONG))
def test_query_equals_sql(spark, database, name):
    got = registry.queries()[name](spark, SMALL)
    columns = sorted(got.columns)
    expected = database.sql(SQL[name])
    assert columns == sorted(expected.columns)
    types = dict(zip(expected.columns, map(str, expected.types)))
    assert {c: TYPES[t] for c, t in got.dtypes} == types
    rows = [tuple(r[c] for c in columns) for r in got.collect()]
    places = [expected.columns.index(c) for c in columns]
    assert ordered(rows) == ordered([tuple(r[i] for i in places) for r in expected.fetchall()])


@pytest.mark.parametrize("name", sorted(set(registry.queries()) - set(SQL)))
def test_query_without_sql_runs(spark, name):
    assert registry.queries()[name](spark, SMALL).count() > 0


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() == 150
