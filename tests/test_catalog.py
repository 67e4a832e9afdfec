"""Every registered query against its SQL, by value."""

import datetime as dt
import math
import os

import pytest

import __spark_entry__ as entry_point

duckdb = pytest.importorskip("duckdb")

SF = "/root/testdata/sf0.01"
TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "tinyint": "TINYINT",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "date": "DATE",
    "boolean": "BOOLEAN",
}


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for name in os.listdir(SF):
        connection.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{name}'")
    return connection


def plain(value):
    if isinstance(value, float) and (math.isnan(value) or value == 0):
        return None if math.isnan(value) else 0.0
    return value.date() if isinstance(value, dt.datetime) else value


def in_order(rows):
    return sorted(rows, key=lambda row: [(v is None, str(v)) for v in row])


@pytest.mark.parametrize("name", sorted(entry_point.oracle_sql()))
def test_query_equals_sql(spark, db, name):
    found = entry_point.queries()[name](spark, SF)
    wanted = db.execute(entry_point.oracle_sql()[name])
    types = {column[0]: str(column[1]) for column in wanted.description}
    assert {c: TYPES[t] for c, t in found.dtypes} == types
    names = sorted(types)
    rows = [dict(zip(types, row)) for row in wanted.fetchall()]
    left = in_order([tuple(plain(row[c]) for c in names) for row in found.collect()])
    right = in_order([tuple(plain(row[c]) for c in names) for row in rows])
    assert left == right


def test_every_sql_has_a_query():
    assert set(entry_point.oracle_sql()) <= set(entry_point.queries())


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0
