"""Every registered query against its SQL statement in DuckDB.

Set TEST_SF_DIR to check another scale.
"""

import datetime
from decimal import Decimal

import duckdb
import pytest

import __spark_entry__ as spark_entry

QUERIES = spark_entry.queries()
STATEMENTS = spark_entry.oracle_sql()
TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()
KINDS = {
    "tinyint": "int", "smallint": "int", "integer": "int", "bigint": "bigint",
    "string": "varchar", "timestamp_ntz": "timestamp",
}


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def _plain(value):
    if isinstance(value, float):
        return round(value, 9)
    if isinstance(value, Decimal):
        return str(value)
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(plain, key=repr)


def test_every_statement_has_a_query():
    assert set(STATEMENTS) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(STATEMENTS))
def test_query_equals_sql(spark, duck, sf_dir, name):
    frame = QUERIES[name](spark, sf_dir)
    got = _rows(frame.columns, [tuple(r) for r in frame.collect()])
    cursor = duck.execute(STATEMENTS[name])
    described = [(c[0], str(c[1]).lower()) for c in cursor.description]
    want = _rows([c for c, _ in described], cursor.fetchall())
    assert sorted(frame.columns) == sorted(c for c, _ in described)
    got_types = {k: KINDS.get(t, t) for k, t in frame.dtypes}
    want_types = {k: {"integer": "int"}.get(t, t) for k, t in described}
    assert got_types == want_types
    assert len(got) == len(want)
    assert got == want


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(STATEMENTS)))
def test_query_without_sql_runs(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).columns
