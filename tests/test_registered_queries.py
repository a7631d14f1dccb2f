"""Every registered query against its SQL on the given tables."""

import os
from decimal import Decimal
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as registry

FOLDER = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")
SQL = registry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in Path(FOLDER).glob("*.parquet"):
        connection.sql(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = (
        tuple(float(v) if isinstance(v, Decimal) else v for v in (row[i] for i in order))
        for row in rows
    )
    return sorted(plain, key=repr)


@pytest.mark.parametrize("name", sorted(name for name in SQL if not name.startswith("op")))
def test_query_equals_sql(spark, duck, name):
    result = registry.queries()[name](spark, FOLDER)
    rows = _rows(result.columns, [tuple(r) for r in result.collect()])
    assert rows, "empty result"
    expected = duck.sql(SQL[name])
    types = dict(zip(expected.columns, map(str, expected.types)))
    kinds = {"bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE"}
    assert {c: kinds[t] for c, t in result.dtypes} == types
    assert rows == _rows(expected.columns, expected.fetchall())
