"""Every registered query against its SQL on the same tables."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb
import pytest

from __spark_entry__ import entry
from queries import ORACLES, QUERIES

SF_DIR = Path("/root/testdata/sf0.01")

pytestmark = pytest.mark.skipif(not SF_DIR.exists(), reason="needs the given tables")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in SF_DIR.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    yield connection
    connection.close()


def _cell(value):
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    return value


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_cell(row[i]) for i in order) for row in rows), key=repr)


SPARK_TYPE = {
    "BIGINT": "bigint",
    "INTEGER": "int",
    "DOUBLE": "double",
    "VARCHAR": "string",
    "BOOLEAN": "boolean",
    "DATE": "date",
    "TIMESTAMP": "timestamp_ntz",
}


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, str(SF_DIR))
    relation = duck.sql(ORACLES[name])
    assert sorted(df.columns) == sorted(relation.columns)
    types = {c: SPARK_TYPE[str(t)] for c, t in zip(relation.columns, relation.types, strict=True)}
    assert dict(df.dtypes) == types
    expected = relation.fetchall()
    assert _rows(df.columns, df.collect()) == _rows(relation.columns, expected)
    assert expected


def test_entry(spark):
    assert entry(spark).count() == 7
