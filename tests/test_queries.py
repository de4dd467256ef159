"""Every registered query against its SQL."""

import math

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import TESTDATA

SF_DIR = str(TESTDATA / "sf0.01")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for path in sorted((TESTDATA / "sf0.01").glob("*.parquet")):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return connection


def _key(row):
    return tuple((v is None, str(type(v)), v if v is not None else 0) for v in row)


def _clean(value):
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    return value


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_clean(r[i]) for i in order) for r in rows), key=_key)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    result = entry.queries()[name](spark, SF_DIR)
    found = [tuple(r) for r in result.collect()]
    expected = duck.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in expected.description]
    rows = expected.fetchall()
    assert sorted(result.columns) == sorted(columns)
    assert _rows(result.columns, found) == _rows(columns, rows)
    assert len(found) > 0


def test_every_query_has_sql():
    own = set(entry.queries()) - set(entry.LLM_QUERIES)
    assert own == set(entry.oracle_sql()) - set(entry.LLM_SQL)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
