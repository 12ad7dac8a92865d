"""Every query with SQL is run by Spark and by DuckDB and compared value by value."""

import math
from pathlib import Path

import duckdb
import pytest

from __spark_entry__ import oracle_sql, queries

QUERIES, SQL = queries(), oracle_sql()


@pytest.fixture(scope="session")
def duck(folder):
    connection = duckdb.connect()
    for path in Path(folder).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return connection


def _cell(value):
    if value is None:
        return (0, "")
    if isinstance(value, bool):
        return (1, float(value))
    if isinstance(value, (int, float)):
        return (1, 0.0 if value == 0 else float(value))
    return (2, str(value))


def compare(spark_rows, spark_names, duck_rows, duck_names):
    assert sorted(spark_names) == sorted(duck_names)
    places = [duck_names.index(n) for n in spark_names]
    left = sorted(tuple(map(_cell, r)) for r in spark_rows)
    right = sorted(tuple(_cell(r[p]) for p in places) for r in duck_rows)
    assert len(left) == len(right)
    for a, b in zip(left, right):
        for (ka, va), (kb, vb) in zip(a, b):
            same = va == vb or (ka == kb == 1 and math.isclose(va, vb, rel_tol=1e-9, abs_tol=2e-6))
            assert ka == kb and same, f"{a} != {b}"


KINDS = {
    "string": "VARCHAR",
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(name, spark, duck, folder):
    result = QUERIES[name](spark, folder)
    expected = duck.execute(SQL[name])
    names = [d[0] for d in expected.description]
    assert {n: KINDS[k] for n, k in result.dtypes} == {d[0]: str(d[1]) for d in expected.description}
    compare(result.collect(), result.columns, expected.fetchall(), names)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_rows_only(name, spark, folder):
    result = QUERIES[name](spark, folder)
    assert result.count() > 0 and result.columns
