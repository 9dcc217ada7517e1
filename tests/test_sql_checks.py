"""Every query with a SQL statement gives the same rows in both engines."""

import math

import duckdb
import pytest

from __spark_entry__ import oracle_sql, queries

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()
TYPES = {"string": "VARCHAR", "double": "DOUBLE", "bigint": "BIGINT", "int": "INTEGER", "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def key(row):
    return tuple((v is not None, str(v) if isinstance(v, str) else "", 0 if isinstance(v, str) or v is None else v)
                 for v in row)


def same(a, b):
    if isinstance(a, float) and isinstance(b, float):
        return math.isclose(a, b, rel_tol=1e-9, abs_tol=2e-6)
    return a == b


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_same_rows(spark, duck, sf_dir, name):
    df = queries()[name](spark, sf_dir)
    columns = sorted(df.columns)
    cursor = duck.execute(oracle_sql()[name])
    found = [d[0] for d in cursor.description]
    assert sorted(found) == columns
    kinds = {d[0]: str(d[1]) for d in cursor.description}
    assert {c: TYPES.get(df.schema[c].dataType.simpleString()) for c in columns} == {c: kinds[c] for c in columns}
    order = [found.index(c) for c in columns]
    expected = sorted((tuple(r[i] for i in order) for r in cursor.fetchall()), key=key)
    actual = sorted((tuple(r) for r in df.select(*[f"`{c}`" for c in columns]).collect()), key=key)
    assert len(actual) == len(expected)
    for a, b in zip(actual, expected):
        assert all(same(x, y) for x, y in zip(a, b)), (columns, a, b)
