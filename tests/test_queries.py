"""Every registered query against its SQL on DuckDB."""

import glob
import math
import os

import duckdb
import pytest

from __spark_entry__ import entry
from recordloom.plans.catalogue import ORACLES, QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def key(row):
    return tuple((value is None, str(value)) for value in row)


def same(a, b):
    if isinstance(a, float) and isinstance(b, float):
        return math.isclose(a, b, rel_tol=1e-12, abs_tol=0)
    return type(a) is type(b) and a == b


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    result = QUERIES[name](spark, SF_DIR)
    columns = sorted(result.columns)
    found = duck.execute(ORACLES[name])
    order = [d[0] for d in found.description]
    assert sorted(order) == columns
    expected = [tuple(row[order.index(c)] for c in columns) for row in found.fetchall()]
    actual = [tuple(row) for row in result.select(*(f"`{c}`" for c in columns)).collect()]
    assert len(actual) == len(expected)
    for a, b in zip(sorted(actual, key=key), sorted(expected, key=key)):
        assert all(map(same, a, b)), [(c, x, y) for c, x, y in zip(columns, a, b) if not same(x, y)]


def test_entry(spark):
    assert entry(spark).count() > 0
