"""Every named query against its checking SQL, on the smallest tables."""

import glob
import math
import os

import duckdb
import pytest

import __spark_entry__ as entry_points
from tripmart import registry

SMALL = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="no test tables")
QUERIES = {k: v for k, v in entry_points.queries().items() if k in registry.QUERIES}
SQL = {k: v for k, v in entry_points.oracle_sql().items() if k in registry.QUERIES}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in glob.glob(f"{SMALL}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def clean(value):
    return None if isinstance(value, float) and math.isnan(value) else value


def test_every_query_has_its_sql():
    assert set(SQL) == set(QUERIES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SMALL)
    columns = sorted(df.columns)
    found = sorted((tuple(clean(r[c]) for c in columns) for r in df.collect()), key=repr)
    answer = duck.execute(SQL[name])
    names = [d[0] for d in answer.description]
    assert sorted(names) == columns
    expected = sorted(
        (tuple(r[names.index(c)] for c in columns) for r in answer.fetchall()), key=repr
    )
    assert found == expected


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0
