"""Every registered query against its SQL on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from catalog import ORACLES, QUERIES
from conftest import plan_of, same

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="needs the test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in os.listdir(FOLDER):
        table = name.removesuffix(".parquet")
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{name}'")
    return con


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    result = duck.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    rows = [tuple(r[names.index(c)] for c in df.columns) for r in result.fetchall()]
    assert sorted(names) == sorted(df.columns)
    assert same(df.collect(), rows)
    plan = plan_of(df)
    assert not any(node in plan for node in ("Python", "Cartesian", "NestedLoop"))


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_without_sql_gives_rows(spark, name):
    assert QUERIES[name](spark, FOLDER).count() > 0


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() == 1000 and "risk_level" in df.columns
