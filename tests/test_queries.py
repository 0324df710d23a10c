"""Every registered query against its SQL, on the smallest test tables."""

import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_points
from dimload.checks import registry

SF_DIR = "/root/testdata/sf0.001"
registry.load_all()
QUERIES, ORACLE = registry.QUERIES, registry.ORACLE
TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "double": "DOUBLE",
    "timestamp_ntz": "TIMESTAMP",
}

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in Path(SF_DIR).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return ""
    return repr(value)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE) and len(QUERIES) > 50


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    expected = duck.sql(ORACLE[name])
    assert {c: TYPES[t] for c, t in df.dtypes} == {c: str(t) for c, t in zip(expected.columns, expected.types)}
    columns = sorted(df.columns)
    places = [expected.columns.index(c) for c in columns]
    got = sorted(tuple(plain(r[c]) for c in columns) for r in df.collect())
    assert got == sorted(tuple(plain(r[i]) for i in places) for r in expected.fetchall())
    text = df._jdf.queryExecution().executedPlan().toString()
    for node in ("CartesianProduct", "NestedLoopJoin", "EvalPython", "InPandas", "MapInArrow"):
        assert node not in text


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0
