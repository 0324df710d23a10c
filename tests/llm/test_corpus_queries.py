"""Every query of the subpackage on the smallest tables, against its SQL where it has one."""

import math
from pathlib import Path

import duckdb
import pytest

from dimload.llm.queries import ORACLE, QUERIES

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables")
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}


def plain(value):
    return "" if value is None or (isinstance(value, float) and math.isnan(value)) else repr(value)


def test_names():
    assert [sum(n.startswith(f"op{k}_") for n in QUERIES) for k in range(1, 14)] == [1] * 13 and "pipeline" in QUERIES


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    df = QUERIES[name](spark, SF_DIR)
    got = [tuple(r[c] for c in sorted(df.columns)) for r in df.collect()]
    assert got
    if name in ORACLE:
        duck = duckdb.connect()
        for file in Path(SF_DIR).glob("*.parquet"):
            duck.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
        want = duck.sql(ORACLE[name])
        assert {c: TYPES[t] for c, t in df.dtypes} == {c: str(t) for c, t in zip(want.columns, want.types)}
        places = [want.columns.index(c) for c in sorted(df.columns)]
        rows = sorted(tuple(plain(r[i]) for i in places) for r in want.fetchall())
        assert sorted(tuple(map(plain, r)) for r in got) == rows
