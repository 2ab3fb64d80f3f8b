"""Every query with SQL gives the same rows in Spark and DuckDB, on the smallest tables."""

import math
import os

import pytest

duckdb = pytest.importorskip("duckdb")
from kinefold import queries as registered  # noqa: E402

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
KINDS = {"bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def tables():
    con = duckdb.connect()
    for name in ("events", "embeddings", "lineitem"):
        con.sql(f"create view {name} as select * from '{SF}/{name}.parquet'")
    return con


def _rows(rows):
    return sorted((tuple(None if isinstance(v, float) and math.isnan(v) else v for v in r) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(registered.oracle_sql()))
def test_same_rows(spark, tables, name):
    df = registered.queries()[name](spark, SF)
    columns = sorted(df.columns)
    other = tables.sql(registered.oracle_sql()[name])
    assert sorted(other.columns) == columns
    kinds = dict(zip(other.columns, map(str, other.types), strict=True))
    assert {c: KINDS.get(t, t) for c, t in df.dtypes} == kinds
    assert _rows(map(tuple, df.select(*columns).collect())) == _rows(other.project(", ".join(f'"{c}"' for c in columns)).fetchall())


@pytest.mark.parametrize("name", sorted(set(registered.queries()) - set(registered.oracle_sql())))
def test_others_have_rows(spark, name):
    assert registered.queries()[name](spark, SF).count() > 0
