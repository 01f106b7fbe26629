"""Every registered query against DuckDB on the driver's tables."""

import glob
import math
import os

import duckdb
import pytest

import __spark_entry__ as entry_point
from checks.queries import ALL

SF_DIR = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")
QUERIES = {name: entry_point.queries()[name] for name in ALL}
ORACLE = {name: sql for name, sql in entry_point.oracle_sql().items() if name in ALL}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def norm(value):
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    return "NULL" if value is None else repr(value)


def test_every_query_has_sql():
    assert set(ORACLE) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    result = duck.execute(ORACLE[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == sorted(df.columns)
    order = sorted(names)
    expected = sorted(
        [norm(row[names.index(c)]) for c in order] for row in result.fetchall()
    )
    actual = sorted([norm(row[c]) for c in order] for row in df.collect())
    assert len(actual) > 0
    assert actual == expected


def test_entry(spark):
    assert entry_point.entry(spark).count() == 908
