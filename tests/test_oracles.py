"""Every registered query against its oracle, on the smallest driver tables."""

import datetime as dt
import glob
import os

import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables are absent")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def norm(value):
    if isinstance(value, float):
        return repr(round(value, 6) + 0.0)
    return value.isoformat() if isinstance(value, dt.datetime) else str(value)


@pytest.mark.parametrize("name", list(entry.queries()))
def test_query(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted(tuple(norm(r[c]) for c in columns) for r in df.collect())
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert got
        return
    found = duck.execute(sql)
    names = [d[0] for d in found.description]
    assert sorted(names) == columns
    assert got == sorted(tuple(norm(r[names.index(c)]) for c in columns) for r in found.fetchall())


def test_flagship(spark):
    assert entry.entry(spark).count() == 12
