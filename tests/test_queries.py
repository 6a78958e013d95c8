"""Every query against its SQL on the small tables."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
SQL = {k: v for k, v in entry.oracle_sql().items() if not k.startswith(("op", "pipeline"))}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.sql("SET TimeZone = 'UTC'")
    for f in glob.glob(f"{SF}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return con


def plain(v):
    if isinstance(v, float) and v != v:
        return None
    if isinstance(v, (list, tuple)):
        return [plain(x) for x in v]
    return v if v is None or isinstance(v, (bool, int, float)) else str(v)


def rows(names, data):
    order = sorted(range(len(names)), key=lambda k: names[k])
    return sorted(repr([plain(r[k]) for k in order]) for r in data)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_its_sql(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    want = duck.sql(SQL[name])
    assert sorted(df.columns) == sorted(want.columns)
    assert rows(df.columns, [tuple(r) for r in df.collect()]) == rows(want.columns, want.fetchall())


def test_entry_gives_rows(spark):
    assert entry.entry(spark).count() > 0
