"""Every query with SQL gives the rows of that SQL on the smallest tables."""

import glob
import math
import os

import duckdb
import pytest

from tarnweave.plans import catalog

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for f in glob.glob(f"{FOLDER}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return con


def plain(v):
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, float):
        return None if math.isnan(v) else repr(round(v, 6) + 0.0)
    return None if v is None else str(v)


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_equals_sql(spark, duck, name):
    out = catalog.queries()[name](spark, FOLDER)
    cols = sorted(out.columns)
    got = sorted(tuple(plain(r[c]) or "" for c in cols) for r in out.collect())
    cur = duck.execute(catalog.oracle_sql()[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == cols
    want = sorted(tuple(plain(r[names.index(c)]) or "" for c in cols) for r in cur.fetchall())
    assert got == want
