"""Every catalogued query gives the rows of its SQL."""

import glob
import math
from collections import Counter
from pathlib import Path

import duckdb
import pytest

from tributary.plans import catalogue

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        con.sql(f"CREATE VIEW {Path(f).stem} AS FROM '{f}'")
    return con


def plain(v):
    return None if v is None or isinstance(v, float) and math.isnan(v) else round(v, 9) if isinstance(v, float) else v


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query_matches_sql(spark, duck, name):
    rows = catalogue.QUERIES[name](spark, SF)
    sql = duck.sql(catalogue.ORACLE_SQL[name])
    names = sorted(rows.columns)
    assert names == sorted(sql.columns)
    order = [sql.columns.index(n) for n in names]
    got = Counter(tuple(plain(r[n]) for n in names) for r in rows.collect())
    assert got == Counter(tuple(plain(r[i]) for i in order) for r in sql.fetchall())
