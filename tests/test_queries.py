"""Every query with a SQL twin gives the twin's rows."""

import datetime
import glob
import math
import os

import duckdb
import pytest

from engagelake import catalog

QUERIES = catalog.queries()
SQL = catalog.oracle_sql()


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if isinstance(v, (list, tuple)):
        return tuple(map(plain, v))
    return v.replace(tzinfo=None) if isinstance(v, datetime.datetime) else v


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for f in glob.glob(f"{sf_dir}/*.parquet"):
        con.sql(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    return con


@pytest.mark.parametrize("name", sorted(SQL))
def test_twin(spark, sf_dir, duck, name):
    df = QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    got = sorted((tuple(map(plain, r)) for r in df.select(*columns).collect()), key=repr)
    answer = duck.execute(SQL[name])
    at = [x[0] for x in answer.description]
    assert sorted(at) == columns
    assert got == sorted((tuple(plain(r[at.index(c)]) for c in columns) for r in answer.fetchall()), key=repr)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_without_twin(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0
