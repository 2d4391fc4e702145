"""Every query against its oracle on the smallest tables."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as driver
from plyspark.plans.catalogue import QUERIES


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for f in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return con


def plain(v):
    if isinstance(v, bool) or v is None:
        return str(v)
    return f"{float(v) + 0.0:.4f}" if isinstance(v, (int, float)) or type(v).__name__ == "Decimal" else str(v)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_oracle(spark, sf_dir, duck, name):
    df = QUERIES[name].spark(spark, sf_dir)
    cols = sorted(df.columns)
    got = sorted(tuple(plain(r[c]) for c in cols) for r in df.collect())
    sql = QUERIES[name].oracle()
    if sql is None:
        assert got
        return
    cur = duck.execute(sql)
    names = [d[0] for d in cur.description]
    assert sorted(names) == cols
    at = [names.index(c) for c in cols]
    assert got == sorted(tuple(plain(r[i]) for i in at) for r in cur.fetchall())


def test_entry_and_registration(spark):
    assert driver.entry(spark).limit(1).count() == 1
    queries, oracles = driver.queries(), driver.oracle_sql()
    assert set(oracles) <= set(queries) and set(QUERIES) <= set(queries)
