"""Every registered query against its SQL on the smallest tables."""

import decimal

import duckdb
import pytest

from pubweave.plans.queries import QUERIES, SQL

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def plain(v):
    return round(float(v), 6) if isinstance(v, (float, decimal.Decimal)) else v


@pytest.mark.parametrize("name", sorted(SQL))
def test_query(spark, db, name):
    df = QUERIES[name](spark, SF)
    want = db.sql(SQL[name])
    columns = sorted(df.columns)
    assert columns == sorted(want.columns)
    key = lambda rows: sorted(([plain(v) for v in r] for r in rows), key=repr)
    at = [want.columns.index(c) for c in columns]
    assert key(df.select(*columns).collect()) == key([[r[i] for i in at] for r in want.fetchall()])
