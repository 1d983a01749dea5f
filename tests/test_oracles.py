import datetime
import decimal
import glob
import os

import duckdb
import pytest

from quarry.plans import registry


@pytest.fixture(scope="module")
def db(tiny):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for p in glob.glob(f"{tiny}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    return con


def plain(v):
    if isinstance(v, float):
        return round(v, 6) + 0.0
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None)
    return v


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_query_like_its_oracle(spark, tiny, db, name):
    df = registry.QUERIES[name](spark, tiny)
    cols = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in cols) for r in df.collect()), key=repr)
    res = db.execute(registry.ORACLES[name])
    names = [d[0] for d in res.description]
    want = sorted((tuple(plain(r[names.index(c)]) for c in cols) for r in res.fetchall()), key=repr)
    assert sorted(names) == cols
    assert got == want


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.ORACLES)))
def test_query_without_oracle_gives_rows(spark, tiny, name):
    assert registry.QUERIES[name](spark, tiny).count() > 0
