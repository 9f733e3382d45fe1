"""Every query with SQL against DuckDB over the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__
from tessera.plans import catalog

D = "/root/testdata/sf0.001"


def plain(v):
    if isinstance(v, float):
        return round(v, 8)
    if isinstance(v, (list, tuple)):
        return tuple(map(plain, v))
    return float(v) if type(v).__name__ == "Decimal" else v


@pytest.mark.skipif(not os.path.isdir(D), reason="no test tables")
@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_against_sql(spark, name):
    got = catalog.QUERIES[name](spark, D)
    rows = got.collect()
    if name not in catalog.ORACLES:
        return
    con = duckdb.connect()
    for f in os.listdir(D):
        con.sql(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{D}/{f}'")
    want = con.sql(catalog.ORACLES[name])
    columns = list(want.columns)
    assert sorted(columns) == sorted(got.columns)
    assert sorted((tuple(plain(r[c]) for c in columns) for r in rows), key=repr) == sorted((tuple(map(plain, r)) for r in want.fetchall()), key=repr)


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() == 4
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
