"""Every registered query against its DuckDB oracle on the smallest tables (row count, column
names and an order-insensitive value digest), and the smoke entry."""

import duckdb
import pytest

import __spark_entry__ as E
from scripts.oracle_check import digest
from starmart.plans import proofs
from starmart.sources.driver import TABLES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(proofs.QUERIES) == set(proofs.ORACLE)
    assert set(proofs.QUERIES) <= set(E.queries())
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(proofs.QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    cur = duck.execute(E.oracle_sql()[name])
    drows = cur.fetchall()
    dcols = [d[0] for d in cur.description]
    assert len(rows) == len(drows)
    assert sorted(df.columns) == sorted(dcols)
    assert digest(df.columns, rows) == digest(dcols, drows)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns[0] == "cicid"
