"""Every registered query against its DuckDB oracle on the smallest tables
(the driver runs the same comparison at sf0.01)."""

from __future__ import annotations

import pytest

import __spark_entry__ as E
from lakemart.plans.registry import load_all
from tools.oracle_check import TABLES, rows_key

QUERIES = E.queries()
ORACLES = E.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf_small):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_small}/{t}.parquet')")
    return con


def test_every_library_query_has_an_oracle():
    assert set(load_all()) <= set(ORACLES) <= set(QUERIES)


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["region", "category", "status", "orders_cnt", "revenue"]
    assert df.count() > 0


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_matches_oracle(spark, duck, sf_small, key):
    sdf = QUERIES[key](spark, sf_small)
    cols = sorted(sdf.columns)
    srows = rows_key([[r[c] for c in cols] for r in sdf.collect()])
    cur = duck.execute(ORACLES[key])
    dcols = [d[0] for d in cur.description]
    assert sorted(dcols) == cols
    order = [dcols.index(c) for c in cols]
    drows = rows_key([[r[i] for i in order] for r in cur.fetchall()])
    assert len(srows) == len(drows)
    assert srows == drows
