"""Every registered query on empty tables (same schemas, zero rows) equals
its oracle; the input check (DQ2) fails with a clear error instead."""

from __future__ import annotations

import pyarrow.parquet as pq
import pytest

import __spark_entry__ as E
from lakemart.operators.quality import EmptyInputError
from tools.oracle_check import TABLES, rows_key


@pytest.fixture(scope="module")
def empty_dir(tmp_path_factory, sf_small):
    d = tmp_path_factory.mktemp("empty-tables")
    for t in TABLES:
        tab = pq.read_table(f"{sf_small}/{t}.parquet")
        pq.write_table(tab.slice(0, 0), str(d / f"{t}.parquet"))
    return str(d)


@pytest.fixture(scope="module")
def duck(empty_dir):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{empty_dir}/{t}.parquet')")
    return con


@pytest.mark.parametrize("key", sorted(k for k in E.oracle_sql() if k != "checked_input_orders"))
def test_empty_tables(spark, duck, empty_dir, key):
    df = E.queries()[key](spark, empty_dir)
    cols = sorted(df.columns)
    got = rows_key([[r[c] for c in cols] for r in df.collect()])
    cur = duck.execute(E.oracle_sql()[key])
    dcols = [d[0] for d in cur.description]
    assert got == rows_key([[r[dcols.index(c)] for c in cols] for r in cur.fetchall()])


def test_input_check_rejects_empty_table(spark, empty_dir):
    with pytest.raises(EmptyInputError):
        E.queries()["checked_input_orders"](spark, empty_dir)
