"""Every query with an oracle agrees with DuckDB at sf0.001: same column names, same row
count, same order-insensitive value multiset (floats compared at 6 places)."""

import os
import sys

import duckdb
import pytest

import __spark_entry__ as entry_mod
from reelrec.sources.tables import WAREHOUSE_TABLES

from conftest import SF_SMALL

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))
from check_oracle import digest, type_mismatches  # noqa: E402

SQL = entry_mod.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in WAREHOUSE_TABLES:
        p = os.path.join(SF_SMALL, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"create view {t} as select * from read_parquet('{p}')")
    return con


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_duckdb(spark, duck, name):
    df = entry_mod.queries()[name](spark, SF_SMALL)
    rows, cols = [tuple(r) for r in df.collect()], df.columns
    res = duck.execute(SQL[name])
    ocols = [d[0] for d in res.description]
    assert type_mismatches(df, res) == []
    orows = res.fetchall()
    assert sorted(cols) == sorted(ocols)
    assert len(rows) == len(orows)
    assert digest(rows, cols)[0] == digest(orows, ocols)[0]
