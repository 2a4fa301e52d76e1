"""Every registered query against its DuckDB oracle on sf0.001 (as the driver
does on sf0.01), plus the entry smoke check."""
from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as entry_mod
from tools.oracle_check import TABLES, digest

SMALL = "/root/testdata/sf0.001"
# the training-data queries have their own tests
QUERIES = {k: f for k, f in entry_mod.queries().items() if k not in entry_mod.LLM_QUERIES}
ORACLES = {k: s for k, s in entry_mod.oracle_sql().items() if k in QUERIES}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    return c


def test_entry(spark):
    df = entry_mod.entry(spark)
    assert df.count() > 0


def test_every_query_has_an_oracle_or_is_listed():
    assert set(QUERIES) - set(ORACLES) == {"layout_audit"}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SMALL)
    rows = [tuple(r) for r in df.collect()]
    r = con.execute(ORACLES[name])
    ocols = [d[0] for d in r.description]
    orows = r.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert digest(df.columns, rows) == digest(ocols, orows)
