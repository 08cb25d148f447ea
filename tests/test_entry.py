"""The driver contract: entry runs, every query has a matching oracle, and a sample agrees."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as E
from ledgerloom.plans import queries
from tools.check_oracle import TABLES, digest

SF = "/root/testdata/sf0.001"


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "realised_pnl" in df.columns


def test_every_trade_query_has_an_oracle():
    assert set(queries.REGISTRY) <= set(E.queries())
    assert set(queries.REGISTRY) <= set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", ["daily_pnl", "daily_pnl_lineitem", "load_metrics", "upsert_trades",
                                  "defect_profile", "running_pnl_filtered", "top_by_month_lineitem", "stats"])
def test_query_matches_oracle_at_sf0001(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = E.queries()[name](spark, SF)
    rel = con.sql(E.oracle_sql()[name])
    assert sorted(df.columns) == sorted(rel.columns)
    assert digest(df.columns, [tuple(r) for r in df.collect()])[0] == digest(rel.columns, rel.fetchall())[0]
