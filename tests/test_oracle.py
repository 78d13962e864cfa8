"""Every registered query vs its DuckDB oracle on the smallest tables."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as E
from ledgerline.plans.registry import QUERIES
from tests.conftest import SF_SMALL
from tools.compare import digest


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    c.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{SF_SMALL}/events.parquet')")
    yield c
    c.close()


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_oracle(spark, con, key):
    df = E.queries()[key](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(E.oracle_sql()[key])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert digest(df.columns, rows)[0] == digest(ocols, orows)[0]


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 1 and rows[0].source_events == 1000
    assert df.schema.simpleString() == (
        "struct<source_events:bigint,enriched_events:bigint,filtered_count:bigint,filtered_pct:double,"
        "window_count:bigint,flagged_count:bigint,flagged_rate:double,total_gross_value:double,"
        "total_net_value:double,discount_value:double,max_window_fraud_rate:double,"
        "min_event_time:string,max_event_time:string,rows_unparsed:bigint>"
    )
