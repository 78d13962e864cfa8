"""Plan-shape guards: what must hold for the queries to scale."""

from __future__ import annotations

import re

import pytest

from ledgerline.plans.registry import QUERIES
from tests.conftest import SF_SMALL

BATCH_KEYS = sorted(k for k in QUERIES if not k.startswith("stream_") and "roundtrip" not in k)


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", BATCH_KEYS)
def test_no_quadratic_joins_or_python(spark, key):
    plan = _plan(QUERIES[key](spark, SF_SMALL))
    for bad in ("BroadcastNestedLoopJoin", "CartesianProduct", "BatchEvalPython", "ArrowEvalPython"):
        assert bad not in plan, (key, bad)


def test_scan_counts_and_pruning(spark):
    """Scans in the plan, and no job while a plan is built."""
    tracker = spark.sparkContext.statusTracker()

    def scans(key):
        before = len(tracker.getJobIdsForGroup(None))
        df = QUERIES[key](spark, SF_SMALL)
        assert len(tracker.getJobIdsForGroup(None)) == before, key
        return _plan(df).count("FileScan parquet")

    assert scans("enrich_transactions") == 1
    assert scans("run_metrics") == 1
    assert scans("status_breakdown") == 1
    assert scans("throughput_series") == 1
    assert scans("windowed_summary") == 1
    assert scans("discount_lookup_join") == 1
    assert scans("amount_histogram") == 2  # exact bounds take a pass of their own
    qe = QUERIES["status_counts"](spark, SF_SMALL)._jdf.queryExecution().toString()
    assert re.findall(r"ReadSchema: struct<([^>]*)>", qe) == ["event_type:string"]
    assert "Exchange" not in _plan(QUERIES["enrich_transactions"](spark, SF_SMALL))
    # the rule table's few bytes make Spark broadcast it without a hint
    assert "BroadcastHashJoin" in _plan(QUERIES["discount_lookup_join"](spark, SF_SMALL))
