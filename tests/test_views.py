from __future__ import annotations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerline.operators.views import (
    flag_rate_by_channel,
    histogram,
    net_value_by_category,
    status_breakdown,
)
from ledgerline.operators.summary import run_metrics
from ledgerline.schemas import ENRICHED, TRANSACTION
from ledgerline.plans.registry import enriched, transactions
from tests.conftest import SF_SMALL


def _numpy_counts(values, bins=34):
    counts, edges = np.histogram(np.array(values, dtype=float), bins=bins)
    return counts.tolist(), edges.tolist()


def _spark_counts(spark, values, bins=34):
    df = spark.createDataFrame([(float(v),) for v in values], "x double")
    rows = histogram(df, "x", bins).orderBy("bin").collect()
    return [r["count"] for r in rows], [r.bin_start for r in rows] + [rows[-1].bin_end]


def test_histogram_matches_numpy_on_amounts(spark):
    e = enriched(spark, SF_SMALL)
    for col in ("gross_amount", "net_amount"):
        values = [r[0] for r in e.select(col).collect()]
        got_counts, got_edges = _spark_counts(spark, values)
        exp_counts, exp_edges = _numpy_counts(values)
        assert got_counts == exp_counts
        assert got_edges == exp_edges


def test_histogram_constant_column(spark):
    got_counts, got_edges = _spark_counts(spark, [5.0, 5.0, 5.0])
    exp_counts, exp_edges = _numpy_counts([5.0, 5.0, 5.0])
    assert got_counts == exp_counts and got_edges == exp_edges


@settings(max_examples=15, deadline=None)
@given(st.lists(st.floats(min_value=-1e6, max_value=1e6, allow_nan=False), min_size=1, max_size=60))
def test_histogram_property(spark, values):
    got_counts, got_edges = _spark_counts(spark, values, bins=7)
    exp_counts, exp_edges = _numpy_counts(values, bins=7)
    assert got_counts == exp_counts
    assert got_edges == pytest.approx(exp_edges)


def test_status_breakdown_zero_fills_the_domain(spark):
    from datetime import datetime

    rows = [
        ("a", "u", 1.0, "USD", "SUCCESS", "grocery", "pos", "US", datetime(2026, 1, 1), 0.0),
        ("b", "u", 1.0, "USD", "success", "grocery", "pos", "US", datetime(2026, 1, 1), 0.0),
        ("c", "u", 1.0, "USD", "FAILED", "grocery", "pos", "US", datetime(2026, 1, 1), 0.0),
    ]
    full = spark.createDataFrame(rows, TRANSACTION)
    from ledgerline.operators.enrich import enrich

    out = status_breakdown(full, enrich(full)).collect()
    assert [(r.status, r["count"]) for r in out] == [("SUCCESS", 1), ("FAILED", 1), ("PENDING", 0)]
    # (3 - 2 enriched) / 3, not clamped
    assert out[0].filtered_share == pytest.approx(1 / 3)


def test_category_and_channel_orderings(spark):
    e = enriched(spark, SF_SMALL)
    cats = net_value_by_category(e).collect()
    assert [r.net_value for r in cats] == sorted(r.net_value for r in cats)
    ch = flag_rate_by_channel(e).collect()
    assert [r.flagged_rate for r in ch] == sorted((r.flagged_rate for r in ch), reverse=True)
    assert all(r.is_alert == (r.flagged_rate >= 0.08) for r in ch)


def test_run_metrics_on_empty_frames(spark):
    empty_t = spark.createDataFrame([], TRANSACTION)
    empty_e = spark.createDataFrame([], ENRICHED)
    from ledgerline.schemas import WINDOWED

    m = run_metrics(empty_t, empty_e, spark.createDataFrame([], WINDOWED), duration_seconds=0.0).first()
    assert m.source_events == 0 and m.enriched_events == 0 and m.filtered_count == 0
    assert m.filtered_pct == 0.0 and m.flagged_rate == 0.0 and m.discount_value == 0.0
    assert m.max_window_fraud_rate == 0.0 and m.throughput_events_per_second == 0.0
    assert m.min_event_time is None


def test_run_metrics_identities(spark):
    t = transactions(spark, SF_SMALL)
    from ledgerline.operators.enrich import enrich
    from ledgerline.operators.windows import closed_windows

    e = enrich(t)
    m = run_metrics(t, e, closed_windows(e), duration_seconds=2.0).first()
    assert m.source_events == 1000
    assert m.filtered_count == m.source_events - m.enriched_events
    assert m.throughput_events_per_second == m.enriched_events / 2.0
    assert 0.0 <= m.max_window_fraud_rate <= 1.0


def test_report_datasets_all_build(spark):
    from ledgerline.operators.enrich import enrich
    from ledgerline.operators.views import report_datasets
    from ledgerline.operators.windows import closed_windows

    t = transactions(spark, SF_SMALL)
    e = enrich(t)
    sets = report_datasets(e, closed_windows(e), t)
    assert set(sets) == {
        "throughput_series", "flag_rate_series", "alert_windows", "status_breakdown",
        "net_value_by_category", "amount_histogram", "flag_rate_by_channel", "sample_enriched",
        "sample_windows",
    }
    counts = {k: v.count() for k, v in sets.items()}
    assert counts["status_breakdown"] == 3 and counts["amount_histogram"] == 68
    assert counts["sample_enriched"] == 8 and counts["sample_windows"] == 12
    assert all(n > 0 for n in counts.values())
    assert sets["net_value_by_category"].collect() == net_value_by_category(e).collect()
    assert sets["flag_rate_by_channel"].collect() == flag_rate_by_channel(e).collect()
    assert "status_breakdown" not in report_datasets(e, closed_windows(e), None)


def test_histogram_of_infinities_fails_loudly(spark):
    from ledgerline.operators.views import histogram

    df = spark.createDataFrame([(1.0,), (2.0,), (float("inf"),)], "x double")
    out = histogram(df, "x", 4)
    with pytest.raises(Exception, match="range is not finite"):
        out.collect()
    kept = spark.createDataFrame([(1.0,), (2.0,), (float("nan"),), (None,)], "x double")
    assert sum(r["count"] for r in histogram(kept, "x", 4).collect()) == 2


def test_sums_keep_small_digits_and_round_last(spark):
    from ledgerline.functions.money import exact_sum

    small = spark.createDataFrame([(4e-7,)] * 3, "x double")
    assert abs(small.agg(exact_sum("x")).first()[0] - 1.2e-6) < 1e-18
    big = spark.createDataFrame([(1e18,), (0.126,), (1.0,)], "x double")
    assert big.agg(exact_sum("x", 2)).first()[0] == 1e18
    mixed = spark.createDataFrame([(1e12 + 0.126,), (1.0,)], "x double")
    assert mixed.agg(exact_sum("x", 2)).first()[0] == 1000000000001.13
    odd = spark.createDataFrame([(1.0,), (float("nan"),)], "x double")
    got = odd.agg(exact_sum("x", 2)).first()[0]
    assert got != got
    assert spark.createDataFrame([(1.0,), (float("inf"),)], "x double").agg(exact_sum("x", 2)).first()[0] == float("inf")


def test_one_pass_metrics_equal_the_three_inputs(spark):
    from datetime import datetime

    from ledgerline.operators.enrich import enrich
    from ledgerline.operators.summary import table_metrics
    from ledgerline.operators.windows import closed_windows

    t = transactions(spark, SF_SMALL)
    row = ("x", "u", 600.0, "USD", "success", "luxury", "web", "CA")
    odd = spark.createDataFrame(
        [(*row, None, 1.0), (*row, datetime(1970, 1, 1, 0, 2), 1.0), (None,) * 10, (*row[:4], None, *row[5:], None, None)],
        "transaction_id string, user_id string, amount double, currency string, status string, merchant_category string, "
        "channel string, country string, event_time timestamp, is_fraud double",
    )
    for frame in (t, t.unionByName(odd), odd, t.limit(0)):
        e = enrich(frame)
        assert table_metrics(frame).collect() == run_metrics(frame, e, closed_windows(e)).collect()
