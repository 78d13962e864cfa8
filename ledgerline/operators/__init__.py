"""DataFrame -> DataFrame operators (batch and streaming alike)."""

from ledgerline.operators.enrich import enrich, enrich_with_rules, flagged, score_components
from ledgerline.operators.legacy import legacy
from ledgerline.operators.summary import (
    enriched_summary,
    metrics_record,
    run_metrics,
    status_counts,
    table_metrics,
    windowed_summary,
)
from ledgerline.operators.views import (
    amount_histogram,
    first_n,
    flag_rate_by_channel,
    flag_rate_series,
    histogram,
    histograms,
    net_value_by_category,
    report_datasets,
    sample_enriched,
    sample_windows,
    status_breakdown,
    throughput_series,
)
from ledgerline.operators.windows import alerts, closed_windows, windowed

__all__ = [
    "alerts",
    "amount_histogram",
    "closed_windows",
    "enrich",
    "enrich_with_rules",
    "enriched_summary",
    "first_n",
    "flag_rate_by_channel",
    "flag_rate_series",
    "flagged",
    "histogram",
    "histograms",
    "legacy",
    "metrics_record",
    "net_value_by_category",
    "report_datasets",
    "run_metrics",
    "sample_enriched",
    "sample_windows",
    "score_components",
    "status_breakdown",
    "status_counts",
    "table_metrics",
    "throughput_series",
    "windowed",
    "windowed_summary",
]
