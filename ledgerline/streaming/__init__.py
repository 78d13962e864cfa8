"""Structured Streaming jobs."""

from ledgerline.streaming.jobs import (
    ProgressLog,
    StreamRun,
    await_all,
    await_query,
    legacy_stream,
    run_stream,
    start_legacy_job,
    start_stream,
    stream_metrics,
    stream_record,
)

__all__ = [
    "ProgressLog",
    "StreamRun",
    "await_all",
    "await_query",
    "legacy_stream",
    "run_stream",
    "start_legacy_job",
    "start_stream",
    "stream_metrics",
    "stream_record",
]
