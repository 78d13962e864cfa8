"""Benchmark: headline streaming job plus batch datasets at one scale factor.

Prints ONE JSON line. Headline (``value``): wall time of the two streaming
sinks (enriched + windowed, availableNow, each reading the source) over the
``events`` table, from query start to both stopped, as the first streaming job
of a fresh JVM; same span the reference times (session start and stats
excluded). The same job is rerun warm and in the chained layout. Like for like
with the published run: 5,000 events in 20 NDJSON files, 4 files a micro-batch,
so both queries run 5 batches (``stream_reference_shape``). Also reported: the
job over NDJSON files of 250 rows of the whole table, and the batch datasets
(each forced with a no-op write so the whole plan runs). Events per second are
given for source and enriched rows apart.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_EVENT_LOG_DIR (optional: write Spark's event log there).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    from ledgerline.session import create_session

    from ledgerline.session import shared_root

    conf = {"spark.driver.memory": "8g"}
    event_log = os.environ.get("BENCH_EVENT_LOG_DIR")
    if event_log:  # stage/task timings for later analysis (opt-in)
        os.makedirs(event_log, exist_ok=True)
        conf.update({"spark.eventLog.enabled": "true", "spark.eventLog.dir": event_log})
    spark = create_session("ledgerline-bench", master=f"local[{cpus}]", shuffle_partitions=cpus, **conf)
    shared_root(spark)  # the configured spark.checkpoint.dir, or a local one if unset


    from ledgerline.params import DEFAULT_PARAMS
    from ledgerline.plans import registry as R
    from ledgerline.schemas import ISO_TIMESTAMP_FORMAT, TRANSACTION
    from ledgerline.session import work_path
    from ledgerline.sources.readers import ndjson_stream
    from ledgerline.sources.sinks import land_ndjson
    from ledgerline.streaming.jobs import run_stream

    n_events = R.events(spark, sf_dir).count()
    timings: dict[str, float] = {}
    extra: dict[str, object] = {}

    def stream(name, source, params=DEFAULT_PARAMS, events=None, **kw):
        run = run_stream(spark, source, work_path(spark, f"bench-{name}"), work_path(spark, f"bench-ckpt-{name}"), params, **kw)
        timings[name] = run.duration_seconds
        extra[f"{name}_batches"] = {k: v["batches_with_data"] for k, v in run.stats().items()}
        extra[f"{name}_events_per_sec"] = {
            "source": round((events or n_events) / run.duration_seconds, 1),
            "enriched": round(run.enriched(spark).count() / run.duration_seconds, 1),
        }
        return run

    table_source = lambda session: R.transactions_from_events(R.events_stream(session, sf_dir))

    # Headline: both sinks over the events table as a stream, each reading it.
    run = stream("stream_dual_sink", table_source)
    extra["enriched_rows"] = run.enriched(spark).count()
    extra["windows_emitted"] = run.windows(spark).count()
    # The same job again in the now-warm JVM: its steady-state cost.
    stream("stream_dual_sink_warm", table_source)
    # Chained: the windowed query reads the enriched output.
    stream("stream_dual_sink_chained", table_source, windowed_from="enriched")

    # Reference-shaped source: NDJSON files of 250 rows; its 5,000 events first.
    small, landing = work_path(spark, "bench-small"), work_path(spark, "bench-landing")
    few = R.transactions(spark, sf_dir).orderBy("event_time", "transaction_id").limit(5000)
    land_ndjson(few, small, DEFAULT_PARAMS.batch_size, partitions=1)
    t0 = time.perf_counter()
    land_ndjson(R.transactions(spark, sf_dir), landing, DEFAULT_PARAMS.batch_size, partitions=cpus)
    timings["ndjson_landing"] = time.perf_counter() - t0
    files = lambda path, n: lambda session: ndjson_stream(session, path, TRANSACTION, n, ISO_TIMESTAMP_FORMAT)
    stream("stream_reference_shape", files(small, 4), events=few.count())
    for per_trigger in (4, 40):
        params = DEFAULT_PARAMS.with_(max_files_per_trigger=per_trigger)
        stream(f"stream_dual_sink_ndjson_{per_trigger}_files", files(landing, per_trigger), params)

    batch_keys = [
        "enrich_transactions",
        "batch_windowed_5m",
        "run_metrics",
        "status_breakdown",
        "amount_histogram",
        "net_value_by_category",
        "flag_rate_by_channel",
        "sample_enriched_top8",
        "discount_lookup_join",
        "legacy_decode_discount",
        "json_payload_decode",
    ]
    for key in batch_keys:
        t0 = time.perf_counter()
        R.QUERIES[key](spark, sf_dir).write.format("noop").mode("overwrite").save()
        timings[key] = time.perf_counter() - t0

    headline = timings["stream_dual_sink"]
    print(
        json.dumps(
            {
                "metric": "stream_dual_sink_wall",
                "value": round(headline, 3),
                "unit": "sec",
                "queries": {k: round(v, 3) for k, v in timings.items()},
                "sf": os.path.basename(sf_dir.rstrip("/")).replace("sf", ""),
                "source_events": n_events,
                "cpus": cpus,
                "baseline": {
                    "sec": 41.527, "events": 5000, "batches_per_query": 5,
                    "source_events_per_sec": 120.4, "enriched_events_per_sec": 105.81,
                },
                **extra,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
