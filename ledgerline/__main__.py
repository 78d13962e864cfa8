"""Command line: run the streaming job once (availableNow) or continuously.

    python -m ledgerline --input /data/stream --out /shared/run1 [--full /data/full.parquet]

Writes enriched and windowed Parquet under ``--out``, checkpoints under
``--checkpoints`` (default ``<out>/_checkpoints``), appends one metrics row
(JSON) under ``<out>/metrics`` and prints it; with ``--report`` also the
chart/report datasets under ``<out>/report``. A rerun with the same folders
processes only new input.
"""

from __future__ import annotations

import argparse
import json
import uuid

from ledgerline.params import JobParams


def parse(argv=None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="ledgerline")
    p.add_argument("--job", default="pipeline", choices=["pipeline", "legacy"],
                   help="pipeline: enrichment + windows; legacy: the older Kafka job (flat 10%% discount)")
    p.add_argument("--output-topic", default="output-topic", help="legacy job: Kafka topic for the JSON records")
    p.add_argument("--input", help="NDJSON directory (file source) or Parquet table (table source)")
    p.add_argument("--source", choices=["file", "kafka", "table", "events"],
                   help="file: NDJSON stream; kafka: topic; table: Parquet transactions; events: driver events table "
                        "(default: $SOURCE, or file)")
    p.add_argument("--out", required=True, help="output root (legacy job offline: JSON records as Parquet)")
    p.add_argument("--checkpoints")
    p.add_argument("--full", help="full batch copy of the input, for source counts and status breakdown "
                   "(default: the counts are taken in the stream; only the breakdown of --report reads the input again, "
                   "and Kafka input has none)")
    p.add_argument("--window", default="5 minutes")
    p.add_argument("--watermark", default="30 minutes")
    p.add_argument("--threshold", type=float, default=0.65)
    p.add_argument("--max-files-per-trigger", type=int, default=4)
    p.add_argument("--max-bytes-per-trigger", help="bound a micro-batch of a file or table source by bytes (like 512m) instead of files")
    p.add_argument("--chained-files-per-trigger", type=int, default=4,
                   help="files of the enriched output in a micro-batch of the windowed query (--mode enriched)")
    p.add_argument("--max-offsets-per-trigger", type=int, help="bound a micro-batch of a Kafka source")
    p.add_argument("--mode", default="source", choices=["enriched", "source"],
                   help="windowed query reads the source itself (source) or the enriched output (enriched: "
                        "one read of the source, but late rows are dropped by the batches of that output)")
    p.add_argument("--state-partitions", type=int, help="partitions of the window state (default: the session's)")
    p.add_argument("--continuous", action="store_true", help="default trigger; wait for any query to stop")
    p.add_argument("--kafka-bootstrap", help="default: $KAFKA_BOOTSTRAP, or localhost:9092")
    p.add_argument("--kafka-topic", help="default: $KAFKA_TOPIC, or transactions")
    p.add_argument("--debug", action="store_true", help="legacy job: print input and output too (each reads the source again)")
    p.add_argument("--report", action="store_true", help="also write the report datasets under <out>/report")
    p.add_argument("--master", default=None)
    return p.parse_args(argv)


def legacy_main(args) -> dict:
    """Older Kafka job: Kafka -> decode -> SUCCESS only -> +discounted_amount ->
    console + JSON records to Kafka. Offline (``--source file``): each line of
    the files under ``--input`` is one record payload, and the records go to
    Parquet under ``--out``."""
    from pyspark.sql import functions as F

    from ledgerline.session import create_session
    from ledgerline.streaming.jobs import ProgressLog, await_all, start_legacy_job

    spark = create_session(master=args.master) if args.master else create_session()
    params = JobParams.from_env(source=args.source, kafka_bootstrap=args.kafka_bootstrap, kafka_topic=args.kafka_topic)
    checkpoints = args.checkpoints or f"{args.out.rstrip('/')}/_checkpoints"
    debug = "console" if args.debug else None
    if params.source == "kafka":
        from ledgerline.sources.readers import kafka_source_options

        raw = spark.readStream.format("kafka").options(**kafka_source_options(params)).load()
        queries = start_legacy_job(raw, checkpoints, params, debug, topic=args.output_topic)
        await_all(map(ProgressLog, queries), any_stop=True)
        return {}
    raw = spark.readStream.text(args.input).select(F.col("value"))
    queries = start_legacy_job(
        raw, checkpoints, params, debug, sink="parquet", out_path=f"{args.out.rstrip('/')}/records",
        available_now=not args.continuous,
    )
    await_all(map(ProgressLog, queries), any_stop=args.continuous)
    written = spark.read.parquet(f"{args.out.rstrip('/')}/records").count()
    print(json.dumps({"records_written": written}))
    return {"records_written": written}


def main(argv=None) -> dict:
    args = parse(argv)
    if args.job == "legacy":
        return legacy_main(args)
    from ledgerline.plans.registry import EVENTS_SCHEMA
    from ledgerline.session import create_session
    from ledgerline.sources.events import transactions_from_events
    from ledgerline.sources.readers import parquet_stream, read_input, read_transactions
    from ledgerline.sources.sinks import append_metrics
    from ledgerline.streaming.jobs import run_stream, stream_record

    spark = create_session(master=args.master) if args.master else create_session()
    from_events = args.source == "events"
    params = JobParams.from_env(
        source="table" if from_events else args.source,
        kafka_bootstrap=args.kafka_bootstrap,
        kafka_topic=args.kafka_topic,
        window_duration=args.window,
        watermark_delay=args.watermark,
        fraud_threshold=args.threshold,
        max_files_per_trigger=args.max_files_per_trigger,
        max_bytes_per_trigger=args.max_bytes_per_trigger,
        chained_files_per_trigger=args.chained_files_per_trigger,
        max_offsets_per_trigger=args.max_offsets_per_trigger,
        state_partitions=args.state_partitions,
    )
    if from_events:
        source = lambda session: transactions_from_events(
            parquet_stream(session, args.input, EVENTS_SCHEMA, args.max_files_per_trigger, args.max_bytes_per_trigger)
        )
        full = lambda: transactions_from_events(spark.read.schema(EVENTS_SCHEMA).parquet(args.full or args.input))
    else:
        source = lambda session: read_transactions(session, params, args.input)
        full = lambda: spark.read.parquet(args.full) if args.full else read_input(spark, params, args.input)
    out = args.out.rstrip("/")
    checkpoints = args.checkpoints or f"{out}/_checkpoints"
    run = run_stream(
        spark, source, args.out, checkpoints, params,
        available_now=not args.continuous, windowed_from=args.mode,
    )
    counted = {"source": full()} if args.full else {"observed": run.counts(spark)}
    record = stream_record(spark, run, params=params, kind="events" if from_events else None, **counted)
    written = append_metrics(record, f"{out}/metrics", uuid.uuid4().hex)
    if args.report:
        from ledgerline.operators.views import report_datasets, write_report_datasets

        datasets = report_datasets(run.enriched(spark), run.windows(spark), full(), params)
        write_report_datasets(datasets, f"{out}/report")
    row = written.first().asDict(recursive=True)
    print(json.dumps(row, default=str))
    return row


if __name__ == "__main__":
    main()
