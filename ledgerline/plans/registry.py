"""Named queries over the driver tables: one per SURVEY §2 key.

Each entry takes (spark, sf_dir) and returns a DataFrame built from the
``events`` table (through the adapter in ``sources.events``). Time columns of
the results are UTC wall clocks (TIMESTAMP_NTZ), so results do not depend on
the caller's session zone.
"""

from __future__ import annotations

from typing import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType, TimestampType

from ledgerline.functions.scoring import discount_rate
from ledgerline.functions.timecols import instant_to_wallclock
from ledgerline.operators import shaping as S
from ledgerline.operators.enrich import enrich, enrich_with_rules, flagged, rules_frame, score_components
from ledgerline.operators.legacy import legacy, legacy_records
from ledgerline.operators.summary import enriched_summary, status_counts, table_metrics, windowed_summary
from ledgerline.operators.views import (
    amount_histogram,
    flag_rate_by_channel,
    flag_rate_series,
    net_value_by_category,
    sample_enriched,
    sample_windows,
    status_breakdown,
    throughput_series,
)
from ledgerline.operators.windows import alerts, closed_windows, windowed
from ledgerline.params import DEFAULT_PARAMS, JobParams
from ledgerline.schemas import ENRICHED, ISO_TIMESTAMP_FORMAT, LEGACY_TRANSACTION, TRANSACTION, WINDOWED
from ledgerline.session import work_path
from ledgerline.sources.events import base_amount, keyed_transactions, transactions_from_events, with_dimensions
from ledgerline.sources.files import Store
from ledgerline.sources.payload import decode_json_payload, encode_json_payload
from ledgerline.sources.readers import ndjson_stream, parquet_stream, read_input, read_ndjson, read_output, read_transactions
from ledgerline.sources.sinks import LANDING_TASK_ROWS, append_metrics, land_in_batches, land_ndjson, write_full_copy
from ledgerline.streaming.jobs import (
    ProgressLog,
    await_all,
    await_query,
    read_batches,
    run_stream,
    start_enriched,
    start_enriched_by_rules,
    start_legacy_job,
    start_stream,
    start_windowed,
    stream_metrics,
    stream_record,
)
from ledgerline.streaming.state import open_windows

EVENTS_SCHEMA = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"

Query = Callable[[SparkSession, str], DataFrame]


# ---- inputs -----------------------------------------------------------------


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(EVENTS_SCHEMA).parquet(f"{sf_dir}/events.parquet")


def events_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    # A glob, not the bare file: a streaming file source needs a directory or pattern.
    return parquet_stream(spark, f"{sf_dir}/events*.parquet", EVENTS_SCHEMA)


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transactions_from_events(events(spark, sf_dir))


def enriched(spark: SparkSession, sf_dir: str, params: JobParams = DEFAULT_PARAMS) -> DataFrame:
    return enrich(transactions(spark, sf_dir), params)


def emitted_windows(spark: SparkSession, sf_dir: str, params: JobParams = DEFAULT_PARAMS) -> DataFrame:
    return closed_windows(enriched(spark, sf_dir, params), params)


def wallclock(df: DataFrame) -> DataFrame:
    """TIMESTAMP columns -> UTC wall-clock TIMESTAMP_NTZ (zone-free output)."""
    return df.select(
        *[
            instant_to_wallclock(f.name).alias(f.name) if isinstance(f.dataType, TimestampType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


# ---- streaming keys ---------------------------------------------------------


def _stream_windows(spark: SparkSession, sf_dir: str, params: JobParams) -> DataFrame:
    out, ckpt = work_path(spark, "windowed"), work_path(spark, "ckpt-windowed")
    src = transactions_from_events(events_stream(spark, sf_dir))
    await_query(start_windowed(src, out, ckpt, params))
    return wallclock(read_output(spark, out, WINDOWED))


def q_stream_windowed_5m(spark, sf_dir):
    return _stream_windows(spark, sf_dir, DEFAULT_PARAMS)


def q_stream_windowed_1h(spark, sf_dir):
    return _stream_windows(spark, sf_dir, DEFAULT_PARAMS.with_(window_duration="1 hour"))


def q_stream_enriched_sink(spark, sf_dir):
    out, ckpt = work_path(spark, "enriched"), work_path(spark, "ckpt-enriched")
    src = transactions_from_events(events_stream(spark, sf_dir))
    await_query(start_enriched(src, out, ckpt))
    return wallclock(read_output(spark, out, ENRICHED))


#: Files that a landing is cut into before they get more rows than the batch size: 25 micro-batches of 16.
LANDING_FILES = 400


def q_stream_ndjson_source(spark, sf_dir):
    """Land the transactions as NDJSON files, stream them back in bounded
    micro-batches, enrich, sink, read the committed output."""
    landing = work_path(spark, "landing")
    land_ndjson(transactions(spark, sf_dir), landing, DEFAULT_PARAMS.batch_size, files=LANDING_FILES)
    out, ckpt = work_path(spark, "enriched-json"), work_path(spark, "ckpt-enriched-json")
    src = ndjson_stream(spark, landing, TRANSACTION, max_files_per_trigger=16, timestamp_format=ISO_TIMESTAMP_FORMAT)
    await_query(start_enriched(src, out, ckpt))
    return wallclock(read_output(spark, out, ENRICHED))


def _dual_sink(spark: SparkSession, sf_dir: str, name: str, windowed_from: str):
    return run_stream(
        spark,
        lambda session: transactions_from_events(events_stream(session, sf_dir)),
        work_path(spark, name),
        work_path(spark, f"ckpt-{name}"),
        windowed_from=windowed_from,
    )


def q_stream_dual_sink(spark, sf_dir):
    """Both sinks at once, each over the source, then run metrics of the outputs."""
    run = _dual_sink(spark, sf_dir, "dual", "source")
    return stream_metrics(spark, run, transactions(spark, sf_dir))


def q_stream_dual_sink_source(spark, sf_dir):
    """What the windowed sink of the two-reader layout has written."""
    return wallclock(_dual_sink(spark, sf_dir, "dual-source", "source").windows(spark))


def q_stream_dual_sink_chained(spark, sf_dir):
    """The same in the chained layout: on one batch in time order the windows are equal."""
    return wallclock(_dual_sink(spark, sf_dir, "dual-chained", "enriched").windows(spark))


PARTS = 8


def _in_parts(spark: SparkSession, sf_dir: str, path: str, late: int = 0) -> tuple[list[str], int]:
    """The transactions landed at ``path`` as eighths of their time range, each a micro-batch of a file
    stream; with ``late`` an eighth of them one part late and an eighth ``late`` parts. The parts'
    folders, and the files of each."""
    tx = keyed_transactions(events(spark, sf_dir))
    seconds = F.unix_seconds("event_time")
    lo, hi, rows = tx.agg(F.min(seconds), F.max(seconds), F.count(F.lit(1))).first()
    part = F.expr(f"((unix_seconds(event_time) - {lo or 0}L) * {PARTS}L) div {(hi or 0) - (lo or 0) + 1}L")
    if late:
        remainder = F.pmod("event_id", F.lit(8))
        part = part + F.when(remainder == 0, 1).when(remainder == 4, late).otherwise(0)
    arrival = F.coalesce(F.least(part, F.lit(PARTS - 1)), F.lit(0))
    files = max(1, rows // (PARTS * LANDING_TASK_ROWS))
    return land_in_batches(tx.withColumn("arrival", arrival).drop("event_id"), path, "arrival", files), files


def _arrive(spark: SparkSession, folders: list[str], path: str) -> None:
    """Landed parts move into the folder that a stream reads."""
    for folder in folders:
        Store(spark, path).rename(folder, f"{path}/{folder.rpartition('/')[2]}")


def q_stream_late_rows(spark, sf_dir):
    """Disordered input in several restarts. The events arrive by eighths of
    their time range, but a quarter of them one part late. A window that had
    closed by the end of the batches before takes no more rows."""
    landing, out, ckpt = work_path(spark, "late"), work_path(spark, "late-out"), work_path(spark, "ckpt-late")
    folders, _ = _in_parts(spark, sf_dir, work_path(spark, "late-parts"), late=1)
    for folder in folders:
        _arrive(spark, [folder], landing)
        await_query(start_windowed(parquet_stream(spark, landing, TRANSACTION), out, ckpt))
    return wallclock(read_output(spark, out, WINDOWED))


def _late_in_one_run(spark: SparkSession, sf_dir: str):
    landing, out, ckpt = work_path(spark, "late1"), work_path(spark, "late1-out"), work_path(spark, "ckpt-late1")
    _, files = _in_parts(spark, sf_dir, landing, late=3)
    return out, await_query(start_windowed(parquet_stream(spark, landing, TRANSACTION, files), out, ckpt))


def q_stream_late_rows_one_run(spark, sf_dir):
    """Disordered input in the micro-batches of one run, an eighth of the events one part late, an eighth
    three: what the watermark drops there it drops a batch late, as rows are held against the watermark
    of the batch before."""
    return wallclock(read_output(spark, _late_in_one_run(spark, sf_dir)[0], WINDOWED))


def q_stream_late_drops(spark, sf_dir):
    """The drop counter of that run by micro-batch: input rows, and windows that lost rows in the batch."""
    rows = _late_in_one_run(spark, sf_dir)[1].batches()
    return spark.createDataFrame(rows, "batch long, input_rows long, windows_dropped long")


def q_open_windows(spark, sf_dir):
    """The windows that a run over the whole table holds back, from the state in its checkpoint."""
    out, ckpt = work_path(spark, "open"), work_path(spark, "ckpt-open")
    await_query(start_windowed(transactions_from_events(events_stream(spark, sf_dir)), out, ckpt))
    return wallclock(open_windows(spark, ckpt))


def _forget_last(spark: SparkSession, log: str) -> None:
    """Take the last entry out of a checkpoint's or a sink's log, as if the writer had died before it."""
    store = Store(spark, log)
    entries = [n for n in store.names(log) if n.isdigit()]
    store.remove(f"{log}/{max(entries, key=int)}")


def _replayed(spark: SparkSession, sf_dir: str, name: str, start, sink_too: bool) -> str:
    """A query over the first half of the parts that dies in its last micro-batch, whose output is written
    but not committed, and a restart that finds the other half too. ``sink_too``: the sink had not
    committed the batch's files either."""
    landing, out, ckpt = work_path(spark, f"{name}-in"), work_path(spark, f"{name}-out"), work_path(spark, f"ckpt-{name}")
    folders, files = _in_parts(spark, sf_dir, work_path(spark, f"{name}-parts"))
    run = lambda: await_query(start(parquet_stream(spark, landing, TRANSACTION, files), out, ckpt))
    _arrive(spark, folders[: PARTS // 2], landing)
    run()
    _forget_last(spark, f"{ckpt}/commits")
    if sink_too:
        _forget_last(spark, f"{out}/_spark_metadata")
    _arrive(spark, folders[PARTS // 2 :], landing)
    run()
    return out


def q_stream_replay_after_crash(spark, sf_dir):
    """Windows after a crash between a micro-batch's output and its commit: replayed, and none twice."""
    return wallclock(read_output(spark, _replayed(spark, sf_dir, "replay", start_windowed, False), WINDOWED))


def q_stream_replay_after_crash_enriched(spark, sf_dir):
    """Enriched events after a crash between a micro-batch's files and the sink's own log: the files of
    the attempt that died stay in the folder, and no row is read twice."""
    return wallclock(read_output(spark, _replayed(spark, sf_dir, "replay-rows", start_enriched, True), ENRICHED))


def q_committed_output(spark, sf_dir):
    """What a reader sees of a sink folder that also holds the files of an aborted micro-batch and
    stray part files: the rows that the sink's log commits to."""
    landing, out, ckpt = work_path(spark, "commit-in"), work_path(spark, "commit-out"), work_path(spark, "ckpt-commit")
    _, files = _in_parts(spark, sf_dir, landing)
    await_query(start_enriched(parquet_stream(spark, landing, TRANSACTION, files), out, ckpt))
    _forget_last(spark, f"{out}/_spark_metadata")
    stray = work_path(spark, "commit-stray")
    enriched(spark, sf_dir).where(F.col("is_flagged")).write.parquet(stray)
    store = Store(spark, out)
    for name in store.names(stray):
        if name.startswith("part-"):
            store.rename(f"{stray}/{name}", f"{out}/{name}")
    return wallclock(read_output(spark, out, ENRICHED))


#: Rates that replace those of the rule table while q_stream_rule_join runs: some raised, one gone, one new.
NEW_RULES = {"grocery": 0.25, "travel": 0.05, "electronics": 0.5, "dining": 0.125, "fuel": 0.0625, "pharmacy": 0.02, "luxury": 0.04}


def q_stream_rule_join(spark, sf_dir):
    """One running query over the parts, whose rule table is replaced after the first half of them."""
    landing, out, ckpt = work_path(spark, "rules-in"), work_path(spark, "rules-out"), work_path(spark, "ckpt-rules")
    table = work_path(spark, "rules")
    folders, files = _in_parts(spark, sf_dir, work_path(spark, "rules-parts"))
    rules = lambda session: session.read.parquet(table)
    query = None
    try:
        for some, rates in ((folders[: PARTS // 2], DEFAULT_PARAMS.discount_rules), (folders[PARTS // 2 :], NEW_RULES)):
            write_full_copy(rules_frame(spark, rates), table)
            _arrive(spark, some, landing)
            if query is None:
                source = parquet_stream(spark, landing, TRANSACTION, files)
                query = start_enriched_by_rules(source, rules, out, ckpt, available_now=False)
            query.processAllAvailable()
    finally:
        if query is not None:
            query.stop()
    return wallclock(read_batches(spark, out))


def _recovered(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Enriched rows by the rule table, and windows, of two queries over the parts. The rule table is gone when
    the second half arrives: the query that needs it fails, which the waiting job is told, and its sibling is stopped.
    A restart with a new table goes on from both checkpoints."""
    landing, table = work_path(spark, "fail-in"), work_path(spark, "fail-rules")
    rows, windows = work_path(spark, "fail-rows"), work_path(spark, "fail-windows")
    ckpts = work_path(spark, "ckpt-fail-rows"), work_path(spark, "ckpt-fail-windows")
    folders, files = _in_parts(spark, sf_dir, work_path(spark, "fail-parts"))

    def start(available_now: bool) -> list[ProgressLog]:
        source = lambda: parquet_stream(spark, landing, TRANSACTION, files)
        sibling = ProgressLog(start_windowed(source(), windows, ckpts[1], available_now=available_now))
        rules = lambda session: session.read.parquet(table)
        return [ProgressLog(start_enriched_by_rules(source(), rules, rows, ckpts[0], available_now=available_now)), sibling]

    write_full_copy(rules_frame(spark, DEFAULT_PARAMS.discount_rules), table)
    _arrive(spark, folders[: PARTS // 2], landing)
    await_all(start(True))
    Store(spark, table).remove(table)
    _arrive(spark, folders[PARTS // 2 :], landing)
    logs = start(False)
    try:
        await_all(logs)
    except StreamingQueryException:
        running = [log for log in logs if log.query.isActive]
    else:
        raise RuntimeError("a query without its rule table ended as if nothing had happened")
    if running:
        raise RuntimeError("a query goes on after its sibling has failed")
    write_full_copy(rules_frame(spark, NEW_RULES), table)
    await_all(start(True))
    return read_batches(spark, rows), read_output(spark, windows, WINDOWED)


def q_stream_failure_recovery(spark, sf_dir):
    """What a query has written that failed, was reported and went on with what it lacked."""
    return wallclock(_recovered(spark, sf_dir)[0])


def q_stream_failure_sibling(spark, sf_dir):
    """The windows of the query that was stopped because the other one failed."""
    return wallclock(_recovered(spark, sf_dir)[1])


def q_stream_continuous(spark, sf_dir):
    """Both sinks with the default trigger while the parts arrive one by one; the run ends as soon as one
    of its queries stops."""
    landing, out, ckpt = work_path(spark, "tail-in"), work_path(spark, "tail-out"), work_path(spark, "ckpt-tail")
    folders, files = _in_parts(spark, sf_dir, work_path(spark, "tail-parts"))
    params = DEFAULT_PARAMS.with_(source="table", max_files_per_trigger=files)
    _arrive(spark, folders[:1], landing)
    run = start_stream(spark, lambda session: read_transactions(session, params, landing), out, ckpt, params, available_now=False)
    try:
        for folder in [None, *folders[1:]]:
            _arrive(spark, [folder] if folder else [], landing)
            for query in run.queries.values():
                query.processAllAvailable()
        run.queries["windowed"].stop()
        await_all(run.logs.values(), any_stop=True)
    finally:
        run.stop()
    return wallclock(run.windows(spark))


def q_stream_source_switch(spark, sf_dir):
    """The same transactions as an NDJSON folder and as a table; the setting says which of the readers streams them."""
    tx = transactions(spark, sf_dir)
    lines, table = work_path(spark, "switch-lines"), work_path(spark, "switch-table")
    land_ndjson(tx, lines)
    tx.write.parquet(table)
    found = []
    for kind, path in (("Folder", lines), ("TABLE", table)):
        params = DEFAULT_PARAMS.with_(source=kind, max_files_per_trigger=16)
        source = read_transactions(spark, params, path, timestamp_format=ISO_TIMESTAMP_FORMAT)
        out = work_path(spark, "switch-out")
        await_query(start_enriched(source, out, work_path(spark, "ckpt-switch"), params))
        found.append(wallclock(read_output(spark, out, ENRICHED)).withColumn("source", F.lit(kind)))
    return found[0].unionByName(found[1])


def q_stream_debug_sinks(spark, sf_dir):
    """What the older job's debug sinks show: the first rows of each micro-batch of its input and its output."""
    landing, shown = work_path(spark, "debug-in"), work_path(spark, "debug-shown")
    _, files = _in_parts(spark, sf_dir, landing)
    raw = encode_json_payload(legacy_records(parquet_stream(spark, landing, TRANSACTION, files)), options={})
    queries = start_legacy_job(
        raw, work_path(spark, "ckpt-debug-job"), debug_format="parquet", debug_path=shown, sink="parquet",
        out_path=work_path(spark, "debug-out"), available_now=True,
    )
    await_all([ProgressLog(q) for q in queries])
    fields = [*LEGACY_TRANSACTION.fields, StructField("discounted_amount", DoubleType()), StructField("batch", LongType())]
    read = lambda name: read_output(spark, f"{shown}/legacy_{name}", StructType(fields)).withColumn("stream", F.lit(name))
    return read("input").unionByName(read("output"))


BOUND_FILES = 20
BOUND_FILE_ROWS = 250_000
BOUND_LINE = 512


def q_stream_batch_bound(spark, sf_dir):
    """Rows of each micro-batch of one run bounded by files (four) and one bounded by bytes (two and a half
    files' worth), over NDJSON files of lines of one length that hold equal shares of the events."""
    rows = events(spark, sf_dir).count()
    files = max(BOUND_FILES, -(-rows // BOUND_FILE_ROWS))
    landing = work_path(spark, "bound")
    tx = keyed_transactions(events(spark, sf_dir))
    line = F.rpad(F.to_json(F.struct("transaction_id", "status", "amount")), BOUND_LINE - 1, " ")
    land_in_batches(tx.select(line.alias("value"), F.pmod("event_id", F.lit(files)).alias("file")), landing, "file", fmt="text")
    bounds = {
        "files": {"max_files_per_trigger": 4},
        "bytes": {"max_files_per_trigger": None, "max_bytes_per_trigger": 5 * BOUND_LINE * -(-rows // files) // 2},
    }
    out = []
    for name, bound in bounds.items():
        params = DEFAULT_PARAMS.with_(**bound)
        log = await_query(start_enriched(read_transactions(spark, params, landing), work_path(spark, "bound-out"), work_path(spark, "ckpt-bound")))
        out += [(name, batch, n) for batch, n, _ in log.batches()]
    return spark.createDataFrame(out, "bound string, batch long, input_rows long")


def q_stream_observed_metrics(spark, sf_dir):
    """The metrics record of a run whose input counts were taken in the stream: nothing reads the input again."""
    run = _dual_sink(spark, sf_dir, "observed", "source")
    record = stream_record(spark, run, kind="table", observed=run.counts(spark))
    return record.withColumn("status_counts", F.to_json("status_counts")).drop(
        "pipeline_duration_seconds", "throughput_events_per_second"
    )


def q_run_metrics_no_full_copy(spark, sf_dir):
    """A run over NDJSON files, malformed lines among them, whose input counts come
    from the files themselves."""
    landing = work_path(spark, "landing-metrics")
    land_ndjson(transactions(spark, sf_dir), landing)
    broken = spark.range(0, 7, 1, 2).select(F.concat(F.lit("not json "), F.col("id").cast("string")).alias("value"))
    broken.write.mode("append").text(landing)
    run = run_stream(
        spark,
        lambda session: read_transactions(session, DEFAULT_PARAMS, landing, timestamp_format=ISO_TIMESTAMP_FORMAT),
        work_path(spark, "metrics-run"),
        work_path(spark, "ckpt-metrics-run"),
        DEFAULT_PARAMS.with_(max_files_per_trigger=100),
    )
    return stream_metrics(spark, run, read_input(spark, DEFAULT_PARAMS, landing, timestamp_format=ISO_TIMESTAMP_FORMAT))


def q_metrics_record(spark, sf_dir):
    """The metrics record that a run writes, read back from its JSON file; the
    wall time, which differs from run to run, left out."""
    run = _dual_sink(spark, sf_dir, "record", "source")
    record = stream_record(spark, run, transactions(spark, sf_dir), kind="table")
    back = append_metrics(record, work_path(spark, "metrics-json"), "r1")
    return back.withColumn("status_counts", F.to_json("status_counts")).drop(
        "pipeline_duration_seconds", "throughput_events_per_second"
    )


def q_stream_incremental_resume(spark, sf_dir):
    """Input arrives in two parts (split at the middle of the time range); the
    same checkpoint resumes state; a third run with no new input adds
    nothing. Result = closed windows over all the input."""
    tx = transactions(spark, sf_dir)
    bounds = tx.agg(F.min("event_time").alias("lo"), F.max("event_time").alias("hi"))
    cut = bounds.select(
        F.timestamp_micros(
            F.unix_micros("lo") + F.floor((F.unix_micros("hi") - F.unix_micros("lo")) / 2)
        )
    ).scalar()
    landing, out, ckpt = work_path(spark, "arrivals"), work_path(spark, "resume"), work_path(spark, "ckpt-resume")
    tx_schema = tx.schema

    def run():
        src = parquet_stream(spark, landing, tx_schema)
        await_query(start_windowed(src, out, ckpt))

    tx.filter(F.col("event_time") < cut).write.mode("append").parquet(landing)
    run()
    tx.filter(~(F.col("event_time") < cut) | F.col("event_time").isNull()).write.mode("append").parquet(landing)
    run()
    run()
    return wallclock(read_output(spark, out, WINDOWED))


def q_stream_legacy_job(spark, sf_dir):
    """Older Kafka job as a stream: producer-style JSON lines (one payload per
    line) -> decode -> SUCCESS only -> discounted_amount -> JSON records,
    written by its checkpointed sink."""
    landing = work_path(spark, "legacy-lines")
    payload = encode_json_payload(legacy_records(transactions(spark, sf_dir)), options={})
    payload.write.text(landing)
    out, ckpt = work_path(spark, "legacy-records"), work_path(spark, "ckpt-legacy")
    raw = spark.readStream.text(landing)
    for q in start_legacy_job(raw, ckpt, sink="parquet", out_path=out, available_now=True):
        await_query(q)
    return spark.read.parquet(out)


# ---- batch keys -------------------------------------------------------------


def q_enrich_transactions(spark, sf_dir):
    return wallclock(enriched(spark, sf_dir))


def q_batch_windowed_5m(spark, sf_dir):
    return wallclock(windowed(enriched(spark, sf_dir), watermark=False))


def q_fraud_components(spark, sf_dir):
    comp = score_components(transactions(spark, sf_dir))
    return comp.select(
        "transaction_id", "amount_risk", "category_risk", "channel_risk", "cross_border_risk",
        "latent_signal", "fraud_score",
    )


def q_discount_lookup(spark, sf_dir):
    tx = transactions(spark, sf_dir)
    return tx.select(
        "transaction_id", "merchant_category",
        discount_rate("merchant_category", DEFAULT_PARAMS.discount_rules).cast("double").alias("discount_rate"),
    )


def q_discount_lookup_join(spark, sf_dir):
    rules = rules_frame(spark, DEFAULT_PARAMS.discount_rules)
    return wallclock(enrich_with_rules(transactions(spark, sf_dir), rules))


def q_flagged_transactions(spark, sf_dir):
    return wallclock(flagged(enriched(spark, sf_dir)).select(
        "transaction_id", "event_time", "merchant_category", "channel", "country",
        "gross_amount", "fraud_score",
    ))


def q_enriched_summary(spark, sf_dir):
    return enriched_summary(enriched(spark, sf_dir))


def q_windowed_summary(spark, sf_dir):
    return windowed_summary(emitted_windows(spark, sf_dir))


def q_status_counts(spark, sf_dir):
    return status_counts(transactions(spark, sf_dir))


def q_run_metrics(spark, sf_dir):
    return table_metrics(transactions(spark, sf_dir))


def q_throughput_series(spark, sf_dir):
    return wallclock(throughput_series(emitted_windows(spark, sf_dir)))


def q_flag_rate_series(spark, sf_dir):
    return wallclock(flag_rate_series(emitted_windows(spark, sf_dir)))


def q_alert_windows(spark, sf_dir):
    return wallclock(alerts(emitted_windows(spark, sf_dir)))


def q_net_value_by_category(spark, sf_dir):
    return net_value_by_category(enriched(spark, sf_dir))


def q_flag_rate_by_channel(spark, sf_dir):
    return flag_rate_by_channel(enriched(spark, sf_dir))


def q_status_breakdown(spark, sf_dir):
    return status_breakdown(transactions(spark, sf_dir))


def q_amount_histogram(spark, sf_dir):
    return amount_histogram(enriched(spark, sf_dir), DEFAULT_PARAMS.histogram_bins)


def q_sample_enriched_top8(spark, sf_dir):
    return wallclock(sample_enriched(enriched(spark, sf_dir), 8))


def q_sample_windows_top12(spark, sf_dir):
    return wallclock(sample_windows(emitted_windows(spark, sf_dir), 12))


def q_json_payload_decode(spark, sf_dir):
    encoded = encode_json_payload(transactions(spark, sf_dir), as_binary=True)
    return wallclock(decode_json_payload(encoded, TRANSACTION))


def q_kafka_payload_decode(spark, sf_dir):
    """The decoding that the Kafka source uses: no JSON options."""
    encoded = encode_json_payload(transactions(spark, sf_dir), as_binary=True)
    return wallclock(decode_json_payload(encoded, TRANSACTION, options={}))


def q_weighted_status(spark, sf_dir):
    return events(spark, sf_dir).select("event_id", S.weighted_status("event_id").alias("status"))


def q_json_payload_encode(spark, sf_dir):
    rows = legacy(legacy_records(transactions(spark, sf_dir)))
    return encode_json_payload(rows, options={})


def q_legacy_decode_discount(spark, sf_dir):
    raw = encode_json_payload(legacy_records(transactions(spark, sf_dir)), options={}, as_binary=True)
    return legacy(decode_json_payload(raw, LEGACY_TRANSACTION, options={}))


def q_transactions_view(spark, sf_dir):
    return wallclock(transactions(spark, sf_dir))


def q_weighted_assignment(spark, sf_dir):
    return with_dimensions(events(spark, sf_dir)).select(
        "event_id", "k", "status", "merchant_category", "channel", "country", "currency"
    )


def q_shape_amounts(spark, sf_dir):
    dims = with_dimensions(events(spark, sf_dir))
    return dims.select(
        "event_id",
        "merchant_category",
        base_amount().cast("double").alias("base_amount"),
        S.category_multiplier().cast("double").alias("category_multiplier"),
        S.shape_amount(base_amount()).alias("amount"),
    )


def q_risk_probability(spark, sf_dir):
    tx = S.with_risk_probability(transactions(spark, sf_dir))
    return tx.select(
        "transaction_id", "amount", "merchant_category", "channel", "country",
        "fraud_probability_units", "fraud_probability",
    )


def q_label_assignment(spark, sf_dir):
    tx = keyed_transactions(events(spark, sf_dir))
    return tx.select(
        "transaction_id",
        S.hash_draw("event_id", S.LABEL_HASH, S.FRAUD_UNITS).alias("label_draw"),
        S.fraud_probability_units().alias("fraud_probability_units"),
        "is_fraud",
    )


def q_fraud_uplift(spark, sf_dir):
    tx = keyed_transactions(events(spark, sf_dir))
    return tx.select(
        "transaction_id",
        "is_fraud",
        F.col("amount").alias("base_amount"),
        S.uplift_factor("event_id").cast("double").alias("uplift_factor"),
        S.uplifted_amount("amount", "event_id", "is_fraud").alias("amount"),
    )


def q_full_copy_roundtrip(spark, sf_dir):
    path = work_path(spark, "full-copy")
    write_full_copy(transactions(spark, sf_dir), path)
    return wallclock(spark.read.schema(TRANSACTION).parquet(path))


def q_ndjson_landing_roundtrip(spark, sf_dir):
    path = work_path(spark, "ndjson")
    land_ndjson(transactions(spark, sf_dir), path, DEFAULT_PARAMS.batch_size, files=LANDING_FILES)
    return wallclock(read_ndjson(spark, path, TRANSACTION))


QUERIES: dict[str, Query] = {
    "enrich_transactions": q_enrich_transactions,
    "batch_windowed_5m": q_batch_windowed_5m,
    "stream_windowed_5m": q_stream_windowed_5m,
    "stream_windowed_1h": q_stream_windowed_1h,
    "stream_enriched_sink": q_stream_enriched_sink,
    "stream_ndjson_source": q_stream_ndjson_source,
    "stream_dual_sink": q_stream_dual_sink,
    "stream_dual_sink_source": q_stream_dual_sink_source,
    "stream_dual_sink_chained": q_stream_dual_sink_chained,
    "stream_late_rows": q_stream_late_rows,
    "stream_late_rows_one_run": q_stream_late_rows_one_run,
    "stream_late_drops": q_stream_late_drops,
    "open_windows": q_open_windows,
    "stream_replay_after_crash": q_stream_replay_after_crash,
    "stream_replay_after_crash_enriched": q_stream_replay_after_crash_enriched,
    "committed_output": q_committed_output,
    "stream_rule_join": q_stream_rule_join,
    "stream_failure_recovery": q_stream_failure_recovery,
    "stream_failure_sibling": q_stream_failure_sibling,
    "stream_continuous": q_stream_continuous,
    "stream_source_switch": q_stream_source_switch,
    "stream_debug_sinks": q_stream_debug_sinks,
    "stream_batch_bound": q_stream_batch_bound,
    "stream_observed_metrics": q_stream_observed_metrics,
    "run_metrics_no_full_copy": q_run_metrics_no_full_copy,
    "metrics_record": q_metrics_record,
    "kafka_payload_decode": q_kafka_payload_decode,
    "weighted_status": q_weighted_status,
    "stream_incremental_resume": q_stream_incremental_resume,
    "stream_legacy_job": q_stream_legacy_job,
    "fraud_components": q_fraud_components,
    "discount_lookup": q_discount_lookup,
    "discount_lookup_join": q_discount_lookup_join,
    "flagged_transactions": q_flagged_transactions,
    "enriched_summary": q_enriched_summary,
    "windowed_summary": q_windowed_summary,
    "status_counts": q_status_counts,
    "run_metrics": q_run_metrics,
    "throughput_series": q_throughput_series,
    "flag_rate_series": q_flag_rate_series,
    "alert_windows": q_alert_windows,
    "net_value_by_category": q_net_value_by_category,
    "flag_rate_by_channel": q_flag_rate_by_channel,
    "status_breakdown": q_status_breakdown,
    "amount_histogram": q_amount_histogram,
    "sample_enriched_top8": q_sample_enriched_top8,
    "sample_windows_top12": q_sample_windows_top12,
    "json_payload_decode": q_json_payload_decode,
    "json_payload_encode": q_json_payload_encode,
    "legacy_decode_discount": q_legacy_decode_discount,
    "transactions_view": q_transactions_view,
    "weighted_assignment": q_weighted_assignment,
    "shape_amounts": q_shape_amounts,
    "risk_probability": q_risk_probability,
    "label_assignment": q_label_assignment,
    "fraud_uplift": q_fraud_uplift,
    "full_copy_roundtrip": q_full_copy_roundtrip,
    "ndjson_landing_roundtrip": q_ndjson_landing_roundtrip,
}
