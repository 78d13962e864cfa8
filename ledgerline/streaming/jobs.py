"""Structured Streaming jobs.

Each query owns its checkpoint; both pipeline queries read the source on
their own, with the same bound on a micro-batch, as in the reference, but run
concurrently instead of one after the other.
"""

from __future__ import annotations

import time
import warnings
from collections import Counter
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

from ledgerline.functions.timecols import instant_to_wallclock
from ledgerline.operators.enrich import enrich, enrich_with_rules
from ledgerline.operators.legacy import legacy
from ledgerline.operators.summary import SourceCounts, metrics_record, run_metrics
from ledgerline.operators.windows import windowed
from ledgerline.params import DEFAULT_PARAMS, JobParams
from ledgerline.schemas import ENRICHED, LEGACY_TRANSACTION, WINDOWED
from ledgerline.sources.payload import decode_json_payload, encode_json_payload
from ledgerline.sources.readers import parquet_stream, read_output
from ledgerline.sources.sinks import start_debug_sink, start_kafka_sink, start_parquet_sink

POLL_SECONDS = 0.1
#: Batches that a progress log holds one by one: more than Spark's own progress entries.
HELD_BATCHES = 1000


#: Name of the counts that a query observes of its source, and how many raw statuses they tell apart.
SOURCE_COUNTS = "source_counts"
STATUSES = 100


def observed_source(source: DataFrame) -> DataFrame:
    """A streaming ``source`` whose rows, rows without an id and raw statuses are counted as they pass
    (A5, A4): no second read, and known for Kafka too. The counts are in the query's progress."""
    return source.observe(
        SOURCE_COUNTS,
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("transaction_id").isNull()).alias("unparsed"),
        F.count("status").alias("with_status"),
        # exact while there are fewer values than it tracks; the sum is held against with_status
        F.expr(f"approx_top_k(status, {STATUSES}, 10000)").alias("statuses"),
    )


def _counted(progress) -> SourceCounts | None:
    told = (progress.get("observedMetrics") or {}).get(SOURCE_COUNTS)
    if told is None:
        return None
    statuses = {x["item"]: int(x["count"]) for x in told["statuses"] or [] if x.get("item") is not None}
    known = sum(statuses.values()) == told["with_status"]
    return SourceCounts(int(told["rows"]), int(told["unparsed"]), statuses if known else None)


def _sum_counts(some: Iterable[SourceCounts]) -> SourceCounts:
    rows = unparsed = 0
    statuses: Counter | None = Counter()
    for c in some:
        rows, unparsed = rows + c.rows, unparsed + c.unparsed
        statuses = None if statuses is None or c.statuses is None else statuses + Counter(c.statuses)
    return SourceCounts(rows, unparsed, None if statuses is None else dict(statuses))


@dataclass
class ProgressLog:
    """Counts of a query over its micro-batches.

    Spark keeps only a query's latest progress entries, so they are collected
    while the query runs: call :meth:`update` more often than it forgets them.
    If batches were missed all the same, the counts are null, with a warning.
    Only the latest batches are held one by one, so a log of a continuous query
    does not grow.
    """

    query: StreamingQuery
    latest: dict[int, tuple[int, int, SourceCounts | None]] = field(default_factory=dict)
    first_id: int | None = None
    seen: int = 0
    with_data: int = 0
    rows: int = 0
    dropped: int = 0
    counts: SourceCounts | None = None

    def update(self) -> None:
        for p in self.query.recentProgress or []:
            batch = p["batchId"]
            if self.latest and batch < min(self.latest):
                continue  # already in the sums
            rows = int(p.get("numInputRows") or 0)
            dropped = sum(int(op.get("numRowsDroppedByWatermark") or 0) for op in p.get("stateOperators") or [])
            # an idle report carries the number of the batch that will come next
            before = self.latest.get(batch, (0, 0, None))
            counts = _counted(p)
            if counts is None or (before[2] and before[2].rows > counts.rows):
                counts = before[2]
            self.latest[batch] = (max(rows, before[0]), max(dropped, before[1]), counts)
            self.first_id = batch if self.first_id is None else min(self.first_id, batch)
        for batch in sorted(self.latest)[:-HELD_BATCHES]:
            self._add(*self.latest.pop(batch))

    def _add(self, rows: int, dropped: int, counts: SourceCounts | None) -> None:
        self.seen += 1
        self.with_data += rows > 0
        self.rows += rows
        self.dropped += dropped
        if counts:
            self.counts = _sum_counts([c for c in (self.counts, counts) if c])

    def _missed(self) -> bool:
        last = max(self.latest, default=None)
        return last is not None and self.seen + len(self.latest) < last - self.first_id + 1

    def batches(self) -> list[tuple[int, int, int]]:
        """(batch id, input rows, rows dropped by the watermark) of the batches with data that are held one by one."""
        self.update()
        return [(b, rows, dropped) for b, (rows, dropped, _) in sorted(self.latest.items()) if rows]

    def source_counts(self) -> SourceCounts | None:
        """The source's counts over this query's batches (see :func:`observed_source`); None if any is unknown."""
        self.update()
        held = list(self.latest.values())
        if self._missed() or any(rows and not counts for rows, _, counts in held):
            return None
        return _sum_counts([c for c in (self.counts, *(counts for *_, counts in held)) if c])

    def stats(self) -> dict:
        """Batches with data, input rows, rows dropped by the watermark (partially aggregated rows) and the last batch id."""
        self.update()
        last = max(self.latest, default=None)
        if self._missed():
            warnings.warn("progress of some micro-batches was missed; their counts are unknown", stacklevel=2)
            return dict.fromkeys(("batches_with_data", "input_rows", "rows_dropped_by_watermark")) | {"last_batch_id": last}
        held = self.latest.values()
        return {
            "batches_with_data": self.with_data + sum(rows > 0 for rows, *_ in held),
            "input_rows": self.rows + sum(rows for rows, *_ in held),
            "rows_dropped_by_watermark": self.dropped + sum(dropped for _, dropped, _ in held),
            "last_batch_id": last,
        }


def await_all(logs: Iterable[ProgressLog], any_stop: bool = False) -> None:
    """Wait until all queries stop, or with ``any_stop`` the first of them.

    When one fails, the others are stopped before its error is raised, so no
    sibling goes on unseen.
    """
    logs = list(logs)
    try:
        running = logs
        while running:
            for log in running:
                log.query.awaitTermination(POLL_SECONDS)  # raises what ended the query
                log.update()
            still = [log for log in running if log.query.isActive]
            # one that stopped after its turn may have failed: nobody else would ask it while a sibling goes on
            for log in running:
                if log not in still:
                    log.query.awaitTermination()
                    log.update()
            if any_stop and len(still) < len(logs):
                return
            running = still
    except BaseException:
        for log in logs:
            if log.query.isActive:
                log.query.stop()
        raise


def await_query(query: StreamingQuery) -> ProgressLog:
    """Block until the query stops, raise its failure; the progress seen meanwhile."""
    log = ProgressLog(query)
    await_all([log])
    return log


COUNTS_ROW = (
    "first_batch long, last_batch long, known boolean, rows long, unparsed long, statuses array<struct<status:string,count:bigint>>"
)


def read_counts(spark: SparkSession, path: str) -> list:
    """The saved counts in the order of their batches: a row for each run that had input."""
    try:
        return spark.read.schema(COUNTS_ROW).json(path).orderBy("first_batch", "last_batch").collect()
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return []


@dataclass
class StreamRun:
    enriched_path: str
    windowed_path: str
    duration_seconds: float
    logs: dict[str, ProgressLog] = field(default_factory=dict)
    started: float = 0.0
    counts_path: str | None = None

    @property
    def queries(self) -> dict[str, StreamingQuery]:
        return {name: log.query for name, log in self.logs.items()}

    def stop(self) -> None:
        for q in self.queries.values():
            q.stop()

    def stats(self) -> dict:
        return {name: log.stats() for name, log in self.logs.items()}

    def save_counts(self, spark: SparkSession) -> None:
        """Keep what this run's batches counted of the source, beside the checkpoints, for runs that resume from them."""
        log = self.logs["enriched"]
        counts = log.source_counts()
        told = [b for b, (rows, *_) in log.latest.items() if rows]
        if not told:
            return
        row = {
            "first_batch": log.first_id if log.with_data else min(told), "last_batch": max(told), "known": counts is not None,
            "rows": counts and counts.rows, "unparsed": counts and counts.unparsed,
            "statuses": None if counts is None or counts.statuses is None else [{"status": s, "count": n} for s, n in counts.statuses.items()],
        }
        spark.createDataFrame([row], COUNTS_ROW).coalesce(1).write.mode("append").json(self.counts_path)

    def counts(self, spark: SparkSession) -> SourceCounts | None:
        """Counts of the source over all runs on these checkpoints. None, with a warning, if some
        batches of theirs were not counted or were counted twice (a run that was cut off)."""
        rows = read_counts(spark, self.counts_path)
        last = -1
        for r in rows:
            if not r.known or r.first_batch != last + 1:
                warnings.warn("some micro-batches of the source were not counted; its counts are unknown", stacklevel=2)
                return None
            last = r.last_batch
        found = [SourceCounts(r.rows, r.unparsed, r.statuses if r.statuses is None else {x.status: x["count"] for x in r.statuses}) for r in rows]
        return _sum_counts(found)

    def enriched(self, spark: SparkSession) -> DataFrame:
        return read_output(spark, self.enriched_path, ENRICHED)

    def windows(self, spark: SparkSession) -> DataFrame:
        return read_output(spark, self.windowed_path, WINDOWED)


def start_enriched(source: DataFrame, path: str, checkpoint: str, params: JobParams = DEFAULT_PARAMS, available_now: bool = True) -> StreamingQuery:
    """K1: enriched events -> Parquet (optionally partitioned by event date)."""
    out = enrich(source, params)
    if params.partition_enriched_by_date:
        out = out.withColumn("event_date", F.to_date(instant_to_wallclock("event_time")))
        return start_parquet_sink(out, path, checkpoint, available_now, partition_by=["event_date"])
    return start_parquet_sink(out, path, checkpoint, available_now)


def start_enriched_by_rules(
    source: DataFrame,
    rules: Callable[[SparkSession], DataFrame],
    path: str,
    checkpoint: str,
    params: JobParams = DEFAULT_PARAMS,
    available_now: bool = True,
) -> StreamingQuery:
    """J1 in a stream: enriched events with the rates of a rule table that may be replaced while the query runs.

    A file or table relation in a streaming plan keeps the files it had when the
    query started, so ``rules`` is asked for the table anew in every micro-batch:
    a batch takes the table as it is when the batch is planned. Rows go to
    ``path``/batch=N. A batch that is replayed after a crash writes its own folder
    anew, so no row is there twice; :func:`read_batches` reads the folders. A rule
    table that vanishes under a running batch fails it, and the replay takes the
    new one.
    """

    def write(rows: DataFrame, batch: int) -> None:
        out = enrich_with_rules(rows, rules(rows.sparkSession), params)
        out.write.mode("overwrite").parquet(f"{path}/batch={batch}")

    writer = source.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def read_batches(spark: SparkSession, path: str, schema: StructType = ENRICHED) -> DataFrame:
    """The rows that a per-batch sink has written, without the batch numbers."""
    return read_output(spark, path, StructType([*schema.fields, StructField("batch", LongType())])).drop("batch")


def start_windows_query(windows: DataFrame, path: str, checkpoint: str, params: JobParams, available_now: bool = True) -> StreamingQuery:
    """Start a stateful window query. With ``params.state_partitions`` its state
    has that many partitions, else the session's shuffle partitions. ``windows``
    must then be made in :func:`windows_session`: a query takes the settings of
    its frame's session."""
    return start_parquet_sink(windows, path, checkpoint, available_now)


def windows_session(spark: SparkSession, params: JobParams) -> SparkSession:
    """The session for the window query's frames: ``spark``, or a sibling on the
    same context with its settings but for the number of shuffle partitions."""
    if not params.state_partitions:
        return spark
    sibling = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if key.startswith("spark.sql.") and spark.conf.isModifiable(key):
            sibling.conf.set(key, value)
    sibling.conf.set("spark.sql.shuffle.partitions", str(int(params.state_partitions)))
    return sibling


def start_windowed(source: DataFrame, path: str, checkpoint: str, params: JobParams = DEFAULT_PARAMS, available_now: bool = True) -> StreamingQuery:
    """K2: watermarked window aggregates -> Parquet (append: closed windows)."""
    return start_windows_query(windowed(enrich(source, params), params), path, checkpoint, params, available_now)


def start_stream(
    spark: SparkSession,
    source: Callable[[SparkSession], DataFrame],
    out_root: str,
    checkpoint_root: str,
    params: JobParams = DEFAULT_PARAMS,
    concurrent: bool = True,
    available_now: bool = True,
    windowed_from: str = "source",
) -> StreamRun:
    """Start the enriched and windowed sinks (C3, W10) and return at once
    (under availableNow a query the other depends on is awaited first).

    ``source`` makes a fresh source frame in the session it is given.

    ``windowed_from='source'`` (default): each query reads the source on its
    own, in the micro-batches that the source's bound makes, so late rows are
    dropped as in the reference; with ``concurrent`` both run at once.

    ``windowed_from='enriched'``: the windowed query streams the committed
    enriched output in micro-batches of ``params.chained_files_per_trigger``
    of its files, so the source is read and enriched once. On input in time
    order the windows are the same. On disordered input they may differ: which
    late rows are dropped depends on how rows are batched, and here the files
    of the enriched output are batched, not those of the source.

    Restarting with the same roots resumes from the checkpoints (W9)."""
    if windowed_from not in ("source", "enriched"):
        raise ValueError(f"windowed_from must be 'source' or 'enriched', not {windowed_from!r}")
    run = StreamRun(
        f"{out_root}/enriched", f"{out_root}/windowed", 0.0, started=time.perf_counter(), counts_path=f"{checkpoint_root}/source_counts"
    )
    try:
        first = start_enriched(observed_source(source(spark)), run.enriched_path, f"{checkpoint_root}/enriched", params, available_now)
        run.logs["enriched"] = ProgressLog(first)
        chained = windowed_from == "enriched"
        if available_now and (chained or not concurrent):
            await_all(run.logs.values())
        session = windows_session(spark, params)
        if chained:
            if not available_now:
                _await_first_output(run)
            rows = parquet_stream(session, run.enriched_path, ENRICHED, params.chained_files_per_trigger)
            windows = windowed(rows.select(*ENRICHED.fieldNames()), params)
        else:
            windows = windowed(enrich(source(session), params), params)
        second = start_windows_query(windows, run.windowed_path, f"{checkpoint_root}/windowed", params, available_now)
        run.logs["windowed"] = ProgressLog(second)
    except BaseException:
        run.stop()
        raise
    return run


def _await_first_output(run: StreamRun) -> None:
    """Until the enriched query has committed a batch: a file stream needs its folder to exist."""
    log = run.logs["enriched"]
    while log.query.isActive and not log.latest:
        log.query.awaitTermination(POLL_SECONDS)
        log.update()


def run_stream(
    spark: SparkSession,
    source: Callable[[SparkSession], DataFrame],
    out_root: str,
    checkpoint_root: str,
    params: JobParams = DEFAULT_PARAMS,
    concurrent: bool = True,
    available_now: bool = True,
    windowed_from: str = "source",
) -> StreamRun:
    """``start_stream`` then wait: availableNow waits for both queries to
    drain; continuous mode waits until any query stops (W8). When a query
    fails the other is stopped and the failure raised (W7)."""
    run = start_stream(spark, source, out_root, checkpoint_root, params, concurrent, available_now, windowed_from)
    await_all(run.logs.values(), any_stop=not available_now)
    run.duration_seconds = time.perf_counter() - run.started
    run.save_counts(spark)
    return run


def stream_metrics(
    spark: SparkSession,
    run: StreamRun,
    source: DataFrame | None,
    with_duration: bool = False,
    observed: SourceCounts | None = None,
) -> DataFrame:
    """C4 over the committed sink outputs and a batch frame of the input, or what
    was ``observed`` of it in the stream (:meth:`StreamRun.counts`), which reads no
    input again. With neither the input's counts are null.

    With ``with_duration`` the row also carries the wall time, throughput and
    the streaming progress counts (data micro-batches per query, rows dropped
    by the watermark)."""
    seconds = run.duration_seconds if with_duration else None
    out = run_metrics(source, run.enriched(spark), run.windows(spark), seconds, observed)
    if not with_duration:
        return out
    stats = run.stats()
    counts = {
        "enriched_batches": stats["enriched"]["batches_with_data"],
        "windowed_batches": stats["windowed"]["batches_with_data"],
        "rows_dropped_by_watermark": stats["windowed"]["rows_dropped_by_watermark"],
    }
    return out.select("*", *[F.lit(n).cast("long").alias(name) for name, n in counts.items()])


def stream_record(
    spark: SparkSession,
    run: StreamRun,
    source: DataFrame | None = None,
    params: JobParams = DEFAULT_PARAMS,
    kind: str | None = None,
    observed: SourceCounts | None = None,
) -> DataFrame:
    """The metrics row with settings and status counts, as a run writes it (K7)."""
    metrics = stream_metrics(spark, run, source, with_duration=True, observed=observed)
    return metrics_record(metrics, source, params, kind, observed)


def legacy_stream(raw: DataFrame, params: JobParams = DEFAULT_PARAMS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """C5 as frames: decoded input, transformed rows, JSON ``value`` records."""
    decoded = decode_json_payload(raw, LEGACY_TRANSACTION, options={})
    transformed = legacy(decoded, params)
    return decoded, transformed, encode_json_payload(transformed, options={})


def start_legacy_job(
    raw: DataFrame,
    checkpoint: str,
    params: JobParams = DEFAULT_PARAMS,
    debug_format: str | None = None,
    sink: str = "kafka",
    out_path: str | None = None,
    available_now: bool = False,
    topic: str | None = None,
    debug_path: str | None = None,
) -> list[StreamingQuery]:
    """The JSON sink, and debug sinks for input and output if asked.

    ``sink='kafka'`` writes the JSON records to ``topic``; ``sink='parquet'``
    writes them to ``out_path`` (used where no broker exists). With a
    ``debug_format`` the first rows of each micro-batch of input and output are shown too
    (console), or kept below ``debug_path``/legacy_input and /legacy_output (parquet), each
    in a query that reads the source again; debug sinks resume from nothing, as
    in the reference."""
    decoded, transformed, encoded = legacy_stream(raw, params)
    queries = []
    if debug_format:
        kept = debug_format == "parquet"
        for df, name in ((decoded, "legacy_input"), (transformed, "legacy_output")):
            queries.append(
                start_debug_sink(
                    df, debug_format, None if kept else name, available_now,
                    path=f"{debug_path}/{name}" if kept else None, order_by=("transaction_id",) if kept else (),
                )
            )
    if sink == "kafka":
        queries.append(start_kafka_sink(encoded, checkpoint, params, topic))
    else:
        queries.append(start_parquet_sink(encoded, out_path, checkpoint, available_now=available_now))
    return queries
