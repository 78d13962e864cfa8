from __future__ import annotations


import pytest
from pyspark.sql import functions as F

from ledgerline.params import JobParams
from ledgerline.plans.registry import transactions, wallclock
from ledgerline.schemas import TRANSACTION
from ledgerline.sources.readers import kafka_source_options
from ledgerline.sources.sinks import append_metrics, kafka_sink_options, start_debug_sink, start_parquet_sink, write_full_copy
from ledgerline.streaming.jobs import ProgressLog, await_all, await_query
from tests.conftest import SF_SMALL


def test_await_surfaces_query_failure(spark, fresh_dir):
    landing = fresh_dir("in")
    transactions(spark, SF_SMALL).write.parquet(landing)
    bad = spark.readStream.schema(TRANSACTION).parquet(landing).select(F.raise_error(F.lit("boom")).alias("x"))
    q = start_parquet_sink(bad, fresh_dir("out"), fresh_dir("ckpt"))
    with pytest.raises(Exception) as exc:
        await_query(q)
    assert "boom" in str(exc.value)


def test_await_the_first_of_continuous_queries(spark, fresh_dir):
    import threading

    landing = fresh_dir("in")
    transactions(spark, SF_SMALL).write.parquet(landing)
    src = spark.readStream.schema(TRANSACTION).parquet(landing)
    queries = [start_debug_sink(src, "memory", f"await_probe_{i}") for i in range(2)]
    try:
        for q in queries:
            q.processAllAvailable()
        threading.Timer(1.0, queries[0].stop).start()
        await_all(map(ProgressLog, queries), any_stop=True)
        assert not queries[0].isActive and queries[1].isActive
        assert spark.table("await_probe_1").count() == 1000
    finally:
        for q in queries:
            q.stop()


def test_append_metrics_adds_one_row_per_run(spark, fresh_dir):
    path = fresh_dir("metrics")
    m = spark.createDataFrame([(1, 0.5)], "source_events long, flagged_rate double")
    append_metrics(m, path, "run-1")
    assert [tuple(r) for r in append_metrics(m, path, "run-2").collect()] == [(1, 0.5)]
    got = spark.read.json(path).orderBy("run_id").collect()
    assert [r.run_id for r in got] == ["run-1", "run-2"]


def test_full_copy_overwrites_and_keeps_microseconds(spark, fresh_dir):
    path = fresh_dir("copy")
    t = transactions(spark, SF_SMALL)
    write_full_copy(t, path)
    write_full_copy(t, path)
    back = spark.read.parquet(path)
    assert back.count() == 1000
    assert wallclock(back).exceptAll(wallclock(t)).count() == 0


def test_kafka_option_builders():
    p = JobParams(kafka_bootstrap="broker:9092", kafka_topic="tx")
    assert kafka_source_options(p) == {
        "kafka.bootstrap.servers": "broker:9092",
        "subscribe": "tx",
        "startingOffsets": "earliest",
    }
    assert kafka_sink_options(p, "out") == {"kafka.bootstrap.servers": "broker:9092", "topic": "out"}
    bounded = kafka_source_options(JobParams(max_offsets_per_trigger=1_000_000))
    assert bounded["maxOffsetsPerTrigger"] == "1000000"


def test_command_line_run_and_rerun(spark, fresh_dir):
    from ledgerline.__main__ import main

    out = fresh_dir("cli")
    args = ["--source", "events", "--input", f"{SF_SMALL}/events*.parquet", "--out", out,
            "--full", f"{SF_SMALL}/events.parquet", "--report"]
    first = main(args)
    assert first["source_events"] == 1000 and first["enriched_events"] > 0
    assert first["enriched_batches"] == 1 and first["rows_dropped_by_watermark"] == 0
    again = main(args)
    assert again["enriched_events"] == first["enriched_events"]
    assert again["enriched_batches"] == 0
    assert spark.read.json(f"{out}/metrics").count() == 2
    assert spark.read.parquet(f"{out}/report/status_breakdown").count() == 3
    assert spark.read.parquet(f"{out}/report/amount_histogram").count() == 68


def test_command_line_counts_the_input_without_a_full_copy(spark, fresh_dir, monkeypatch):
    from ledgerline.__main__ import main, parse

    table = fresh_dir("table")
    transactions(spark, SF_SMALL).write.parquet(table)
    row = main(["--source", "table", "--input", table, "--out", fresh_dir("cli")])
    assert row["source_events"] == 1000 and row["filtered_count"] == 1000 - row["enriched_events"] > 0
    assert row["source"] == "table" and sum(x["count"] for x in row["status_counts"]) == 1000
    monkeypatch.setenv("SOURCE", "Kafka")
    args = parse(["--out", "x"])
    params = JobParams.from_env(source=args.source, kafka_topic=args.kafka_topic)
    assert params.source == "kafka" and params.kafka_topic == "transactions"
    assert JobParams.from_env({"KAFKA_TOPIC": "a", "KAFKA_BOOTSTRAP": "b:1"}, kafka_topic="c") == JobParams(
        kafka_topic="c", kafka_bootstrap="b:1"
    )


def test_run_folder_goes_with_the_process(spark):
    import os

    from ledgerline import session

    path = session.work_path(spark, "gone")
    root = session.shared_root(spark).removeprefix("file://")
    before = dict(session._run_folders)
    session._run_folders[session.shared_root(spark)] = f"{root}/ledgerline/run-test"
    try:
        spark.range(1).write.parquet(session.work_path(spark, "x"))
        assert os.path.isdir(f"{root}/ledgerline/run-test")
        session.remove_run_folder(session.shared_root(spark))
        assert not os.path.exists(f"{root}/ledgerline/run-test")
    finally:
        session._run_folders.update(before)
    assert session.work_path(spark, "gone").rsplit("/", 1)[0] == path.rsplit("/", 1)[0]


def test_a_failure_between_two_turns_is_raised():
    class Query:
        """Runs until it fails or is stopped; ``meanwhile`` happens while somebody waits for it."""

        def __init__(self, meanwhile=None):
            self.isActive, self.failure, self.meanwhile, self.recentProgress = True, None, meanwhile, []

        def awaitTermination(self, timeout=None):
            assert timeout or not self.isActive, "waits for ever"
            if self.failure:
                raise self.failure
            if self.meanwhile:
                self.meanwhile()

        def stop(self):
            self.isActive = False

    def fail():
        first.isActive, first.failure = False, ValueError("boom")

    for any_stop in (False, True):
        first, second = Query(), Query(meanwhile=fail)
        with pytest.raises(ValueError, match="boom"):
            await_all([ProgressLog(first), ProgressLog(second)], any_stop)
        assert not second.isActive


def test_debug_sinks_show_the_first_rows_of_a_batch(spark, fresh_dir, capfd):
    landing, shown = fresh_dir("in"), fresh_dir("shown")
    spark.range(100).repartition(4).write.parquet(landing)
    source = spark.readStream.schema("id long").parquet(landing)
    await_query(start_debug_sink(source, "parquet", available_now=True, rows=7, path=shown, order_by=("id",)))
    assert sorted(tuple(r) for r in spark.read.parquet(shown).collect()) == [(i, 0) for i in range(7)]
    await_query(start_debug_sink(source, "console", "probe", available_now=True, rows=3))
    printed = capfd.readouterr().out
    assert "probe, batch 0" in printed and printed.count("\n|") == 4  # a heading and three rows
    for wrong in ({"fmt": "parquet"}, {"fmt": "console", "path": shown}, {"fmt": "kafka"}):
        with pytest.raises(ValueError, match="a debug sink is"):
            start_debug_sink(source, **wrong)
