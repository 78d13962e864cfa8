"""What a run guarantees: counts without a second read, nothing lost or doubled on restarts, whole outputs."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from ledgerline.operators.enrich import rules_frame
from ledgerline.operators.summary import SourceCounts
from ledgerline.operators.views import report_datasets, write_report_datasets
from ledgerline.params import JobParams, byte_count
from ledgerline.plans import registry as R
from ledgerline.schemas import ISO_TIMESTAMP_FORMAT, TRANSACTION, WINDOWED
from ledgerline.sources.files import Store, hidden_sibling, recover_folder
from ledgerline.sources.readers import parquet_stream, read_output, read_transactions
from ledgerline.sources.sinks import land_in_batches, land_ndjson, write_full_copy
from ledgerline.streaming import jobs
from ledgerline.streaming.jobs import ProgressLog, await_query, read_batches, run_stream, start_enriched_by_rules, start_windowed, stream_metrics, stream_record
from ledgerline.streaming.state import open_windows
from tests.conftest import SF_SMALL


def local(path):
    return path.removeprefix("file:")


def data_files(path):
    return sorted(os.path.join(d, f) for d, _, names in os.walk(local(path)) for f in names if f.startswith("part-") and not f.endswith(".crc"))


# ---- counts in the stream ---------------------------------------------------


def test_counts_come_from_the_stream(spark, fresh_dir):
    asked = []

    def source(session):
        asked.append(session)
        return R.transactions_from_events(R.events_stream(session, SF_SMALL))

    run = run_stream(spark, source, fresh_dir("o"), fresh_dir("c"))
    counts = run.counts(spark)
    assert len(asked) == 2  # once for each query
    assert [s["input_rows"] for s in run.stats().values()] == [1000, 1000]
    plain = {r.status: r["count"] for r in R.q_status_counts(spark, SF_SMALL).collect()}
    assert counts == SourceCounts(1000, 0, plain)
    record = stream_record(spark, run, observed=counts)
    assert SF_SMALL not in record._jdf.queryExecution().toString()  # the record's plan reads outputs only
    told = stream_record(spark, run, R.transactions(spark, SF_SMALL)).first()
    assert record.first() == told
    assert stream_metrics(spark, run, None).first().source_events is None


def test_counts_add_up_over_restarts(spark, fresh_dir):
    landing, out, ckpt = fresh_dir("in"), fresh_dir("o"), fresh_dir("c")
    tx = R.transactions(spark, SF_SMALL)
    broken = spark.createDataFrame([("not json",)], "value string")
    source = lambda session: read_transactions(session, JobParams(), landing, timestamp_format=ISO_TIMESTAMP_FORMAT)
    for n in range(3):
        if n < 2:
            part = fresh_dir("part")
            land_ndjson(tx.where(F.crc32(F.col("transaction_id").cast("binary")) % 2 == n), part, 100)
            broken.coalesce(1).write.mode("append").text(landing)
            for f in data_files(part):
                Store(spark, landing).rename(f, f"{landing}/{os.path.basename(f)}")
        run = run_stream(spark, source, out, ckpt)
    assert run.stats()["enriched"]["batches_with_data"] == 0
    counts = run.counts(spark)
    assert (counts.rows, counts.unparsed, sum(counts.statuses.values())) == (1002, 2, 1000)
    m = stream_metrics(spark, run, None, observed=counts).first()
    assert m.source_events == 1002 and m.rows_unparsed == 2 and m.filtered_count == 1002 - m.enriched_events
    # a run whose counts were lost makes them unknown
    saved = spark.read.schema(jobs.COUNTS_ROW).json(run.counts_path)
    saved.where("first_batch > 0").coalesce(1).write.json(f"{local(ckpt)}/other")
    run.counts_path = f"{ckpt}/other"
    with pytest.warns(UserWarning, match="unknown"):
        assert run.counts(spark) is None


def test_more_statuses_than_are_told_apart(spark, fresh_dir):
    rows = R.transactions(spark, SF_SMALL).withColumn("status", F.col("transaction_id"))
    path = fresh_dir("many")
    rows.write.parquet(path)
    counts = run_stream(spark, lambda s: parquet_stream(s, path, TRANSACTION), fresh_dir("o"), fresh_dir("c")).counts(spark)
    assert (counts.rows, counts.statuses) == (1000, None)


def test_counts_of_folded_batches(monkeypatch):
    monkeypatch.setattr(jobs, "HELD_BATCHES", 3)

    class Query:
        recentProgress = []

    def entry(batch, counted=True):
        told = {"rows": batch, "unparsed": 1, "with_status": batch, "statuses": [{"item": "S", "count": batch}]}
        return {"batchId": batch, "numInputRows": batch, "observedMetrics": {jobs.SOURCE_COUNTS: told} if counted else {}}

    log = ProgressLog(Query())
    for batch in range(1, 20):
        Query.recentProgress = [entry(b) for b in range(max(1, batch - 2), batch + 1)]
        log.update()
    assert log.source_counts() == SourceCounts(190, 19, {"S": 190})
    Query.recentProgress = [entry(20, counted=False)]
    assert log.source_counts() is None


# ---- state, replay, committed rows ------------------------------------------


def test_open_and_closed_windows_hold_every_row(spark, fresh_dir):
    out, ckpt = fresh_dir("o"), fresh_dir("c")
    for minutes in ("5 minutes", "1 hour"):
        params = JobParams(window_duration=minutes, watermark_delay="2 days")
        o, c = f"{out}-{minutes[0]}", f"{ckpt}-{minutes[0]}"
        await_query(start_windowed(R.transactions_from_events(R.events_stream(spark, SF_SMALL)), o, c, params))
        held, emitted = open_windows(spark, c), read_output(spark, o, WINDOWED)
        assert held.columns == emitted.columns == WINDOWED.fieldNames()
        whole = R.windowed(R.enriched(spark, SF_SMALL, params), params, watermark=False)
        both = held.unionByName(emitted)
        assert both.exceptAll(whole).count() == whole.exceptAll(both).count() == 0
        assert held.count() > 5 and held.join(emitted, "window_start").count() == 0


def test_open_windows_of_an_earlier_batch(spark, fresh_dir):
    landing, ckpt = fresh_dir("in"), fresh_dir("c")
    R._in_parts(spark, SF_SMALL, landing)
    await_query(start_windowed(parquet_stream(spark, landing, TRANSACTION, 1), fresh_dir("o"), ckpt))
    first = spark.read.schema(TRANSACTION).parquet(f"{landing}/arrival=0")
    held = open_windows(spark, ckpt, batch=0)  # no watermark yet: all windows of the batch
    assert held.agg(F.sum("event_count")).first()[0] == R.enrich(first).count()


def test_a_replayed_batch_runs_again(spark, fresh_dir):
    landing, out, ckpt = fresh_dir("in"), fresh_dir("o"), fresh_dir("c")
    R._in_parts(spark, SF_SMALL, landing)
    run = lambda: await_query(R.start_enriched(parquet_stream(spark, landing, TRANSACTION, 1), out, ckpt))
    run()
    files = len(data_files(out))
    R._forget_last(spark, f"{ckpt}/commits")
    R._forget_last(spark, f"{out}/_spark_metadata")
    committed = R.enriched(spark, SF_SMALL).count()
    assert 0 < read_output(spark, out, R.ENRICHED).count() < committed
    assert [b for b, _, _ in run().batches()] == [R.PARTS - 1]
    assert len(data_files(out)) > files  # the first attempt's files are still there
    assert read_output(spark, out, R.ENRICHED).count() == committed


def test_landing_in_batches(spark, fresh_dir):
    path = fresh_dir("land")
    rows = spark.range(1000).select("id", (F.col("id") % 4).alias("b"))
    folders = land_in_batches(rows, path, "b", files=3)
    assert [f.rpartition("/")[2] for f in folders] == [f"b={i}" for i in range(4)]
    times = [[os.stat(f).st_mtime for f in data_files(folder)] for folder in folders]
    assert [len(t) for t in times] == [3] * 4 and all(max(a) < min(b) for a, b in zip(times, times[1:]))
    assert spark.read.parquet(path).count() == 1000
    with pytest.raises(ValueError, match="files"):
        land_in_batches(rows.limit(2), fresh_dir("few"), "b", files=50)


# ---- rules that change, whole outputs ---------------------------------------


def test_rule_table_with_a_duplicate_fails_the_batch(spark, fresh_dir):
    landing, out, ckpt, table = fresh_dir("in"), fresh_dir("o"), fresh_dir("c"), fresh_dir("rules")
    R.transactions(spark, SF_SMALL).write.parquet(landing)
    one = rules_frame(spark, {"grocery": 0.5})
    write_full_copy(one.unionAll(one), table)
    rules = lambda session: session.read.parquet(table)
    start = lambda: start_enriched_by_rules(parquet_stream(spark, landing, TRANSACTION), rules, out, ckpt)
    with pytest.raises(Exception, match="duplicate merchant_category"):
        await_query(start())
    write_full_copy(one, table)  # mended: the replay of the same batch takes the new table
    await_query(start())
    got = read_batches(spark, out)
    assert got.columns == R.ENRICHED.fieldNames() and got.count() == R.enriched(spark, SF_SMALL).count()
    assert {(r.merchant_category == "grocery", r.discount_rate) for r in got.collect()} == {(True, 0.5), (False, 0.0)}


def test_a_failed_write_leaves_the_old_copy(spark, fresh_dir):
    path = fresh_dir("copy")
    write_full_copy(spark.range(10), path)
    bad = spark.range(100).select(F.when(F.col("id") < 50, F.col("id")).otherwise(F.raise_error(F.lit("broken")).cast("long")).alias("id"))
    with pytest.raises(Exception, match="broken"):
        write_full_copy(bad, path)
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == list(range(10))
    folder, _, name = local(path).rpartition("/")
    assert [f for f in os.listdir(folder) if f.startswith(f"_{name}")] == []
    # a copy may be made from what is there
    write_full_copy(spark.read.parquet(path).where("id < 4"), path)
    assert spark.read.parquet(path).count() == 4


def test_an_interrupted_swap_is_put_back(spark, fresh_dir):
    path = fresh_dir("copy")
    write_full_copy(spark.range(10), path)
    Store(spark, path).rename(path, hidden_sibling(path, "old"))  # the process died here
    assert recover_folder(spark, path) and not recover_folder(spark, path)
    assert spark.read.parquet(path).count() == 10
    Store(spark, path).rename(path, hidden_sibling(path, "old"))
    write_full_copy(spark.range(3), path)  # does so by itself
    assert spark.read.parquet(path).count() == 3
    with pytest.raises(FileExistsError):
        Store(spark, path).rename(path, path)


def test_landing_evaluates_its_input_once(spark, fresh_dir):
    passed = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            passed.add(batch.num_rows)
            yield batch

    tx = R.transactions(spark, SF_SMALL)
    path = fresh_dir("land")
    land_ndjson(tx.mapInArrow(count, tx.schema), path, 100)
    assert passed.value == 1000
    assert spark.read.text(path).count() == 1000


def test_report_releases_what_it_caches(spark, fresh_dir):
    full = R.enriched(spark, SF_SMALL)
    datasets = report_datasets(full, R.emitted_windows(spark, SF_SMALL), None)
    write_report_datasets(datasets, fresh_dir("report"))
    assert not datasets.shared.is_cached and "status_breakdown" not in datasets


def test_byte_bound_options(spark, fresh_dir):
    from ledgerline.__main__ import main, parse

    args = parse(["--out", "x", "--max-bytes-per-trigger", "64m", "--chained-files-per-trigger", "9", "--max-offsets-per-trigger", "5"])
    assert (args.max_bytes_per_trigger, args.chained_files_per_trigger, args.max_offsets_per_trigger) == ("64m", 9, 5)
    assert [byte_count(x) for x in (7, "7", "2k", "64M", " 1g ")] == [7, 7, 2048, 64 << 20, 1 << 30]
    for bad in ("", "0", "m", "-1", "1x"):
        with pytest.raises(ValueError):
            byte_count(bad)
    landing = fresh_dir("in")
    land_ndjson(R.transactions(spark, SF_SMALL), landing, 100)
    row = main(["--input", landing, "--out", fresh_dir("o"), "--max-bytes-per-trigger", "1"])
    assert row["enriched_batches"] == 10 and row["source_events"] == 1000
    row = main(["--input", landing, "--out", fresh_dir("o"), "--max-bytes-per-trigger", "10m"])
    assert row["enriched_batches"] == 1
