from __future__ import annotations

import json

from pyspark.sql import functions as F

from ledgerline.operators.legacy import legacy
from ledgerline.schemas import LEGACY_TRANSACTION, TRANSACTION_NULLABLE
from ledgerline.sources.payload import decode_json_payload, encode_json_payload
from ledgerline.streaming.jobs import legacy_stream, start_legacy_job

# Published golden run of the older Kafka job: 12 records in, 8 out.
GOLDEN_IN = [
    ("TX12345", "U1001", 250.75, "SUCCESS", "2024-12-05T10:00:00Z"),
    ("TX12346", "U1002", 150.5, "FAILED", "2024-12-05T10:05:00Z"),
    ("TX12347", "U1003", 300.0, "SUCCESS", "2024-12-05T10:10:00Z"),
    ("TX12348", "U1004", 50.25, "PENDING", "2024-12-05T10:15:00Z"),
    ("TX12349", "U1005", 450.0, "SUCCESS", "2024-12-05T10:20:00Z"),
    ("TX12350", "U1006", 120.0, "FAILED", "2024-12-05T10:25:00Z"),
    ("TX12351", "U1007", 520.75, "SUCCESS", "2024-12-05T10:30:00Z"),
    ("TX12352", "U1008", 200.0, "SUCCESS", "2024-12-05T11:00:00Z"),
    ("TX12353", "U1009", 350.5, "SUCCESS", "2024-12-05T11:10:00Z"),
    ("TX12354", "U1010", 100.0, "SUCCESS", "2024-12-05T11:15:00Z"),
    ("TX12355", "U1011", 250.5, "FAILED", "2024-12-05T11:20:00Z"),
    ("TX12356", "U1012", 300.75, "SUCCESS", "2024-12-05T11:25:00Z"),
]
GOLDEN_OUT = {
    "TX12345": "225.675",
    "TX12347": "270.0",
    "TX12349": "405.0",
    "TX12351": "468.675",
    "TX12352": "180.0",
    "TX12353": "315.45",
    "TX12354": "90.0",
    "TX12356": "270.675",
}


def _kafka_frame(spark, records):
    values = [(json.dumps(dict(zip(LEGACY_TRANSACTION.fieldNames(), r))).encode(),) for r in records]
    return spark.createDataFrame(values, "value binary")


def test_legacy_golden(spark):
    raw = _kafka_frame(spark, GOLDEN_IN)
    decoded, transformed, encoded = legacy_stream(raw)
    assert decoded.count() == 12
    rows = {r.transaction_id: r for r in transformed.collect()}
    assert set(rows) == set(GOLDEN_OUT)
    for tid, text in GOLDEN_OUT.items():
        # the console sink prints Java's Double.toString of the value
        assert rows[tid].discounted_amount == rows[tid].amount * 0.9
        assert abs(rows[tid].discounted_amount - float(text)) < 1e-9
    # timestamp stays text
    assert rows["TX12345"].timestamp == "2024-12-05T10:00:00Z"
    first = json.loads(encoded.filter(F.col("value").contains("TX12345")).first().value)
    assert first == {
        "transaction_id": "TX12345", "user_id": "U1001", "amount": 250.75, "status": "SUCCESS",
        "timestamp": "2024-12-05T10:00:00Z", "discounted_amount": 250.75 * 0.9,
    }


def test_legacy_filter_is_case_sensitive(spark):
    raw = _kafka_frame(spark, [("a", "u", 10.0, "success", "t"), ("b", "u", 10.0, "SUCCESS", "t")])
    _, transformed, _ = legacy_stream(raw)
    assert [r.transaction_id for r in transformed.collect()] == ["b"]


def test_json_encode_omits_nulls_and_decode_tolerates_garbage(spark):
    df = spark.createDataFrame([("a", None, 1.0, "SUCCESS", None)], LEGACY_TRANSACTION)
    text = encode_json_payload(df, options={}).first().value
    assert json.loads(text) == {"transaction_id": "a", "amount": 1.0, "status": "SUCCESS"}
    bad = spark.createDataFrame([("{not json",), ('{"transaction_id":"x","status":"SUCCESS"}',)], "value string")
    out = decode_json_payload(bad, TRANSACTION_NULLABLE).collect()
    assert len(out) == 2
    assert all(v is None for v in out[0].asDict().values())
    assert out[1].transaction_id == "x" and out[1].amount is None


def test_legacy_job_with_memory_sinks(spark, fresh_dir):
    landing = fresh_dir("legacy-in")
    _kafka_frame(spark, GOLDEN_IN).write.parquet(landing)
    raw = spark.readStream.schema("value binary").parquet(landing)
    out = fresh_dir("legacy-out")
    queries = start_legacy_job(raw, fresh_dir("ckpt"), debug_format="memory", sink="parquet", out_path=out)
    try:
        for q in queries:
            q.processAllAvailable()
    finally:
        for q in queries:
            q.stop()
    assert spark.table("legacy_input").count() == 12
    assert spark.table("legacy_output").count() == 8
    assert spark.read.parquet(out).count() == 8


def test_legacy_semantics_differ_from_enrichment(spark):
    df = spark.createDataFrame([("a", "u", 100.0, "SUCCESS", "t")], LEGACY_TRANSACTION)
    assert legacy(df).first().discounted_amount == 90.0


def test_legacy_command_line_offline(spark, fresh_dir, tmp_path):
    from ledgerline.__main__ import main

    d = tmp_path / "producer"
    d.mkdir()
    lines = [json.dumps(dict(zip(LEGACY_TRANSACTION.fieldNames(), r))) for r in GOLDEN_IN]
    (d / "transactions.json").write_text("\n".join(lines) + "\n")
    out = fresh_dir("legacy-cli")
    got = main(["--job", "legacy", "--source", "file", "--input", str(d), "--out", out])
    assert got == {"records_written": 8}
    records = [json.loads(r.value) for r in spark.read.parquet(f"{out}/records").collect()]
    assert {r["transaction_id"] for r in records} == set(GOLDEN_OUT)
