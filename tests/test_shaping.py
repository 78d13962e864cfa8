from __future__ import annotations

from pyspark.sql import functions as F

from ledgerline.operators import shaping as S
from ledgerline.plans.registry import events, transactions
from tests.conftest import SF_SMALL


def test_weighted_pick_matches_cumulative_rule(spark):
    df = spark.range(-3, 104).select(F.col("id").cast("int").alias("d"), F.lit(None).cast("int").alias("n"))
    got = {r.d: r.label for r in df.select("d", S.weighted_pick("d", S.CHANNEL_WEIGHTS).alias("label")).collect()}
    for d, label in got.items():
        expected = "mobile" if d < 45 else "web" if d < 73 else "pos" if d < 95 else "api"
        assert label == expected, d
    assert df.select(S.weighted_pick("n", S.CHANNEL_WEIGHTS)).first()[0] == "api"


def test_shares_are_close_to_weights(spark):
    t = transactions(spark, "/root/testdata/sf0.01")
    n = t.count()
    shares = {r.channel: r["count"] / n for r in t.groupBy("channel").count().collect()}
    for label, w in S.CHANNEL_WEIGHTS:
        assert abs(shares[label] - w / 100) < 0.03


def test_amount_bounds_and_ids(spark):
    t = transactions(spark, SF_SMALL)
    r = t.agg(F.min("amount").alias("lo"), F.max("amount").alias("hi")).first()
    assert r.lo >= 4.0 and r.hi <= 4500.0
    ids = [x.transaction_id for x in t.orderBy("transaction_id").limit(2).collect()]
    assert ids == ["txn_0000000", "txn_0000001"]


def test_ids_are_not_truncated(spark):
    df = spark.createDataFrame([(123456789012,), (None,)], "i bigint")
    got = [r[0] for r in df.select(S.transaction_id("i", seed=42)).collect()]
    assert got == ["txn_42_123456789012", None]


def test_uplift_only_on_labelled_rows(spark):
    from ledgerline.sources.events import keyed_transactions

    k = keyed_transactions(events(spark, SF_SMALL))
    out = k.select("is_fraud", "amount", S.uplifted_amount("amount", "event_id", "is_fraud").alias("up"))
    assert out.filter((F.col("is_fraud") == 0.0) & (F.col("up") != F.col("amount"))).count() == 0
    ratio = out.filter(F.col("is_fraud") == 1.0).select((F.col("up") / F.col("amount")).alias("r"))
    b = ratio.agg(F.min("r").alias("lo"), F.max("r").alias("hi")).first()
    assert 1.14 <= b.lo and b.hi < 2.21


def test_weighted_pick_null_column_draw(spark):
    df = spark.createDataFrame([(None,), (5,), (99,), (1000,), (-7,)], "n int")
    got = [r[0] for r in df.select(S.weighted_pick("n", S.CHANNEL_WEIGHTS)).collect()]
    assert got == ["api", "mobile", "api", "api", "mobile"]


def test_zero_pad_matches_python_format(spark):
    vals = [0, 7, 1234567, 12345678, -5, -123456789, None]
    df = spark.createDataFrame([(v,) for v in vals], "i bigint")
    got = [r[0] for r in df.select(S.zero_pad("i", 7)).collect()]
    assert got == [None if v is None else f"{v:07d}" for v in vals]


def test_expressions_compose_to_the_adapter(spark):
    from ledgerline.sources.events import base_amount, keyed_transactions, with_dimensions

    ev = events(spark, SF_SMALL)
    dims = with_dimensions(ev).withColumn("amount", S.shape_amount(base_amount()))
    shaped = S.with_risk_probability(dims)
    got = shaped.select("event_id", "amount", S.fraud_label("event_id", F.col("fraud_probability_units")).alias("is_fraud"))
    ref = keyed_transactions(ev).select("event_id", "amount", "is_fraud")
    assert got.exceptAll(ref).count() == 0 and ref.exceptAll(got).count() == 0
    raised = got.withColumn("up", S.uplifted_amount("amount", "event_id", "is_fraud"))
    assert raised.where("is_fraud = 0 AND up <> amount").count() == 0


def test_status_shares(spark):
    got = {r.status: r["count"] for r in spark.range(100).select(S.weighted_status("id").alias("status")).groupBy("status").count().collect()}
    assert got == dict(S.STATUS_WEIGHTS)


def test_table_source_switch(spark, fresh_dir):
    from ledgerline.params import JobParams
    from ledgerline.sources.readers import read_transactions

    path = fresh_dir("tx")
    transactions(spark, SF_SMALL).write.parquet(path)
    df = read_transactions(spark, JobParams(), path, source="TABLE")
    assert df.isStreaming and df.columns == transactions(spark, SF_SMALL).columns


def test_adapter_survives_extreme_inputs(spark):
    from ledgerline.sources.events import transactions_from_events

    rows = [
        (2**62, None, 1, "view", float("nan"), '{"k": 5}'),
        (-7, None, -3, "click", float("inf"), "not json"),
        (3, None, 4, None, 1e300, None),
    ]
    df = spark.createDataFrame(rows, "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string")
    out = {r.transaction_id: r for r in transactions_from_events(df).collect()}
    assert out[f"txn_{2**62}"].amount is None  # NaN value -> null amount, no failure
    assert out["txn_-000007"].amount is None and out["txn_-000007"].merchant_category == "luxury"
    assert out["txn_0000003"].amount is None and out["txn_0000003"].status == "SUCCESS"
    assert all(r.channel in ("mobile", "web", "pos", "api") for r in out.values())
