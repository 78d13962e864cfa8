from __future__ import annotations

import math
from datetime import datetime
from itertools import product

import pytest

from ledgerline.operators.enrich import enrich, enrich_with_rules, rules_frame, score_components
from ledgerline.params import JobParams
from ledgerline.schemas import ENRICHED_COLUMNS, TRANSACTION, TRANSACTION_NULLABLE

T0 = datetime(2026, 1, 1, 9)


def tx(id_, amount=100.0, status="SUCCESS", category="grocery", channel="mobile", country="US", is_fraud=0.0, when=T0):
    return (id_, "user_1", amount, "USD", status, category, channel, country, when, is_fraud)


def test_reference_unit_rows(spark):
    params = JobParams(discount_rules={"grocery": 0.10, "luxury": 0.20}, fraud_threshold=0.65)
    rows = [
        tx("txn_1", 100.0, "SUCCESS", "grocery", "mobile", "US", 0.0),
        tx("txn_2", 250.0, "FAILED", "grocery", "web", "US", 0.0, datetime(2026, 1, 1, 9, 1)),
        tx("txn_3", 900.0, "SUCCESS", "luxury", "api", "GB", 1.0, datetime(2026, 1, 1, 9, 2)),
    ]
    out = enrich(spark.createDataFrame(rows, TRANSACTION), params).orderBy("transaction_id").collect()
    assert [r.transaction_id for r in out] == ["txn_1", "txn_3"]
    assert out[0].net_amount == pytest.approx(90.0)
    assert out[1].net_amount == pytest.approx(720.0)
    assert out[0].fraud_score == pytest.approx(0.11)
    assert out[1].fraud_score == pytest.approx(0.96)
    assert out[0].is_flagged is False and out[1].is_flagged is True
    assert list(out[0].asDict()) == ENRICHED_COLUMNS


# Published result rows.
def test_published_enriched_rows(spark):
    # amount, category, channel, country -> rate, net (2 dp), score (4 dp)
    cases = [
        (100.05, "grocery", "web", "DE", 0.03, 97.05, 0.23),
        (356.88, "luxury", "mobile", "US", 0.04, 342.60, 0.28),
        (117.49, "travel", "web", "US", 0.05, 111.62, 0.175),
        (12.45, "pharmacy", "mobile", "CA", 0.02, 12.20, 0.165),
        (258.37, "luxury", "api", "US", 0.04, 248.04, 0.345),
        (61.76, "grocery", "pos", "US", 0.03, 59.91, 0.11),
        (13.68, "dining", "web", "FR", 0.10, 12.31, 0.23),
        (79.46, "luxury", "pos", "US", 0.04, 76.28, 0.20),
    ]
    rows = [tx(f"t{i}", a, "SUCCESS", c, ch, co) for i, (a, c, ch, co, *_) in enumerate(cases)]
    out = {r.transaction_id: r for r in enrich(spark.createDataFrame(rows, TRANSACTION)).collect()}
    for i, (_, _, _, _, rate, net, score) in enumerate(cases):
        r = out[f"t{i}"]
        assert r.discount_rate == rate
        assert round(r.net_amount, 2) == pytest.approx(net)
        assert round(r.fraud_score, 4) == pytest.approx(score)
        assert r.is_flagged is False


def _py_score(amount, category, channel, country, is_fraud, hv=450.0):
    a = 0.20 if amount >= hv else (0.10 if amount >= hv * 0.55 else 0.02)
    c = 0.11 if category in ("electronics", "luxury") else 0.02
    ch = 0.09 if channel in ("web", "api") else 0.025
    x = 0.07 if country != "US" else 0.015
    raw = 0.03 + a + c + ch + x + (is_fraud or 0.0) * 0.46
    return min(1.0, max(0.0, raw))


def test_full_score_table_and_borders(spark):
    amounts = [100.0, 247.50, 247.51, 449.99, 450.0, 900.0]
    combos = list(product(amounts, ["grocery", "luxury"], ["mobile", "web"], ["US", "GB"], [0.0, 1.0]))
    rows = [tx(f"c{i}", a, "SUCCESS", c, ch, co, f) for i, (a, c, ch, co, f) in enumerate(combos)]
    out = {r.transaction_id: r for r in enrich(spark.createDataFrame(rows, TRANSACTION)).collect()}
    assert len(out) == len(combos)
    for i, combo in enumerate(combos):
        expected = _py_score(*combo)
        assert out[f"c{i}"].fraud_score == expected  # bit-equal: same order of additions
        assert out[f"c{i}"].is_flagged is (expected >= 0.65)


def test_exact_threshold_is_inclusive(spark):
    # 0.03 + 0.10 + 0.02 + 0.025 + 0.015 + 0.46 == 0.65 exactly in doubles
    row = tx("edge", 300.0, "SUCCESS", "grocery", "mobile", "US", 1.0)
    r = enrich(spark.createDataFrame([row], TRANSACTION)).first()
    assert r.fraud_score == 0.65
    assert r.is_flagged is True


def test_247_50_is_low_risk_247_51_medium(spark):
    rows = [tx("a", 247.50), tx("b", 247.51)]
    comp = {r.transaction_id: r for r in score_components(spark.createDataFrame(rows, TRANSACTION)).collect()}
    assert comp["a"].amount_risk == 0.02
    assert comp["b"].amount_risk == 0.10


def test_null_nan_and_status_edges(spark):
    rows = [
        tx("lower", status="success"),
        tx("padded", status=" SUCCESS "),
        tx("nullstatus", status=None),
        tx("nullamount", amount=None),
        tx("nanamount", amount=float("nan")),
        tx("nullcat", category=None),
        tx("unknowncat", category="toys"),
        tx("nullchannel", channel=None),
        tx("nullcountry", country=None),
        tx("nullfraud", is_fraud=None),
        tx("nanfraud", is_fraud=float("nan")),
        tx("negfraud", is_fraud=-1.0),
        tx("bigfraud", is_fraud=3.0),
        tx("nulltime", when=None),
    ]
    df = spark.createDataFrame(rows, TRANSACTION_NULLABLE)
    out = {r.transaction_id: r for r in enrich(df).collect()}
    assert "padded" not in out and "nullstatus" not in out
    assert out["lower"].status == "SUCCESS"
    assert out["nullamount"].net_amount is None
    assert out["nullamount"].fraud_score == _py_score(0.0, "grocery", "mobile", "US", 0.0)
    assert math.isnan(out["nanamount"].net_amount)
    assert out["nanamount"].fraud_score == 0.03 + 0.20 + 0.02 + 0.025 + 0.015
    assert out["nullcat"].discount_rate == 0.0 and out["unknowncat"].discount_rate == 0.0
    assert out["nullchannel"].fraud_score == out["lower"].fraud_score
    assert out["nullcountry"].fraud_score == out["lower"].fraud_score
    assert out["nullfraud"].fraud_score == out["lower"].fraud_score and out["nullfraud"].is_flagged is False
    assert out["nanfraud"].fraud_score == 1.0
    assert out["negfraud"].fraud_score == 0.0
    assert out["bigfraud"].fraud_score == 1.0
    assert out["nulltime"].event_time is None


def test_empty_rule_set_gives_zero_rate(spark):
    df = spark.createDataFrame([tx("a", category="grocery")], TRANSACTION)
    r = enrich(df, JobParams(discount_rules={})).first()
    assert r.discount_rate == 0.0 and r.net_amount == 100.0


def test_rule_table_join_equals_map_lookup(spark):
    from tests.conftest import SF_SMALL
    from ledgerline.plans.registry import transactions

    t = transactions(spark, SF_SMALL)
    params = JobParams()
    a = enrich(t, params)
    b = enrich_with_rules(t, rules_frame(spark, params.discount_rules), params)
    assert a.count() == b.count()
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_rule_table_with_duplicate_keys_is_rejected(spark):
    df = spark.createDataFrame([tx("a")], TRANSACTION)
    rules = spark.createDataFrame([("grocery", 0.1), ("grocery", 0.2)], "merchant_category string, discount_rate double")
    out = enrich_with_rules(df, rules)  # no job yet
    with pytest.raises(Exception, match="duplicate merchant_category"):
        out.collect()


def test_rule_table_beyond_the_broadcast_threshold_is_shuffled(spark):
    df = spark.createDataFrame([tx("a")], TRANSACTION)
    rules = rules_frame(spark, {"grocery": 0.1})
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        out = enrich_with_rules(df, rules)
        assert "SortMergeJoin" in out._jdf.queryExecution().executedPlan().toString()
        assert out.first().discount_rate == 0.1
    finally:
        spark.conf.set(key, before)
    nulls = spark.createDataFrame([(None, 0.5), (None, 0.6), ("grocery", 0.1)], "merchant_category string, discount_rate double")
    assert enrich_with_rules(df, nulls).first().discount_rate == 0.1


def test_batch_plan_has_no_shuffle_and_prunes_columns(spark):
    from tests.conftest import SF_SMALL
    from ledgerline.plans.registry import enriched

    plan = enriched(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    assert "WholeStageCodegen" in plan or "*(" in plan
