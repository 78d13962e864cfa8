from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from ledgerline.llm import toxicity

SF = "/root/testdata/sf0.1"


def slow_fit(rows, labels):
    """FTRL-proximal one coordinate at a time."""
    from math import copysign, exp, sqrt

    z: dict = {}
    n: dict = {}
    bias, grads = float(np.log((sum(labels) + 0.5) / (len(labels) - sum(labels) + 0.5))), 1.0
    order = np.random.default_rng(7)

    def weight(i):
        if abs(z.get(i, 0.0)) <= toxicity.L1:
            return 0.0
        zi = z[i]
        return (copysign(toxicity.L1, zi) - zi) / ((toxicity.BETA + sqrt(n[i])) / toxicity.ALPHA + toxicity.L2)

    for _ in range(toxicity.EPOCHS):
        for r in order.permutation(len(rows)):
            w = {int(i): weight(int(i)) for i in rows[r]}
            g = 1 / (1 + exp(-(sum(w.values()) + bias))) - labels[r]
            for i, wi in w.items():
                s = (sqrt(n.get(i, 0.0) + g * g) - sqrt(n.get(i, 0.0))) / toxicity.ALPHA
                z[i] = z.get(i, 0.0) + g - s * wi
                n[i] = n.get(i, 0.0) + g * g
            grads += g * g
            bias -= 0.05 * g / sqrt(grads)
    return {i: weight(i) for i in z if weight(i)}, bias


def test_fit_equals_a_slow_version():
    rng = np.random.default_rng(1)
    rows = [np.unique(rng.integers(0, 50, 12)) for _ in range(120)]
    labels = [int((r < 6).any()) for r in rows]
    model = toxicity.fit(rows, labels)
    want, bias = slow_fit(rows, labels)
    assert np.isclose(model.bias, bias)
    assert {int(i): round(float(v), 4) for i, v in zip(model.index, model.value)} == {i: round(v, 4) for i, v in want.items()}


def test_features_do_not_depend_on_blocks(monkeypatch):
    text = b"You, ARE a b-c d e f g h i j k l m n o p " * 9
    whole = np.concatenate(list(toxicity._buckets(text, toxicity._Memo())))
    monkeypatch.setattr(toxicity, "_BLOCK", 7)
    parts = np.concatenate(list(toxicity._buckets(text, toxicity._Memo())))
    assert sorted(whole) == sorted(parts)
    assert list(toxicity._buckets(b"", toxicity._Memo())) == [] and len(next(toxicity._buckets(b"one", toxicity._Memo()))) == 1


def test_held_out_quality(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    out = toxicity.toxicity(docs, labels).join(labels, "doc_id").where("held_out").collect()
    toxic = [r for r in out if r.toxic]
    clean = [r for r in out if not r.toxic]
    english = docs.where("lang = 'en'")
    words = {r.doc_id for r in english.select("doc_id").collect()}
    recall = np.mean([r.predicted for r in toxic])
    assert recall >= 0.78, recall  # few labels in the other languages at this size
    assert np.mean([r.predicted for r in toxic if r.doc_id in words]) >= 0.9
    assert np.mean([r.predicted for r in clean]) <= 0.01
    rank = np.argsort(np.argsort([r.score for r in out]))
    auc = (sum(rank[i] for i, r in enumerate(out) if r.toxic) - len(toxic) * (len(toxic) - 1) / 2) / (len(toxic) * len(clean))
    assert auc > 0.95, auc


def test_labels_of_held_out_rows_teach_nothing(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    turned = labels.withColumn("toxic", F.when(held, 1 - F.col("toxic")).otherwise(F.col("toxic")).cast("int"))
    a, b = toxicity.train(docs, labels), toxicity.train(docs, turned)
    assert a.bias == b.bias and (a.index == b.index).all() and a.rows == b.rows < labels.count()


def test_odd_rows(spark, docs_of, odd_rows, with_clashes):
    rows = odd_rows + [(100 + i, f"you {'scum' if i % 3 == 0 else 'friend'} number {i}") for i in range(90)]
    docs = with_clashes(docs_of(rows))
    marks = [(100 + i, int(i % 3 == 0)) for i in range(90)] + [(4, 1), (None, 1), (1, None), (2, 7), (100, 1)]
    labels = with_clashes(spark.createDataFrame(marks, "doc_id long, toxic int"))
    out = toxicity.toxicity(docs, labels)
    assert out.columns == ["doc_id", "held_out", "score", "predicted"] and out.count() == len(rows)
    got = out.collect()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    assert all(r.predicted == int((r.doc_id - 100) % 3 == 0) for r in got if r.doc_id and r.doc_id >= 100)
    empty = {r.score for r in got if r.doc_id in (4, 5, 6)}
    assert len(empty) == 1
    kept = toxicity.drop_toxic(docs, labels)
    assert kept.columns == docs.columns
    assert kept.count() == sum(not r.predicted for r in got)


def test_no_labels_and_no_rows(spark, docs_of):
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    out = toxicity.toxicity(docs_of([(1, "some text"), (2, None)]), labels).collect()
    assert {(r.score, r.predicted) for r in out} == {(0.0, 0)}
    assert toxicity.toxicity(docs_of([]), labels).count() == 0


def test_long_documents_teach_all_their_features(spark, docs_of):
    text = " ".join(f"w{i}" for i in range(30_000))
    labels = spark.createDataFrame([(1, 1)], "doc_id long, toxic int")
    (row,) = toxicity.training_rows(docs_of([(1, text)]), labels).collect()
    whole = np.unique(np.concatenate(list(toxicity._buckets(text.encode(), toxicity._Memo()))))
    assert row.features == whole.tolist() and len(whole) > 1 << 15


def test_the_sample_is_bounded_by_its_features(spark, docs_of):
    docs = docs_of([(i, " ".join(f"w{i}x{j}" for j in range(50))) for i in range(400)])
    labels = spark.createDataFrame([(i, i % 2) for i in range(400)], "doc_id long, toxic int")
    whole = toxicity.training_rows(docs, labels).collect()
    some = toxicity.training_rows(docs, labels, train_features=5_000).collect()
    assert 0 < len(some) < len(whole) and sum(len(r.features) for r in some) <= 5_000 < sum(len(r.features) for r in some) + 200
    by_id = {r.doc_id: r for r in whole}
    assert all(r == by_id[r.doc_id] for r in some)  # rows are whole
    again = toxicity.training_rows(docs.repartition(7), labels, train_features=5_000).collect()
    assert sorted(r.doc_id for r in again) == sorted(r.doc_id for r in some)
    assert toxicity.train(docs, labels, train_features=5_000).rows == len(some)
    assert toxicity.training_rows(docs, labels, train_features=10).count() == 0


def test_a_repeated_id_teaches_once(spark, docs_of):
    docs = docs_of([(1, "first text")] * 50 + [(1, "second text")] * 50)
    labels = spark.createDataFrame([(1, 1)], "doc_id long, toxic int")
    (row,) = toxicity.training_rows(docs, labels).collect()
    assert len(row.features) == 3
