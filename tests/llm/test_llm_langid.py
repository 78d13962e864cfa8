from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from ledgerline.llm import langid


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = langid.language(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert len(out) > 150
    assert np.mean([r.lang == r.lang_pred for r in out]) >= 0.96
    assert all(0 <= r.score <= 1 for r in out)


def test_learns_a_planted_byte_string():
    rng = np.random.default_rng(0)
    windows = rng.integers(1, 60, (1000, langid.WINDOW)).astype(np.uint8)
    windows[:500, 5:9] = [70, 71, 72, 73]
    labels = np.repeat([0, 1], 500)
    net = langid.fit(windows[::2], labels[::2], ["a", "b"])
    found = langid.predict_windows(net, net.tables(), windows[1::2])
    assert (found.argmax(1) == labels[1::2]).all()


def test_tables_equal_the_plain_network():
    rng = np.random.default_rng(1)
    windows = rng.integers(0, 256, (16, langid.WINDOW)).astype(np.uint8)
    net = langid.fit(windows, np.arange(16) % 3, ["x", "y", "z"])
    vectors = net.embed[windows]
    peaks = []
    for bank in net.taps:
        span = langid.WINDOW - len(bank) + 1
        heard = np.stack([np.einsum("jre,jef->rf", vectors[:, i : i + len(bank)].transpose(1, 0, 2), bank) for i in range(span)], 1)
        peaks.append(heard.max(1))
    out = langid._softmax(np.maximum(np.concatenate(peaks, 1) + net.shift, 0) @ net.out + net.out_shift)
    assert np.allclose(out, langid.predict_windows(net, net.tables(), windows), atol=1e-4)


def test_the_whole_text_counts():
    rng = np.random.default_rng(2)
    windows = np.where(np.arange(200)[:, None] % 2, 97, 98).astype(np.uint8) + rng.integers(0, 2, (200, langid.WINDOW)).astype(np.uint8) * 10
    net = langid.fit(windows, np.arange(200) % 2, ["a", "b"])
    texts = [bytes(windows[0]) * 3 + bytes(windows[1]), bytes(windows[0]), bytes(windows[1]) * 30 + bytes(windows[0])[:9]]
    got = langid.predict(net, texts)
    one, two = langid.predict(net, [bytes(windows[0])])[0], langid.predict(net, [bytes(windows[1])])[0]
    assert np.allclose(got[0], (3 * one + two) / 4, atol=1e-5) and np.allclose(got[1], one, atol=1e-5) and got[2].argmax() == two.argmax()


def test_odd_rows(spark, docs_of, odd_rows, with_clashes):
    base = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    odd = docs_of([(d and d + 10**6, t, None) for d, t in odd_rows] + [(2 * 10**6, "1234 !! 56"), (2 * 10**6 + 1, "☃☃")])
    docs = with_clashes(base.unionByName(odd))
    out = langid.language(docs)
    assert out.columns == ["doc_id", "held_out", "lang_pred", "score"] and out.count() == docs.count()
    und = {r.doc_id for r in out.where("lang_pred = 'und'").collect()}
    assert {10**6 + 4, 10**6 + 5, 10**6 + 6, 2 * 10**6, 2 * 10**6 + 1} <= und
    assert out.where("lang_pred = 'und' AND score <> 0").count() == 0
    same = out.where(F.col("doc_id").isin(10**6 + 1, 10**6 + 2)).select("lang_pred", "score").distinct()
    assert same.count() == 1
    kept = langid.drop_unknown_language(docs)
    assert kept.columns == docs.columns
    assert not {r.doc_id for r in kept.select("doc_id").collect()} & (und - {None})
    assert base.join(kept, "doc_id", "left_anti").count() <= 2


def test_nothing_to_learn_from(spark, docs_of):
    out = langid.language(docs_of([(1, "some text", None), (2, None, None)])).collect()
    assert {(r.lang_pred, r.score) for r in out} == {("und", 0.0)}
    assert langid.language(docs_of([])).count() == 0
    one = langid.language(docs_of([(i, f"text {i}", "xx") for i in range(8)])).collect()
    assert {r.lang_pred for r in one} == {"xx"}


def test_lang_is_no_input(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    net = langid.train(docs)
    a = langid.identify(docs.select("doc_id", "text"), net).select("doc_id", "lang_pred", "score")
    b = langid.identify(docs.select(F.col("doc_id"), "text", F.lit("zz").alias("lang")), net).select("doc_id", "lang_pred", "score")
    assert a.exceptAll(b).count() == 0


def test_gradients_equal_differences():
    """The hand-written gradients against finite differences of the loss, in double precision."""
    rng = np.random.default_rng(3)
    k = len(langid.WIDTHS) * langid.FILTERS
    net = langid.Network(
        ["a", "b", "c"],
        rng.normal(0, 0.5, (256, langid.EMBED)),
        [rng.normal(0, 0.3, (w, langid.EMBED, langid.FILTERS)) for w in langid.WIDTHS],
        rng.normal(0, 0.1, k),
        rng.normal(0, 0.3, (k, 3)),
        rng.normal(0, 0.1, 3),
    )
    x, y = rng.integers(0, 256, (7, langid.WINDOW)), rng.integers(0, 3, 7)

    def loss():
        pooled = np.concatenate(
            [
                sum(net.embed[x][:, j : j + langid.WINDOW - len(bank) + 1] @ tap for j, tap in enumerate(bank)).max(1)
                for bank in net.taps
            ],
            1,
        )
        told = langid._softmax(np.maximum(pooled + net.shift, 0) @ net.out + net.out_shift)
        return -np.log(told[np.arange(len(y)), y]).mean()

    params = [net.embed, *net.taps, net.shift, net.out, net.out_shift]
    for param, grad in zip(params, langid.gradients(net, x, y)):
        assert param.shape == grad.shape
        flat, step = param.reshape(-1), 1e-6
        strong = np.argsort(-np.abs(grad.reshape(-1)))[:12]
        for i in {*strong.tolist(), *rng.integers(0, flat.size, 12).tolist()}:
            kept = flat[i]
            flat[i] = kept + step
            above = loss()
            flat[i] = kept - step
            below = loss()
            flat[i] = kept
            assert abs((above - below) / (2 * step) - grad.reshape(-1)[i]) < 1e-5, i
