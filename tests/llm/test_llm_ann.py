from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerline.llm import ann


def brute(rows, every, k=20):
    """rows of (id, vector) -> (query, rank, id, score), ties to smaller ids."""
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], np.float64)
    out = []
    for q in np.flatnonzero(ids % every == 0):
        score = (x * x[q]).sum(1)
        order = [j for j in np.lexsort((ids, -score)) if j != q][:k]
        out += [(int(ids[q]), r, int(ids[j]), float(score[j])) for r, j in enumerate(order, 1)]
    return out


def recall(got, want):
    near = {(q, i) for q, _, i, _ in want}
    return len({(r.query_id, r.vec_id) for r in got} & near) / len(near)


def clustered(n, dim=24, groups=60, seed=0, radius=None):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(groups, dim))
    if radius:
        centres *= radius / np.linalg.norm(centres, axis=1, keepdims=True)
    x = centres[rng.integers(groups, size=n)] + 0.35 * rng.normal(size=(n, dim))
    return [(int(i), [float(v) for v in row]) for i, row in enumerate(x)]


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>")


def test_recall_and_scores_on_the_table(spark):
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in table.collect()]
    want = brute(rows, 20)
    got = ann.search(table, F.col("vec_id") % 20 == 0).collect()
    assert recall(got, want) >= 0.9
    by = {i: np.array(v, np.float64) for i, v in rows}
    assert all(np.isclose(r.score, by[r.query_id] @ by[r.vec_id], rtol=1e-13, atol=1e-15) for r in got)
    for q in {r.query_id for r in got}:
        mine = sorted((r for r in got if r.query_id == q), key=lambda r: r["rank"])
        assert [r["rank"] for r in mine] == list(range(1, 21))
        assert mine == sorted(mine, key=lambda r: (-r.score, r.vec_id))


def test_few_parts_are_asked_on_clusters(spark):
    rows = clustered(6000)
    router = ann.fit(np.array([v for _, v in rows]), 24)
    assert router.parts == 24 and router.probes <= 12
    got = ann.search(frame(spark, rows), F.col("vec_id") % 20 == 0, part_rows=250, cell_rows=200).collect()
    assert recall(got, brute(rows, 20)) >= 0.9


def test_every_query_gets_its_full_number(spark):
    """Also where most of the nearest lie in parts that aren't asked."""
    rng = np.random.default_rng(9)
    rows = [(i, [float(v) for v in rng.normal(size=16)]) for i in range(4000)]
    got = ann.search(frame(spark, rows), F.col("vec_id") % 20 == 0, sample_rows=3000, part_rows=150, recall=0.3).collect()
    assert len(got) == 200 * 20
    assert 0.2 <= recall(got, brute(rows, 20)) < 0.9


def test_parts_are_balanced():
    x = np.array([v for _, v in clustered(2000)])
    graph = ann._nearest(x, np.arange(len(x)), 8)
    part = ann.balanced_parts(x, graph, 16, np.random.default_rng(0))
    size = np.bincount(part, minlength=16)
    assert size.max() <= np.ceil(1.1 * 2000 / 16) and (part >= 0).all()
    within = (part[graph] == part[:, None]).mean()
    assert within > 0.5  # by chance 1 / 16


def test_ties_copies_and_odd_vectors(spark, with_clashes):
    rng = np.random.default_rng(3)
    good = [(i, [float(v) for v in rng.normal(size=8)]) for i in range(300)]
    copy = [0.5] * 8
    good += [(1000 + i, copy) for i in range(150)]
    odd = [(5000, None), (5001, [0.0] * 8), (5002, [1.0] * 7 + [None]), (5003, [1.0] * 7 + [float("nan")]),
           (5004, [float("inf")] * 8), (5005, []), (5006, [1.0, 2.0]), (5020, [1.0, 2.0, 3.0]), (None, [1.0] * 8)]
    df = with_clashes(frame(spark, good + odd))
    got = ann.search(df, F.col("vec_id") % 20 == 0, part_rows=10**6, cell_rows=100, recall=1.0)
    want = brute(good, 20)
    rows = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got.collect())
    assert [r[:3] for r in rows] == [w[:3] for w in sorted(want)]
    assert np.allclose([r[3] for r in rows], [w[3] for w in sorted(want)], rtol=1e-13)


@pytest.mark.parametrize("n", [0, 1, 5, 21])
def test_small_tables(spark, n):
    rows = clustered(n, dim=6) if n else []
    got = ann.search(frame(spark, rows), F.col("vec_id") % 20 == 0).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id) for r in got) == sorted(w[:3] for w in (brute(rows, 20) if n else []))


def test_repeated_ids_and_other_lengths_keep_their_rows(spark):
    rng = np.random.default_rng(5)
    vector = lambda d: [float(v) for v in rng.normal(size=d)]
    long, short = [(i % 200, vector(8)) for i in range(300)], [(i, vector(3)) for i in range(300, 420)]
    rows = long + [long[20]] + short  # ids 0 to 99 twice with other vectors, 20 a third time with an equal one
    got = ann.search(frame(spark, rows), F.col("vec_id") % 20 == 0, cell_rows=50, recall=1.0).collect()
    want = sorted(brute(long + [long[20]], 20) + brute(short, 20))
    assert sorted((r.query_id, r["rank"], r.vec_id) for r in got) == sorted(w[:3] for w in want)
    assert np.allclose(sorted(r.score for r in got), sorted(w[3] for w in want), rtol=1e-12)
    assert len([r for r in got if r.query_id == 20]) == 3 * 20 and (20, 20) in {(r.query_id, r.vec_id) for r in got}
    assert {r.scored for r in got if r.query_id >= 300} == {120}


def test_one_id_and_one_vector_for_a_third_of_the_rows(spark):
    rows = clustered(1500) + [(40, [3.0] * 24)] * 700
    df = frame(spark, rows).repartition(5)
    got = ann.search(df, F.col("vec_id") % 100 == 0, part_rows=200, cell_rows=100).collect()
    ask = [i for i, _ in rows if i % 100 == 0]
    assert len(got) == 20 * len(ask)
    got = ann.search(df, F.col("vec_id") == 40, part_rows=200, cell_rows=100).collect()
    assert len(got) == 20 * 701 and sum(r.query_id == r.vec_id for r in got) >= 20 * 700


def test_vectors_scored_grow_slower_than_the_table(spark, monkeypatch):
    """Parts are cut again where they stay large, so ten times the rows aren't ten times the work of a query."""
    monkeypatch.setattr(ann, "MAX_PARTS", 16)
    scored = {}
    for n in (2000, 20_000):
        rows = clustered(n, groups=n // 50, seed=n, radius=6)
        got = ann.search(frame(spark, rows), F.col("vec_id") % 100 == 0, sample_rows=2000, part_rows=100).collect()
        x = np.array([v for _, v in rows])
        near = {(q, int(j)) for q in range(0, n, 100) for j in np.argsort(-np.where(np.arange(n) == q, -np.inf, x @ x[q]))[:20]}
        assert len({(r.query_id, r.vec_id) for r in got} & near) / len(near) >= 0.9
        scored[n] = np.mean([r.scored for r in got if r["rank"] == 1])
    assert scored[20_000] < 5 * scored[2000]
