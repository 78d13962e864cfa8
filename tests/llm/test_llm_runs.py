from __future__ import annotations

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerline.llm import queries, runs

SF = "/root/testdata/sf0.001"


def plain_runs(words, least, periods):
    """Runs straight from their definition: for each period, stretches of equal words that far apart."""
    n = len(words)
    number = {}
    ids = np.array([number.setdefault(w, len(number)) for w in words], np.int64)
    found = {}
    for q in range(1, n // periods + 1):
        same = np.concatenate([[False], ids[:-q] == ids[q:], [False]])
        turn = np.flatnonzero(same[1:] != same[:-1])
        for a, b in zip(turn[::2].tolist(), turn[1::2].tolist()):
            span = (a, b + q)
            if span[1] - span[0] >= max(least, periods * q):
                found.setdefault(span, q)  # the smallest period of a stretch comes first
    return sorted(((a, b - a, q) for (a, b), q in found.items()), key=lambda r: (r[0], r[2]))


def rows(found):
    return [tuple(r) for r in found.tolist()]


@settings(max_examples=300, deadline=None)
@given(
    st.lists(st.sampled_from([b"a", b"b", b"c"]), max_size=60),
    st.integers(0, 50),
    st.integers(1, 6),
    st.sampled_from([(2, 2), (4, 2), (6, 3), (24, 3), (10, 4)]),
)
def test_runs_equal_the_definition(words, at, period, least):
    if at < len(words):
        words = [w if i < at else words[min(at + (i - at) % period, len(words) - 1)] for i, w in enumerate(words)]
    assert rows(runs.word_runs(words, *least)) == plain_runs(words, *least)


def test_trees_give_extensions_and_orders():
    rng = random.Random(4)
    for _ in range(30):
        s = [rng.randint(1, 3) for _ in range(rng.randint(2, 60))]
        found = runs.Extensions(s)
        closed = [*s, 0]
        suffixes = sorted(range(len(closed)), key=lambda i: closed[i:])
        assert found.order == suffixes
        turned = sorted(range(len(closed)), key=lambda i: [-x if x else -9 for x in closed[i:]])
        assert found.tree.falling() == turned
        i, j = (x.ravel() for x in np.meshgrid(range(len(s)), range(len(s))))
        i, j = i[i != j], j[i != j]
        plain = [next(k for k in range(len(closed)) if closed[a + k : a + k + 1] != closed[b + k : b + k + 1]) for a, b in zip(i, j)]
        assert found(i, j).tolist() == plain
        smaller = runs.next_smaller(found.order)
        assert smaller.tolist() == [next(k for k in range(a + 1, len(closed)) if closed[k:] < closed[a:]) for a in range(len(s))]


def test_range_minimum():
    rng = np.random.default_rng(1)
    for n in (1, 15, 16, 17, 200, 1000):
        values = rng.integers(0, 100, n)
        lowest = runs.RangeMinimum(values.tolist())
        a, b = np.sort(rng.integers(0, n, (2, 500)), 0)
        assert lowest(a, b).tolist() == [values[x : y + 1].min() for x, y in zip(a, b)]


def test_long_texts():
    rng = random.Random(2)
    base = [b"w%d" % rng.randint(0, 300) for _ in range(30_000)]
    words = [*base[:10_000], *[base[10_000 + i % 7_001] for i in range(25_000)], *base[20_000:], *[b"spam"] * 9_000]
    assert rows(runs.word_runs(words)) == [r for r in rows(runs.word_runs(words)) if r[1] >= max(24, 3 * r[2])]
    assert (54_000 - 9_000, 9_000, 1) in rows(runs.word_runs(words))
    long = [r for r in rows(runs.word_runs(words)) if r[2] == 7_001]
    assert len(long) == 1 and long[0][0] <= 10_000 and long[0][0] + long[0][1] >= 35_000


def expected(doc_id, text):
    words = (text or "").encode().split()
    n = len(words)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    found = plain_runs(words, 24, 3)
    gone = {i for s, length, q in found for i in range(s + q, s + length)}
    best = max(found, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=(None, None, None))
    text = b" ".join(w for i, w in enumerate(words) if i not in gone)
    listed = "".join(f"{s},{length},{q}\n" for s, length, q in found)
    milli = None if best[0] is None else 1000 * best[1] // best[2]
    return (doc_id, len(found), *best, milli, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(text).hexdigest())


def test_query_equals_brute_force(spark):
    got = sorted(tuple(r) for r in queries.op13_runs(spark, SF).collect())
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    assert got == sorted(expected(*r) for r in docs)
    assert sum(r[1] > 0 for r in got) > 5


def test_odd_rows(spark, docs_of, odd_rows, with_clashes, fresh_dir):
    more = [(20, "spam " * 30), (20, "spam " * 30), (21, ("a b c " * 9).strip()), (22, "x y " * 24), (23, "\x0b".join("ab" * 12))]
    # ids whose number calls for a repeated tail, on an empty, a null and a short text
    tailed = [i for i in range(2000) if zlib.crc32(str(i).encode()) % 10 == 0][:4]
    more += [(tailed[0], ""), (tailed[1], None), (tailed[2], "one"), (tailed[3], " ".join(f"w{i}" for i in range(90)))]
    folder = fresh_dir("runs")
    with_clashes(docs_of(odd_rows + more)).write.parquet(f"{folder}/documents.parquet")
    key = lambda r: tuple(str(x) for x in r)
    got = sorted((tuple(r) for r in queries.op13_runs(spark, folder).collect()), key=key)
    assert got == sorted((expected(*r) for r in odd_rows + more), key=key)


def test_operator_gives_spans_and_text(spark, docs_of):
    found = runs.find_runs(docs_of([(1, "start " + "ab cd " * 14 + "end"), (2, None)]))
    one, none = sorted(found.collect())
    assert [tuple(r) for r in one.runs] == [(1, 28, 2)] and one.collapsed == "start ab cd end"
    assert none.runs == [] and none.collapsed == ""
    assert runs.find_runs(docs_of([])).count() == 0
    small = runs.find_runs(docs_of([(1, "a a b a a b")]), 2, 2).first()
    assert [tuple(r) for r in small.runs] == [(0, 2, 1), (0, 6, 3), (3, 2, 1)]
    with pytest.raises(ValueError):
        runs.find_runs(docs_of([]), 1)
