from __future__ import annotations

import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerline.llm import packing


def slow_pack(lengths, sizes, cost):
    """The same rules with every open bin looked at for every piece."""
    bins, offsets, used, cap = [], [], [], []
    for i, x in enumerate(lengths):
        fits = [b for b in range(len(used)) if cap[b] - used[b] >= x]
        if fits:
            least = min(cap[b] - used[b] for b in fits)
            b = opened = [b for b in fits if cap[b] - used[b] == least]
            b = max(opened, key=lambda b: last[b])
        else:
            rest = sorted(lengths[i + 1 :], reverse=True)

            def filled(room):
                total, done = 0, set()
                for y in rest:
                    if y not in done and y <= room - total:
                        total += y * min(rest.count(y), (room - total) // y)
                        done.add(y)
                return total

            s = min((s for s in sorted(sizes) if s >= x), key=lambda s: (cost(s) / (x + filled(s - x)), s))
            b = len(used)
            used.append(0)
            cap.append(s)
            if not b:
                last = {}
        bins.append(b)
        offsets.append(used[b])
        used[b] += x
        last[b] = i
    return bins, offsets, [min(s for s in sizes if s >= u) for u in used]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=60))
def test_equals_a_slow_version(lengths):
    lengths = sorted(lengths, reverse=True)
    sizes = (16, 32, 64)
    assert packing.pack(lengths, sizes) == slow_pack(lengths, sizes, packing.sequence_cost)


def test_costs_no_more_than_one_size():
    rng = random.Random(3)
    lengths = sorted((rng.randint(1, 4096) if rng.random() < 0.3 else rng.randint(1, 400) for _ in range(4000)), reverse=True)
    joint = sum(map(packing.sequence_cost, packing.pack(lengths)[2]))
    single = sum(map(packing.sequence_cost, packing.pack(lengths, (4096,))[2]))
    floor = sum(lengths) * packing.sequence_cost(512) / 512
    assert floor <= joint < single
    assert sum(packing.pack(lengths)[2]) < 1.02 * sum(lengths)


def check(rows, docs, sizes):
    """Bins hold their pieces without overlap, and the pieces of a document are all of it."""
    bins: dict = {}
    for r in rows:
        assert r.bin_size in sizes
        bins.setdefault(r.bin_id, []).append(r)
    for some in bins.values():
        some.sort(key=lambda r: r.bin_offset)
        at = 0
        for r in some:
            assert r.bin_offset == at
            at += r.length + 1
        assert at <= some[0].bin_size and len({r.bin_size for r in some}) == 1
        assert some[0].bin_size == min(s for s in sizes if s >= at)  # downsized
    want, got = {}, {}
    for doc, text in docs:
        n = len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
        want.setdefault(doc, []).append(n)
    for r in rows:
        got.setdefault(r.doc_id, []).append((r.piece, r.start, r.length))
    assert want.keys() == got.keys()
    for doc, ns in want.items():
        assert sum(n for _, _, n in got[doc]) == sum(ns)
        assert sorted(s for _, s, _ in got[doc]) == sorted(s for n in ns for s in range(0, max(n, 1), max(sizes) - 1))


@pytest.mark.parametrize("bucket", [50_000, 7])
def test_places_whole_documents(spark, docs_of, odd_rows, with_clashes, bucket):
    sizes = (16, 64, 256)
    out = packing.pack_documents(with_clashes(docs_of(odd_rows)), sizes, bucket).collect()
    check(out, odd_rows, sizes)


def test_table_and_empty_table(spark, docs_of):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = packing.pack_documents(docs).collect()
    check(out, [(r.doc_id, r.text) for r in docs.collect()], packing.SIZES)
    assert packing.pack_documents(docs_of([])).count() == 0
    with pytest.raises(ValueError):
        packing.pack_documents(docs, sizes=())
