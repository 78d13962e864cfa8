from __future__ import annotations

import re
from collections import Counter
from itertools import permutations

import duckdb
import numpy as np

from ledgerline.llm import filter_audit, queries
from tools.compare import digest

SF = "/root/testdata/sf0.001"
LABELS = "doc_id long, quality int, toxic int"


def fails(docs):
    """The failed filters of each (doc_id, text, source), straight from their wording."""
    out = []
    least = {}
    for i, text, _ in docs:
        if i is not None:
            least[text or ""] = min(least.get(text or "", i), i)
    for i, text, _ in docs:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        told = ""
        told += "A" * (len(words) < 200)
        told += "B" * (100 * len(set(words)) < 50 * len(words))
        told += "C" * (100 * len(re.findall("[A-Z]", text)) > 2 * len(text))
        told += "D" * bool(re.search("[#$%&*|]", text))
        told += "E" * (i is not None and i > least[text])
        out.append(told)
    return out


def brute(docs, labels):
    """Every order applied to every document, one after another."""
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    parts = {s or "" for _, _, s in docs}
    told = fails(docs)
    out, removals = {}, Counter()
    for order in map("".join, permutations("ABCDE")):
        for part in parts:
            left = [k for k, d in enumerate(docs) if (d[2] or "") == part]
            away = []
            alone = Counter(told[k] for k in left if len(told[k]) == 1)
            for step, name in enumerate(order, 1):
                gone = [k for k in left if name in told[k]]
                left = [k for k in left if name not in told[k]]
                out[part, order, step] = (
                    len(left), len(gone), sum(name in told[k] for k in away), alone[name],
                    sum(docs[k][0] in good for k in gone), sum(docs[k][0] in toxic for k in gone),
                )
                removals[part, name] += len(gone)
                away += gone
    return sorted((*k, *v, removals[k[0], k[1][k[2] - 1]]) for k, v in out.items())


def frame(spark, docs):
    rows = [(i, text, "en", source, 0) for i, text, source in docs]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


def result(df):
    return sorted(tuple(r) for r in df.collect())


def test_wide_numbers_hold_each_outcome():
    for mask in (0, 1, 0b10110, 31):
        fields = filter_audit.unpack(filter_audit.wide(mask))
        kept, removed, redundant, alone = np.moveaxis(fields, 2, 0)
        assert (removed.sum(1) == bool(mask)).all() and (kept[:, -1] == (mask == 0)).all()
        assert (removed + redundant).sum() == 120 * mask.bit_count()
        assert alone.sum() == 120 * (mask.bit_count() == 1)


def test_sums_do_not_run_over():
    n = (1 << 62) + 12345  # more rows than any table has
    total = filter_audit.wide(5) * n + filter_audit.wide(4) * 7 + filter_audit.wide(0) * (1 << 60)
    fields = filter_audit.unpack(total)
    order = filter_audit.ORDERS.index("ABCDE")
    assert fields[order, 0].tolist() == [7 + (1 << 60), n, 0, 0]
    assert fields[order, 2].tolist() == [1 << 60, 7, n, 7]


def test_audit_equals_brute_force(spark, with_clashes):
    long = " ".join(f"w{i}" for i in range(250))
    poor = "same words again " * 80
    docs = [
        (1, "a short text", "x"), (2, "a short text", "y"), (3, "a short text", "x"), (3, "a short text", "x"),
        (4, long, "x"), (5, long, None), (6, long + " 100%", "y"), (7, long.upper(), "y"), (8, poor, ""), (9, poor, "x"),
        (10, None, "x"), (11, "", "y"), (12, " \n\t ", "y"), (None, "a short text", "x"), (None, None, None), (None, "only here", "y"),
        (-4, long, "z"), (20, "Ünï☃ 𝄞 " * 210, "z"), (21, "A " * 300, "z"), (22, "x y " * 300, "z"), (23, "w\x0b" * 400, "z"),
    ]
    labels = [(1, 1, 0), (2, 0, 1), (3, 1, 1), (3, 0, 0), (5, 1, None), (9, None, 1), (None, 1, 1), (99, 1, 1)]
    got = filter_audit.audit(with_clashes(frame(spark, docs)), spark.createDataFrame(labels, LABELS))
    assert result(got) == brute(docs, labels)


def test_empty_tables(spark):
    none = spark.createDataFrame([], LABELS)
    assert filter_audit.audit(frame(spark, []), none).count() == 0
    got = result(filter_audit.audit(frame(spark, [(1, None, None)]), none))
    assert len(got) == 600 and got == brute([(1, None, None)], [])


def test_query_equals_sql_and_brute_force(spark):
    df = queries.op11_filter_audit(spark, SF)
    rows = result(df)
    con = duckdb.connect()
    for name in ("documents", "labels"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{SF}/{name}.parquet')")
    told = con.execute(queries.ORACLE["op11_filter_audit"])
    columns = [d[0] for d in told.description]
    assert digest(df.columns, rows)[0] == digest(columns, told.fetchall())[0]
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "source").collect()]
    labels = [tuple(r) for r in spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "quality", "toxic").collect()]
    assert rows == brute(docs, labels)
