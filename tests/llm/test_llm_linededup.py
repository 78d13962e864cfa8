from __future__ import annotations

import random

from pyspark.sql import functions as F

import corpus_pipeline
from ledgerline.llm import linededup

SF = "/root/testdata/sf0.001"


def brute(rows, min_words, common=None):
    """rows of (order key, text) -> set of deleted line numbers by key: every line of a run of
    non-blank lines that occurs earlier and has min_words words, or a letter and common documents;
    all runs tried."""
    solid = {k: [(i, x) for i, x in enumerate(t.split("\n")) if x.split()] for k, t in rows if t is not None}
    seen: dict = {}
    holders: dict = {}
    for key in solid if common else ():
        lines = [x for _, x in solid[key]]
        for start in range(len(lines)):
            for end in range(start, len(lines)):
                holders.setdefault(tuple(lines[start : end + 1]), set()).add(key)
    gone: dict = {k: set() for k, _ in rows}
    for key in sorted(solid):
        lines = solid[key]
        for start in range(len(lines)):
            words = 0
            for end in range(start, len(lines)):
                words += len(lines[end][1].split())
                run = tuple(x for _, x in lines[start : end + 1])
                first = seen.setdefault(run, (key, start))
                shared = common and len(holders[run]) >= common and any(c.isalpha() for x in run for c in x)
                if (words >= min_words or shared) and first != (key, start):
                    gone[key].update(i for i, _ in lines[start : end + 1])
    return gone


def deleted(spark, docs, min_words, common=None):
    """(doc_id, text) -> deleted line numbers, as the operator says."""
    out = linededup.deletions(docs, min_words, common).collect()
    return {(r.id, r.th): {x.line for x in r.gone} for r in out}


def keyed(docs):
    id_ = F.coalesce("doc_id", F.lit((1 << 63) - 1)).alias("id")
    return [((r.id, r.th), r.text) for r in docs.select(id_, F.xxhash64("text").alias("th"), "text").collect()]


def test_random_documents_equal_brute_force(spark, docs_of):
    rng = random.Random(8)
    for min_words in (1, 3, 5, 10):
        pool = [" ".join(f"w{rng.randrange(9)}" for _ in range(rng.randrange(1, 5))) for _ in range(14)] + ["", "  "]
        rows = []
        for d in range(40):
            lines = [rng.choice(pool) if rng.random() < 0.8 else f"single {d} {i}" for i in range(rng.randrange(0, 22))]
            rows.append((rng.randrange(30), "\n".join(lines)))
        docs = docs_of(rows)
        want = {k: v for k, v in brute(keyed(docs), min_words).items() if v}
        assert deleted(spark, docs, min_words) == want


def test_common_runs_equal_brute_force(spark, docs_of):
    rng = random.Random(5)
    for common in (2, 5, 9):
        pool = ["a", "b c", "}", "1 2", "--", "é", "{", ""]
        rows = []
        for d in range(30):
            lines = [rng.choice(pool) if rng.random() < 0.9 else f"{d} {i}" for i in range(rng.randrange(0, 14))]
            rows.append((rng.randrange(25), "\n".join(lines)))
        docs = docs_of(rows)
        want = {k: v for k, v in brute(keyed(docs), 12, common).items() if v}
        assert deleted(spark, docs, 12, common) == want and want


def test_table_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = keyed(docs)
    # every run of a long document would be too many: the longest ones go by the table test of the pipeline
    small = docs.where(F.size(F.split("text", "\n")) <= 60)
    want = {k: v for k, v in brute(keyed(small), 10).items() if v}
    assert deleted(spark, small, 10) == want and len(rows) == docs.count()
    want = {k: v for k, v in brute(keyed(small), 10, 4).items() if v}
    assert deleted(spark, small, 10, 4) == want


def test_suffix_ranks_sort_the_suffixes(spark, docs_of):
    rng = random.Random(3)
    rows = [(d, "\n".join(rng.choice("abcd") for _ in range(12))) for d in range(8)]
    lines = linededup.line_sequence(docs_of(rows))
    order = {r.lid: 0 for r in lines.select("lid").collect()}
    order = {lid: i for i, lid in enumerate(sorted(order), 1)}
    ranked, depths = linededup.suffix_ranks(lines, 16)
    assert depths == [1, 2, 4, 8, 16]
    whole, all_depths = linededup.suffix_ranks(lines, None)
    top = f"r{all_depths[-1]}"
    pairs = ranked.join(whole.select("id", "th", "pos", F.col(top).alias("full")), ["id", "th", "pos"])
    assert pairs.where("full <> r16").count() == 0
    text: dict = {}
    for r in lines.collect():
        text.setdefault(r.id, {})[r.pos] = order[r.lid]
    got = ranked.select("id", "pos", "r16").collect()
    suffix = {(r.id, r.pos): [text[r.id][p] for p in range(r.pos, 12)] for r in got}
    assert [k for k, _ in sorted(suffix.items(), key=lambda kv: (kv[1], kv[0]))] == [
        (r.id, r.pos) for r in sorted(got, key=lambda r: (r.r16, r.id, r.pos))
    ]
    ranks = {}
    for r in got:
        ranks.setdefault(r.r16, set()).add(tuple(suffix[r.id, r.pos]))
    assert all(len(v) == 1 for v in ranks.values())


def test_texts_and_counts(spark, docs_of, with_clashes):
    a, b = "one two three four five six", "seven eight nine ten eleven"
    rows = [
        (5, f"{a}\n{b}\n\nonly here"),
        (9, f"start\n{a}\n{b}\nmid\n{a}\nend"),
        (9, f"start\n{a}\n{b}\nmid\n{a}\nend"),
        (11, f"{a}\n\n{b}"),
        (12, "\n\n"),
        (13, None),
        (14, ""),
        (None, f"{a} {b}\nnew"),
        (15, f"{a} {b}"),
    ]
    docs = with_clashes(docs_of(rows))
    out = {(r.doc_id, i): r for i, r in enumerate(linededup.dedup_lines(docs, 8).collect())}
    text = {}
    for (doc, _), r in out.items():
        text.setdefault(doc, []).append((r.text, r.lines_before, r.lines_deleted, r.runs_deleted))
    assert text[5] == [(f"{a}\n{b}\n\nonly here", 4, 0, 0)]
    assert text[9] == [(f"start\nmid\n{a}\nend", 6, 2, 1)] * 2  # the last line a alone has six words
    assert text[11] == [("", 3, 2, 1)]  # blank lines don't part a run; one blank line is left
    assert text[12] == [("\n\n", 3, 0, 0)] and text[13] == [(None, 0, 0, 0)] and text[14] == [("", 1, 0, 0)]
    assert text[None] == [("new", 2, 1, 1)] and text[15] == [(f"{a} {b}", 1, 0, 0)]
    kept = linededup.keep_first_lines(docs, 8)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert 11 not in ids and ids.count(9) == 2 and {12, 13, 14} <= set(ids)
    assert all(r.n_chars == len(r.text or "") for r in kept.collect())
    assert linededup.dedup_lines(docs_of([]), 8).count() == 0


def test_long_copies_go_whole(spark, docs_of):
    lines = [f"line {i} of a long passage" for i in range(700)]
    rows = [(1, "\n".join(lines)), (2, "\n".join(["before", *lines[100:650], "after"]))]
    out = {r.doc_id: r for r in linededup.dedup_lines(docs_of(rows)).collect()}
    assert out[1].lines_deleted == 0
    assert (out[2].text, out[2].lines_deleted, out[2].runs_deleted) == ("before\nafter", 550, 1)


def test_common_short_lines_go_in_the_pipeline(spark, docs_of):
    licence = "Released under the MIT License."
    last = linededup.COMMON_DOCS + 3
    rows = [(i, f"text number {i}\n{licence}\n}}\nend {i}\n}}") for i in range(1, last)] + [(last, licence), (last + 1, "}\nfourth text")]
    kept = {r.doc_id: r.text for r in corpus_pipeline.line_stage(spark, docs_of(rows), SF).collect()}
    want = {i: f"text number {i}\nend {i}\n}}" for i in range(2, last)}
    assert kept == {1: rows[0][1], last + 1: "}\nfourth text"} | want


def test_code_keeps_its_short_lines(spark, docs_of):
    """Two programs share lines that are too short and too rare to be repeats."""
    first = "int f(int x) {\n  if (x > 2)\n    return 1;\n  return 0;\n}"
    second = "int g(int y) {\n  while (y--)\n    h(y);\n    return 1;\n  return 0;\n}"
    kept = {r.doc_id: r.text for r in corpus_pipeline.line_stage(spark, docs_of([(1, first), (2, second)]), SF).collect()}
    assert kept == {1: first, 2: second}


def test_the_commonest_line_stays_once(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    lines = lambda d: d.where("text is not null").select(F.explode(F.split("text", "\n")).alias("x")).where(F.col("x").rlike(r"\p{L}"))
    top = lines(docs).groupBy("x").count().orderBy(F.desc("count"), "x").first()
    assert top["count"] > 100
    cleaned = linededup.keep_first_lines(docs)
    assert lines(cleaned).where(F.col("x") == top.x).count() == 1
    held = lines(cleaned.withColumn("text", F.array_join(F.array_distinct(F.split("text", "\n")), "\n"))).groupBy("x").count()
    assert held.agg(F.max("count")).first()[0] < linededup.COMMON_DOCS


def test_the_pipeline_sorts_the_whole_suffix_array(spark, docs_of, monkeypatch):
    built, plain = [], linededup.suffix_ranks

    def spy(lines, depth):
        out = plain(lines, depth)
        built.append((depth, out[1]))
        return out

    monkeypatch.setattr(linededup, "suffix_ranks", spy)
    text = "\n".join(f"line {i}" for i in range(20))
    corpus_pipeline.line_stage(spark, docs_of([(1, text), (2, text)]), SF).collect()
    assert built == [(None, [1, 2])]  # the lines of one passage: pairs are as far apart as lines
    same = "\n".join(["again"] * 40)
    corpus_pipeline.line_stage(spark, docs_of([(1, same)]), SF).collect()
    assert built[1] == (None, [1, 2, 4, 8, 16, 32, 64, 128])


def test_every_later_copy_of_a_line_goes(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    want = {k: v for k, v in brute([(k, t) for k, t in keyed(docs) if t and t.count("\n") < 60], 1).items() if v}
    assert deleted(spark, docs.where(F.size(F.split("text", "\n")) <= 60), 1) == want and want


def test_letter_windows_are_the_same_code_at_any_depth(spark, docs_of):
    """No branch for each depth, and no frame that is summed up anew for each row."""
    rows = [(1, "\n".join(["again", "--"] * 20))]
    ranked, depths = linededup.suffix_ranks(linededup.line_sequence(docs_of(rows)), None)
    assert len(depths) > 5
    branches = []
    for some in (depths[:2], depths):
        plan = linededup._letter_windows(ranked, some)._jdf.queryExecution().optimizedPlan().toString()
        branches.append(plan.count("CASE WHEN"))
        assert "unboundedfollowing" not in plan.lower()
    assert branches[0] == branches[1]
    got = sorted((r.pos, r.start, r.n) for r in linededup._letter_windows(ranked, depths).collect())
    want = [(i, i - i % 2, 1 + i % 2) for i in range(40)] + [(i, i, 2) for i in range(1, 39, 2)]
    assert got == sorted(want)
