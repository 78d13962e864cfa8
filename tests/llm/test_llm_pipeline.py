from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ledgerline.llm import langid, linededup, queries, simhash, toxicity

SF = "/root/testdata/sf0.01"


def test_stages_are_as_agreed():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "language", "line_dedup", "simhash", "packing"]
    assert corpus_pipeline.ORACLE_SQL is None


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    """The documents after each stage, written and read again."""
    root = tmp_path_factory.mktemp("pipeline")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        path = str(root / name)
        stage(spark, docs, SF).write.parquet(path)
        docs = spark.read.parquet(path)
        out.append(docs)
    return out


def ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def test_columns_are_those_of_documents(steps):
    assert all(df.columns == steps[0].columns and df.dtypes == steps[0].dtypes for df in steps[1:-1])


def test_each_stage_does_what_its_operator_says(spark, steps):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    assert ids(steps[1]) == ids(toxicity.toxicity(steps[0], labels).where("predicted = 0"))
    told = langid.language(steps[1]).where((F.col("lang_pred") != "und") & (F.col("score") >= langid.MIN_SCORE))
    assert ids(steps[2]) == ids(told)
    cleaned = linededup.dedup_lines(steps[2])
    kept = cleaned.where((F.col("lines_deleted") == 0) | (F.trim("text") != ""))
    assert ids(steps[3]) == ids(kept)
    assert steps[3].select("doc_id", "text").exceptAll(kept.select("doc_id", "text")).count() == 0
    classes = simhash.near_duplicates(steps[3])
    assert ids(steps[4]) == ids(classes.where("doc_id = component_id"))
    assert steps[4].exceptAll(steps[3]).count() == 0
    assert sorted(set(ids(steps[5]))) == ids(steps[4])


def test_clean_documents_stay(spark, steps):
    labels = spark.read.parquet(f"{SF}/labels.parquet").where("toxic = 0")
    before = steps[0].join(labels, "doc_id", "left_semi")
    lost = before.join(steps[1], "doc_id", "left_anti").count()
    assert lost <= 0.03 * before.count()
    assert steps[1].join(steps[2], "doc_id", "left_anti").count() <= 0.01 * steps[1].count()


def test_run_equals_the_stages(spark, steps):
    out = corpus_pipeline.run(spark, SF)
    assert out.columns == steps[-1].columns
    assert ids(out) == ids(steps[-1])


def test_every_operator_is_registered():
    numbers = sorted(int(name[2:].split("_")[0]) for name in queries.QUERIES)
    assert numbers == list(range(1, 14))


def plain_stages(spark, rows, labels):
    """(doc_id, text) that are left before packing, stage by stage with plain rules over the operators' scores."""
    from tests.llm.test_llm_linededup import brute
    from tests.llm.test_llm_simhash import classes

    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    clean = [(r.doc_id, r.text) for r in toxicity.score(frame, toxicity.train(frame, labels)).where("toxic_score < 0.3").collect()]
    told = langid.language(frame).collect()
    known = {(r.doc_id, r.lang_pred, r.score) for r in told}
    fine = {d for d, lang, score in known if lang != "und" and score >= langid.MIN_SCORE}
    left = [(d, t) for d, t in clean if d in fine and t is not None]  # a null text is of no language
    order = {k: ((1 << 63) - 1 if k[0] is None else k[0], k[1]) for k in left}
    gone = brute([(order[k], k[1]) for k in left], linededup.MIN_WORDS, linededup.COMMON_DOCS)
    cut = [(d, "\n".join(x for i, x in enumerate(t.split("\n")) if i not in gone[order[d, t]])) for d, t in left]
    cut = [(d, new) for (d, new), (_, old) in zip(cut, left) if new == old or new.strip()]
    kept = [min(some, key=lambda r: ((1 << 63) - 1 if r[0] is None else r[0])) for some in classes(cut)]
    return sorted(kept, key=str)


def test_odd_documents_go_through(spark, docs_of, odd_rows, with_clashes, fresh_dir):
    """Exact rows behind each stage for nulls, empty, long and repeated texts, with clashing columns."""
    folder = fresh_dir("odd")
    lines = "a first line of eleven words that some other texts repeat too"
    more = [(30 + i, f"document number {i} begins here\n{lines}\nand it ends with words of its own {i * 7}") for i in range(12)]
    rows = [(d, t, "en", "s", len(t or "")) for d, t in odd_rows + more]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    with_clashes(frame).write.parquet(f"{folder}/documents.parquet")
    labels = spark.createDataFrame([(1, 1, 0), (30, 1, 0), (31, 0, 0)], "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{folder}/labels.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        docs = stage(spark, docs, folder)
        assert docs.columns == with_clashes(frame).columns
        path = fresh_dir(f"odd{i}")
        docs.write.parquet(path)
        docs = spark.read.parquet(path)
    got = sorted(((r.doc_id, r.text) for r in docs.collect()), key=str)
    assert got == plain_stages(spark, rows, labels) and len(got) > 12
    assert all(r.n_chars == len(r.text) for r in docs.collect())
    out = corpus_pipeline.run(spark, folder)
    assert {str(r.doc_id) for r in out.collect()} == {str(d) for d, _ in got}


def test_empty_tables_go_through(spark, docs_of, fresh_dir):
    none = fresh_dir("none")
    docs_of([]).write.parquet(f"{none}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{none}/labels.parquet")
    assert corpus_pipeline.run(spark, none).count() == 0
