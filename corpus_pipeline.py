"""Corpus pipeline: the training-data operators in a row over ``documents``.

Toxic documents and those in no learnt language go, later copies of repeated
lines are cut, one document of each near-duplicate class stays, and what is
left is packed into sequences. Every stage but the last returns the columns of
``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerline.llm import langid, linededup, packing, simhash, toxicity
from ledgerline.session import work_path


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score as toxic go."""
    return toxicity.drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in no learnt language go."""
    return langid.drop_unknown_language(docs)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of repeated line runs (ten words, or a letter and many documents) go, and documents of nothing else."""
    return linededup.keep_first_lines(docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class stays."""
    return simhash.drop_near_duplicates(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document is placed in a training sequence."""
    return packing.pack_documents(docs)


STAGES = [
    ("toxicity", toxicity_stage),
    ("language", language_stage),
    ("line_dedup", line_stage),
    ("simhash", near_duplicate_stage),
    ("packing", packing_stage),
]

#: SQL can't express the trained stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table, each written and read again in the shared folder.

    Documents without letters, null and empty texts among them, go in the language
    stage; of rows that repeat whole one stays; a null id comes after every other. An
    empty table gives no rows. Other columns than those of ``documents`` pass through.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = work_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
