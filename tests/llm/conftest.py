from __future__ import annotations

import pytest

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use inside or add; as extra columns they must do no harm.
CLASHING = (
    "fp", "component_id", "row", "piece", "bucket", "words", "shard", "slot", "_bucket", "_hash", "_row", "_position",
    "hash", "part", "first", "last", "id", "th", "gone", "_id", "_th", "_gone", "lines_before", "lines_deleted",
    "score", "lang_pred", "toxic_score", "_toxic_score", "_told", "_lang_pred", "_lang_score", "held_out", "a.b",
)


@pytest.fixture
def docs_of(spark):
    """A documents frame of (doc_id, text) or (doc_id, text, lang) rows."""

    def make(rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "s", len(r[1] or "")) for r in rows]
        return spark.createDataFrame(full, DOC_SCHEMA)

    return make


@pytest.fixture
def with_clashes():
    """The frame with an extra string column of every clashing name."""
    from pyspark.sql import functions as F

    def add(df):
        extra = [c for c in CLASHING if c not in df.columns]
        return df.select("*", *[F.lit("x").alias(c) for c in extra])

    return add


@pytest.fixture
def odd_rows():
    """Nulls, empty, white-space and long texts, ties, repeated rows and ids."""
    long = "lorem ipsum dolor sit amet " * 20_000
    return [
        (1, "the cat sat on the mat today"),
        (2, "the cat sat on the mat today"),
        (2, "the cat sat on the mat today"),
        (3, "another text under a repeated id"),
        (3, "one more text under that id"),
        (4, None),
        (5, ""),
        (6, " \t\n "),
        (None, "a text without an id"),
        (None, None),
        (7, long),
        (8, long + "end"),
        (-9, "Ünïcödé ☃ 𝄞 text\nwith lines\n\nand more"),
    ]
