"""Toxicity scores: FTRL-proximal logistic regression over hashed n-grams.

A text's features are its distinct word unigrams, bigrams and skip-grams (two
words with one between them), hashed into 2**20 buckets. FTRL-proximal trains
a weight for each bucket with per-coordinate learning rates and L1 sparsity;
what is left of the weights is a few thousand numbers that every task gets.

The model learns from a bounded sample: of the ``train_rows`` labelled documents with
the smallest hash of their id as many, in that order, as have ``train_features``
features together, each with all of its features. Scoring reads every whole text.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import columns, fresh, hash_order, held_out, materialise, smallest_hashes, train_row

BITS = 20
#: Bounds of the sample that the driver holds: documents, and their features together (four bytes each).
TRAIN_ROWS = 16_384
TRAIN_FEATURES = 1 << 24
THRESHOLD = 0.3
EPOCHS = 6
ALPHA, BETA, L1, L2 = 2.0, 1.0, 5.0, 0.0
_MEMO_WORDS = 1 << 18
_BLOCK = 1 << 16
_ROWS_AT_ONCE = 64
#: ASCII letters in lower case; other ASCII but digits becomes a space.
_FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if c > 127 or 97 <= c <= 122 or 48 <= c <= 57 else 32 for c in range(256)
)
_ODD = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9))
_DOWN = np.uint64(64 - BITS)


class _Memo(dict):
    """Word to 64-bit hash; forgets all when it holds too many words."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= _MEMO_WORDS:
            self.clear()
        value = self[word] = zlib.crc32(word) * 0xD6E8FEB86659FD93 & 0xFFFFFFFFFFFFFFFF
        return value


def _buckets(text: bytes | None, memo: _Memo) -> Iterator[np.ndarray]:
    """The feature buckets of a text, repeats included, a block of words at a time."""
    words = (text or b"").translate(_FOLD).split()
    for start in range(0, len(words), _BLOCK):
        block = words[start : start + _BLOCK + 2]  # pairs reach two words into the next block
        h = np.fromiter(map(memo.__getitem__, block), np.uint64, len(block))
        own = h[:_BLOCK]
        mixed = [own * _ODD[0], (h[:-1] * _ODD[1] ^ h[1:])[:_BLOCK] * _ODD[0], (h[:-2] * _ODD[2] ^ h[2:])[:_BLOCK] * _ODD[1]]
        x = np.concatenate(mixed)
        x ^= x >> np.uint64(29)
        yield ((x * _ODD[1]) >> _DOWN).astype(np.int64)


@dataclass
class Model:
    """Non-zero weights by bucket, and the bias. ``rows`` is how many rows it learnt from."""

    index: np.ndarray
    value: np.ndarray
    bias: float
    rows: int

    def dense(self) -> np.ndarray:
        weights = np.zeros(1 << BITS, np.float32)
        weights[self.index] = self.value
        return weights


def _sigmoid(x: float) -> float:
    return float(1 / (1 + np.exp(-np.clip(x, -35, 35))))


def fit(rows: list[np.ndarray], labels: list[int]) -> Model:
    """FTRL-proximal over rows of distinct feature buckets with 0/1 labels.

    The bias starts at the log odds of the labels, so few rows don't make the
    score of a text without known features a coin toss."""
    z, n = np.zeros(1 << BITS), np.zeros(1 << BITS)
    bias, grads = float(np.log((sum(labels) + 0.5) / (len(labels) - sum(labels) + 0.5))), 1.0
    order = np.random.default_rng(7)
    for _ in range(EPOCHS if rows else 0):
        for r in order.permutation(len(rows)):
            i = rows[r]
            zi, root = z[i], np.sqrt(n[i])
            w = np.where(np.abs(zi) > L1, (np.sign(zi) * L1 - zi) / ((BETA + root) / ALPHA + L2), 0.0)
            g = _sigmoid(w.sum() + bias) - labels[r]
            z[i] = zi + g - (np.sqrt(n[i] + g * g) - root) / ALPHA * w
            n[i] += g * g
            grads += g * g
            bias -= 0.05 * g / np.sqrt(grads)
    live = np.flatnonzero(np.abs(z) > L1)
    w = (np.sign(z[live]) * L1 - z[live]) / ((BETA + np.sqrt(n[live])) / ALPHA + L2)
    return Model(live.astype(np.int32), w.astype(np.float32), float(bias), len(rows))


def training_rows(
    docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS, train_features: int = TRAIN_FEATURES
) -> DataFrame:
    """(doc_id, features, toxic) of at most ``train_rows`` labelled training documents with a text, and of at
    most ``train_features`` features.

    The labelled ids with the smallest hashes are taken, each with all its distinct
    buckets; the first that would go over ``train_features`` and those behind it are left
    out. Of several texts of an id the one with the smallest hash teaches.
    """
    marked = (
        labels.where(train_row() & F.col("toxic").isin(0, 1))
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.max("toxic").cast("int").alias("toxic"))
    )
    marked = smallest_hashes(marked, train_rows, marked.count(), "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = _Memo()
        for batch in batches:
            for at in range(0, batch.num_rows, _ROWS_AT_ONCE):  # a document has up to 2**BITS features
                some = batch.slice(at, _ROWS_AT_ONCE)
                found = [
                    np.unique(np.concatenate([*_buckets(x.as_py(), memo), np.zeros(0, np.int64)])).astype(np.int32)
                    for x in some["text"]
                ]
                features = pa.array(found, pa.list_(pa.int32()))
                yield pa.record_batch({"doc_id": some["doc_id"], "features": features, "toxic": some["toxic"]})

    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary").alias("text")).where("text is not null")
    # at most train_rows rows of two numbers
    told = texts.join(F.broadcast(marked), "doc_id")
    one = told.groupBy("doc_id").agg(F.min_by("text", F.xxhash64("text")).alias("text"), F.max("toxic").alias("toxic"))
    found = materialise(one.mapInArrow(run, "doc_id long, features array<int>, toxic int"))
    # a number for each of at most train_rows rows
    before = Window.orderBy(hash_order("doc_id"), "doc_id").rowsBetween(Window.unboundedPreceding, 0)
    sizes = found.select("doc_id", F.size("features").cast("long").alias("n"))
    chosen = sizes.withColumn("so_far", F.sum("n").over(before)).where(F.col("so_far") <= train_features)
    return found.join(F.broadcast(chosen.select("doc_id")), "doc_id")


def train(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS, train_features: int = TRAIN_FEATURES) -> Model:
    got = training_rows(docs, labels, train_rows, train_features).toArrow().sort_by([("doc_id", "ascending")])
    return fit([x.values.to_numpy() for x in got["features"]], got["toxic"].to_pylist())


def score(docs: DataFrame, model: Model, name: str = "toxic_score") -> DataFrame:
    """``docs`` with a double column ``name``, which ``docs`` must not have, behind its own columns.

    Null and empty texts get the score of a text without features. A model that
    has seen no rows scores 0.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def scored(texts):
        import pandas as pd

        if not sent.value.rows:
            return pd.Series(np.zeros(len(texts)))
        weights, memo, bias = sent.value.dense(), _Memo(), sent.value.bias

        def one(raw: bytes | None) -> float:
            hits = [b[weights[b] != 0] for b in _buckets(raw, memo)]
            return _sigmoid(bias + (float(weights[np.unique(np.concatenate(hits))].sum()) if hits else 0.0))

        return pd.Series([one(x) for x in texts], dtype="float64")

    return docs.select(*columns(docs.columns), scored(F.col("text").cast("binary")).alias(name))


def toxicity(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, held_out, score, predicted) for each row of ``docs``.

    Learns from labelled rows that aren't held out, scores all. Labels that are
    null or not 0/1 teach nothing; a repeated label counts as toxic if one of
    its rows does. Repeated rows keep their rows, and equal texts get equal
    scores. Other columns of either table are ignored.
    """
    model = train(docs, labels, train_rows)
    found = score(docs.select("doc_id", "text"), model)
    return found.select(
        "doc_id",
        held_out().alias("held_out"),
        F.col("toxic_score").alias("score"),
        (F.col("toxic_score") >= threshold).cast("int").alias("predicted"),
    )


def drop_toxic(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the documents that score ``threshold`` or more.

    Null and empty texts score like a text without features and stay unless most labels
    are toxic; without labels all stay. Rows with equal texts stay or go together,
    whatever their ids, null ids too. An empty table gives no rows; other columns pass
    through, whatever their names.
    """
    name = fresh(docs, "toxic_score")
    found = score(docs, train(docs, labels, train_rows), name)
    return found.where(F.col(name) < threshold).select(*columns(docs.columns))
