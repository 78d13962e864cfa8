"""Document fingerprints by locally consistent parsing.

A text's UTF-8 bytes are parsed into phrases, the phrases' names into longer
phrases, and so on. Deterministic coin tossing finds the cuts: a symbol is
labelled by the lowest bit in which it differs from the one before it; a few
such rounds leave labels from 0 to 5 without equal neighbours, and a phrase
starts at each local maximum. A cut depends on a few symbols around it alone,
so equal substrings are parsed alike wherever they stand, but for their ends.
A phrase's name is a hash of its symbols' names, hence equal phrases have equal
names in all documents.

The fingerprint is a one-permutation min-hash of the names on levels
``LEVELS``, the same for every text: ``SLOTS`` values of 16 bits in hex, 0000 for a slot without names.
Two fingerprints' likeness is the share of equal slots among those that either
fills: an estimate of the Jaccard likeness of the phrase sets.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import materialise

LEVELS = (1, 2, 3, 4)
SLOTS = 64
_AT_ONCE = 1 << 20
_U = np.uint64


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit scramble."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_BYTE_NAMES = _mix(np.arange(1, 257, dtype=_U) * _U(0x9E3779B97F4A7C15))
_PLACES = _mix(np.arange(301, 365, dtype=_U) * _U(0x9E3779B97F4A7C15)) | _U(1)


def _lowest_difference(x: np.ndarray, first: np.ndarray) -> np.ndarray:
    """One round of coin tossing: 2 * (lowest bit that differs from the symbol before) + that bit."""
    before = np.empty_like(x)
    before[1:] = x[:-1]
    before[first] = ~x[first]
    d = x ^ before
    k = np.bitwise_count((d & (~d + x.dtype.type(1))) - x.dtype.type(1))
    return (k << 1) | ((x >> k.astype(x.dtype)) & x.dtype.type(1)).astype(np.uint8)


def parse(symbols: np.ndarray, first: np.ndarray, names: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
    """One level of parsing over many sequences laid end to end.

    ``first`` marks each sequence's first symbol, ``names`` are the symbols'
    64-bit names. Returns the place of each phrase's first symbol, and its name.
    """
    keep = np.ones(len(symbols), bool)
    keep[1:] = (symbols[1:] != symbols[:-1]) | first[1:]
    at = np.flatnonzero(keep)  # a run of equal symbols counts as one, named by its length too
    x, f, h = symbols[at], first[at], names[at]
    if len(at) < len(symbols):
        run = np.diff(np.append(at, len(symbols))).astype(_U)
        h = np.where(run > 1, _mix(h + run * _U(0xD6E8FEB86659FD93)), h)
    label = _lowest_difference(x, f)
    for _ in range(3):  # 64 bits: labels under 128, 14, 8, 6
        label = _lowest_difference(label, f)
    cut = np.zeros(len(x), bool)
    cut[1:-1] = (label[1:-1] > label[:-2]) & (label[1:-1] > label[2:]) & ~f[2:]
    cut |= f
    starts = np.flatnonzero(cut)
    place = np.arange(len(x)) - np.repeat(starts, np.diff(np.append(starts, len(x))))
    named = np.add.reduceat(h * _PLACES[place & 63], starts)
    return at[starts], _mix(named + _U(level * 0x9E3779B9))


def sketches(texts: Sequence[str | None]) -> np.ndarray:
    """Fingerprints (texts, SLOTS) as 16-bit numbers; a null text counts as empty."""
    raw = [(t or "").encode() for t in texts]
    lengths = np.array([len(r) for r in raw], np.int64)
    least = np.full(len(raw) * SLOTS, np.iinfo(_U).max, _U)
    symbols = np.frombuffer(b"".join(raw), np.uint8)
    if len(symbols):
        owner = np.repeat(np.arange(len(raw)), lengths)
        names = _BYTE_NAMES[symbols]
        for level in range(1, max(LEVELS) + 1):
            first = np.ones(len(owner), bool)
            first[1:] = owner[1:] != owner[:-1]
            at, names = parse(symbols, first, names, level)
            symbols, owner = names, owner[at]
            if level in LEVELS:
                v = _mix(names)
                slot = owner * SLOTS + (v >> _U(58)).astype(np.int64)
                np.minimum.at(least, slot, v & _U((1 << 58) - 1))
    filled = least < np.iinfo(_U).max
    values = np.where(filled, _mix(least) % _U(65535) + _U(1), _U(0))
    return values.astype(np.uint16).reshape(len(raw), SLOTS)


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row: equal slots among the slots that either fills; 1 for two empty fingerprints."""
    either = (a != 0) | (b != 0)
    same = (either & (a == b)).sum(-1)
    return np.where(either.any(-1), same / np.maximum(either.sum(-1), 1), 1.0)


def to_hex(found: np.ndarray) -> list[str]:
    return [row.astype(">u2").tobytes().hex() for row in found]


def fingerprint(text: str | None) -> str:
    return to_hex(sketches([text]))[0]


def edited(text: str, following: str) -> str:
    """``text`` with its last half (rounded down) replaced by the first as many code points of ``following``."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


_RESULT = {
    "doc_id": pa.int64(),
    "n_chars": pa.int64(),
    "edited_sha256": pa.string(),
    "fingerprint": pa.string(),
    "edited_fingerprint": pa.string(),
    "near_edited": pa.float64(),
    "near_next": pa.float64(),
}
_RESULT_SQL = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def _results(ids: list, texts: list[str], following: str) -> dict[str, list]:
    """The result columns for texts in order; ``following`` is the one behind the last."""
    after = [*texts[1:], following]
    changed = [edited(t, n) for t, n in zip(texts, after)]
    own, new = sketches([*texts, following]), sketches(changed)
    return {
        "doc_id": ids,
        "n_chars": [len(t) for t in texts],
        "edited_sha256": [hashlib.sha256(t.encode()).hexdigest() for t in changed],
        "fingerprint": to_hex(own[:-1]),
        "edited_fingerprint": to_hex(new),
        "near_edited": likeness(own[:-1], new).tolist(),
        "near_next": likeness(own[:-1], own[1:]).tolist(),
    }


def _in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A partition's documents in order, each with the next one. The first text goes
    out as well, and the last document without a result: its next one is in another partition."""
    schema = pa.schema([*_RESULT.items(), ("part", pa.int32()), ("first", pa.string()), ("last", pa.string())])

    def out(columns: dict[str, list], part: int) -> pa.RecordBatch:
        n = len(next(iter(columns.values())))
        full = {name: columns.get(name, [None] * n) for name in schema.names} | {"part": [part] * n}
        return pa.record_batch([pa.array(full[f.name], f.type) for f in schema], schema=schema)

    ids: list = []
    texts: list[str] = []
    held, begun, part = 0, False, 0
    for batch in batches:
        for doc, text, part in zip(batch["doc_id"].to_pylist(), batch["text"], batch["part"].to_pylist()):
            text = text.as_py() or ""
            if not begun:
                yield out({"first": [text]}, part)
                begun = True
            if texts and held >= _AT_ONCE:
                yield out(_results(ids, texts, text), part)
                ids, texts, held = [], [], 0
            ids.append(doc)
            texts.append(text)
            held += len(text) + 256
    if texts:
        if len(texts) > 1:
            yield out(_results(ids[:-1], texts[:-1], texts[-1]), part)
        yield out({"doc_id": ids[-1:], "last": texts[-1:]}, part)


def _at_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for doc, text, following in zip(*(batch[c].to_pylist() for c in ("doc_id", "last", "following"))):
            found = _results([doc], [text], following)
            yield pa.record_batch([pa.array(found[c], t) for c, t in _RESULT.items()], names=list(_RESULT))


def fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of whole texts and of their edited texts.

    Returns doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited and near_next for each row of ``docs``. The next document is
    the one with the next smaller id (null ids last; rows of one id in the order
    of their texts' hashes), the first one for the last; a document alone is its
    own next. Null texts count as empty; two empty fingerprints have likeness 1,
    an empty and another 0. Equal texts have equal fingerprints. An empty table
    gives no rows; other columns are ignored.

    Rows are dealt by ranges of the id, so a text is shuffled once; a range's
    last document meets the first of the next range in a join of a row for each
    range.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("doc_id").desc_nulls_last(), F.col("hash")]
    rows = docs.select(F.col("doc_id").cast("long"), "text").withColumn("hash", F.xxhash64("text"))
    dealt = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    found = materialise(
        dealt.select("doc_id", "text", F.spark_partition_id().alias("part")).mapInArrow(
            _in_order, f"{_RESULT_SQL}, part int, first string, last string"
        )
    )
    firsts = found.where("first is not null").select("part", "first")
    ends = found.where("last is not null").select("doc_id", "last", "part")
    ring = Window.orderBy("part")  # a row for each range that has documents
    around = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    chain = firsts.select("part", F.coalesce(F.lead("part").over(ring), F.first("part").over(around)).alias("after"))
    following = firsts.select(F.col("part").alias("after"), F.col("first").alias("following"))
    met = ends.join(chain, "part").join(following, "after").select("doc_id", "last", "following")
    done = found.where("fingerprint is not null").select(*_RESULT)
    return done.unionAll(met.mapInArrow(_at_ends, _RESULT_SQL))
