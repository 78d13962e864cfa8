"""Audit of how filters interact in every order that they can be applied in.

Whether a text fails a filter doesn't hang on the other filters, so a document
is its mask: the set of filters that it fails. A mask settles what happens to
the document at each step of each of the 120 orders of five filters. All 600
step outcomes of a mask are packed in one wide whole number of 64-bit fields,
four for each step (kept, removed, redundant, unique fails), each 0 or 1. The
packed counters of a part are the sum of its documents' numbers: rows are counted
by part, mask and label first, and a number is added as often as its mask was
counted. A field holds a count of rows, which is under 2**63, so no field runs
over into the next and the sum is unpacked by reading it as an array of longs.
Documents of good quality and toxic ones have sums of their own.

Copies are found by the texts' SHA-256: the least doc_id of a text is aggregated
before it is joined back by text and id, so a text that a third of all rows share
meets in no task.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import permutations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import materialise

FILTERS = "ABCDE"
ORDERS = ["".join(p) for p in permutations(FILTERS)]
STEPS = len(FILTERS)
LEAST_WORDS = 200
#: Percent: distinct words of all words, at least; capitals of all characters, at most.
LEAST_DISTINCT, MOST_CAPITALS = 50, 2
_CAPITALS = bytes(range(ord("A"), ord("Z") + 1))
_SIGNS = re.compile(rb"[#$%&*|]")
_COPY = 1 << FILTERS.index("E")
#: Fields of a step, in their order in the wide number.
FIELDS = ("kept", "removed", "redundant", "unique_fails")

RESULT = (
    "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, "
    "good_lost long, toxic_lost long, shapley long"
)


def text_mask(text: bytes, chars: int) -> int:
    """The filters A to D that a UTF-8 text of ``chars`` code points fails, as a mask."""
    words = text.split()  # bytes: at ASCII white space only
    short = len(words) < LEAST_WORDS
    poor = 100 * len(set(words)) < LEAST_DISTINCT * len(words)
    loud = 100 * (len(text) - len(text.translate(None, _CAPITALS))) > MOST_CAPITALS * chars
    return short | poor << 1 | loud << 2 | bool(_SIGNS.search(text)) << 3


def masks(docs: DataFrame) -> DataFrame:
    """(doc_id, part, mask, key) for each row: the filters A to D that the whole text fails, and the text's SHA-256."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, keys = [], []
            chars = pc.utf8_length(batch["text"].cast(pa.string())).to_pylist()
            for text, n in zip(batch["text"], chars):
                raw = text.as_py()
                found.append(text_mask(raw, n))
                keys.append(hashlib.sha256(raw).digest())
            yield pa.record_batch(
                [batch["doc_id"], batch["part"], pa.array(found, pa.int32()), pa.array(keys, pa.binary())],
                ["doc_id", "part", "mask", "key"],
            )

    texts = docs.select(
        F.col("doc_id").cast("long"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
        F.coalesce("text", F.lit("")).cast("binary").alias("text"),
    )
    return texts.mapInArrow(run, "doc_id long, part string, mask int, key binary")


def mask_counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, good, toxic, n): rows by part, failed filters and label, a copy's mask with E."""
    marks = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        *[F.coalesce(F.max(F.col(c) == 1), F.lit(False)).alias(name) for c, name in (("quality", "good"), ("toxic", "toxic"))]
    )
    rows = materialise(masks(docs))
    firsts = rows.groupBy("key").agg(F.min("doc_id").alias("doc_id"), F.lit(True).alias("first"))
    named = rows.join(firsts, ["key", "doc_id"], "left")
    copy = F.col("doc_id").isNotNull() & F.col("first").isNull()
    marked = named.join(marks, "doc_id", "left").select(
        "part",
        F.when(copy, F.col("mask").bitwiseOR(_COPY)).otherwise(F.col("mask")).alias("mask"),
        *[F.coalesce(c, F.lit(False)).alias(c) for c in ("good", "toxic")],
    )
    return marked.groupBy("part", "mask", "good", "toxic").agg(F.count(F.lit(1)).alias("n"))


@lru_cache(maxsize=None)
def wide(mask: int) -> int:
    """All step outcomes of a mask in one number: 64 bits a field, four fields a step, five steps an order."""
    fields = np.zeros((len(ORDERS), STEPS, len(FIELDS)), "<u8")
    for o, order in enumerate(ORDERS):
        gone = False
        for s, name in enumerate(order):
            bit = 1 << FILTERS.index(name)
            fails = bool(mask & bit)
            fields[o, s] = (not gone and not fails, fails and not gone, fails and gone, mask == bit)
            gone |= fails
    return int.from_bytes(fields.tobytes(), "little")


def unpack(total: int) -> np.ndarray:
    """The counts that a sum of wide numbers holds: (order, step, field)."""
    size = len(ORDERS) * STEPS * len(FIELDS)
    return np.frombuffer(total.to_bytes(8 * size, "little"), "<u8").astype(np.int64).reshape(len(ORDERS), STEPS, len(FIELDS))


def part_rows(part: str, counts: list[tuple[int, bool, bool, int]]) -> pa.Table:
    """The 600 result rows of a part from its (mask, good, toxic, n)."""
    sums = [
        sum(wide(m) * n for m, good, toxic, n in counts if chosen(good, toxic))
        for chosen in (lambda good, toxic: True, lambda good, toxic: good, lambda good, toxic: toxic)
    ]
    kept, removed, redundant, alone = np.moveaxis(unpack(sums[0]), 2, 0)
    lost = [unpack(x)[:, :, FIELDS.index("removed")] for x in sums[1:]]
    which = np.array([[FILTERS.index(name) for name in order] for order in ORDERS])
    shapley = np.array([removed[which == f].sum() for f in range(len(FILTERS))])[which]
    longs = [kept, removed, redundant, alone, *lost, shapley]
    names = [f.split()[0] for f in RESULT.split(", ")]
    return pa.table(
        [
            pa.array([part] * which.size, pa.string()),
            pa.array(np.repeat(ORDERS, STEPS).tolist(), pa.string()),
            pa.array(np.tile(np.arange(1, STEPS + 1), len(ORDERS)), pa.int32()),
            *[pa.array(x.ravel(), pa.int64()) for x in longs],
        ],
        names,
    )


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """What each filter removes at each step of each order, for each source.

    ``docs`` needs doc_id, text and source, ``labels`` doc_id, quality and toxic.
    Filters, by what fails them: A under 200 words; B distinct words under half of
    all; C capitals A-Z over 2 % of the code points; D any of ``#$%&*|``; E a text
    that a row with a smaller doc_id has, in any part. Words are parted by ASCII
    white space and case-sensitive.

    600 rows for each part (source; null: empty string): kept after the step,
    removed at it, redundant (fails the filter, removed before), unique_fails
    (fails this filter only), good_lost and toxic_lost (removed at it; quality or
    toxic = 1), shapley (removed by the step's filter, summed over all orders).

    A null text is empty (it fails A, and E if a smaller id's text is empty too).
    A null doc_id has no label and nothing is smaller or greater than it, so its
    row is never a copy and makes none. Repeated rows all count; those of the
    smallest id are no copies. Several labels of an id: any 1 counts. An empty
    table gives no rows; other columns are ignored.
    """

    def run(key: tuple, rows: pa.Table) -> pa.Table:  # 128 rows at most: masks by labels
        counts = list(zip(*[rows[c].to_pylist() for c in ("mask", "good", "toxic", "n")]))
        return part_rows(key[0].as_py(), counts)

    return mask_counts(docs, labels).groupBy("part").applyInArrow(run, RESULT)
