"""SimHash near-duplicates by a segment-popcount embedding.

Every text gets a 64-bit SimHash over its word shingles. Two fingerprints link
when they differ in at most ``max_bits`` bits. To find the links, a fingerprint
is cut into 32 segments of two bits and mapped to the vector of its segments'
bit counts. The Manhattan distance of two such vectors is never above the
Hamming distance of the fingerprints, so it is a lower bound to filter by.

The grid join over these vectors works on subspaces: the 32 axes fall into
``max_bits + 3`` blocks; vectors within Manhattan distance ``max_bits`` can
differ in at most ``max_bits`` blocks, hence they lie in the same unit cell of
at least one 3-block subspace. Rows of a cell are joined, filtered by the
Manhattan bound, then verified on the fingerprints.

A cell with more than ``cell_rows`` fingerprints (a large group of near copies)
is not paired up. Its members publish every fingerprint within ``max_bits / 2``
bit flips instead; two of them meet in such a key exactly when they are within
``max_bits``, and each key links its members to the smallest one: as many links
as members, none lost.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import LAST_ID, columns, connected_components, fresh, materialise

SHINGLE_WORDS = 3
MAX_BITS = 2
CELL_ROWS = 64
_SEED = 42
_BLOCK = 1 << 16
_EVEN_BITS = 0x5555555555555555


def fingerprint(text: bytes | None, shingle_words: int = SHINGLE_WORDS) -> int:
    """Unsigned 64-bit SimHash of a UTF-8 text (null counts as empty, and gives 0)."""
    words = (text or b"").lower().split()  # bytes: only A-Z, only ASCII white space
    if not words:
        return 0
    shingles = max(1, len(words) - shingle_words + 1)
    ones = np.zeros(64, np.int64)
    for start in range(0, shingles, _BLOCK):
        block = words[start : start + _BLOCK + shingle_words - 1]
        if len(words) <= shingle_words:
            joined: Iterator[bytes] = iter([b" ".join(words)])
        else:
            joined = map(b" ".join, zip(*(block[j:] for j in range(shingle_words))))
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, joined, repeat(_SEED)), np.uint64)
        bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(0, dtype=np.int64)
    chosen = np.packbits(ones * 2 > shingles, bitorder="little")
    return int(chosen.view("<u8")[0])


def fingerprints(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, **more: Column) -> DataFrame:
    """(doc_id, fp) for each row of ``docs``; fp is the fingerprint as a signed long. ``more`` adds long columns."""
    kept = list(more)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(x.as_py(), shingle_words) for x in batch["text"]], np.uint64)
            told = {name: batch[name] for name in kept}
            yield pa.record_batch({"doc_id": batch["doc_id"], "fp": pa.array(found.view(np.int64)), **told})

    extra = [c.cast("long").alias(name) for name, c in more.items()]
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary").alias("text"), *extra)
    return texts.mapInArrow(run, ", ".join(["doc_id long", "fp long", *[f"{name} long" for name in more]]))


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def segment_counts(fp: Column) -> Column:
    """The 32 segment bit counts of a fingerprint, each written in unary on its
    segment's two bits: the Manhattan distance of two vectors is then the bit
    count of their XOR."""
    low = fp.bitwiseAND(F.lit(_EVEN_BITS))
    high = F.shiftrightunsigned(fp, 1).bitwiseAND(F.lit(_EVEN_BITS))
    return low.bitwiseOR(high).bitwiseOR(F.shiftleft(low.bitwiseAND(high), 1))


def _subspaces(max_bits: int) -> list[int]:
    """A bit mask for every choice of 3 of the max_bits + 3 blocks of axes."""
    blocks = [reduce(int.__or__, (3 << 2 * int(i) for i in part)) for part in np.array_split(np.arange(32), max_bits + 3)]
    return [_signed(a | b | c) for a, b, c in combinations(blocks, 3)]


def _flips(radius: int) -> list[int]:
    return [_signed(sum(1 << i for i in some)) for r in range(radius + 1) for some in combinations(range(64), r)]


def links(found: DataFrame, max_bits: int = MAX_BITS, cell_rows: int = CELL_ROWS) -> DataFrame:
    """Edges (u, v) whose components are those of "differ in at most max_bits bits".

    ``found`` has the distinct fingerprints in column ``fp``. Edges found in
    cells are exactly pairs within max_bits; edges from crowded cells join a
    member to the smallest member of a shared key, also within max_bits.
    """
    if max_bits % 2 or not 0 <= max_bits <= 4:
        raise ValueError("max_bits must be 0, 2 or 4")
    masks = F.array(*map(F.lit, _subspaces(max_bits)))
    coded = found.select("fp", segment_counts(F.col("fp")).alias("counts"))
    cells = coded.select(
        "fp", "counts", F.posexplode(F.transform(masks, lambda m: F.col("counts").bitwiseAND(m))).alias("space", "cell")
    )
    crowd = materialise(cells.groupBy("space", "cell").agg(F.count(F.lit(1)).alias("members")).where("members > 1"))
    key = ["space", "cell"]
    a = cells.join(crowd.where(F.col("members") <= cell_rows), key)
    b = a.select(*key, F.col("fp").alias("fp2"), F.col("counts").alias("counts2"))
    near = (
        (F.col("fp") < F.col("fp2"))
        & (F.bit_count(F.col("counts").bitwiseXOR(F.col("counts2"))) <= max_bits)
        & (F.bit_count(F.col("fp").bitwiseXOR(F.col("fp2"))) <= max_bits)
    )
    a, b = a.alias("a"), b.alias("b")
    pairs = a.join(b, (F.col("a.space") == F.col("b.space")) & (F.col("a.cell") == F.col("b.cell")) & near).select(
        F.col("fp").alias("u"), F.col("fp2").alias("v")
    )
    hot = cells.join(crowd.where(F.col("members") > cell_rows), key).select("fp").distinct()
    flips = F.array(*map(F.lit, _flips(max_bits // 2)))
    balls = hot.select("fp", F.explode(flips).alias("flip")).select("fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("key"))
    stars = balls.groupBy("key").agg(F.min("fp").alias("v"), F.max("fp").alias("top")).where("v < top").drop("top")
    return pairs.unionAll(balls.join(materialise(stars), "key").where("fp <> v").select(F.col("fp").alias("u"), "v"))


def near_duplicates(
    docs: DataFrame, shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS, cell_rows: int = CELL_ROWS
) -> DataFrame:
    """Classes of near-duplicate documents: (doc_id, fp, component_id), a row for each row of ``docs``.

    component_id is the smallest doc_id that a chain of links reaches, the
    document's own included. Null and white-space texts have fingerprint 0 and
    link like any other. Repeated ids each keep their row; a null id keeps its
    row and takes the class's smallest non-null id (null if there is none). An
    empty table gives no rows; other columns of ``docs`` are ignored.
    """
    of_doc = materialise(fingerprints(docs, shingle_words))
    least = F.min("doc_id").alias("component_id")
    classes = _classes(of_doc, least, max_bits, cell_rows)
    return of_doc.join(classes, "fp").select("doc_id", "fp", "component_id")


def _classes(of_doc: DataFrame, least: Column, max_bits: int, cell_rows: int) -> DataFrame:
    """(fp, m): for each fingerprint the minimum m, an aggregate under its alias, over all rows of its class."""
    (name,) = of_doc.agg(least).columns
    distinct = materialise(of_doc.groupBy("fp").agg(least))
    roots = connected_components(links(distinct.select("fp"), max_bits, cell_rows))
    rooted = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    of_class = rooted.groupBy("root").agg(F.min(name).alias(name))
    return materialise(rooted.drop(name).join(of_class, "root").select("fp", name))


def fingerprint_hex(fp: Column) -> Column:
    """The fingerprint as 16 lowercase hex digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def drop_near_duplicates(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """``docs`` with one row of each class: that of the smallest id (null last), then of the text and
    the whole row with the smallest hash.

    A class is one of rows, not of ids: rows that share an id without being near copies
    stay, and near copies without an id go but for one. Rows that repeat whole are one.
    Null and white-space texts are near copies of each other. An empty table gives no
    rows; other columns pass through, whatever their names.
    """
    names = [fresh(docs, n) for n in ("_id", "_th", "_rh")]
    keys = (F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)), F.xxhash64("text"), F.xxhash64(*columns(docs.columns)))
    rows = materialise(fingerprints(docs, shingle_words, **dict(zip(names, keys))))
    # the least row of each class; a fingerprint's own least row comes up in its class, if at all
    least = _classes(rows, F.min(F.struct(*names)).alias("least"), max_bits, CELL_ROWS)
    kept = least.select("least").distinct().select(*[F.col(f"least.{n}").alias(n) for n in names])
    # copies of a whole row meet before they are dealt, so none are too many for a task
    single = docs.select("*", *[c.alias(n) for c, n in zip(keys, names)]).dropDuplicates(names)
    return single.join(kept, names, "left_semi").select(*columns(docs.columns))
