"""Best-fit packing of documents into sequences of several permitted lengths.

A document of n words takes n + 1 places (an end mark follows); one that is
longer than the largest sequence is cut into pieces. Pieces are dealt to
buckets of about ``bucket_pieces`` rows by a hash, and each bucket is packed on
its own: bins are never shared between buckets, so a bucket costs at most a
few half-empty bins and the work stays even however long the table is.

Within a bucket pieces go in falling length to the open bin with the least room
that holds them. If none does, a bin is opened in the size that costs least
for a token, given what the pieces still to come could fill it with. In the
end every bin shrinks to the smallest permitted size that holds its contents.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import materialise

SIZES = (512, 1024, 2048, 4096)
BUCKET_PIECES = 50_000
WORD = r"[^\x20\x09-\x0D]+"
#: Sequence length at which attention costs as much as the rest of a token's work.
ATTENTION = 16_384


def sequence_cost(size: int) -> float:
    """Work of one sequence: linear in its tokens, plus attention over all pairs."""
    return size * (1 + size / ATTENTION)


def _filled(room: int, lengths: list[int], counts: dict[int, int]) -> int:
    """Tokens that the largest pieces left would put into ``room``; lengths are sorted."""
    used, top = 0, len(lengths)
    while room > used and (top := bisect_right(lengths, room - used, 0, top)):
        x = lengths[top - 1]
        used += x * min(counts[x], (room - used) // x)
        top -= 1
    return used


def pack(
    lengths: Sequence[int], sizes: Sequence[int] = SIZES, cost: Callable[[int], float] = sequence_cost
) -> tuple[list[int], list[int], list[int]]:
    """Best-fit decreasing with several bin sizes.

    ``lengths`` must not rise and each must be from 1 to the largest size.
    Returns the bin and the offset in it of each piece, and the bins' sizes.
    """
    sizes = sorted(sizes)
    costs = [cost(s) for s in sizes]
    counts: dict[int, int] = {}
    for x in lengths:
        counts[x] = counts.get(x, 0) + 1
    left = sorted(counts)
    rooms: list[int] = []  # the distinct rooms of open bins, sorted
    open_bins: dict[int, list[int]] = {}
    used: list[int] = []
    cap: list[int] = []
    bins, offsets = [], []
    for x in lengths:
        counts[x] -= 1
        if not counts[x]:
            left.pop()
        at = bisect_left(rooms, x)
        if at < len(rooms):
            room = rooms[at]
            b = open_bins[room].pop()
            if not open_bins[room]:
                rooms.pop(at)
        else:
            first = bisect_left(sizes, x)
            s = min(range(first, len(sizes)), key=lambda i: (costs[i] / (x + _filled(sizes[i] - x, left, counts)), i))
            b, room = len(used), sizes[s]
            used.append(0)
            cap.append(sizes[s])
        bins.append(b)
        offsets.append(used[b])
        used[b] += x
        if room := room - x:
            if not (stack := open_bins.setdefault(room, [])):
                insort(rooms, room)
            stack.append(b)
    return bins, offsets, [sizes[bisect_left(sizes, u)] for u in used]


def pieces(docs: DataFrame, largest: int, words: Column | None = None) -> DataFrame:
    """(row, doc_id, piece, start, length): every document cut to at most ``largest`` - 1 words a piece."""
    counted = F.regexp_count("text", F.lit(WORD)) if words is None else words
    sized = docs.select(F.col("doc_id").cast("long"), F.coalesce(counted, F.lit(0)).cast("long").alias("words"))
    sized = materialise(sized.withColumn("row", F.monotonically_increasing_id()))
    most = F.lit(largest - 1)
    starts = F.sequence(F.lit(0).cast("long"), F.greatest(F.col("words") - 1, F.lit(0)), most.cast("long"))
    cut = sized.select("row", "doc_id", "words", F.posexplode(starts).alias("piece", "start"))
    length = F.least(F.col("words") - F.col("start"), most).cast("int")
    return cut.select("row", "doc_id", "piece", "start", length.alias("length"))


def pack_documents(
    docs: DataFrame,
    sizes: Sequence[int] = SIZES,
    bucket_pieces: int = BUCKET_PIECES,
    words: Column | None = None,
    seed: int = 11,
) -> DataFrame:
    """Place every document: (doc_id, piece, start, length, bin_id, bin_size, bin_offset).

    A row is a piece: ``length`` words of the document from word ``start`` on,
    put at place ``bin_offset`` of sequence ``bin_id``, which has ``bin_size``
    places; the place behind the piece holds the end mark. ``words`` is the
    length of a row (default: its words apart by ASCII white space).

    Null and empty texts are pieces of no words. Repeated rows and ids are
    packed each on its own, null ids too. An empty table gives no rows.
    """
    sizes = sorted(set(sizes))
    if not sizes or sizes[0] < 2:
        raise ValueError("sizes must be 2 or more")
    cut = pieces(docs, sizes[-1], words)
    buckets = max(1, -(-cut.count() // bucket_pieces))
    dealt = cut.withColumn("bucket", F.pmod(F.xxhash64("row", "piece", F.lit(seed)), F.lit(buckets)))

    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by([("length", "descending"), ("row", "ascending"), ("piece", "ascending")])
        bins, offsets, caps = pack([n + 1 for n in group["length"].to_pylist()], sizes)
        bins = np.array(bins, np.int64)
        base = group["bucket"][0].as_py() << 32
        placed = group.select(["doc_id", "piece", "start", "length"])
        placed = placed.append_column("bin_id", pa.array(bins + base))
        placed = placed.append_column("bin_size", pa.array(np.array(caps, np.int32)[bins]))
        return placed.append_column("bin_offset", pa.array(np.array(offsets, np.int32)))

    return dealt.groupBy("bucket").applyInArrow(
        run, "doc_id long, piece int, start long, length int, bin_id long, bin_size int, bin_offset int"
    )
