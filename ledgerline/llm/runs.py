"""Periodic runs of words, found with suffix trees.

A run is a maximal stretch of a text's words with smallest period q that is at
least ``min_words`` long and holds at least ``min_periods`` periods. Every run
has a Lyndon root: a Lyndon word of length q inside it which, in one of the two
orders of the alphabet (rising or falling), is the longest Lyndon word that
starts at its place. So the 2n longest Lyndon words of a sequence of n words are
all the candidates that there are; each is extended to both sides and kept if it
is long enough.

The extensions are longest common extensions: forwards on Ukkonen's suffix tree
of the sequence, backwards on that of its reversal. Each is the string depth of
the lowest common ancestor of two leaves, read in constant time from a range
minimum over the depths met on an Euler tour. The longest Lyndon word at a place
ends at the next smaller suffix, whose order is the order of the tree's leaves.

Trees are built over the stretches of a text that can hold a run. In a run every
stretch of ``_gram`` words occurs again, a period away; words in no such stretch
cut the text, and so do, stretch by stretch, those whose nearest copy is further
away than a period can be long there. What is cut away holds no run, and no run
crosses it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MIN_WORDS = 24
MIN_PERIODS = 3
_BLOCK = 16
_BATCH_CHARS = 1 << 22
#: Cuts of the stretches at most; each only leaves away what holds no run.
_ROUNDS = 4

RUN = "struct<start:bigint,length:bigint,period:bigint>"


class SuffixTree:
    """Ukkonen's suffix tree of a sequence of whole numbers above 0. An end mark, smaller than all, closes it."""

    def __init__(self, symbols: list[int]) -> None:
        text = self.text = [*symbols, 0]
        n = len(text)
        # an edge into a node spells text[first:last]; a leaf's goes to the end
        first, last, link = [0], [0], [0]
        children: list[dict[int, int] | None] = [{}]
        node = edge = length = waiting = 0
        for i, symbol in enumerate(text):
            waiting += 1  # suffixes that are not in the tree yet
            unlinked = 0
            while waiting:
                if not length:
                    edge = i
                below = children[node]
                child = below.get(text[edge])
                if child is None:
                    below[text[edge]] = len(first)
                    if unlinked:
                        link[unlinked] = node
                        unlinked = 0
                else:
                    at = first[child]
                    span = last[child] - at
                    if length >= span:
                        edge += span
                        length -= span
                        node = child
                        continue
                    met = text[at + length]
                    if met == symbol:
                        length += 1
                        if unlinked:
                            link[unlinked] = node
                        break
                    middle = len(first)
                    below[text[edge]] = middle
                    first.append(at)
                    last.append(at + length)
                    link.append(0)
                    children.append({met: child, symbol: middle + 1})
                    first[child] = at + length
                    if unlinked:
                        link[unlinked] = middle
                    unlinked = middle
                first.append(i)  # the new leaf
                last.append(n)
                link.append(0)
                children.append(None)
                waiting -= 1
                if node:
                    node = link[node]
                elif length:
                    length -= 1
                    edge = i - waiting + 1
        self.first, self.last, self.children = first, last, children

    def tour(self) -> tuple[list[int], list[int], list[int]]:
        """The Euler tour with children in rising order: string depths in the order met, the place of
        every suffix's leaf on it, and the suffixes in the order of their leaves. A node is met
        before each of its children, which is often enough for the ancestors of leaves."""
        first, last, children = self.first, self.last, self.children
        depths: list[int] = []
        place = [0] * len(self.text)
        order: list[int] = []
        stack = [(0, c) for _, c in sorted(children[0].items(), reverse=True)]
        while stack:
            depth, node = stack.pop()
            depths.append(depth)
            below = children[node]
            if below is None:
                suffix = first[node] - depth
                order.append(suffix)
                place[suffix] = len(depths)
                depths.append(depth + last[node] - first[node])
            else:
                depth += last[node] - first[node]
                for _, c in sorted(below.items(), reverse=True):
                    stack.append((depth, c))
        return depths, place, order

    def falling(self) -> list[int]:
        """The suffixes in order if the order of the symbols is turned round; the end mark stays the smallest."""
        first, last, children = self.first, self.last, self.children
        order: list[int] = []

        def turned(below: dict[int, int]) -> list[int]:
            kept = [c for _, c in sorted(below.items())]
            if 0 in below:  # taken from the end of the stack, so it comes first
                kept = [*kept[1:], kept[0]]
            return kept

        stack = [(0, c) for c in turned(children[0])]
        while stack:
            depth, node = stack.pop()
            below = children[node]
            if below is None:
                order.append(first[node] - depth)
            else:
                depth += last[node] - first[node]
                stack.extend([(depth, c) for c in turned(below)])
        return order


class RangeMinimum:
    """Minima of ranges in constant time: within blocks by running minima, across blocks by a sparse table."""

    def __init__(self, values: list[int]) -> None:
        blocks = max(1, -(-len(values) // _BLOCK))
        padded = np.full(blocks * _BLOCK, np.iinfo(np.int32).max, np.int32)
        padded[: len(values)] = values
        grid = padded.reshape(blocks, _BLOCK)
        self.values = padded
        self.up_to = np.minimum.accumulate(grid, 1).ravel()
        self.onwards = np.minimum.accumulate(grid[:, ::-1], 1)[:, ::-1].ravel()
        self.table = [grid.min(1)]
        while (step := 1 << (len(self.table) - 1)) * 2 <= blocks:
            row = self.table[-1]
            self.table.append(np.minimum(row[:-step], row[step:]))

    def __call__(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """min(values[a..b]), both ends included, for each pair with a <= b."""
        block_a, block_b = a // _BLOCK, b // _BLOCK
        out = np.minimum(self.onwards[a], self.up_to[b])
        between = block_b - block_a - 1
        wide = np.flatnonzero(between > 0)
        level = np.frexp(between[wide])[1] - 1
        for k in np.unique(level):
            these = wide[level == k]
            row = self.table[k]
            inner = np.minimum(row[block_a[these] + 1], row[block_b[these] - (1 << k)])
            out[these] = np.minimum(out[these], inner)
        same = np.flatnonzero(between < 0)
        if same.size:
            reach = a[same, None] + np.arange(_BLOCK)
            reach = np.minimum(reach, b[same, None])
            out[same] = self.values[reach].min(1)
        return out


class Extensions:
    """Longest common extensions of pairs of places of a sequence, from its suffix tree."""

    def __init__(self, symbols: list[int]) -> None:
        self.tree = SuffixTree(symbols)
        depths, place, self.order = self.tree.tour()
        self.place = np.array(place, np.int64)
        self.minimum = RangeMinimum(depths)

    def __call__(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many symbols agree from i and from j on (i and j differ; the sequence's length is a place)."""
        a, b = self.place[i], self.place[j]
        return self.minimum(np.minimum(a, b), np.maximum(a, b)).astype(np.int64)


def next_smaller(order: list[int]) -> np.ndarray:
    """For each suffix of a sequence the next one that is smaller, where its longest Lyndon word ends."""
    n = len(order) - 1  # the end mark's suffix is the smallest
    rank = [0] * (n + 1)
    for r, suffix in enumerate(order):
        rank[suffix] = r
    out = [n] * n
    stack: list[int] = []
    for i in range(n):
        r = rank[i]
        while stack and rank[stack[-1]] > r:
            out[stack.pop()] = i
        stack.append(i)
    return np.array(out, np.int64)


def sequence_runs(symbols: list[int], min_words: int, min_periods: int) -> np.ndarray:
    """(start, length, period) of the runs of a sequence, sorted. Symbols are above 0."""
    n = len(symbols)
    if n < max(2, min_words):
        return np.zeros((0, 3), np.int64)
    forwards = Extensions(symbols)
    ends = [next_smaller(order) for order in (forwards.order, forwards.tree.falling())]
    i = np.tile(np.arange(n), 2)
    j = np.concatenate(ends)
    short = (j - i) * min_periods <= n
    i, j = i[short], j[short]
    after = forwards(i, j)
    del forwards
    backwards = Extensions(symbols[::-1])
    before = backwards(n - i, n - j)
    period = j - i
    length = before + period + after
    found = (length >= min_words) & (length >= min_periods * period)
    rows = np.stack([i - before, length, period], 1)[found]
    return np.unique(rows[:, [0, 2, 1]], axis=0)[:, [0, 2, 1]]


def _gram(min_words: int, min_periods: int) -> int:
    """So many words in a row occur again in any run that holds them: a run of period q has
    at least 2q + gram - 1 words."""
    return max(1, (min_words + 5) // 3) if min_periods >= 3 else 1


def stretches(words: list[bytes], min_words: int, min_periods: int) -> list[tuple[int, int]]:
    """The stretches (from, to) in which every word lies in some ``_gram`` words that occur
    again no further away than the stretch's longest possible period."""
    gram, n = _gram(min_words, min_periods), len(words)
    if n < max(min_words, gram + 1):
        return []
    named = np.fromiter(map(hash, words), np.int64, n).view(np.uint64)
    # equal words give equal hashes, so no repeat is missed; a chance match only leaves a word in
    hashes, width = named * np.uint64(0x9E3779B97F4A7C15), 1
    while width < gram:
        step = min(width, gram - width)
        hashes = (hashes[:-step] * np.uint64(0xD6E8FEB86659FD93)) ^ hashes[step:]
        hashes = (hashes ^ (hashes >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        width += step
    ordered = np.sort(hashes)
    twice = ordered[1:] == ordered[:-1]
    if not twice.any():
        return []
    copies = ordered[1:][twice]
    at = np.flatnonzero(copies[np.minimum(np.searchsorted(copies, hashes), len(copies) - 1)] == hashes)
    # in the order of hash, then place: how far the nearest equal gram is
    at = at[np.argsort(hashes[at], kind="stable")]
    step = np.where(hashes[at[1:]] == hashes[at[:-1]], at[1:] - at[:-1], n)
    near = np.minimum(np.append(step, n), np.insert(step, 0, n))
    near, at = near[order := np.argsort(at)], at[order]
    found = [(0, n)]
    for _ in range(_ROUNDS):
        widest = np.zeros(n, np.int64)  # of the stretch that a place is in, the longest period
        for a, b in (before := found):
            widest[a:b] = (b - a) // min_periods
        near, at = near[keep := near <= widest[at]], at[keep]
        edge = np.zeros(n + 1, np.int64)
        edge[at] += 1
        edge[at + gram] -= 1
        held = np.concatenate([[False], np.cumsum(edge[:-1]) > 0, [False]])
        turn = np.flatnonzero(held[1:] != held[:-1])
        found = [(a, b) for a, b in zip(turn[::2].tolist(), turn[1::2].tolist()) if b - a >= min_words]
        if found == before or not found:
            break
    return found


def word_runs(words: list[bytes], min_words: int = MIN_WORDS, min_periods: int = MIN_PERIODS) -> np.ndarray:
    """(start, length, period) of the runs of a list of words, by start, then period."""
    found = []
    for a, b in stretches(words, min_words, min_periods):
        number: dict[bytes, int] = {}
        symbols = [number.setdefault(w, len(number) + 1) for w in words[a:b]]
        runs = sequence_runs(symbols, min_words, min_periods)
        runs[:, 0] += a
        found.append(runs)
    return np.concatenate(found) if found else np.zeros((0, 3), np.int64)


def collapsed(words: list[bytes], runs: np.ndarray) -> bytes:
    """The words that no run holds after its first period, joined by a space."""
    if not len(runs):
        return b" ".join(words)
    edge = np.zeros(len(words) + 1, np.int64)
    start, length, period = runs.T
    np.add.at(edge, start + period, 1)
    np.add.at(edge, start + length, -1)
    return b" ".join([words[i] for i in np.flatnonzero(np.cumsum(edge[:-1]) == 0).tolist()])


def find_runs(docs: DataFrame, min_words: int = MIN_WORDS, min_periods: int = MIN_PERIODS) -> DataFrame:
    """(doc_id, runs, collapsed) for each row of ``docs``.

    ``runs`` is an array of (start, length, period), by start, then period, places
    and lengths in words from 0; words are what ASCII white space parts. ``collapsed``
    is the text's words, joined by a space, without those that a run holds after its
    first period. A null text counts as empty: no runs, an empty text. Repeated rows
    and ids keep their rows; other columns are ignored; an empty table gives no rows.
    Whole texts are worked on, of any length, in memory in proportion to the text.
    """
    if min_words < 2 or min_periods < 2:
        raise ValueError("a run has two words and two periods at least")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch["doc_id"], batch["text"]
            at = 0
            while at < batch.num_rows:
                begin, size, runs, left = at, 0, [], []
                while at < batch.num_rows and size < _BATCH_CHARS:
                    words = (texts[at].as_py() or b"").split()  # bytes: at ASCII white space only
                    rows = word_runs(words, min_words, min_periods)
                    text = collapsed(words, rows)
                    runs.append([{"start": s, "length": n, "period": q} for s, n, q in rows.tolist()])
                    left.append(text)
                    size += len(text) + 64
                    at += 1
                kind = pa.list_(pa.struct([(k, pa.int64()) for k in ("start", "length", "period")]))
                yield pa.record_batch(
                    [ids.slice(begin, at - begin), pa.array(runs, kind), pa.array(left, pa.binary()).cast(pa.string())],
                    ["doc_id", "runs", "collapsed"],
                )

    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary").alias("text"))
    return texts.mapInArrow(run, f"doc_id long, runs array<{RUN}>, collapsed string")


def foremost(runs: Column) -> Column:
    """The run with the greatest length for its period (exactly); ties: smallest start, then period. Null without runs."""

    def better(best: Column, x: Column) -> Column:
        # the array is in the order of ties, so only a greater ratio takes the place
        return F.when(best.isNull() | (x["length"] * best["period"] > best["length"] * x["period"]), x).otherwise(best)

    return F.aggregate(runs, F.lit(None).cast(RUN), better)


def runs_text(runs: Column) -> Column:
    """A line "start,length,period" for each run."""
    lines = F.transform(runs, lambda x: F.concat_ws(",", x["start"], x["length"], x["period"]))
    return F.array_join(F.transform(lines, lambda x: F.concat(x, F.lit("\n"))), "")
