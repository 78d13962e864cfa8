"""Line dedup: later copies of repeated line runs go.

A document is the sequence of the ids (64-bit hashes) of its non-blank lines.
Lines that occur once cut the sequences: no repeated run holds one. Prefix
doubling sorts the suffixes of what is left: the rank of a suffix by its first
2k lines is the rank of the pair (rank by k lines, rank by k lines k further
on), each round one distributed sort of the distinct pairs. Suffixes of equal
rank at depth k are an interval of the suffix array with a longest common
prefix of k lines or more.

A run is a repeat if it also occurs earlier (by doc_id, then place) and either has
``min_words`` words or more, or holds a letter and stands in ``common_docs``
documents or more. All lines of such runs go; shorter runs that few documents
share (a brace, ``return 1;`` of two programs) stay. The union of the maximal
repeats that go is the union of the smallest windows that already decide:

* for the words, a window that has them and can't lose both its first and its last
  line for it; it has min_words lines at most;
* for the documents, a line with a letter alone, or with the lines without letters
  between it and the line in question, before or behind. A longer window stands in
  no more documents.

The sort goes on to the full suffix array, as windows of the second kind may have
any length. The interval of a window of n lines is named by the ranks of its first
and its last 2**j lines (2**j <= n < 2**(j+1)); beyond the depth at which the array
was settled, equal ranks mean equal suffixes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import LAST_ID, columns, dense_ranks, fresh, materialise

#: A repeat has so many words, or so many documents hold it.
MIN_WORDS = 10
COMMON_DOCS = 20
WORD = r"[^\x20\x09-\x0D]+"
_DOC = ["id", "th"]


def _split(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _keyed(docs: DataFrame) -> DataFrame:
    """id and th tell documents apart and order them: ids ascending (null last), then texts by hash."""
    return docs.withColumns(
        {"id": F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)), "th": F.xxhash64("text")}
    )


def line_sequence(docs: DataFrame) -> DataFrame:
    """(id, th, pos, line, lid, words, letter): the non-blank lines. pos counts them from 0, line is the place
    among all lines, letter tells whether the line holds one."""
    numbered = F.transform(_split(F.col("text")), lambda x, i: F.struct(i.alias("line"), x.alias("x")))
    solid = F.filter(numbered, lambda s: s["x"].rlike(r"[^\x20\x09-\x0D]"))
    return (
        _keyed(docs.select("doc_id", "text").where("text is not null"))
        .select(*_DOC, F.posexplode(solid).alias("pos", "s"))
        .select(
            *_DOC,
            "pos",
            "s.line",
            F.xxhash64("s.x").alias("lid"),
            F.regexp_count("s.x", F.lit(WORD)).alias("words"),
            F.col("s.x").rlike(r"\p{L}").alias("letter"),
        )
    )


def suffix_ranks(lines: DataFrame, depth: int | None) -> tuple[DataFrame, list[int]]:
    """Ranks of the suffixes at depths 1, 2, 4, ... up to ``depth``, and those depths. Without
    a ``depth`` until a round splits no rank: the last ranks are then the suffix array's.

    ``lines`` as from :func:`line_sequence`. Returns its rows whose line occurs
    more than once with columns r1, r2, r4, ...; a suffix that ends or meets a
    line that occurs once sorts before its longer equals. Rows repeated in
    ``lines`` count once.
    """
    repeated = materialise(lines.groupBy("lid").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("lid"))
    named = materialise(dense_ranks(repeated, ["lid"], "r1"))
    now = materialise(lines.join(named, "lid").drop("lid").dropDuplicates([*_DOC, "pos"]))
    in_doc = Window.partitionBy(*_DOC).orderBy("pos")
    depths = [1]
    while depth is None or depths[-1] * 2 <= depth:
        k, r = depths[-1], f"r{depths[-1]}"
        further = F.when(F.lead("pos", k).over(in_doc) == F.col("pos") + k, F.lead(r, k).over(in_doc))
        paired = now.withColumn("next", F.coalesce(further, F.lit(0)))
        ranks = materialise(dense_ranks(paired.select(r, "next").distinct(), [r, "next"], f"r{2 * k}"))
        now = materialise(paired.join(ranks, [r, "next"]).drop("next"))
        depths.append(2 * k)
        if depth is None and ranks.count() == named.count():
            break
        named = ranks
    return now, depths


def _windows(ranked: DataFrame, depths: list[int], min_words: int) -> DataFrame:
    """(id, th, pos, n, first, last, lines): the windows that can't lose both ends, with
    the ranks that name their interval of the suffix array."""
    in_doc = Window.partitionBy(*_DOC).orderBy("pos")
    ahead = in_doc.rowsBetween(0, min_words - 1)
    cum = F.sum("words").over(in_doc.rowsBetween(Window.unboundedPreceding, 0))
    depths = [k for k in depths if k <= min_words]
    ranks = [f"r{k}" for k in depths]
    row = ranked.withColumn("cum", cum).withColumn(
        "rows", F.collect_list(F.struct("pos", "line", "words", "cum", *ranks)).over(ahead)
    )
    row = row.withColumn("rows", F.filter("rows", lambda x, j: x["pos"] == F.col("pos") + j))
    own = F.col("rows")[0]

    def whole(n: Column) -> Column:  # words of the first n lines
        return F.col("rows")[n - 1]["cum"] - own["cum"] + own["words"]

    fits = F.filter(
        F.sequence(F.lit(1), F.size("rows")),
        lambda n: (whole(n) >= min_words)
        & ((whole(n) - F.col("rows")[n - 1]["words"] < min_words) | (whole(n) - own["words"] < min_words)),
    )
    cut = row.withColumn("n", F.explode(fits))
    first = last = F.lit(None).cast("long")
    for k in depths:
        first = F.when(F.col("n") >= k, own[f"r{k}"]).otherwise(first)
        last = F.when(F.col("n") >= k, F.col("rows")[F.col("n") - k][f"r{k}"]).otherwise(last)
    lines = F.transform(F.slice("rows", 1, F.col("n")), lambda x: F.struct(x["pos"], x["line"]))
    return cut.select(*_DOC, "pos", "n", first.alias("first"), last.alias("last"), lines.alias("lines"))


def _level(n: Column, depths: list[int]) -> Column:
    """The place in ``depths`` (1, 2, 4, ...) of the greatest depth that is at most ``n``."""
    return F.least(F.length(F.bin(n)) - 1, F.lit(len(depths) - 1))


def _letter_windows(ranked: DataFrame, depths: list[int]) -> DataFrame:
    """(id, th, start, pos, line, n, first, last): for each line the windows that reach from it to the nearest
    line with a letter, before and behind, named as in :func:`_windows`; pos and line are the line in question."""
    in_doc = Window.partitionBy(*_DOC).orderBy("pos")
    # lines that occur once part the stretches
    cut = ranked.withColumn("stretch", F.col("pos") - F.row_number().over(in_doc))
    along = Window.partitionBy(*_DOC, "stretch").orderBy("pos")
    before = along.rowsBetween(Window.unboundedPreceding, 0)
    # a frame that begins at its row is summed up anew for each row; from the end on it only grows
    behind = Window.partitionBy(*_DOC, "stretch").orderBy(F.desc("pos")).rowsBetween(Window.unboundedPreceding, 0)
    # ranks by level: the generated code has no branch for each depth
    heads = F.struct("pos", F.array(*[f"r{k}" for k in depths]).alias("ranks"))
    tails = F.struct("pos", F.array(*[F.lag(f"r{k}", k - 1).over(along) for k in depths]).alias("ranks"))  # of the last k lines
    row = cut.withColumns({"head": heads, "tail": tails}).drop(*[f"r{k}" for k in depths])
    row = row.withColumns(
        {
            "opened": F.last(F.when(F.col("letter"), F.col("head")), ignorenulls=True).over(before),
            "closed": F.last(F.when(F.col("letter"), F.col("tail")), ignorenulls=True).over(behind),
        }
    )

    def window(start: Column, end: Column) -> Column:
        n = end["pos"] - start["pos"] + 1
        first, last = (F.get(side["ranks"], _level(n, depths)) for side in (start, end))
        return F.struct(start["pos"].alias("start"), n.alias("n"), first.alias("first"), last.alias("last"))

    opened = F.when(F.col("opened").isNotNull(), window(F.col("opened"), F.col("tail")))
    closed = F.when(F.col("closed").isNotNull() & ~F.col("letter"), window(F.col("head"), F.col("closed")))
    return row.select(*_DOC, "pos", "line", F.explode(F.array_compact(F.array(opened, closed))).alias("w")).select(
        *_DOC, "w.start", "pos", "line", "w.n", "w.first", "w.last"
    )


def deletions(docs: DataFrame, min_words: int = MIN_WORDS, common_docs: int | None = COMMON_DOCS) -> DataFrame:
    """(id, th, gone): for each document that loses lines, their (pos, line) in order. Without
    ``common_docs`` only the number of words makes a repeat."""
    if min_words < 1 or (common_docs is not None and common_docs < 1):
        raise ValueError("min_words and common_docs must be 1 or more")
    ranked, depths = suffix_ranks(materialise(line_sequence(docs)), None)
    windows = materialise(_windows(ranked, depths, min_words))
    key = ["n", "first", "last"]
    origin = F.min(F.struct(*_DOC, "pos")).alias("origin")
    classes = materialise(
        windows.groupBy(*key).agg(origin, F.count(F.lit(1)).alias("copies")).where("copies > 1").drop("copies")
    )
    later = windows.join(classes, key).where(F.struct(*_DOC, "pos") != F.col("origin"))
    gone = later.select(*_DOC, F.explode("lines").alias("l"))
    if common_docs is not None:
        near = materialise(_letter_windows(ranked, depths))
        of_doc = near.groupBy(*key, *_DOC).agg(F.min("start").alias("at"))
        origin = F.min(F.struct(*_DOC, "at")).alias("origin")
        common = materialise(
            of_doc.groupBy(*key).agg(origin, F.count(F.lit(1)).alias("docs")).where(F.col("docs") >= common_docs).drop("docs")
        )
        copies = near.join(common, key).where(F.struct(*_DOC, F.col("start").alias("at")) != F.col("origin"))
        gone = gone.unionAll(copies.select(*_DOC, F.struct("pos", "line").alias("l")))
    return gone.distinct().groupBy(*_DOC).agg(F.sort_array(F.collect_list("l")).alias("gone"))


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS, common_docs: int | None = COMMON_DOCS) -> DataFrame:
    """``docs`` with later copies of repeated line runs cut out of ``text``.

    A run goes if it has ``min_words`` words, or a letter and ``common_docs`` documents.

    Three columns are added: lines_before, lines_deleted and runs_deleted (long;
    maximal runs of deleted lines). The first copy, by doc_id then place, stays.
    A null text stays null and has no lines; blank lines neither count nor go;
    a null id comes after every other; repeated rows (same id and text) are one
    document and lose the same lines. An empty table gives no rows. Columns of
    ``docs`` with the added names are replaced.
    """
    added = ("lines_before", "lines_deleted", "runs_deleted")
    names = [c for c in docs.columns if c not in added]
    key = {"id": fresh(docs, "_id"), "th": fresh(docs, "_th")}
    gone_name = fresh(docs, "_gone")
    gone = materialise(deletions(docs, min_words, common_docs)).withColumnsRenamed(key | {"gone": gone_name})
    values = (F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)), F.xxhash64("text"))
    keyed = docs.select(*columns(names), *[v.alias(k) for k, v in zip(key.values(), values)])
    held = keyed.join(gone, list(key.values()), "left")
    gone = F.col(gone_name)
    lines, out = _split(F.col("text")), F.transform(gone, lambda x: x["line"])
    left = F.filter(lines, lambda x, i: ~F.array_contains(out, i))
    starts = F.filter(gone, lambda x, i: (i == 0) | (gone[F.greatest(i - 1, F.lit(0))]["pos"] + 1 < x["pos"]))
    counts = (
        F.when(F.col("text").isNull(), 0).otherwise(F.size(lines)),
        F.when(gone.isNull(), 0).otherwise(F.size(gone)),
        F.when(gone.isNull(), 0).otherwise(F.size(starts)),
    )
    text = F.when(gone.isNull(), F.col("text")).otherwise(F.array_join(left, "\n")).alias("text")
    kept = [text if name == "text" else c for name, c in zip(names, columns(names))]
    return held.select(*kept, *[c.cast("long").alias(n) for n, c in zip(added, counts)])


def keep_first_lines(docs: DataFrame, min_words: int = MIN_WORDS, common_docs: int | None = COMMON_DOCS) -> DataFrame:
    """``docs`` after :func:`dedup_lines`, its own columns only: n_chars, if there is one,
    counts the new text, and documents of which only blank lines are left go.

    Documents that lose nothing stay as they are: null, empty and white-space texts, too. A
    null id comes after every other; rows that repeat whole lose the same lines and all
    stay or go; an empty table gives no rows."""
    added = {c: fresh(docs, f"_{c}") for c in ("lines_before", "lines_deleted", "runs_deleted") if c in docs.columns}
    out = dedup_lines(docs.withColumnsRenamed(added), min_words, common_docs)
    out = out.where((F.col("lines_deleted") == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    if "n_chars" in docs.columns:
        changed = F.when(F.col("lines_deleted") == 0, F.col("n_chars")).otherwise(F.length("text"))
        out = out.withColumn("n_chars", changed.cast(docs.schema["n_chars"].dataType))
    held = [added.get(c, c) for c in docs.columns]
    return out.select(*[col.alias(c) for col, c in zip(columns(held), docs.columns)])
