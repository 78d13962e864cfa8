"""Chat formatting by quotation linking.

Messages quote earlier ones with ``>`` marks, nested quotes with several. Every
message is parsed into its own words and the passages it quotes, each with its
level. Passages are normalised (case, white space) and hashed, whole and by
paragraph, line and sentence, and joined to the hashes of what earlier messages
of the conversation say themselves. The message that most words of the outermost
linked quotes come from is the one replied to; without a linked quote that is
the message before. Replies make threads, and a conversation is written thread
by thread, without its quotes.

A conversation may hold any share of all messages: nothing here is gathered or
sorted by conversation in one task. The latest earlier message with a passage
is found within stretches of turns, then across them; places in a conversation
come from one distributed sort; threads from pointer doubling.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import LAST_ID, dense_ranks, materialise

STRETCH = 4096
_MARKS = re.compile(r"(?:[ \t]{0,3}>)+[ \t]?")
#: Ends of the line that announces a quote.
_SAYS = re.compile(r"(?:wrote|writes|said|schrieb|a écrit|escribió)\s*:\s*$", re.IGNORECASE)
#: Where a sentence ends: behind its end mark and what closes with it.
_ENDS = re.compile(r"(?<=[.!?…])[\"'”’»)\]]*\s+|(?<=[。！？])")


def parse(text: str) -> tuple[str, list[tuple[int, str]]]:
    """A message's own words, and the passages it quotes as (level, text).

    A line's level is the number of ``>`` in front of it. Consecutive lines of
    one level are a passage. A line that announces a quote one level deeper
    belongs to the quote. Without quotes the text comes back as it is.
    """
    if ">" not in text:
        return text, []
    lines = []
    for line in text.split("\n"):
        marks = _MARKS.match(line)
        lines.append((marks.group().count(">"), line[marks.end() :]) if marks else (0, line))
    own: list[str] = []
    passages: list[tuple[int, list[str]]] = []
    before = 0
    for i, (level, line) in enumerate(lines):
        announces = i + 1 < len(lines) and lines[i + 1][0] == level + 1 and _SAYS.search(line)
        if announces:
            before = 0
            continue
        if level:
            if level != before:
                passages.append((level, []))
            passages[-1][1].append(line)
        else:
            own.append(line)
        before = level
    if not passages:
        return text, []
    found = [(level, "\n".join(some)) for level, some in passages]
    return "\n".join(own).strip("\n"), [(level, said) for level, said in found if said.strip()]


def _hash(words: list[str]) -> int:
    value = xxhash.xxh64_intdigest(" ".join(words))
    return value - (1 << 64) if value >> 63 else value


def units(text: str) -> dict[int, int]:
    """Hash to number of words of the normalised text, of its paragraphs, lines and sentences.

    Sentences are taken from paragraphs, so they are the same however lines are broken,
    and from lines, as a list's lines need no end marks. What closes with a sentence
    (quotation marks, brackets) isn't part of it.
    """
    folded = text.casefold()
    paragraphs, lines = re.split(r"\n\s*\n", folded), folded.split("\n")
    sentences = (said.rstrip("\"'”’»)]") for part in (*paragraphs, *lines) for said in _ENDS.split(part))
    parts = {folded, *paragraphs, *lines, *sentences}
    return {_hash(words): len(words) for words in (p.split() for p in parts) if words}


def _parsed(messages: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            said, quoted, own, passages = [], [], [], []
            for value in batch["text"]:
                text = value.as_py()
                body, found = parse(text or "")
                said.append(None if text is None else body)
                passages.append(len(found))
                own.append(list(units(body)))
                quoted.append([
                    (level, _hash(passage.casefold().split()), h, n) for level, passage in found for h, n in units(passage).items()
                ])
            keep = [batch[c] for c in ("c", "t", "role")]
            fields = {"level": pa.int32(), "passage": pa.int64(), "h": pa.int64(), "words": pa.int32()}
            kind = pa.list_(pa.struct(list(fields.items())))
            rows = [[dict(zip(fields, q)) for q in some] for some in quoted]
            new = [pa.array(said, pa.string()), pa.array(passages, pa.int64()), pa.array(own, pa.list_(pa.int64())), pa.array(rows, kind)]
            yield pa.record_batch([*keep, *new], ["c", "t", "role", "text", "quotes", "own", "quoted"])

    return messages.mapInArrow(
        run,
        "c long, t long, role string, text string, quotes long, own array<long>, "
        "quoted array<struct<level:int,passage:long,h:long,words:int>>",
    )


def _sources(parsed: DataFrame) -> DataFrame:
    """(c, t, to, linked, unlinked) of the messages that quote: the message replied to by quote (null
    without one), how many different passages met an earlier message and how many met none."""
    asked = parsed.select("c", "t", F.explode("quoted").alias("q")).select("c", "t", "q.*")
    asked = materialise(asked.groupBy("c", "t", "level", "passage", "h").agg(F.sum("words").alias("words")))
    wanted = materialise(asked.select("c", "h").distinct())
    own = parsed.select("c", "t", F.explode("own").alias("h")).join(wanted, ["c", "h"], "left_semi").distinct()
    stretch = F.expr(f"t div {STRETCH}")
    events = (
        asked.select("c", "h", "t", F.lit(None).cast("long").alias("said"))
        .distinct()
        .unionAll(own.select("c", "h", "t", F.col("t").alias("said")))
        .withColumn("s", stretch)
    )
    near = Window.partitionBy("c", "h", "s").orderBy("t").rangeBetween(Window.unboundedPreceding, -1)
    far = Window.partitionBy("c", "h").orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    within = events.withColumn("last", F.max("said").over(near)).where("said is null")
    across = events.groupBy("c", "h", "s").agg(F.max("said").alias("top")).select("c", "h", "s", F.max("top").over(far).alias("older"))
    found = within.join(across, ["c", "h", "s"]).select("c", "h", "t", F.coalesce("last", "older").alias("to"))
    met = materialise(asked.join(found, ["c", "h", "t"], "left"))
    votes = met.where("to is not null").groupBy("c", "t", "level", "to").agg(F.sum("words").alias("words"))
    best = votes.groupBy("c", "t").agg(F.max(F.struct((-F.col("level")).alias("outer"), "words", "to")).alias("best"))
    passages = met.groupBy("c", "t", "level", "passage").agg(F.bool_or(F.col("to").isNotNull()).alias("met"))
    counted = passages.groupBy("c", "t").agg(F.count_if("met").alias("linked"), F.count_if(~F.col("met")).alias("unlinked"))
    return counted.join(best, ["c", "t"], "left").select("c", "t", "best.to", "linked", "unlinked")


def _threads(links: DataFrame) -> DataFrame:
    """(at, root, depth) of a forest given by (at, up), up null for a root, by pointer doubling."""
    now = materialise(
        links.select(
            "at", F.coalesce("up", "at").alias("root"), F.when(F.col("up").isNull(), 0).otherwise(1).cast("long").alias("depth")
        )
    )
    while True:
        above = now.select(F.col("at").alias("root"), F.col("root").alias("further"), F.col("depth").alias("more"))
        then = materialise(
            now.join(above, "root").select(
                "at", F.col("further").alias("root"), (F.col("depth") + F.col("more")).alias("depth"), "more"
            )
        )
        now = then.drop("more")
        if not then.where("more > 0").limit(1).count():
            return now


def link_conversations(messages: DataFrame) -> DataFrame:
    """Messages in reply order without quotes.

    ``messages`` has conv_id, turn, role and text. Returns for each row conv_id,
    position (from 0 in the conversation), turn, role, text (own words only),
    reply_to (the turn answered, null at a thread's start), thread (its first
    turn), depth, by_quote (whether a quote told), quotes (passages quoted), linked
    and unlinked (how many different passages of the message an earlier one says, in
    whole or in a paragraph, line or sentence, and how many none does).

    Threads come by their first turn, messages in a thread by turn, so a reply
    comes after what it answers. Rows that share conversation and turn are one
    message: they share its place and links, and each keeps its row. A null
    conversation or turn is a value of its own, after all others. A null text
    stays null and says nothing; so does an empty one. Other columns are ignored;
    an empty table gives no rows.
    """
    rows = messages.select(
        F.coalesce(F.col("conv_id").cast("long"), F.lit(LAST_ID)).alias("c"),
        F.coalesce(F.col("turn").cast("long"), F.lit(LAST_ID)).alias("t"),
        F.col("role").cast("string").alias("role"),
        F.col("text").cast("string").alias("text"),
    )
    parsed = materialise(_parsed(rows))
    order = materialise(dense_ranks(parsed.select("c", "t").distinct(), ["c", "t"], "at"))
    told = materialise(_sources(parsed))
    before = order.select(F.col("c").alias("c0"), F.col("t").alias("t0"), (F.col("at") + 1).alias("at"))
    quoted = told.join(order.select("c", F.col("t").alias("to"), F.col("at").alias("to_at")), ["c", "to"], "left")
    linked = materialise(
        order.join(before, "at", "left")
        .join(quoted, ["c", "t"], "left")
        .select(
            "c", "t", "at",
            F.coalesce("to_at", F.when(F.col("c0") == F.col("c"), F.col("at") - 1)).alias("up"),
            F.coalesce("to", F.when(F.col("c0") == F.col("c"), F.col("t0"))).alias("reply_to"),
            F.col("to").isNotNull().alias("by_quote"),
            *[F.coalesce(n, F.lit(0)).alias(n) for n in ("linked", "unlinked")],
        )
    )
    threads = _threads(linked.select("at", "up"))
    starts = order.select(F.col("at").alias("root"), F.col("t").alias("thread"))
    placed = materialise(
        linked.join(threads, "at").join(starts, "root").select("c", "t", "at", "root", "thread", "depth", "reply_to", "by_quote", "linked", "unlinked")
    )
    ranked = materialise(dense_ranks(placed.select("c", "root", "at"), ["c", "root", "at"], "place"))
    first = materialise(ranked.groupBy("c").agg(F.min("place").alias("first")))
    position = ranked.join(first, "c").select("at", (F.col("place") - F.col("first")).alias("position"))
    whole = materialise(placed.join(position, "at"))
    missing = lambda x: F.when(F.col(x) != LAST_ID, F.col(x))
    return parsed.join(whole, ["c", "t"]).select(
        missing("c").alias("conv_id"), "position", missing("t").alias("turn"), "role", "text",
        "reply_to", missing("thread").alias("thread"), "depth", "by_quote", "quotes", "linked", "unlinked",
    )
