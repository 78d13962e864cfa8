from __future__ import annotations

import random

from ledgerline.llm import quotes

SCHEMA = "conv_id long, turn long, role string, text string"


def linked(spark, rows, clashes=lambda df: df):
    out = quotes.link_conversations(clashes(spark.createDataFrame(rows, SCHEMA))).collect()
    return sorted(out, key=lambda r: (r.conv_id is None, r.conv_id or 0, r.position, r.role or "", r.text or ""))


def test_parse_levels_and_announcements():
    text = "Hi,\nAnn wrote:\n> first line\n> second line\n>> deeper\n> > also deeper\n>\n> back\nmy answer\n> other"
    assert quotes.parse(text) == (
        "Hi,\nmy answer",
        [(1, "first line\nsecond line"), (2, "deeper\nalso deeper"), (1, "\nback"), (1, "other")],
    )
    assert quotes.parse("a > b") == ("a > b", []) and quotes.parse("") == ("", [])
    assert quotes.parse("> all quoted") == ("", [(1, "all quoted")])
    assert quotes.parse("5\n> \n6") == ("5\n6", [])


def test_reply_order_and_nested_quotes(spark):
    rows = [
        (1, 0, "user", "How do I sort a table?\n\nAnd how do I filter it?"),
        (1, 1, "assistant", "Use orderBy for the sort."),
        (1, 2, "user", "Bob wrote:\n> How do I sort  a table?\nSame question here."),
        (1, 3, "assistant", "> and how do i FILTER it?\nUse where."),
        (1, 4, "user", ">> How do I sort a table?\n> Use orderBy for the sort.\nThanks!"),
        (1, 5, "user", "No quote at all."),
        (2, 7, "user", "> Use where.\nquoted from another conversation"),
        (2, 9, "user", "Use where."),
    ]
    got = linked(spark, rows)
    of = {(r.conv_id, r.turn): r for r in got}
    assert of[1, 2].reply_to == 0 and of[1, 2].by_quote and of[1, 2].text == "Same question here."
    assert of[1, 3].reply_to == 0 and of[1, 3].text == "Use where."
    assert of[1, 4].reply_to == 1 and of[1, 4].quotes == 2 and of[1, 4].depth == 2
    assert of[1, 1].reply_to == 0 and not of[1, 1].by_quote  # no quote: the message before
    assert of[1, 5].reply_to == 4 and of[1, 5].depth == 3
    assert of[2, 7].reply_to is None and of[2, 9].reply_to == 7  # a quote of another conversation links nothing
    assert [(r.conv_id, r.turn) for r in got] == [(1, t) for t in range(6)] + [(2, 7), (2, 9)]
    assert [r.position for r in got] == [0, 1, 2, 3, 4, 5, 0, 1]


def test_a_sentence_of_a_longer_line_is_found(spark):
    rows = [
        (1, 0, "user", "I have a table of orders. It is very wide, and\nslow to read! What can I do?"),
        (1, 1, "assistant", "Read fewer columns (\"prune them.\") Then it is fast."),
        (1, 2, "user", "> What can I do?\nSame here."),
        (1, 3, "user", "> It is very wide,\n> and slow to read!\nMine too.\n> Nobody said this.\nOr so."),
        (1, 4, "user", "> Then it is fast.\n> Words of an unknown message.\nThanks."),
        (1, 5, "user", "> prune them.\nHow?"),
        (1, 6, "user", "> Nobody said this.\nIndeed."),
        (1, 7, "user", "这是第一句。这是第二句。"),
        (1, 8, "user", "no quote"),
        (1, 9, "user", "> 这是第二句。\n对"),
    ]
    of = {r.turn: r for r in linked(spark, rows)}
    assert [(t, of[t].reply_to, of[t].by_quote) for t in (2, 3, 4, 9)] == [(2, 0, True), (3, 0, True), (4, 1, True), (9, 7, True)]
    assert [(of[t].quotes, of[t].linked, of[t].unlinked) for t in (0, 2, 3, 4, 6)] == [(0, 0, 0), (1, 1, 0), (2, 1, 1), (1, 1, 0), (1, 0, 1)]
    assert (of[6].reply_to, of[6].by_quote) == (5, False)  # quotes what no message says: the message before
    assert (of[5].reply_to, of[5].by_quote, of[5].unlinked) == (4, False, 1)  # a part of a sentence isn't one


def brute(rows):
    """reply_to by looking at every earlier message of the conversation, and the passages with and without a link."""
    out = {}
    by: dict = {}
    for c, t, _, text in rows:
        body, passages = quotes.parse(text)
        by.setdefault(c, {})[t] = (set(quotes.units(body)), passages)
    for c, turns in by.items():
        for t, (_, passages) in turns.items():
            asked: dict = {}
            for level, passage in passages:
                for h, n in quotes.units(passage).items():
                    asked[level, h] = asked.get((level, h), 0) + n
            votes: dict = {}
            kinds = {(level, " ".join(p.casefold().split())): set(quotes.units(p)) for level, p in passages}
            met = sum(any(h in turns[u][0] for u in turns if u < t for h in hashes) for hashes in kinds.values())
            for (level, h), n in asked.items():
                said = [u for u in turns if u < t and h in turns[u][0]]
                if said:
                    votes[level, max(said)] = votes.get((level, max(said)), 0) + n
            if votes:
                level, to = max(votes, key=lambda k: (-k[0], votes[k], k[1]))
            else:
                to = max((u for u in turns if u < t), default=None)
            out[c, t] = (to, bool(votes), met, len(kinds) - met)
    return out


def test_random_threads_equal_brute_force(spark, monkeypatch):
    rng = random.Random(6)
    rows = []
    for c in range(6):
        said: list = []
        for t in sorted(rng.sample(range(200), 40)):
            parts = [" ".join(rng.choice(["ok", "yes", "no", "why", "well"]) for _ in range(rng.randrange(1, 4))) for _ in range(rng.randrange(1, 4))]
            if said and rng.random() < 0.7:
                parts[:0] = [">" * rng.randrange(1, 3) + " " + line for line in rng.choice(said)[: rng.randrange(1, 4)]]
            said.append([p for p in parts if not p.startswith(">")])
            rows.append((c, t, "user", "\n".join(parts)))
    want = brute(rows)
    monkeypatch.setattr(quotes, "STRETCH", 16)  # many stretches in each conversation
    got = linked(spark, rows)
    assert {(r.conv_id, r.turn): (r.reply_to, r.by_quote, r.linked, r.unlinked) for r in got} == want
    place = {(r.conv_id, r.turn): r.position for r in got}
    for r in got:
        if r.reply_to is None:
            assert r.thread == r.turn and r.depth == 0
        else:
            assert place[r.conv_id, r.reply_to] < r.position
            up = next(x for x in got if (x.conv_id, x.turn) == (r.conv_id, r.reply_to))
            assert up.thread == r.thread and up.depth + 1 == r.depth
    for c in range(6):
        assert sorted(r.position for r in got if r.conv_id == c) == list(range(40))


def test_odd_rows(spark, with_clashes):
    rows = [
        (1, 0, "user", "same"), (1, 0, "user", "same"), (1, 0, None, "other variant"), (1, 1, "user", None),
        (1, 2, "user", ""), (1, None, "user", "no turn"), (None, 3, "user", "no conversation"), (None, 4, "user", "> no conversation"),
        (None, None, None, None), (2, -5, "user", "> x\n" * 50_000 + "y"),
    ]
    got = linked(spark, rows, with_clashes)
    assert len(got) == len(rows)
    one = [(r.position, r.turn, r.text) for r in got if r.conv_id == 1]
    assert [p for p, *_ in one] == [0, 0, 0, 1, 2, 3] and one[3][2] is None and one[4][2] == "" and one[5][1] is None
    none = [r for r in got if r.conv_id is None]
    assert [(r.turn, r.reply_to, r.text) for r in none] == [(3, None, "no conversation"), (4, 3, ""), (None, 4, None)]
    assert [r.text for r in got if r.conv_id == 2] == ["y"]
    assert quotes.link_conversations(spark.createDataFrame([], SCHEMA)).count() == 0


def test_table_is_whole(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    out = quotes.link_conversations(table)
    assert out.count() == table.count()
    got = {(r.conv_id, r.turn): (r.reply_to, r.by_quote, r.linked, r.unlinked) for r in out.collect()}
    assert got == brute([(r.conv_id, r.turn, r.role, r.text) for r in table.collect()])
    assert out.select("conv_id", "turn", "role", "text").exceptAll(table.select("conv_id", "turn", "role", "text")).count() == 0
