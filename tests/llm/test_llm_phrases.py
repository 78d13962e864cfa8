from __future__ import annotations

import hashlib
import random

import numpy as np

from ledgerline.llm import phrases

SF = "/root/testdata/sf0.001"


def names(data: bytes, level: int) -> list[int]:
    symbols = np.frombuffer(data, np.uint8)
    named = phrases._BYTE_NAMES[symbols]
    for lv in range(1, level + 1):
        first = np.zeros(len(symbols), bool)
        first[0] = True
        _, named = phrases.parse(symbols, first, named, lv)
        symbols = named
    return named.tolist()


def test_equal_substrings_share_interior_names():
    rng = random.Random(2)
    shared = bytes(rng.randrange(97, 123) for _ in range(4000))
    for level in (1, 2, 3):
        seen = [names(bytes(rng.randrange(97, 123) for _ in range(n)) + shared + b"tail" * n, level) for n in (1, 17, 203)]
        inner = names(shared, level)[12:-12]
        for other in seen:
            text, part = ",".join(map(str, other)), ",".join(map(str, inner))
            assert part in text


def test_phrases_have_bounded_length():
    rng = random.Random(5)
    data = bytes(rng.randrange(256) for _ in range(20_000)) + b"a" * 500 + b"ab" * 500
    symbols = np.frombuffer(data, np.uint8)
    first = np.zeros(len(symbols), bool)
    first[0] = True
    at, _ = phrases.parse(symbols, first, phrases._BYTE_NAMES[symbols], 1)
    runless = [i for i in range(1, len(data)) if data[i] != data[i - 1]]
    place = {v: i for i, v in enumerate(runless, 1)} | {0: 0}
    gaps = np.diff([place[int(a)] for a in at])
    assert gaps.max() <= 12 and gaps[1:].min() >= 2


def test_one_text_or_many_at_once():
    rng = random.Random(7)
    texts = ["", "a", "aa", "ab" * 40, None, "é☃𝄞"] + ["".join(rng.choice("abc de") for _ in range(rng.randrange(300))) for _ in range(40)]
    assert phrases.to_hex(phrases.sketches(texts)) == [phrases.fingerprint(t) for t in texts]
    assert phrases.fingerprint("") == "0" * 256 != phrases.fingerprint("a")


def test_likeness_follows_the_shared_part():
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("etaoinshrdlu") for _ in range(rng.randrange(2, 9)))
    text = " ".join(word() for _ in range(3000))
    other = " ".join(word() for _ in range(3000))
    got = [
        float(phrases.likeness(*phrases.sketches([text, text[: int(len(text) * (1 - p))] + other[: int(len(text) * p)]])))
        for p in (0, 0.1, 0.5, 1)
    ]
    assert got[0] == 1 and got[1] > 0.6 and 0.15 < got[2] < 0.55 and got[3] < 0.1


def test_likeness_does_not_jump_with_the_length():
    """A text and its first bytes are as alike around 96 bytes as elsewhere."""
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("etaoinshrdlu") for _ in range(rng.randrange(2, 9)))
    texts = [" ".join(word() for _ in range(60))[:130] for _ in range(200)]

    def mean(short, longer):
        return float(phrases.likeness(*(phrases.sketches([t[:n] for t in texts]) for n in (short, longer))).mean())

    assert all(mean(n, n + 3) > 0.7 for n in (84, 94, 95, 110))
    assert abs(mean(90, 100) - mean(105, 115)) < 0.1


def expected(rows):
    """Rows (doc_id, text) in any order -> result rows, with Spark's order of ties taken from ``rows``."""
    out = []
    for i, (doc, text) in enumerate(rows):
        text, following = text or "", rows[(i + 1) % len(rows)][1] or ""
        half = len(text) // 2
        changed = text[: len(text) - half] + following[:half]
        a, b, c = phrases.sketches([text, changed, following])
        out.append(
            (doc, len(text), hashlib.sha256(changed.encode()).hexdigest(), phrases.to_hex([a])[0], phrases.to_hex([b])[0],
             float(phrases.likeness(a, b)), float(phrases.likeness(a, c)))
        )
    return sorted(out, key=str)


def in_order(df):
    from pyspark.sql import functions as F

    got = df.select("doc_id", "text", F.xxhash64("text").alias("h")).orderBy(F.col("doc_id").desc_nulls_last(), "h").collect()
    return [(r.doc_id, r.text) for r in got]


def test_table_equals_plain_version(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = sorted((tuple(r) for r in phrases.fingerprints(docs).collect()), key=str)
    assert got == expected(in_order(docs))


def test_odd_rows(spark, docs_of, odd_rows, with_clashes):
    docs = with_clashes(docs_of(odd_rows))
    got = sorted((tuple(r) for r in phrases.fingerprints(docs).collect()), key=str)
    assert got == expected(in_order(docs))
    assert phrases.fingerprints(docs_of([])).count() == 0
    alone = phrases.fingerprints(docs_of([(1, "alone")])).first()
    assert alone.near_next == 1.0 and alone.n_chars == 5

