from __future__ import annotations

import gzip
import hashlib
import os

import duckdb
import pytest
from pyspark.sql import functions as F

from ledgerline.llm import queries, warc
from tools.compare import digest

SF = "/root/testdata/sf0.001"
PAGE = "page_id long, url string, html string"


def expected(pages):
    """Rows straight from the wording: payload, digest, response or revisit."""
    first = {}
    for i, _, html in pages:
        raw = (html or "").encode()
        if len(raw) >= 100 and i is not None:
            first[raw] = min(first.get(raw, i), i)
    out = []
    for i, _, html in pages:
        raw = (html or "").encode()
        one = first.get(raw)
        of = one if one is not None and i != one else None
        out.append((i, len(raw), hashlib.sha256(raw).hexdigest(), "response" if of is None else "revisit", of))
    return sorted(out, key=str)


def result(df):
    return sorted((tuple(r) for r in df.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()), key=str)


ODD = [
    (1, "http://a.example.com/x", "<p>" + "é" * 60),
    (2, "http://b.example.com/x", "<p>" + "é" * 60),
    (2, "http://b.example.com/x", "<p>" + "é" * 60),  # a repeated row
    (3, None, "<p>" + "é" * 60),
    (4, "http://a.example.com/x", "short"),
    (5, "http://a.example.com/x", "short"),
    (6, "", None),
    (7, "not a url\nwith\tbreaks", ""),
    (8, "https://A.example.com:8080/Ünï?q=1&r=\\#top", "x" * 100),
    (9, "http://[::1", "x" * 100),
    (None, "http://a.example.com/x", "x" * 100),
    (None, None, "y" * 200),
    (None, None, "y" * 200),
    (10, "http://a.example.com/x", "\r\n\r\nWARC/1.1\r\n\r\n" * 20),
    (11, "http://a.example.com/x", "long " * 400_000),
    (-5, "http://a.example.com/x", "z" * 99),
    (12, "http://a.example.com/x", "z" * 99),
    (-6, "http://c.example.com/", "w" * 300),
    (13, "http://c.example.com/", "w" * 300),
]


@pytest.fixture
def odd(spark, with_clashes):
    return with_clashes(spark.createDataFrame(ODD, PAGE).repartition(4))


def test_archive_and_read_back(spark, odd, fresh_dir):
    folder = fresh_dir("warc")
    warc.archive(odd, folder)
    found = warc.open_archive(spark, folder, odd)
    assert result(warc.resolve(found)) == expected(ODD)
    # responses hold their whole payload and URL
    told = sorted(((r.page_id, r.url, bytes(r.payload).decode()) for r in found.where("record_type = 'response'").collect()), key=str)
    by_id = {(i, h): u for i, u, h in ODD}
    assert all(by_id[i, html or None] == url if html else True for i, url, html in told)
    assert [x for x in told if x[0] == 11][0][2] == "long " * 400_000


def test_small_blocks_and_files(spark, fresh_dir):
    """One-line blocks, an archive file for each record, hot URLs over many blocks and shards."""
    pages = [(i, "http://hot.example.com/a" if i % 3 else f"http://h{i % 7}.example.com/{i}", f"{i % 40:0>150}") for i in range(400)]
    df = spark.createDataFrame(pages, PAGE).repartition(5)
    folder = fresh_dir("warc-small")
    captures = warc.write_archives(df, folder, archive_bytes=1)
    shards = warc.build_index(captures, folder, block_lines=2)
    assert shards.count() > 1
    files = os.listdir(f"{folder}/archive".removeprefix("file:"))
    assert len([f for f in files if f.endswith(".warc.gz")]) == 400
    assert result(warc.resolve(warc.open_archive(spark, folder, df))) == expected(pages)


def test_lookup_finds_what_is_asked_for(spark, odd, fresh_dir):
    folder = fresh_dir("warc-look")
    warc.archive(odd, folder)
    asked = spark.createDataFrame(
        [("http://www.B.example.com/x#part", 2), ("http://a.example.com/x", 4), ("http://a.example.com/x", 77), ("zzz", 1), ("http://0/", 1)],
        "url string, page_id long",
    )
    found = warc.open_archive(spark, folder, asked)
    assert sorted(r.page_id for r in found.collect()) == [2, 2, 4]


def test_index_reads_few_blocks(spark, fresh_dir):
    pages = [(i, f"http://example.com/{i:05d}", "x") for i in range(1000)]
    folder = fresh_dir("warc-blocks")
    warc.build_index(warc.write_archives(spark.createDataFrame(pages, PAGE), folder), folder, block_lines=10)
    index = warc.Index(folder, [tuple(r) for r in spark.read.parquet(f"{folder}/shards").collect()])
    assert len(list(index.find(warc.capture_key("http://example.com/00500", 500)))) == 1
    assert index.reads <= 2
    assert list(index.find(warc.capture_key("http://example.com/00500", 501))) == []


def test_files_of_lost_attempts_are_not_read(spark, odd, fresh_dir):
    folder = fresh_dir("warc-lost")
    warc.archive(odd, folder)
    root = folder.removeprefix("file:")
    with open(f"{root}/archive/stray.warc.gz", "wb") as f:
        f.write(gzip.compress(warc.record(1, "http://a.example.com/x", b"other", hashlib.sha256(b"other").hexdigest(), None))[:40])
    with open(f"{root}/index/stray.directory", "w") as f:
        f.write("broken")
    assert result(warc.resolve(warc.open_archive(spark, folder, odd))) == expected(ODD)


def test_records():
    sha = hashlib.sha256(b"a\r\n\r\nb").hexdigest()
    raw = warc.record(5, 'http://x/"q"\r\nHost: y', b"a\r\n\r\nb", sha, 5)
    told = warc.parse(raw)
    assert told["url"] == 'http://x/"q"\r\nHost: y' and told["payload"] == b"a\r\n\r\nb" and told["record_type"] == "response"
    again = warc.parse(warc.record(6, None, b"a\r\n\r\nb", sha, 5))
    assert again == {
        "page_id": 6, "url": None, "record_type": "revisit", "payload_bytes": 6, "payload_digest": sha, "refers_to": 5, "payload": None
    }
    with pytest.raises(ValueError):
        warc.parse(raw[:-6])
    with pytest.raises(ValueError):
        warc.parse(raw.replace(b"\r\n\r\nb\r\n", b"\r\n\r\nc\r\n"))


def test_keys():
    assert warc.url_key("http://www.Example.com/A?b=c#d") == "com,example)/A?b=c"
    assert warc.url_key("https://m.example.com:444") == "com,example,m:444)/"
    assert warc.url_key(None) == "" and warc.url_key("a\tb") == " a%09b"
    ids = [-(1 << 63), -7, 0, 3, 20, (1 << 63) - 1, None]
    keys = [warc.capture_key("http://x/", i) for i in ids]
    assert keys == sorted(keys)


def test_empty_table(spark, fresh_dir):
    folder = fresh_dir("warc-none")
    none = spark.createDataFrame([], PAGE)
    warc.archive(none, folder)
    asked = spark.createDataFrame([("http://x/", 1)], "url string, page_id long")
    assert warc.open_archive(spark, folder, asked).count() == 0
    assert warc.resolve(warc.open_archive(spark, folder, none)).count() == 0


def test_a_revisit_needs_its_response(spark, odd, fresh_dir):
    folder = fresh_dir("warc-half")
    warc.archive(odd, folder)
    found = warc.open_archive(spark, folder, odd).where((F.col("record_type") == "revisit"))
    with pytest.raises(Exception, match="no response for the revisit"):
        warc.resolve(found).collect()


def test_query_equals_sql(spark, fresh_dir, with_clashes):
    copies = spark.read.parquet(f"{SF}/pages.parquet")
    twice = copies.unionByName(copies.where("page_id % 3 = 0").withColumn("page_id", F.col("page_id") + 100_000))
    folder = fresh_dir("warc-sql")
    twice.repartition(3).write.parquet(f"{folder}/pages.parquet")
    for where in (SF, folder):
        df = queries.op12_warc(spark, where)
        rows = [tuple(r) for r in df.collect()]
        con = duckdb.connect()
        files = f"{where}/pages.parquet" if where == SF else f"{where.removeprefix('file:')}/pages.parquet/*.parquet"
        con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{files}')")
        told = con.execute(queries.ORACLE["op12_warc"])
        columns = [d[0] for d in told.description]
        assert digest(df.columns, rows)[0] == digest(columns, told.fetchall())[0]
    assert {r[df.columns.index("record_type")] for r in rows} == {"response", "revisit"}
