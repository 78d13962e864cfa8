from __future__ import annotations

import zlib

from pyspark.sql import functions as F

from ledgerline.llm import queries, sharding

SF = "/root/testdata/sf0.001"


def slots_are_gapless(rows, shards):
    by: dict = {}
    for r in rows:
        by.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(v) == list(range(len(v))) for v in by.values())
    counts = [len(by.get(s, [])) for s in range(shards)]
    assert max(counts) - min(counts) <= 1 and set(by) <= set(range(shards))


def test_rows_are_whole_and_shards_even(spark, docs_of, odd_rows, with_clashes):
    docs = with_clashes(docs_of(odd_rows))
    out = sharding.shard(docs, shards=5, bucket_bytes=300)
    rows = [r.asDict() for r in out.collect()]
    slots_are_gapless(rows, 5)
    kept = [c for c in docs.columns if c not in ("shard", "slot")]
    assert [c for c in out.columns if c not in ("shard", "slot")] == kept
    plain = [f"`{c}`" for c in kept]
    assert out.select(plain).exceptAll(docs.select(plain)).count() == 0 and len(rows) == len(odd_rows)
    assert sharding.shard(docs_of([]), 5).count() == 0


def test_order_is_random_and_repeatable(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")

    def order(df, seed=1, **kw):
        got = sharding.shard(df, 4, seed, **kw).orderBy("shard", "slot")
        return [r.doc_id for r in got.select("doc_id").collect()]

    a = order(docs, bucket_bytes=50_000)
    assert a == order(docs.repartition(7), bucket_bytes=50_000)
    assert a != order(docs, seed=2, bucket_bytes=50_000)
    assert sorted(a) == sorted(r.doc_id for r in docs.collect())
    n = len(a)
    # neighbours in the shuffled order are as far apart as chance has it (n / 3)
    step = sum(abs(x - y) for x, y in zip(a, a[1:])) / (n - 1)
    assert 0.25 * max(a) < step < 0.42 * max(a)


def test_the_shuffle_permutes_each_bucket(spark):
    """Within a bucket the order isn't that of the hash: the Fisher-Yates pass has an effect, and every place is as likely."""
    places = [0] * 6
    for seed in range(60):
        df = spark.range(6).selectExpr("id AS doc_id", "CAST(id AS string) AS text")
        got = sharding.shard(df, 1, seed).where("doc_id = 3").first()
        places[got.slot] += 1
    assert min(places) >= 2 and max(places) <= 24


def test_written_shards_keep_slot_order(spark, fresh_dir):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    path = fresh_dir("shards")
    sharding.write_shards(docs, path, 4, bucket_bytes=50_000)
    back = spark.read.parquet(path)
    assert back.count() == docs.count()
    first = back.where("shard = 2").select("slot", F.input_file_name().alias("f"), F.monotonically_increasing_id().alias("i")).collect()
    assert [r.slot for r in sorted(first, key=lambda r: (r.f, r.i))] == list(range(len(first)))


def test_query_digests(spark):
    rows = queries.op4_sharding(spark, SF).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    slots_are_gapless([r.asDict() for r in rows], 24)
    assert len(rows) == len(texts)
    for r in rows:
        raw = texts[r.doc_id].encode()
        assert (r["size"], r.text_crc32, r.law, r.grown_shard) == (len(raw) + 8, zlib.crc32(raw), "rows", None)


def test_no_python_in_the_plan(spark):
    plan = queries.op4_sharding(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


def test_copies_of_a_row_spread(spark):
    """20,000 equal rows that need 77 buckets use them, and the order holds whatever the partitions."""
    rows = spark.range(20_000).selectExpr("CAST(7 AS LONG) AS doc_id", "repeat('x', 400) AS text")
    volume = 20_000 * (16 + 400)
    out, total = sharding._shuffled(rows, 1, -(-volume // 77))
    assert total == 20_000
    used = out.select("position", F.spark_partition_id().alias("p"))
    sizes = sorted(r["count"] for r in used.groupBy("p").count().collect())
    assert len(sizes) >= 70 and sizes[-1] < 4 * 20_000 / 77
    assert used.select("position").distinct().count() == 20_000
    assert used.agg(F.max("position")).first()[0] == 19_999


def test_copies_among_other_rows(spark, monkeypatch):
    monkeypatch.setattr(sharding, "CHUNK_ROWS", 64)
    some = spark.range(2_000).selectExpr("id AS doc_id", "concat('text ', id % 100) AS text")
    hot = spark.range(1_000).selectExpr("CAST(NULL AS LONG) AS doc_id", "'copy' AS text")
    twice = spark.range(900).selectExpr("5 + id % 3 AS doc_id", "'another' AS text")
    docs = some.unionAll(hot).unionAll(twice)

    def order(df):
        rows = [r.asDict() for r in sharding.shard(df, 7, 3, bucket_bytes=4_000).collect()]
        slots_are_gapless(rows, 7)
        return sorted((r["shard"], r["slot"], str(r["doc_id"]), r["text"]) for r in rows)

    first = order(docs)
    assert first == order(docs.repartition(13))
    assert sorted((d, t) for _, _, d, t in first) == sorted((str(r.doc_id), r.text) for r in docs.collect())
    # copies are spread over the shards like any rows
    assert all(80 < sum(1 for s, *_, t in first if s == k and t == "copy") < 220 for k in range(7))


def test_ties_in_id_and_text_have_an_order(spark):
    tied = spark.range(500).selectExpr("1L AS doc_id", "'same' AS text", "id AS other")

    def order(df):
        return [r.other for r in sharding.shard(df, 3, bucket_bytes=2_000).orderBy("shard", "slot").collect()]

    assert order(tied) == order(tied.repartition(9)) == order(tied.orderBy(F.desc("other")))


def test_wide_columns_count(spark):
    wide = spark.range(1_000).selectExpr("id AS doc_id", "'t' AS text", "repeat('y', 1000) AS extra", "array(id) AS a")
    used = sharding.shuffle_rows(wide, bucket_bytes=20_000).select(F.spark_partition_id().alias("p")).distinct().count()
    assert used >= 40


def test_the_table_is_read_at_most_twice(spark):
    read = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    n = docs.count()
    assert sharding.shard(docs.mapInArrow(count, docs.schema)).count() == n
    assert read.value <= 2 * n
