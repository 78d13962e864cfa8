"""Shards in random order by a two-pass external shuffle, in DataFrame operations only.

Pass one scatters rows by a seeded hash into as many buckets as it takes for a
bucket to fit in a task's memory; many copies of one row scatter one by one. Pass two shuffles each bucket on its own:
``shuffle`` is a seeded Fisher-Yates shuffle of an array, here of the bucket's
rows in the order of their hash. The buckets one after another are a random
order of the whole table, which is cut into shards of equal row counts (law
``rows``: at most one row apart).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, MapType, StringType, StructType

from ledgerline.llm.common import columns, materialise

SHARDS = 24
SEED = 20_240_501
BUCKET_BYTES = 16 << 20
#: A bucket's offset is two numbers; up to this many offsets go to every task.
BROADCAST_BUCKETS = 200_000
#: Copies of a row are dealt one by one if together they make up this part of a bucket.
HEAVY_PARTS = 8
CHUNK_ROWS = 100_000


def row_bytes(text: Column | str = "text") -> Column:
    """UTF-8 bytes of the text (null: none) plus 8."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 8).cast("long")


def _volume(docs: DataFrame) -> Column:
    """About the bytes of a row in memory: those of its strings and binaries, of what else is of any length as JSON, 8 for others."""
    size = F.lit(8 * len(docs.columns))
    for c, f in zip(columns(docs.columns), docs.schema.fields):
        if isinstance(f.dataType, (StringType, BinaryType)):
            size = size + F.coalesce(F.octet_length(c), F.lit(0))
        elif isinstance(f.dataType, (ArrayType, StructType, MapType)):
            size = size + F.coalesce(F.octet_length(F.to_json(F.struct(c))), F.lit(0))
    return size.cast("long")


def _copies(groups: DataFrame, n: str) -> DataFrame:
    """``groups`` with a row for each of the ``n`` copies, numbered by ``copy`` from 0; chunk by chunk, so that
    a group's copies aren't made in one task."""
    chunks = groups.withColumn("chunk", F.explode(F.expr(f"sequence(0L, ({n} - 1L) div {CHUNK_ROWS}L)")))
    dealt = chunks.repartition("hash", "chunk")
    last = F.expr(f"least({n}, (chunk + 1L) * {CHUNK_ROWS}L) - 1L")
    return dealt.withColumn("copy", F.explode(F.sequence(F.col("chunk") * CHUNK_ROWS, last))).drop("chunk")


def _shuffled(docs: DataFrame, seed: int, bucket_bytes: int) -> tuple[DataFrame, int]:
    """What :func:`shuffle_rows` gives, and the number of rows."""
    names = columns(docs.columns)
    hashed = docs.select(F.xxhash64(F.lit(seed), *names).alias("hash"), _volume(docs).alias("bytes"), F.struct(*names).alias("row"))
    # rows that repeat whole, counted before they are dealt: three numbers for each distinct row
    groups = materialise(hashed.groupBy("hash").agg(F.count(F.lit(1)).alias("n"), F.max("bytes").alias("bytes")))
    total, volume = groups.agg(F.sum("n"), F.sum(F.col("n") * F.col("bytes"))).first()
    buckets = max(1, -(-(volume or 0) // bucket_bytes))
    place = lambda h: F.pmod(h, F.lit(buckets)).cast("int").alias("bucket")
    # a group of copies that would weigh in its bucket is taken apart: each copy goes where its own number says
    heavy = groups.where((F.col("n") > 1) & (F.col("n") * F.col("bytes") > bucket_bytes // HEAVY_PARTS))
    some = heavy.count()  # at most HEAVY_PARTS for each bucket
    salted = F.xxhash64(F.lit(seed), F.col("hash"), F.col("copy"))
    if some:
        hot = heavy.select("hash", "n")
        hot = F.broadcast(hot) if some <= BROADCAST_BUCKETS else hot
        rows = hashed.join(hot.select("hash"), "hash", "left_anti").select("hash", "row")
        one = hashed.join(hot, "hash", "left_semi").groupBy("hash").agg(F.first("row").alias("row"))
        copies = _copies(heavy.select("hash", "n"), "n").join(one, "hash").select(salted.alias("hash"), "row")
        light = groups.join(hot.select("hash"), "hash", "left_anti").select(place(F.col("hash")), "n")
        counts = light.unionAll(_copies(heavy.select("hash", "n"), "n").select(place(salted), F.lit(1).cast("long").alias("n")))
        rows = rows.unionAll(copies)
    else:
        rows, counts = hashed.select("hash", "row"), groups.select(place(F.col("hash")), "n")
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        counts.groupBy("bucket")
        .agg(F.sum("n").alias("n"))  # a row for each bucket from here on
        .select("bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    )
    shuffled = (
        rows.select(place(F.col("hash")), "hash", "row")
        .repartitionById(buckets, "bucket")
        .sortWithinPartitions("bucket", "hash")
        .groupBy("bucket")
        .agg(F.collect_list("row").alias("rows"))
        .select("bucket", F.shuffle("rows", F.lit(seed)).alias("rows"))
        .select("bucket", F.posexplode("rows").alias("at", "row"))
    )
    offsets = F.broadcast(offsets) if buckets <= BROADCAST_BUCKETS else offsets
    placed = shuffled.join(offsets, "bucket").select("row", (F.col("offset") + F.col("at")).alias("position"))
    return placed, total or 0


def shuffle_rows(docs: DataFrame, seed: int = SEED, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """(row, position): the rows of ``docs`` as structs, and their places, from 0, in a seeded random order.

    The rows of a partition come in that order. The same table, seed and
    bucket size give the same order whatever the partitions or retries: rows
    scatter and are sorted by a 64-bit hash of all their columns, and those of
    equal hash are copies of a row. Groups of copies that would fill a good
    part of a bucket are counted first and scattered copy by copy. A bucket is
    measured by the bytes of all columns. Nulls are values like any other. Maps
    can't be hashed and are refused by Spark.
    """
    return _shuffled(docs, seed, bucket_bytes)[0]


def shard(docs: DataFrame, shards: int = SHARDS, seed: int = SEED, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """``docs`` in random order, each row with its ``shard`` (0 to shards - 1) and its ``slot`` in it (gapless from 0).

    Shards differ by one row at most; with fewer rows than shards some are
    empty. Columns of ``docs`` named shard or slot are replaced. An empty table
    gives no rows.
    """
    kept = docs.select(*columns([c for c in docs.columns if c.lower() not in ("shard", "slot")]))
    placed, total = _shuffled(kept, seed, bucket_bytes)
    total = max(1, total)
    number = F.expr(f"CAST((position * {shards}L) div {total}L AS INT)")
    start = F.expr(f"(shard * {total}L + {shards - 1}L) div {shards}L")
    placed = placed.withColumn("shard", number).withColumn("slot", F.col("position") - start)
    return placed.select("row.*", "shard", "slot")


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, seed: int = SEED, bucket_bytes: int = BUCKET_BYTES) -> None:
    """Write the shards as Parquet below ``path``/shard=N; the files of a shard, by name, hold its slots in order."""
    shard(docs, shards, seed, bucket_bytes).write.partitionBy("shard").parquet(path)
