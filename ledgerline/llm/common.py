"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerline.session import shared_root

#: Order key of a missing id: it comes after every real one.
LAST_ID = (1 << 63) - 1


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialise(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the folder of ``spark.checkpoint.dir``."""
    shared_root(df.sparkSession)
    return df.checkpoint(eager=True)


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` hasn't got."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def columns(names: Sequence[str]) -> list[Column]:
    """Columns by their exact names, dots and all."""
    return [F.col("`" + name.replace("`", "``") + "`") for name in names]


def train_row(doc_id: Column | str = "doc_id") -> Column:
    """True where a document may be learnt from: crc32 of its id as text, mod 4, is not 2."""
    doc_id = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 != 2, F.lit(False))


def held_out(doc_id: Column | str = "doc_id") -> Column:
    """True where that remainder is 2 (a null id has none, so it is False)."""
    doc_id = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def hash_order(*keys: str) -> Column:
    """A hash of the columns, from 0 to 2**63 - 1."""
    return F.shiftrightunsigned(F.xxhash64(*keys), 1)


def hash_bound(rows: int, total: int) -> int:
    """A bound of :func:`hash_order` below which about 2 * ``rows`` of ``total`` rows lie, so that a
    search for the ``rows`` smallest hashes sorts no more than these, however many tasks there are."""
    return min(1 << 63, (1 << 63) * (2 * rows + 100) // max(1, total)) - 1


def smallest_hashes(df: DataFrame, rows: int, total: int, *keys: str) -> DataFrame:
    """The ``rows`` rows of the ``total`` of ``df`` with the smallest hashes of ``keys``."""
    h = hash_order(*keys)
    return df.where(h <= hash_bound(rows, total)).orderBy(h, *keys).limit(rows)


def dense_ranks(keys: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """Number distinct rows 1, 2, ... in the order of ``order`` over the whole table.

    A range partitioning sorts the keys, each partition numbers its own rows,
    and the partitions' row counts (one row for each partition) give the
    offsets, so no task sees more than its own range.
    """
    parts = int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = materialise(
        keys.repartitionByRange(parts, *order).withColumn("_part", F.spark_partition_id())
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        dealt.groupBy("_part")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    )
    within = Window.partitionBy("_part").orderBy(*order)
    return (
        dealt.join(F.broadcast(offsets), "_part")  # one row for each shuffle partition
        .withColumn(name, F.col("_offset") + F.row_number().over(within))
        .drop("_part", "_offset")
    )


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One large-star or small-star step; edges are (u, v) with u > v."""
    if large:
        near = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        near = edges
    # written out, so that the join below has a plain shuffle on both sides
    # and the optimiser can split a hub's rows
    least = materialise(near.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")))
    moved = near.join(least, "u")
    if large:
        out = moved.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = moved.where(F.col("v") > F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        out = out.unionAll(least.select("u", F.col("m").alias("v")))
    return out.distinct()


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Components of an undirected graph: (node, root), root the smallest node.

    ``edges`` has two long columns u and v; loops, repeated and reversed edges
    are allowed, nodes without edges don't appear. Large-star and small-star
    steps alternate until nothing moves; every step's edges go to the shared
    checkpoint folder, and only a count and a checksum reach the driver.
    """
    now = materialise(
        edges.where("u <> v")
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct()
    )

    def state(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())

    seen = state(now)
    for _ in range(max_rounds):
        if not seen[0]:
            break
        now = materialise(_star(_star(now, True), False))
        if (then := state(now)) == seen:
            break
        seen = then
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(
        now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
