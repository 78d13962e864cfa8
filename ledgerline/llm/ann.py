"""Approximate nearest neighbours by learned partitions.

A bounded sample of the vectors gives a neighbour graph, which is cut into
parts of nearly equal size with few edges between them. A small classifier
(one hidden layer) learns where a vector's neighbours lie: for each part, the
share of them in it. It puts every vector into its most probable part, and
sends a query to its most probable ones; how many is measured on sample queries
that the classifier has not seen. A part that is still large is cut once more in
the same way, by a sample and a classifier of its own, so parts stay near
``part_rows`` vectors however many rows there are; a query goes down into the
parts that it asks. All vectors of the last parts are scored exactly in double
precision. A query's k-th best score among the sample vectors of the parts it
asks is a lower bound for its result, so cells return only what reaches it.

The work of a part is cut into cells of at most about ``cell_rows`` vectors and
``cell_rows`` queries by hashes of their rows, so a part that holds a third of
the table (copies can't be cut) is no larger task than any other. Classifiers
are fitted in tasks, one for each part that is cut, and meet its rows in a join.
"""

from __future__ import annotations

import io
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import hash_order, materialise, smallest_hashes

NEIGHBOURS = 20
SAMPLE_ROWS = 8192
PART_ROWS = 2048
MAX_PARTS = 128
CELL_ROWS = 4096
RECALL = 0.95
#: Rows of (part, number) that may be broadcast; more of them are joined by a shuffle.
SMALL_ROWS = 1 << 16
#: A part's children are numbered from its own number times this. Parts of length-d vectors start at d * _FAN.
_FAN = 2 * MAX_PARTS
_LEVELS = 4
_GRAPH = 10
_HIDDEN = 128
_EPOCHS = 40


@dataclass
class Router:
    """The classifier, and the number of parts that reaches the wished recall on the sample."""

    shift: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: np.ndarray
    probes: int = 1

    @property
    def parts(self) -> int:
        return len(self.b2)

    def scores(self, x: np.ndarray) -> np.ndarray:
        return np.maximum((x - self.shift) @ self.w1 + self.b1, 0) @ self.w2 + self.b2

    def dump(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, **vars(self))
        return out.getvalue()

    @classmethod
    def load(cls, data: bytes) -> Router:
        with np.load(io.BytesIO(data)) as held:
            return cls(**{name: held[name] for name in held.files} | {"probes": int(held["probes"])})


def _nearest(x: np.ndarray, queries: np.ndarray, k: int) -> np.ndarray:
    """Indices (queries, k) of the largest inner products, a query's own row left out."""
    out = np.empty((len(queries), k), np.int64)
    for start in range(0, len(queries), 1024):
        rows = queries[start : start + 1024]
        near = x[rows] @ x.T
        near[np.arange(len(rows)), rows] = -np.inf
        out[start : start + len(rows)] = np.argpartition(-near, k - 1, axis=1)[:, :k]
    return out


def balanced_parts(x: np.ndarray, graph: np.ndarray, parts: int, rng: np.random.Generator) -> np.ndarray:
    """Cut the neighbour graph into ``parts`` parts, none above 1.1 times the mean size.

    Vertices start with the nearest of ``parts`` seeds that has room; then each
    in turn moves to where most of its neighbours are, if that part has room.
    """
    n = len(x)
    room = int(np.ceil(1.1 * n / parts))
    seeds = [int(rng.integers(n))]
    gap = ((x - x[seeds[0]]) ** 2).sum(1)
    while len(seeds) < parts:  # far from the seeds so far, by chance in proportion
        seeds.append(int(rng.choice(n, p=gap / gap.sum())) if gap.sum() > 0 else int(rng.integers(n)))
        gap = np.minimum(gap, ((x - x[seeds[-1]]) ** 2).sum(1))
    centres = x[seeds]
    for _ in range(5):
        near = (centres**2).sum(1) - 2 * x @ centres.T
        own = near.argmin(1)
        centres = np.stack([x[own == p].mean(0) if (own == p).any() else centres[p] for p in range(parts)])
    size = np.zeros(parts, np.int64)
    part = np.full(n, -1)
    for v in near.min(1).argsort():
        for p in near[v].argsort():
            if size[p] < room:
                part[v] = p
                size[p] += 1
                break
    both = np.concatenate([np.stack([np.repeat(np.arange(n), graph.shape[1]), graph.ravel()]),
                           np.stack([graph.ravel(), np.repeat(np.arange(n), graph.shape[1])])], axis=1)
    both = both[:, both[0].argsort(kind="stable")]
    ends = np.searchsorted(both[0], np.arange(n + 1))
    for _ in range(8):
        moved = 0
        for v in rng.permutation(n):
            votes = np.bincount(part[both[1, ends[v] : ends[v + 1]]], minlength=parts)
            p = int((votes - 1e9 * (size >= room)).argmax())
            if p != part[v] and votes[p] > votes[part[v]]:
                size[part[v]] -= 1
                size[p] += 1
                part[v] = p
                moved += 1
        if moved < n // 200:
            break
    return part


def _learn(x: np.ndarray, target: np.ndarray, rng: np.random.Generator) -> Router:
    """Adam on the cross entropy to the target shares."""
    d, parts = x.shape[1], target.shape[1]
    spread = max(float(x.std()), 1e-9)
    router = Router(
        x.mean(0), rng.normal(0, (2 / d) ** 0.5 / spread, (d, _HIDDEN)), np.zeros(_HIDDEN),
        rng.normal(0, (1 / _HIDDEN) ** 0.5, (_HIDDEN, parts)), np.zeros(parts),
    )
    weights = [router.w1, router.b1, router.w2, router.b2]
    scale = [1 / spread, 1, 1, 1]
    first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    step = 0
    for _ in range(_EPOCHS):
        for rows in np.array_split(rng.permutation(len(x)), max(1, len(x) // 128)):
            z = x[rows] - router.shift
            hidden = np.maximum(z @ router.w1 + router.b1, 0)
            out = hidden @ router.w2 + router.b2
            e = np.exp(out - out.max(1, keepdims=True))
            g = (e / e.sum(1, keepdims=True) - target[rows]) / len(rows)
            back = (g @ router.w2.T) * (hidden > 0)
            step += 1
            for w, grad, m, v, s in zip(weights, (z.T @ back, back.sum(0), hidden.T @ g, g.sum(0)), first, second, scale):
                m += 0.1 * (grad - m)
                v += 0.001 * (grad * grad - v)
                w -= 0.003 * s * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-12)
    return router


def fit(sample: np.ndarray, parts: int, k: int = NEIGHBOURS, recall: float = RECALL, seed: int = 17) -> Router:
    """A router for ``parts`` parts from a sample (n, d) of vectors; equal vectors count once.

    A tenth of the sample only asks: the number of probes is the smallest that
    finds ``recall`` of its k nearest sample vectors.
    """
    rng = np.random.default_rng(seed)
    x = np.unique(sample, axis=0)
    parts = max(1, min(parts, len(x) // 32))
    if parts == 1:
        d = sample.shape[1]
        return Router(np.zeros(d), np.zeros((d, 1)), np.zeros(1), np.zeros((1, 1)), np.zeros(1))
    order = rng.permutation(len(x))
    asked, learnt = order[: len(x) // 10], order[len(x) // 10 :]
    own = x[learnt]
    graph = _nearest(own, np.arange(len(own)), min(_GRAPH, len(own) - 1))
    part = balanced_parts(own, graph, parts, rng)
    share = np.zeros((len(own), parts))
    np.add.at(share, (np.repeat(np.arange(len(own)), graph.shape[1]), part[graph].ravel()), 1.0)
    np.add.at(share, (np.arange(len(own)), part), 1.0)
    router = _learn(own, share / share.sum(1, keepdims=True), rng)
    found = router.scores(x)
    place = np.empty_like(found, dtype=np.int64)  # of each part in the order of a vector's scores
    np.put_along_axis(place, (-found).argsort(1, kind="stable"), np.arange(parts)[None].repeat(len(x), 0), 1)
    near = _nearest(x, asked, min(k, len(x) - 1))
    needed = np.sort(np.take_along_axis(place[asked], found.argmax(1)[near], 1).ravel())
    router.probes = int(needed[min(len(needed) - 1, int(np.ceil(recall * len(needed))))]) + 1
    return router


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False).reshape(-1, dim)


def usable(embeddings: DataFrame) -> DataFrame:
    """(row, vec_id, v): the vectors that take part, as doubles, each with a number of its own."""
    v = F.col("embedding").cast("array<double>")
    return (
        embeddings.select(F.col("vec_id").cast("long"), v.alias("v"))
        .where("vec_id is not null and v is not null")
        .where(F.forall("v", lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False))))
        .where(F.exists("v", lambda x: x != 0))
        .select(F.monotonically_increasing_id().alias("row"), "vec_id", "v")
    )


def _floors(
    rows: np.ndarray, x: np.ndarray, asked: list[list[int]], sample_rows: np.ndarray, sample: np.ndarray, parts: np.ndarray, k: int
) -> np.ndarray:
    """The k-th best score of each query among the sample vectors of the parts it asks, its own row left out."""
    if len(sample) <= k:
        return np.full(len(x), -np.inf)
    names, place = np.unique(parts, return_inverse=True)
    out = np.empty(len(x))
    for start in range(0, len(x), 512):
        some = asked[start : start + 512]
        near = x[start : start + 512] @ sample.T
        near[rows[start : start + 512, None] == sample_rows[None, :]] = -np.inf
        asks = np.stack([np.isin(names, mine) for mine in some])
        near[~asks[:, place]] = -np.inf
        out[start : start + 512] = -np.partition(-near, k - 1, axis=1)[:, k - 1]
    return out - 1e-12 * np.abs(sample).max() * np.abs(x).sum(1)


_FOUND = "query_row long, query_id long, row long, vec_id long, score double, scored long"


def _best(queries: pa.Table, members: pa.Table, k: int) -> pa.Table:
    """The k nearest members of each query in a cell, in the columns of ``_FOUND``."""
    picked: list[np.ndarray] = []
    mine: list[np.ndarray] = []
    scores: list[np.ndarray] = []
    if queries.num_rows and members.num_rows:
        dim = len(members["v"][0])
        x, y = _matrix(queries["v"].combine_chunks(), dim), _matrix(members["v"].combine_chunks(), dim)
        q_rows, m_rows, m_ids = queries["row"].to_numpy(), members["row"].to_numpy(), members["vec_id"].to_numpy()
        floor = queries["floor"].to_numpy()
        size = float(np.abs(y).max()) or 1.0
        for start in range(0, len(x), 512):
            block = x[start : start + 512]
            near = block @ y.T
            near[q_rows[start : start + 512, None] == m_rows[None, :]] = -np.inf
            kth = -np.partition(-near, min(k, len(y)) - 1, axis=1)[:, min(k, len(y)) - 1]
            for i, bar in enumerate(np.maximum(kth, floor[start : start + 512])):
                # a hair below: products are taken anew, the same way for equal vectors
                slack = 1e-12 * size * float(np.abs(block[i]).sum())
                some = np.flatnonzero((near[i] >= bar - slack) & (near[i] > -np.inf))
                exact = (y[some] * block[i]).sum(1)
                best = np.lexsort((m_rows[some], m_ids[some], -exact))[:k]
                picked.append(some[best])
                mine.append(np.full(len(best), start + i))
                scores.append(exact[best])
    q, m = (np.concatenate(parts) if parts else np.zeros(0, np.int64) for parts in (mine, picked))
    asked, found = queries.take(pa.array(q)), members.take(pa.array(m))
    score = pa.array(np.concatenate(scores) if scores else np.zeros(0))
    return pa.table({
        "query_row": asked["row"], "query_id": asked["vec_id"], "row": found["row"], "vec_id": found["vec_id"],
        "score": score, "scored": asked["scored"],
    })


def _small(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= SMALL_ROWS else df


def _cell(parts: Column | str, salt: int) -> Column:
    """One of ``parts`` cells for a row."""
    return F.pmod(F.xxhash64("row", F.lit(salt)), F.col(parts) if isinstance(parts, str) else parts).cast("int")


def _cells(column: str, cell_rows: int) -> Column:
    return F.ceil(F.col(column) / cell_rows).cast("int")


def _every(column: str) -> Column:
    return F.explode(F.sequence(F.lit(0), F.col(column) - 1))


def _counts(df: DataFrame, name: str, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


_PLACED = "up long, node long, row long, vec_id long, v array<double>"


def _cut(
    members: DataFrame, asked: DataFrame, wide: DataFrame, many: int, k: int, sample_rows: int, part_rows: int, recall: float, cell_rows: int
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Cut the ``many`` parts ``wide`` (node, n): (members, asked, new parts as (up, node, n)).

    ``members`` are (node, row, vec_id, v), each vector in one part; ``asked`` have the same
    columns, a query once for every part that it asks.
    """

    def fitted(key: tuple, rows: pa.Table) -> pa.Table:
        x = _matrix(rows["v"].combine_chunks(), len(rows["v"][0]))
        order = np.argsort(rows["row"].to_numpy())
        n = rows["n"][0].as_py()
        # of a vector's k nearest, the sample holds its share
        router = fit(x[order], min(MAX_PARTS, max(4, -(-n // part_rows))), max(1, math.ceil(k * len(x) / n)), recall)
        return pa.table({"node": [key[0]], "n": [rows["n"][0]], "parts": [router.parts], "router": pa.array([router.dump()], pa.binary())})

    # about sample_rows vectors of each part
    share = hash_order("row").cast("double") / 2.0**63 <= F.lit(float(sample_rows)) / F.col("n")
    sample = members.join(_small(wide, many), "node").where(share).select("node", "row", "v", "n")
    routers = materialise(
        sample.groupBy("node").applyInArrow(fitted, "node long, n long, parts long, router binary").where("parts > 1")
    )
    chunks = routers.select("node", _cells("n", cell_rows).alias("cells"))
    cell = ["node", "cell"]

    def place(rows: pa.Table, guide: pa.Table) -> pa.Table:
        router = Router.load(guide["router"][0].as_py())
        node = rows["node"][0].as_py()
        best = router.scores(_matrix(rows["v"].combine_chunks(), len(rows["v"][0]))).argmax(1)
        at = pa.array(node * _FAN + 1 + best.astype(np.int64))
        return pa.table({"up": rows["node"], "node": at, **{c: rows[c] for c in ("row", "vec_id", "v")}})

    dealt = members.join(_small(chunks, many), "node").withColumn("cell", _cell("cells", 1)).drop("cells")
    guides = routers.join(chunks, "node").withColumn("cell", _every("cells")).select(*cell, "router")
    moved = materialise(dealt.groupBy(*cell).cogroup(guides.groupBy(*cell)).applyInArrow(place, _PLACED))
    parts = materialise(_counts(moved, "n", "up", "node"))

    def route(rows: pa.Table, guide: pa.Table) -> pa.Table:
        router = Router.load(guide["router"][0].as_py())
        node = rows["node"][0].as_py()
        held = np.zeros(router.parts, np.int64)
        for part in guide["parts"][0].as_py():
            held[part["node"] - node * _FAN - 1] = part["n"]
        order = (-router.scores(_matrix(rows["v"].combine_chunks(), len(rows["v"][0])))).argsort(1, kind="stable")
        before = held[order].cumsum(1) - held[order]
        # as many parts as calibrated, and more while they hold fewer than k rows besides the query's own
        wanted = ((np.arange(router.parts) < router.probes) | (before < k + 1)) & (held[order] > 0)
        at, place = np.nonzero(wanted)
        asking = rows.take(pa.array(at))
        return pa.table({"up": asking["node"], "node": pa.array(node * _FAN + 1 + order[at, place]), **{c: asking[c] for c in ("row", "vec_id", "v")}})

    loads = asked.groupBy("node").agg(F.ceil(F.count(F.lit(1)) / cell_rows).cast("int").alias("cells")).join(routers.select("node"), "node")
    loads = materialise(loads)
    sizes = parts.groupBy(F.col("up").alias("node")).agg(F.collect_list(F.struct("node", "n")).alias("parts"))  # MAX_PARTS at most
    questions = asked.join(_small(loads, many), "node").withColumn("cell", _cell("cells", 2)).drop("cells")
    guides = routers.drop("parts").join(sizes, "node").join(loads, "node").withColumn("cell", _every("cells")).select(*cell, "router", "parts")
    sent = questions.groupBy(*cell).cogroup(guides.groupBy(*cell)).applyInArrow(route, _PLACED)

    whole = ["node", "row", "vec_id", "v"]
    left = lambda df: df.join(_small(routers.select("node"), many), "node", "left_anti").select(whole)
    return (
        left(members).unionAll(moved.select(whole)),
        materialise(left(asked).unionAll(sent.select(whole))),
        parts,
    )


def search(
    embeddings: DataFrame,
    is_query: Column,
    k: int = NEIGHBOURS,
    sample_rows: int = SAMPLE_ROWS,
    part_rows: int = PART_ROWS,
    recall: float = RECALL,
    cell_rows: int = CELL_ROWS,
) -> DataFrame:
    """The k nearest rows of each query by inner product: (query_id, rank, vec_id, score, scored).

    ``is_query`` is a condition on vec_id. Nearest first, ties to the smaller
    id; a query with fewer than k other rows gets all. ``scored`` is the number of
    vectors that the query was scored against. Vectors that are null, zero or hold
    null or non-finite components take no part, nor do null ids. A vector is near
    only to vectors of its own length. Rows that share an id are rows like any
    other: each is a candidate of the others, and each asks for itself, with its
    results under the id that they share. Other columns are ignored; an empty
    table gives no rows.
    """
    members = materialise(usable(embeddings).select((F.size("v").cast("long") * _FAN).alias("node"), "row", "vec_id", "v"))
    asked = members.where(is_query)
    nodes = materialise(_counts(members, "n", "node"))
    total = nodes.agg(F.sum("n")).first()[0] or 0
    depth = max(1, math.ceil(math.log(max(1, total / part_rows)) / math.log(MAX_PARTS) - 1e-9))
    open_ = nodes
    for level in range(_LEVELS):
        wide = materialise(open_.where(F.col("n") >= (128 if level == 0 else 2 * part_rows)))
        if not (many := wide.count()):
            break
        members, asked, parts = _cut(members, asked, wide, many, k, sample_rows, part_rows, recall ** (1 / depth), cell_rows)
        of = wide.select(F.col("node").alias("up"), F.col("n").alias("whole"))
        # what hardly shrinks isn't cut again: copies, or vectors that can't be told apart
        open_ = parts.join(of, "up").where("n < 0.9 * whole").select("node", "n")
        nodes = materialise(nodes.join(parts.select(F.col("up").alias("node")).distinct(), "node", "left_anti").unionAll(parts.select("node", "n")))

    # the sample's rows as they were placed, of the most frequent length: sample_rows vectors at most
    sample = smallest_hashes(members, sample_rows, max(1, total), "row").toArrow()
    sizes = pc.list_value_length(sample["v"]).to_numpy().astype(np.int64)
    dim = int(np.bincount(sizes).argmax()) if len(sizes) else 1
    sample = sample.filter(pa.array(sizes == dim))
    known = embeddings.sparkSession.sparkContext.broadcast(
        (sample["row"].to_numpy(), _matrix(sample["v"].combine_chunks(), dim), sample["node"].to_numpy())
    )

    def floored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            floor = np.full(batch.num_rows, -np.inf)
            some = np.flatnonzero(pc.list_value_length(batch["v"]).to_numpy() == dim)
            if len(some):
                mine = batch.take(pa.array(some))
                floor[some] = _floors(mine["row"].to_numpy(), _matrix(mine["v"], dim), mine["nodes"].to_pylist(), *known.value, k)
            yield pa.record_batch([*batch.columns, pa.array(floor)], [*batch.schema.names, "floor"])

    count = nodes.count()
    queries = (
        asked.join(_small(nodes, count), "node")
        .groupBy("row")
        .agg(F.any_value("vec_id").alias("vec_id"), F.any_value("v").alias("v"), F.collect_list("node").alias("nodes"), F.sum("n").alias("scored"))
    )
    bounded = queries.mapInArrow(floored, "row long, vec_id long, v array<double>, nodes array<long>, scored long, floor double")
    asked = materialise(bounded.select("row", "vec_id", "v", "scored", "floor", F.explode("nodes").alias("node")))
    loads = _counts(asked, "q", "node").join(nodes, "node")
    cells = materialise(loads.select("node", _cells("n", cell_rows).alias("chunks"), _cells("q", cell_rows).alias("blocks")))
    cell = ["node", "chunk", "block"]
    rows = members.join(_small(cells, count), "node").withColumn("chunk", _cell("chunks", 1)).withColumn("block", _every("blocks"))
    questions = asked.join(_small(cells, count), "node").withColumn("block", _cell("blocks", 2)).withColumn("chunk", _every("chunks"))
    near = (
        questions.drop("chunks", "blocks").groupBy(*cell)
        .cogroup(rows.drop("chunks", "blocks").groupBy(*cell))
        .applyInArrow(lambda q, m: _best(q, m, k), _FOUND)
    )
    ranked = Window.partitionBy("query_row").orderBy(F.col("score").desc(), "vec_id", "row")
    return (
        near.withColumn("rank", F.row_number().over(ranked))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score", "scored")
    )
