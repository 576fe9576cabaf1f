"""Approximate nearest neighbours by learned partitions.

The graph of nearest neighbours of a sample is cut into parts of about equal size with few edges between them, and a small
network (one hidden layer) learns in which parts the neighbours of a vector lie.  Every row of the table goes to the part
that the network finds most probable; a query goes to its ``probes`` most probable ones and is compared there by exact Euclidean distance.
``probes`` is the least number of parts that holds the share ``target`` of the true neighbours of sample rows that neither the
graph nor the network has seen.

The sample (at most ``sample`` rows of least hash of the id) fixes the parts and nothing else: all rows are in the index.  A part is
dealt out as cells of at most about ``SLICE`` rows by ``BLOCK`` queries, so a part or a vector of a third of all rows is many
cells, and a task holds one cell.  Each cell sends k rows a query.

Vectors that are null, empty, zero, or hold a null or a component that isn't finite take no part, nor do rows without an id and those of another
length than most rows (of equally frequent lengths the smaller counts).  Ties go to the smaller id.  Copies of a vector are neighbours of each other.  Of several rows of
one id that are queries, the least vector asks; a query never finds rows of its own id.  An empty table, or one row, has no neighbours.
Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Rows and queries of a cell, and rows that are compared at once.
SLICE, BLOCK, STEP = 1 << 15, 1 << 12, 1 << 10
HIDDEN, EPOCHS = 128, 30
#: Sample rows of a part, and the most parts there are.
PART, MOST_PARTS = 128, 64


def usable(vectors: DataFrame, key: str = "vec_id", column: str = "embedding") -> DataFrame:
    """``(id, v)`` of the rows that take part."""
    v = F.col(column)
    whole = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = vectors.where(F.col(key).isNotNull() & v.isNotNull()).where(whole & F.exists(v, lambda x: x != 0))
    rows = rows.select(F.col(key).alias("id"), v.alias("v"))
    size = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.col("count").desc(), "n").first()
    return rows.where(F.size("v") == (size["n"] if size else 0))


def _matrix(column) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return np.asarray(column.flatten(), np.float64).reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def _graph(x: np.ndarray, k: int) -> np.ndarray:
    """The k nearest other rows of each row."""
    square = (x * x).sum(1)
    out = np.empty((len(x), k), np.int64)
    for i in range(0, len(x), STEP):
        d = square[None, :] - 2 * (x[i : i + STEP] @ x.T)
        d[np.arange(len(d)), np.arange(i, i + len(d))] = np.inf
        out[i : i + STEP] = np.argpartition(d, k - 1, axis=1)[:, :k]
    return out


def _centres(x: np.ndarray, parts: int, rounds: int = 10) -> np.ndarray:
    c = x[np.linspace(0, len(x) - 1, parts).astype(int)].copy()
    for _ in range(rounds):
        at = ((c * c).sum(1) - 2 * (x @ c.T)).argmin(1)
        n = np.bincount(at, minlength=parts)
        sums = np.zeros_like(c)
        np.add.at(sums, at, x)
        c[n > 0] = sums[n > 0] / n[n > 0, None]
    return c


def balanced_parts(x: np.ndarray, near: np.ndarray, parts: int, slack: float = 0.1, rounds: int = 15) -> np.ndarray:
    """A part for each node: near centres at first, then moved to where most of its neighbours are, no part larger than the mean by more than ``slack``."""
    n = len(x)
    room = max(-(-n // parts), int(n / parts * (1 + slack)))
    d = (x * x).sum(1)[:, None] - 2 * (x @ (c := _centres(x, parts)).T) + (c * c).sum(1)
    part, size = np.full(n, -1), np.zeros(parts, np.int64)
    for i in np.argsort(d.min(1), kind="stable"):
        for p in np.argsort(d[i], kind="stable"):
            if size[p] < room:
                part[i] = p
                size[p] += 1
                break
    a = np.concatenate([np.repeat(np.arange(n), near.shape[1]), near.ravel()])
    b = np.concatenate([near.ravel(), np.repeat(np.arange(n), near.shape[1])])
    for _ in range(rounds):
        links = np.zeros((n, parts), np.int32)
        np.add.at(links, (a, part[b]), 1)
        to = links.argmax(1)
        gain = links[np.arange(n), to] - links[np.arange(n), part]
        moved = 0
        for i in np.argsort(-gain, kind="stable"):
            if gain[i] <= 0:
                break
            if size[to[i]] < room:
                size[part[i]] -= 1
                size[to[i]] += 1
                part[i] = to[i]
                moved += 1
        if not moved:
            break
    return part


class Router:
    """The network that says how probable each part is for a vector."""

    def __init__(self, scale: float, parts: int, dim: int):
        r = np.random.default_rng(7)
        self.scale, self.parts, self.probes = scale, parts, parts
        self.w = [r.normal(0, (2 / dim) ** 0.5, (dim, HIDDEN)), np.zeros(HIDDEN), r.normal(0, (1 / HIDDEN) ** 0.5, (HIDDEN, parts)), np.zeros(parts)]

    def _forward(self, x: np.ndarray):
        h = np.maximum((x / self.scale) @ self.w[0] + self.w[1], 0)
        z = h @ self.w[2] + self.w[3]
        p = np.exp(z - z.max(1, keepdims=True))
        return h, p / p.sum(1, keepdims=True)

    def probable(self, x: np.ndarray) -> np.ndarray:
        return self._forward(x)[1]

    def train(self, x: np.ndarray, want: np.ndarray) -> None:
        """Adam on the cross entropy with the shares of each row's neighbours in the parts."""
        r = np.random.default_rng(8)
        m, v, t = [np.zeros_like(w) for w in self.w], [np.zeros_like(w) for w in self.w], 0
        for epoch in range(EPOCHS):
            order = r.permutation(len(x))
            for i in range(0, len(x), 256):
                rows = order[i : i + 256]
                h, p = self._forward(x[rows])
                dz = (p - want[rows]) / len(rows)
                dh = (dz @ self.w[2].T) * (h > 0)
                grads = [(x[rows] / self.scale).T @ dh, dh.sum(0), h.T @ dz, dz.sum(0)]
                t += 1
                for w, g, a, b in zip(self.w, grads, m, v, strict=True):
                    a += 0.1 * (g - a)
                    b += 0.001 * (g * g - b)
                    w -= 0.01 * (1 - epoch / EPOCHS) * (a / (1 - 0.9**t)) / (np.sqrt(b / (1 - 0.999**t)) + 1e-8)

    def of(self, x: np.ndarray) -> np.ndarray:
        """The part of each row."""
        return self.probable(x).argmax(1)

    def routes(self, x: np.ndarray, rows: np.ndarray, least: int) -> list[np.ndarray]:
        """Parts that each query looks into: ``probes``, and more until they hold ``least`` rows; ``rows`` says how many a part has."""
        order = np.argsort(-self.probable(x), axis=1, kind="stable")
        held = np.cumsum(rows[order], axis=1)
        n = np.maximum(self.probes, (held < least).sum(1) + 1)
        return [o[:k] for o, k in zip(order, n.tolist(), strict=True)]


def fit(rows: DataFrame, k: int = 10, sample: int = 1 << 13, target: float = 0.97) -> Router | None:
    """The router, learnt in the driver on a sample of at most ``sample`` rows; none for an empty table."""
    x = _matrix(rows.orderBy(F.xxhash64("id"), "id", "v").limit(sample).select("v").toArrow()["v"])
    if not len(x):
        return None
    aside = np.arange(len(x)) % 8 == 7
    known = x[~aside]
    parts = int(np.clip(len(known) // PART, 1, MOST_PARTS))
    router = Router(float(np.sqrt((x * x).mean())), parts, x.shape[1])
    if parts == 1:
        return router
    near = _graph(known, min(k, len(known) - 1))
    part = balanced_parts(known, near, parts)
    want = np.zeros((len(known), parts))
    np.add.at(want, (np.repeat(np.arange(len(known)), near.shape[1]), part[near].ravel()), 1.0 / near.shape[1])
    router.train(known, want)
    asked, own = x[aside], router.of(x)
    square = (x * x).sum(1)
    d = square[None, :] - 2 * (asked @ x.T)
    d[np.arange(len(asked)), np.flatnonzero(aside)] = np.inf
    true = np.argpartition(d, k - 1, axis=1)[:, :k]
    place = np.argsort(np.argsort(-router.probable(asked), axis=1, kind="stable"), axis=1)
    found = np.sort(np.take_along_axis(place, own[true], axis=1).ravel())
    router.probes = int(found[int(np.ceil(target * len(found))) - 1]) + 1
    return router


def _first(query, score, ids, k: int):
    """The k rows of least score and id of each query."""
    order = np.lexsort((ids, score, query))
    at = np.searchsorted(query[order], query[order])
    order = order[np.arange(len(order)) - at < k]
    return query[order], score[order], ids[order]


def nearest_in_cell(ids: np.ndarray, x: np.ndarray, asked: np.ndarray, q: np.ndarray, k: int):
    """Place of the query, distance and id of the k nearest rows of each query; rows of the query's own id are left out.

    Products give the candidates, with a margin for their rounding; distances are then taken from the differences.
    """
    by_id = np.argsort(asked, kind="stable")
    qq, held = (q * q).sum(1), None
    for i in range(0, len(x), STEP):
        part, own = x[i : i + STEP], ids[i : i + STEP]
        xx = (part * part).sum(1)
        d = xx[:, None] + qq[None, :] - 2 * (part @ q.T)
        at = np.minimum(np.searchsorted(asked[by_id], own), len(asked) - 1)
        same = np.flatnonzero(asked[by_id[at]] == own)
        d[same, by_id[at[same]]] = np.inf
        least = np.partition(d, k - 1, axis=0)[k - 1] if len(part) > k else np.full(len(q), np.finfo(float).max)
        row, query = np.nonzero(d <= np.minimum(least + 1e-9 * (xx.max() + qq), np.finfo(float).max))
        score = np.empty(len(row))
        for j in range(0, len(row), 1 << 17):
            e = part[row[j : j + (1 << 17)]] - q[query[j : j + (1 << 17)]]
            score[j : j + (1 << 17)] = np.sqrt((e * e).sum(1))
        found = query, score, own[row]
        held = _first(*(found if held is None else tuple(np.concatenate(p) for p in zip(held, found, strict=True))), k)
    return held


def search(vectors: DataFrame, queries: DataFrame, k: int = 10, router: Router | None = None) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the k nearest found of each query, both tables as ``usable`` gives them."""
    spark = vectors.sparkSession
    kind = vectors.schema["id"].dataType.simpleString()
    out = f"query_id {kind}, vec_id {kind}, score double"
    router = router or fit(vectors, k)
    if router is None:
        return spark.createDataFrame([], f"query_id {kind}, rank int, vec_id {kind}, score double")
    shared = spark.sparkContext.broadcast(router)

    def place(batches):
        for batch in batches:
            if len(batch):
                part = shared.value.of(_matrix(batch.column("v")))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(part, pa.int32())], [*batch.schema.names, "part"])

    item = vectors.schema["v"].dataType.simpleString()
    placed = vectors.mapInArrow(place, f"id {kind}, v {item}, part int")
    sizes = np.zeros(router.parts, np.int64)
    for r in placed.groupBy("part").count().collect():  # one row a part
        sizes[r["part"]] = r["count"]
    known = spark.sparkContext.broadcast(sizes)

    def route(batches):
        for batch in batches:
            if len(batch):
                parts = shared.value.routes(_matrix(batch.column("v")), known.value, k + 1)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([p.tolist() for p in parts], pa.list_(pa.int32()))], [*batch.schema.names, "parts"])

    asked = queries.groupBy("id").agg(F.min("v").alias("v")).mapInArrow(route, f"id {kind}, v {item}, parts array<int>")
    asked = asked.select("id", "v", F.explode("parts").alias("part"))
    waiting = np.zeros(router.parts, np.int64)
    for r in asked.groupBy("part").count().collect():
        waiting[r["part"]] = r["count"]
    slices, blocks = (np.maximum(-(-n // size), 1).tolist() for n, size in ((sizes, SLICE), (waiting, BLOCK)))
    of = lambda n: F.element_at(F.array(*[F.lit(int(x)) for x in n]), F.col("part") + 1)
    deal = lambda n, seed: F.pmod(F.xxhash64("id", F.lit(seed)), of(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), of(n) - 1))
    cells = ["part", "slice", "block"]
    here = placed.select("id", "v", "part", deal(slices, 1).alias("slice"), each(blocks).alias("block"))
    there = asked.select("id", "v", "part", each(slices).alias("slice"), deal(blocks, 2).alias("block"))

    def cell(left: pa.Table, right: pa.Table) -> pa.Table:
        if not len(left) or not len(right):
            columns = [left.column("id").slice(0, 0)] * 2 + [pa.array([], pa.float64())]
            return pa.Table.from_arrays(columns, ["query_id", "vec_id", "score"])
        names = right.column("id").combine_chunks()
        query, score, ids = nearest_in_cell(left.column("id").to_numpy(), _matrix(left.column("v")), names.to_numpy(), _matrix(right.column("v")), k)
        kept = np.isfinite(score)
        return pa.Table.from_arrays([names.take(pa.array(query[kept])), pa.array(ids[kept], left.schema.field("id").type), pa.array(score[kept])], ["query_id", "vec_id", "score"])

    found = here.groupBy(*cells).cogroup(there.groupBy(*cells)).applyInArrow(cell, out)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op13_nearest_neighbours(spark, sf_dir: str) -> DataFrame:
    rows = usable(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return search(rows, rows.where(F.col("id") % 100 == 0))
