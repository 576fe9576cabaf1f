"""Exact and approximate nearest vectors, theme counts and estimates from similar records."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnweave.functions.codes import percentile_floor


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column) -> Column:
    """Raw cosine; a zero vector has cosine 0."""
    n = norm(a) * norm(b)
    return dot(a, b) / F.when(n == 0, 1.0).otherwise(n)


def unit(a: Column) -> Column:
    n = norm(a)
    return F.transform(a, lambda x: x.cast("double") / F.when(n == 0, 1.0).otherwise(n))


def truncated(a: Column, dim: int) -> Column:
    """The first dimensions, of length one again."""
    return unit(F.slice(a, 1, dim))


def _best(score: np.ndarray, ids: pa.Array, query: np.ndarray, k: int):
    """The k best rows of each query, of equal scores those of least id; rows of one query may stand anywhere."""
    place = np.empty(len(ids), np.int64)
    place[pc.sort_indices(ids, null_placement="at_start").to_numpy()] = np.arange(len(ids))
    order = np.lexsort((place, -score, query))
    first = np.searchsorted(query[order], query[order])
    order = order[np.arange(len(order)) - first < k]
    return score[order], ids.take(pa.array(order)), query[order]


#: Scores that a task holds at once.
CELLS = 1 << 21


def _slices(queries: int, rows: int) -> list[slice]:
    """The queries in runs whose scores against ``rows`` rows fit ``CELLS``."""
    step = max(1, CELLS // max(rows, 1))
    return [slice(i, min(i + step, queries)) for i in range(0, queries, step)]


def _kept(score: np.ndarray, k: int):
    """Places of scores, row and query, that are among the k best of a query or equal to the last of them."""
    least = np.partition(score, -k, axis=0)[-k] if len(score) > k else np.full(score.shape[1], -np.inf)
    return np.nonzero(score >= least)


def _joined(held: list) -> tuple:
    return np.concatenate([h[0] for h in held]), pa.concat_arrays([h[1] for h in held]), np.concatenate([h[2] for h in held])


def nearest(vectors: DataFrame, queries: DataFrame, k: int, key: str = "id", block: int = 4096, lists: Lists | None = None) -> DataFrame:
    """Exact k nearest of each query by cosine: ``(query, id, score, rank)``.

    ``queries`` is a stated query set; it is taken in blocks of about ``block`` rows, each block broadcast as a
    matrix of unit rows.  A task multiplies its batches with it and keeps k rows a query.  Scores that agree to 12 places are
    a tie, which the least id wins.  Rows without an embedding are no neighbours and have none; a zero vector has cosine 0.
    With ``lists`` a query meets only rows of the lists that it looks into.
    """
    spark = vectors.sparkSession
    q = queries.select(F.col(key).alias("query"), F.col("embedding").alias("q")).where("q IS NOT NULL")
    blocks = max(1, -(-q.count() // block))
    rows = vectors.select(F.col(key).alias("id"), F.col("embedding").cast("array<double>").alias("v")).where("v IS NOT NULL")
    kind = q.schema["query"].dataType.simpleString()
    fields = f"query {kind}, id {rows.schema['id'].dataType.simpleString()}, score double"
    out = None
    for b in range(blocks):
        part = (q if blocks == 1 else q.where(F.pmod(F.xxhash64("query"), F.lit(blocks)) == b)).toArrow()
        shared = spark.sparkContext.broadcast((part["query"].combine_chunks(), _units(part["q"].combine_chunks()), lists))

        def run(batches, shared=shared):
            names, matrix, lists = shared.value
            into = lists.looked_into(matrix) if lists and len(names) else None
            held = None
            for batch in batches:
                if not len(batch) or not len(names):
                    continue
                units = _units(batch["v"])
                parts = [(np.arange(len(units)), np.arange(len(names)))]
                if lists:
                    of = lists.of(units)
                    parts = [(np.flatnonzero(of == x), np.flatnonzero(into[:, x])) for x in np.unique(of)]
                for here, asked in parts:
                    if not len(asked):
                        continue
                    found = [held] if held else []
                    for some in _slices(len(asked), len(here)):
                        to = asked[some]
                        score = np.round(units[here] @ matrix[to].T, 12)
                        at, query = _kept(score, k)
                        found.append((score[at, query], batch["id"].take(pa.array(here[at])), to[query]))
                    held = _best(*_joined(found), k)
            if held:
                yield pa.RecordBatch.from_arrays([names.take(pa.array(held[2])), held[1], pa.array(held[0])], ["query", "id", "score"])

        found = rows.mapInArrow(run, fields)
        out = found if out is None else out.union(found)
    from tarnweave.operators.records import cap_per_key

    return cap_per_key(out, ["query"], [F.col("score").desc(), F.col("id")], k)


def _units(column: pa.Array) -> np.ndarray:
    """Rows of equal length as a matrix of rows of length one; zero rows stay zero."""
    m = np.asarray(column.flatten(), np.float64).reshape(len(column), -1) if len(column) else np.zeros((0, 1))
    n = np.sqrt((m * m).sum(1, keepdims=True))
    return m / np.where(n == 0, 1, n)


def theme(vectors: DataFrame, query: DataFrame, least: float) -> DataFrame:
    """All rows whose cosine with the one query vector reaches a threshold."""
    one = F.broadcast(query.select(F.col("embedding").alias("q")).limit(1))
    return vectors.join(one, F.lit(True)).withColumn("score", cosine(F.col("embedding"), F.col("q"))).drop("q").where(F.col("score") >= least)


class Lists:
    """Unit centres of inverted lists, and how many of them a query looks into."""

    def __init__(self, centres: np.ndarray, probes: int):
        self.centres, self.probes = centres, probes

    def of(self, units: np.ndarray) -> np.ndarray:
        """The list of each row: that of the centre of largest cosine."""
        return (units @ self.centres.T).argmax(1)

    def looked_into(self, units: np.ndarray) -> np.ndarray:
        """Which lists each query looks into."""
        order = np.argsort(-(units @ self.centres.T), axis=1, kind="stable")[:, : self.probes]
        out = np.zeros((len(units), len(self.centres)), bool)
        out[np.arange(len(units))[:, None], order] = True
        return out


def fit_lists(vectors: DataFrame, k: int = 10, target: float = 0.98, sample: int = 1 << 14, key: str = "id", rounds: int = 10) -> Lists | None:
    """Inverted lists fitted on a bounded sample: the ``sample`` rows of least hash of the key.

    The square root of the sample's size is the number of lists, by spherical k-means; a query looks into the least number of
    lists that holds a share ``target`` of the sample's own k nearest.  Every row of a table has a list; the
    sample only says where the centres are.  None where no row has an embedding.
    """
    rows = vectors.where("embedding IS NOT NULL").orderBy(F.xxhash64(key), key).limit(sample).select(F.col("embedding").cast("array<double>").alias("v")).toArrow()
    if not rows.num_rows:
        return None
    u = _units(rows["v"].combine_chunks())
    n = int(len(u) ** 0.5)
    centres = u[:n].copy()
    for _ in range(rounds):
        at = (u @ centres.T).argmax(1)
        sums = np.zeros_like(centres)
        np.add.at(sums, at, u)
        size = np.sqrt((sums * sums).sum(1, keepdims=True))
        centres = np.where(size > 0, sums / np.where(size > 0, size, 1), centres)
    own, found = Lists(centres, 1).of(u), []
    for one in range(0, len(u), max(len(u) // 512, 1)):
        score = u @ u[one]
        score[one] = -np.inf
        near = np.argsort(-score, kind="stable")[: min(k, len(u) - 1)]
        place = np.empty(n, np.int64)
        place[np.argsort(-(centres @ u[one]), kind="stable")] = np.arange(n)
        found.extend(place[own[near]])
    found.sort()
    return Lists(centres, int(found[int(np.ceil(target * len(found))) - 1]) + 1 if found else n)


def indexed(vectors: DataFrame, lists: Lists) -> DataFrame:
    """Rows with their ``list``, to be written in folders by list; a row without an embedding has none."""
    shared = vectors.sparkSession.sparkContext.broadcast(lists)

    @F.pandas_udf("int")
    def place(v):
        units = _units(pa.array(v, pa.list_(pa.float64())).fill_null([0.0] * shared.value.centres.shape[1]))
        return v.notna().map({True: 0}).astype("Int32") + shared.value.of(units)

    return vectors.withColumn("list", place(F.col("embedding").cast("array<double>")))


def approximate(vectors: DataFrame, queries: DataFrame, k: int, lists: Lists | None = None, where: Column | None = None) -> DataFrame:
    """Nearest within the lists that a query looks into, among the rows that a filter keeps: as ``nearest``.

    Batches meet the queries list by list, so a list of a third of all rows is no hot task.
    """
    kept = vectors if where is None else vectors.where(where)
    return nearest(kept, queries, k, lists=lists or fit_lists(vectors, k))


def search(vectors: DataFrame, queries: DataFrame, k: int, lists: Lists | None = None, where: Column | None = None) -> DataFrame:
    """By the lists where there are some, else exact."""
    if lists is not None:
        return approximate(vectors, queries, k, lists, where)
    return nearest(vectors if where is None else vectors.where(where), queries, k)


class Codes:
    """Vectors in parts, each replaced by the number of the nearest of at most 256 centres: a byte a part."""

    def __init__(self, centres: np.ndarray):
        self.centres = centres  # (parts, centres, length of a part)

    def encode(self, units: np.ndarray) -> np.ndarray:
        out = np.empty((len(units), len(self.centres)), np.uint8)
        size = self.centres.shape[2]
        for p, c in enumerate(self.centres):
            out[:, p] = ((c * c).sum(1)[None, :] - 2 * (units[:, p * size : (p + 1) * size] @ c.T)).argmin(1)
        return out

    def scores(self, tables: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """About the cosine of each query (``tables`` of it) with each coded row."""
        out = np.zeros((len(codes), len(tables)), np.float32)
        for p in range(codes.shape[1]):
            out += tables[:, p].T[codes[:, p]]
        return out

    def tables(self, units: np.ndarray) -> np.ndarray:
        size = self.centres.shape[2]
        return np.stack([units[:, p * size : (p + 1) * size] @ c.T for p, c in enumerate(self.centres)], axis=1).astype(np.float32)


def fit_codes(vectors: DataFrame, parts: int = 16, sample: int = 1 << 14, key: str = "id", rounds: int = 8) -> Codes | None:
    """Centres of each part by k-means on a bounded sample, the rows of least hash of the key; every row of a table is coded with them."""
    rows = vectors.where("embedding IS NOT NULL").orderBy(F.xxhash64(key), key).limit(sample).select(F.col("embedding").cast("array<double>").alias("v")).toArrow()
    if not rows.num_rows:
        return None
    u = _units(rows["v"].combine_chunks())
    parts = max(p for p in range(1, parts + 1) if u.shape[1] % p == 0)
    size, out = u.shape[1] // parts, []
    for p in range(parts):
        x = u[:, p * size : (p + 1) * size]
        c = x[np.linspace(0, len(x) - 1, min(256, len(x))).astype(int)].copy()
        for _ in range(rounds):
            at = ((c * c).sum(1)[None, :] - 2 * (x @ c.T)).argmin(1)
            n = np.bincount(at, minlength=len(c))
            sums = np.zeros_like(c)
            np.add.at(sums, at, x)
            c[n > 0] = sums[n > 0] / n[n > 0, None]
        out.append(c)
    return Codes(np.stack(out))


def coded(vectors: DataFrame, codes: Codes) -> DataFrame:
    """Rows with ``code`` (null without an embedding) instead of the embedding: the index, a sixteenth of the vectors' size for 64 floats."""
    shared = vectors.sparkSession.sparkContext.broadcast(codes)
    width = codes.centres.shape[0] * codes.centres.shape[2]

    @F.pandas_udf("binary")
    def code(v):
        units = _units(pa.array(v, pa.list_(pa.float64())).fill_null([0.0] * width))
        found = [x.tobytes() for x in shared.value.encode(units)]
        return v.notna().map({True: 1, False: None}).combine(v.__class__(found), lambda known, x: x if known == 1 else None)

    return vectors.withColumn("code", code(F.col("embedding").cast("array<double>"))).drop("embedding")


def search_coded(index: DataFrame, vectors: DataFrame, queries: DataFrame, k: int, codes: Codes, candidates: int = 100, where: Column | None = None, key: str = "id", block: int = 1024) -> DataFrame:
    """The ``k`` nearest among the ``candidates`` rows of best coded score of each query: ``(query, id, score, rank)`` as ``nearest``.

    A filter applies to the index before the search.  Tasks read the codes only; the vectors of the candidates come by a join on the
    id, so just those pairs are compared in full.
    """
    from tarnweave.operators.records import cap_per_key

    spark = vectors.sparkSession
    q = queries.select(F.col(key).alias("query"), F.col("embedding").cast("array<double>").alias("q")).where("q IS NOT NULL")
    rows = (index if where is None else index.where(where)).where("code IS NOT NULL").select(F.col(key).alias("id"), "code")
    kind, blocks, best = q.schema["query"].dataType.simpleString(), max(1, -(-q.count() // block)), None
    for b in range(blocks):
        part = (q if blocks == 1 else q.where(F.pmod(F.xxhash64("query"), F.lit(blocks)) == b)).toArrow()
        if not part.num_rows:
            continue
        shared = spark.sparkContext.broadcast((codes, part["query"].combine_chunks(), codes.tables(_units(part["q"].combine_chunks()))))

        def run(batches, shared=shared):
            codes, names, tables = shared.value
            held = None
            for batch in batches:
                if len(batch):
                    own = np.frombuffer(b"".join(batch["code"].to_pylist()), np.uint8).reshape(len(batch), -1)
                    found = [held] if held else []
                    for some in _slices(len(names), len(batch)):
                        score = codes.scores(tables[some], own)
                        at, query = _kept(score, candidates)
                        found.append((score[at, query], batch["id"].take(pa.array(at)), query + some.start))
                    held = _best(*_joined(found), candidates)
            if held:
                yield pa.RecordBatch.from_arrays([names.take(pa.array(held[2])), held[1], pa.array(held[0].astype(np.float64))], ["query", "id", "about"])

        found = rows.mapInArrow(run, f"query {kind}, id {rows.schema['id'].dataType.simpleString()}, about double")
        best = found if best is None else best.union(found)
    if best is None:
        return nearest(vectors.limit(0), queries, k, key)
    few = cap_per_key(best, ["query"], [F.col("about").desc(), F.col("id")], candidates).select("query", "id")
    full = few.join(vectors.select(F.col(key).alias("id"), F.col("embedding").alias("v")), "id").join(q, "query")
    scored = full.select("query", "id", F.round(cosine(F.col("v"), F.col("q")), 12).alias("score"))
    return cap_per_key(scored, ["query"], [F.col("score").desc(), F.col("id")], k)


def compared_share(vectors: DataFrame, queries: DataFrame, lists: Lists) -> DataFrame:
    """``(share)``: pairs of query and row that the lists compare, of all pairs."""
    shared = vectors.sparkSession.sparkContext.broadcast(lists)

    @F.pandas_udf("array<int>")
    def into(v):
        import pandas as pd

        found = shared.value.looked_into(_units(pa.array(v, pa.list_(pa.float64()))))
        return pd.Series([np.flatnonzero(x).tolist() for x in found])

    sizes = indexed(vectors.where("embedding IS NOT NULL"), lists).groupBy("list").agg(F.count("*").alias("rows"))
    asked = queries.where("embedding IS NOT NULL").select(F.explode(into(F.col("embedding").cast("array<double>"))).alias("list")).groupBy("list").agg(F.count("*").alias("asked"))
    both = sizes.join(asked, "list", "left")  # one row a list
    total = both.agg(F.sum("rows").alias("n"), F.sum(F.coalesce("asked", F.lit(0)) * F.col("rows")).alias("pairs"))
    return total.select((F.col("pairs") / F.col("n") / F.lit(max(queries.count(), 1))).alias("share"))


def recall(found: DataFrame, exact: DataFrame) -> DataFrame:
    """Mean share of each query's exact neighbours that were found."""
    a = exact.groupBy("query").agg(F.collect_set("id").alias("want"))
    b = found.groupBy("query").agg(F.collect_set("id").alias("got"))
    each = a.join(b, "query", "left").select(F.size(F.array_intersect("want", F.coalesce("got", F.array().cast("array<bigint>")))) / F.size("want"))
    return each.toDF("r").agg(F.round(F.avg("r"), 6).alias("recall"))


def estimate(neighbours: DataFrame, base: float, least: int = 5) -> DataFrame:
    """Price interval from discounts of similar records ``(base, award)``; null with fewer than ``least``."""
    d = neighbours.where("base > 0 AND award > 0").select(((F.col("base") - F.col("award")) / F.col("base")).alias("d")).where("d >= 0 AND d < 1")
    x = d.agg(
        F.count("*").alias("n"),
        F.avg(F.when(F.col("d") < 0.005, 1.0).otherwise(0.0)).alias("zero"),
        *[percentile_floor("d", p).alias(k) for k, p in (("p25", 0.25), ("median", 0.5), ("p75", 0.75))],
    ).where(F.col("n") >= least)
    price = lambda p: F.floor(F.lit(base) * (1 - F.col(p)) + 0.5).cast("double")
    return x.select("n", F.round("zero", 6).alias("zero_share"), *[F.round(k, 6).alias(k) for k in ("p25", "median", "p75")], price("median").alias("expected"), price("p75").alias("lowest"), price("p25").alias("highest"))
