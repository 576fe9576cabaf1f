"""A gold set of name pairs in four bands, drawn by keys: the same seed gives the same pairs on any cluster."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarnweave.operators.network import numbered
from tarnweave.plans.durable import cut

#: Pairs of each band, pairs of a prefix, shortest name, and the edits of near and middle pairs.
QUOTAS = {"EXACT": 12, "NEAR": 14, "MID": 14, "FAR": 8}
PER_BLOCK, LEAST, NEAR, NEAR_SHARE, MIDDLE = 2, 8, 2, 0.2, (3, 6)
#: Sketches of a name, and rows of a sketch that are compared.
SKETCHES, FEW = 4, 16


def _draw(seed: int, *what: Column | str) -> Column:
    return F.md5(F.concat_ws(":", F.lit(seed), *what))


def _first(df: DataFrame, by: list[str], order: list[Column], k: int) -> DataFrame:
    """The k rows of least draw of each stratum; tasks keep k rows of a stratum each before any shuffle."""
    return df.withColumn("_k", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("_k") <= k).drop("_k")


def gold_pairs(subjects: DataFrame, seed: int = 42, quotas: dict[str, int] | None = None) -> DataFrame:
    """``(band, left, right, dist, rel)`` of ``(id, code, name)``, names of at least ``LEAST`` characters.

    * EXACT: the first two codes of a name, one pair a name.
    * NEAR, MID: names of one beginning that share a sketch (the least of their 3-grams under one of ``SKETCHES`` hashes); of a
      sketch the ``FEW`` rows of least draw are compared, so a beginning or a sketch of any size is a bounded sample.  At most ``PER_BLOCK``
      pairs of a beginning in each band.
    * FAR: each row with the one at a place that its own gives, of another beginning.

    Of each band the pairs of least draw fill the quota.  Codes of a pair differ; ``rel`` is edits by the shorter name.
    """
    quotas = QUOTAS | (quotas or {})
    e = cut(subjects.where((F.length("name") >= LEAST) & F.col("id").isNotNull() & F.col("code").isNotNull()).select("id", "code", "name", F.substring("name", 1, 3).alias("p")))
    one = e.groupBy("name", "code").agg(F.min("id").alias("id"))
    two = _first(one, ["name"], [F.col("code")], 2).groupBy("name").agg(F.min_by("id", "code").alias("left"), F.max_by("id", "code").alias("right"), F.count("*").alias("n")).where("n = 2")
    exact = two.orderBy(_draw(seed, "name"), "name").limit(quotas["EXACT"]).select(F.lit("EXACT").alias("band"), "left", "right", F.lit(0).alias("dist"), F.lit(0.0).alias("rel"))

    grams = F.transform(F.sequence(F.lit(1), F.length("name") - 2), lambda i: F.substring("name", i, F.lit(3)))
    hashed = lambda j: F.array_min(F.transform(grams, lambda g: F.md5(F.concat(F.lit(f"{j}:"), g))))
    sketch = F.explode(F.array(*[F.struct(F.lit(j).alias("j"), hashed(j).alias("m")) for j in range(SKETCHES)]))
    few = cut(_first(e.select("*", sketch.alias("s")).select("id", "code", "name", "p", "s.j", "s.m"), ["p", "j", "m"], [_draw(seed, "id"), F.col("id")], FEW))
    a, b = few.alias("a"), few.alias("b")
    met = a.join(b, F.expr("a.p = b.p AND a.j = b.j AND a.m = b.m AND a.id < b.id AND a.code <> b.code AND a.name <> b.name"))
    dist = F.levenshtein("a.name", "b.name")
    rel = dist / F.least(F.length("a.name"), F.length("b.name"))
    band = F.when((dist <= NEAR) & (rel <= NEAR_SHARE), "NEAR").when(dist.between(*MIDDLE), "MID")
    pairs = met.select(band.alias("band"), F.col("a.p").alias("p"), F.col("a.id").alias("left"), F.col("b.id").alias("right"), dist.alias("dist"), rel.alias("rel")).where("band IS NOT NULL").distinct()
    order = [_draw(seed, "left", "right"), F.col("left"), F.col("right")]
    spread = _first(pairs, ["band", "p"], order, PER_BLOCK)
    middle = [_first(spread.where(F.col("band") == x), ["band"], order, quotas[x]).select("band", "left", "right", "dist", "rel") for x in ("NEAR", "MID")]

    placed = cut(numbered(e.withColumn("draw", _draw(seed, "id")), ["draw", "id"], "place"))
    n = placed.count()
    there = placed.select(F.col("place").alias("at"), F.col("id").alias("right"), F.col("code").alias("c2"), F.col("name").alias("n2"), F.col("p").alias("p2"))
    far = placed.withColumn("at", (F.col("place") * 7919 + 12345) % F.lit(max(n, 1)) + 1).join(there, "at").where("p <> p2 AND code <> c2")
    dist = F.levenshtein("name", "n2")
    last = far.orderBy("place").limit(quotas["FAR"]).select(F.lit("FAR").alias("band"), F.col("id").alias("left"), "right", dist.alias("dist"), (dist / F.least(F.length("name"), F.length("n2"))).alias("rel"))
    return exact.union(middle[0]).union(middle[1]).union(last)
