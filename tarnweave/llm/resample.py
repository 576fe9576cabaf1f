"""Quality by importance resampling: hashed n-gram models and Gumbel top-k.

Words and word pairs are hashed to ``BUCKETS`` counts, once for a target (texts labelled good) and once
for all texts; every text is counted.  A text's log weight is the log of the ratio of the two generative models, the sum over
its n-grams, so that a long text is told with more certainty than a short one.  Adding Gumbel noise drawn from
the document's id and text and keeping the k largest keys samples k texts without replacement in
proportion to their weights.  The k-th key is found by histograms that are refined, never by a
sort of all rows.

Null and empty texts have weight ratio 1, that is log weight 0; rows that tie with the k-th key
are all kept, so repeated rows stay together.  Rows without a doc_id have draws of their own but are never in the target.
Without a target all log weights are 0.  An empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnweave.plans.durable import cut

from .tokens import mix, slabs, words

BUCKETS = 1 << 15
_R = np.uint64(0xA0761D6478BD642F)


def features(h: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the words and word pairs of a slab, and the row of each."""
    rows = np.repeat(np.arange(len(first) - 1), np.diff(first))
    if not len(h):
        return np.zeros(0, np.int64), rows
    pair = np.flatnonzero(rows[1:] == rows[:-1])
    two = mix(h[pair] * _R + h[pair + 1])
    f = np.concatenate([h, two]) >> np.uint64(64 - 15)
    return f.astype(np.int64), np.concatenate([rows, rows[pair]])


def fit(docs: DataFrame, target_ids: np.ndarray) -> np.ndarray:
    """Log ratio of each bucket: target model over the model of all texts, both with one added."""
    ids = docs.sparkSession.sparkContext.broadcast(np.sort(target_ids))

    def count(batches):
        n = np.zeros((2, BUCKETS), np.int64)
        for rows, b, o in slabs(batches):
            _, _, h, first = words(b, o, fold=False)
            f, row = features(h, first)
            n[0] += np.bincount(f, minlength=BUCKETS)
            doc = rows.column("doc_id")
            good = np.isin(doc.fill_null(0).to_numpy(zero_copy_only=False), ids.value) & doc.is_valid().to_numpy(zero_copy_only=False)
            if good.any():
                n[1] += np.bincount(f[good[row]], minlength=BUCKETS)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(BUCKETS)), pa.array(n[0]), pa.array(n[1])], ["b", "n", "t"])

    sums = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(count, "b long, n long, t long").groupBy("b").agg(F.sum("n"), F.sum("t"))
    n = np.zeros((2, BUCKETS))
    for b, x, t in sums.collect():  # BUCKETS rows
        n[:, b] = x, t
    if not n[1].sum():
        return np.zeros(BUCKETS)
    n += 1
    return np.log(n[1] / n[1].sum()) - np.log(n[0] / n[0].sum())


def weigh(docs: DataFrame, ratio: np.ndarray, seed: int = 7) -> DataFrame:
    """``(doc_id, draw, log_weight, n_features)`` of every row; ``draw`` is a hash of id and text."""
    shared = docs.sparkSession.sparkContext.broadcast(ratio)

    def run(batches):
        for rows, b, o in slabs(batches):
            _, _, h, first = words(b, o, fold=False)
            f, row = features(h, first)
            n = np.bincount(row, minlength=len(rows))
            total = np.bincount(row, shared.value[f], len(rows))
            yield pa.RecordBatch.from_arrays([*(rows.column(c) for c in ("doc_id", "draw")), pa.array(total), pa.array(n, pa.int64())], ["doc_id", "draw", "log_weight", "n_features"])

    draws = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.lit(seed), "doc_id", "text").alias("draw"), "text")
    return draws.mapInArrow(run, "doc_id long, draw long, log_weight double, n_features long")


def top_k(keyed: DataFrame, k: int, column: str = "key", few: int = 10_000) -> float:
    """The k-th largest value of a column (-inf if there are fewer), by refined histograms."""
    lo, hi, n = keyed.select(F.min(column), F.max(column), F.count(column)).first()
    if k >= n or not n:
        return float("-inf")
    if k <= 0:
        return float("inf")
    above = 0
    while True:
        inside = keyed.where(F.col(column).between(lo, hi))
        if hi <= lo or n <= few:
            values = sorted((r[0] for r in inside.select(column).collect()), reverse=True) if hi > lo else None
            return values[k - above - 1] if values else hi
        width = (hi - lo) / 4096
        bins = inside.groupBy(F.least(F.floor((F.col(column) - lo) / width), F.lit(4095)).alias("b")).agg(
            F.count(column), F.min(column), F.max(column)
        )
        for _, c, a, z in sorted(bins.collect(), reverse=True):  # at most 4096 rows
            if above + c >= k:
                lo, hi, n = a, z, c
                break
            above += c


def resample(docs: DataFrame, labels: DataFrame, seed: int = 7, most_targets: int = 20_000) -> DataFrame:
    """``(doc_id, log_weight, gumbel_key, kept)``.

    The target are at most ``most_targets`` labelled good and not toxic rows, the first by hash of the id;
    k is the labelled share of good rows times the number of documents.
    """
    good = F.coalesce((F.col("quality") == 1), F.lit(False))
    share = labels.where("quality IS NOT NULL").select(F.avg(good.cast("double"))).first()[0]
    target = labels.where(good & (F.coalesce("toxic", F.lit(0)) == 0) & F.col("doc_id").isNotNull())
    ids = [r[0] for r in target.select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(most_targets).collect()]
    u = (F.shiftrightunsigned("draw", 11) + 0.5) / F.lit(float(1 << 53))
    scored = weigh(docs, fit(docs, np.array(ids, np.int64)), seed)
    keyed = cut(scored.withColumn("gumbel_key", F.col("log_weight") - F.log(-F.log(u))).drop("draw"))
    k = round((1.0 if share is None else share) * keyed.count())
    return keyed.withColumn("kept", F.col("gumbel_key") >= top_k(keyed, k, "gumbel_key"))


def op9_quality_classifier(spark, sf_dir: str) -> DataFrame:
    return resample(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
