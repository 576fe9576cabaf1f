"""Benchmark decontamination by spaced seeds.

Each mask reads six of eight or nine consecutive words and ignores the rest; together the masks hit
every stretch of ``STRETCH`` aligned words with up to two substitutions.  Benchmark items are
indexed by their seed hashes, documents look theirs up, and around each hit the aligned words
are compared.  Words count that stand in a stretch of ``STRETCH`` with at most ``MOST_OTHER`` others, so no such stretch is lost, or in a
segment that has at least ``LEAST`` equal words and the score ``SCORE`` with +1 for an equal and -3 for another word (the best
such segment, then the best ones left and right of it, and so on); an overlap is a run of them.  Items shorter than ``STRETCH`` words must
occur whole and unchanged.

The index goes to the executors in blocks of about ``block_words`` benchmark words, each block one
more pass over the same rows without a shuffle.  Where there are several, the rows are written after each pass and its block is
released before the next is sent, so one block is held at a time.  Very long texts are read whole, one at a time.

Words are runs of anything but ASCII white space, A-Z lower-cased.  Null and empty texts match
nothing, as do items without a word; repeated rows and items are all reported; an empty benchmark leaves all
documents clean, an empty table has no rows.  Other columns are kept, one named ``_overlaps`` is replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnweave.plans.durable import cut

from .tokens import column_bytes, mix, slabs, words

MASKS = ((0, 1, 2, 4, 6, 7), (0, 1, 4, 5, 6, 7), (0, 1, 3, 6, 7, 8))
STRETCH, MOST_OTHER, LEAST, SCORE = 13, 2, 10, 5
_FILTER_BITS = 22
_Q = np.uint64(0xD6E8FEB86659FD93)
HIT = "array<struct<item_id: bigint, start: int, end: int, matched: int>>"


def _seed(h: np.ndarray, offsets) -> np.ndarray:
    n = len(h) - offsets[-1]
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.full(n, len(offsets) * 256 + offsets[-1] + sum(offsets), np.uint64)
    for i in offsets:
        out = out * _Q + h[i : i + n]
    return mix(out)


def _segments(same: np.ndarray, length: int) -> list[tuple[int, int]]:
    """Disjoint segments that count: the runs of words within scored segments or within ``STRETCH`` words of which all but
    ``MOST_OTHER`` are equal, without other words at their ends; all or nothing of a short item."""
    if length < STRETCH:
        return [(0, length)] if len(same) == length and same.all() else []
    within = np.zeros(len(same) + 1, np.int64)  # opened less closed
    for i, j in _scored(same):
        within[i] += 1
        within[j] -= 1
    c = np.concatenate([[0], np.cumsum(same)])
    near = np.flatnonzero(c[STRETCH:] - c[:-STRETCH] >= STRETCH - MOST_OTHER)
    np.add.at(within, near, 1)
    np.add.at(within, near + STRETCH, -1)
    inside = np.concatenate([[False], np.cumsum(within)[:-1] > 0, [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    out = []
    for i, j in zip(edges[::2], edges[1::2], strict=True):
        equal = np.flatnonzero(same[i:j])
        out.append((int(i + equal[0]), int(i + equal[-1] + 1)))
    return out


def _scored(same: np.ndarray) -> list[tuple[int, int]]:
    """Disjoint segments of at least ``SCORE`` and ``LEAST`` equal words, each the best of what the ones found before it leave."""
    out, todo = [], [(0, len(same))]
    while todo:
        i, j = todo.pop()
        c = np.concatenate([[0], np.cumsum(np.where(same[i:j], 1, -3))])
        end = int(np.argmax(c - np.minimum.accumulate(c)))
        start = int(np.argmin(c[: end + 1]))
        if c[end] - c[start] >= SCORE and same[i + start : i + end].sum() >= LEAST:
            out.append((i + start, i + end))
            todo += [(a, b) for a, b in ((i, i + start), (i + end, j)) if b - a >= LEAST]
    return out


class Index:
    """Seeds of one block of items, sorted by hash."""

    def __init__(self, ids: np.ndarray, h: np.ndarray, first: np.ndarray):
        self.ids, self.h, self.first = ids, h, first
        size = np.diff(first)
        self.short = sorted({int(x) for x in size if 0 < x < STRETCH})
        seeds, items, at = [], [], []
        for i, n in enumerate(size):
            own = h[first[i] : first[i + 1]]
            for m in MASKS if n >= STRETCH else ([tuple(range(n))] if n else []):
                s = _seed(own, m)
                seeds.append(s)
                items.append(np.full(len(s), i))
                at.append(np.arange(len(s)))
        none = np.zeros(0, np.int64)
        s = np.concatenate([none.astype(np.uint64), *seeds])
        order = np.argsort(s, kind="stable")
        self.seeds = s[order]
        self.items = np.concatenate([none, *items])[order]
        self.at = np.concatenate([none, *at])[order]
        self.some = np.zeros(1 << _FILTER_BITS, bool)
        self.some[(self.seeds >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)] = True

    def hits(self, h: np.ndarray, first: np.ndarray) -> list[list[dict]]:
        """Verified overlaps of each row of a slab."""
        rows = len(first) - 1
        out: list[list[dict]] = [[] for _ in range(rows)]
        where, item, diag = [], [], []
        for m in (*MASKS, *(tuple(range(k)) for k in self.short)):
            s = _seed(h, m)
            q = np.flatnonzero(self.some[(s >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)])
            lo = np.searchsorted(self.seeds, s[q], side="left")
            n = np.searchsorted(self.seeds, s[q], side="right") - lo
            q, lo, n = q[n > 0], lo[n > 0], n[n > 0]
            if len(q):
                each = np.repeat(np.arange(len(q)), n)
                pick = lo[each] + np.arange(len(each)) - np.repeat(np.cumsum(n) - n, n)
                row = np.searchsorted(first, q[each], side="right") - 1
                whole = q[each] + m[-1] < first[row + 1]
                where.append(row[whole])
                item.append(self.items[pick][whole])
                diag.append((q[each] - self.at[pick])[whole])
        if not where:
            return out
        seen = np.unique(np.stack([np.concatenate(x) for x in (where, item, diag)]), axis=1)
        for r, i, d in seen.T:
            a, b = self.first[i], self.first[i + 1]
            lo, hi = max(d, first[r]), min(d + b - a, first[r + 1])
            same = h[lo:hi] == self.h[a + lo - d : a + hi - d]
            at = int(lo - first[r])
            for start, end in _segments(same, int(b - a)):
                out[r].append({"item_id": int(self.ids[i]), "start": at + start, "end": at + end, "matched": int(same[start:end].sum())})
        return out


def overlaps(docs: DataFrame, benchmark: DataFrame, block_words: int = 1 << 21) -> DataFrame:
    """``docs`` with ``_overlaps``, all verified overlaps (item, word span, equal words) of each row."""
    items = benchmark.select("item_id", F.coalesce("text", F.lit("")).alias("text")).where("item_id IS NOT NULL")
    n_words = items.select(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0] // 2 + 1
    blocks = -(-n_words // block_words)
    out = docs.withColumn("_overlaps", F.array().cast(HIT))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in out.schema)
    for k in range(blocks):
        part = items.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == k).toArrow()  # at most about block_words words
        if not part.num_rows:
            continue
        b, o = column_bytes(part.column("text").combine_chunks())
        _, _, h, first = words(b, o)
        index = docs.sparkSession.sparkContext.broadcast(Index(part.column("item_id").to_numpy(), h, first))

        def run(batches, index=index):
            for rows, b, o in slabs(batches):
                _, _, h, first = words(b, o)
                new = index.value.hits(h, first)
                i = rows.schema.get_field_index("_overlaps")
                if any(new):
                    both = [x + y for x, y in zip(rows.column(i).to_pylist(), new, strict=True)]
                    rows = rows.set_column(i, rows.schema.field(i), pa.array(both, rows.schema.field(i).type))
                yield rows

        out = out.mapInArrow(run, schema)
        if blocks > 1:
            out = cut(out)
            index.unpersist()
    return out


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Documents without any overlap."""
    return overlaps(docs, benchmark).where(F.size("_overlaps") == 0).drop("_overlaps")


def op8_decontamination(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = overlaps(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    ids = F.array_sort(F.array_distinct(F.transform("_overlaps", lambda x: x["item_id"])))
    return found.select(
        "doc_id",
        (F.size("_overlaps") > 0).alias("contaminated"),
        ids.alias("item_ids"),
        F.coalesce(F.array_max(F.transform("_overlaps", lambda x: x["matched"])), F.lit(0)).alias("most_matched"),
        F.array_join(
            F.transform(F.array_sort("_overlaps"), lambda x: F.concat_ws(":", x["item_id"], x["start"], x["end"], x["matched"])), ","
        ).alias("overlaps"),
    )
