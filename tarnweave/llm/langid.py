"""Language identification by interpolated Kneser-Ney character models.

One model of order ``ORDER`` per language value, learnt from the texts of that language.  Letters
are lower-cased and folded to 12-bit symbols, every run of anything else is one boundary symbol.
The n-gram counts of all training texts are summed per range of the two symbols before the last.  N-grams of four and
three symbols are used in blocks of ranges with about ``MAX_ENTRIES`` entries, one block in the driver and in a broadcast at a time; an n-gram,
its context and its back-off are in one block, so a text's entropy is the sum over blocks.  Pairs of symbols, which the symbols
bound, are in every block.  Very long texts are read whole, one at a time.  A text gets the language of
the lowest cross-entropy per symbol.  It is rejected when that entropy lies further above the
language's mean than the calibrated quantile allows; mean and quantile come from a fold of the training texts (``FOLD``) and a
model that didn't see it.

Null texts and texts without a letter are ``und`` with score 0 and are rejected.  Without training
rows every text is ``und``.  A language without a text in the fold rejects nothing.  Ties go to the language that sorts
first; repeated rows are judged alike, an empty table gives no rows, other columns are kept.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnweave.plans.durable import cut, small_batches

from .tokens import mix, slabs

ORDER = 4
BITS = 12
MAX_ENTRIES = 1 << 23
DISCOUNT = 0.75
RANGES = 64
#: One of so many training texts, by the hash of the text, calibrates.
FOLD = 8


@functools.cache
def _symbols() -> np.ndarray:
    """Symbol of each code point: 0 for what is no letter, else 1 to 4095."""
    out = np.zeros(0x110000, np.uint16)
    for c in range(0x110000):
        s = chr(c)
        if s.isalpha():
            low = ord(s.lower()[0])
            out[c] = low if low < 0xE00 else 0xE00 + low % 0x1FF
    return out


def symbols(b: np.ndarray, o: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbols of a slab, with a boundary before each row; where each row starts, and its letters."""
    points = np.frombuffer(b.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    at = np.zeros(len(b) + 1, np.int64)
    np.cumsum((b & 0xC0) != 0x80, out=at[1:])
    cut = at[o]
    s = _symbols()[points]
    keep = s != 0
    keep[1:] |= s[:-1] != 0
    first = cut[:-1][np.diff(cut) > 0]
    keep[first] = s[first] != 0
    total = np.concatenate([[0], np.cumsum(keep)])
    row_at = total[cut]
    letters = np.concatenate([[0], np.cumsum(s != 0)])[cut]
    s = s[keep]
    return s, row_at, np.diff(letters)


def grams(s: np.ndarray, row_at: np.ndarray) -> np.ndarray:
    """Key of the ORDER symbols that end at each symbol; before a row stand boundaries."""
    n = len(s)
    rows = np.repeat(row_at[:-1], np.diff(row_at))
    back = np.arange(n) - rows
    key = s.astype(np.uint64)
    for i in range(1, ORDER):
        shifted = np.zeros(n, np.uint64)
        shifted[i:] = s[:-i]
        shifted[back < i] = 0
        key |= shifted << np.uint64(BITS * i)
    return key


def _range(keys: np.ndarray) -> np.ndarray:
    """Range of the two symbols before the last of each key: an n-gram, its context, the n-gram without its first symbol and
    that one's context are all in one range."""
    pair = keys >> np.uint64(BITS) & np.uint64((1 << 2 * BITS) - 1)
    return (mix(pair) >> np.uint64(32)).astype(np.int64) % RANGES


def _merge(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    k, c = np.concatenate(keys), np.concatenate(counts)
    u, inv = np.unique(k, return_inverse=True)
    return u, np.bincount(inv, c, len(u)).astype(np.int64)


def _count(batches):
    names: dict[str, int] = {}
    held: dict[int, tuple[list, list]] = {}
    for rows, b, o in slabs(batches):
        s, row_at, _ = symbols(b, o)
        if not len(s):
            continue
        lang = np.array([names.setdefault(x, len(names)) for x in rows.column("lang").to_pylist()])
        of, key = np.repeat(lang, np.diff(row_at)), grams(s, row_at)
        for i in np.unique(of):
            k, c = np.unique(key[of == i], return_counts=True)
            ks, cs = held.setdefault(int(i), ([], []))
            ks.append(k)
            cs.append(c)
            if len(ks) > 16:
                held[int(i)] = tuple([x] for x in _merge(ks, cs))
    out = [[], [], [], []]
    for name, i in names.items():
        if i in held:
            k, c = _merge(*held[i])
            part = _range(k)
            for r in range(RANGES):
                on = part == r
                if on.any():
                    for col, v in zip(out, (name, r, k[on].tobytes(), c[on].tobytes()), strict=True):
                        col.append(v)
    yield pa.RecordBatch.from_arrays(
        [pa.array(out[0], pa.string()), pa.array(out[1], pa.int32()), pa.array(out[2], pa.binary()), pa.array(out[3], pa.binary())],
        ["lang", "r", "k", "c"],
    )


def _sum(batches):
    held: dict[tuple, tuple[list, list]] = {}
    for batch in batches:
        for x in batch.to_pylist():
            ks, cs = held.setdefault((x["lang"], x["r"]), ([], []))
            ks.append(np.frombuffer(x["k"], np.uint64))
            cs.append(np.frombuffer(x["c"], np.int64))
            if len(ks) > 16:
                held[x["lang"], x["r"]] = tuple([y] for y in _merge(ks, cs))
    rows = [(*k, *(y.tobytes() for y in _merge(*v))) for k, v in held.items()]
    cols = list(zip(*rows, strict=True)) if rows else [[], [], [], []]
    yield pa.RecordBatch.from_arrays(
        [pa.array(cols[0], pa.string()), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.binary()), pa.array(cols[3], pa.binary())],
        ["lang", "r", "k", "c"],
    )


def _pairs(batches):
    """Of each range of n-grams the pairs at their ends, with how many symbols stand before each."""
    for batch in batches:
        keys, counts = [], []
        for x in batch.column("k").to_pylist():
            longer = np.sort(np.frombuffer(x, np.uint64))
            for n in range(ORDER - 1, 1, -1):
                longer, before = _shorter(longer, n)
            keys.append(longer.tobytes())
            counts.append(before.astype(np.int64).tobytes())
        yield pa.RecordBatch.from_arrays([batch.column("lang"), pa.array(keys, pa.binary()), pa.array(counts, pa.binary())], ["lang", "k", "c"])


class Sorted:
    """Values in the order of their keys' hashes, found by a directory of the leading bits."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        h = mix(keys)
        order = np.argsort(h)
        self.h, self.values = h[order], values[order]
        self.shift = np.uint64(64 - max(4, int(len(keys)).bit_length()))
        ends = np.arange((1 << int(64 - int(self.shift))) + 1, dtype=np.uint64)
        self.at = np.searchsorted(self.h >> self.shift, ends).astype(np.int64)
        self.most = int(np.diff(self.at).max()) if len(keys) else 0

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Index of each key, -1 where it is missing."""
        h = mix(keys)
        i = self.at[(h >> self.shift).astype(np.int64)]
        out = np.full(len(keys), -1, np.int64)
        left = np.arange(len(keys))
        for _ in range(self.most):
            inside = i < len(self.h)
            i, h, left = i[inside], h[inside], left[inside]
            same = self.h[i] == h
            out[left[same]] = i[same]
            go = ~same
            i, h, left = i[go] + 1, h[go], left[go]
            if not len(left):
                break
        return out


def _group(keys: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums over equal sorted keys."""
    if not len(keys):
        return keys, weights
    new = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[new], np.add.reduceat(weights, new)


def _shorter(keys: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams at the ends of sorted distinct longer ones, and how many symbols stand before each."""
    low = np.sort(keys & np.uint64((1 << (BITS * n)) - 1))
    return _group(low, np.ones(len(low)))


class Smoothed:
    """Kneser-Ney tables of one language: per order sorted n-grams, contexts, totals and widths.

    ``low`` has the pairs of symbols where ``keys`` are only some ranges.
    """

    def __init__(self, keys: np.ndarray, counts: np.ndarray, low: tuple[np.ndarray, np.ndarray] | None = None):
        self.levels = []
        for n in range(ORDER, 0, -1):
            ctx = keys >> np.uint64(BITS)
            cs, tot = _group(ctx, counts.astype(float))
            _, wide = _group(ctx, np.ones(len(ctx)))
            self.levels.append((keys, counts.astype(float), cs, tot, wide))
            if n > 1:
                keys, counts = low if low and n == 3 else _shorter(keys, n - 1)

    def back(self, level: int, ctx: np.ndarray) -> np.ndarray:
        _, _, cs, tot, wide = self.levels[level]
        if not len(cs):
            return np.ones(len(ctx))
        i = np.minimum(np.searchsorted(cs, ctx), len(cs) - 1)
        seen = cs[i] == ctx
        return np.where(seen, DISCOUNT * wide[i] / tot[i], 1.0)

    def prob(self, level: int, keys: np.ndarray) -> np.ndarray:
        if level == ORDER:
            return np.full(len(keys), 1.0 / (1 << BITS))
        k, c, cs, tot, _ = self.levels[level]
        own = 0.0
        if len(k):
            i = np.minimum(np.searchsorted(k, keys), len(k) - 1)
            j = np.minimum(np.searchsorted(cs, keys >> np.uint64(BITS)), len(cs) - 1)
            own = np.where(k[i] == keys, np.maximum(c[i] - DISCOUNT, 0) / tot[j], 0.0)
        low = keys & np.uint64((1 << (BITS * (ORDER - level - 1))) - 1)
        return own + self.back(level, keys >> np.uint64(BITS)) * self.prob(level + 1, low)


class Model:
    """Log2 probabilities per language of all n-grams seen in any language, by order."""

    def __init__(self, langs: list[str], counts: dict[str, tuple[np.ndarray, np.ndarray]], low: dict[str, tuple[np.ndarray, np.ndarray]], ranges: range):
        self.langs, self.ranges = langs, ranges
        none = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        each = [Smoothed(*counts.get(x, none), low[x]) for x in langs]
        self.tables, self.backs = [], []
        for level in range(ORDER):
            keys = np.unique(np.concatenate([e.levels[level][0] for e in each]))
            self.tables.append(Sorted(keys, np.log2(np.stack([e.prob(level, keys) for e in each], 1)).astype(np.float32)))
            ctx = np.unique(np.concatenate([e.levels[level][2] for e in each]))
            self.backs.append(Sorted(ctx, np.log2(np.stack([e.back(level, ctx) for e in each], 1)).astype(np.float32)))
        self.floor = -float(BITS)

    def logs(self, keys: np.ndarray, level: int = 0) -> np.ndarray:
        if level == ORDER:
            return np.full((len(keys), len(self.langs)), self.floor, np.float32)
        i = self.tables[level].find(keys)
        out = self.tables[level].values[i]
        miss = np.flatnonzero(i < 0)
        if len(miss):
            k = keys[miss]
            j = self.backs[level].find(k >> np.uint64(BITS))
            w = np.where((j >= 0)[:, None], self.backs[level].values[j], np.float32(0))
            out[miss] = w + self.logs(k & np.uint64((1 << (BITS * (ORDER - level - 1))) - 1), level + 1)
        return out


class Counts:
    """Summed n-gram counts ``(lang, r, k, c)`` of a training set, from which models of blocks of ranges are made.

    The longest n-grams of a range give its n-grams of one symbol less whole; only pairs of symbols go over all ranges.  Tasks count them, and
    the driver adds up at most 4096 * 4096 of a language.
    """

    def __init__(self, rows: DataFrame):
        self.rows = rows
        sizes = rows.groupBy("r").agg(F.sum(F.octet_length("k")).alias("n")).collect()  # at most RANGES
        self.size = {x.r: x["n"] // 8 for x in sizes}
        low: dict[str, tuple[list, list]] = {}
        for x in rows.select("lang", "k").mapInArrow(_pairs, "lang string, k binary, c binary").coalesce(8).toLocalIterator():
            ks, cs = low.setdefault(x.lang, ([], []))
            ks.append(np.frombuffer(x.k, np.uint64))
            cs.append(np.frombuffer(x.c, np.int64))
            if len(ks) > 16:
                low[x.lang] = tuple([y] for y in _merge(ks, cs))
        self.low = {k: _merge(*v) for k, v in low.items()}
        self.langs = sorted(self.low)

    def blocks(self) -> list[range]:
        """Neighbouring ranges with about MAX_ENTRIES entries together."""
        out, first, held = [], 0, 0
        for r in range(RANGES):
            if held and held + self.size.get(r, 0) > MAX_ENTRIES:
                out.append(range(first, r))
                first, held = r, 0
            held += self.size.get(r, 0)
        return [*out, range(first, RANGES)]

    def model(self, ranges: range) -> Model:
        got: dict[str, tuple[list, list]] = {}
        for x in self.rows.where(F.col("r").between(ranges.start, ranges.stop - 1)).coalesce(8).toLocalIterator():
            ks, cs = got.setdefault(x.lang, ([], []))
            ks.append(np.frombuffer(x.k, np.uint64))
            cs.append(np.frombuffer(x.c, np.int64))
        return Model(self.langs, {k: _merge(*v) for k, v in got.items()}, self.low, ranges)


_COUNTS = "lang string, r int, k binary, c binary"


def _counted(rows: DataFrame) -> DataFrame:
    small_batches(rows.sparkSession)
    return cut(rows.mapInArrow(_count, _COUNTS).repartition(RANGES, "r").mapInArrow(_sum, _COUNTS))


def train(docs: DataFrame) -> Counts | None:
    """Counts of the ``text`` and non-null ``lang`` of all rows."""
    counts = Counts(_counted(docs.where("lang IS NOT NULL AND text IS NOT NULL").select("text", "lang")))
    return counts if counts.langs else None


def learn(docs: DataFrame) -> tuple[Counts | None, dict[str, tuple[float, float]]]:
    """Counts of the ``text`` and non-null ``lang`` of all rows, and the limits of rejection from the fold."""
    rows = docs.where("lang IS NOT NULL AND text IS NOT NULL").select("text", "lang")
    fold = F.pmod(F.xxhash64("text"), F.lit(FOLD)) == 0
    marked = _counted(rows.withColumn("lang", F.concat(F.when(fold, "1").otherwise("0"), "lang")))  # once counted, the fold is told by the name
    name = F.substring("lang", 2, 1 << 30)
    both = Counts(cut(marked.withColumn("lang", name).repartition(RANGES, "r").mapInArrow(_sum, _COUNTS)))
    if not both.langs:
        return None, {}
    rest = Counts(marked.where("substr(lang, 1, 1) = '0'").withColumn("lang", name))
    seen = score(rows.where(fold).select("text"), rest if rest.langs else both)
    return both, calibrate(cut(seen.select("lang_pred", "entropy", "n_symbols")))


def score(docs: DataFrame, counts: Counts | None) -> DataFrame:
    """Adds ``lang_pred``, ``score``, ``entropy`` (bits a symbol of the winner, null for ``und``) and
    ``n_symbols``; the columns that ``docs`` has must not use these names."""
    extra = "lang_pred string, score double, entropy double, n_symbols long"
    if counts is None:
        return docs.select("*", F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(None).cast("double").alias("entropy"), F.lit(0).cast("long").alias("n_symbols"))
    spark = docs.sparkSession
    small_batches(spark)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    *firsts, last = counts.blocks()

    def sums(m: Model, rows, b, o, before):
        s, row_at, letters = symbols(b, o)
        total = np.zeros((len(rows), len(m.langs)))
        if len(s):
            keys = grams(s, row_at)
            if len(m.ranges) < RANGES:
                logs = np.zeros((len(keys), len(m.langs)), np.float32)
                r = _range(keys)
                own = np.flatnonzero((r >= m.ranges.start) & (r < m.ranges.stop))
                logs[own] = m.logs(keys[own])
            else:
                logs = m.logs(keys)
            some = np.flatnonzero(np.diff(row_at) > 0)
            total[some] = np.add.reduceat(logs, row_at[some], axis=0, dtype=np.float64)
        if before is not None:
            total += np.frombuffer(b"".join(before.to_pylist())).reshape(total.shape)
        return total, np.diff(row_at), letters

    rows = docs
    for ranges in firsts:
        shared = spark.sparkContext.broadcast(counts.model(ranges))

        def part(batches, shared=shared):
            for rows, b, o in slabs(batches):
                at = rows.schema.get_field_index("_sums")
                total, _, _ = sums(shared.value, rows, b, o, rows.column(at) if at >= 0 else None)
                kept = rows.drop_columns(["_sums"]) if at >= 0 else rows
                yield pa.RecordBatch.from_arrays([*kept.columns, pa.array([x.tobytes() for x in total], pa.binary())], [*kept.schema.names, "_sums"])

        rows = cut(rows.mapInArrow(part, f"{fields}, _sums binary"))
        shared.unpersist()
    shared = spark.sparkContext.broadcast(counts.model(last))

    def run(batches):
        m = shared.value
        for rows, b, o in slabs(batches):
            at = rows.schema.get_field_index("_sums")
            total, n, letters = sums(m, rows, b, o, rows.column(at) if at >= 0 else None)
            rows = rows.drop_columns(["_sums"]) if at >= 0 else rows
            cost = -total / np.maximum(n, 1)[:, None]
            best = cost.argmin(1)
            low = cost[np.arange(len(n)), best]
            share = 1 / np.exp2(-(cost - low[:, None]) * np.minimum(n, 64)[:, None]).sum(1)
            ok = letters > 0
            pred = [m.langs[i] if y else "und" for i, y in zip(best, ok, strict=True)]
            new = [pa.array(pred, pa.string()), pa.array(np.where(ok, share, 0.0)), pa.array(low, mask=~ok), pa.array(n, pa.int64())]
            yield pa.RecordBatch.from_arrays([*rows.columns, *new], [*rows.schema.names, "lang_pred", "score", "entropy", "n_symbols"])

    return rows.mapInArrow(run, f"{fields}, {extra}")


def calibrate(scored: DataFrame, quantile: float = 0.9995, slack: float = 1.5, least: float = 1.5) -> dict[str, tuple[float, float]]:
    """Per language mean entropy and least rejected excess over it, in bits a symbol.

    Excesses of all given rows go through a histogram of bounded size; the limit is their quantile
    times a slack and at least ``least``, so texts of the kind that was learnt from are kept.  ``scored`` is read twice.
    """
    seen = scored.where("entropy IS NOT NULL")
    stats = seen.groupBy("lang_pred").agg((F.sum(F.col("entropy") * F.col("n_symbols")) / F.sum("n_symbols")).alias("mean"))
    mean = {r.lang_pred: r["mean"] for r in stats.collect()}  # one row a language
    if not mean:
        return {}
    excess = F.greatest(F.col("entropy") - _pick(mean), F.lit(0.0))
    bins = seen.groupBy("lang_pred", F.floor(excess * 32).alias("b")).count().collect()
    out = {}
    for name, m in mean.items():
        own = sorted((r["b"], r["count"]) for r in bins if r.lang_pred == name)
        total, run = sum(c for _, c in own), 0
        for b, c in own:
            run += c
            if run >= quantile * total:
                out[name] = (m, max(least, slack * (b + 1) / 32))
                break
    return out


def _pick(values: dict[str, float]):
    e = F.lit(None).cast("double")
    for k, v in values.items():
        e = F.when(F.col("lang_pred") == k, F.lit(float(v))).otherwise(e)
    return e


def identify(docs: DataFrame, counts: Counts | None, limits: dict[str, tuple[float, float]]) -> DataFrame:
    """``score`` with ``rejected``: no language, or an entropy beyond the calibrated excess."""
    excess = F.col("entropy") - _pick({k: v[0] for k, v in limits.items()})
    over = F.coalesce(excess > _pick({k: v[1] for k, v in limits.items()}), F.lit(False))
    return score(docs, counts).withColumn("rejected", F.col("entropy").isNull() | over)


def held_out(modulus: int, remainder: int = 2):
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % modulus == remainder, F.lit(False))


def op5_language_id(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = identify(docs.select("doc_id", "text"), *learn(docs.where(~held_out(4))))
    return found.select(
        "doc_id", held_out(4).alias("held_out"), "lang_pred", "score", "entropy", "rejected"
    )
