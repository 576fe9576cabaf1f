"""Phrase collocations by count tries of limited depth.

Each task counts the phrases of up to ``longest`` words of its texts in tries (one for about ``SHARD`` words): a
node holds how often its words follow each other within a piece.  A trie is written sorted and
cut at the borders of prefix ranges; a range gets the blocks of all tries and merges them level by level.  Borders
are quantiles of a sample of phrases, so a first word or pair of words of a third of the corpus is simply several ranges;
the nodes on the way to a border go into the blocks on both sides, which makes the walk from the root complete in every
range, and count once.  The walk gives the counts of all left parts; right parts are those of the suffix,
the node without the first word, which is looked up level by level.

Words and pieces are those of ``words_in_pieces``.  A word is its hash with that of its language (64 bits), phrases of two languages
never meet.  A null language is ``und``.

Null and empty texts hold no word.  Repeated rows count each time.  Very long texts are read whole, without a limit.  Ties in the ranking
go to the phrase of least bytes.  An empty table has no phrases.  Only ``text`` and ``lang`` are read, so other
columns may have any name.
"""

from __future__ import annotations

import hashlib
import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tarnweave.plans.durable import cut, small_batches

from .lookups import lookup
from .tokens import _FOLDED, _powers, column_bytes, mix, slabs

#: Words of a trie, and words whose phrases a range should hold.
SHARD, RANGE = 1 << 21, 1 << 21
#: One in so many phrases stands in the sample of borders; samples for each range.
RATE, PER_RANGE = 1 << 12, 16
_PIECE = np.zeros(256, bool)
_PIECE[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_GAP = _PIECE.copy()
_GAP[[0x20, 0x09]] = True


def words_in_pieces(b: np.ndarray, o: np.ndarray, salt: np.ndarray):
    """Words of a slab: starts, ends, hashes with A-Z lower-cased and the row's salt, and whether the next word continues the piece.

    Pieces end at ``[.,;:!?\\x0A-\\x0D]``; words are ``[^\\x20\\x09]+`` within them.
    """
    n = len(b)
    if not n:
        none = np.zeros(0, np.int64)
        return none, none, none.astype(np.uint64), none.astype(bool)
    inside = ~_GAP[b]
    edge = np.zeros(n + 1, bool)
    edge[o] = True
    starts = np.flatnonzero(inside & (edge[:n] | ~np.concatenate([[False], inside[:-1]])))
    ends = np.flatnonzero(inside & (edge[1:] | ~np.concatenate([inside[1:], [False]]))) + 1
    power, inverse = _powers(n)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_FOLDED[b] * power[:n], out=sums[1:])
    row = np.searchsorted(o, starts, side="right") - 1
    h = mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))
    h = mix(h ^ salt[row]) | np.uint64(1)
    pieces = np.zeros(n + 1, np.int64)
    np.cumsum(_PIECE[b], out=pieces[1:])
    glued = np.zeros(len(starts), bool)
    glued[:-1] = (pieces[starts[1:]] == pieces[ends[:-1]]) & (row[1:] == row[:-1])
    return starts, ends, h, glued


def _langs(rows: pa.RecordBatch) -> tuple[list[str], np.ndarray]:
    """Language of each row, and the hash that its words take with them."""
    names = [x if x is not None else "und" for x in rows.column("lang").to_pylist()]
    known = {x: int.from_bytes(hashlib.blake2b(x.encode(), digest_size=8).digest(), "little") for x in set(names)}
    return names, np.array([known[x] for x in names], np.uint64)


def _phrases(glued: np.ndarray, k: int) -> np.ndarray:
    """Where phrases of k words begin."""
    n = len(glued) - k + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    whole = np.ones(n, bool)
    for i in range(k - 1):
        whole &= glued[i : i + n]
    return np.flatnonzero(whole)


def _sampled(longest: int):
    """Words of each language of a batch, and a sample of its phrases of full length."""

    def run(batches):
        for rows, b, o in slabs(batches):
            names, salt = _langs(rows)
            starts, _, h, glued = words_in_pieces(b, o, salt)
            row = np.searchsorted(o, starts, side="right") - 1
            each = np.bincount(row, minlength=len(names))
            total: dict[str, int] = {}
            for name, n in zip(names, each.tolist(), strict=True):
                if n:
                    total[name] = total.get(name, 0) + n
            at = _phrases(glued, longest)
            key = mix(h[at] + np.arange(len(at), dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) if len(at) else h[:0]
            chosen = at[key % np.uint64(RATE) == 0]
            place = (key[key % np.uint64(RATE) == 0] >> np.uint64(1)).astype(np.int64)
            phrases = [h[i : i + longest].view(np.int64).tolist() for i in chosen]
            none = len(phrases)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([*total, *[None] * none], pa.string()),
                    pa.array([*total.values(), *[None] * none], pa.int64()),
                    pa.array([*[None] * len(total), *place.tolist()], pa.int64()),
                    pa.array([*[None] * len(total), *phrases], pa.list_(pa.int64())),
                ],
                ["lang", "n", "place", "phrase"],
            )

    return run


class Trie:
    """Sorted levels: ``keys[d]`` is (parent's place) * words + word, ``counts[d]`` how often the node occurs.

    ``hashes`` are the distinct words in order, ``text`` and ``lang`` say what they are.
    """

    def __init__(self, hashes, text, lang, keys, counts):
        self.hashes, self.text, self.lang, self.keys, self.counts = hashes, text, lang, keys, counts

    @classmethod
    def of(cls, h: np.ndarray, glued: np.ndarray, text: dict, longest: int) -> Trie:
        hashes, ids = np.unique(h, return_inverse=True)
        words = max(len(hashes), 1)
        keys, counts, node = [], [], None
        for k in range(1, longest + 1):
            at = _phrases(glued, k)
            key = ids[at] if k == 1 else node[at] * words + ids[at + k - 1]
            level, place, n = np.unique(key, return_inverse=True, return_counts=True)
            node = np.zeros(len(h), np.int64)
            node[at] = place
            keys.append(level.astype(np.int64))
            counts.append(n.astype(np.int64))
        own = [text[x] for x in hashes.tolist()]
        return cls(hashes, [x[0] for x in own], [x[1] for x in own], keys, counts)

    def slices(self, borders: np.ndarray):
        """For each range the first and the end of its nodes on every level; nodes on the way to a border are in both ranges."""
        words = max(len(self.hashes), 1)
        first, end = [], []
        exact = np.ones(len(borders), bool)
        base = np.zeros(len(borders), np.int64)  # where the nodes on the way stand, or the first node after them
        for d, keys in enumerate(self.keys):
            w = np.searchsorted(self.hashes, borders[:, d])
            known = exact & (w < len(self.hashes))
            known[known] &= self.hashes[w[known]] == borders[known, d]
            key = base * words + np.where(exact, w, 0)
            lo = np.searchsorted(keys, key)
            here = known & (lo < len(keys))
            here[here] &= keys[lo[here]] == key[here]
            last = d == len(self.keys) - 1
            first.append(np.concatenate([[0], lo]))
            end.append(np.concatenate([lo + (0 if last else here), [len(keys)]]))
            base, exact = lo, here
        return first, end

    def block(self, lo: list[int], hi: list[int]) -> bytes:
        """A part of the levels with the words that it uses."""
        words = max(len(self.hashes), 1)
        cut_ = [(k[a:b] // words, k[a:b] % words) for k, a, b in zip(self.keys, lo, hi, strict=True)]
        used, ids = np.unique(np.concatenate([w for _, w in cut_]), return_inverse=True)
        ids = np.split(ids, np.cumsum([len(w) for _, w in cut_])[:-1])
        langs = sorted({self.lang[i] for i in used.tolist()})
        code = {x: i for i, x in enumerate(langs)}
        levels = []
        for d, ((parent, _), w, a, b) in enumerate(zip(cut_, ids, lo, hi, strict=True)):
            children = np.bincount(parent - lo[d - 1], minlength=hi[d - 1] - lo[d - 1]) if d else None
            levels.append((_narrow(children), _narrow(w), _narrow(self.counts[d][a:b])))
        raw = pickle.dumps(
            (self.hashes[used], "\n".join(self.text[i] for i in used.tolist()), langs, _narrow(np.array([code[self.lang[i]] for i in used.tolist()], np.int64)), levels)
        )
        return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)

    @classmethod
    def merged(cls, blocks: list[bytes]) -> Trie:
        """One trie with the sums of the blocks' counts."""
        parts = [pickle.loads(pa.decompress(x[8:], int.from_bytes(x[:8], "little"), codec="zstd", asbytes=True)) for x in blocks]
        hashes, first = np.unique(np.concatenate([p[0] for p in parts]), return_index=True)
        text = [t for p in parts for t in p[1].split("\n")]
        lang = [p[2][i] for p in parts for i in p[3].tolist()]
        to = [np.searchsorted(hashes, p[0]) for p in parts]
        words, keys, counts = len(hashes), [], []
        nodes = [np.zeros(0, np.int64)] * len(parts)
        for d in range(len(parts[0][4])):
            raw, n = [], []
            for p, ids, node in zip(parts, to, nodes, strict=True):
                children, w, count = p[4][d]
                key = ids[w.astype(np.int64)].astype(np.int64)
                raw.append(key if children is None else np.repeat(node, children) * words + key)
                n.append(count)
            every = np.concatenate(raw)
            order = np.argsort(every, kind="stable")  # runs that are sorted already are merged
            new = np.ones(len(every), bool)
            new[1:] = every[order[1:]] != every[order[:-1]]
            at = np.empty(len(every), np.int64)
            at[order] = np.cumsum(new) - 1
            keys.append(every[order[new]])
            counts.append(_sums(np.concatenate(n).astype(np.int64)[order], new))
            nodes = np.split(at, np.cumsum([len(x) for x in raw])[:-1])
        return cls(hashes, [text[i] for i in first.tolist()], [lang[i] for i in first.tolist()], keys, counts)

    def frequent(self, least: int, border: np.ndarray | None):
        """Nodes of this range with at least so many occurrences: ``(lang, words, a, lefts)``; those on the way to the border belong to the range before."""
        words = max(len(self.hashes), 1)
        out = []
        way = np.zeros(0, np.int64)  # the node on the way to the border, on the level before
        for d, (keys, n) in enumerate(zip(self.keys, self.counts, strict=True)):
            owned = n >= least
            if border is not None and d < len(self.keys) - 1:
                on = self.hashes[keys % words] == border[d]
                if d:
                    on &= np.isin(keys // words, way)
                way = np.flatnonzero(on)
                owned[way] = False
            pick = np.flatnonzero(owned)
            path, lefts, at = [], [], pick
            for e in range(d, -1, -1):
                path.append(self.keys[e][at] % words)
                if e < d:
                    lefts.append(self.counts[e][at])
                at = self.keys[e][at] // words
            path, lefts = path[::-1], lefts[::-1]
            for i, a in enumerate(n[pick].tolist()):
                ids = [p[i] for p in path]
                out.append((self.lang[ids[0]], [self.text[x] for x in ids], a, [int(x[i]) for x in lefts]))
        return out


def _sums(n: np.ndarray, new: np.ndarray) -> np.ndarray:
    return np.add.reduceat(n, np.flatnonzero(new)) if len(n) else n


def _narrow(x: np.ndarray | None) -> np.ndarray | None:
    """The least type that holds the values."""
    if x is None:
        return None
    most = int(x.max()) if len(x) else 0
    return x.astype(np.uint8 if most < 1 << 8 else np.uint16 if most < 1 << 16 else np.uint32 if most < 1 << 32 else np.int64)


def _shards(longest: int, borders):
    """Sorted tries of a task, cut into the blocks of the ranges."""

    def blocks(held, text):
        trie = Trie.of(np.concatenate([x[0] for x in held]), np.concatenate([x[1] for x in held]), text, longest)
        first, end = trie.slices(borders.value)
        ranges = [r for r in range(len(first[0])) if end[0][r] > first[0][r]]
        made = [trie.block([int(x[r]) for x in first], [int(x[r]) for x in end]) for r in ranges]
        return pa.RecordBatch.from_arrays([pa.array(ranges, pa.int64()), pa.array(made, pa.binary())], ["range", "block"])

    def run(batches):
        held, text, n = [], {}, 0
        for rows, b, o in slabs(batches):
            names, salt = _langs(rows)
            starts, ends, h, glued = words_in_pieces(b, o, salt)
            distinct, at = np.unique(h, return_index=True)
            folded = np.where((b >= 65) & (b <= 90), b + 32, b).astype(np.uint8).tobytes()
            for x, i in zip(distinct.tolist(), at.tolist(), strict=True):
                if x not in text:
                    text[x] = folded[starts[i] : ends[i]].decode(), names[int(np.searchsorted(o, starts[i], side="right")) - 1]
            held.append((h, glued))
            n += len(h)
            if n >= SHARD:
                yield blocks(held, text)
                held, text, n = [], {}, 0
        if n:
            yield blocks(held, text)

    return run


def _merge(least: int, borders):
    def run(table: pa.Table) -> pa.Table:
        r = table.column("range")[0].as_py()
        found = Trie.merged(table.column("block").to_pylist()).frequent(least, borders.value[r - 1] if r else None)
        columns = list(zip(*found, strict=True)) or [()] * 4
        kinds = (pa.string(), pa.list_(pa.string()), pa.int64(), pa.list_(pa.int64()))
        return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["lang", "words", "a", "lefts"])

    return run


def count(docs: DataFrame, longest: int = 3, least: int = 10) -> tuple[DataFrame, DataFrame]:
    """Phrases of up to ``longest`` words with at least ``least`` occurrences, ``(lang, words, a, lefts, rights)``,
    where lefts and rights are the counts of the parts before and after each cut; and ``(lang, n)``, all words."""
    spark = docs.sparkSession
    small_batches(spark)
    texts = docs.select("text", "lang")
    sample = cut(texts.mapInArrow(_sampled(longest), "lang string, n bigint, place bigint, phrase array<bigint>"))
    n = sample.where("n IS NOT NULL").groupBy("lang").agg(F.sum("n").alias("n"))
    ranges = -(-(n.agg(F.sum("n")).first()[0] or 0) // RANGE)
    chosen = sample.where("phrase IS NOT NULL").orderBy("place", "phrase").limit(ranges * PER_RANGE).select("phrase").toArrow() if ranges > 1 else None
    own = np.array(chosen["phrase"].to_pylist() if chosen else [], np.int64).reshape(-1, longest).view(np.uint64)
    own = np.unique(own, axis=0)
    own = own[np.lexsort(own.T[::-1])]
    at = np.unique(np.arange(1, ranges) * len(own) // max(ranges, 1)) if len(own) else np.zeros(0, np.int64)
    borders = spark.sparkContext.broadcast(own[at])
    blocks = texts.mapInArrow(_shards(longest, borders), "range bigint, block binary")
    nodes = cut(blocks.groupBy("range").applyInArrow(_merge(least, borders), "lang string, words array<string>, a bigint, lefts array<bigint>"))
    level = nodes.where(F.size("words") == 1).withColumn("rights", F.array().cast("array<bigint>"))
    out = level
    for k in range(2, longest + 1):
        parts = level.select("lang", F.col("words").alias("_rest"), F.col("a").alias("_f"), F.col("rights").alias("_after"))
        longer = nodes.where(F.size("words") == k).withColumn("_rest", F.slice("words", 2, k - 1))
        level = lookup(longer, parts, ["lang", "_rest"]).select(*nodes.columns, F.concat(F.array("_f"), "_after").alias("rights"))
        level = cut(level)
        out = out.union(level)
    return out, n


def collocations(docs: DataFrame, longest: int = 3, least: int = 10, share: int = 50, top: int = 2000) -> DataFrame:
    """The first phrases of each language: ``(lang, rank, phrase, a, l, r, n, score)``.

    A phrase of 2 to ``longest`` words occurs ``a`` times.  Of its cuts the one with the least floor(1000000 * a * a / (l * r)) counts,
    the first of equal ones.  Phrases within a longer one that occurs at least ``share`` percent as often are left out.
    """
    nodes, n = count(docs, longest, least)
    phrases = nodes.where(F.size("words") > 1).withColumn("phrase", F.array_join("words", " "))
    subs = [F.slice("words", i, k) for k in range(2, longest) for i in range(1, longest)]
    inside = phrases.where(F.size("words") > 2).select("lang", "a", F.size("words").alias("_size"), F.explode(F.array(*subs)).alias("words")) if subs else phrases.limit(0).select("lang", "a", F.lit(0).alias("_size"), "words")
    inside = inside.where((F.size("words") > 1) & (F.size("words") < F.col("_size")))
    longer = inside.groupBy("lang", F.array_join("words", " ").alias("phrase")).agg(F.max("a").alias("_longer"))
    kept = phrases.join(longer, ["lang", "phrase"], "left").where(F.col("_longer").isNull() | (F.col("_longer") * F.lit(100) < F.col("a") * F.lit(share)))
    wide = lambda x: x.cast("decimal(19,0)")
    kept = kept.withColumn("_aa", wide(F.col("a")) * wide(F.col("a")) * F.lit(1000000).cast("decimal(7,0)"))
    kept = kept.withColumn("_lr", F.zip_with("lefts", "rights", lambda x, y: F.struct((wide(x) * wide(y)).alias("lr"), x.alias("l"), y.alias("r"))))
    cuts = F.expr("transform(_lr, (x, i) -> named_struct('score', _aa div x.lr, 'k', i, 'l', x.l, 'r', x.r))")
    scored = kept.withColumn("_cut", F.array_min(cuts)).select("lang", "phrase", "a", "_cut.l", "_cut.r", "_cut.score")
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    part = F.pmod(F.xxhash64("phrase"), F.lit(64))
    first = scored.withColumn("_rank", F.row_number().over(Window.partitionBy("lang", part).orderBy(*order))).where(F.col("_rank") <= top)
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    return ranked.join(n, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op11_phrase_collocations(spark, sf_dir: str) -> DataFrame:
    return collocations(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP11_SQL = r"""
WITH piece AS (
    SELECT coalesce(lang, 'und') AS lang, row_number() OVER () AS id,
           string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]') AS pieces
    FROM documents),
one AS (SELECT lang, id, unnest(pieces) AS piece, generate_subscripts(pieces, 1) AS p FROM piece),
w AS (SELECT lang, id, p, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM one),
word AS (SELECT lang, id, p, unnest(w) AS a, generate_subscripts(w, 1) AS i FROM w),
three AS (SELECT lang, a, lead(a) OVER o AS b, lead(a, 2) OVER o AS c FROM word WINDOW o AS (PARTITION BY id, p ORDER BY i)),
grams AS (
    SELECT lang, 1 AS k, a AS phrase, count(*) AS f FROM three GROUP BY ALL
    UNION ALL SELECT lang, 2 AS k, a || ' ' || b AS phrase, count(*) AS f FROM three WHERE b IS NOT NULL GROUP BY ALL
    UNION ALL SELECT lang, 3 AS k, a || ' ' || b || ' ' || c AS phrase, count(*) AS f FROM three WHERE c IS NOT NULL GROUP BY ALL),
total AS (SELECT lang, sum(f) AS n FROM grams WHERE k = 1 GROUP BY lang),
cand AS (SELECT lang, k AS size, phrase, f AS a, string_split(phrase, ' ') AS w FROM grams WHERE k > 1 AND f >= 10),
cut AS (
    SELECT c.lang, c.size, c.phrase, c.a, c.w, k.k, x.f AS l, y.f AS r, (1000000::HUGEINT * c.a * c.a) // (x.f::HUGEINT * y.f) AS score
    FROM cand c JOIN (VALUES (1), (2)) AS k(k) ON k.k < c.size
    JOIN grams x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:k.k], ' ')
    JOIN grams y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[k.k + 1:], ' ')),
best AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inside AS (
    SELECT lang, phrase, max(a) AS longer
    FROM (SELECT lang, a, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS phrase FROM cand WHERE size = 3)
    GROUP BY ALL),
kept AS (SELECT b.* FROM best b LEFT JOIN inside i USING (lang, phrase) WHERE i.longer IS NULL OR 100 * i.longer < 50 * b.a)
SELECT lang, rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept) JOIN total USING (lang)
WHERE rank <= 2000
"""
