"""N-gram Jaccard self-join with prefix tries.

A document's set are the hashes of its distinct shingles of ``K`` words.  Equal sets are one class,
so exact copies cost one member.  All shingles are ordered by one global order, rare first: a
sketch of fixed size counts every shingle of the corpus, and a token is the class of the count's excess over the
usual cell followed by the hash.  Two sets with Jaccard similarity of 3/4 share a token among the first
quarter of each, so the first levels of the tries are built over those prefixes only, spread over
tasks by token, and are pruned by length and by the length that remains.

Runs of a token up to ``RUN`` members give their pairs, a longer run stars around a few of its members.  Pairs lose
those whose parity bitmaps differ in more places than linked sets can (a bound, so no link is lost); what is left falls into
families.  The sets of a family go once into one path-compressed trie, frequent tokens first, through which each of them is
sent: overlaps of shared paths are counted once and a subtree is left as soon as what remains can't
reach the threshold.  Families too large for one trie are split by pairs around a member.  What the stars
of long runs leave in parts goes set by set through tries of the run's sets: no pairs of a run
are written, none within a part is needed, and no link between parts is lost.

Null and empty texts have no shingles and stay alone; rows of one doc_id are one document, rows
without doc_id are alone with a null component; other columns are ignored.  An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnweave.operators.components import components
from tarnweave.plans.durable import cut, release, small_batches

from .tokens import mix, shingles, slabs, words

K = 5
CELLS = 20
RUN = 32
STARS = 4
TRIE = 512
#: Tokens of a family that go into one trie.
TOKENS = 1 << 19
ENTRIES = 1 << 18
FILTER_BITS = 24
#: More ids than this are joined instead of put in a bit array (32 MB).
MOST_IDS = 1 << 25
_CHUNK = 12


def _sets(b, o, rank):
    """Row and sorted distinct tokens of every row of a slab that has words."""
    _, _, h, first = words(b, o)
    s, owner = shingles(h, first, K)
    if len(s):
        order = np.argsort(owner, kind="stable")
        s, owner = s[order], owner[order]
        t = (rank[(s >> np.uint64(64 - CELLS)).astype(np.int64)].astype(np.uint64) << np.uint64(56)) | (s >> np.uint64(8))
        at = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
        for i, j in zip(at, [*at[1:], len(t)], strict=True):
            yield int(owner[i]), np.unique(t[i:j])


def _sketch(docs: DataFrame) -> np.ndarray:
    """Class of the excess of each of 2**CELLS cells, counting the shingles of all texts."""

    def count(batches):
        n = np.zeros(1 << CELLS, np.int64)
        held, size = [], 0
        for _, b, o in slabs(batches):
            _, _, h, first = words(b, o)
            s, _ = shingles(h, first, K)
            held.append((s >> np.uint64(64 - CELLS)).astype(np.uint32))
            size += len(s)
            if size >= len(n):
                n += np.bincount(np.concatenate(held), minlength=len(n))
                held, size = [], 0
        if held:
            n += np.bincount(np.concatenate(held), minlength=len(n))
        parts = n.astype(np.uint32).reshape(-1, 1 << _CHUNK)  # of one task
        on = np.flatnonzero(parts.any(1))
        yield pa.RecordBatch.from_arrays([pa.array(on), pa.array([parts[i].tobytes() for i in on], pa.binary())], ["part", "n"])

    def add(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                x = np.frombuffer(n, np.uint32).astype(np.int64)
                sums[part] = sums[part] + x if part in sums else x
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int64()), pa.array([x.tobytes() for x in sums.values()], pa.binary())], ["part", "n"])

    n = np.zeros((1 << (CELLS - _CHUNK), 1 << _CHUNK), np.int64)
    summed = docs.select("text").mapInArrow(count, "part long, n binary").repartition("part").mapInArrow(add, "part long, n binary")
    for part, x in summed.collect():  # 2**CELLS numbers
        n[part] = np.frombuffer(x, np.int64)
    over = np.maximum(n.ravel() - np.median(n), 0)  # a large corpus fills every cell with rare ones
    return np.minimum(4 * np.log2(over + 1), 255).astype(np.uint8)


def _describe(docs: DataFrame, rank) -> DataFrame:
    """Per row: doc_id, n_shingles and two hashes of the set."""

    def run(batches):
        for rows, b, o in slabs(batches):
            n = np.zeros(len(rows), np.int64)
            s1, s2 = np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64)
            for i, t in _sets(b, o, rank.value):
                n[i] = len(t)
                s1[i] = np.bitwise_xor.reduce(mix(t)).view(np.int64)
                s2[i] = mix(t ^ np.uint64(0x5851F42D4C957F2D)).sum().view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id").cast(pa.int64()), pa.array(n), pa.array(s1), pa.array(s2)], ["doc_id", "n", "s1", "s2"]
            )

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n long, s1 long, s2 long")


_ENTRY = np.dtype([("t", "<u8"), ("id", "<i8"), ("n", "<i4"), ("p", "<i4")])


def _deal(docs: DataFrame, representatives: DataFrame, rank, buckets: int) -> DataFrame:
    """Prefix entries of the class representatives, packed by ranges of tokens.

    The bit array lets a few other members through, which then merely link to their own class.
    """

    def pack(held):
        e = np.concatenate(held)
        which = (mix(e["t"]) >> np.uint64(33)).astype(np.int64) % buckets
        order = np.argsort(which, kind="stable")
        e, which = e[order], which[order]
        at = np.flatnonzero(np.concatenate([[True], which[1:] != which[:-1]]))
        ends = [*at[1:], len(e)]
        return pa.RecordBatch.from_arrays(
            [pa.array(which[at]), pa.array([e[i:j].tobytes() for i, j in zip(at, ends, strict=True)], pa.binary())], ["bucket", "e"]
        )

    def run(batches):
        held, size = [], 0
        for ids, b, o in batches:
            for i, t in _sets(b, o, rank.value):
                n = len(t)
                t = t[: n - (3 * n + 3) // 4 + 1]
                e = np.empty(len(t), _ENTRY)
                e["t"], e["id"], e["n"], e["p"] = t, ids[i], n, np.arange(len(t))
                held.append(e)
                size += len(e)
            if size >= ENTRIES:
                yield pack(held)
                held, size = [], 0
        if size:
            yield pack(held)

    return _among(docs, representatives, run, "bucket long, e binary").repartition(buckets, "bucket")


def _runs(dealt: DataFrame) -> DataFrame:
    """Pairs of short runs (a, b) and members of long runs (token, a), b null."""

    def run(batches):
        held = [np.frombuffer(x, _ENTRY) for batch in batches for x in batch.column("e").to_pylist()]
        if not held:
            return
        e = np.concatenate(held)
        del held
        e = e[np.argsort(e["t"], kind="stable")]
        at = np.flatnonzero(np.concatenate([[True], e["t"][1:] != e["t"][:-1]]))
        size = np.diff(np.append(at, len(e)))
        pairs = np.zeros((0, 2), np.int64)
        waiting: list[np.ndarray] = []

        def settle():
            nonlocal pairs, waiting
            pairs = np.unique(np.concatenate([pairs, *waiting]), axis=0)
            waiting = []

        for m in range(2, RUN + 1):
            starts = at[size == m]
            i, j = np.triu_indices(m, 1)
            step = max(1, (1 << 17) // len(i))
            for k in range(0, len(starts), step):
                x = e[(starts[k : k + step, None] + i).ravel()]
                y = e[(starts[k : k + step, None] + j).ravel()]
                small, large = np.minimum(x["n"], y["n"]).astype(np.int64), np.maximum(x["n"], y["n"]).astype(np.int64)
                reach = 1 + np.minimum(x["n"] - 1 - x["p"], y["n"] - 1 - y["p"])
                ok = (4 * small >= 3 * large) & (7 * reach.astype(np.int64) >= 3 * (small + large)) & (x["id"] != y["id"])
                waiting.append(np.stack([np.minimum(x["id"], y["id"])[ok], np.maximum(x["id"], y["id"])[ok]], 1))
            settle() if waiting else None
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(len(pairs), pa.int64()), pa.array(pairs[:, 0]), pa.array(pairs[:, 1]), pa.nulls(len(pairs), pa.int64())], ["token", "a", "b", "n"]
        )
        for s, m in zip(at[size > RUN], size[size > RUN], strict=True):
            x = e[s : s + m]
            yield pa.RecordBatch.from_arrays(
                [pa.array(x["t"].view(np.int64)), pa.array(x["id"]), pa.nulls(m, pa.int64()), pa.array(x["n"].astype(np.int64))], ["token", "a", "b", "n"]
            )

    return dealt.mapInArrow(run, "token long, a long, b long, n long")


def id_position(id_column: str, bits: int = FILTER_BITS):
    return F.shiftrightunsigned(F.xxhash64(id_column), 64 - bits)


def id_filter(ids: DataFrame, bits: int = FILTER_BITS) -> np.ndarray:
    """Packed array of ``2**bits`` bits in which the bit of every id is on."""

    def run(batches):
        on: dict[int, np.ndarray] = {}
        for batch in batches:
            p = batch.column("p").to_numpy()
            for part in np.unique(p >> 19):
                on.setdefault(int(part), np.zeros(1 << 19, bool))[p[p >> 19 == part] & ((1 << 19) - 1)] = True
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(on), pa.int64()), pa.array([np.packbits(x).tobytes() for x in on.values()], pa.binary())], ["part", "bits"]
        )

    out = np.zeros((1 << (bits - 19), 1 << 16), np.uint8)
    at = ids.select(id_position("id", bits).alias("p"))
    rows = at.repartition(1 << (FILTER_BITS - 19), F.shiftright("p", 19)).mapInArrow(run, "part long, bits binary")
    for part, x in rows.coalesce(8).collect():  # 2**bits bits
        out[part] |= np.frombuffer(x, np.uint8)
    return out.ravel()


def may_be_among(id_column: str, ids: DataFrame):
    """Column: whether an id may be among ``ids``; true for all of them and, by the bit array, for a few others.  Of too many ids all may be."""
    n = ids.count()
    if n > MOST_IDS:
        return F.lit(True)
    size = max(FILTER_BITS, int(4 * n).bit_length())
    bits = ids.sparkSession.sparkContext.broadcast(id_filter(ids, size))

    @F.arrow_udf("boolean")
    def on(p: pa.Array) -> pa.Array:
        x = p.to_numpy()
        return pa.array((bits.value[x >> 3] >> (7 - (x & 7)) & 1).astype(bool))

    return on(id_position(F.col(id_column).cast("long"), size))


def _among(docs: DataFrame, ids: DataFrame, run, schema: str) -> DataFrame:
    """``run`` over slabs (ids, bytes, offsets) of the texts whose id is among ``ids``; the bit array lets a few others through."""
    texts = docs.where("doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    n = ids.count()  # repeated ones count
    size = max(FILTER_BITS, int(4 * n).bit_length())
    if n > MOST_IDS:
        some = texts.join(ids, texts.doc_id == ids.id, "left_semi")
        return some.mapInArrow(lambda batches: run((r.column("doc_id").to_numpy(), b, o) for r, b, o in slabs(batches)), schema)
    bits = docs.sparkSession.sparkContext.broadcast(id_filter(ids, size))

    def chosen(batches):
        for batch in batches:
            p = batch.column("p").to_numpy()
            on = batch.filter(pa.array((bits.value[p >> 3] >> (7 - (p & 7)) & 1).astype(bool)))
            if len(on):
                for rows, b, o in slabs(iter([on])):
                    yield rows.column("doc_id").to_numpy(), b, o

    return texts.withColumn("p", id_position("doc_id", size)).mapInArrow(lambda batches: run(chosen(batches)), schema)


def _members(docs: DataFrame, ids: DataFrame, rank) -> DataFrame:
    """Ordered sets of (at least) the documents with these ids, computed from their texts again."""

    def run(slabs_of):
        for ids, b, o in slabs_of:
            got = list(_sets(b, o, rank.value))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[[i for i, _ in got]] if got else [], pa.int64()), pa.array([t.tobytes() for _, t in got], pa.binary())], ["id", "t"]
            )

    return _among(docs, ids, run, "id long, t binary")


def parities(t: np.ndarray) -> bytes:
    """Bitmap of at least two places a token; a place is on if an odd number of tokens fall on it."""
    m = max(64, 1 << int(2 * len(t) - 1).bit_length())
    return np.packbits(np.bincount((mix(t) & np.uint64(m - 1)).astype(np.int64), minlength=m).astype(np.uint8) & 1, bitorder="little").tobytes()


def may_link(n: int, x: bytes, k: int, y: bytes) -> bool:
    """Sets of n and k tokens with bitmaps x and y differ in as many tokens as places at least; linked ones in (n + k) / 7 at most."""
    if 4 * min(n, k) < 3 * max(n, k):
        return False
    if len(x) < len(y):
        x, y = y, x
    a = int.from_bytes(x, "little")
    bits = 8 * len(x)
    while bits > 8 * len(y):  # upper half upon lower half
        bits >>= 1
        a = a >> bits ^ a & (1 << bits) - 1
    return 7 * (a ^ int.from_bytes(y, "little")).bit_count() <= n + k


def _marks(docs: DataFrame, ids: DataFrame, rank) -> DataFrame:
    """Size and bitmap of (at least) the documents with these ids."""

    def run(slabs_of):
        for ids, b, o in slabs_of:
            got = [(ids[i], len(t), parities(t)) for i, t in _sets(b, o, rank.value)]
            a, n, m = zip(*got, strict=True) if got else ((), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(n, pa.int64()), pa.array(m, pa.binary())], ["id", "n", "m"])

    return _among(docs, ids, run, "id long, n long, m binary").dropDuplicates(["id"])


def _likely(pairs: DataFrame, marks: DataFrame) -> DataFrame:
    """Pairs (a, b, n), n the size of a, whose bitmaps allow a link."""
    x = marks.select(F.col("id").alias("a"), F.col("n").alias("n"), F.col("m").alias("m"))
    y = marks.select(F.col("id").alias("b"), F.col("n").alias("k"), F.col("m").alias("w"))

    def run(batches):
        for batch in batches:
            n, m, k, w = (batch.column(c).to_pylist() for c in "nmkw")
            on = pa.array([may_link(*r) for r in zip(n, m, k, w, strict=True)], pa.bool_())
            yield batch.select(["a", "b", "n"]).filter(on)

    return pairs.select("a", "b").join(x, "a").join(y, "b").select("a", "b", "n", "m", "k", "w").mapInArrow(run, "a long, b long, n long")


class Trie:
    """Path-compressed trie of ordered sets, laid out in arrays and traversed level by level.

    A node is a run of tokens that all sets below it share, so its overlap with a probe is counted
    once for all of them; a node is left, with all below it, when the overlap so far and the lengths
    that remain can't reach the threshold.
    """

    def __init__(self):
        self.sets: list[tuple[bytes, int, np.ndarray]] = []
        self.levels: list[np.ndarray] | None = None

    def add(self, key: int, t: np.ndarray) -> None:
        self.sets.append((t.astype(">u8").tobytes(), key, t))

    def _lay(self) -> None:
        self.sets.sort(key=lambda x: x[:2])
        parent, source, start, end = [-1], [-1], [0], [0]
        ends: list[tuple[int, int, int]] = []  # node, key, size
        stack = [0]
        before = self.sets[0][2][:0]
        for k, (_, key, t) in enumerate(self.sets):
            m = min(len(before), len(t))
            differ = before[:m] != t[:m]
            same = int(differ.argmax()) if differ.any() else m
            last = -1
            while end[stack[-1]] > same:
                last = stack.pop()
            if end[stack[-1]] < same:  # the path so far splits here
                parent.append(stack[-1])
                source.append(source[last])
                start.append(start[last])
                end.append(same)
                parent[last], start[last] = len(parent) - 1, same
                stack.append(len(parent) - 1)
            if len(t) > same:
                parent.append(stack[-1])
                source.append(k)
                start.append(same)
                end.append(len(t))
                stack.append(len(parent) - 1)
            ends.append((stack[-1], key, len(t)))
            before = t
        n = len(parent)
        self.parent, self.depth = np.array(parent), np.array(end)
        flat = [self.sets[source[x]][2][start[x] : end[x]] for x in range(1, n)]
        self.tokens, self.flat = np.unique(np.concatenate(flat) if flat else before, return_inverse=True)
        self.at = np.cumsum([0, *map(len, flat)])[:-1] if flat else np.zeros(0, np.int64)
        self.ends = np.array(ends, np.int64)
        self.short, self.long = np.full(n, 1 << 60), np.zeros(n, np.int64)
        np.minimum.at(self.short, self.ends[:, 0], self.ends[:, 2])
        np.maximum.at(self.long, self.ends[:, 0], self.ends[:, 2])
        order = np.argsort(self.depth, kind="stable").tolist()
        level = [0] * n
        for x in order[1:]:
            level[x] = level[parent[x]] + 1
        for x in order[:0:-1]:
            self.short[parent[x]] = min(self.short[parent[x]], self.short[x])
            self.long[parent[x]] = max(self.long[parent[x]], self.long[x])
        by = np.argsort(level, kind="stable")
        cuts = np.flatnonzero(np.diff(np.array(level)[by])) + 1
        self.levels = np.split(by, cuts)[1:]

    def linked(self, t: np.ndarray) -> list[int]:
        """Keys whose sets have 4 * intersection >= 3 * union with t."""
        if not self.sets:
            return []
        if self.levels is None:
            self._lay()
        n = len(t)
        hit = np.zeros(len(self.tokens) + 1, np.int64)
        at = np.searchsorted(self.tokens, t)
        at[at == len(self.tokens)] = 0
        hit[at[self.tokens[at] == t]] = 1
        over = np.zeros(len(self.parent), np.int64)
        if len(self.at):
            over[1:] = np.add.reduceat(hit[self.flat], self.at)
        alive = np.zeros(len(self.parent), bool)
        alive[0] = True
        for nodes in self.levels:
            nodes = nodes[alive[self.parent[nodes]]]
            if not len(nodes):
                break
            o = over[nodes] + over[self.parent[nodes]]
            over[nodes] = o
            reach = o + np.minimum(n - o, self.long[nodes] - self.depth[nodes])
            alive[nodes] = 7 * reach >= 3 * (n + self.short[nodes])
        node, key, size = self.ends.T
        ok = alive[node] & (7 * over[node] >= 3 * (n + size))
        return key[ok].tolist()


class Parts:
    """Parts of the members 0 to n - 1 that links have joined so far."""

    def __init__(self, n: int):
        self.up, self.count = list(range(n)), n

    def find(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, x: int, y: int) -> None:
        x, y = self.find(x), self.find(y)
        if x != y:
            self.up[max(x, y)] = min(x, y)
            self.count -= 1


def _spread(edges: DataFrame) -> DataFrame:
    """``(node, component)``: the least node up to two edges away, a first guess of the component."""
    both = edges.select(F.col("a").alias("x"), F.col("b").alias("y")).union(edges.select("b", "a"))
    near = both.groupBy(F.col("x").alias("node")).agg(F.least(F.col("node"), F.min("y")).alias("component"))
    far = both.join(near, both.y == near.node).groupBy(F.col("x").alias("node")).agg(F.min("component").alias("far"))
    return near.join(far, "node").select("node", F.least("component", "far").alias("component"))


def _families(pairs: DataFrame, docs: DataFrame, rank) -> tuple[DataFrame, bool]:
    """Links (a, b) that connect what the pairs (a, b, n) connect if their sets link; whether each a is the least of its part.

    A family of up to ``TRIE`` members and ``TOKENS`` tokens is one trie, each set is sent there once.  Pairs of a larger one, and those
    between families, are verified one by one, so that any division into families gives the same parts.
    """
    pairs = cut(pairs)
    release(pairs.sparkSession)  # bitmaps that met
    if pairs.isEmpty():
        return pairs.select("a", "b"), True
    nodes = cut(_spread(pairs))
    ends = pairs.select(F.col("a").alias("node"), "n").union(pairs.select(F.col("b").alias("node"), (F.col("n") * 4 / 3).cast("long").alias("n")))
    size = ends.groupBy("node").agg(F.max("n").alias("n")).join(nodes, "node").groupBy("component").agg(F.count("*").alias("m"), F.sum("n").alias("tokens"))
    fits = (F.col("m") <= TRIE) & (F.col("tokens") <= TOKENS)
    placed = cut(nodes.join(size, "component").select(F.col("node").alias("id"), F.col("component").alias("family"), fits.alias("whole")))
    small = placed.where("whole").select("id", "family")

    def run(batches):
        family, ids, sets = None, [], []

        def settle():
            trie, parts = Trie(), Parts(len(ids))
            for i, t in enumerate(sets):
                trie.add(i, t[::-1])
            for i, t in enumerate(sets):
                if parts.count == 1:
                    break
                for j in trie.linked(t):
                    parts.join(i, j)
            root = [parts.find(i) for i in range(len(ids))]
            on = [i for i, r in enumerate(root) if r != i]
            return pa.RecordBatch.from_arrays([pa.array([ids[root[i]] for i in on], pa.int64()), pa.array([ids[i] for i in on], pa.int64())], ["a", "b"])

        for batch in batches:
            for f, a, t in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if f != family:
                    if ids:
                        yield settle()
                    family, ids, sets = f, [], []
                if not ids or ids[-1] != a:  # rows of one id are one document
                    ids.append(a)
                    sets.append(np.frombuffer(t, np.uint64))
        if ids:
            yield settle()

    sent = _members(docs, small, rank).join(small, "id").select("family", "id", "t").repartition("family").sortWithinPartitions("family", "id", "t")
    edges = cut(sent.mapInArrow(run, "a long, b long"))
    x = placed.select(F.col("id").alias("a"), F.col("family").alias("f"), "whole")
    y = placed.select(F.col("id").alias("b"), F.col("family").alias("g"))
    rest = cut(pairs.join(x, "a").join(y, "b").where("NOT whole OR f <> g").select("a", "b", "n"))
    if rest.isEmpty():
        return edges, True
    salts = rest.groupBy("a").agg((F.floor(F.count("*") * F.max("n") / TOKENS) + 1).alias("salts"))
    rest = cut(rest.join(salts, "a").select("a", "b", F.pmod(F.xxhash64("b"), F.col("salts")).cast("int").alias("salt")))
    sets = _members(docs, rest.select(F.explode(F.array("a", "b")).alias("id")), rank)
    return edges.union(cut(_verify(rest, cut(sets)))), False


def _verify(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs (a, b) whose sets link; the sets of one (a, salt) meet in one trie."""
    own = pairs.select("a", "salt").distinct().select(F.col("a").alias("id"), "a", "salt", F.lit(None).cast("long").alias("b"))
    met = own.union(pairs.select(F.col("b").alias("id"), "a", "salt", "b")).join(sets, "id")

    def found(key, own, trie):
        b = sorted({x for t in own for x in trie.linked(t)})
        return pa.RecordBatch.from_arrays([pa.array([key[0]] * len(b), pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    def run(batches):
        key, own, trie = None, [], Trie()
        for batch in batches:
            for a, salt, b, t in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                if (a, salt) != key:
                    if own:
                        yield found(key, own, trie)
                    key, own, trie = (a, salt), [], Trie()
                if b is None:
                    own.append(np.frombuffer(t, np.uint64))
                else:
                    trie.add(b, np.frombuffer(t, np.uint64)[::-1])
        if own:
            yield found(key, own, trie)

    rows = met.select("a", "salt", "b", "t").repartition("a", "salt").sortWithinPartitions("a", "salt", F.col("b").asc_nulls_first())
    return rows.mapInArrow(run, "a long, b long")


def _stars(members: DataFrame) -> DataFrame:
    """Pairs of a few members of each long run with all its others."""
    hubs = members.groupBy("token").agg(F.array_distinct(F.array(*[F.min_by("a", F.xxhash64("a", F.lit(i))) for i in range(STARS)])).alias("hubs"))
    pairs = members.join(hubs, "token").select(F.explode("hubs").alias("hub"), "a").where("hub <> a")
    return pairs.select(F.col("hub").alias("a"), F.col("a").alias("b")).distinct()


def _between(members: DataFrame, labels: DataFrame, docs_of: DataFrame, rank) -> DataFrame:
    """Links between the parts into which known links leave the long runs, all of them.

    Runs that share members are one family.  Its sets stand in tries of about ``TRIE`` sets, by hash and
    class of size (linked sizes are in equal or neighbouring classes); every set outside the family's
    largest part is sent through all of its tries.  So sets move, pairs are never written.
    """
    hub = members.groupBy("token").agg(F.min("a").alias("hub"))
    near = members.join(hub, "token").select("hub", "a").distinct()
    family = components(near, "hub", "a").select(F.col("node").alias("of"), F.col("component").alias("family"))
    docs = members.groupBy("a").agg(F.first("n").alias("n")).join(family, F.col("a") == F.col("of")).join(labels, F.col("a") == F.col("node"), "left")
    docs = cut(docs.select("a", "n", "family", F.coalesce("component", "a").alias("part"), F.floor(F.log("n") / float(np.log(4 / 3)) + 1e-9).alias("size")))
    parts = docs.groupBy("family", "part").agg(F.count("*").alias("m"))
    main = parts.groupBy("family").agg(F.max_by("part", F.struct("m", "part")).alias("main"), F.count("*").alias("parts")).where("parts > 1")
    tries = docs.groupBy("family", "size").agg((F.floor(F.count("*") / TRIE) + 1).alias("tries"))
    open_docs = cut(docs.join(main.select("family", "main"), "family"))
    if open_docs.isEmpty():
        return open_docs.select("a", F.col("main").alias("b"))
    sets = _members(docs_of, open_docs.select(F.col("a").alias("id")), rank)
    stored = open_docs.join(tries, ["family", "size"]).select("family", "size", F.pmod(F.xxhash64("a"), F.col("tries")).alias("trie"), F.lit(0).alias("kind"), "a", "part")
    apart = open_docs.where("part <> main").withColumn("size", F.explode(F.array(*[F.col("size") + d for d in (-1, 0, 1)])))
    sent = apart.join(tries, ["family", "size"]).withColumn("trie", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tries") - 1)))
    rows = stored.union(sent.select("family", "size", "trie", F.lit(1).alias("kind"), "a", "part")).join(sets, F.col("a") == F.col("id"))

    def run(batches):
        key, trie, part_of = None, Trie(), {}
        for batch in batches:
            a, b = [], []
            for family, size, at, kind, doc, part, t in zip(*(batch.column(i).to_pylist() for i in range(7)), strict=True):
                if (family, size, at) != key:
                    key, trie, part_of = (family, size, at), Trie(), {}
                x = np.frombuffer(t, np.uint64)
                if kind == 0:
                    trie.add(doc, x[::-1])
                    part_of[doc] = part
                else:
                    first: dict[int, int] = {}  # one link to each other part is enough
                    for y in trie.linked(x):
                        if part_of[y] != part:
                            first.setdefault(part_of[y], y)
                    a += [doc] * len(first)
                    b += first.values()
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    keys = ["family", "size", "trie"]
    dealt = rows.select(*keys, "kind", "a", "part", "t").repartition(*keys).sortWithinPartitions(*keys, "kind")
    return dealt.mapInArrow(run, "a long, b long")


def links(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Per row ``(doc_id, n, id)``, id the class representative (null without shingles); linked
    pairs ``(a, b)`` of representatives that together connect every component; ``(node, component)`` of those that have links."""
    spark = docs.sparkSession
    small_batches(spark)
    rank = spark.sparkContext.broadcast(_sketch(docs))
    described = cut(_describe(docs, rank))
    classes = described.where("n > 0 AND doc_id IS NOT NULL").groupBy("s1", "s2", "n").agg(F.min("doc_id").alias("id"))
    classed = cut(described.join(classes, ["s1", "s2", "n"], "left").select("doc_id", "n", "id"))
    total = described.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0] // 4
    representatives = classed.where("doc_id = id").select("id").distinct()
    found = cut(_runs(_deal(docs, representatives, rank, total // ENTRIES + 1)))
    release(spark)  # the dealt entries
    short = found.where("b IS NOT NULL").select("a", "b").distinct()
    members = found.where("b IS NULL").select("token", "a", "n")
    pairs = cut(short.union(_stars(members)).distinct())
    ids = pairs.select(F.explode(F.array("a", "b")).alias("id"))
    marks = cut(_marks(docs, ids, rank))
    edges, stars = _families(_likely(pairs, marks), docs, rank)
    release(spark)

    none = spark.range(0).select(F.col("id").alias("node"), F.col("id").alias("component"))
    own = none if edges.isEmpty() else None
    if own is None and stars:
        own = edges.select(F.col("b").alias("node"), F.col("a").alias("component")).union(edges.select("a", "a").distinct())
    if not members.isEmpty():
        guess = cut(_spread(edges)) if own is None else own  # smaller parts only mean more work
        more = cut(_between(members, guess, docs, rank))
        if not more.isEmpty():
            edges, own = edges.union(more), None
        release(spark)
    labels = components(edges) if own is None else own
    return classed, edges, labels


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_shingles, component_id)`` of every row; see the module for the rules."""
    classed, _, labels = links(docs)
    out = classed.join(labels, classed.id == labels.node, "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "id", "doc_id").alias("component_id"))


def op1_ngram_jaccard_join(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
