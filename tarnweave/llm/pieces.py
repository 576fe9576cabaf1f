"""SentencePiece encoding and decoding with a scan of boundary states.

A BPE segmentation is the only sequence of pieces in which each piece and each pair of neighbours
encodes to itself.  So encoding is a best path whose steps weigh 0 (neighbours agree) or minus infinity, with exactly
one finite path.  Where no piece can cross (white-space marks, line ends) the state space has one element: such
walls split a text into segments, and the distinct segments of a batch are merged together, one merge of each at a
time, over arrays.  Distinct segments are kept in a table of bounded size.  A giant text is
cut at fixed lengths: each chunk yields, on its own, the max-plus matrix from the states at its
left boundary to those at its right one (a state is the last piece that ends at or before the
boundary).  Matrices are multiplied as a tree, ``FAN`` neighbours at once; states go down the same tree, and with its
two states known each chunk is traced back on its own.  No task holds more than ``FAN`` matrices.

The ids are those of the model's own BPE.  Null texts give null ids, empty texts none, an empty table no rows.  Repeated
rows are encoded alike; other columns are kept, but one named ``ids`` (or ``decoded``, in ``decode``) is replaced.
"""

from __future__ import annotations

import pickle
import re
from functools import cache
from heapq import heapify, heappop, heappush
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnweave.plans.durable import cut, small_batches

MARK = "▁"
CHUNK = 32_768
FAN = 64
MOST_SEGMENTS = 150_000
#: Longer segments are merged one by one with a heap.
SHORT = 64
_CODE = 21


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class Pieces:
    """Vocabulary of a BPE model and the algebra of its boundary states."""

    def __init__(self, model: bytes):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.score: dict[str, float] = {}
        self.id: dict[str, int] = {}
        self.raw: list[bytes] = []
        self.byte = [0] * 256
        self.unknown = sp.unk_id()
        for i in range(sp.get_piece_size()):
            p = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.byte[int(p[3:5], 16)] = i
                self.raw.append(bytes([int(p[3:5], 16)]))
            elif sp.is_control(i):
                self.raw.append(b"")
            elif sp.is_unknown(i):
                self.raw.append(" ⁇ ".encode())
            else:
                self.score[p], self.id[p] = sp.get_score(i), i
                self.raw.append(p.replace(MARK, " ").encode())
        self.raw_size = np.fromiter(map(len, self.raw), np.int64, len(self.raw))
        self.raw_at = np.cumsum(self.raw_size) - self.raw_size
        self.raw_bytes = np.frombuffer(b"".join(self.raw), np.uint8)
        self.fallback = any(self.byte)
        self.longest = max(map(len, self.score))
        self.prefix = bool(sp.encode("a", out_type=str)[0].startswith(MARK))
        self.cuts_at_mark = not any(re.search(f"[^{MARK}]{MARK}", p) for p in self.score)
        long = {c for p in self.score if len(p) > 1 for c in p}
        self.alone = "\n" if "\n" not in long else ""
        self.split = re.compile(f"{self.alone or '(?!)'}|{MARK}+[^{MARK}{self.alone}]*|[^{MARK}{self.alone}]+").findall
        self.pairs: dict[tuple[str, str], bool] = {}
        self.known: dict[str, tuple[int, ...]] = {}
        self.valid: dict[str, bool] = {}
        # codes: the id of a piece, or the number of pieces and the code point of a character that is none
        self.size = sp.get_piece_size()
        self.code = np.arange(0x110000, dtype=np.int32) + self.size
        for p, i in self.id.items():
            if len(p) == 1:
                self.code[ord(p)] = i
        halves = [(self._code(p[:i]) << _CODE | self._code(p[i:]), x) for p, x in self.id.items() for i in range(1, len(p)) if self._is(p[:i]) and self._is(p[i:])]
        halves.sort()
        self.pair_key = np.array([k for k, _ in halves] + [1 << 62], np.int64)
        self.pair_id = np.array([x for _, x in halves] + [0], np.int64)
        by_id = np.full(self.size, -np.inf)
        for p, i in self.id.items():
            by_id[i] = self.score[p]
        self.pair_score = np.append(by_id[self.pair_id[:-1]], -np.inf)  # the last stands for no pair

    def _is(self, p: str) -> bool:
        return len(p) == 1 or p in self.id

    def _code(self, p: str) -> int:
        return self.id.get(p) if p in self.id else self.size + ord(p)

    def _pair(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Index of the piece that two codes make, -1 if they make none."""
        key = left << _CODE | right
        i = np.searchsorted(self.pair_key, key)
        return np.where(self.pair_key[i] == key, i, -1)

    def merge_all(self, segments: list[str]) -> list[tuple[int, ...]]:
        """Ids of many short segments: each round merges the best pair of every segment, leftmost first."""
        lengths = np.fromiter(map(len, segments), np.int64, len(segments))
        symbol = self.code[np.frombuffer("".join(segments).encode("utf-32-le"), np.uint32)].astype(np.int64)
        owner = np.repeat(np.arange(len(segments)), lengths)
        pair = np.full(len(symbol), -1, np.int64)
        inner = np.flatnonzero(owner[1:] == owner[:-1])
        pair[inner] = self._pair(symbol[inner], symbol[inner + 1])
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(symbol):
            start = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
            score = self.pair_score[pair]
            best = np.maximum.reduceat(score, start)
            width = np.diff(np.append(start, len(symbol)))
            top = np.repeat(best, width)
            open_ = top > -np.inf
            if not open_.all():
                done.append((owner[~open_], symbol[~open_]))
                owner, symbol, pair, score, top = owner[open_], symbol[open_], pair[open_], score[open_], top[open_]
                if not len(symbol):
                    break
            at = np.flatnonzero(score == top)
            at = at[np.concatenate([[True], owner[at[1:]] != owner[at[:-1]]])]
            symbol[at] = self.pair_id[pair[at]]
            keep = np.ones(len(symbol), bool)
            keep[at + 1] = False
            owner, symbol, pair = owner[keep], symbol[keep], pair[keep]
            at -= np.arange(len(at))  # one symbol of every segment before is gone
            pair[at] = -1
            for left in (at, at - 1):
                left = left[(left >= 0) & (left + 1 < len(symbol))]
                left = left[owner[left] == owner[left + 1]]
                pair[left] = self._pair(symbol[left], symbol[left + 1])
        owner = np.concatenate([o for o, _ in done]) if done else owner
        symbol = np.concatenate([x for _, x in done]) if done else symbol
        symbol = symbol[np.argsort(owner, kind="stable")]
        ends = np.cumsum(np.bincount(owner, minlength=len(segments))).tolist()
        flat, out, i = symbol.tolist(), [], 0
        plain = symbol.max(initial=0) < self.size
        for j in ends:
            x = flat[i:j]
            out.append(tuple(x) if plain or max(x, default=0) < self.size else tuple(self.spelled(x)))
            i = j
        return out

    def spelled(self, codes: list[int]) -> list[int]:
        """Ids of codes: characters that are no piece by their bytes."""
        out: list[int] = []
        for x in codes:
            if x < self.size:
                out.append(x)
            else:
                out += [self.byte[c] for c in chr(x - self.size).encode()] if self.fallback else [self.unknown]
        return out

    def merge_long(self, segment: str) -> tuple[int, ...]:
        """Ids of one segment of any length, by a heap of pairs."""
        x: list[str | None] = list(segment)
        after, before = list(range(1, len(x) + 1)), list(range(-1, len(x) - 1))
        score = self.score
        heap = [(-score[p], i, p) for i in range(len(x) - 1) if (p := x[i] + x[i + 1]) in score]
        heapify(heap)
        while heap:
            _, i, p = heappop(heap)
            j = after[i] if x[i] is not None else len(x)
            if j == len(x) or x[i] + x[j] != p:
                continue
            x[i], x[j], k = p, None, after[j]
            after[i] = k
            if k < len(x):
                before[k] = i
                if (q := p + x[k]) in score:
                    heappush(heap, (-score[q], i, q))
            h = before[i]
            if h >= 0 and (q := x[h] + p) in score:
                heappush(heap, (-score[q], h, q))
        return self.ids([p for p in x if p is not None])

    def learn(self, segments: set[str]) -> None:
        """Puts all of the segments into the table."""
        new = segments - self.known.keys()
        if len(self.known) + len(new) > MOST_SEGMENTS:
            self.known.clear()
            new = segments
        short = [w for w in new if len(w) <= SHORT]
        for i in range(0, len(short), 1 << 14):
            part = short[i : i + (1 << 14)]
            self.known.update(zip(part, self.merge_all(part), strict=True))
        for w in new:
            if len(w) > SHORT:
                self.known[w] = self.merge_long(w)

    def segments(self, escaped: str) -> list[str]:
        return self.split(escaped) if self.cuts_at_mark else [escaped] if escaped else []

    def encode_all(self, escaped: list[str]) -> list[list[tuple[int, ...]]]:
        """Ids of the segments of each text."""
        segments = [self.segments(t) for t in escaped]
        self.learn(set(chain.from_iterable(segments)))
        out = [list(map(self.known.__getitem__, s)) for s in segments]
        for w in [w for w in self.known if len(w) > 4096]:  # long ones hardly come again
            del self.known[w]
        return out

    def merged(self, text: str) -> list[str]:
        """The model's own merges of a short text: best score first, then leftmost."""
        x = list(text)
        while len(x) > 1:
            best, at = None, -1
            for i in range(len(x) - 1):
                s = self.score.get(x[i] + x[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if best is None:
                break
            x[at : at + 2] = [x[at] + x[at + 1]]
        return x

    def agree(self, a: str, b: str) -> bool:
        """Weight of a step from piece a to piece b: 0 (true) or minus infinity."""
        if not a:
            ok = self.valid.get(b)
            if ok is None:
                ok = self.valid[b] = len(b) == 1 or self.merged(b) == [b]
            return ok
        ok = self.pairs.get((a, b))
        if ok is None:
            if len(self.pairs) > 300_000:
                self.pairs.clear()
            ok = self.pairs[a, b] = self.agree("", b) and self.merged(a + b) == [a, b]
        return ok

    def is_cut(self, left: str, right: str) -> bool:
        """No piece holds these two neighbours."""
        if self.alone and (left == self.alone or right == self.alone):
            return True
        return self.cuts_at_mark and right == MARK and left != MARK

    def walk(self, text: str, last: dict[int, str], first: int, lo: int, hi: int) -> dict[int, str]:
        """The piece that ends at each position in (lo, hi], given those in ``last`` up to lo."""
        vocabulary, longest, agree = self.score, self.longest, self.agree
        for j in range(lo + 1, hi + 1):
            for i in range(max(first, j - longest), j):
                a = last.get(i)
                if a is not None:
                    t = text[i:j]
                    if (j - i == 1 or t in vocabulary) and (agree(a, t) if a or i == first else True):
                        last[j] = t
                        break
        return last

    def ids(self, tokens: list[str]) -> tuple[int, ...]:
        out: list[int] = []
        for t in tokens:
            i = self.id.get(t)
            if i is not None:
                out.append(i)
            elif self.fallback:
                out += [self.byte[c] for c in t.encode()]
            else:
                out.append(self.unknown)
        return tuple(out)

    def escape(self, text: str) -> str:
        return (MARK if self.prefix and text else "") + text.replace(" ", MARK)

    def encode(self, escaped: str) -> list[tuple[int, ...]]:
        return self.encode_all([escaped])[0]

    def decode(self, ids) -> str:
        text = b"".join(map(self.raw.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if self.prefix and text.startswith(" ") else text

    # chunks: ``text`` has up to 2 * longest characters before position ``lo`` and ends at the boundary

    def states(self, text: str, at: int) -> list[tuple[int, str]]:
        """All states a path may have at a boundary: distance of the last end, and the last piece."""
        if at == 0:
            return [(0, "")]
        out = []
        for e in range(min(self.longest, at + 1)):
            end = at - e
            if end == 0:
                out.append((e, ""))
            out += [(e, text[i:end]) for i in range(max(0, end - self.longest), end) if end - i == 1 or text[i:end] in self.score]
        return out

    def walls(self, text: str, lo: int, hi: int):
        """First and last two places between lo and hi that no piece crosses, as far as there are any."""
        first = next((i for i in range(lo + 1, hi) if self.is_cut(text[i - 1], text[i])), None)
        if first is None:
            return None, None, None
        last = next(i for i in range(hi - 1, first - 1, -1) if self.is_cut(text[i - 1], text[i]))
        return first, next((i for i in range(last - 1, first - 1, -1) if self.is_cut(text[i - 1], text[i])), None), last

    def transfer(self, text: str, lo: int) -> dict[tuple[int, str], list[tuple[int, str]]]:
        """Finite entries of a chunk's matrix: for each left state the right states it reaches.

        Between the first and the last wall there is one path, so only what lies outside is walked.
        """
        hi = len(text)
        wall, before, final = self.walls(text, lo, hi)
        seen: dict[tuple, list[tuple[int, str]]] = {}

        def right(last: dict[int, str], least: int) -> list[tuple[int, str]]:
            return [(hi - j, last[j]) for j in range(hi, max(least, hi - self.longest), -1) if j in last]

        def go(last: dict[int, str], first: int, at: int) -> list[tuple[int, str]]:
            """On from position ``at``, where paths of one window are walked once."""
            passed = []
            while True:
                window = (at, *(last.get(i) for i in range(max(first, at - self.longest + 1), at + 1)))
                if window in seen:
                    found = seen[window]
                    break
                passed.append(window)
                if at >= hi:
                    found = right(last, lo)
                    break
                self.walk(text, last, first, at, min(hi, at + 64))
                at = min(hi, at + 64)
            for w in passed:
                seen[w] = found
            return found

        beyond = None if wall is None else right(self.walk(text, {final: ""}, final, final, hi), final)
        if before is not None and hi - self.longest < final:
            beyond = [*beyond, (hi - final, self.walk(text, {before: ""}, before, before, final)[final])]
        out = {}
        for e, t in self.states(text, lo):
            first = lo - e
            if first < 0:
                continue
            last = {first: t}
            if wall is None:
                found = go(last, first, lo)
            else:
                self.walk(text, last, first, lo, wall)
                if wall not in last:
                    continue
                found = beyond
                if before is None and hi - self.longest < wall:
                    found = [*beyond, (hi - wall, last[wall])]
            if found:
                out[e, t] = found
        return out

    def trace(self, text: str, lo: int, enter: tuple[int, str], leave: tuple[int, str]) -> tuple[int, ...]:
        """Ids of the pieces that end in the chunk on the path between two states."""
        first, j = lo - enter[0], len(text) - leave[0]
        if j <= lo:
            return ()

        def back(start: int, piece: str, at: int, to: int) -> list[str]:
            last, out, k = self.walk(text, {start: piece}, start, at, to), [], to
            while k > start:
                out.append(last[k])
                k -= len(last[k])
            return out[::-1]

        wall, _, final = self.walls(text, lo, j)
        if wall is None:
            return self.ids(back(first, enter[1], lo, j))
        middle = chain.from_iterable(self.encode(text[wall:final]))
        return (*self.ids(back(first, enter[1], lo, wall)), *middle, *self.ids(back(final, "", final, j)))


def combine(a: dict, b: dict) -> dict:
    """Max-plus product of two matrices of 0 and minus infinity."""
    rows: dict[int, list] = {}  # a's rows that are one object stay one
    out = {}
    for s, mid in a.items():
        if id(mid) not in rows:
            rows[id(mid)] = list(dict.fromkeys(x for m in mid for x in b.get(m, ())))
        if rows[id(mid)]:
            out[s] = rows[id(mid)]
    return out


def _path(mats: list[dict], enter: tuple[int, str] = (0, ""), leave: tuple[int, str] | None = None) -> list[tuple[int, str]]:
    """States at all boundaries of the one finite path between two states."""
    ahead = [[enter]]
    for m in mats:
        ahead.append(list(dict.fromkeys(x for s in ahead[-1] for x in m.get(s, ()))))
    out = [leave or next(s for s in ahead[-1] if s[0] == 0)]
    for m, before in zip(reversed(mats), reversed(ahead[:-1]), strict=True):
        out.append(next(s for s in before if out[-1] in m.get(s, ())))
    return out[::-1]


@cache
def _loaded(model: bytes) -> Pieces:
    return Pieces(model)


def _lists(rows: list, ok: list[bool]) -> pa.Array:
    """List column of int32 from iterables of tuples."""
    sizes = np.zeros(len(rows) + 1, np.int32)
    values = []
    for k, x in enumerate(rows):
        v = np.fromiter(chain.from_iterable(x), np.int32)
        sizes[k + 1] = len(v)
        values.append(v)
    flat = np.concatenate(values) if values else np.zeros(0, np.int32)
    mask = None if all(ok) else pa.array([not y for y in ok])
    return pa.ListArray.from_arrays(pa.array(np.cumsum(sizes, dtype=np.int32)), pa.array(flat), mask=mask)


def _texts(p: Pieces, ids: pa.Array) -> pa.Array:
    """Texts of lists of ids: the pieces' bytes laid end to end, the space before each text left out."""
    at = ids.offsets.to_numpy().astype(np.int64)
    flat = ids.flatten().to_numpy()
    if len(ids) and not ids.null_count and at[-1] - at[0] == len(flat):
        at = at - at[0]
        begin, size = p.raw_at[flat], p.raw_size[flat]
        first = at[:-1][np.diff(at) > 0]
        if p.prefix:
            spaced = first[(size[first] > 0) & (p.raw_bytes[np.minimum(begin[first], len(p.raw_bytes) - 1)] == 32)]
            begin[spaced] += 1
            size[spaced] -= 1
        ends = np.concatenate([[0], np.cumsum(size)])
        data = p.raw_bytes[np.repeat(begin - ends[:-1], size) + np.arange(ends[-1])]
        rows = ends[at]
        starts = rows[:-1][rows[:-1] < len(data)]
        try:
            data.tobytes().decode()
            whole = not ((data[starts] & 0xC0) == 0x80).any()  # no character goes on in the next text
        except UnicodeDecodeError:
            whole = False
        if whole:
            return pa.StringArray.from_buffers(len(ids), pa.py_buffer(rows.astype(np.int32)), pa.py_buffer(data))
    return pa.array([p.decode(x.values.to_pylist()) if x.is_valid else None for x in ids], pa.string())


def _schema(df: DataFrame, more: str) -> str:
    return ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema), more])


def _rows(batches, most: int = 1 << 21):
    for batch in batches:
        n = np.cumsum(pa.compute.fill_null(pa.compute.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False))
        i = 0
        while i < len(batch):
            j = max(i + 1, int(np.searchsorted(n, (n[i - 1] if i else 0) + most)))
            yield batch.slice(i, j - i)
            i = j


def encode(docs: DataFrame, model_path: str | None = None, chunk: int = CHUNK, decoded: bool = False) -> DataFrame:
    """``docs`` with ``ids``, the piece ids of ``text``, and on demand ``decoded``, the text of these.

    Asked for here, ``decoded`` takes no worker of its own beside the encoder's.
    """
    docs = docs.drop("ids", "decoded") if decoded else docs.drop("ids")
    small_batches(docs.sparkSession)
    with open(model_path or default_model(), "rb") as f:
        model = docs.sparkSession.sparkContext.broadcast(f.read())
    size = F.coalesce(F.length("text"), F.lit(0))

    def small(batches):
        p = _loaded(model.value)
        for batch in _rows(batches):
            texts = batch.column("text").to_pylist()
            ids = _lists(p.encode_all([p.escape(t) if t else "" for t in texts]), [t is not None for t in texts])
            more = {"ids": ids, "decoded": _texts(p, ids)} if decoded else {"ids": ids}
            yield pa.RecordBatch.from_arrays([*batch.columns, *more.values()], [*batch.schema.names, *more])

    done = docs.where(size <= chunk).mapInArrow(small, _schema(docs, "ids array<int>, decoded string" if decoded else "ids array<int>"))
    giant = cut(docs.where(size > chunk).withColumn("_uid", F.monotonically_increasing_id()))
    if giant.isEmpty():
        return done
    p = _loaded(model.value)
    if chunk < p.longest:
        raise ValueError("a chunk must be as long as the longest piece")
    back = 2 * p.longest
    lead = int(p.prefix)
    whole = giant.select("_uid", F.concat(F.lit(MARK * lead), F.replace("text", F.lit(" "), F.lit(MARK))).alias("t"))
    k = F.explode(F.sequence(F.lit(0), F.floor((F.length("t") - 1) / chunk).cast("int"))).alias("k")
    pieces = whole.select("_uid", k, "t").select(
        "_uid",
        "k",
        F.least(F.col("k") * chunk, F.lit(back)).alias("lo"),
        F.substring("t", F.greatest(F.col("k") * chunk - back, F.lit(0)) + 1, F.least(F.col("k") * chunk, F.lit(back)) + chunk).alias("text"),
    )
    pieces = cut(pieces.repartition("_uid", "k"))

    known = _boundaries(pieces, model)

    def traced(batches):
        p = _loaded(model.value)
        for batch in batches:
            got = [p.trace(r["text"], r["lo"], (r["e0"], r["t0"]), (r["e1"], r["t1"])) for r in batch.to_pylist()]
            ids = _lists([(x,) for x in got], [True] * len(got))
            yield pa.RecordBatch.from_arrays([batch.column("_uid"), batch.column("k"), ids], ["_uid", "k", "ids"])

    parts = pieces.join(known, ["_uid", "k"]).mapInArrow(traced, "_uid long, k int, ids array<int>")
    joined = parts.groupBy("_uid").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("k", "ids"))), lambda x: x["ids"])).alias("ids"))
    long = giant.join(joined, "_uid").drop("_uid")
    return done.unionByName(decode(long, model_path) if decoded else long)


def _boundaries(pieces: DataFrame, model) -> DataFrame:
    """``(_uid, k, e0, t0, e1, t1)``: the two states of each chunk, by a tree of products and back down."""
    matrix = "_uid long, k int, m binary"
    states = "_uid long, k int, e0 int, t0 string, e1 int, t1 string"

    def leaves(batches):
        p = _loaded(model.value)
        for batch in batches:
            m = [pickle.dumps(p.transfer(t, lo)) for t, lo in zip(batch.column("text").to_pylist(), batch.column("lo").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("_uid"), batch.column("k"), pa.array(m, pa.binary())], ["_uid", "k", "m"])

    def products(batches):
        for batch in batches:
            out = []
            for ms in batch.column("ms").to_pylist():
                whole = pickle.loads(ms[0]["m"])
                for x in ms[1:]:
                    whole = combine(whole, pickle.loads(x["m"]))
                out.append(pickle.dumps(whole))
            yield pa.RecordBatch.from_arrays([batch.column("_uid"), batch.column("k"), pa.array(out, pa.binary())], ["_uid", "k", "m"])

    def rows(found):
        kinds = (pa.int64(), pa.int32(), pa.int32(), pa.string(), pa.int32(), pa.string())
        columns = list(zip(*found, strict=True)) or [()] * 6
        return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)], ["_uid", "k", "e0", "t0", "e1", "t1"])

    def roots(batches):
        for batch in batches:
            ends = [_path([pickle.loads(m)]) for m in batch.column("m").to_pylist()]
            yield rows([(u, k, *a, *b) for u, k, (a, b) in zip(batch.column("_uid").to_pylist(), batch.column("k").to_pylist(), ends, strict=True)])

    def down(batches):
        for batch in batches:
            found = []
            for r in batch.to_pylist():
                s = _path([pickle.loads(x["m"]) for x in r["ms"]], (r["e0"], r["t0"]), (r["e1"], r["t1"]))
                found += [(r["_uid"], x["k"], *a, *b) for x, a, b in zip(r["ms"], s[:-1], s[1:], strict=True)]
            yield rows(found)

    def groups(level: DataFrame) -> DataFrame:
        """At most FAN neighbours of one text."""
        return level.groupBy("_uid", F.floor(F.col("k") / FAN).cast("int").alias("k")).agg(F.array_sort(F.collect_list(F.struct(F.col("k"), "m"))).alias("ms"))

    top = cut(pieces.mapInArrow(leaves, matrix))
    most = top.agg(F.max("k")).first()[0]
    levels = []
    while most:
        levels.append(top)
        top = cut(groups(top).mapInArrow(products, matrix))
        most //= FAN
    known = top.mapInArrow(roots, states)
    for level in reversed(levels):
        known = cut(groups(level).join(known, ["_uid", "k"]).mapInArrow(down, states))
    return known


def decode(encoded: DataFrame, model_path: str | None = None) -> DataFrame:
    """``encoded`` with ``decoded``, the text of ``ids``."""
    encoded = encoded.drop("decoded")
    with open(model_path or default_model(), "rb") as f:
        model = encoded.sparkSession.sparkContext.broadcast(f.read())

    def run(batches):
        p = _loaded(model.value)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, _texts(p, batch.column("ids"))], [*batch.schema.names, "decoded"])

    return encoded.mapInArrow(run, _schema(encoded, "decoded string"))


def digest(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_tokens, ids_sha256, round_trip)``; the hash is over the ids joined by commas."""
    both = encode(docs.select("doc_id", "text"), decoded=True)
    return both.select(
        "doc_id",
        F.coalesce(F.size("ids"), F.lit(0)).cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"),
        F.col("decoded").eqNullSafe(F.replace("text", F.lit(MARK), F.lit(" "))).alias("round_trip"),
    )


def op2_sentencepiece(spark, sf_dir: str) -> DataFrame:
    return digest(spark.read.parquet(f"{sf_dir}/documents.parquet"))
