"""Language-model scoring: exact unigram counts and a causal self-attention model in numpy.

Words (runs of anything but ASCII white space, A-Z lower-cased) and one end per text are the tokens of the base
score.  Texts are handled in blocks of about ``BLOCK`` words: a block has a sorted dictionary of
its words' hashes, so only distinct words travel to be counted, and their counts travel back in the same
order; nothing depends on how often a word is used.

The model reads subword ids (byte-level BPE of each word, then an end id).  An id has the
probability of its class given the attention context times its share of the class; classes
and shares come from the subword counts of all training texts, and the attention layer is trained on all their
windows: every task goes through those of its own texts by steps of Adam, and the tasks' models are averaged after each
of ``ROUNDS``, an embedding by how often a task read it.  Each window holds ``2 * STRIDE`` ids, overlaps its
predecessor by half and scores its second half, so each id is scored once; windows go in batches
under a causal mask.

A word's probability is the mean of two: that of its subwords by the attention model and that of the base
score (``WORD_SHARE``).  The score of a text is the log10 probability of its words and its end.

Null and empty texts are one end token, null row ids stay null.  Rows are scored independently, repeated rows alike; other
columns are ignored.  Without training texts all counts are 0 and the classes are those of equal counts.  An empty table gives no rows.
"""

from __future__ import annotations

import os
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnweave.plans.durable import cut, release, small_batches

from .langid import held_out
from .tokens import give_back, slabs, words

give_back(8 << 20, 32 << 20)  # a batch's arrays of up to some MB come and go all the time

BLOCK = 1 << 20
STRIDE, DIM, CLASSES = 16, 16, 64
END = 50_256
IDS = END + 1
ROUNDS = (1 / 16, 3 / 16, 3 / 4)  # shares of the texts between two averages
LEAST = 300  # steps; a corpus of fewer is gone through several times
BATCH = 128
SLICES = 16
WIDTH = 1 << 22
WORD_SHARE = 0.95
_TRAIN, _NULL = 1, 2


def default_ranks() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


@cache
def _tokenizer(data: bytes):
    import base64

    import public_tokenizers
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, data.splitlines())}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def subwords(data: bytes, texts: list[str]) -> list[list[int]]:
    enc = _tokenizer(data)
    return [enc.encode_ordinary(" " + t) for t in texts]


class Attention:
    """One causal self-attention layer over id embeddings that predicts the class of the next id."""

    def __init__(self, seed: int = 0):
        r = np.random.default_rng(seed)
        d = DIM
        self.p = {
            "E": r.normal(0, 0.1, (IDS, d)),
            "P": r.normal(0, 0.1, (2 * STRIDE, d)),
            "Q": r.normal(0, 0.3, (d, d)),
            "K": r.normal(0, 0.3, (d, d)),
            "V": r.normal(0, 0.3, (d, d)),
            "U": r.normal(0, 0.3, (d, CLASSES)),
            "b": np.zeros(CLASSES),
        }
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}
        s, t = np.arange(STRIDE)[:, None] + STRIDE, np.arange(2 * STRIDE)[None]
        self.mask = np.where(t <= s, np.float32(0), np.float32(-1e9))

    def _read(self, x: np.ndarray, live: np.ndarray):
        """Unscaled log class probabilities, with what they came from."""
        p = self.p
        h = p["E"].take(x, 0)
        h += p["P"]
        q, k, v = _times(h[:, STRIDE:], p["Q"]), _times(h, p["K"]), _times(h, p["V"])
        a = q @ k.transpose(0, 2, 1)
        a *= np.float32(DIM**-0.5)
        a += self.mask
        a += np.where(live, np.float32(0), np.float32(-1e9))[:, None]
        a -= a.max(2, keepdims=True)
        np.exp(a, out=a)
        a *= 1 / _sums_of(a)
        y = a @ v
        y += h[:, STRIDE:]
        z = _times(y, p["U"])
        z += p["b"]
        z -= z.max(2, keepdims=True)
        return z, (h, q, k, v, a, y)

    def forward(self, x: np.ndarray, live: np.ndarray):
        """Log class probabilities of the second half of windows (n, 2 * STRIDE) of ids."""
        z, rest = self._read(x, live)
        share = np.exp(z)
        total = _sums_of(share)
        z -= np.log(total)
        share *= 1 / total
        return z, (*rest, share)

    def logs_of(self, x: np.ndarray, live: np.ndarray, target: np.ndarray) -> np.ndarray:
        """Log probabilities of the target classes only."""
        z, _ = self._read(x, live)
        own = z.reshape(-1)[np.arange(target.size) * CLASSES + target.ravel()].reshape(target.shape)
        return own - np.log(_sums_of(np.exp(z, out=z))[..., 0])

    def partials(self, x, live, target, weight):
        """Mean loss of the targets, the gradients but that of the embeddings, and the ids read with theirs."""
        p = self.p
        z, (h, q, k, v, a, y, dz) = self.forward(x, live)
        n = max(float(weight.sum()), 1.0)
        at = np.arange(target.size) * CLASSES + target.ravel()
        loss = -(z.ravel()[at] * weight.ravel()).sum() / n
        dz.reshape(-1)[at] -= 1
        dz *= (weight / n)[..., None]
        g = {"U": _outer(y, dz), "b": np.ones(target.size, dz.dtype) @ dz.reshape(-1, CLASSES)}
        dy = _times(dz, p["U"].T)
        ds = dy @ v.transpose(0, 2, 1)
        dv = a.transpose(0, 2, 1) @ dy
        ds *= a
        ds -= a * _sums_of(ds)
        ds *= np.float32(DIM**-0.5)
        dq, dk = ds @ k, ds.transpose(0, 2, 1) @ q
        dh = _times(dk, p["K"].T) + _times(dv, p["V"].T)
        dh[:, STRIDE:] += dy + _times(dq, p["Q"].T)
        g["Q"] = _outer(h[:, STRIDE:], dq)
        g["K"], g["V"] = _outer(h, dk), _outer(h, dv)
        g["P"] = dh.sum(0)
        order = np.argsort(x.astype(np.uint16), axis=None, kind="stable")
        ids = x.ravel()[order]
        first = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]]))
        return loss, g, ids[first], np.add.reduceat(dh.reshape(-1, DIM).take(order, 0), first, axis=0)

    def gradient(self, x, live, target, weight):
        """Mean loss of the targets and the gradient of every parameter."""
        loss, g, ids, rows = self.partials(x, live, target, weight)
        g["E"] = np.zeros_like(self.p["E"])
        g["E"][ids] = rows
        return loss, g


class Adam:
    """Steps over windows; of the embeddings only the rows that a step reads are moved."""

    def __init__(self, net: Attention, rate: float = 0.01):
        self.net, self.rate, self.t = net, rate, 0
        self.m = {k: np.zeros_like(v) for k, v in net.p.items()}
        self.s = {k: np.zeros_like(v) for k, v in net.p.items()}
        self.random = np.random.default_rng(0)

    def learn(self, x, live, target, weight) -> None:
        """One pass over the windows in a mixed order."""
        order = self.random.permutation(len(x))
        for i in range(0, len(x), BATCH):
            pick = order[i : i + BATCH]
            _, g, ids, rows = self.net.partials(x[pick], live[pick], target[pick], weight[pick])
            self.t += 1
            self.move("E", ids, rows)
            for k in g:
                self.move(k, slice(None), g[k])

    def move(self, k: str, at, g: np.ndarray) -> None:
        some = (lambda x: x.take(at, 0)) if isinstance(at, np.ndarray) else (lambda x: x[at])
        m, s = 0.9 * some(self.m[k]) + 0.1 * g, 0.99 * some(self.s[k]) + 0.01 * g * g
        self.m[k][at], self.s[k][at] = m, s
        self.net.p[k][at] -= self.rate / (1 - 0.9**self.t) * m / (np.sqrt(s / (1 - 0.99**self.t)) + 1e-8)


def _times(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    """x @ w as one product of matrices."""
    return (x.reshape(-1, x.shape[-1]) @ w).reshape(*x.shape[:-1], w.shape[1])


def _sums_of(x: np.ndarray) -> np.ndarray:
    """Sums over the last axis, which is kept."""
    return (x.reshape(-1, x.shape[-1]) @ np.ones(x.shape[-1], x.dtype)).reshape(*x.shape[:-1], 1)


def _outer(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return x.reshape(-1, x.shape[-1]).T @ y.reshape(-1, y.shape[-1])


def windows(ids: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Windows over id sequences laid end to end (``at`` has their bounds): inputs, live inputs, targets,
    and where each target stands in ``ids`` (-1 for filling)."""
    n = np.diff(at)
    blocks = -(-n // STRIDE)
    first = np.concatenate([[0], np.cumsum(blocks)])
    total = int(first[-1])
    row = np.repeat(np.arange(len(n)), blocks)
    k = np.arange(total) - first[row]
    place = at[row][:, None] + k[:, None] * STRIDE + np.arange(STRIDE)
    inside = place < at[row + 1][:, None]
    target_at = np.where(inside, place, -1)
    back = at[row][:, None] + (k[:, None] - 1) * STRIDE + np.arange(2 * STRIDE) - 1
    begin = at[row][:, None]
    live = (back >= begin - 1) & (back < at[row + 1][:, None])
    x = np.where(live & (back >= begin), ids[np.clip(back, 0, max(len(ids) - 1, 0))], END)
    return x, live, ids[np.maximum(target_at, 0)], target_at


class Model:
    def __init__(self, counts: np.ndarray):
        c = counts + 1.0
        order = np.argsort(-c, kind="stable")
        mass = np.cumsum(c[order]) - c[order]
        self.of = np.zeros(IDS, np.int64)
        self.of[order] = np.minimum((mass / c.sum() * CLASSES).astype(np.int64), CLASSES - 1)
        self.share = np.log(c / np.bincount(self.of, c, CLASSES)[self.of]).astype(np.float32)
        self.net = Attention()
        self.net.p["b"] = np.log(np.bincount(self.of, c, CLASSES) / c.sum() + 1e-6).astype(np.float32)

    def logs(self, ids: np.ndarray, at: np.ndarray, batch: int = 256) -> np.ndarray:
        """Natural log probability of each id."""
        out = np.empty(len(ids))
        x, live, target, where = windows(ids, at)
        for i in range(0, len(x), batch):
            t, w = target[i : i + batch], where[i : i + batch]
            own = self.net.logs_of(x[i : i + batch], live[i : i + batch], self.of.take(t)) + self.share.take(t)
            inside = w >= 0
            out[w[inside]] = own[inside]
        return out


_ROWS = "kind int, block long, bucket long, x binary, y binary, z binary, w binary"
_NAMES = ["kind", "block", "bucket", "x", "y", "z", "w"]


def _row(kind, block, bucket, *arrays):
    cells = [a.tobytes() if a is not None else None for a in (*arrays, None, None, None, None)[:4]]
    return pa.RecordBatch.from_arrays(
        [pa.array([kind], pa.int32()), pa.array([block], pa.int64()), pa.array([bucket], pa.int64()), *(pa.array([c], pa.binary()) for c in cells)], _NAMES
    )


def _blocks(docs: DataFrame, buckets: int, ranks) -> DataFrame:
    """Kind 1: ids, words per row, word numbers; kind 2: subwords of the dictionary; kind 3: hashes and training
    counts by bucket; kind 4: subword counts of training texts."""

    def emit(held):
        ids = np.concatenate([h[0] for h in held])
        flags = np.concatenate([h[1] for h in held])
        train = (flags & _TRAIN).astype(bool)
        per_row = np.concatenate([h[2] for h in held])
        spelled: dict[int, str] = {}
        u, local = np.unique(np.concatenate([h[3] for h in held]), return_inverse=True)
        for h in held:
            for k, w in h[4]:
                spelled.setdefault(k, w)
        owner = np.repeat(np.arange(len(ids)), per_row)
        c = np.bincount(local[train[owner]], minlength=len(u))
        block = int.from_bytes(os.urandom(7), "little")
        yield _row(1, block, 0, ids, per_row.astype(np.int32), local.astype(np.uint32), flags)
        sub = subwords(ranks.value, [spelled[k] for k in u.tolist()])
        size = np.fromiter(map(len, sub), np.int32, len(sub))
        flat = np.fromiter(chain.from_iterable(sub), np.uint16)
        yield _row(2, block, 0, size, flat)
        n = np.bincount(flat, np.repeat(c, size), IDS).astype(np.int64) if len(flat) else np.zeros(IDS, np.int64)
        n[END] += int(train.sum())
        yield _row(4, block, 0, n)
        which = (u >> np.uint64(40)).astype(np.int64) * buckets >> 24
        cut_at = np.searchsorted(which, np.arange(buckets + 1))
        for b in range(buckets):
            i, j = cut_at[b], cut_at[b + 1]
            if j > i:
                yield _row(3, block, b, u[i:j], c[i:j].astype(np.int64))

    def run(batches):
        held, size = [], 0
        for rows, b, o in slabs(batches):
            s, e, h, first = words(b, o)
            raw = b.tobytes()
            _, one = np.unique(h, return_index=True)
            low = raw.translate(_LOWER)
            spelled = [(k, low[i:j].decode("utf-8", "replace")) for k, i, j in zip(h[one].tolist(), s[one].tolist(), e[one].tolist(), strict=True)]
            row = rows.column("row")
            flags = rows.column("train").to_numpy(zero_copy_only=False).astype(np.uint8) * _TRAIN
            flags |= row.is_null().to_numpy(zero_copy_only=False).astype(np.uint8) * _NULL
            held.append((row.fill_null(0).to_numpy(zero_copy_only=False), flags, np.diff(first), h, spelled))
            size += len(h)
            if size >= BLOCK:
                yield from emit(held)
                held, size = [], 0
        if held:
            yield from emit(held)

    return docs.mapInArrow(run, _ROWS)


_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def _counts(rows: DataFrame, buckets: int) -> DataFrame:
    """Kind 5: the corpus count of each dictionary word of a block; kind 6: words and tokens of a bucket."""

    def run(batches):
        held = [r for batch in batches for r in zip(*(batch.column(k).to_pylist() for k in ("block", "bucket", "x", "y")), strict=True)]
        for bucket in sorted({r[1] for r in held}):
            own = [r for r in held if r[1] == bucket]
            u, inv = np.unique(np.concatenate([np.frombuffer(r[2], np.uint64) for r in own]), return_inverse=True)
            c = np.bincount(inv, np.concatenate([np.frombuffer(r[3], np.int64) for r in own]), len(u)).astype(np.int64)
            yield _row(6, 0, bucket, np.array([(c > 0).sum(), c.sum()], np.int64))
            i = 0
            for r in own:
                n = len(r[2]) // 8
                yield _row(5, r[0], bucket, c[inv[i : i + n]])
                i += n

    return rows.where("kind = 3").repartition(buckets, "bucket").mapInArrow(run, _ROWS)


def _sums(rows: DataFrame, kind: int, length: int) -> np.ndarray:
    """Sum of the arrays of one kind, summed on the executors first."""

    def run(batches):
        total = np.zeros(length, np.int64)
        for batch in batches:
            for x in batch.column("x").to_pylist():
                total += np.frombuffer(x, np.int64)
        yield _row(kind, 0, 0, total)

    own = rows.where(F.col("kind") == kind).select(*_NAMES).mapInArrow(run, _ROWS)
    parts = own.repartition(16).mapInArrow(run, _ROWS).select("x").collect()  # 16 rows
    return sum((np.frombuffer(r.x, np.int64) for r in parts), np.zeros(length, np.int64))


class Block:
    """The rows of kinds 1 and 2 of one block."""

    def __init__(self, own: list[dict]):
        one = next(r for r in own if r["kind"] == 1)
        two = next(r for r in own if r["kind"] == 2)
        self.ids, self.per_row = np.frombuffer(one["x"], np.int64), np.frombuffer(one["y"], np.int32).astype(np.int64)
        self.local, flags = np.frombuffer(one["z"], np.uint32), np.frombuffer(one["w"], np.uint8)
        self.train, self.null = (flags & _TRAIN).astype(bool), (flags & _NULL).astype(bool)
        self.first = np.concatenate([[0], np.cumsum(self.per_row)])
        self.size, self.flat = np.frombuffer(two["x"], np.int32).astype(np.int64), np.frombuffer(two["y"], np.uint16)
        self.begin = np.cumsum(self.size) - self.size

    def sequences(self, texts: np.ndarray):
        """About 64k words at once: texts, their ids laid end to end, bounds, and the dictionary number (-1 for an end)
        and first id of each token."""
        words_before = np.concatenate([[0], np.cumsum(self.per_row[texts])])
        i = 0
        while i < len(texts):
            j = max(i + 1, int(np.searchsorted(words_before, words_before[i] + 65_536, side="right")) - 1)
            some = texts[i:j]
            at = words_before[i : j + 1] - words_before[i]
            w = self.local[np.repeat(self.first[some] - at[:-1], self.per_row[some]) + np.arange(at[-1])].astype(np.int64)
            n = np.concatenate([[0], np.cumsum(self.size[w])])
            where = np.repeat(self.begin[w] - n[:-1], self.size[w]) + np.arange(n[-1])
            bounds = n[at] + np.arange(j - i + 1)
            seq = np.full(bounds[-1], END, np.int64)
            keep = np.ones(len(seq), bool)
            keep[bounds[1:] - 1] = False
            seq[keep] = self.flat[where]
            token = np.full(len(w) + j - i, -1, np.int64)
            ends = at[1:] + np.arange(j - i)
            words_at = np.ones(len(token), bool)
            words_at[ends] = False
            token[words_at] = w
            start = np.empty(len(token), np.int64)
            start[words_at] = n[:-1] + np.repeat(np.arange(j - i), np.diff(at))
            start[ends] = bounds[1:] - 1
            yield some, seq, bounds, token, start
            i = j


def _by_block(batches):
    """Lists of the rows of one block, which stand together."""
    held: list[dict] = []
    for batch in batches:
        for r in batch.to_pylist():
            if held and r["block"] != held[0]["block"]:
                yield held
                held = []
            held.append(r)
    if held:
        yield held


def _learn(rows: DataFrame, model: Model, k: int, passes: int) -> None:
    """Round k: each task trains on all windows of its share of training texts, then the moves are averaged into the
    model, those of an embedding by the times it was read.  The driver gets one model, in ``SLICES`` + 1 rows."""
    small = [x for x in model.net.p if x != "E"]
    shared = rows.sparkSession.sparkContext.broadcast(model)
    upper = np.cumsum(ROUNDS)[:-1]

    def run(batches):
        old, of = shared.value.net, shared.value.of
        net = Attention()
        net.p = {x: v.copy() for x, v in old.p.items()}
        adam, reads, total = Adam(net), np.zeros(IDS, np.int64), 0
        for own in _by_block(batches):
            block = Block(own)
            spot = (block.ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)) / 2.0**24
            texts = np.flatnonzero(block.train & (np.searchsorted(upper, spot, side="right") == k))
            for _ in range(passes):
                for _, seq, bounds, _, _ in block.sequences(texts):
                    x, live, target, where = windows(seq, bounds)
                    adam.learn(x, live, of[target], (where >= 0).astype(np.float32))
                    reads += np.bincount(x[live], minlength=IDS)
                    total += len(x)
        if not total:
            return
        task = TaskContext.get().partitionId()
        for i, ids in enumerate(np.array_split(np.arange(IDS), SLICES)):
            ids = ids[reads[ids] > 0]
            yield _row(7, task, i, ids, net.p["E"][ids] - old.p["E"][ids], reads[ids])
        rest = np.concatenate([(net.p[x] - old.p[x]).ravel() for x in small])
        yield _row(7, task, SLICES, np.zeros(1, np.int64), rest, np.array([total]))

    def mean(batches):
        sums: dict[int, tuple] = {}
        for batch in batches:
            for r in batch.to_pylist():
                ids, n = np.frombuffer(r["x"], np.int64), np.frombuffer(r["z"], np.int64)
                move = np.frombuffer(r["y"], np.float32).reshape(len(ids), -1 if len(ids) else DIM)
                if r["bucket"] not in sums:
                    length = IDS if r["bucket"] < SLICES else 1
                    sums[r["bucket"]] = np.zeros((length, move.shape[1])), np.zeros(length, np.int64)
                s, c = sums[r["bucket"]]
                s[ids] += move * n[:, None].astype(np.float64)
                c[ids] += n
        for i, (s, c) in sums.items():
            ids = np.flatnonzero(c)
            yield _row(7, 0, i, ids, (s[ids] / c[ids, None]).astype(np.float32))

    moves = rows.where("kind in (1, 2)").mapInArrow(run, _ROWS).repartition(SLICES + 1, "bucket").sortWithinPartitions("bucket", "block")
    for r in moves.mapInArrow(mean, _ROWS).select("bucket", "x", "y").collect():
        ids, move = np.frombuffer(r.x, np.int64), np.frombuffer(r.y, np.float32)
        if r.bucket < SLICES:
            model.net.p["E"][ids] += move.reshape(-1, DIM)
        else:
            cuts = np.cumsum([model.net.p[x].size for x in small])[:-1]
            for x, part in zip(small, np.split(move, cuts), strict=True):
                model.net.p[x] += part.reshape(model.net.p[x].shape)
    shared.unpersist()


def score(docs: DataFrame, train, ranks_path: str | None = None) -> DataFrame:
    """``(row, n_tokens, n_known, train_tokens, base_score, score)`` for ``(row long, text)``; ``train`` is the
    column that says which rows are learnt from."""
    spark = docs.sparkSession
    small_batches(spark)
    with open(ranks_path or default_ranks(), "rb") as f:
        ranks = spark.sparkContext.broadcast(f.read())
    docs = docs.select(F.col("row").cast("long").alias("row"), "text", F.coalesce(train, F.lit(True)).alias("train"))
    n = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    buckets = int(n // WIDTH // 8 + 1)
    rows = cut(_blocks(docs, buckets, ranks))
    release(spark)
    counted = cut(_counts(rows, buckets))
    distinct, tokens = _sums(counted, 6, 2).tolist()
    seen = _sums(rows, 4, IDS)
    ends = docs.where("train").count()
    total, kinds = tokens + ends, distinct + (ends > 0)
    model = Model(seen)
    passes = -(-LEAST // (int(seen.sum()) // STRIDE // BATCH + 1))
    for k in range(len(ROUNDS)):
        _learn(rows, model, k, passes)
        release(spark)
    shared = spark.sparkContext.broadcast(model)
    base = float(np.log10(total + kinds + 1))
    end_log = float(np.log10(ends + 1))

    def run(batches):
        for own in _by_block(batches):
            block = Block(own)
            ids, per_row, local = block.ids, block.per_row, block.local
            five = sorted((r["bucket"], r["x"]) for r in own if r["kind"] == 5)
            c = np.concatenate([np.zeros(0, np.int64), *(np.frombuffer(x, np.int64) for _, x in five)])
            owner = np.repeat(np.arange(len(ids)), per_row)
            known = np.bincount(owner, (c > 0)[local] if len(local) else None, len(ids)).astype(np.int64)
            word = np.append(np.log10(c + 1.0), end_log) - base  # the last is the end's
            logs = np.bincount(owner, word[local] if len(local) else None, len(ids)) + word[-1]
            out = np.empty(len(ids))
            for some, seq, bounds, token, start in block.sequences(np.arange(len(ids))):
                by_ids = np.add.reduceat(shared.value.logs(seq, bounds), start) + np.log1p(-WORD_SHARE)
                both = np.logaddexp(by_ids, word[token] * np.log(10) + np.log(WORD_SHARE))
                out[some] = np.add.reduceat(both, np.flatnonzero(np.concatenate([[True], token[:-1] < 0])))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, mask=block.null), pa.array(per_row + 1), pa.array(known + (1 if ends else 0)), pa.array(np.full(len(ids), total, np.int64)),
                    pa.array(logs), pa.array(out / np.log(10)),
                ],
                ["row", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
            )

    both = rows.where("kind in (1, 2)").union(counted.where("kind = 5"))
    parts = max(int(n // (1 << 23)), 1)
    return (
        both.repartition(parts, "block")
        .sortWithinPartitions("block")
        .mapInArrow(run, "row long, n_tokens long, n_known long, train_tokens long, base_score double, score double")
    )


def op4_lm_scoring(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", F.col("doc_id").alias("row"), "text")
    return score(docs, ~held_out(7)).select(
        F.col("row").alias("doc_id"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    ).withColumn("held_out", held_out(7))
