"""Alignment of two tokenizers' tokens over the same bytes.

Each Arrow partition encodes its texts with both tokenizers in chunks of about ``CHUNK`` bytes and hands DuckDB one interval table per
tokenizer (row of the chunk, place, id, first byte).  An ASOF join gives each A token the B token it begins in; where both
begin at the same byte a group begins, a window sum over these places numbers the groups, and an ASOF join on the groups' first
bytes gives B tokens theirs.  Links are the join of both within a group, counted per text, and partial document counts of id pairs are
counted per chunk; Spark merges them and looks the sums up for each text's links.

A is a byte-level BPE (space and text), B a sentencepiece model, which adds the space itself.  Neither has special tokens here.
Null and empty texts have no tokens, as have texts whose joined A or B bytes are not space and text, such as those with U+2581.
Repeated rows are documents of their own.  Very long texts are encoded whole, one chunk each.  An id pair of the most
frequent ones (more than one of 2**18 links) is looked up in a broadcast, all others by shuffle.  All columns but ``text`` are carried
along in ``_row``, so their names can't clash.  An empty table has no rows.
"""

from __future__ import annotations

import functools
import hashlib
import json
import re
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnweave.plans.durable import cut, shared_dir, small_batches

from .lookups import lookup

#: Text bytes that DuckDB gets at once.
CHUNK = 3 << 19
#: White space of such length is more than the fast encoder's regular expressions can take.
_LONG_GAP = re.compile(r"\s{1000}")

#: DuckDB: the group of each token.
_GROUPS = """
CREATE OR REPLACE TEMP TABLE grouped_a AS
    SELECT doc, i, id, s, opens, count(opens) OVER (ORDER BY i ROWS UNBOUNDED PRECEDING)::INT AS g
    FROM (SELECT a.*, CASE WHEN a.s = b.s THEN 1 END AS opens FROM a ASOF JOIN b ON a.s >= b.s);
CREATE OR REPLACE TEMP TABLE grouped_b AS
    SELECT b.doc, b.i, b.id, g.g FROM b ASOF JOIN (SELECT s, g FROM grouped_a WHERE opens = 1) g ON b.s >= g.s;
CREATE OR REPLACE TEMP TABLE links AS
    SELECT x.doc, x.id AS a, y.id AS b, count(*)::INT AS n FROM grouped_a x JOIN grouped_b y USING (g) GROUP BY ALL;
"""
ROWS = "uid bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, groups string, links array<struct<a: int, b: int, n: int>>, partial array<struct<a: int, b: int, docs: bigint>>"


def default_a() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def default_b() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class Ragged:
    """Byte strings by id in one array."""

    def __init__(self, values: list[bytes]):
        self.size = np.array([len(x) for x in values], np.int64)
        self.first = np.cumsum(self.size) - self.size
        self.flat = np.frombuffer(b"".join(values), np.uint8)

    def joined(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of the ids one after another."""
        n = self.size[ids]
        end = np.cumsum(n)
        return self.flat[np.repeat(self.first[ids] - (end - n), n) + np.arange(end[-1] if len(end) else 0)]


def _byte_letters() -> dict[str, int]:
    """Byte-level vocabularies write a byte as its own Latin-1 letter where that prints, and the others from U+0100 on in order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class ByteLevel:
    """Encoder A from its JSON; texts that the fast encoder can't take go to the plain one, which gives the same ids."""

    def __init__(self, content: str):
        import public_tokenizers
        import tiktoken

        self.content, vocab, letter = content, json.loads(content)["model"]["vocab"], _byte_letters()
        special = {x["content"] for x in json.loads(content)["added_tokens"]}
        known = {bytes(letter[c] for c in k): i for k, i in vocab.items() if k not in special}
        self.bytes = Ragged(_by_id(known))
        self.fast = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=known, special_tokens={})

    @functools.cached_property
    def plain(self):
        from tokenizers import Tokenizer

        t = Tokenizer.from_str(self.content)
        t.encode_special_tokens = True
        return t

    def encode(self, text: str) -> np.ndarray:
        if _LONG_GAP.search(text):
            return np.array(self.plain.encode(text, add_special_tokens=False).ids, np.int64)
        return np.array(self.fast.encode_ordinary(text), np.int64)


class Pieces:
    """Encoder B."""

    def __init__(self, content: bytes):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_proto=content)
        self.bytes = Ragged([self._bytes(i) for i in range(len(self.model))])

    def _bytes(self, i: int) -> bytes:
        piece = self.model.id_to_piece(i)
        if self.model.is_byte(i):
            return bytes([int(piece[3:-1], 16)])
        return b"" if self.model.is_unknown(i) or self.model.is_control(i) else piece.replace("▁", " ").encode()

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(x, np.int64) for x in self.model.encode(texts, num_threads=1)]


def _by_id(known: dict[bytes, int]) -> list[bytes]:
    out = [b""] * (max(known.values()) + 1)
    for k, i in known.items():
        out[i] = k
    return out


@functools.lru_cache(2)
def _loaded(a: str, b: bytes):
    import duckdb

    con = duckdb.connect(":memory:", config={"threads": 1, "temp_directory": ""})  # chunks are small: nothing is spilled to a local folder
    return ByteLevel(a), Pieces(b), con


class Printed:
    """The ids of a chunk in the form ``a1,a2|b1;a3|b2,b3``."""

    def __init__(self, most: int):
        digits = [str(i).encode() for i in range(most)]
        self.width = max(map(len, digits)) + 1
        self.table = np.array([list((b" " + x).ljust(self.width)) for x in digits], np.uint8).reshape(most, self.width)
        self.size = np.array([len(x) + 1 for x in digits])
        self.kept = np.arange(self.width) < self.size[:, None]

    def texts(self, a, b, group_a, group_b, doc_a, docs: int) -> list[bytes]:
        """What each of the chunk's rows prints; groups are numbered from 1 over the chunk and ids stand in order."""
        count_a, count_b = (np.bincount(g, minlength=1 + int(group_a.max(initial=0))) for g in (group_a, group_b))
        before_a, before_b = np.cumsum(count_a) - count_a, np.cumsum(count_b) - count_b
        at_a = np.arange(len(a)) + before_b[group_a]
        at_b = np.arange(len(b)) + before_a[group_b] + count_a[group_b]
        n = len(a) + len(b)
        ids, sep = np.empty(n, np.int64), np.full(n, ord(","), np.uint8)
        ids[at_a], ids[at_b] = a, b
        opens = np.diff(group_a, prepend=0) > 0
        sep[at_a[opens]] = ord(";")
        sep[at_b[np.diff(group_b, prepend=0) > 0]] = ord("|")
        first = at_a[np.flatnonzero(np.diff(doc_a, prepend=-1))]  # of each row that has tokens
        rows = self.table[ids]
        rows[:, 0] = sep
        size = self.size[ids]
        keep = self.kept[ids]
        keep[first, 0] = False
        flat = rows[keep].tobytes()
        size[first] -= 1
        place = np.append((np.cumsum(size) - size)[first], len(flat))
        out = [b""] * docs
        for k, d in enumerate(doc_a[np.flatnonzero(np.diff(doc_a, prepend=-1))].tolist()):
            out[d] = flat[place[k] : place[k + 1]]
        return out


@functools.lru_cache(1)
def _printed(most: int) -> Printed:
    return Printed(most)


def _aligned(texts: list[str | None], a: ByteLevel, b: Pieces, con, groups: bool) -> list[pa.Array]:
    """Columns of ROWS without the uid for one chunk."""
    n = len(texts)
    here = [d for d, x in enumerate(texts) if x]
    in_a = [a.encode(" " + texts[d]) for d in here]
    in_b = b.encode([texts[d] for d in here]) if here else []
    ids_a, ids_b, doc_a, doc_b = [], [], [], []
    for d, x, y in zip(here, in_a, in_b, strict=True):
        want = np.frombuffer((" " + texts[d]).encode(), np.uint8)
        # A cuts and merges bytes and nothing else, so its size tells; B may have changed some
        if a.bytes.size[x].sum() == len(want) == b.bytes.size[y].sum() and np.array_equal(b.bytes.joined(y), want):
            ids_a.append(x)
            ids_b.append(y)
            doc_a.append(np.full(len(x), d, np.int32))
            doc_b.append(np.full(len(y), d, np.int32))
    if not ids_a:
        zero = pa.array([0] * n, pa.int64())
        kinds = [_ARROW[k] for k in ("links", "partial")]
        return [zero] * 4 + [pa.array([""] * n), pa.array(["" if groups else None] * n, pa.string()), *(pa.array([[]] * n, k) for k in kinds)]
    ids_a, ids_b, doc_a, doc_b = (np.concatenate(x) for x in (ids_a, ids_b, doc_a, doc_b))
    place = np.int32 if max(a.bytes.size[ids_a].sum(), len(ids_a), len(ids_b)) < 1 << 31 else np.int64
    for name, ids, doc, size in (("a", ids_a, doc_a, a.bytes.size), ("b", ids_b, doc_b, b.bytes.size)):
        first = (np.cumsum(size[ids]) - size[ids]).astype(place)
        con.register(name, pa.table({"doc": doc, "i": np.arange(len(ids), dtype=place), "id": ids.astype(np.int32), "s": first}))
    con.execute(_GROUPS)
    group_a = con.execute("SELECT g FROM grouped_a ORDER BY i").fetchnumpy()["g"]
    group_b = con.execute("SELECT g FROM grouped_b ORDER BY i").fetchnumpy()["g"]
    links = con.execute("SELECT doc, a, b, n FROM links ORDER BY ALL").fetchnumpy()
    partial = con.execute("SELECT a, b, count(*)::BIGINT AS docs FROM links GROUP BY ALL ORDER BY ALL").fetchnumpy()
    for name in ("a", "b"):
        con.unregister(name)
    text = _printed(max(len(a.bytes.size), len(b.bytes.size))).texts(ids_a, ids_b, group_a, group_b, doc_a, n)
    sums = np.bincount(links["doc"], weights=links["n"], minlength=n).astype(np.int64)
    number = np.bincount(doc_a[np.diff(group_a, prepend=0) > 0], minlength=n)
    offsets = np.searchsorted(links["doc"], np.arange(n + 1))
    inner = pa.StructArray.from_arrays([pa.array(links[k], pa.int32()) for k in "abn"], ["a", "b", "n"])
    sent = pa.StructArray.from_arrays([pa.array(partial["a"], pa.int32()), pa.array(partial["b"], pa.int32()), pa.array(partial["docs"], pa.int64())], ["a", "b", "docs"])
    return [
        pa.array(np.bincount(doc_a, minlength=n)), pa.array(np.bincount(doc_b, minlength=n)), pa.array(number), pa.array(sums),
        pa.array([hashlib.sha256(x).hexdigest() if x else "" for x in text]),
        pa.array([x.decode() if groups else None for x in text], pa.string()),
        pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), inner),
        pa.ListArray.from_arrays(pa.array(np.append(0, np.full(n, len(sent))), pa.int32()), sent),  # stands in the chunk's first row
    ]


_ARROW = {
    "links": pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32()), ("n", pa.int32())])),
    "partial": pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32()), ("docs", pa.int64())])),
}


def align(docs: DataFrame, a_path: str | None = None, b_path: str | None = None, groups: bool = False) -> tuple[DataFrame, DataFrame]:
    """Rows and id pairs.

    Rows: ``_row`` (all columns but the text), ``uid``, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``groups_sha256``, ``groups``
    (the printed groups, if asked for) and ``links`` (id pair and how often).  Pairs: ``a``, ``b``, ``docs`` (documents that
    hold the pair linked), ``best`` (no pair of the A id is in more).  Both are written in the shared folder.
    """
    spark = docs.sparkSession
    small_batches(spark)
    with open(a_path or default_a(), encoding="utf-8") as f, open(b_path or default_b(), "rb") as g:
        models = spark.sparkContext.broadcast((f.read(), g.read()))
    rest = [F.col(f"`{c}`") for c in docs.columns if c != "text"]
    carried = docs.select("text", F.struct(*rest, *([] if rest else [F.lit(0)])).alias("_row"), F.monotonically_increasing_id().alias("uid"))

    def run(batches):
        a, b, con = _loaded(*models.value)

        def done(held):
            rows = pa.Table.from_batches(held).combine_chunks()
            made = _aligned(rows.column("text").to_pylist(), a, b, con, groups)
            names = ["_row", "uid", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "groups", "links", "partial"]
            yield from pa.Table.from_arrays([rows.column("_row"), rows.column("uid"), *made], names).to_batches()

        held, size = [], 0
        for batch in batches:
            lengths = pc.binary_length(batch.column("text")).fill_null(0).to_pylist()
            i = 0
            for j, n in enumerate(lengths):
                size += n
                if size >= CHUNK:
                    held.append(batch.slice(i, j + 1 - i))
                    yield from done(held)
                    i, held, size = j + 1, [], 0
            if i < len(batch):
                held.append(batch.slice(i))
        if held:
            yield from done(held)

    folder = f"{shared_dir(spark)}/alignment-{uuid.uuid4().hex}"
    carried.mapInArrow(run, f"_row {carried.schema['_row'].dataType.simpleString()}, {ROWS}").write.parquet(folder)
    rows = spark.read.parquet(folder)
    counts = rows.select(F.explode("partial").alias("p")).groupBy("p.a", "p.b").agg(F.sum("p.docs").alias("docs"))
    counts = cut(counts)
    highest = counts.groupBy("a").agg(F.max("docs").alias("_most"))  # at most a row for each id of A
    pairs = counts.join(F.broadcast(highest), "a").select("a", "b", "docs", (F.col("docs") == F.col("_most")).alias("best"))
    return rows.drop("partial"), pairs


def link_counts(rows: DataFrame, pairs: DataFrame) -> DataFrame:
    """``(uid, n_best, count_sum)`` of rows with links: links whose pair is the A id's best, and the pairs' counts over all links."""
    links = rows.select("uid", F.explode("links").alias("l")).select("uid", "l.a", "l.b", "l.n")
    met = lookup(links, pairs, ["a", "b"], pairs.select("a", "b", F.col("docs").alias("_weight")), 1 << 18)
    return met.groupBy("uid").agg(
        F.sum(F.when(F.col("best"), F.col("n")).otherwise(0)).alias("n_best"), F.sum(F.col("n") * F.col("docs")).alias("count_sum")
    )


def op12_tokenizer_alignment(spark, sf_dir: str) -> DataFrame:
    rows, pairs = align(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return rows.join(link_counts(rows, pairs), "uid", "left").select(
        F.col("_row.doc_id").alias("doc_id"), "n_a", "n_b", "n_groups", "n_links", zero("n_best"), zero("count_sum"), "groups_sha256"
    )
