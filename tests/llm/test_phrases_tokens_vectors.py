"""Collocations, tokenizer alignment and learned partitions against brute force."""

import hashlib
import os
import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tarnweave.llm import alignment, collocations, neighbours
from tarnweave.llm.lookups import lookup

FOLDER = "/root/testdata/sf0.001"


def lower(x):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in x)


def grams(docs, longest):
    f = defaultdict(Counter)
    for text, lang in docs:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text or "")):
            w = re.findall(r"[^\x20\x09]+", piece)
            for k in range(1, longest + 1):
                f["und" if lang is None else lang].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    return f


def ranked(docs, longest=3, least=10, share=50, top=2000):
    out = set()
    for lang, f in grams(docs, longest).items():
        n = sum(c for p, c in f.items() if len(p) == 1)
        cand = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        rows = []
        for p, a in cand.items():
            within = [b for q, b in cand.items() if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q)))]
            if any(100 * b >= share * a for b in within):
                continue
            score, k = min((10**6 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            rows.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (s, a, p, left, right) in enumerate(sorted(rows)[:top], 1):
            out.add((lang, rank, p.decode(), -a, left, right, n, -s))
    return out


def texts():
    r = random.Random(1)
    some = [" ".join(r.choice(["a", "B", "the", "of", "x.", "y,", "é", "\n", "q!"]) for _ in range(r.randrange(40))) for _ in range(120)]
    some += [None, "", "  ", ".,;", "The the the the the", "hot pair " * 200, "word " * 3000] + ["copy of one text with words"] * 30
    return [(x, r.choice(["en", None, "und", "de"])) for x in some]


@pytest.mark.parametrize(("longest", "words", "rate", "top"), [(3, 1 << 21, 1 << 12, 2000), (3, 300, 4, 5), (4, 300, 2, 2000), (2, 100, 2, 2000)])
def test_collocations(spark, monkeypatch, longest, words, rate, top):
    monkeypatch.setattr(collocations, "RANGE", words)  # few words a range: borders within hot words and pairs
    monkeypatch.setattr(collocations, "RATE", rate)
    docs = texts()
    df = spark.createDataFrame([(*x, 1, "clash") for x in docs], "text string, lang string, a int, words string")
    got = {tuple(r) for r in collocations.collocations(df, longest, 5, 50, top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()}
    assert got == ranked(docs, longest, 5, 50, top)


def test_blocks_of_all_borders_sum_up():
    """Whatever the borders, merged ranges hold every node of the whole trie once."""
    r = random.Random(2)
    h = np.array([r.randrange(1, 12) * 2 + 1 for _ in range(2000)], np.uint64)
    glued = np.array([r.random() < 0.9 for _ in h])
    glued[-1] = False
    text = {int(x): (f"w{x}", "en") for x in set(h.tolist())}
    whole = {tuple(w): (a, tuple(left)) for _, w, a, left in collocations.Trie.of(h, glued, text, 3).frequent(1, None)}
    halves = [collocations.Trie.of(x, y, text, 3) for x, y in ((h[:900], np.append(glued[:899], False)), (h[900:], glued[900:]))]
    glued[899] = False
    whole = {tuple(w): (a, tuple(left)) for _, w, a, left in collocations.Trie.of(h, glued, text, 3).frequent(1, None)}
    for _ in range(20):
        borders = np.unique(np.array([[r.randrange(0, 30) for _ in range(3)] for _ in range(5)], np.uint64), axis=0)
        cuts = [t.slices(borders) for t in halves]
        got = []
        for k in range(len(borders) + 1):
            blocks = [t.block([int(x[k]) for x in lo], [int(x[k]) for x in hi]) for t, (lo, hi) in zip(halves, cuts) if hi[0][k] > lo[0][k]]
            if blocks:
                got += collocations.Trie.merged(blocks).frequent(1, borders[k - 1] if k else None)
        assert len(got) == len(whole) and {tuple(w): (a, tuple(left)) for _, w, a, left in got} == whole


def test_collocations_query_equals_its_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{FOLDER}/documents.parquet'")
    names = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    want = con.execute(f"SELECT {', '.join(names)} FROM ({collocations.OP11_SQL})").fetchall()
    got = [tuple(r) for r in collocations.op11_phrase_collocations(spark, FOLDER).select(*names).collect()]
    assert sorted(got) == sorted(want) and want


def test_collocations_of_nothing(spark):
    none = spark.createDataFrame([], "text string, lang string")
    assert collocations.collocations(none).count() == 0
    assert collocations.collocations(spark.createDataFrame([(None, "en"), ("", None)], "text string, lang string")).count() == 0


def test_scores_beyond_64_bits(spark):
    """Counts of some billions: the products are exact."""
    a, left, right = 3_000_000_019, 4_000_000_007, 5_000_000_029
    e = "cast({} as decimal(19,0))"
    got = spark.sql(f"SELECT ({e.format(a)} * {e.format(a)} * cast(1000000 as decimal(7,0))) div ({e.format(left)} * {e.format(right)}) AS s").first().s
    assert got == 10**6 * a * a // (left * right)


def test_lookup_of_hot_and_rare_keys(spark):
    rows = spark.createDataFrame([(i, 7 if i % 3 else i) for i in range(300)], "i int, k int")
    table = spark.createDataFrame([(k, k * 2) for k in range(0, 300, 2)] + [(7, 14)], "k int, v int")
    for most in (1, 4, 1000):
        got = sorted((r.i, r.k, r.v) for r in lookup(rows, table, ["k"], most=most).collect())
        assert got == [(i, k, 2 * k) for i, k in sorted((i, 7 if i % 3 else i) for i in range(300)) if k == 7 or k % 2 == 0]


def aligned(docs):
    """Rows of the contract, token by token."""
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(alignment.default_a())
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=alignment.default_b())
    letter, name = alignment._byte_letters(), {i: k for k, i in a.get_vocab().items()}
    raw_a = lambda i: bytes(letter[c] for c in name[i])
    raw_b = lambda i: bytes([int(b.id_to_piece(i)[3:-1], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()
    seen, count = [], Counter()
    for text in docs:
        x, y = (a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)) if text else ([], [])
        whole = (" " + (text or "")).encode()
        if not text or b"".join(map(raw_a, x)) != whole or b"".join(map(raw_b, y)) != whole:
            seen.append(None)
            continue
        ends = [np.cumsum([len(raw(i)) for i in ids]).tolist() for raw, ids in ((raw_a, x), (raw_b, y))]
        groups, lo = [], 0
        for e in sorted(set(ends[0]) & set(ends[1])):
            groups.append([[i for i, z in zip(ids, end, strict=True) if lo < z <= e] for ids, end in ((x, ends[0]), (y, ends[1]))])
            lo = e
        links = Counter((i, j) for u, v in groups for i in u for j in v)
        count.update(links.keys())
        seen.append((len(x), len(y), groups, links))
    best = defaultdict(int)
    for (i, _), c in count.items():
        best[i] = max(best[i], c)
    out = []
    for s in seen:
        if s is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, groups, links = s
        printed = ";".join(",".join(map(str, u)) + "|" + ",".join(map(str, v)) for u, v in groups)
        sums = sum(links.values()), sum(n for p, n in links.items() if count[p] == best[p[0]]), sum(n * count[p] for p, n in links.items())
        out.append((n_a, n_b, len(groups), *sums, hashlib.sha256(printed.encode()).hexdigest()))
    return out


@pytest.mark.parametrize("most", [1, 1 << 18])
def test_alignment(spark, tmp_path, monkeypatch, most):
    monkeypatch.setattr(alignment, "lookup", lambda rows, table, keys, weights, _: lookup(rows, table, keys, weights, most))  # all by shuffle, or all broadcast
    r = random.Random(3)
    docs = [None, "", " ", "\n\n", "Hello, world!", "Hello, world!", "▁a", "a▁", "\x00", "日本語 😀 naïve", "<s> </s> <|endoftext|> <unk>", " " * 3000 + "x", "abc " * 9000, "1" * 2000]
    docs += ["".join(r.choice(["the ", "ing", "é", "😀", "\t", " ", "12", "Zq", "."]) for _ in range(r.randrange(60))) for _ in range(60)]
    spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = {x.doc_id: tuple(x)[1:] for x in alignment.op12_tokenizer_alignment(spark, str(tmp_path)).collect()}
    assert got == dict(enumerate(aligned(docs)))


def test_alignment_keeps_other_columns(spark):
    df = spark.createDataFrame([(1, "a b", 5, "x"), (1, "a b", 5, "x"), (None, None, None, None)], "uid long, text string, n_a int, links string")
    rows, pairs = alignment.align(df, groups=True)
    assert sorted((r._row.uid or 0, r._row.n_a or 0, r.groups) for r in rows.collect()) == [(0, 0, ""), (1, 5, "257|264;275|287"), (1, 5, "257|264;275|287")]
    assert sorted(map(tuple, pairs.collect())) == [(257, 264, 2, True), (275, 287, 2, True)]
    none, no_pairs = alignment.align(df.limit(0))
    assert none.count() == 0 and no_pairs.count() == 0 and alignment.link_counts(none, no_pairs).count() == 0


def brute(rows, queries, k):
    out = {}
    for q in queries:
        x = rows[q]
        d = sorted((float(np.sqrt(((np.array(v, float) - np.array(x, float)) ** 2).sum())), i) for i, v in rows.items() if i != q)
        out[q] = d[:k]
    return out


def test_cells_are_exact(monkeypatch):
    monkeypatch.setattr(neighbours, "STEP", 7)
    r = np.random.default_rng(1)
    x = r.normal(size=(60, 5)).round(1)
    x[20:40] = x[3]  # copies: ties
    ids = r.permutation(60).astype(np.int64)
    query, score, found = neighbours.nearest_in_cell(ids, x, ids[:9], x[:9], 6)
    want = brute(dict(zip(ids.tolist(), x, strict=True)), ids[:9].tolist(), 6)
    for j, q in enumerate(ids[:9].tolist()):
        assert list(zip(score[query == j].tolist(), found[query == j].tolist(), strict=True)) == want[q]


def test_parts_are_balanced():
    x = np.random.default_rng(2).normal(size=(900, 8))
    x[:300] = x[0]  # a third of the rows are one vector
    part = neighbours.balanced_parts(x, neighbours._graph(x, 5), 9)
    assert np.bincount(part, minlength=9).max() <= 110


@pytest.mark.parametrize(("slice_", "block"), [(1 << 15, 1 << 12), (40, 3)])
def test_recall_of_learned_partitions(spark, monkeypatch, slice_, block):
    monkeypatch.setattr(neighbours, "SLICE", slice_)
    monkeypatch.setattr(neighbours, "BLOCK", block)
    df = spark.read.parquet(f"{FOLDER}/embeddings.parquet")
    rows = {r.vec_id: r.embedding for r in df.collect()}
    got = defaultdict(list)
    for r in neighbours.op13_nearest_neighbours(spark, FOLDER).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.score, r.vec_id))
        assert r.rank == len(got[r.query_id])
    want = brute(rows, [i for i in rows if i % 100 == 0], 10)
    assert got.keys() == want.keys() and all(len(x) == 10 for x in got.values())
    assert sum(len(set(got[q]) & set(want[q])) for q in want) >= 0.9 * 10 * len(want)


def test_recall_on_clustered_vectors(spark):
    """Well separated clusters: few parts are looked into, and still nine in ten neighbours are found."""
    r = np.random.default_rng(3)
    centre = r.normal(size=(40, 16)) * 4
    x = (centre[r.integers(0, 40, 3000)] + r.normal(size=(3000, 16))).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    rows = neighbours.usable(df)
    router = neighbours.fit(rows)
    assert router.parts > 10 and router.probes <= router.parts // 3
    got = defaultdict(set)
    for q in neighbours.search(rows, rows.where(F.col("id") % 100 == 0), 10, router).collect():
        got[q.query_id].add(q.vec_id)
    want = brute(dict(enumerate(x)), range(0, 3000, 100), 10)
    assert sum(len(got[q] & {i for _, i in want[q]}) for q in want) >= 0.9 * 300


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    odd = [(0, None), (1, []), (2, [0.0, 0.0]), (3, [1.0, None]), (4, [nan, 1.0]), (5, [inf, 1.0]), (None, [1.0, 1.0]), (6, [1.0, 2.0, 3.0])]
    good = [(100, [1.0, 0.0]), (7, [1.0, 0.0]), (8, [1.0, 0.0]), (9, [0.0, 1.0]), (100, [1.0, 0.0])]
    df = spark.createDataFrame(odd + good, "vec_id long, embedding array<double>").withColumn("part", F.lit(1)).withColumn("id", F.lit(2))
    rows = neighbours.usable(df)
    got = [tuple(r) for r in neighbours.search(rows, rows.where("id % 100 = 0")).orderBy("rank").collect()]
    assert got == [(100, 1, 7, 0.0), (100, 2, 8, 0.0), (100, 3, 9, 2**0.5)]
    for some in (df.limit(0), df.where("vec_id = 100").limit(1)):
        rows = neighbours.usable(some)
        assert neighbours.search(rows, rows).count() == 0


def test_files_are_there():
    assert os.path.exists(alignment.default_a()) and os.path.exists(alignment.default_b())
