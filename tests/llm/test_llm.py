"""Operators against brute force on small fixtures."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tarnweave.llm import chatformat, decontaminate, langid, lmscore, ngramjoin, pieces, pii, qualityrules, resample, suffixdedup
from tarnweave.llm.suffixarray import suffix_array

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def fold(x):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in x or "")


def near_copies():
    r = random.Random(1)
    base = [f"w{i}" for i in range(200)]
    out = [None, "", " \n", "a", "A b", "a B", "a b c d e", "x y z w v u t"] * 2
    for k in range(60):
        x = list(base)
        for _ in range(k % 9):
            x[r.randrange(200)] = f"q{r.randrange(10**6)}"
        out.append(" ".join(x))
    return out


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empties, ties, repeated rows, a long text and columns with clashing names."""
    texts = [None, "", "  ", "Hello world", "Hello world", "é😀 ñ\nline\nline", "word " * 30000, "1" * 3000, "mail a@b.co and +44 20 7946 0958"]
    rows = [(i if i else None, t, "en", "s", len(t or ""), 0.5, 1) for i, t in enumerate(texts)] + [(4, "Hello world", "en", "s", 11, 0.5, 1)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score double, n int")


def test_trie_links():
    r = random.Random(2)
    sets = [np.unique(np.array(r.sample(range(60), r.randrange(1, 40)), np.uint64)) for _ in range(120)]
    sets += [np.sort(np.setdiff1d(sets[0], sets[0][:k])) for k in range(4)]
    trie = ngramjoin.Trie()
    for i, x in enumerate(sets):
        trie.add(i, x[::-1])
    for x in sets:
        want = [i for i, y in enumerate(sets) if 4 * len(np.intersect1d(x, y)) >= 3 * len(np.union1d(x, y))]
        assert sorted(trie.linked(x)) == want


def test_parity_bitmaps_lose_no_link():
    r = random.Random(5)
    for _ in range(300):
        x = set(r.sample(range(10**9), r.choice([1, 5, 60, 400, 3000])))
        y = set(r.sample(sorted(x), max(1, int(len(x) * r.uniform(0.7, 1))))) | set(r.sample(range(10**9), int(len(x) * r.uniform(0, 0.2))))
        a, b = (np.array(sorted(s), np.uint64) for s in (x, y))
        if 4 * len(x & y) >= 3 * len(x | y):
            assert ngramjoin.may_link(len(x), ngramjoin.parities(a), len(y), ngramjoin.parities(b))
    a, b = (np.array(r.sample(range(10**9), 500), np.uint64) for _ in "ab")
    assert not ngramjoin.may_link(500, ngramjoin.parities(a), 500, ngramjoin.parities(b))


@pytest.mark.parametrize(("run", "tokens", "most"), [(4, 1 << 21, 1 << 25), (32, 2000, -1)])
def test_near_duplicates(spark, monkeypatch, run, tokens, most):
    monkeypatch.setattr(ngramjoin, "RUN", run)
    monkeypatch.setattr(ngramjoin, "TOKENS", tokens)  # families beyond one trie
    monkeypatch.setattr(ngramjoin, "MOST_IDS", most)  # more ids than the bit array is for
    texts = dict(enumerate(near_copies()))
    sets = {}
    for d, x in texts.items():
        w = WORD.findall(fold(x))
        sets[d] = {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngramjoin.near_duplicates(df).collect()}
    assert got == {d: (len(sets[d]), find(d)) for d in sets}


def test_pieces_equal_the_library():
    import sentencepiece

    model = open(pieces.default_model(), "rb").read()
    p, sp = pieces.Pieces(model), sentencepiece.SentencePieceProcessor(model_proto=model)
    r = random.Random(1)
    texts = ["", "a", "  a  b ", "\n\n", "日本語😀", "<s>hi</s> <0x0A>", "the" * 200, "ab" * 300, "\t\t x"]
    texts += ["".join(r.choice("abet hino\n.é😀1") for _ in range(r.randrange(1, 150))) for _ in range(60)]
    for x in texts:
        got = [i for s in p.encode(p.escape(x)) for i in s]
        assert got == sp.encode(x)
        assert p.decode(got) == x
        s = p.escape(x)
        if s:
            mats, parts = [], []
            for k in range(0, len(s), 23):
                lo = k - max(0, k - 2 * p.longest)
                parts.append((s[k - lo : k + 23], lo))
                mats.append(p.transfer(*parts[-1]))
            path = pieces._path(mats)
            assert [i for (t, lo), a, b in zip(parts, path[:-1], path[1:], strict=True) for i in p.trace(t, lo, a, b)] == got
            whole = mats[0]
            for m in mats[1:]:
                whole = pieces.combine(whole, m)
            assert (0, path[-1][1]) in whole[0, ""]


def test_decoding_of_columns():
    """All rows at once give what each row gives alone, broken bytes included."""
    import pyarrow as pa

    p = pieces.Pieces(open(pieces.default_model(), "rb").read())
    r = random.Random(11)
    good = [[i for s in p.encode(p.escape(t)) for i in s] for t in ["a b", "", " x", "日本語😀é", "line\nline  two", "<s>"]]
    odd = [[p.byte[0xC3]], [p.byte[0xA9]], [p.unknown, 1, 2], [r.randrange(p.size) for _ in range(50)]]
    for rows in (good, good + odd, [*good, None], [[]], [good[0][1:], good[3]]):
        assert pieces._texts(p, pa.array(rows, pa.list_(pa.int32()))).to_pylist() == [None if x is None else p.decode(x) for x in rows]


def test_giant_texts_over_chunks(spark, monkeypatch):
    import sentencepiece

    monkeypatch.setattr(pieces, "FAN", 3)  # a tree of several levels
    sp = sentencepiece.SentencePieceProcessor(model_file=pieces.default_model())
    texts = ["ab" * 3000, "ab" * 3000, None, "x y " * 2000, "éa b\n" * 1500 + "q" * 4000, "short", ""]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("ids", F.lit("clash"))
    got = {r.doc_id: r.ids for r in pieces.encode(df, chunk=500).collect()}
    assert got == {i: None if t is None else sp.encode(t) for i, t in enumerate(texts)}


def test_query_equals_the_library(spark):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=pieces.default_model())
    docs = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    for r in pieces.op2_sentencepiece(spark, "/root/testdata/sf0.001").collect():
        ids = sp.encode(docs[r.doc_id] or "")
        assert r.n_tokens == len(ids) and r.round_trip
        if docs[r.doc_id] is not None:
            assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()


def base_spans(t):
    def luhn(d):
        total = 0
        for i, c in enumerate(reversed(d)):
            x = int(c) * (1 + i % 2)
            total += x - 9 if x > 9 else x
        return total % 10 == 0

    digits = lambda x: re.sub("[^0-9]", "", x)
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(x) <= 255 for x in m[0].split("."))]
    out += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t) if 12 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))]
    out += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 9 <= len(digits(m[0])) <= 15]
    return sorted(out)


def test_personal_data(spark):
    texts = ["", None, "a@b.c_d@e.f x", "a@b..c", "+1 (555) 123-4567.", "4111 1111 1111 1111", "1.2.3.4.5.6.7.8", "999.1.1.1 1.1.1.256",
             "é😀 a@b.co 😀😀 +44 20 7946 0958 )", "a.a." * 30 + "@b.c", "1 " * 1500, "7" * 3000, "a@" + "b." * 1500 + "c", "0001.002.3.4", "a@b.c " * 600]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in pii.detect(df).collect():
        assert [(x.s, x.k, x.e) for x in r.base] == base_spans(r.text)
        assert {(x.s, x.k, x.e) for x in r.base} <= {(x.s, x.k, x.e) for x in r.spans}
    done = {r.doc_id: r.text for r in pii.redact(df).collect()}
    assert done[1] is None and done[5] == "[CARD]" and done[6] == "[IP].[IP]" and done[2] == "[EMAIL][EMAIL] x"


def test_boosting_and_calibration():
    codes = np.array([0, 1, 2, 3])
    pos, neg = np.array([1.0, 2, 95, 300]), np.array([99.0, 200, 5, 1])
    trees = pii.fit(codes, pos, neg)
    f = pii.margin((codes[:, None] >> np.arange(pii.N_BITS)) & 1, trees)
    least = pii.calibrate(f, pos, neg, 0.9, 20)
    assert [x >= least for x in f] == [False, False, True, True]


def test_language_model_is_a_distribution():
    keys = np.array([1 << 36 | 2 << 24 | 3 << 12 | 4, 1 << 36 | 2 << 24 | 3 << 12 | 5, 2 << 36 | 2 << 24 | 3 << 12 | 4], np.uint64)
    m = langid.Smoothed(*langid._merge([keys], [np.array([3, 1, 2])]))
    ctx = 1 << 24 | 2 << 12 | 3
    assert math.isclose(m.prob(0, np.array([ctx << 12 | x for x in range(4096)], np.uint64)).sum(), 1.0)


def test_language_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = langid.train(docs.where(~langid.held_out(4)))
    rest = langid.score(docs.where(langid.held_out(4)).select("doc_id", "text", "lang"), model)
    assert rest.where("lang_pred = lang").count() >= 0.98 * rest.count()


def test_language_in_blocks(spark, monkeypatch):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang")
    whole = {r.doc_id: (r.lang_pred, r.score, r.entropy) for r in langid.score(docs, langid.train(docs)).collect()}
    monkeypatch.setattr(langid, "MAX_ENTRIES", 5000)
    model = langid.train(docs)
    assert len(model.blocks()) > 2
    for r in langid.score(docs, model).collect():
        lang, share, entropy = whole[r.doc_id]
        assert r.lang_pred == lang and r.score == pytest.approx(share, abs=1e-4) and r.entropy == pytest.approx(entropy, rel=1e-5)


def test_entropy_of_plain_kneser_ney(spark):
    """One language, one short table: the model's bits against sums over dictionaries."""
    texts = ["abra cadabra", "Abba abracad", "cab  bad"]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    def grams(t):
        s = "   " + re.sub("[^a-z]+", " ", t.lower())
        return [s[i - 3 : i + 1] for i in range(3, len(s))]
    counts = [Counter(g for t in texts for g in grams(t))]
    for _ in range(3):
        counts.append(Counter(g[1:] for g in counts[-1]))
    def p(g, level=0):
        if level == 4:
            return 1 / 4096
        c, ctx = counts[level], g[:-1]
        total = sum(n for x, n in c.items() if x[:-1] == ctx)
        low = p(g[1:], level + 1)
        if not total:
            return low
        return max(c[g] - 0.75, 0) / total + 0.75 * sum(x[:-1] == ctx for x in c) / total * low
    for t, r in zip(["abra dab", "zzz"], langid.score(spark.createDataFrame([(0, "abra dab"), (1, "zzz")], "doc_id long, text string"), langid.train(docs)).orderBy("doc_id").collect(), strict=True):
        own = grams(t)
        assert math.isclose(r.entropy, -sum(math.log2(p(g)) for g in own) / len(own), rel_tol=1e-5)


def test_language_odd_rows(spark, odd):
    out = {r.doc_id: r for r in langid.identify(odd.select("doc_id", "text"), *langid.learn(odd)).collect()}
    assert out[None].lang_pred == out[1].lang_pred == out[7].lang_pred == "und" and out[7].rejected
    assert langid.train(odd.where("lang = 'xx'")) is None
    assert langid.score(odd.select("doc_id", "text"), None).where("lang_pred = 'und'").count() == odd.count()


def test_attention_gradient():
    net = lmscore.Attention(1)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    ids = np.random.default_rng(0).integers(0, 50, 46)
    x, live, target, where = lmscore.windows(ids, np.array([0, 40, 45, 46]))
    assert sorted(where[where >= 0].tolist()) == list(range(46))  # each id once
    target, weight = target % lmscore.CLASSES, (where >= 0).astype(float)
    _, g = net.gradient(x, live, target, weight)
    for k in net.p:
        i = np.unravel_index(np.abs(g[k]).argmax(), g[k].shape)
        old, e = net.p[k][i], 1e-5
        net.p[k][i] = old + e
        up, _ = net.gradient(x, live, target, weight)
        net.p[k][i] = old - e
        down, _ = net.gradient(x, live, target, weight)
        net.p[k][i] = old
        assert math.isclose(g[k][i], (up - down) / 2 / e, rel_tol=1e-4)


def test_scores(spark, monkeypatch):
    monkeypatch.setattr(lmscore, "BLOCK", 500)
    texts = {i: t for i, t in enumerate([None, "", "A b a", "b c d e " * 60, "B\tb", "zz yy"] * 5)}
    df = spark.createDataFrame([(i, t) for i, t in texts.items()], "row long, text string")
    got = {r.row: r for r in lmscore.score(df, F.crc32(F.col("row").cast("string")) % 7 != 2).collect()}
    tokens = {i: [*WORD.findall(fold(t)), None] for i, t in texts.items()}
    c = Counter(w for i, ws in tokens.items() if zlib.crc32(str(i).encode()) % 7 != 2 for w in ws)
    n, v = sum(c.values()), len(c)
    for i, ws in tokens.items():
        r = got[i]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(ws), sum(c[w] > 0 for w in ws), n)
        assert math.isclose(r.base_score, sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws))
        assert r.score < 0


def test_held_out_texts_beat_word_counts(spark):
    rows = lmscore.op4_lm_scoring(spark, "/root/testdata/sf0.01").where("held_out").collect()
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows)


def test_scores_without_an_id(spark):
    df = spark.createDataFrame([(None, "a b"), (1, "a b"), (None, None)], "row long, text string")
    got = lmscore.score(df, F.lit(True)).collect()
    assert sorted((r.row is None, r.n_tokens) for r in got) == [(False, 3), (True, 1), (True, 3)]
    assert len({round(r.score, 9) for r in got if r.n_tokens == 3}) == 1


def test_probabilities_of_ids_sum_to_one():
    m = lmscore.Model(np.random.default_rng(2).integers(0, 90, lmscore.IDS))
    at = np.array([0, 41])
    before = np.random.default_rng(3).integers(0, lmscore.IDS, 41)
    x, live, _, _ = lmscore.windows(before, at)
    z, _ = m.net.forward(x, live)
    whole = np.exp(z[:, :, m.of[np.arange(lmscore.IDS)]] + m.share).sum(2)
    assert np.allclose(whole, 1, atol=1e-3)


def test_every_training_text_is_learnt_from(spark, monkeypatch):
    made, init = [], lmscore.Model.__init__

    def noted(self, counts):
        init(self, counts)
        made.append(self)

    monkeypatch.setattr(lmscore.Model, "__init__", noted)
    words = [bytes([97 + i // 26, 97 + i % 26]).decode() * 2 for i in range(600)]
    df = spark.createDataFrame([(i, f"{w} is {w}") for i, w in enumerate(words)], "row long, text string")
    lmscore.score(df, F.lit(True)).count()
    with open(lmscore.default_ranks(), "rb") as f:
        read = {x for s in lmscore.subwords(f.read(), words) for x in s}
    moved = (made[0].net.p["E"] != lmscore.Attention().p["E"]).any(1)
    assert len(read) > 300 and moved[sorted(read)].all()


def test_redaction_of_many_nested_spans(spark, monkeypatch):
    spans = [(0, 0, 200), *[(5 * i, 1, 5 * i + 3) for i in range(1, 31)]]
    found = "array(" + ",".join(f"named_struct('s',{s},'k',{k},'e',{e})" for s, k, e in spans) + ")"
    monkeypatch.setattr(pii, "detect", lambda df, precision: df.withColumn("spans", F.expr(found)))
    df = spark.createDataFrame([("x" * 200 + " end",)], "text string")
    assert pii.redact(df).first().text == f"[{pii.KINDS[0].upper()}] end"


def test_perspectives(spark):
    rows = [(1, 0, "system", "s"), (1, 1, "ann", "hi <|im_end|>"), (1, 2, "bob", None), (1, 300, "ann", "x"), (2, None, None, "y"), (2, None, None, "y")]
    out = chatformat.render(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    ann = sorted((r.segment, r) for r in out if r.perspective == "ann")
    assert [s for s, _ in ann] == [0, 1] and ann[1][1].base == ann[0][1].n_chars
    first = ann[0][1]
    assert [first.rendered[m.start : m.end] for m in first["mask"]] == ["hi < |im_end|><|im_end|>"]
    assert "user name=bob" in first.rendered and {r.perspective for r in out} == {"ann", "bob", "unknown"}
    assert [r.n_turns for r in out if r.perspective == "unknown"] == [2]


@pytest.mark.parametrize("n", [1, 2, 30, 300])
def test_suffix_array(n):
    r = random.Random(n)
    for k in (1, 2, 5, 200):
        x = np.array([r.randrange(k) for _ in range(n)], np.uint8)
        b = x.tobytes()
        assert suffix_array(x).tolist() == sorted(range(n), key=lambda i: b[i:])


@pytest.mark.parametrize("hot", [2, 2048])
def test_repeated_bytes(spark, monkeypatch, hot):
    monkeypatch.setattr(suffixdedup, "HOT", hot)
    r = random.Random(2)
    texts = [None, "", "a" * 99, "a" * 100, "a" * 101, "ab" * 300, "x" * 500 + "é😀" * 60]
    passage = "".join(r.choice("abcdefgh ") for _ in range(180))
    texts += ["".join(r.choice("abcdefgh ") for _ in range(80)) + passage + "".join(r.choice("abcdefgh ") for _ in range(80)) for _ in range(25)]
    rows = list(enumerate(texts)) + [(31, texts[31]), (40, texts[30])]
    got = {x.doc_id: x for x in suffixdedup.remove(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    seen = set()
    for d, t in sorted(dict(rows).items()):
        b = (t or "").encode()
        gone = bytearray(len(b))
        for i in range(len(b) - 99):
            w = b[i : i + 100]
            if w in seen:
                gone[i : i + 100] = b"\1" * 100
            seen.add(w)
        kept = bytes(c for c, g in zip(b, gone, strict=True) if not g)
        runs = sum(1 for i in range(len(gone)) if gone[i] and (not i or not gone[i - 1]))
        assert (got[d].n_bytes, got[d].n_removed, got[d].n_spans, bytes(got[d].kept)) == (len(b), sum(gone), runs, kept)


def test_several_texts_of_one_id(spark):
    r = random.Random(6)
    p, q = ("".join(r.choice("abcdefghijkl ") for _ in range(400)) for _ in "pq")
    rows = [(1, p), (2, "zzz " + p + " tail"), (2, q), (None, p)]
    out = suffixdedup.remove(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert all(bytes(x.kept).decode() == q for x in out if x.n_bytes == 400 and x.doc_id == 2)
    assert sum(x.n_removed for x in out) in (0, 400)  # of the longer text of document 2, if it is the one


def test_masks_hit_all_pairs_of_substitutions():
    from itertools import combinations

    for gone in combinations(range(decontaminate.STRETCH), 2):
        assert any(not {i + s for i in m} & set(gone) for m in decontaminate.MASKS for s in range(decontaminate.STRETCH - m[-1]))


def test_decontamination(spark):
    item = [f"t{i}" for i in range(30)]
    changed = [w if i % 10 else "X" for i, w in enumerate(item)]
    docs = [(1, "a b " + " ".join(item)), (2, " ".join(changed) + " c"), (3, " ".join(item[:9])), (4, None), (5, "short item here"), (6, ""), (6, "")]
    bench = spark.createDataFrame([(1, " ".join(item)), (2, "SHORT item"), (3, None), (4, "")], "item_id long, text string")
    df = spark.createDataFrame(docs, "doc_id long, text string")
    for words in (1 << 20, 20):  # one block or several
        got = {r.doc_id: {x.item_id for x in r._overlaps} for r in decontaminate.overlaps(df, bench, words).collect()}
        assert got == {1: {1}, 2: {1}, 3: set(), 4: set(), 5: {2}, 6: set()}
    assert decontaminate.clean(df, bench.limit(0)).count() == len(docs)


def test_every_overlap_of_an_alignment(spark):
    item = [f"t{i}" for i in range(60)]
    text = " ".join(w if not 20 <= i < 40 else f"other{i}" for i, w in enumerate(item))
    bench = spark.createDataFrame([(7, " ".join(item))], "item_id long, text string")
    out = decontaminate.overlaps(spark.createDataFrame([(1, "x y " + text)], "doc_id long, text string"), bench).first()._overlaps
    assert [(x.item_id, x.start, x.end, x.matched) for x in out] == [(7, 2, 22, 20), (7, 42, 62, 20)]


def test_overlaps_of_random_substitutions(spark):
    """Every stretch of 13 equal or twice substituted words is found, and nothing else is."""
    r = random.Random(3)
    items = {i: [f"i{i}w{k}" for k in range(40)] for i in range(8)}
    docs, want = [], {}
    for d in range(60):
        i, a = r.randrange(8), r.randrange(25)
        part = list(items[i][a : a + 15])
        for k in r.sample(range(1, 14), d % 3):
            part[k] = f"z{r.random()}"
        noise = [f"n{r.random()}" for _ in range(30)]
        docs.append((d, " ".join(noise[:15] + part + noise[15:]) if d % 4 else " ".join(noise)))
        want[d] = {i} if d % 4 else set()
    bench = spark.createDataFrame([(i, " ".join(x)) for i, x in items.items()], "item_id long, text string")
    got = {x.doc_id: {y.item_id for y in x._overlaps} for x in decontaminate.overlaps(spark.createDataFrame(docs, "doc_id long, text string"), bench).collect()}
    assert got == want


def test_every_placement_of_two_substitutions():
    """13 to 20 words of an item within foreign text, any up to two of them replaced: all are found, and as one overlap with all equal words."""
    from itertools import combinations

    r = np.random.default_rng(5)
    item = r.integers(1, 1 << 60, 20).astype(np.uint64)
    for n in range(13, 21):
        index = decontaminate.Index(np.array([1]), item, np.array([0, 20]))
        gone = [g for k in range(3) for g in combinations(range(n), k)]
        texts = r.integers(1, 1 << 60, (len(gone), n + 20)).astype(np.uint64)
        for row, g in zip(texts, gone, strict=True):
            row[10 : 10 + n] = item[:n]
            row[[10 + i for i in g]] += np.uint64(1)
        found = index.hits(texts.ravel(), np.arange(len(gone) + 1) * (n + 20))
        assert all(len(x) == 1 and x[0]["matched"] == n - len(g) for x, g in zip(found, gone, strict=True))
    clean = r.integers(1, 1 << 60, 5000).astype(np.uint64)
    clean[100:108] = item[4:12]  # eight words are no overlap
    assert decontaminate.Index(np.array([1]), item, np.array([0, 20])).hits(clean, np.array([0, 5000])) == [[]]


def test_importance_weights(spark):
    """The log weight is the sum of log ratios of word and pair counts, counted here by dictionaries."""
    r = random.Random(4)
    texts = {i: " ".join(r.choice("abcdefg") for _ in range(r.randrange(1, 30))) for i in range(40)}
    labels = spark.createDataFrame([(i, int(i % 4 == 0), 0) for i in range(40)], "doc_id long, quality int, toxic int")
    grams = {i: [*t.split(), *zip(t.split(), t.split()[1:])] for i, t in texts.items()}
    every, good = Counter(g for x in grams.values() for g in x), Counter(g for i, x in grams.items() if i % 4 == 0 for g in x)
    ratio = {g: math.log((good[g] + 1) / (sum(good.values()) + resample.BUCKETS)) - math.log((every[g] + 1) / (sum(every.values()) + resample.BUCKETS)) for g in every}
    rows = resample.resample(spark.createDataFrame(list(texts.items()), "doc_id long, text string"), labels).collect()
    for x in rows:
        assert math.isclose(x.log_weight, sum(ratio[g] for g in grams[x.doc_id]), abs_tol=1e-9)
    kept = sorted((x.gumbel_key for x in rows), reverse=True)[:10]
    assert sorted((x.gumbel_key for x in rows if x.kept), reverse=True) == kept
    out = resample.resample(spark.createDataFrame([(None, f"t{i}") for i in range(50)], "doc_id long, text string"), labels.limit(0))
    assert len({x.gumbel_key for x in out.collect()}) == 50


def test_resampling(spark):
    good, bad = "the cat sat on the mat", "buy $$$ now !!! click $$$"
    docs = spark.createDataFrame([(i, good if i % 2 else bad) for i in range(200)] + [(None, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(100)], "doc_id long, quality int, toxic int")
    out = resample.resample(docs, labels).collect()
    kept = [r for r in out if r.kept]
    assert abs(len(kept) - 100) <= 1 and sum(r.doc_id is not None and r.doc_id % 2 for r in kept) >= 99
    keyed = spark.range(5000).select(F.rand(3).alias("key"))
    keyed = keyed.cache()
    values = sorted((r.key for r in keyed.collect()), reverse=True)
    assert resample.top_k(keyed, 1234, few=50) == values[1233]


def test_quality_ledger(spark, odd):
    rows = {r.doc_id: r for r in qualityrules.apply_policy(qualityrules.ledger(odd)).collect()}
    assert rows[6].n_repeat_words == 30000 and rows[5].n_dup_lines == 1 and rows[None].n_words == 0 and not rows[None].kept
    cut = {r.rule: r for r in qualityrules.ablation(qualityrules.ledger(odd)).collect()}
    assert cut["few_words"].n_failed == odd.count() - 1


def test_digest_of_base_spans(spark, tmp_path):
    spark.createDataFrame([(1, "x a@b.co 10.0.0.1")], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    r = pii.op3_pii(spark, str(tmp_path)).first()
    assert r.base_sha256 == hashlib.sha256(b"email:2:8,ip:9:17").hexdigest() and (r.n_email, r.n_ip) == (1, 1)


def test_pipeline_stages_on_odd_rows(spark, odd, tmp_path):
    import corpus_pipeline

    spark.createDataFrame([(1, "nothing of this kind")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = odd.drop("score", "n").withColumn("base", F.lit(1)).withColumn("ids", F.lit("clash"))
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        if name != "token_ids":
            assert out.columns == docs.columns
        out.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
    assert docs.where("NOT round_trip").count() == 0
    assert docs.count() < odd.count()


def test_empty_tables(spark, odd):
    none = odd.limit(0)
    text = none.select("doc_id", "text")
    assert ngramjoin.near_duplicates(text).count() == 0
    assert suffixdedup.remove(text).count() == 0
    assert pieces.encode(text).count() == 0
    assert pii.detect(text).count() == 0
    assert qualityrules.ledger(text).count() == 0
    assert lmscore.score(none.select(F.col("doc_id").alias("row"), "text"), F.lit(True)).count() == 0
    assert langid.train(none) is None


def test_stage_of_near_duplicates_leaves_texts_in_place(spark, tmp_path):
    """Only texts of documents that go, or of repeated ids, are shuffled; of repeated ids the row of least hash stays."""
    import random

    import corpus_pipeline

    rnd = random.Random(5)
    text = lambda: " ".join("%032x" % rnd.getrandbits(128) for _ in range(100))
    one = {i: text() for i in range(600)}
    rows = [(i, t) for i, t in one.items()] + [(1000, one[3] + " more"), (1001, one[4]), (1002, text()), (1002, text()), (1003, "a b"), (1003, "a b"), (None, text()), (None, one[5])]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/docs")
    docs = spark.read.parquet(f"{tmp_path}/docs")
    used = lambda: spark.sparkContext._jsc.sc().statusStore().executorList(True).apply(0).totalShuffleWrite()
    before = used()
    got = [(r.doc_id, r.text) for r in corpus_pipeline.near_duplicates(spark, docs, "").collect()]
    assert used() - before < sum(len(t) for t in one.values())
    assert sorted(i for i, _ in got if i is not None) == [*range(600), 1002, 1003]
    assert all(t == one[i] for i, t in got if i in one) and sum(i is None for i, _ in got) == 2
    both = docs.where("doc_id = 1002").selectExpr("text", "xxhash64(struct(doc_id, text)) AS h").orderBy("h").first().text
    assert dict(got)[1002] == both


def test_logs_of_targets_are_those_of_all_classes():
    m = lmscore.Model(np.random.default_rng(2).integers(0, 90, lmscore.IDS))
    ids = np.random.default_rng(3).integers(0, lmscore.IDS, 300)
    x, live, target, _ = lmscore.windows(ids, np.array([0, 41, 41, 300]))
    z, _ = m.net.forward(x, live)
    every = np.take_along_axis(z, m.of[target][..., None], 2)[..., 0]
    assert np.allclose(m.net.logs_of(x, live, m.of[target]), every, atol=1e-5)
