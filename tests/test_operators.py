import random
import re

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tarnweave.functions import codes
from tarnweave.operators import linkage, lookup, network, vectors
from tarnweave.operators.components import components
from tarnweave.operators.records import merge_lots, upsert
from tarnweave.sources import adapters
from tarnweave.sources.paging import balanced_ranges, keyset_page


def test_components_match_union_find(spark):
    r = random.Random(3)
    edges = [(r.randrange(200), r.randrange(200)) for _ in range(150)] + [(i, i + 1) for i in range(300, 340)]
    got = {x.node: x.component for x in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    assert got == {x: find(x) for x in root}


def test_components_without_edges(spark):
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_fuzzy_pairs_lose_nothing(spark):
    r = random.Random(5)
    names = ["alphabeta company", "alphabeta compny", "alphabeta companyx", "alp", "alp", "alphabetical", ""]
    for _ in range(80):
        x = list("alphabeta gamma delta"[: r.randrange(8, 21)])
        for _ in range(r.randrange(4)):
            x[r.randrange(3, len(x))] = r.choice("abcde")
        names.append("".join(x))
    df = spark.createDataFrame(list(enumerate(names)), "id long, name string")
    got = {(x.a, x.b) for x in linkage.fuzzy_pairs(df).collect()}
    a, b = df.alias("a"), df.alias("b")
    near = codes.near_names(F.col("a.name"), F.col("b.name")) & (F.substring("a.name", 1, 3) == F.substring("b.name", 1, 3))
    want = {(x[0], x[1]) for x in a.join(b, (F.col("a.id") < F.col("b.id")) & near).select("a.id", "b.id").collect()}
    assert got == want


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, 30), min_size=1, max_size=40), st.integers(1, 60))
def test_balanced_ranges_cover_disjointly(sizes, most):
    import datetime as dt

    first = dt.date(2024, 1, 1)
    days = {first + dt.timedelta(days=i): n for i, n in enumerate(sizes) if n}
    out = balanced_ranges(days, first, first + dt.timedelta(days=len(sizes) - 1), most)
    assert sum(n for _, _, n in out) == sum(sizes)
    assert all(a[1] < b[0] for a, b in zip(out, out[1:], strict=False))
    assert all(n <= most or a == b for a, b, n in out)


def test_keyset_pages_cover_all(spark):
    df = spark.createDataFrame([(i // 3, i) for i in range(20)], "a int, b int")
    seen, after = [], None
    while rows := keyset_page(df, ["a", "b"], after, 7).collect():
        seen += [(r.a, r.b) for r in rows]
        after = (rows[-1].a, rows[-1].b)
    assert seen == [(i // 3, i) for i in range(20)]


def test_upsert_twice_changes_nothing(spark):
    old = spark.createDataFrame([(1, "a", True), (2, "b", True)], "k int, v string, done boolean")
    new = spark.createDataFrame([(2, "c", False), (3, "d", False)], "k int, v string, done boolean")
    once = upsert(old, new, "k", keep_flag="done")
    rows = {tuple(r) for r in once.collect()}
    assert rows == {(1, "a", True), (2, "c", True), (3, "d", False)}
    assert {tuple(r) for r in upsert(once, new, "k", keep_flag="done").collect()} == rows


def test_communities_of_two_cliques(spark):
    edges = [(a, b, 1.0) for k in (0, 10) for a in range(k, k + 5) for b in range(a + 1, k + 5)] + [(4, 10, 1.0)]
    got = {r.node: r.community for r in network.communities(spark.createDataFrame(edges, "a long, b long, w double")).collect()}
    assert len({got[i] for i in range(5)}) == 1 and len({got[i] for i in range(10, 15)}) == 1 and got[0] != got[10]


def test_local_moving_settles(spark):
    r = random.Random(5)
    edges = [(i, i + 1, 1.0 + r.randrange(5)) for i in range(40)]
    found = network.communities(spark.createDataFrame(edges, "a long, b long, w double"), levels=1, patience=1)
    of = {x.node: x.community for x in found.collect()}
    total = sum(w for *_, w in edges)
    inside = sum(w for a, b, w in edges if of[a] == of[b])
    volume = {}
    for a, b, w in edges:
        for n in (a, b):
            volume[of[n]] = volume.get(of[n], 0.0) + w
    assert inside / total - sum(v * v for v in volume.values()) / (2 * total) ** 2 > 0.69  # four rounds reach 0.5


def test_zero_vector_has_cosine_zero(spark):
    df = spark.createDataFrame([([0.0, 0.0], [1.0, 0.0]), ([3.0, 4.0], [3.0, 4.0])], "a array<double>, b array<double>")
    assert [round(r[0], 9) for r in df.select(vectors.cosine(F.col("a"), F.col("b"))).collect()] == [0.0, 1.0]


def _notice(**kw):
    item = {"cig": "C1", "descrizione": "x", "aggiudicatari_ad": [{"importo": 5.0, "soggetti": [{"codice_fiscale": "IT12345678903", "denominazione": "Beta"}]}]} | kw.pop("item", {})
    sections = [
        {"name": "SEZ. A - ente", "fields": {"soggetti_sa": [{"codice_fiscale": "00743110157", "denominazione_amministrazione": "Comune"}]}},
        {"name": "SEZ. C - lotti", "fields": {"documenti_di_gara_link": "https://e.org"}, "items": [item, {"descrizione": "no lot"}]},
    ]
    return {"idAvviso": "n1", "codiceScheda": "AD3", "dataPubblicazione": "2024-05-01T10:00:00", "template": [{"template": {"metadata": {}, "sections": sections}}]} | kw


def test_notice_adapter(spark):
    import json

    raw = [_notice(), _notice(idAvviso="n2", codiceScheda="M1", nuovoAvviso="n1", item={"aggiudicatari": []})]
    df = spark.createDataFrame([(json.dumps(x),) for x in raw], "j string").select(F.from_json("j", adapters.NOTICE).alias("r")).select("r.*")
    a, b = adapters.notices(df).orderBy("avviso.idAvviso").collect()
    assert (a.stadio, a.procedura, a.dataPubblicazione, a.stazioneAppaltante.cf) == ("award", "affidamento_diretto", "2024-05-01", "00743110157")
    assert a.aggiudicazioni[0].impresa.cf == "12345678903" and a.link.piattaforma == "https://e.org"
    assert b.stadio == "amendment" and b.aggiudicazioni == []  # an empty list hides the direct award


def test_release_adapter_and_merge(spark):
    import json

    rel = {
        "id": "r1", "ocid": "o1", "date": "2024-06-02T00:00:00Z", "tag": ["award"],
        "parties": [{"id": "p1", "name": "Ente", "identifier": {"id": "00743110157"}, "roles": "buyer;payer"}, {"id": "p2", "name": "Beta", "identifier": {"id": "12345678903"}, "roles": ["supplier"]}],
        "awards": [{"status": "active", "value": {"amount": 1.0}, "suppliers": [{"id": "p2"}], "relatedLots": ["C1"]}, {"status": "active", "value": {"amount": 9.0}, "suppliers": [{"id": "p2"}], "relatedLots": ["C1"]}],
        "tender": {"description": "d", "mainProcurementCategory": "works", "procurementMethodDetails": "X TITLE:PROCEDURA APERTA", "items": [{"id": "C1", "classification": {"scheme": "CPV", "id": "99999999"}}, {"id": "C1", "description": "second"}]},
    }
    df = spark.createDataFrame([(json.dumps(rel),)], "j string").select(F.from_json("j", adapters.RELEASE).alias("r")).select("r.*")
    one = adapters.releases(df)
    r = one.first()
    assert (r.cig, r.stadio, r.natura, r.procedura, r.cpv, r.oggetto) == ("C1", "award", "Lavori", "procedura aperta", [], "d")
    assert r.aggiudicazioni[0].importo == 9.0 and r.stazioneAppaltante.denominazione == "Ente"
    raw = spark.createDataFrame([(json.dumps(_notice()),)], "j string").select(F.from_json("j", adapters.NOTICE).alias("r")).select("r.*")
    both = adapters.notices(raw).unionByName(one)
    order = F.when(F.col("fonte") == "pl", 1).otherwise(2)
    lot = merge_lots(both, order).first()
    assert (lot.cig, lot.oggetto, lot.natura, lot._sources) == ("C1", "x", "Lavori", ["pl", "ocds"])
    assert len(lot.aggiudicazioni) == 1 and len(lot.avvisi) == 2 and lot.garaId.ocds == "o1"
    assert merge_lots(both.union(both), order).first() == lot


def test_only_reading_sql(spark):
    from tarnweave.operators.lookup import is_reading

    assert is_reading(spark, "WITH a AS (SELECT 1 x) SELECT x, 'set or drop' FROM a WHERE x IN (SELECT 1) ORDER BY x LIMIT 3")
    for text in ("DROP TABLE x", "INSERT INTO a SELECT 1", "CREATE VIEW v AS SELECT 1", "SET a = b", "nonsense"):
        assert not is_reading(spark, text)


@pytest.mark.parametrize(
    "text",
    [
        "SELECT java_method('java.lang.System', 'getProperty', 'user.dir')",
        "SELECT reflect('java.lang.System', 'exit', '0') FROM guarded",
        "SELECT id FROM guarded WHERE id > (SELECT length(java_method('java.lang.System', 'getProperty', 'user.dir')))",
        "WITH x AS (SELECT try_reflect('java.lang.System', 'exit', '0')) SELECT * FROM x",
        "SELECT * FROM parquet.`/etc`",
        "SELECT * FROM text.`/etc/passwd`",
        "SELECT * FROM unknown_table",
        "SELECT * FROM range(5)",
        "DROP TABLE guarded",
    ],
)
def test_statements_that_do_more_than_read_are_refused(spark, text):
    spark.range(3).createOrReplaceTempView("guarded")
    with pytest.raises(PermissionError):
        lookup.run_sql(spark, text)


def test_reading_statements(spark):
    spark.range(3).createOrReplaceTempView("guarded")
    out = lookup.run_sql(spark, "WITH x AS (SELECT id, upper('a') AS u FROM guarded WHERE id IN (SELECT max(id) FROM guarded)) SELECT count(*) AS n, sum(id) AS s FROM x")
    assert out.first().n == 1 and out.first().s == 2


def test_checkpoint_folder_is_required_on_a_cluster(monkeypatch):
    from types import SimpleNamespace

    from tarnweave.plans import durable

    sc = SimpleNamespace(getCheckpointDir=lambda: None, master="yarn")
    with pytest.raises(ValueError):
        durable.shared_dir(SimpleNamespace(sparkContext=sc, conf=SimpleNamespace(get=lambda *a: None)))


def modularity_of(edges, of):
    """By SQL over the returned labels."""
    con = duckdb.connect()
    con.execute("CREATE TABLE e (a BIGINT, b BIGINT, w DOUBLE)")
    con.execute("CREATE TABLE l (n BIGINT, c BIGINT)")
    con.executemany("INSERT INTO e VALUES (?, ?, ?)", edges)
    con.executemany("INSERT INTO l VALUES (?, ?)", list(of.items()))
    return con.execute(
        "WITH u AS (SELECT a, b, w FROM e UNION ALL SELECT b, a, w FROM e), t AS (SELECT sum(w) AS t FROM u), "
        "j AS (SELECT x.c AS ca, y.c AS cb, w FROM u JOIN l x ON a = x.n JOIN l y ON b = y.n), "
        "v AS (SELECT ca, sum(w) AS v, coalesce(sum(w) FILTER (ca = cb), 0) AS i FROM j GROUP BY 1) SELECT sum(i) / max(t) - sum(v * v) / max(t) ** 2 FROM v, t"
    ).fetchone()[0]


@pytest.mark.parametrize(("block", "hub"), [(1 << 18, 1 << 16), (200, 1 << 16), (200, 25)])
def test_modularity_of_planted_communities(spark, block, hub):
    """In one block, in many, and with hubs: about as good as the planted partition, and the figure returned is that of SQL."""
    r = random.Random(9)
    edges = {}
    for a in range(120):
        for b in range(a + 1, 120):
            if r.random() < (0.35 if a // 15 == b // 15 else 0.01) or a == 0 and b % 4 == 0:
                edges[a, b] = float(r.randrange(1, 4))
    edges = [(*k, w) for k, w in edges.items()]
    df = spark.createDataFrame(edges, "a long, b long, w double")
    found = network.communities(df, block=block, hub=hub)
    of = {x.node: x.community for x in found.collect()}
    q = network.partition_quality(df, spark.createDataFrame(list(of.items()), "node long, community long")).first()
    assert abs(q.modularity - modularity_of(edges, of)) < 1e-9 and q.communities == len(set(of.values()))
    assert q.modularity > modularity_of(edges, {n: n // 15 for n in of}) - 0.05


def test_profile_of_communities(spark):
    found = spark.createDataFrame([(1, 1), (2, 1), (3, 1), (4, 4)], "node long, community long")
    kinds = spark.createDataFrame([(1, "x"), (2, "y"), (3, "y"), (4, "x")], "node long, kind string")
    assert sorted(map(tuple, network.profile(found, kinds).collect())) == [(1, 3, "x", 1), (1, 3, "y", 2), (4, 1, "x", 1)]


def test_loads_with_nulls(spark):
    from pyspark.sql import functions as F

    from tarnweave.operators import loads

    rows = spark.createDataFrame([(1, "a", None), (2, "", "x"), (None, "b", "y"), (4, None, "z")], "id int, b string, link string")
    assert [r.link for r in loads.complete(rows, ["id", "b"], {"link": "none"}).collect()] == ["none"]
    found = spark.createDataFrame([(1, "q"), (1, "p"), (2, "n"), (None, "m")], "id int, link string")
    out = {(r.id, r.link) for r in loads.backfilled(rows, found, "id", "link").collect()}
    assert out == {(1, "p"), (2, "x"), (None, "y"), (4, "z")}
    assert loads.backfilled(rows.limit(0), found, "id", "link").count() == 0
    draws = rows.select(loads.seeded(F.col("id"), 1).alias("d"), "id").collect()
    assert all((r.d is None) == (r.id is None) and (r.d is None or 0 <= r.d < 1) for r in draws)
    said = spark.createDataFrame([(None, "same"), (" SAME ", "same"), ("same", "diff"), ("?", "same"), ("diff", "diff")], "h string, v string")
    assert [r[0] for r in said.select(loads.agreement(F.col("h"), F.col("v"))).collect()] == ["other", "agree", "name_misled", "code_found", "agree"]


def test_fuzzy_pairs_lose_none_of_many_edits(spark):
    r = random.Random(5)
    base = ["Acme trading 001", "Acme trading 002x", "Acmegamma", "aaaaaaaaaaaa", "Acm"]
    names = []
    for i in range(160):
        x = list(r.choice(base))
        for _ in range(r.randrange(4)):
            at = r.randrange(len(x) + 1)
            x[at : at + r.randrange(2)] = r.choice(["", "a", "1", "é", "𝒳"])
        names.append((i, "".join(x)))
    names += [(160, None), (161, ""), (None, "Acme trading 001")]

    def edits(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            last, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
        return row[-1]

    def near(a, b):
        short = min(len(a), len(b))
        return a == b or (a[:3] == b[:3] and short >= 8 and edits(a, b) <= min(2, 0.2 * short))

    known = [(i, x) for i, x in names if i is not None and x]
    want = {(i, j) for i, x in known for j, y in known if i < j and near(x, y)}
    got = [(x.a, x.b) for x in linkage.fuzzy_pairs(spark.createDataFrame(names, "id long, name string")).collect()]
    assert len(got) == len(set(got)) and set(got) == want


def test_nearest_ties_nulls_and_blocks(spark):
    rows = [(i, [1.0, 0.0]) for i in range(40)] + [(40, [0.0, 1.0]), (41, None), (42, [0.0, 0.0]), (43, [2.0, 2.0])]
    v = spark.createDataFrame(rows, "id long, embedding array<float>").repartition(5)
    for block in (1, 4096):
        found = vectors.nearest(v, v.where("id IN (7, 40, 41, 42)"), 3, block=block).collect()
        got = {q: [(x.id, round(x.score, 6)) for x in sorted(found, key=lambda x: x["rank"]) if x.query == q] for q in (7, 40, 41, 42)}
        assert got[7] == [(0, 1.0), (1, 1.0), (2, 1.0)]
        assert got[40] == [(40, 1.0), (43, 0.707107), (0, 0.0)]
        assert got[41] == [] and got[42] == [(0, 0.0), (1, 0.0), (2, 0.0)]
    assert vectors.nearest(v.where("id < 0"), v, 3).count() == 0 and vectors.nearest(v, v.where("id < 0"), 3).count() == 0


def test_lists_find_what_exact_search_finds(spark):
    r = random.Random(2)
    rows = [(i, [((i % 12 == d) * 4 + r.gauss(0, 0.3)) for d in range(12)], i % 2) for i in range(600)] + [(600, None, 0), (601, [0.0] * 12, 1)]
    v = spark.createDataFrame(rows, "id long, embedding array<float>, label int").repartition(4)
    q = v.where("id % 25 = 0 AND id < 600")
    lists = vectors.fit_lists(v)
    exact, found = vectors.nearest(v, q, 5), vectors.approximate(v, q, 5, lists)
    assert vectors.recall(found, exact).first().recall >= 0.9
    assert vectors.compared_share(v, q, lists).first().share < 0.5
    odd = vectors.search(v, q, 5, lists, F.col("label") == 1)
    assert {x.id % 2 for x in odd.collect()} == {1} and vectors.search(v, q, 5).exceptAll(exact).isEmpty()
    at = {x.id: x.list for x in vectors.indexed(v, lists).collect()}
    assert at[600] is None and all(at[i] is not None for i in range(600))
    assert vectors.approximate(v.where("id < 0"), q, 5).count() == 0


def test_percentile_floor_is_the_element_at_floor(spark):
    r = random.Random(4)
    groups = {n: sorted(float(r.randrange(12)) for _ in range(n)) for n in range(1, 31)}
    df = spark.createDataFrame([(n, x) for n, xs in groups.items() for x in xs] + [(0, None), (5, None)], "n int, x double")
    shares = (0.0, 0.1, 0.25, 0.3, 0.5, 0.7, 0.75, 0.9, 1.0)
    out = df.groupBy("n").agg(*[codes.percentile_floor("x", p).alias(f"p{i}") for i, p in enumerate(shares)]).collect()
    from fractions import Fraction

    for row in out:
        xs = groups.get(row.n)
        want = [None if xs is None else xs[min(row.n - 1, int(Fraction(str(p)) * row.n))] for p in shares]
        assert list(row)[1:] == want


def test_names_that_begin_alike_are_no_hot_block(spark):
    """A thousand names with one common beginning: candidates stay near the pairs found, and no key is common."""
    names = spark.range(1000).select("id", F.format_string("Supplier#%09d", "id").alias("name"))
    classes = linkage.name_classes(names)
    met, near = linkage.candidates(classes).count(), linkage.near_classes(classes).count()
    assert near <= met < 1.5 * near
    keys = classes.select(F.explode(linkage._left_out(F.col("name"), 2, False)).alias("key"))
    largest = keys.groupBy("key").count().agg(F.max("count")).first()[0]
    assert largest < 0.01 * keys.count()


def test_equal_names_are_classes(spark):
    rows = [(i, "one and the same name") for i in range(50)] + [(50, "one and the same nam"), (51, "another name"), (52, "another name"), (53, None)]
    names = spark.createDataFrame([(i, x, i % 2) for i, x in rows], "id long, name string, part int")
    assert {(r["class"], r.members) for r in linkage.name_classes(names).collect()} == {(0, 50), (50, 1), (51, 2)}
    edges = [tuple(r) for r in linkage.name_edges(names).collect()]
    assert len(edges) == 49 + 1 + 1 and {x.cluster for x in linkage.clusters(names, linkage.name_edges(names)).collect()} == {0, 51, 53}
    assert linkage.fuzzy_pairs(names).count() == 50 * 49 // 2 + 50 + 1
    assert linkage.fuzzy_pairs(names, within=("part",)).count() == 2 * (25 * 24 // 2) + 25


@pytest.mark.parametrize("common", [0, 1 << 10])
def test_common_parts_lose_no_pair(spark, monkeypatch, common):
    r = random.Random(8)
    names = sorted({"".join(r.choice("ab") for _ in range(r.randrange(8, 12))) for _ in range(150)})
    df = spark.createDataFrame(list(enumerate("abc" + x for x in names)), "id long, name string")
    classes = linkage.name_classes(df)
    for edit in (1, 2, 3):
        near = codes.near_names(F.col("a_name"), F.col("b_name"), edit=edit)
        got = {(x.a, x.b) for x in linkage.candidates(classes, edit=edit, common=common).where(near).collect()}
        a, b = df.select(F.col("id").alias("a"), F.col("name").alias("a_name")), df.select(F.col("id").alias("b"), F.col("name").alias("b_name"))
        assert got == {(x.a, x.b) for x in a.join(b, F.col("a") < F.col("b")).where(near).collect()}


@pytest.mark.parametrize("spread", [0.3, None])
def test_coded_search_finds_most_and_compares_few(spark, spread):
    """Clustered and even vectors; null and zero ones; a filter before the search."""
    import numpy as np

    r = np.random.default_rng(4)
    x = r.normal(size=(1500, 32))
    if spread:
        x = r.normal(size=(12, 32))[r.integers(0, 12, 1500)] + spread * x
    rows = [(i, y.tolist(), i % 4) for i, y in enumerate(x)] + [(2000, None, 0), (2001, [0.0] * 32, 0)]
    v = spark.createDataFrame(rows, "id long, embedding array<double>, kind int")
    codes = vectors.fit_codes(v)
    index, q = vectors.coded(v, codes), v.where("id % 50 = 0 AND id < 1500")
    assert index.where("code IS NULL").count() == 1
    got = vectors.search_coded(index, v, q, 10, codes, candidates=100, block=7)
    assert vectors.recall(got, vectors.nearest(v, q, 10)).first().recall >= 0.9  # 100 of 1502: 0.07 of all pairs
    only = vectors.search_coded(index, v, q, 10, codes, candidates=100, where=F.col("kind") == 1).join(v.select("id", "kind"), "id")
    assert only.count() == 300 and only.where("kind <> 1").isEmpty()
    assert vectors.recall(only.select("query", "id"), vectors.nearest(v.where("kind = 1"), q, 10)).first().recall >= 0.95


def test_fuzzy_words_equal_a_full_comparison(spark):
    r = random.Random(11)
    names = [" ".join("".join(r.choice("abcé") for _ in range(r.randrange(1, 6))) for _ in range(r.randrange(4))) for _ in range(120)] + [None, "a", "ab-ab"]
    df = spark.createDataFrame([(i, x, i % 5) for i, x in enumerate(names)], "id long, name string, wins int")
    own = {i: [w for w in re.split(r"[\W_]+", x or "") if w] for i, x in enumerate(names)}

    def edits(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            last, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
        return row[-1]

    for text in ("abca", "ab cab", "aa aa bcé", "x"):
        words, want = lookup.tokens(text), []
        for i, ws in own.items():
            best = [min(((edits(w, q), max(len(w), len(q))) for w in ws), default=(9, 1)) for q in words]
            if words and all(d <= 2 for d, _ in best):
                want.append((-round(sum(1 - d / m for d, m in best) / len(words), 6), -(i % 5), i))
        got = [(-x.score, -x.wins, x.id) for x in lookup.search(df, text, k=1000).collect()]
        assert got == sorted(want)
    keys, _ = lookup.token_index(spark.range(2000).select("id", F.concat(F.lit("firm "), F.sha2(F.col("id").cast("string"), 256)).alias("name")))
    asked = spark.createDataFrame([("fimr",)], "word string")
    assert [x.token for x in lookup.near_tokens(keys, asked).collect()] == ["firm"]  # one of 2001 tokens compared


def test_leaves_of_any_json(spark):
    import json

    from tarnweave.sources.trees import leaves

    r = random.Random(12)
    value = lambda d: r.choice([lambda: r.randrange(9), lambda: None, lambda: "ab", lambda: [value(d + 1) for _ in range(r.randrange(4))] if d < 5 else 1, lambda: {k: value(d + 1) for k in "zay"[: r.randrange(4)]} if d < 5 else 2])()
    docs = {i: {"k": value(0), "m": value(0)} for i in range(40)}

    def walk(x, name):
        if isinstance(x, dict):
            return [y for k, v in x.items() for y in walk(v, k)]
        if isinstance(x, list):
            return [y for v in x for y in walk(v, None)]
        return [] if x is None else [(name, str(x))]

    df = spark.createDataFrame([(i, json.dumps(d)) for i, d in docs.items()] + [(98, "no json"), (99, None)], "id long, text string")
    got = leaves(df, "id", "text").collect()
    for i in [*docs, 98, 99]:
        assert sorted(((x.name, x.value) for x in got if x.id == i), key=str) == sorted(walk(docs.get(i), None), key=str)


def test_gold_pairs_are_drawn_alike_and_spread(spark):
    from tarnweave.operators import goldset

    r = random.Random(13)
    rows = [(i, f"c{i % 7}", "same name of all") for i in range(300)] + [(300 + i, f"c{i % 9}", "alpha " + "".join(r.choice("abcd") for _ in range(6))) for i in range(300)]
    rows += [(600 + i, f"c{i}", r.choice(["betas", "gammas"]) + f" company {i % 40}") for i in range(100)] + [(None, "c", "nameless one"), (701, None, "nameless one"), (702, "c", "short"), (703, "c", None)]
    df = spark.createDataFrame(rows, "id long, code string, name string")
    code, name = {i: c for i, c, _ in rows}, {i: n for i, _, n in rows}
    one = sorted(map(tuple, goldset.gold_pairs(df).collect()))
    assert one == sorted(map(tuple, goldset.gold_pairs(df.repartition(7)).collect()))
    for band, a, b, dist, rel in one:
        assert code[a] != code[b] and abs(rel - dist / min(len(name[a]), len(name[b]))) < 1e-9
        assert {"EXACT": dist == 0, "NEAR": 1 <= dist <= 2, "MID": 3 <= dist <= 6, "FAR": name[a][:3] != name[b][:3]}[band]
    bands = [x[0] for x in one]
    assert bands.count("EXACT") == 12 and bands.count("FAR") == 8 and "NEAR" in bands and "MID" in bands
    for band in ("NEAR", "MID"):
        begins = [name[x[1]][:3] for x in one if x[0] == band]
        assert max(begins.count(p) for p in begins) <= 2


def test_rules_replace_their_own_findings(spark, tmp_path):
    from tarnweave.operators import anomalies

    of = lambda lots, severity: spark.createDataFrame([(x, 5, severity) for x in lots], "lot long, n int, severity string")
    path = f"{tmp_path}/findings"
    anomalies.run_rules({"x": of([1, 2, 3, 4], "low"), "y": of([9, 8], "high")}, path)
    anomalies.run_rules({"x": of([7, 5], "high")}, path)
    top = [(r.rule, r.lot, r["rank"]) for r in anomalies.worst(spark.read.parquet(path), 3).orderBy("rule", "rank").collect()]
    assert top == [("x", 5, 1), ("x", 7, 2), ("y", 8, 1), ("y", 9, 2)]
    anomalies.run_rules({"x": of([], "low")}, path)
    assert {r.rule for r in spark.read.parquet(path).collect()} == {"y"}


@settings(max_examples=15, deadline=None)
@given(sizes=st.lists(st.integers(0, 30), min_size=1, max_size=20), most=st.integers(1, 60))
def test_windows_equal_the_ranges(spark, sizes, most):
    import datetime as dt

    from tarnweave.sources.paging import windows

    first = dt.date(2024, 1, 1)
    days = {first + dt.timedelta(days=i): n for i, n in enumerate(sizes) if n}
    df = spark.createDataFrame([(d,) for d, n in days.items() for _ in range(n)], "d date")
    assert sorted(map(tuple, windows(df, "d", most).collect())) == (balanced_ranges(days, min(days), max(days), most) if days else [])


def test_exploded_keys_are_never_broadcast(spark):
    """Keys made of common names are some hundred a name, which no estimate of Spark's knows."""
    names = spark.createDataFrame([(i, f"Supplier#{i:09d}") for i in range(200)], "id long, name string")
    plan = linkage.candidates(linkage.name_classes(names), common=1)._jdf.queryExecution().optimizedPlan().toString()
    crowd = [x for x in plan.splitlines() if "Join Inner" in x and "key#" in x]
    assert crowd and all("strategy=merge" in x for x in crowd)


def test_counted_pairs_equal_listed_ones(spark):
    rows = [(i, f"company {i % 7} of town", f"c{i % 3}" if i % 5 else None, i % 4) for i in range(80)]
    df = spark.createDataFrame(rows, "id long, name string, code string, part long")
    listed = linkage.fuzzy_pairs(df, carry=("code",))
    for by in ((), ("code",)):
        counted = linkage.counted_pairs(df.select("id", "name", "code"), by)
        assert counted.agg(F.sum("n")).first()[0] == listed.count()
        assert counted.where("a_name = b_name").agg(F.sum("n")).first()[0] == listed.where("a_name = b_name").count()
    tiers = {(r.tier, r.n) for r in linkage.ceiling(df).groupBy("tier").agg(F.sum("n").alias("n")).collect()}
    assert tiers == {(r.tier, r["count"]) for r in linkage.resolve(df).groupBy("tier").count().collect()}
    for r in linkage.scaling(df, "part").collect():  # equal names count as many times as they occur
        some = df.where(F.col("part") < int(r.share * 4))
        assert (r.names, r.pairs) == (some.count(), linkage.fuzzy_pairs(some).where("a_name <> b_name").count())


def test_confusion_of_all_pairs_from_group_sizes(spark):
    import itertools

    rows = [(i % 3, f"n{i % 4}" if i % 6 else None, f"t{i % 5}" if i % 7 else None) for i in range(60)]
    got = linkage.exact_confusion(spark.createDataFrame(rows, "b long, name string, label string"), ["b"], "name", "label").first()
    want = {"tp": 0, "fp": 0, "fn": 0, "tn": 0}
    for x, y in itertools.combinations(rows, 2):
        if x[0] == y[0] and None not in (*x, *y):
            want[("t" if (x[1] == y[1]) == (x[2] == y[2]) else "f") + ("p" if x[1] == y[1] else "n")] += 1
    assert got.asDict() == want
    assert linkage.exact_confusion(spark.createDataFrame([], "b long, name string, label string"), ["b"], "name", "label").first().asDict() == dict.fromkeys(want, 0)


def test_merge_reads_contributions_twice_at_most(spark):
    raw = spark.createDataFrame([("{}",)], "j string").select(F.from_json("j", adapters.NOTICE).alias("r")).select("r.*")
    lots = merge_lots(adapters.notices(raw), F.struct("fonte", "avviso.idAvviso"))
    plan = lots._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") + plan.count("LocalRelation") + plan.count("Scan") <= 2 and plan.count("Join") == 1


def test_scores_of_a_task_are_bounded(spark):
    """A block of queries times a batch was one matrix: 4096 x 10,000 scores."""
    import numpy as np

    from tarnweave.operators import vectors

    runs = vectors._slices(4096, 10_000)
    assert [i for s in runs for i in range(s.start, s.stop)] == list(range(4096))
    assert max(s.stop - s.start for s in runs) * 10_000 <= vectors.CELLS
    m = np.random.default_rng(3).normal(size=(5000, 4)).round(2)
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(m)], "id long, embedding array<double>").repartition(2)
    u = m / np.linalg.norm(m, axis=1, keepdims=True)
    got = {(r["query"], r["rank"]): r["id"] for r in vectors.nearest(df, df, 2).where("query % 50 = 0").collect()}
    for q in range(0, 5000, 50):
        score = np.round(u @ u[q], 12)
        assert [got[q, 1], got[q, 2]] == np.lexsort((np.arange(5000), -score))[:2].tolist()


def test_stored_rows_are_read_by_column(spark):
    """A checkpoint kept whole rows uncompressed."""
    from tarnweave.plans.durable import stored

    df = spark.range(100).selectExpr("id", "repeat('x', 1000) AS wide", "array(named_struct('a', id, 'b', CAST(NULL AS STRING))) AS s")
    kept = stored(df)
    assert kept.dtypes == df.dtypes and sorted(kept.collect()) == sorted(df.collect())
    plan = kept.select("id")._jdf.queryExecution().executedPlan().toString()
    assert "FileScan parquet" in plan and "wide" not in plan


def test_tasks_over_awards_read_little_unless_the_session_says_otherwise(spark):
    import __spark_entry__

    key, run = "spark.sql.adaptive.advisoryPartitionSizeInBytes", __spark_entry__.queries()["jn14_ratio"]
    try:
        run(spark, "/root/testdata/sf0.001")
        assert spark.conf.get(key, "64m") == "16m"
        spark.conf.set(key, "32m")
        run(spark, "/root/testdata/sf0.001")
        assert spark.conf.get(key, "64m") == "32m"
    finally:
        spark.conf.unset(key)


def test_releases_are_read_from_json_once(spark):
    import __spark_entry__

    key = "spark.sql.debug.maxToStringFields"
    try:
        spark.conf.set(key, "10000")
        plan = __spark_entry__.queries()["prj21_release_rows"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.unset(key)
    assert plan.count("from_json") == 1


def test_a_crowd_gives_each_pair_once_from_few_keys(spark):
    """Names of one length have half the square of their length of keys, and those that differ at two places one key in common."""
    r = random.Random(2)
    words = {f"Supplier#{i:09d}" for i in range(300)} | {"abc" + "".join(r.choice("ab𝄞") for _ in range(r.randrange(6, 10))) for _ in range(150)}
    names = spark.createDataFrame([(i, x, x[:3]) for i, x in enumerate(sorted(words))], "id long, name string, k string")
    crowd = names.where("k = 'Sup'")
    keys = linkage._less_one(crowd).count() + linkage._less_two(crowd).count()
    assert keys <= 300 * (18 * 19 // 2)
    two = linkage._less_two(crowd)
    differ = F.col("p").isin(17, 18) & (F.col("q") == 18)
    assert two.where(differ).count() == 300
    got = [tuple(x) for x in linkage._crowded(names, 2).collect()]
    assert len(got) == len(set(got)) and all(x[0] < x[2] for x in got)
    a, b = (names.select(F.col("id").alias(f"id{e}"), F.col("name").alias(f"name{e}"), "k") for e in ("", "2"))
    near = a.join(b, "k").where("id < id2").where(F.levenshtein("name", "name2") <= 2).select("id", "name", "id2", "name2")
    assert {tuple(x) for x in near.collect()} <= set(got)


def test_rules_run_once(spark, tmp_path):
    from tarnweave.operators import anomalies

    runs = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            runs.add(batch.num_rows)
            yield batch

    lots = spark.createDataFrame([(x, "low") for x in range(6)], "lot long, severity string").repartition(2).mapInArrow(count, "lot long, severity string").repartition(2, "lot").distinct()
    anomalies.run_rules({"x": lots, "y": lots.where("lot > 90")}, f"{tmp_path}/findings")
    assert runs.value == 12  # each rule's rows once
    assert {r.rule for r in spark.read.parquet(f"{tmp_path}/findings").collect()} == {"x"}


def test_notices_are_read_as_json_once_a_pass(spark):
    """A condition on an exploded list must not make and read the JSON again below it."""
    from tarnweave.plans.canonical import raw_notices, raw_releases
    from tarnweave.plans.registry import Tables

    t = Tables(spark, "/root/testdata/sf0.001")
    for rows in (adapters.notices(raw_notices(t)), adapters.releases(raw_releases(t))):
        assert rows._jdf.queryExecution().optimizedPlan().toString().count("from_json(") == 1


def test_release_frames_read_their_own_columns(spark):
    """Flat rows of releases stand as compressed columns; a frame decodes those that it names."""
    from tarnweave.plans.graphs import _frames
    from tarnweave.plans.registry import Tables

    frames = _frames(Tables(spark, "/root/testdata/sf0.001"))
    plan = frames["RIGUARDA"]._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<idAvviso:string,idAppalto:string>" in plan
