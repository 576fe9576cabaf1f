"""Linkage over coded subjects, run logs, shards, metrics, raw members and stored conversations."""

from __future__ import annotations

from pyspark.sql import functions as F

from tarnweave.operators import anomalies, chats, linkage, loads, vectors

from .domain import RF1, RF2, RF3, paths
from .registry import query
from .storage import _folder

c = F.col

# subjects: no code, a foreign one, a malformed number, or a valid VAT code of the nation; each tenth bears its nation's name
_CODE = """CASE s_suppkey % 4 WHEN 0 THEN '' WHEN 1 THEN concat('DE', lpad(CAST(s_nationkey AS STRING), 5, '0')) WHEN 2 THEN concat('1', lpad(CAST(s_nationkey AS STRING), 7, '0'))
  ELSE concat(lpad(CAST(s_nationkey AS STRING), 10, '0'), CAST((10 - (CAST(floor(s_nationkey / 10) AS INT) + CASE WHEN s_nationkey % 10 > 4 THEN 2 * (s_nationkey % 10) - 9 ELSE 2 * (s_nationkey % 10) END) % 10) % 10 AS STRING)) END"""
_NAME = "CASE WHEN s_suppkey % 10 = 0 THEN concat('Gruppo ', CAST(s_nationkey AS STRING)) ELSE s_name END"
_D = "levenshtein(a.name, b.name)"
_PAIRS = f"""WITH s AS (SELECT s_suppkey AS id, {_CODE} AS code, {_NAME} AS name FROM supplier),
p AS (SELECT a.id AS a, b.id AS b, a.code AS x, b.code AS y, a.name AS m, b.name AS n, {_D} AS d FROM s a JOIN s b ON a.id < b.id AND substr(a.name, 1, 3) = substr(b.name, 1, 3)
WHERE a.name = b.name OR (least(length(a.name), length(b.name)) >= 8 AND abs(length(a.name) - length(b.name)) <= 2 AND {_D} <= 2 AND {_D} <= 0.2 * least(length(a.name), length(b.name)))),
t AS (SELECT *, CASE WHEN x <> '' AND x = y THEN 'merge' WHEN length(x) = 11 AND length(y) = 11 THEN 'reject' WHEN x LIKE 'DE%' OR y LIKE 'DE%' THEN 'reject' ELSE 'review' END AS tier FROM p) """


def _subjects(t):
    return t.supplier.select(c("s_suppkey").alias("id"), F.expr(_CODE).alias("code"), F.expr(_NAME).alias("name"))


@query("lk06_linkage", _PAIRS + "SELECT a, b, tier, CASE tier WHEN 'merge' THEN 'STESSO_SOGGETTO' WHEN 'review' THEN 'POSSIBILE_DUPLICATO' END AS edge FROM t")
def linked(t):
    return linkage.resolve(_subjects(t))


@query("lk15_ceiling", _PAIRS + "SELECT CASE WHEN d = 0 THEN 'EXACT' ELSE 'NEAR' END AS band, tier, count(*) AS n FROM t GROUP BY ALL")
def ceiling(t):
    return linkage.ceiling(_subjects(t))


@query("lk12_annotated", _PAIRS + """, r AS (SELECT *, d / greatest(length(m), length(n)) AS rel FROM t WHERE x <> y)
SELECT a, b, CASE WHEN (length(x) = 11 AND length(y) = 11) OR x LIKE 'DE%' OR y LIKE 'DE%' THEN 'diff' WHEN rel <= 0.12 THEN 'same' ELSE 'diff' END AS label,
  CASE WHEN (length(x) = 11 AND length(y) = 11) OR x LIKE 'DE%' OR y LIKE 'DE%' THEN 'high' WHEN rel = 0 OR rel >= 0.25 THEN 'medium' ELSE 'low' END AS confidence FROM r""")
def annotated(t):
    s = _subjects(t)
    said = linkage.annotated(c("a_code"), c("b_code"), c("a_name"), c("b_name"))
    return linkage.fuzzy_pairs(s, carry=("code",)).where("a_code <> b_code").select("a", "b", said.alias("s")).select("a", "b", "s.label", "s.confidence")


@query("lk13_levels", _PAIRS + "SELECT CASE WHEN d = 0 THEN 'L2' ELSE 'L3' END AS level, count(*) AS n FROM t GROUP BY 1")
def levels(t):
    two = linkage.counted_pairs(_subjects(t).select("id", "name"))
    return two.groupBy(loads.level_of(c("a_name"), c("b_name")).alias("level")).agg(F.sum("n").alias("n"))


@query("snk08_decision_log", _PAIRS + "SELECT run, tier, count(*) AS n FROM t, (VALUES ('first'), ('second')) r(run) GROUP BY ALL")
def decision_log(t):
    """Two runs append their decisions to one log."""
    path, found = _folder(t), linkage.resolve(_subjects(t))
    for run in ("first", "second"):
        found.select("a", "b", "tier", F.lit(run).alias("run")).write.mode("append").parquet(path)
    return t.spark.read.parquet(path).groupBy("run", "tier").agg(F.count("*").alias("n"))


@query("snk09_run_log", "SELECT 'good' AS run, 'completed' AS status, count(*) AS rows FROM orders UNION ALL SELECT 'bad', 'error', NULL")
def run_log(t):
    path = _folder(t)
    loads.recorded(t.spark, path, "good", t.orders.count)
    loads.recorded(t.spark, path, "bad", lambda: t.missing_table.count())
    return loads.last_status(t.spark, path)


@query("snk03_flag_reset", "SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN 'new' ELSE o_orderstatus END AS status, o_orderkey % 5 <> 0 AS _synced FROM orders")
def flag_reset(t):
    old = t.orders.select("o_orderkey", c("o_orderstatus").alias("status"), F.lit(True).alias("_synced"))
    return loads.upsert_flagged(old, t.orders.where("o_orderkey % 5 = 0").select("o_orderkey", F.lit("new").alias("status")), "o_orderkey")


@query("snk19_metrics", "SELECT o_orderpriority AS name, count(*) * 2 AS value FROM orders GROUP BY 1")
def metrics(t):
    """Lines of JSON that two runs append."""
    path, rows = _folder(t), t.orders.groupBy(c("o_orderpriority").alias("name")).agg(F.count("*").alias("value"))
    for _ in range(2):
        rows.write.mode("append").json(path)
    return t.spark.read.schema("name string, value long").json(path).groupBy("name").agg(F.sum("value").alias("value"))


@query("snk20_prefix_table", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 50")
def prefix_table(t):
    """The first rows as a table of their own; the number is the operator."""
    path = _folder(t)
    t.orders.orderBy("o_orderkey").limit(50).select("o_orderkey", "o_totalprice").write.parquet(path)
    return t.spark.read.parquet(path)


@query("snk22_shards", "SELECT count(*) AS n, count(DISTINCT o_custkey) AS keys, true AS apart FROM orders")
def shards(t):
    path = _folder(t)
    loads.sharded(t.orders.select("o_orderkey", "o_custkey"), "o_custkey", 8).write.partitionBy("shard").parquet(path)
    each = t.spark.read.parquet(path).groupBy("o_custkey").agg(F.count("*").alias("n"), F.min("shard").alias("low"), F.max("shard").alias("high"))
    return each.agg(F.sum("n").alias("n"), F.count("*").alias("keys"), F.bool_and(c("low") == c("high")).alias("apart"))


_TAGS = "CASE l_partkey % 6 WHEN 0 THEN 'award,contract' WHEN 1 THEN 'award,tender' WHEN 2 THEN 'tender' WHEN 3 THEN 'contract' WHEN 4 THEN 'planning' END"


@query("prj22_tag_code", f"SELECT CASE {_TAGS} WHEN 'award,contract' THEN 'OCDS-AC' WHEN 'award,tender' THEN 'OCDS-A' WHEN 'tender' THEN 'OCDS-T' WHEN 'contract' THEN 'OCDS-C' WHEN 'planning' THEN 'OCDS-P' ELSE 'OCDS-X' END AS code, count(*) AS n FROM lineitem GROUP BY 1")
def tag_codes(t):
    return t.lineitem.groupBy(loads.tag_code(F.split(F.expr(_TAGS), ",")).alias("code")).agg(F.count("*").alias("n"))


@query("prj19_guards", "SELECT p_partkey, CASE WHEN p_partkey % 3 > 0 THEN p_name END AS name, CASE p_partkey % 3 WHEN 0 THEN p_size WHEN 1 THEN p_size + 0.5 END AS size FROM part")
def guards(t):
    """Members that may be of another type: text or a number, a number, text with a comma, or none."""
    name = F.when(c("p_partkey") % 3 > 0, F.to_json(F.struct(c("p_name").alias("name")))).otherwise('{"name":7}')
    size = F.concat(F.lit(',"size":'), F.when(c("p_partkey") % 3 == 0, c("p_size").cast("string")).when(c("p_partkey") % 3 == 1, F.concat(F.lit('"'), c("p_size").cast("string"), F.lit(',5"'))).otherwise('"x"'))
    whole = F.concat(F.expr("substr(n, 1, length(n) - 1)"), "s", F.lit("}"))
    v = t.part.select("p_partkey", name.alias("n"), size.alias("s")).select("p_partkey", F.parse_json(whole).alias("v"))
    return v.select("p_partkey", loads.as_text(c("v"), "$.name").alias("name"), loads.as_number(c("v"), "$.size").alias("size"))


@query("prj18_summary", "SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber % 2 = 0 THEN 'A' || l_partkey ELSE 'B' || l_partkey END AS cig, 'second' AS oggetto, l_quantity AS importo, CAST(l_linenumber % 2 AS BIGINT) AS winners FROM lineitem")
def summaries(t):
    """Two sections of one item: the first lacks a title, of odd lines the code too, and of even ones an award."""
    item = lambda cig, title, amount, won: F.struct(
        cig.alias("cig"), title.alias("descrizione"), F.lit("").alias("natura_principale"), amount.alias("valore_affidamento"), F.lit(None).cast("double").alias("valore_totale"),
        F.lit(1.0).alias("importo"), F.when(won, F.array(F.struct(c("l_suppkey").alias("soggetto")))).alias("aggiudicatari_ad"),
    )
    even = c("l_linenumber") % 2 == 0
    one = item(F.when(even, F.concat(F.lit("A"), "l_partkey")).otherwise(""), F.lit(""), c("l_quantity").cast("double"), F.lit(False))
    two = item(F.concat(F.lit("B"), "l_partkey"), F.lit("second"), F.lit(5.0), ~even)
    s = loads.summary(F.array(F.struct(F.array(one).alias("items")), F.struct(F.array(two).alias("items"))))
    return t.lineitem.select("l_orderkey", "l_linenumber", s.alias("s")).select("l_orderkey", "l_linenumber", "s.cig", "s.oggetto", "s.importo", F.size("s.aggiudicatari").cast("long").alias("winners"))


@query("prj30_chart_columns", "SELECT 'o_orderstatus' AS label, 'n' AS value FROM (SELECT 1 FROM orders LIMIT 1)")
def chart_columns(t):
    label, value = loads.chart_columns(t.orders.groupBy("o_orderstatus").agg(F.count("*").alias("n"), F.sum("o_totalprice").alias("total")))
    return t.orders.limit(1).select(F.lit(label).alias("label"), F.lit(value).alias("value"))


@query("scl23_ratio", "SELECT o_orderpriority, round(count(*) FILTER (o_orderstatus = 'F') / count(*), 6) AS share FROM orders GROUP BY 1")
def ratio(t):
    return t.orders.groupBy("o_orderpriority").agg(F.round(F.try_divide(F.count_if(c("o_orderstatus") == "F"), F.count("*")), 6).alias("share"))


@query("srt05_bounded_scan", "SELECT o_orderkey FROM (SELECT * FROM orders ORDER BY o_orderkey LIMIT 300) ORDER BY o_totalprice DESC, o_orderkey LIMIT 10")
def bounded_scan(t):
    """A ranking over the first rows only, where the caller asks for that; by key, so that it is the same in every run."""
    return t.orders.orderBy("o_orderkey").limit(300).orderBy(c("o_totalprice").desc(), "o_orderkey").limit(10).select("o_orderkey")


@query("tl15_chat_store", """WITH m AS (SELECT conv_id, turn FROM conversations WHERE conv_id % 10 <> 0 UNION ALL SELECT DISTINCT conv_id, 1000 FROM conversations WHERE conv_id % 3 = 0 AND conv_id % 10 <> 0)
SELECT conv_id AS id, CASE WHEN conv_id % 2 = 0 THEN 'even' ELSE 'chat' END AS title, CAST(max(turn) AS BIGINT) AS updated, count(*) AS messages, count(*) AS stored FROM m GROUP BY conv_id""")
def chat_store(t):
    """Chats of the table: each third gets a message, even ones a name, each tenth goes with all its messages."""
    messages = t.conversations.select(c("conv_id").alias("chat"), c("turn").cast("long").alias("at"), "role", "text")
    have = messages.groupBy(c("chat").alias("id")).agg(F.lit("chat").alias("title"), F.max("at").alias("updated"), F.count("*").alias("messages")).select("id", "title", "updated", "messages")
    new = have.where("id % 3 = 0").select(c("id").alias("chat"), F.lit(1000).cast("long").alias("at"), F.lit("user").alias("role"), F.lit("more").alias("text"))
    have, messages = chats.appended(have, messages, new)
    have, messages = chats.removed(have, messages, have.where("id % 10 = 0").select("id"))
    have = chats.renamed(have, have.where("id % 2 = 0").select("id", F.lit("even").alias("title")))
    stored = messages.groupBy(c("chat").alias("id")).agg(F.count("*").alias("stored"))
    return have.join(stored, "id")


_FOUND = " UNION ALL ".join(f"SELECT '{k}' AS rule, severity, sa, imp FROM ({q}) WHERE sa = 7 OR imp = 7" for k, q in (("rf1", RF1), ("rf2", RF2), ("rf3", RF3)))


@query("tl12_findings", f"SELECT * FROM ({_FOUND}) ORDER BY CASE severity WHEN 'high' THEN 0 WHEN 'medium' THEN 1 ELSE 2 END, rule, sa, imp LIMIT 50")
def findings(t):
    p = paths(t)
    found = anomalies.findings(rf1=anomalies.recurrent_pairs(p), rf2=anomalies.split_awards(p), rf3=anomalies.dominant_winner(p))
    return anomalies.picked(found, entity=7, limit=50)


def _coded_search(t, where=None):
    v = t.embeddings.select(c("vec_id").alias("id"), "embedding", "label")
    codes = vectors.fit_codes(v)
    index, q = vectors.coded(v, codes), v.where("id % 100 = 0")
    return v, q, vectors.search_coded(index, v, q, 10, codes, candidates=100, where=where)


@query("vec04_coded_search")
def coded_search(t):
    """Recall of coded search, and the share of all pairs that it compares in full."""
    v, q, found = _coded_search(t)
    return vectors.recall(found, vectors.nearest(v, q, 10)).withColumn("compared_share", F.least(F.lit(1.0), F.lit(100.0) / F.lit(v.count())))


@query(
    "vec04_filter_first",
    "SELECT q.vec_id AS query, count(*) AS found, bool_and(v.label = 3) AS kept FROM (SELECT * FROM embeddings WHERE vec_id % 100 = 0) q, (SELECT * FROM embeddings WHERE label = 3 LIMIT 10) v GROUP BY 1",
)
def filter_first(t):
    """The filter comes before the search, so every query has its ten rows of the label."""
    v, _, found = _coded_search(t, c("label") == 3)
    kept = found.join(v.select("id", "label"), "id")
    return kept.groupBy("query").agg(F.count("*").alias("found"), F.bool_and(c("label") == 3).alias("kept"))


_GOLD = """WITH s AS (SELECT s_suppkey AS id, 'c' || s_nationkey AS code, s_name AS name FROM supplier UNION ALL SELECT 1000000 + p_partkey, p_brand, p_name FROM part),
e AS (SELECT *, substr(name, 1, 3) AS p FROM s WHERE length(name) >= 8),
one AS (SELECT name, code, min(id) AS id FROM e GROUP BY ALL),
two AS (SELECT name, arg_min(id, code) AS l, arg_max(id, code) AS r FROM (SELECT * FROM one QUALIFY row_number() OVER (PARTITION BY name ORDER BY code) <= 2) GROUP BY 1 HAVING count(*) = 2),
g AS (SELECT id, code, name, p, j, list_min(list_transform(range(1, length(name) - 1), lambda i: md5(j || ':' || substr(name, i, 3)))) AS m FROM e, range(4) t(j)),
few AS (SELECT * FROM g QUALIFY row_number() OVER (PARTITION BY p, j, m ORDER BY md5('42:' || id), id) <= 16),
met AS (SELECT DISTINCT a.p, a.id AS l, b.id AS r, levenshtein(a.name, b.name) AS d, least(length(a.name), length(b.name)) AS n FROM few a JOIN few b ON a.p = b.p AND a.j = b.j AND a.m = b.m AND a.id < b.id AND a.code <> b.code AND a.name <> b.name),
banded AS (SELECT *, d / n AS rel, CASE WHEN d <= 2 AND d / n <= 0.2 THEN 'NEAR' WHEN d BETWEEN 3 AND 6 THEN 'MID' END AS band FROM met),
spread AS (SELECT * FROM banded WHERE band IS NOT NULL QUALIFY row_number() OVER (PARTITION BY band, p ORDER BY md5('42:' || l || ':' || r), l, r) <= 2),
mid AS (SELECT band, l, r, d, rel FROM spread QUALIFY row_number() OVER (PARTITION BY band ORDER BY md5('42:' || l || ':' || r), l, r) <= 14),
placed AS (SELECT *, row_number() OVER (ORDER BY md5('42:' || id), id) AS place, count(*) OVER () AS n FROM e),
far AS (SELECT 'FAR' AS band, a.id AS l, b.id AS r, levenshtein(a.name, b.name) AS d, levenshtein(a.name, b.name) / least(length(a.name), length(b.name)) AS rel
  FROM placed a JOIN placed b ON b.place = (a.place * 7919 + 12345) % a.n + 1 WHERE a.p <> b.p AND a.code <> b.code ORDER BY a.place LIMIT 8)
SELECT band, l AS "left", r AS "right", d AS dist, round(rel, 6) AS rel FROM ((SELECT 'EXACT' AS band, l, r, 0 AS d, 0.0 AS rel FROM two ORDER BY md5('42:' || name), name LIMIT 12) UNION ALL SELECT * FROM mid UNION ALL SELECT * FROM far)"""


@query("lk11_gold_bands", _GOLD)
def gold_bands(t):
    """Suppliers and parts as subjects: pairs in four bands."""
    from tarnweave.operators import goldset

    s = t.supplier.select(c("s_suppkey").alias("id"), F.concat(F.lit("c"), "s_nationkey").alias("code"), c("s_name").alias("name"))
    s = s.union(t.part.select(c("p_partkey") + 1000000, "p_brand", "p_name"))
    return goldset.gold_pairs(s).withColumn("rel", F.round("rel", 6))


@query("tl02_part_search", "SELECT p_partkey AS id, p_name AS name, p_size AS wins FROM part WHERE list_min(list_transform(regexp_split_to_array(lower(p_name), '[^a-z0-9#]+'), lambda x: levenshtein(x, 'rde'))) <= 2 AND list_min(list_transform(regexp_split_to_array(lower(p_name), '[^a-z0-9#]+'), lambda x: levenshtein(x, 'wigdet'))) <= 2 ORDER BY list_min(list_transform(regexp_split_to_array(lower(p_name), '[^a-z0-9#]+'), lambda x: levenshtein(x, 'rde') / greatest(length(x), 3))) + list_min(list_transform(regexp_split_to_array(lower(p_name), '[^a-z0-9#]+'), lambda x: levenshtein(x, 'wigdet') / greatest(length(x), 6))), p_size DESC, p_partkey LIMIT 10")
def part_search(t):
    """Two misspelt words over part names."""
    from tarnweave.operators import lookup

    rows = t.part.select(c("p_partkey").alias("id"), c("p_name").alias("name"), c("p_size").alias("wins"))
    return lookup.search(rows, "rde wigdet").select("id", "name", "wins")


@query("lk16_link_status", _PAIRS + """, e AS (SELECT *, CASE tier WHEN 'merge' THEN 'STESSO_SOGGETTO' WHEN 'review' THEN 'POSSIBILE_DUPLICATO' END AS edge FROM t),
u AS (SELECT tier, edge, a AS id FROM e UNION SELECT tier, edge, b FROM e) SELECT n.tier, n.edge, n.pairs, s.subjects FROM (SELECT tier, edge, count(*) AS pairs FROM e GROUP BY ALL) n JOIN (SELECT tier, count(*) AS subjects FROM u GROUP BY ALL) s USING (tier)""")
def link_status(t):
    return linkage.status(_subjects(t))


_SHARE = "SELECT CAST({s} AS DOUBLE) AS share, (SELECT count(*) FROM f WHERE part < {k}) AS names, count(*) AS pairs FROM f a JOIN f b ON a.id < b.id AND a.part < {k} AND b.part < {k} AND substr(a.name, 1, 3) = substr(b.name, 1, 3) AND least(length(a.name), length(b.name)) >= 8 AND levenshtein(a.name, b.name) BETWEEN 1 AND 2 AND levenshtein(a.name, b.name) / least(length(a.name), length(b.name)) <= 0.2"


@query("lk17_link_scaling", "WITH f AS (SELECT s_suppkey AS id, s_name AS name, s_nationkey % 4 AS part FROM supplier) " + " UNION ALL ".join(_SHARE.format(s=k / 4, k=k) for k in (1, 2, 3, 4)))
def link_scaling(t):
    return linkage.scaling(t.supplier.select(c("s_suppkey").alias("id"), c("s_name").alias("name"), (c("s_nationkey") % 4).alias("part")), "part")


@query("snk15_edge_slice", "SELECT l_returnflag AS kind, l_orderkey, l_suppkey, count(*) AS n FROM lineitem WHERE l_returnflag <> 'N' GROUP BY ALL")
def edge_slice(t):
    """Edges in folders by type, one type deleted."""
    from tarnweave.sources import files

    path = _folder(t)
    files.replace_slices(t.lineitem.groupBy(c("l_returnflag").alias("kind"), "l_orderkey", "l_suppkey").agg(F.count("*").alias("n")), path, "kind")
    files.delete_slice(t.spark, path, "kind", "N")
    return t.spark.read.parquet(path).select(c("kind").cast("string").alias("kind"), "l_orderkey", "l_suppkey", "n")
