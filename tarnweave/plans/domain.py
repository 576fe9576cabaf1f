"""Anomaly rules, codes and names, linkage, vectors, entity search, adapters and incremental loads."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tarnweave.functions import codes
from tarnweave.operators import anomalies, linkage, lookup, network, vectors
from tarnweave.operators.records import insert_absent

from .durable import cut, shared_dir
from .registry import query
from .relational import PATH, PRICE, M, awards

c = F.col


def paths(t, home: str = "o_custkey"):
    """Award paths: one row per order line, direct where the line came back."""
    return awards(t).select(
        c(home).alias("sa"), c("l_suppkey").alias("imp"), c("o_orderkey").alias("lot"), c("l_extendedprice").alias("amount"),
        (c("l_returnflag") == "R").alias("direct"), c("l_returnflag").alias("code"),
    )


def nation_paths(t):
    return awards(t).join(t.customer, c("o_custkey") == c("c_custkey")).select(
        c("c_nationkey").alias("sa"), c("l_suppkey").alias("imp"), c("o_orderkey").alias("lot"), c("l_extendedprice").alias("amount"),
        (c("l_returnflag") == "R").alias("direct"), c("l_returnflag").alias("code"),
    )


RF1 = f"SELECT o_custkey AS sa, l_suppkey AS imp, count(DISTINCT o_orderkey) AS n, {PRICE} AS total, CASE WHEN count(DISTINCT o_orderkey) >= 5 THEN 'high' ELSE 'medium' END AS severity FROM {PATH} WHERE l_returnflag = 'R' GROUP BY ALL HAVING count(DISTINCT o_orderkey) >= 3 AND {PRICE} < 500000000"
RF2 = f"SELECT o_custkey AS sa, l_suppkey AS imp, count(DISTINCT o_orderkey) AS n, {PRICE} AS total, max(l_extendedprice) AS largest, CASE WHEN {PRICE} > 100000 THEN 'high' ELSE 'medium' END AS severity FROM {PATH} WHERE l_returnflag = 'R' AND l_extendedprice > 0 AND l_extendedprice < 40000 GROUP BY ALL HAVING count(DISTINCT o_orderkey) >= 2 AND {PRICE} > 40000 AND {PRICE} < 500000000"
RF3 = f"WITH p AS (SELECT o_custkey AS sa, l_suppkey AS imp, count(DISTINCT o_orderkey) AS n FROM {PATH} GROUP BY ALL), q AS (SELECT o_custkey AS sa, count(DISTINCT o_orderkey) AS lots FROM {PATH} GROUP BY 1) SELECT sa, imp, n, lots, round(n / lots, 6) AS share, CASE WHEN n / lots > 0.8 THEN 'high' ELSE 'medium' END AS severity FROM p JOIN q USING (sa) WHERE lots >= 3 AND n / lots > 0.5"
RF4 = "SELECT l_orderkey AS lot, count(*) AS n, CASE WHEN count(*) > 6 THEN 'high' ELSE 'medium' END AS severity FROM lineitem GROUP BY 1 HAVING count(*) > 3"
RF5 = "SELECT l_orderkey AS lot, count(*) AS n, CASE WHEN count(*) > 1 THEN 'high' ELSE 'low' END AS severity FROM lineitem WHERE l_returnflag IN ('A', 'M1') GROUP BY 1"
RF6 = f"SELECT o_custkey AS sa, l_suppkey AS imp, count(*) FILTER (l_returnflag = 'A') AS n_first, count(*) FILTER (l_returnflag = 'R') AS n_second, 'medium' AS severity FROM {PATH} GROUP BY ALL HAVING n_first >= 1 AND n_second >= 1"
RF7 = f"WITH p AS (SELECT l_suppkey AS imp, c_nationkey AS sa, count(*) AS n, {PRICE} AS total FROM {PATH} JOIN customer ON o_custkey = c_custkey WHERE l_extendedprice > 0 AND l_extendedprice < 500000000 GROUP BY ALL), x AS (SELECT *, sum(total) OVER (PARTITION BY imp) AS whole FROM p) SELECT imp, sa, n, total, round(total / whole, 6) AS share, CASE WHEN total / whole >= 0.09 THEN 'high' ELSE 'medium' END AS severity FROM x WHERE whole > 10000 AND total / whole >= 0.07 AND n >= 3"


@query("rf1_recurrent_pairs", RF1)
def rf1(t):
    return anomalies.recurrent_pairs(paths(t))


@query("rf2_split_awards", RF2)
def rf2(t):
    return anomalies.split_awards(paths(t))


@query("rf3_dominant_winner", RF3)
def rf3(t):
    return anomalies.dominant_winner(paths(t))


def _notices(t):
    return t.lineitem.select(c("l_orderkey").alias("lot"), c("l_returnflag").alias("code"))


@query("rf4_many_notices", RF4)
def rf4(t):
    return anomalies.many_notices(_notices(t))


@query("rf5_changed_contracts", RF5)
def rf5(t):
    return anomalies.changed_contracts(_notices(t), ("A", "M1"))


@query("rf6_both_procedures", RF6)
def rf6(t):
    return anomalies.both_procedures(paths(t), ("A",), ("R",))


@query("rf7_client_capture", RF7)
def rf7(t):
    return anomalies.captured_client(nation_paths(t), share=0.07, high=0.09)


@query("rf7_client_capture_share", RF7.replace("JOIN customer ON o_custkey = c_custkey", "JOIN nation ON n_nationkey = l_suppkey % 25").replace("c_nationkey", "CASE WHEN o_custkey % 4 > 0 THEN 0 ELSE n_nationkey END").replace("0.09", "0.9").replace("0.07", "0.7"))
def rf7_share(t):
    """The rule's own share: three customers in four are one authority."""
    rows = paths(t).withColumn("sa", F.when(c("sa") % 4 > 0, 0).otherwise(c("imp") % 25))
    return anomalies.captured_client(rows)


_ALL = " UNION ALL ".join(f"SELECT '{k}' AS rule, severity FROM ({q})" for k, q in (("rf1", RF1), ("rf2", RF2), ("rf3", RF3), ("rf4", RF4), ("rf5", RF5), ("rf6", RF6), ("rf7", RF7)))


@query("rf10_findings_by_severity", f"SELECT rule, severity, count(*) AS n FROM ({_ALL}) GROUP BY ALL")
def rf10(t):
    every = anomalies.findings(rf1=rf1(t), rf2=rf2(t), rf3=rf3(t), rf4=rf4(t), rf5=rf5(t), rf6=rf6(t), rf7=rf7(t))
    return every.groupBy("rule", "severity").agg(F.count("*").alias("n"))


@query("rf11_status", f"SELECT rule, count(*) FILTER (severity = 'high') AS high, count(*) FILTER (severity = 'medium') AS medium, count(*) FILTER (severity = 'low') AS low FROM ({_ALL}) GROUP BY 1")
def rf11(t):
    every = anomalies.findings(rf1=rf1(t), rf2=rf2(t), rf3=rf3(t), rf4=rf4(t), rf5=rf5(t), rf6=rf6(t), rf7=rf7(t))
    return every.groupBy("rule").agg(*[F.count_if(c("severity") == s).alias(s) for s in ("high", "medium", "low")])


@query("rf8_communities")
def rf8(t):
    """Communities of the network of pairs with at least three lots; companies have odd node numbers."""
    pairs = awards(t).groupBy("o_custkey", "l_suppkey").agg(F.count_distinct("o_orderkey").alias("w")).where("w >= 3")
    edges = cut(pairs.select((c("o_custkey") * 2).alias("a"), (c("l_suppkey") * 2 + 1).alias("b"), "w"))
    found = cut(network.communities(edges))
    n = found.groupBy("community").agg(
        F.count("*").alias("size"), F.count_if(c("node") % 2 == 0).alias("authorities"), F.count_if(c("node") % 2 == 1).alias("companies")
    )
    level = F.when(c("size") >= 10, "high").when(c("size") >= 5, "medium").otherwise("low")
    kept = n.where("authorities >= 1 AND companies >= 2 AND size >= 3").withColumn("severity", level)
    top = kept.orderBy(c("size").desc(), "community").limit(50)
    return top.join(F.broadcast(network.partition_quality(edges, found).select(F.round("modularity", 6).alias("modularity"))))  # one row


@query("gr02_projection", f"SELECT o_custkey AS sa, l_suppkey AS imp, count(*) AS w FROM {PATH} GROUP BY ALL")
def projection(t):
    return paths(t).groupBy("sa", "imp").agg(F.count("*").alias("w"))


# codes and names

# codes and names of every kind from the keys of the orders, in SQL that both sides read alike
_N = "CAST(o_orderkey AS STRING)"
_NAMES = (
    f"CASE o_orderkey % 9 WHEN 0 THEN concat('Alfa ', {_N}, ' S.R.L.') WHEN 1 THEN concat('  BETA s.p.a. & figli  ', {_N}) WHEN 2 THEN concat('coop. Gamma', {_N}, ' società cooperativa') WHEN 3 THEN concat('Delta-', {_N}, ' (in liquidazione) srl') "
    f"WHEN 4 THEN concat('Casa di Cura ', {_N}, ' s.n.c. / S.A.S.') WHEN 5 THEN '' WHEN 6 THEN concat('scarlatti ', {_N}, ' scarl') WHEN 7 THEN concat('s.r.l. ', {_N}) ELSE concat('Perù Àlfa ', {_N}) END"
)
_VATS = "lpad(CAST(o_orderkey * 7919 + o_custkey AS STRING), 11, '0')"
_LETTER = lambda x: f"chr(CAST(65 + ({x}) % 26 AS INT))"
_TWO = lambda x, n=2: f"lpad(CAST(({x}) % {10**n} AS STRING), {n}, '0')"
_PERSONS = f"concat('RSSMRA', {_TWO('o_orderkey')}, {_LETTER('o_custkey')}, {_TWO('o_custkey')}, {_LETTER('o_orderkey')}, {_TWO('o_orderkey * 7', 3)}, {_LETTER('o_orderkey + o_custkey')})"
_CODES = (
    f"CASE o_orderkey % 8 WHEN 0 THEN concat('IT', {_VATS}) WHEN 1 THEN concat(' it ', {_VATS}) WHEN 2 THEN {_N} WHEN 3 THEN concat('DE 12', {_N}) WHEN 4 THEN {_PERSONS} WHEN 5 THEN lower({_PERSONS}) "
    f"WHEN 6 THEN concat({_VATS}, {_VATS}) ELSE concat('12-', {_N}, '78.90') END"
)
_KINDS = f"CASE o_orderkey % 7 WHEN 0 THEN {_PERSONS} WHEN 1 THEN concat('DE', {_TWO('o_orderkey', 5)}) WHEN 2 THEN substr({_VATS}, 1, 9) WHEN 3 THEN '' WHEN 4 THEN concat('x ', {_N}) ELSE {_VATS} END"


def _values(t, text: str):
    return t.orders.select(c("o_orderkey").alias("i"), F.expr(text).alias("v"))


_FORMS = r"\b(s\.?r\.?l\.?|s\.?p\.?a\.?|s\.?n\.?c\.?|s\.?a\.?s\.?|s\.?c\.?r\.?l\.?|s\.?c\.?p\.?a\.?|scarl|coop\.?|cooperativa|s\.?\s*coop\.?)\b"


def _name_sql(x: str) -> str:
    return f"trim(regexp_replace(regexp_replace(regexp_replace(lower({x}), '{_FORMS}', '', 'g'), '[^a-z0-9àèéìòù\\s]+', ' ', 'g'), '\\s+', ' ', 'g'))"


@query("scl_normalize_name", f"SELECT i, {_name_sql('v')} AS name FROM (SELECT o_orderkey AS i, {_NAMES} AS v FROM orders)")
def names(t):
    return _values(t, _NAMES).select("i", codes.normalize_name(c("v")).alias("name"))


@query("scl_normalize_part_names", f"SELECT p_partkey, {_name_sql('p_name')} AS name FROM part")
def part_names(t):
    return t.part.select("p_partkey", codes.normalize_name(c("p_name")).alias("name"))


_CODE = r"regexp_replace(regexp_replace(upper(trim(v)), '^IT', ''), '\s+', '', 'g')"


@query("scl_normalize_code", f"SELECT i, CASE WHEN regexp_full_match({_CODE}, '[0-9A-Z]{{8,16}}') THEN {_CODE} END AS code FROM (SELECT o_orderkey AS i, {_CODES} AS v FROM orders)")
def code_values(t):
    return _values(t, _CODES).select("i", codes.normalize_code(c("v")).alias("code"))


_D = lambda i: f"CAST(substr(v, {i}, 1) AS INT)"
_VAT = " + ".join(_D(i) if i % 2 else f"(2 * {_D(i)} - CASE WHEN {_D(i)} > 4 THEN 9 ELSE 0 END)" for i in range(1, 11))


@query("scl_vat_checksum", f"SELECT i, CASE WHEN regexp_full_match(v, '[0-9]{{11}}') THEN (10 - ({_VAT}) % 10) % 10 = {_D(11)} ELSE false END AS valid FROM (SELECT o_orderkey AS i, {_KINDS} AS v FROM orders)")
def vat(t):
    return _values(t, _KINDS).select("i", codes.vat_valid(c("v")).alias("valid"))


_PLACE = lambda i: f"(instr('0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ', substr(v, {i}, 1)))"
_ODDS = "[" + ", ".join(map(str, codes.ODD)) + "]"
_PERSON = " + ".join(f"{_ODDS}[{_PLACE(i)}]" if i % 2 else f"(CASE WHEN {_PLACE(i)} > 10 THEN {_PLACE(i)} - 11 ELSE {_PLACE(i)} - 1 END)" for i in range(1, 16))


@query("scl_person_checksum", f"SELECT i, CASE WHEN regexp_full_match(v, '{codes.PERSON[1:-1]}') THEN chr(CAST(65 + ({_PERSON}) % 26 AS INT)) = substr(v, 16, 1) ELSE false END AS valid FROM (SELECT o_orderkey AS i, {_KINDS} AS v FROM orders)")
def person(t):
    return _values(t, _KINDS).select("i", codes.person_valid(c("v")).alias("valid"))


@query("scl_classify", f"SELECT i, CASE WHEN regexp_full_match(v, '[0-9]{{11}}') THEN 'PIVA' WHEN regexp_full_match(v, '{codes.PERSON[1:-1]}') THEN 'CF' WHEN regexp_full_match(v, '[0-9]{{8,13}}') THEN 'NUM_BAD' WHEN regexp_full_match(v, '[A-Z]{{2}}[0-9A-Z]{{3,}}') THEN 'FOREIGN' ELSE 'OTHER' END AS kind FROM (SELECT o_orderkey AS i, {_KINDS} AS v FROM orders)")
def kinds(t):
    return _values(t, _KINDS).select("i", codes.classify(c("v"))["kind"].alias("kind"))


@query("scl_dates", "SELECT event_id, strftime(ts, '%Y-%m-%d') AS day, strftime(date_trunc('month', ts), '%Y-%m') AS month, strftime(CAST(ts AS DATE) + 30, '%d/%m/%Y') AS later, date_diff('day', CAST(ts AS DATE), DATE '2024-03-01') AS left_days FROM events")
def dates(t):
    day = c("ts").cast("date")
    return t.events.select(
        "event_id",
        F.date_format("ts", "yyyy-MM-dd").alias("day"),
        F.date_format(F.date_trunc("month", "ts"), "yyyy-MM").alias("month"),
        F.date_format(F.date_add(day, 30), "dd/MM/yyyy").alias("later"),
        F.datediff(F.lit("2024-03-01").cast("date"), day).cast("long").alias("left_days"),
    )


@query("scl_arrays_json", "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, len(string_split(event_type, 'e')) AS parts, string_split(event_type, 'e')[1] AS head FROM events")
def arrays_json(t):
    parts = F.split("event_type", "e")
    return t.events.select("event_id", F.get_json_object("props", "$.k").cast("long").alias("k"), F.size(parts).cast("long").alias("parts"), F.get(parts, 0).alias("head"))


@query("scl_numbers", "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(100.0 * l_discount / (l_tax + 1), 1) AS pct, CAST(floor(l_extendedprice) AS BIGINT) AS whole, abs(l_quantity - 25) AS gap, CAST(l_quantity AS BIGINT) % 7 AS rest FROM lineitem")
def numbers(t):
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.round(100.0 * c("l_discount") / (c("l_tax") + 1), 1).alias("pct"), F.floor("l_extendedprice").alias("whole"),
        F.abs(c("l_quantity") - 25).alias("gap"), (c("l_quantity").cast("long") % 7).alias("rest"),
    )


@query("scl28_host", r"SELECT page_id, regexp_replace(regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#:]+)', 1), '^www\.', '') AS host FROM pages")
def host(t):
    return t.pages.select("page_id", F.coalesce(F.regexp_replace(F.parse_url("url", F.lit("HOST")), r"^www\.", ""), F.lit("")).alias("host"))


@query("prj08_links", r"SELECT page_id, len(regexp_extract_all(html, 'href=\"(https?://[^\"]+)\"', 1)) AS n, coalesce(regexp_extract_all(html, 'href=\"(https?://[^\"]+)\"', 1)[1], '') AS first FROM pages")
def links(t):
    found = F.regexp_extract_all("html", F.lit(r'href="(https?://[^"]+)"'), F.lit(1))
    return t.pages.select("page_id", F.size(found).cast("long").alias("n"), F.coalesce(F.get(found, 0), F.lit("")).alias("first"))


@query("src24_html_rewrite", r'''SELECT page_id, md5(regexp_replace(html, '(?i)<head([^>]*)>', '<head\1><base href="/">')) AS h FROM pages''')
def html_rewrite(t):
    return t.pages.select("page_id", F.md5(F.regexp_replace("html", r"(?i)<head([^>]*)>", '<head$1><base href="/">')).alias("h"))


_FORM = "CASE l_partkey % 13 WHEN 0 THEN 'PL1_3' WHEN 1 THEN 'P2_11' WHEN 2 THEN 'P1_15_2' WHEN 3 THEN 'P7_1_1' WHEN 4 THEN 'P7_3' WHEN 5 THEN 'A1_33' WHEN 6 THEN 'AD3' WHEN 7 THEN 'A3_6' WHEN 8 THEN 'AD1_26' WHEN 9 THEN 'M2' WHEN 10 THEN 'ZZ' WHEN 11 THEN '' END"


@query("prj24_dictionary", f"""
SELECT coalesce(d.section, '?') AS section, coalesce(d.label, CASE WHEN coalesce(l.code, '') = '' THEN '—' ELSE 'Scheda ' || l.code END) AS label, coalesce(d.mode, 'altro') AS mode, count(*) AS n
FROM (SELECT {_FORM} AS code FROM lineitem) l LEFT JOIN (VALUES ('PL1_3', 'avvisi', 'Preinformazione', 'preinformazione'), ('P2_11', 'bandi', 'Bando di gara', 'gara'),
('P1_15_2', 'avvisi', 'Sistema di qualificazione', 'qualificazione'), ('P7_1_1', 'avvisi', 'Indagine di mercato', 'indagine'), ('P7_3', 'avvisi', 'Elenco operatori economici', 'elenco'),
('A1_33', 'esiti', 'Avviso di aggiudicazione', 'gara'), ('AD3', 'esiti', 'Esito affidamento diretto', 'diretto'), ('A3_6', 'avvisi', 'Avviso affidamento diretto', 'diretto'),
('AD1_26', 'esiti', 'Trasparenza preventiva', 'trasparenza'), ('M2', 'avvisi', 'Modifica del contratto', 'modifica')) d(code, section, label, mode) ON l.code = d.code GROUP BY ALL""")
def dictionary(t):
    from tarnweave.functions.forms import described

    return described(t.lineitem.select(F.expr(_FORM).alias("code")), "code").groupBy("section", "label", "mode").agg(F.count("*").alias("n"))


@query("prj28_status", "SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'aggiudicato' WHEN o_orderdate IS NULL THEN 'concluso/non datato' WHEN CAST(o_orderdate AS DATE) >= DATE '1997-01-01' THEN 'aperto' ELSE 'scaduto' END AS status FROM orders")
def status(t):
    from tarnweave.sources.adapters import status_of

    return t.orders.select("o_orderkey", status_of(c("o_orderstatus") == "F", c("o_orderdate").cast("date"), F.lit("1997-01-01").cast("date")).alias("status"))


@query("prj27_embedding_text", "SELECT p_partkey, substr(array_to_string([nullif(p_name, ''), nullif(p_type, '')], ' — '), 1, 2000) AS text FROM part")
def embedding_text(t):
    return t.part.select("p_partkey", F.substring(F.concat_ws(" — ", F.nullif("p_name", F.lit("")), F.nullif("p_type", F.lit(""))), 1, 2000).alias("text"))


# linkage

_LEFT = f"CASE o_orderkey % 6 WHEN 0 THEN {_PERSONS} WHEN 1 THEN concat('ES', {_TWO('o_orderkey', 6)}) WHEN 2 THEN '' ELSE {_VATS} END"
_RIGHT = f"CASE o_custkey % 5 WHEN 0 THEN {_VATS} WHEN 1 THEN concat(substr({_VATS}, 1, 9), '0', substr({_VATS}, 11, 1)) WHEN 2 THEN substr({_VATS}, 1, 10) WHEN 3 THEN {_PERSONS} ELSE lpad(CAST(o_custkey * 104729 AS STRING), 11, '0') END"
_LEFT_NAME = f"concat('company of number ', {_N})"
_RIGHT_NAME = f"CASE o_orderkey % 4 WHEN 0 THEN {_LEFT_NAME} WHEN 1 THEN concat('company ofnumber ', {_N}) WHEN 2 THEN concat('compny of numbr ', {_N}, 'x') ELSE concat('other name ', {_N}) END"
_KIND = f"CASE WHEN regexp_full_match(v, '[0-9]{{11}}') THEN 'PIVA' WHEN regexp_full_match(v, '{codes.PERSON[1:-1]}') THEN 'CF' WHEN regexp_full_match(v, '[0-9]{{8,13}}') THEN 'NUM_BAD' WHEN regexp_full_match(v, '[A-Z]{{2}}[0-9A-Z]{{3,}}') THEN 'FOREIGN' ELSE 'OTHER' END"
_VALID = f"CASE WHEN regexp_full_match(v, '[0-9]{{11}}') THEN (10 - ({_VAT}) % 10) % 10 = {_D(11)} WHEN regexp_full_match(v, '{codes.PERSON[1:-1]}') THEN chr(CAST(65 + ({_PERSON}) % 26 AS INT)) = substr(v, 16, 1) ELSE false END"
_JUDGED = f"""WITH p AS (SELECT o_orderkey AS i, {_LEFT} AS a, {_RIGHT} AS b, {_LEFT_NAME} AS an, {_RIGHT_NAME} AS bn, o_orderkey % 4 < 2 AND o_custkey % 5 < 3 AS so FROM orders),
s AS (SELECT i, 'a' AS e, a AS v FROM p UNION ALL SELECT i, 'b', b FROM p), k AS (SELECT i, e, {_KIND} AS kind, {_VALID} AS valid FROM s),
x AS (SELECT p.*, ka.kind AS ak, ka.valid AS av, kb.kind AS bk, kb.valid AS bv, levenshtein(an, bn) AS d, least(length(an), length(bn)) AS short, greatest(length(an), length(bn)) AS long
  FROM p JOIN k ka ON ka.i = p.i AND ka.e = 'a' JOIN k kb ON kb.i = p.i AND kb.e = 'b'),
r AS (SELECT *, CASE WHEN a <> '' AND a = b THEN 'same' WHEN ak = bk AND ak IN ('PIVA', 'CF') THEN CASE WHEN av AND bv THEN 'diff' WHEN levenshtein(a, b) <= 2 THEN 'same' ELSE 'inconclusive' END
  WHEN ak = 'FOREIGN' OR bk = 'FOREIGN' THEN 'diff' WHEN ((ak = 'PIVA' AND av AND bk = 'NUM_BAD') OR (bk = 'PIVA' AND bv AND ak = 'NUM_BAD')) AND levenshtein(a, b) <= 2 THEN 'same' ELSE 'inconclusive' END AS rel FROM x),
j AS (SELECT *, CASE WHEN rel = 'diff' THEN 'reject' WHEN rel = 'same' THEN 'merge' WHEN replace(an, ' ', '') = replace(bn, ' ', '') AND ((ak = 'CF' AND av AND bk = 'PIVA' AND bv) OR (bk = 'CF' AND bv AND ak = 'PIVA' AND av)) THEN 'bridge' ELSE 'review' END AS tier FROM r) """
_NEAR_SQL = lambda edit: f"(an = bn OR (short >= 8 AND long - short <= {edit} AND d BETWEEN 1 AND {edit} AND d / short <= 0.2))"


def _pairs(t):
    return t.orders.select(
        c("o_orderkey").alias("i"), F.expr(_LEFT).alias("left_code"), F.expr(_RIGHT).alias("right_code"), F.expr(_LEFT_NAME).alias("left_name"), F.expr(_RIGHT_NAME).alias("right_name"),
        ((c("o_orderkey") % 4 < 2) & (c("o_custkey") % 5 < 3)).alias("so"),
    )


def _scored(said: str) -> str:
    n = {"tp": "said AND so", "fp": "said AND NOT so", "fn": "NOT said AND so", "tn": "NOT said AND NOT so"}
    counts = ", ".join(f"count(*) FILTER ({x}) AS {k}" for k, x in n.items())
    return f"(SELECT *, CASE WHEN tp + fp = 0 THEN 1 ELSE tp / (tp + fp) END AS p, CASE WHEN tp + fn = 0 THEN 1 ELSE tp / (tp + fn) END AS r FROM (SELECT {counts} FROM (SELECT so, {said} AS said FROM j)))"


def _table(rows: dict, name: str) -> str:
    one = "SELECT {v} AS {n}, tp, fp, fn, tn, round(p, 6) AS precision, round(r, 6) AS recall, round(CASE WHEN p + r = 0 THEN 0 ELSE 2 * p * r / (p + r) END, 6) AS f1 FROM {q}"
    return _JUDGED + " UNION ALL ".join(one.format(v=v, n=name, q=_scored(q)) for v, q in rows.items())


@query("lk02_verdict", _JUDGED + "SELECT i, tier FROM j")
def verdicts(t):
    return _pairs(t).select("i", codes.verdict(c("left_code"), c("right_code"), c("left_name"), c("right_name")).alias("tier"))


_FUZZY = "a.s_suppkey < b.s_suppkey AND substr(a.s_name, 1, 3) = substr(b.s_name, 1, 3) AND length(a.s_name) >= 8 AND abs(length(a.s_name) - length(b.s_name)) <= 2 AND levenshtein(a.s_name, b.s_name) <= 1 AND a.s_nationkey = b.s_nationkey"


def _supplier_edges(t):
    """Names of one nation that are one edit apart."""
    return linkage.name_edges(t.supplier.select(c("s_suppkey").alias("id"), c("s_name").alias("name"), "s_nationkey"), edit=1, within=("s_nationkey",))


_CLOSURE = f"""
WITH RECURSIVE e AS (SELECT a.s_suppkey AS a, b.s_suppkey AS b FROM supplier a JOIN supplier b ON {_FUZZY}),
u AS (SELECT a, b FROM e UNION SELECT b, a FROM e), r AS (SELECT s_suppkey AS id, s_suppkey AS k FROM supplier UNION SELECT r.id, u.b FROM r JOIN u ON r.k = u.a)
SELECT id, min(k) AS cluster FROM r GROUP BY 1"""


@query("lk07_entities", _CLOSURE)
def entities(t):
    return linkage.clusters(t.supplier.select(c("s_suppkey").alias("id")), _supplier_edges(t))


@query("lk07_golden_records", f"SELECT cluster, min(s_name) AS representative, count(*) AS members FROM ({_CLOSURE}) JOIN supplier ON id = s_suppkey GROUP BY 1")
def golden(t):
    found = linkage.clusters(t.supplier.select(c("s_suppkey").alias("id")), _supplier_edges(t))
    rows = found.join(t.supplier, c("id") == c("s_suppkey")).select("id", "cluster", c("s_name").alias("code"), c("s_name").alias("name"), F.array(F.lit("imp")).alias("roles"))
    return linkage.golden(rows).select("cluster", "representative", "members")


@query("lk08_incremental", f"SELECT min(id) OVER (PARTITION BY cluster) AS cluster, id FROM ({_CLOSURE})")
def incremental(t):
    """Even suppliers were resolved before; odd ones and their edges arrive."""
    edges = cut(_supplier_edges(t))
    before = t.supplier.where("s_nationkey < 12").select(c("s_suppkey").alias("id"))
    old = linkage.clusters(before, edges.join(before.withColumnRenamed("id", "a"), "a", "left_semi").join(before.withColumnRenamed("id", "b"), "b", "left_semi"))
    missing = t.supplier.select(c("s_suppkey").alias("a"), c("s_suppkey").alias("b"))
    new = cut(linkage.rejoin(old, edges.union(missing)).select("id", "cluster"))
    least = new.groupBy("cluster").agg(F.min("id").alias("least"))
    return new.join(least, "cluster").select(c("least").alias("cluster"), "id")


_SAID = {
    "'exact_name'": "an = bn", "'fuzzy_name'": _NEAR_SQL(2), "'same_code'": "a = b", "'code_relation'": "rel = 'same'",
    "'name_unless_code_differs'": f"({_NEAR_SQL(2)} AND rel <> 'diff')", "'very_near_name'": "(d / greatest(long, 1) <= 0.03 AND rel <> 'diff')", "'verdict'": "tier IN ('merge', 'bridge')",
}


@query("lk10_strategies", _table(_SAID, "strategy"))
def strategies(t):
    """Pairs of every order as a gold set, all seven strategies."""
    return linkage.strategies(_pairs(t))


@query("lk10_sweep", _table({k: f"({_NEAR_SQL(k)} AND rel <> 'diff')" for k in (1, 2, 3, 4)}, "edit"))
def sweep(t):
    return linkage.edit_sweep(_pairs(t))


@query("lk11_bands", "WITH p AS (SELECT levenshtein(a.n_name, b.n_name) AS d, greatest(length(a.n_name), length(b.n_name)) AS m FROM nation a JOIN nation b ON a.n_nationkey < b.n_nationkey) SELECT CASE WHEN d = 0 THEN 'EXACT' WHEN d <= 2 THEN 'NEAR' WHEN d <= 6 THEN 'MID' ELSE 'FAR' END AS band, count(*) AS n FROM p GROUP BY 1")
def bands(t):
    a, b = t.nation.alias("a"), t.nation.alias("b")
    d = F.levenshtein(c("a.n_name"), c("b.n_name"))
    band = F.when(d == 0, "EXACT").when(d <= 2, "NEAR").when(d <= 6, "MID").otherwise("FAR")
    return a.join(b, F.expr("a.n_nationkey < b.n_nationkey")).select(band.alias("band")).groupBy("band").agg(F.count("*").alias("n"))


@query("snk01_insert_absent", "SELECT DISTINCT o_custkey FROM orders WHERE o_custkey NOT IN (SELECT user_id FROM events)")
def absent(t):
    return insert_absent(t.events.select(c("user_id").alias("o_custkey")), t.orders.select("o_custkey"), "o_custkey")


# vectors and search

_DOT = "list_inner_product(CAST({0} AS DOUBLE[]), CAST({1} AS DOUBLE[]))"
_COS = f"({_DOT.format('v.embedding', 'q.embedding')} / (sqrt({_DOT.format('v.embedding', 'v.embedding')}) * sqrt({_DOT.format('q.embedding', 'q.embedding')})))"


def _vec(t):
    return t.embeddings.select(c("vec_id").alias("id"), "embedding", "label")


@query("jn25_exact_knn", f"SELECT query, id, round(score, 6) AS score, k AS rank FROM (SELECT q.vec_id AS query, v.vec_id AS id, {_COS} AS score, row_number() OVER (PARTITION BY q.vec_id ORDER BY {_COS} DESC, v.vec_id) AS k FROM embeddings v, embeddings q WHERE q.vec_id % 100 = 0) WHERE k <= 10")
def exact_knn(t):
    v = _vec(t)
    found = vectors.nearest(v, v.where("id % 100 = 0"), 10)
    return found.select("query", "id", F.round("score", 6).alias("score"), c("rank").cast("long").alias("rank"))


def _query_vector(t):
    return t.embeddings.orderBy("vec_id").limit(1)


_ONE = "(SELECT embedding FROM embeddings ORDER BY vec_id LIMIT 1) q"


@query("vec06_theme_count", f"SELECT count(*) AS n, arg_max(vec_id, (round({_COS}, 9), -vec_id)) AS best FROM embeddings v, {_ONE} WHERE {_COS} >= 0.2")
def theme_count(t):
    hits = vectors.theme(t.embeddings, _query_vector(t), 0.2)
    return hits.agg(F.count("*").alias("n"), F.max_by("vec_id", F.struct(F.round("score", 9), -c("vec_id"))).alias("best"))


@query("vec07_sweep", " UNION ALL ".join(f"SELECT CAST({s} AS DOUBLE) AS least, count(*) AS n FROM embeddings v, {_ONE} WHERE {_COS} >= {s}" for s in ("0.1", "0.15", "0.2", "0.25")))
def sweep(t):
    every = vectors.theme(t.embeddings, _query_vector(t), -2.0)
    steps = F.explode(F.array(*[F.lit(s) for s in (0.1, 0.15, 0.2, 0.25)])).alias("least")
    return every.select("score", steps).groupBy("least").agg(F.count_if(c("score") >= c("least")).alias("n"))


@query("jn22_topk_join", f"WITH h AS (SELECT v.vec_id, {_COS} AS s FROM embeddings v, {_ONE} ORDER BY s DESC, v.vec_id LIMIT 80) SELECT vec_id, o_totalprice FROM h JOIN orders ON o_orderkey = vec_id + 1")
def topk_join(t):
    hits = vectors.theme(t.embeddings, _query_vector(t), -2.0).orderBy(c("score").desc(), "vec_id").limit(80)
    return hits.join(t.orders, c("o_orderkey") == c("vec_id") + 1).select("vec_id", "o_totalprice")


@query("vec08_price_estimate", f"""
WITH h AS (SELECT v.vec_id, {_COS} AS s FROM embeddings v, {_ONE} ORDER BY s DESC, v.vec_id LIMIT 80),
d AS (SELECT l_discount AS d FROM h JOIN lineitem ON l_orderkey = vec_id + 1 WHERE l_extendedprice > 0 AND l_discount >= 0 AND l_discount < 1),
x AS (SELECT count(*) AS n, avg(CASE WHEN d < 0.005 THEN 1.0 ELSE 0.0 END) AS z, list_sort(list(d)) AS s FROM d)
SELECT n, round(z, 6) AS zero_share, round(s[CAST(least(n - 1, floor(0.25 * n)) AS INT) + 1], 6) AS p25, round(s[CAST(least(n - 1, floor(0.5 * n)) AS INT) + 1], 6) AS median,
  round(s[CAST(least(n - 1, floor(0.75 * n)) AS INT) + 1], 6) AS p75 FROM x WHERE n >= 5""")
def price_estimate(t):
    hits = vectors.theme(t.embeddings, _query_vector(t), -2.0).orderBy(c("score").desc(), "vec_id").limit(80)
    base = hits.join(t.lineitem, c("l_orderkey") == c("vec_id") + 1)
    rows = base.select(F.lit(1.0).alias("base"), (1.0 - c("l_discount")).alias("award")).where("award > 0")
    return vectors.estimate(rows, 100_000.0).select("n", "zero_share", "p25", "median", "p75")


@query("vec12_recall", "SELECT count(*) AS asked, true AS enough, true AS fewer FROM embeddings WHERE vec_id % 100 = 0")
def recall(t):
    """Recall of the lists is 0.9 or more, at less than all pairs."""
    v = _vec(t).select("id", "embedding")
    q = v.where("id % 100 = 0")
    lists = vectors.fit_lists(v)
    found, share = vectors.recall(vectors.approximate(v, q, 10, lists), vectors.nearest(v, q, 10)), vectors.compared_share(v, q, lists)
    return q.agg(F.count("*").alias("asked")).crossJoin(found).crossJoin(share).select("asked", (c("recall") >= 0.9).alias("enough"), (c("share") < 0.9).alias("fewer"))  # rows of one


_OPEN = f"SELECT vec_id AS id, round({_COS}, 6) AS score FROM embeddings v, {_ONE} WHERE {{}} ORDER BY {_COS} DESC, vec_id LIMIT {{}}"


@query("tl04_semantic_search", _OPEN.format("label % 2 = 0", 8))
def semantic_search(t):
    """Nearest to one text among rows that a filter keeps, exact where there is no index."""
    one = _query_vector(t).select(c("vec_id").alias("id"), "embedding")
    return vectors.search(_vec(t), one, 8, where=c("label") % 2 == 0).select("id", F.round("score", 6).alias("score"))


@query("vec04_filtered_lists", "SELECT count(*) AS found, true AS kept FROM (SELECT 1 FROM embeddings WHERE vec_id % 100 = 0), range(5)")
def filtered_lists(t):
    """The filter goes before the search, so k rows are found for each query."""
    v = _vec(t)
    found = vectors.search(v, v.where("id % 100 = 0"), 5, vectors.fit_lists(v), c("label") % 2 == 0)
    labels = found.join(v.select("id", "label"), "id")
    return labels.agg(F.count("*").alias("found"), F.bool_and(c("label") % 2 == 0).alias("kept"))


_CUT = [f"CAST({x}.embedding[1:16] AS DOUBLE[])" for x in "vq"]
_CUT_COS = f"(list_inner_product({_CUT[0]}, {_CUT[1]}) / sqrt(list_inner_product({_CUT[0]}, {_CUT[0]}) * list_inner_product({_CUT[1]}, {_CUT[1]})))"


@query("vec10_truncated", f"SELECT vec_id AS id, round({_CUT_COS}, 6) AS score FROM embeddings v, {_ONE} ORDER BY {_CUT_COS} DESC, vec_id LIMIT 10")
def truncated(t):
    short = _vec(t).withColumn("embedding", vectors.truncated(c("embedding"), 16))
    return vectors.nearest(short, short.orderBy("id").limit(1), 10).select("id", F.round("score", 6).alias("score"))


@query("snk16_vector_index", "SELECT count(*) AS n, count(*) AS distinct_ids, true AS one_list FROM embeddings")
def vector_index(t):
    """Vectors written in folders by list and read again: every row once, in the list of its nearest centre."""
    from tarnweave.plans.storage import _folder

    v, path = _vec(t), _folder(t)
    lists = vectors.fit_lists(v)
    vectors.indexed(v, lists).write.partitionBy("list").parquet(path)
    back = t.spark.read.parquet(path)
    again = vectors.indexed(back.withColumnRenamed("list", "was"), lists)
    return again.agg(F.count("*").alias("n"), F.countDistinct("id").alias("distinct_ids"), F.bool_and(c("list") == c("was")).alias("one_list"))


@query("gr08_entity_search", f"SELECT s_suppkey AS id, s_name AS name, w AS wins FROM (SELECT l_suppkey, count(*) AS w FROM lineitem GROUP BY 1) JOIN supplier ON s_suppkey = l_suppkey WHERE list_min(list_transform(list_filter(regexp_split_to_array(lower(s_name), '[^a-z0-9#]+'), lambda x: x <> ''), lambda x: levenshtein(x, 'suplier'))) <= 2 ORDER BY list_min(list_transform(list_filter(regexp_split_to_array(lower(s_name), '[^a-z0-9#]+'), lambda x: x <> ''), lambda x: levenshtein(x, 'suplier') / greatest(length(x), 7))), w DESC, s_suppkey LIMIT 10")
def entity_search(t):
    wins = t.lineitem.groupBy("l_suppkey").agg(F.count("*").alias("wins"))
    rows = t.supplier.join(wins, c("s_suppkey") == c("l_suppkey")).select(c("s_suppkey").alias("id"), c("s_name").alias("name"), "wins")
    return lookup.search(rows, "Suplier").select("id", "name", "wins")


@query("tl01_read_only_sql", f"SELECT o_orderpriority, count(*) AS n, {M.format('o_totalprice')} AS total FROM orders WHERE o_totalprice > 1000 GROUP BY 1")
def read_only_sql(t):
    t.orders.createOrReplaceTempView("tw_orders")
    text = "SELECT o_orderpriority, count(*) AS n, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total FROM tw_orders WHERE o_totalprice > :least GROUP BY 1"
    return lookup.run_sql(t.spark, text, {"least": 1000})


@query("tl15_chat_history", "SELECT conv_id, count(*) AS turns, arg_max(role, (turn, text)) AS last_role, CAST(sum(length(text)) AS BIGINT) AS size FROM conversations GROUP BY 1")
def chat_history(t):
    return t.conversations.groupBy("conv_id").agg(
        F.count("*").alias("turns"), F.max_by("role", F.struct("turn", "text")).alias("last_role"), F.sum(F.length("text")).cast("long").alias("size")
    )


@query("src21_sample")
def sample(t):
    """A random sample of 100 rows that is the same in every run."""
    return t.orders.orderBy(F.xxhash64("o_orderkey"), "o_orderkey").limit(100).select("o_orderkey")


@query(
    "src07_window_split",
    """WITH RECURSIVE d AS (SELECT CAST(ts AS DATE) AS d, count(*) AS n FROM events GROUP BY 1),
    w(a, b, n) AS (SELECT min(d), max(d), sum(n) FROM d
      UNION ALL SELECT x.a, x.b, (SELECT coalesce(sum(n), 0) FROM d WHERE d BETWEEN x.a AND x.b)
      FROM (SELECT unnest([{'a': a, 'b': a + CAST((b - a) // 2 AS INT)}, {'a': a + CAST((b - a) // 2 AS INT) + 1, 'b': b}]) AS x FROM w WHERE n > 300 AND a < b))
    SELECT strftime(a, '%Y-%m-%d') AS first_day, strftime(b, '%Y-%m-%d') AS last_day, CAST(n AS BIGINT) AS n FROM w WHERE n > 0 AND (n <= 300 OR a = b)""",
)
def window_split(t):
    from tarnweave.sources.paging import windows

    day = lambda x: F.date_format(x, "yyyy-MM-dd").alias(x)
    return windows(t.events, "ts", 300).select(day("first_day"), day("last_day"), "n")


def _rules(t) -> dict:
    return {"rf1": rf1(t), "rf2": rf2(t), "rf3": rf3(t), "rf4": rf4(t), "rf5": rf5(t), "rf6": rf6(t), "rf7": rf7(t)}


@query("rf9_replaced_slices", f"SELECT rule, severity, count(*) AS n FROM ({_ALL.replace(RF4, RF4.replace('> 6', '> 9').replace('> 3', '> 5'))}) GROUP BY ALL")
def replaced_slices(t):
    """All rules run; then one runs again with other thresholds and replaces its own findings."""
    path = f"{shared_dir(t.spark)}/findings-{uuid.uuid4().hex}"
    anomalies.run_rules(_rules(t), path)
    anomalies.run_rules({"rf4": anomalies.many_notices(_notices(t), 5, 9)}, path)
    return t.spark.read.parquet(path).groupBy("rule", "severity").agg(F.count("*").alias("n"))


_KEYED = " UNION ALL ".join(
    f"SELECT '{k}' AS rule, severity, {'lot' if k in ('rf4', 'rf5') else 'NULL'} AS lot, {'NULL' if k in ('rf4', 'rf5') else 'sa'} AS sa, {'NULL' if k in ('rf4', 'rf5') else 'imp'} AS imp FROM ({q})"
    for k, q in (("rf1", RF1), ("rf2", RF2), ("rf3", RF3), ("rf4", RF4), ("rf5", RF5), ("rf6", RF6), ("rf7", RF7))
)


@query("rf11_top_findings", f"SELECT rule, severity, CAST(lot AS BIGINT) AS lot, CAST(sa AS BIGINT) AS sa, CAST(imp AS BIGINT) AS imp, rank FROM (SELECT *, row_number() OVER (PARTITION BY rule ORDER BY CASE severity WHEN 'high' THEN 0 WHEN 'medium' THEN 1 ELSE 2 END, lot, sa, imp) AS rank FROM ({_KEYED})) WHERE rank <= 3")
def top_findings(t):
    """Findings are written once, the status reads the three worst of each rule."""
    path = f"{shared_dir(t.spark)}/findings-{uuid.uuid4().hex}"
    anomalies.run_rules(_rules(t), path)
    return anomalies.worst(t.spark.read.parquet(path), 3)
