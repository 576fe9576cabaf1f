"""Aggregates, joins, windows, sorts, set operations and filters over the order tables.

Authorities are customers, companies suppliers, lots orders, awards and notices order lines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tarnweave.functions.codes import money, near_names, percentile_floor
from tarnweave.operators.records import cap_per_key, first_known, upsert

from .durable import small_tasks
from .registry import query

c = F.col


def awards(t) -> DataFrame:
    """Path authority, lot, company: one row per order line."""
    small_tasks(t.spark)
    return t.lineitem.join(t.orders, c("l_orderkey") == c("o_orderkey"))


PATH = "lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey"
M = "CAST(coalesce(sum(CAST({} AS DECIMAL(18,2))), 0) AS DOUBLE)"
PRICE = M.format("l_extendedprice")


@query("agg04_top_winners", f"SELECT s_suppkey, s_name, {PRICE} AS total, count(*) AS n FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY ALL ORDER BY total DESC, s_suppkey LIMIT 10")
def top_winners(t):
    won = t.lineitem.groupBy("l_suppkey").agg(money(c("l_extendedprice")).alias("total"), F.count("*").alias("n"))
    named = won.join(t.supplier, c("l_suppkey") == c("s_suppkey")).select("s_suppkey", "s_name", "total", "n")
    return named.orderBy(c("total").desc(), "s_suppkey").limit(10)


@query("agg29_global", f"SELECT count(*) AS n, count(o_totalprice) AS n_known, {M.format('o_totalprice')} AS total FROM orders")
def global_counts(t):
    return t.orders.agg(F.count("*").alias("n"), F.count("o_totalprice").alias("n_known"), money(c("o_totalprice")).alias("total"))


@query("agg01_counts", "SELECT 'orders' AS label, count(*) AS n FROM orders UNION ALL SELECT 'customer', count(*) FROM customer UNION ALL SELECT 'supplier', count(*) FROM supplier UNION ALL SELECT 'lineitem', count(*) FROM lineitem")
def counts(t):
    out = None
    for name in ("orders", "customer", "supplier", "lineitem"):
        one = getattr(t, name).agg(F.count("*").alias("n")).select(F.lit(name).alias("label"), "n")
        out = one if out is None else out.union(one)
    return out


@query("agg02_group_count_topn", "SELECT event_type, count(*) AS n FROM events GROUP BY 1 ORDER BY n DESC, event_type LIMIT 10")
def group_count(t):
    return t.events.groupBy("event_type").agg(F.count("*").alias("n")).orderBy(c("n").desc(), "event_type").limit(10)


@query("agg03_group_sum", f"SELECT o_orderpriority, {M.format('o_totalprice')} AS total, count(*) AS n FROM orders GROUP BY 1")
def group_sum(t):
    return t.orders.groupBy("o_orderpriority").agg(money(c("o_totalprice")).alias("total"), F.count("*").alias("n"))


@query("agg05_min_max", "SELECT CAST(min(o_orderdate) AS DATE) AS first_day, CAST(max(o_orderdate) AS DATE) AS last_day FROM orders")
def min_max(t):
    return t.orders.agg(F.min("o_orderdate").cast("date").alias("first_day"), F.max("o_orderdate").cast("date").alias("last_day"))


@query("agg06_distinct", f"SELECT o_custkey, count(DISTINCT l_suppkey) AS companies, count(DISTINCT o_orderkey) AS lots FROM {PATH} GROUP BY 1")
def distinct_counts(t):
    return awards(t).groupBy("o_custkey").agg(F.count_distinct("l_suppkey").alias("companies"), F.count_distinct("o_orderkey").alias("lots"))


@query("agg07_collect_slice", f"SELECT l_suppkey, array_to_string(list_sort(list(DISTINCT o_custkey))[1:5], ',') AS buyers FROM {PATH} GROUP BY 1")
def collect_slice(t):
    few = cap_per_key(awards(t).select("l_suppkey", "o_custkey").distinct(), ["l_suppkey"], [c("o_custkey")], 5)
    return few.groupBy("l_suppkey").agg(F.concat_ws(",", F.array_sort(F.collect_list("o_custkey")).cast("array<string>")).alias("buyers"))


@query("agg10_pivot_status", "SELECT o_orderpriority, count(*) FILTER (o_orderstatus = 'F') AS f, count(*) FILTER (o_orderstatus = 'O') AS o, count(*) FILTER (o_orderstatus = 'P') AS p FROM orders GROUP BY 1")
def pivot_status(t):
    one = lambda s: F.count_if(c("o_orderstatus") == s).alias(s.lower())
    return t.orders.groupBy("o_orderpriority").agg(one("F"), one("O"), one("P"))


@query("agg11_conditional_sum", f"SELECT o_custkey, l_suppkey, count(*) FILTER (l_returnflag = 'A') AS a, count(*) FILTER (l_returnflag = 'R') AS r FROM {PATH} GROUP BY ALL HAVING a >= 1 AND r >= 1")
def conditional_sum(t):
    both = awards(t).groupBy("o_custkey", "l_suppkey").agg(
        F.sum(F.when(c("l_returnflag") == "A", 1).otherwise(0)).alias("a"), F.sum(F.when(c("l_returnflag") == "R", 1).otherwise(0)).alias("r")
    )
    return both.where("a >= 1 AND r >= 1")


@query("agg13_supplier_profile", f"SELECT l_suppkey, count(*) AS wins, {PRICE} AS total, array_to_string(list_sort(list(DISTINCT c_name))[1:6], '|') AS buyers FROM {PATH} JOIN customer ON o_custkey = c_custkey GROUP BY 1 ORDER BY wins DESC, l_suppkey LIMIT 3")
def supplier_profile(t):
    won = awards(t).join(t.customer.select("c_custkey", "c_name"), c("o_custkey") == c("c_custkey"))
    best = won.groupBy("l_suppkey").agg(F.count("*").alias("wins"), money(c("l_extendedprice")).alias("total")).orderBy(c("wins").desc(), "l_suppkey").limit(3)
    theirs = won.join(F.broadcast(best.select("l_suppkey")), "l_suppkey", "left_semi").select("l_suppkey", "c_name").distinct()  # three keys
    few = cap_per_key(theirs, ["l_suppkey"], [c("c_name")], 6).groupBy("l_suppkey").agg(F.concat_ws("|", F.array_sort(F.collect_list("c_name"))).alias("buyers"))
    return best.join(few, "l_suppkey").select("l_suppkey", "wins", "total", "buyers")


@query("agg14_concentration", f"WITH w AS (SELECT o_custkey, l_suppkey, count(*) AS wins, {PRICE} AS total FROM {PATH} GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY total DESC, l_suppkey) AS k FROM w) SELECT o_custkey, l_suppkey, wins, total, round(100.0 * wins / CAST(sum(wins) OVER (PARTITION BY o_custkey) AS DOUBLE), 1) AS share FROM r WHERE k <= 10")
def concentration(t):
    won = awards(t).groupBy("o_custkey", "l_suppkey").agg(F.count("*").alias("wins"), money(c("l_extendedprice")).alias("total"))
    top = cap_per_key(won, ["o_custkey"], [c("total").desc(), c("l_suppkey")], 10).drop("rank")
    return top.withColumn("share", F.round(100.0 * c("wins") / F.sum("wins").over(Window.partitionBy("o_custkey")), 1))


@query("agg15_first_nonnull_merge", """
SELECT user_id, arg_min(value, (CAST(event_type <> 'purchase' AS INT), ts, event_id)) FILTER (event_type IN ('purchase', 'click')) AS amount,
  arg_min(props, (ts, event_id)) AS props, arg_max(event_type, (ts, event_id)) AS last_type,
  array_to_string(list_sort(list(DISTINCT event_type)), ',') AS sources FROM events GROUP BY 1""")
def first_known_merge(t):
    seen = F.struct("ts", "event_id")
    source = F.struct((c("event_type") != "purchase").cast("int"), "ts", "event_id")
    return t.events.groupBy("user_id").agg(
        first_known(F.when(c("event_type").isin("purchase", "click"), c("value")), source).alias("amount"),
        first_known("props", seen).alias("props"),
        F.max_by("event_type", seen).alias("last_type"),
        F.concat_ws(",", F.array_sort(F.collect_set("event_type"))).alias("sources"),
    )


@query("agg16_ordered_distinct", """
WITH f AS (SELECT user_id, event_type, min((ts, event_id)) AS k FROM events GROUP BY ALL)
SELECT user_id, string_agg(event_type, '>' ORDER BY k) AS path FROM f GROUP BY 1""")
def ordered_distinct(t):
    first = t.events.groupBy("user_id", "event_type").agg(F.min(F.struct("ts", "event_id")).alias("k"))
    rows = F.array_sort(F.collect_list(F.struct("k", "event_type")))
    return first.groupBy("user_id").agg(F.array_join(F.transform(rows, lambda r: r["event_type"]), ">").alias("path"))


@query("agg19_longest_name", "SELECT source, arg_max(doc_id, (length(text), -doc_id)) AS doc_id, max(length(text)) AS size, array_to_string(list_sort(list(DISTINCT lang)), ',') AS langs FROM documents GROUP BY 1")
def longest_name(t):
    return t.documents.groupBy("source").agg(
        F.max_by("doc_id", F.struct(F.length("text"), -c("doc_id"))).alias("doc_id"),
        F.max(F.length("text")).cast("long").alias("size"),
        F.concat_ws(",", F.array_sort(F.collect_set("lang"))).alias("langs"),
    )


_P = "list_sort(list(o_totalprice))[CAST(least(count(*) - 1, floor({} * count(*))) AS INT) + 1] AS {}"


@query("agg21_percentile_floor", f"SELECT o_orderpriority, o_orderstatus, {_P.format(0.25, 'p25')}, {_P.format(0.5, 'p50')}, {_P.format(0.75, 'p75')} FROM orders GROUP BY ALL")
def percentiles(t):
    return t.orders.groupBy("o_orderpriority", "o_orderstatus").agg(*[percentile_floor("o_totalprice", p).alias(f"p{int(p * 100)}") for p in (0.25, 0.5, 0.75)])


@query("agg22_share_below", "SELECT l_returnflag, round(avg(CASE WHEN l_discount < 0.005 THEN 1.0 ELSE 0.0 END), 6) AS share FROM lineitem GROUP BY 1")
def share_below(t):
    return t.lineitem.groupBy("l_returnflag").agg(F.round(F.avg(F.when(c("l_discount") < 0.005, 1.0).otherwise(0.0)), 6).alias("share"))


@query("agg23_confusion", """
WITH x AS (SELECT count(*) FILTER (quality = 1 AND toxic = 1) AS tp, count(*) FILTER (quality = 1 AND toxic = 0) AS fp,
  count(*) FILTER (quality = 0 AND toxic = 1) AS fn, count(*) FILTER (quality = 0 AND toxic = 0) AS tn FROM labels),
y AS (SELECT *, CASE WHEN tp + fp = 0 THEN 1.0 ELSE tp / (tp + fp) END AS p, CASE WHEN tp + fn = 0 THEN 1.0 ELSE tp / (tp + fn) END AS r FROM x)
SELECT tp, fp, fn, tn, round(p, 6) AS precision, round(r, 6) AS recall, round(CASE WHEN p + r = 0 THEN 0.0 ELSE 2 * p * r / (p + r) END, 6) AS f1 FROM y""")
def confusion(t):
    from tarnweave.operators.linkage import scores

    return scores(t.labels.select((c("quality") == 1).alias("said"), (c("toxic") == 1).alias("so")))


@query("agg24_tally", "SELECT p_type, p_brand, count(*) AS n FROM part GROUP BY ALL")
def tally(t):
    return t.part.groupBy("p_type", "p_brand").agg(F.count("*").alias("n"))


@query("agg25_homonyms", "SELECT p_name, count(DISTINCT p_brand) AS brands FROM part GROUP BY 1 HAVING count(DISTINCT p_brand) >= 2")
def homonyms(t):
    return t.part.groupBy("p_name").agg(F.count_distinct("p_brand").alias("brands")).where("brands >= 2")


_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


@query("agg27_schema_introspection", f"""
SELECT DISTINCT table_name AS "table", column_name AS "column", CASE WHEN data_type = 'INTEGER' THEN 'int' WHEN data_type = 'VARCHAR' THEN 'string' WHEN data_type = 'FLOAT[]' THEN 'array<float>'
  WHEN data_type = 'TIMESTAMP' THEN 'timestamp_ntz' WHEN data_type LIKE 'TIMESTAMP%' THEN 'timestamp' ELSE lower(data_type) END AS type FROM information_schema.columns WHERE table_name IN {_TABLES}""")
def introspection(t):
    rows = [(n, f.name, f.dataType.simpleString()) for n in _TABLES for f in getattr(t, n).schema]
    return t.spark.createDataFrame(rows, "table string, column string, type string")


@query("agg28_blocking", "WITH b AS (SELECT substr(s_name, 1, 3) AS k, count(*) AS n FROM supplier GROUP BY 1), x AS (SELECT CAST(sum(n) AS BIGINT) AS n, CAST(sum(n * (n - 1) / 2) AS BIGINT) AS blocked FROM b) SELECT CAST(n * (n - 1) / 2 AS BIGINT) AS possible, blocked, round(blocked / (n * (n - 1) / 2), 6) AS ratio FROM x")
def blocking(t):
    per = t.supplier.groupBy(F.substring("s_name", 1, 3).alias("k")).agg(F.count("*").alias("n"))
    x = per.agg(F.sum("n").alias("n"), F.sum(c("n") * (c("n") - 1) / 2).cast("long").alias("blocked"))
    possible = c("n") * (c("n") - 1) / 2
    return x.select(possible.cast("long").alias("possible"), "blocked", F.round(c("blocked") / possible, 6).alias("ratio"))


@query("agg30_winner_buyers", f"SELECT l_suppkey, count(DISTINCT o_orderkey) AS lots, count(DISTINCT o_custkey) AS buyers FROM {PATH} GROUP BY 1")
def winner_buyers(t):
    return awards(t).groupBy("l_suppkey").agg(F.count_distinct("o_orderkey").alias("lots"), F.count_distinct("o_custkey").alias("buyers"))


# joins


@query("jn01_semi", "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)")
def semi(t):
    return t.orders.join(t.lineitem, c("o_orderkey") == c("l_orderkey"), "left_semi").select("o_orderkey", "o_orderstatus")


@query("jn02_anti", "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)")
def anti(t):
    return t.orders.join(t.lineitem, c("o_orderkey") == c("l_orderkey"), "left_anti").select("o_orderkey", "o_orderstatus")


@query("jn03_full_outer_upsert", """
WITH o AS (SELECT o_orderkey AS k, o_orderstatus AS s, o_totalprice AS v FROM orders WHERE o_orderstatus <> 'P'),
n AS (SELECT l_orderkey AS k, max(l_linestatus) AS s, max(l_extendedprice) AS v FROM lineitem GROUP BY 1)
SELECT coalesce(n.k, o.k) AS k, CASE WHEN n.k IS NOT NULL THEN n.s ELSE o.s END AS s, CASE WHEN n.k IS NOT NULL THEN n.v ELSE o.v END AS v FROM o FULL JOIN n ON o.k = n.k""")
def full_outer(t):
    old = t.orders.where("o_orderstatus <> 'P'").select(c("o_orderkey").alias("k"), c("o_orderstatus").alias("s"), c("o_totalprice").alias("v"))
    new = t.lineitem.groupBy(c("l_orderkey").alias("k")).agg(F.max("l_linestatus").alias("s"), F.max("l_extendedprice").alias("v"))
    return upsert(old, new, "k")


@query("jn05_left_lookup", "SELECT s_suppkey, n_name FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey AND n_regionkey <= 2")
def left_lookup(t):
    return t.supplier.join(t.nation.where("n_regionkey <= 2"), c("s_nationkey") == c("n_nationkey"), "left").select("s_suppkey", "n_name")


@query("jn06_inner_lookup", "SELECT s_suppkey, n_name, r_name FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey")
def inner_lookup(t):
    return t.supplier.join(t.nation, c("s_nationkey") == c("n_nationkey")).join(t.region, c("n_regionkey") == c("r_regionkey")).select("s_suppkey", "n_name", "r_name")


@query("jn07_same_name_pairs", "SELECT a.p_name, count(*) AS pairs FROM part a JOIN part b ON a.p_name = b.p_name AND a.p_partkey < b.p_partkey GROUP BY 1")
def same_name_pairs(t):
    per = t.part.groupBy("p_name").agg(F.count("*").alias("n"))  # pairs of a name follow from its count
    return per.where("n > 1").select("p_name", (c("n") * (c("n") - 1) / 2).cast("long").alias("pairs"))


@query("jn08_same_lot_pairs", "SELECT a.l_suppkey AS a, b.l_suppkey AS b, count(*) AS n FROM (SELECT DISTINCT l_orderkey, l_suppkey FROM lineitem) a JOIN (SELECT DISTINCT l_orderkey, l_suppkey FROM lineitem) b ON a.l_orderkey = b.l_orderkey AND a.l_suppkey < b.l_suppkey GROUP BY ALL")
def same_lot_pairs(t):
    d = t.lineitem.select("l_orderkey", "l_suppkey").distinct()
    a, b = d.alias("a"), d.alias("b")
    pairs = a.join(b, F.expr("a.l_orderkey = b.l_orderkey AND a.l_suppkey < b.l_suppkey"))
    return pairs.groupBy(c("a.l_suppkey").alias("a"), c("b.l_suppkey").alias("b")).agg(F.count("*").alias("n"))


_NEAR = "((a.s_name = b.s_name AND a.s_name <> '') OR (least(length(a.s_name), length(b.s_name)) >= 8 AND abs(length(a.s_name) - length(b.s_name)) <= 2 AND levenshtein(a.s_name, b.s_name) BETWEEN 1 AND 2 AND levenshtein(a.s_name, b.s_name) / least(length(a.s_name), length(b.s_name)) <= 0.2))"


@query("jn09_blocked_fuzzy", f"SELECT a.s_suppkey AS a, b.s_suppkey AS b, levenshtein(a.s_name, b.s_name) AS edit, round(1 - levenshtein(a.s_name, b.s_name) / greatest(length(a.s_name), length(b.s_name)), 3) AS score FROM supplier a JOIN supplier b ON substr(a.s_name, 1, 3) = substr(b.s_name, 1, 3) AND a.s_suppkey < b.s_suppkey WHERE {_NEAR}")
def blocked_fuzzy(t):
    from tarnweave.operators.linkage import fuzzy_pairs

    names = t.supplier.select(c("s_suppkey").alias("id"), c("s_name").alias("name"))
    p = fuzzy_pairs(names)
    longest = F.greatest(F.length("a_name"), F.length("b_name"))
    d = F.levenshtein("a_name", "b_name")
    return p.select("a", "b", d.cast("long").alias("edit"), F.round(1 - d / longest, 3).alias("score"))


@query("jn11_anti_pairs", f"SELECT a.s_suppkey AS a, b.s_suppkey AS b FROM supplier a JOIN supplier b ON substr(a.s_name, 1, 3) = substr(b.s_name, 1, 3) AND a.s_suppkey < b.s_suppkey WHERE {_NEAR} AND a.s_nationkey <> b.s_nationkey")
def anti_pairs(t):
    from tarnweave.operators.linkage import fuzzy_pairs

    names = t.supplier.select(c("s_suppkey").alias("id"), c("s_name").alias("name"), c("s_nationkey").alias("nation"))
    return fuzzy_pairs(names, carry=("nation",)).where("a_nation <> b_nation").select("a", "b")


_HOPS = "region JOIN nation ON r_regionkey = n_regionkey JOIN customer ON n_nationkey = c_nationkey"


@query("jn12_path", f"SELECT r_name, count(*) AS n, count(DISTINCT o_orderkey) AS lots, {PRICE} AS total FROM {_HOPS} JOIN orders ON c_custkey = o_custkey JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1")
def path(t):
    home = t.customer.join(t.nation, c("c_nationkey") == c("n_nationkey")).join(t.region, c("n_regionkey") == c("r_regionkey"))
    rows = awards(t).join(home, c("o_custkey") == c("c_custkey"))
    return rows.groupBy("r_name").agg(F.count("*").alias("n"), F.count_distinct("o_orderkey").alias("lots"), money(c("l_extendedprice")).alias("total"))


@query("jn13_optional_path", f"SELECT c_custkey, count(l_orderkey) AS n, {PRICE} AS total FROM customer LEFT JOIN (orders JOIN lineitem ON o_orderkey = l_orderkey AND l_returnflag = 'R') ON c_custkey = o_custkey GROUP BY 1")
def optional_path(t):
    sub = awards(t).where("l_returnflag = 'R'")
    return t.customer.join(sub, c("c_custkey") == c("o_custkey"), "left").groupBy("c_custkey").agg(F.count("l_orderkey").alias("n"), money(c("l_extendedprice")).alias("total"))


@query("jn14_ratio", f"WITH p AS (SELECT o_custkey, l_suppkey, count(DISTINCT o_orderkey) AS n FROM {PATH} GROUP BY ALL), q AS (SELECT o_custkey, count(DISTINCT o_orderkey) AS lots FROM {PATH} GROUP BY 1) SELECT o_custkey, l_suppkey, n, lots, round(n / lots, 6) AS share FROM p JOIN q USING (o_custkey) WHERE lots >= 3 AND n / lots > 0.4")
def ratio(t):
    p = awards(t).groupBy("o_custkey", "l_suppkey").agg(F.count_distinct("o_orderkey").alias("n"))
    q = awards(t).groupBy("o_custkey").agg(F.count_distinct("o_orderkey").alias("lots"))
    return p.join(q, "o_custkey").withColumn("share", F.round(c("n") / c("lots"), 6)).where("lots >= 3 AND n / lots > 0.4")


@query("jn15_share", f"WITH p AS (SELECT l_suppkey, c_nationkey, {PRICE} AS total, count(*) AS n FROM {PATH} JOIN customer ON o_custkey = c_custkey GROUP BY ALL) SELECT l_suppkey, c_nationkey, n, total, round(total / sum(total) OVER (PARTITION BY l_suppkey), 6) AS share FROM p")
def share(t):
    p = awards(t).join(t.customer, c("o_custkey") == c("c_custkey")).groupBy("l_suppkey", "c_nationkey").agg(money(c("l_extendedprice")).alias("total"), F.count("*").alias("n"))
    return p.withColumn("share", F.round(c("total") / F.sum("total").over(Window.partitionBy("l_suppkey")), 6))


@query("jn16_competitors", f"WITH w AS (SELECT l_suppkey, o_custkey, count(*) AS n FROM {PATH} GROUP BY ALL), m AS (SELECT o_custkey FROM w WHERE l_suppkey = (SELECT min(s_suppkey) FROM supplier)) SELECT l_suppkey, count(*) AS buyers, CAST(sum(n) AS BIGINT) AS paths FROM w JOIN m USING (o_custkey) WHERE l_suppkey <> (SELECT min(s_suppkey) FROM supplier) GROUP BY 1 ORDER BY buyers DESC, l_suppkey LIMIT 8")
def competitors(t):
    from tarnweave.operators.network import competitors as rivals

    seed = t.supplier.agg(F.min("s_suppkey").alias("seed"))
    return rivals(awards(t).select(c("l_suppkey").alias("company"), c("o_custkey").alias("buyer")), seed, 8).withColumnRenamed("company", "l_suppkey")


@query("jn17_ego", f"SELECT l_suppkey, count(*) AS n, {PRICE} AS total FROM {PATH} WHERE o_custkey = (SELECT min(o_custkey) FROM orders) GROUP BY 1 ORDER BY n DESC, total DESC, l_suppkey LIMIT 12")
def ego(t):
    who = t.orders.agg(F.min("o_custkey").alias("who"))
    own = awards(t).join(who, c("o_custkey") == c("who"), "left_semi")
    rows = own.groupBy("l_suppkey").agg(F.count("*").alias("n"), money(c("l_extendedprice")).alias("total"))
    return rows.orderBy(c("n").desc(), c("total").desc(), "l_suppkey").limit(12)


@query("jn18_common_buyers", f"WITH e AS (SELECT DISTINCT o_custkey, o_orderkey, l_suppkey FROM {PATH} WHERE l_suppkey IN (1, 2)) SELECT DISTINCT a.o_custkey FROM e a JOIN e b ON a.o_custkey = b.o_custkey AND a.o_orderkey <> b.o_orderkey WHERE a.l_suppkey = 1 AND b.l_suppkey = 2")
def common_buyers(t):
    e = awards(t).where(c("l_suppkey").isin(1, 2)).select("o_custkey", "o_orderkey", "l_suppkey").distinct()
    a, b = e.where("l_suppkey = 1").alias("a"), e.where("l_suppkey = 2").alias("b")
    return a.join(b, F.expr("a.o_custkey = b.o_custkey AND a.o_orderkey <> b.o_orderkey")).select("a.o_custkey").distinct()


@query("jn21_classify_keys", "SELECT k, CASE WHEN c_custkey IS NOT NULL THEN 'sa' WHEN s_suppkey IS NOT NULL THEN 'imp' END AS kind FROM (SELECT DISTINCT l_partkey AS k FROM lineitem) LEFT JOIN customer ON k = c_custkey LEFT JOIN supplier ON k = s_suppkey")
def classify_keys(t):
    k = t.lineitem.select(c("l_partkey").alias("k")).distinct()
    both = k.join(t.customer, c("k") == c("c_custkey"), "left").join(t.supplier, c("k") == c("s_suppkey"), "left")
    return both.select("k", F.when(c("c_custkey").isNotNull(), "sa").when(c("s_suppkey").isNotNull(), "imp").alias("kind"))


@query("jn19_first_link", "SELECT conv_id, arg_min(text, turn) FILTER (role = 'assistant') AS first_answer FROM conversations GROUP BY 1")
def first_link(t):
    return t.conversations.groupBy("conv_id").agg(F.min_by(F.when(c("role") == "assistant", c("text")), F.when(c("role") == "assistant", c("turn"))).alias("first_answer"))


@query("jn26_far_pairs", "SELECT a.n_name AS a, b.n_name AS b FROM nation a JOIN nation b ON substr(a.n_name, 1, 3) <> substr(b.n_name, 1, 3) AND a.n_nationkey < b.n_nationkey")
def far_pairs(t):
    a, b = t.nation.alias("a"), t.nation.alias("b")  # nations are few by nature; other inputs go through blocks
    return a.join(b, F.expr("substr(a.n_name, 1, 3) <> substr(b.n_name, 1, 3) AND a.n_nationkey < b.n_nationkey")).select(c("a.n_name").alias("a"), c("b.n_name").alias("b"))


@query("jn28_chain", "WITH e AS (SELECT user_id, event_id, lag(event_id) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS older FROM events) SELECT event_id AS newer, older FROM e WHERE older IS NOT NULL")
def chain(t):
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    return t.events.select(c("event_id").alias("newer"), F.lag("event_id").over(w).alias("older")).where("older IS NOT NULL")


# windows, sorts, sets

_LINE = "l_extendedprice DESC, l_orderkey, l_linenumber, l_partkey, l_suppkey"


@query("win01_cap_per_group", f"SELECT l_suppkey, l_orderkey, l_linenumber, k FROM (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY {_LINE}) AS k FROM lineitem) WHERE k <= 50")
def capped(t):
    line = [c("l_extendedprice").desc(), c("l_orderkey"), c("l_linenumber"), c("l_partkey"), c("l_suppkey")]
    return cap_per_key(t.lineitem, ["l_suppkey"], line, 50).select("l_suppkey", "l_orderkey", "l_linenumber", c("rank").cast("long").alias("k"))


@query("win02_top3", "SELECT event_type, event_id, k FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY value DESC, event_id) AS k FROM events) WHERE k <= 3")
def top3(t):
    return cap_per_key(t.events, ["event_type"], [c("value").desc(), c("event_id")], 3).select("event_type", "event_id", c("rank").cast("long").alias("k"))


@query("win03_latest", "SELECT user_id, arg_max(event_id, (ts, event_id)) AS event_id FROM events GROUP BY 1")
def latest(t):
    return t.events.groupBy("user_id").agg(F.max_by("event_id", F.struct("ts", "event_id")).alias("event_id"))


@query("win04_share_of_total", "SELECT event_type, count(*) AS n, round(100.0 * count(*) / CAST(sum(count(*)) OVER () AS DOUBLE), 1) AS share FROM events GROUP BY 1")
def share_of_total(t):
    per = t.events.groupBy("event_type").agg(F.count("*").alias("n"))
    return per.crossJoin(per.agg(F.sum("n").alias("total"))).select("event_type", "n", F.round(100.0 * c("n") / c("total"), 1).alias("share"))


@query("win05_quota", "WITH a AS (SELECT *, row_number() OVER (PARTITION BY p_type, p_brand ORDER BY p_partkey) AS k FROM part), b AS (SELECT *, row_number() OVER (PARTITION BY p_type ORDER BY k, p_brand) AS j FROM a WHERE k <= 2) SELECT p_partkey, k, j FROM b WHERE j <= 36")
def quota(t):
    a = t.part.withColumn("k", F.row_number().over(Window.partitionBy("p_type", "p_brand").orderBy("p_partkey")).cast("long")).where("k <= 2")
    b = a.withColumn("j", F.row_number().over(Window.partitionBy("p_type").orderBy("k", "p_brand")).cast("long"))
    return b.where("j <= 36").select("p_partkey", "k", "j")


@query("win06_row_ids", "SELECT s_suppkey, row_number() OVER (ORDER BY s_name, s_suppkey) AS id FROM supplier")
def row_ids(t):
    from tarnweave.operators.network import numbered

    return numbered(t.supplier.select("s_suppkey", "s_name"), ["s_name", "s_suppkey"], "id").select("s_suppkey", "id")


@query("win08_first_in_array", "WITH f AS (SELECT l_orderkey, l_suppkey, min((l_linenumber, l_partkey, l_extendedprice)) AS k FROM lineitem GROUP BY ALL) SELECT l_orderkey, string_agg(CAST(l_suppkey AS VARCHAR), ',' ORDER BY k, l_suppkey) AS companies FROM f GROUP BY 1")
def first_in_array(t):
    f = t.lineitem.groupBy("l_orderkey", "l_suppkey").agg(F.min(F.struct("l_linenumber", "l_partkey", "l_extendedprice")).alias("k"))
    rows = F.array_sort(F.collect_list(F.struct("k", "l_suppkey")))
    return f.groupBy("l_orderkey").agg(F.array_join(F.transform(rows, lambda r: r["l_suppkey"].cast("string")), ",").alias("companies"))


@query("srt02_nulls", "WITH x AS (SELECT c_custkey, max(o_orderdate) AS d FROM customer LEFT JOIN orders ON c_custkey = o_custkey AND o_orderstatus = 'P' GROUP BY 1) SELECT c_custkey, CAST(d AS DATE) AS day FROM x ORDER BY d DESC NULLS LAST, c_custkey LIMIT 50")
def nulls_last(t):
    x = t.customer.join(t.orders.where("o_orderstatus = 'P'"), c("c_custkey") == c("o_custkey"), "left").groupBy("c_custkey").agg(F.max("o_orderdate").alias("d"))
    return x.orderBy(c("d").desc_nulls_last(), "c_custkey").limit(50).select("c_custkey", c("d").cast("date").alias("day"))


@query("srt09_distinct_order", "SELECT DISTINCT l_suppkey, l_returnflag, l_linestatus FROM lineitem ORDER BY 1, 2, 3 LIMIT 50")
def distinct_order(t):
    return t.lineitem.select("l_suppkey", "l_returnflag", "l_linestatus").distinct().orderBy("l_suppkey", "l_returnflag", "l_linestatus").limit(50)


@query("srt10_keyset", "SELECT event_id, user_id FROM events WHERE (ts, event_id) > (SELECT min((ts, event_id)) FROM events) ORDER BY ts, event_id LIMIT 100")
def keyset(t):
    from tarnweave.sources.paging import keyset_page

    first = t.events.agg(F.min(F.struct("ts", "event_id")).alias("k")).first().k
    return keyset_page(t.events, ["ts", "event_id"], (first.ts, first.event_id), 100).select("event_id", "user_id")


@query("set01_union_all", "SELECT kind, count(*) AS n FROM (SELECT 'order' AS kind, o_orderkey AS k FROM orders UNION ALL SELECT 'event', event_id FROM events) GROUP BY 1")
def union_all(t):
    a = t.orders.select(F.lit("order").alias("kind"), c("o_orderkey").alias("k"))
    return a.unionByName(t.events.select(F.lit("event").alias("kind"), c("event_id").alias("k"))).groupBy("kind").agg(F.count("*").alias("n"))


@query("set02_roles", "SELECT k, array_to_string(list_sort(list(DISTINCT role)), ',') AS roles FROM (SELECT c_custkey AS k, 'sa' AS role FROM customer UNION ALL SELECT s_suppkey, 'imp' FROM supplier) GROUP BY 1")
def roles(t):
    both = t.customer.select(c("c_custkey").alias("k"), F.lit("sa").alias("role")).union(t.supplier.select("s_suppkey", F.lit("imp")))
    return both.groupBy("k").agg(F.concat_ws(",", F.array_sort(F.collect_set("role"))).alias("roles"))


@query("set03_difference", "SELECT o_custkey FROM orders EXCEPT SELECT user_id FROM events")
def difference(t):
    return t.orders.select("o_custkey").subtract(t.events.select("user_id"))


@query("set05_intersection", "SELECT o_custkey FROM orders INTERSECT SELECT user_id FROM events")
def intersection(t):
    return t.orders.select("o_custkey").intersect(t.events.select("user_id"))


@query("set06_distinct", "SELECT DISTINCT o_orderstatus, o_orderpriority FROM orders")
def distinct(t):
    return t.orders.select("o_orderstatus", "o_orderpriority").distinct()


# filters


@query("flt01_keys_and_lists", "SELECT count(*) FILTER (o_orderkey = 7) AS one, count(*) FILTER (o_orderpriority IN ('1-URGENT', '2-HIGH')) AS listed, count(*) FILTER (CAST(o_orderdate AS DATE) >= DATE '1997-01-01') AS late, count(*) FILTER (o_totalprice > 0 AND o_totalprice < 500000000) AS sane, count(*) FILTER (o_orderstatus = 'O' AND CAST(o_orderdate AS DATE) >= DATE '1996-06-01') AS open FROM orders")
def key_filters(t):
    day = c("o_orderdate").cast("date")
    return t.orders.agg(
        F.count_if(c("o_orderkey") == 7).alias("one"),
        F.count_if(c("o_orderpriority").isin("1-URGENT", "2-HIGH")).alias("listed"),
        F.count_if(day >= F.lit("1997-01-01").cast("date")).alias("late"),
        F.count_if((c("o_totalprice") > 0) & (c("o_totalprice") < 5e8)).alias("sane"),
        F.count_if((c("o_orderstatus") == "O") & (day >= F.lit("1996-06-01").cast("date"))).alias("open"),
    )


@query("flt09_text", "SELECT count(*) FILTER (contains(lower(p_name), 'an')) AS contained, count(*) FILTER (starts_with(p_brand, 'Brand#1')) AS prefixed, count(*) FILTER (regexp_full_match(p_name, '[a-z]+ .*')) AS matched, count(*) FILTER (length(p_name) >= 8) AS long_enough FROM part")
def text_filters(t):
    return t.part.agg(
        F.count_if(F.lower("p_name").contains("an")).alias("contained"),
        F.count_if(c("p_brand").startswith("Brand#1")).alias("prefixed"),
        F.count_if(c("p_name").rlike("^(?:[a-z]+ .*)$")).alias("matched"),
        F.count_if(F.length("p_name") >= 8).alias("long_enough"),
    )


@query("flt03_nested", "SELECT count(*) AS n FROM (SELECT l_orderkey, list(l_suppkey) AS won FROM lineitem GROUP BY 1) WHERE list_contains(won, 3) AND len(won) > 1")
def nested_filters(t):
    won = t.lineitem.groupBy("l_orderkey").agg(F.collect_list("l_suppkey").alias("won"))
    return won.where(F.exists("won", lambda x: x == 3) & (F.size("won") > 1)).agg(F.count("*").alias("n"))


@query("flt17_candidates", f"SELECT count(*) AS n FROM supplier a JOIN supplier b ON substr(a.s_name, 1, 3) = substr(b.s_name, 1, 3) AND a.s_suppkey < b.s_suppkey WHERE {_NEAR}")
def candidate_filter(t):
    from tarnweave.operators.linkage import counted_pairs

    return counted_pairs(t.supplier.select(c("s_suppkey").alias("id"), c("s_name").alias("name"))).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"))


@query("flt19_discounts", "SELECT count(*) FILTER (l_discount >= 0 AND l_discount < 1) AS usable, count(*) FILTER (l_discount < 0.005) AS none FROM lineitem")
def discounts(t):
    d = c("l_discount")
    return t.lineitem.agg(F.count_if((d >= 0) & (d < 1)).alias("usable"), F.count_if(d < 0.005).alias("none"))


@query("flt23_urls", "SELECT count(*) FILTER (regexp_matches(url, '(?i)^https?://')) AS web, count(*) FILTER (html IS NOT NULL AND html <> '') AS filled FROM pages")
def urls(t):
    return t.pages.agg(F.count_if(c("url").rlike("(?i)^https?://")).alias("web"), F.count_if(c("html").isNotNull() & (c("html") != "")).alias("filled"))
