"""Buyer and company networks: rivals, neighbourhoods, row numbers and communities."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tarnweave.operators.components import components
from tarnweave.plans.durable import cut, release


def competitors(paths: DataFrame, seed: DataFrame, k: int = 8) -> DataFrame:
    """Companies of ``(company, buyer)`` that share most buyers with the one company of ``seed``."""
    mine = paths.join(seed, paths.company == F.col("seed"), "left_semi").select("buyer").distinct()
    others = paths.join(seed, paths.company == F.col("seed"), "left_anti").join(mine, "buyer", "left_semi")
    n = others.groupBy("company").agg(F.count_distinct("buyer").alias("buyers"), F.count("*").alias("paths"))
    return n.orderBy(F.col("buyers").desc(), "company").limit(k)


def numbered(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """Row numbers from 1 in a total order without a single task: ranges are sorted and numbered on
    their own, the sizes of the ranges before are added."""
    ranged = cut(df.repartitionByRange(*order).withColumn("_p", F.spark_partition_id()))
    sizes = ranged.groupBy("_p").agg(F.count("*").alias("_n"))  # one row a range
    before = sizes.withColumn("_before", F.coalesce(F.sum("_n").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    own = F.row_number().over(Window.partitionBy("_p").orderBy(*order))
    return ranged.withColumn("_own", own).join(before, "_p").withColumn(name, (F.col("_own") + F.col("_before")).cast("long")).drop("_p", "_own", "_n", "_before")


#: Directed edges of a block, and edges from which on a node is a hub.
BLOCK, HUB = 1 << 18, 1 << 16


def communities(edges: DataFrame, levels: int = 5, tolerance: float = 1e-6, patience: int = 2, block: int = BLOCK, hub: int = HUB) -> DataFrame:
    """``(node, community)`` of a weighted graph ``(a, b, w)`` by modularity in levels (Louvain), deterministic.

    The nodes of a level are dealt to blocks of about ``block`` directed edges, those of a community to one block where it isn't
    larger than that, in another way each round.  Within its task a block moves its nodes one after
    another, each to the neighbouring community of largest gain (ties: smallest), as long as any gains; what other blocks hold stands as
    it was at the round's start.  Hubs are no part of a block: what they are linked with is summed up across tasks, and they move by
    the same gain.  The best labels of a level become its result when ``patience`` rounds haven't raised
    modularity by ``tolerance``, or at once where everything was in one block; then communities become nodes.

    Communities are connected: each is split into its components at the end, which can only raise modularity.
    """
    both = edges.select("a", "b", F.col("w").cast("double").alias("w"))
    both = cut(both.union(both.select("b", "a", "w")).groupBy("a", "b").agg(F.sum("w").alias("w")))
    total = both.agg(F.sum("w")).first()[0]
    if not total:
        return edges.select(F.col("a").alias("node"), F.col("a").alias("community")).limit(0)
    assigned = both.select(F.col("a").alias("node")).distinct().withColumn("community", F.col("node"))
    graph = both
    for _ in range(levels):
        best = _level(graph, total, tolerance, patience, block, hub)
        if best is None:
            break
        name = best.select(F.col("n").alias("community"), F.col("c").alias("up"))
        assigned = cut(assigned.join(name, "community").select("node", F.col("up").alias("community")))
        graph = cut(_labelled(graph, best).groupBy(F.col("ca").alias("a"), F.col("cb").alias("b")).agg(F.sum("w").alias("w")))
        release(edges.sparkSession)
    inside = _labelled(both, assigned.toDF("n", "c")).where("ca = cb").select("a", "b")
    return assigned.join(components(inside), "node", "left").select("node", F.coalesce("component", "node").alias("community"))


def _labelled(graph: DataFrame, nodes: DataFrame) -> DataFrame:
    """Edges with the communities ``ca`` and ``cb`` of their ends."""
    x, y = (nodes.select(F.col("n").alias(e), F.col("c").alias(f"c{e}")) for e in "ab")
    return graph.join(x, "a").join(y, "b")


def _level(graph: DataFrame, total: float, tolerance: float, patience: int, block: int, hub: int) -> DataFrame | None:
    """The best labels ``(n, d, c)`` of a level; none if no move raises modularity."""
    kind = graph.schema["a"].dataType.simpleString()
    nodes = cut(graph.groupBy(F.col("a").alias("n")).agg(F.sum("w").alias("d"), F.count("*").alias("links")).withColumn("c", F.col("n")))
    size = nodes.agg(F.coalesce(F.sum(F.when(F.col("links") <= hub, F.col("links"))), F.lit(0)).alias("edges"), F.count_if(F.col("links") > hub).alias("hubs")).first()
    blocks = max(1, -(-size.edges // block))
    best, best_q, first_q, idle, turn = None, None, None, 0, 0
    while True:
        volumes = nodes.groupBy("c").agg(F.sum("d").alias("v"))
        large = F.col("v") > total / blocks
        own = F.pmod(F.xxhash64(F.when(large, F.col("n")).otherwise(F.col("c")), F.lit(turn)), F.lit(blocks)).cast("int")
        labels = nodes.join(volumes, "c").withColumn("block", F.when(F.col("links") > hub, -1).otherwise(own))
        x, y = (labels.select(F.col("n").alias(e), F.col("d").alias(f"d{e}"), F.col("c").alias(f"c{e}"), F.col("v").alias(f"v{e}"), F.col("block").alias(f"k{e}")) for e in "ab")
        ends = graph.join(x, "a").join(y, "b")
        inner = ends.where("ka >= 0").select("ka", "a", "da", "ca", "va", F.when(F.col("ka") == F.col("kb"), F.col("b")).alias("b"), F.col("a").eqNullSafe(F.col("b")).alias("self"), "cb", "vb", "w")
        out = f"n {kind}, d double, c {kind}, was {kind}, links bigint, inside double, inside_now double"
        new = inner.groupBy("ka").applyInArrow(lambda table: _moved(table, total), out)
        if size.hubs:
            new = new.unionByName(_hubs(ends.where("ka < 0"), total, turn))
        new = cut(new)
        q = _quality(new, "was", "inside", total)
        if first_q is None:
            first_q = best_q = q
        if q > best_q + tolerance:
            best, best_q, idle = nodes, q, 0
        elif turn:
            idle += 1
        nodes = new.select("n", "d", "links", "c")
        if new.where("c <> was").isEmpty() or idle == patience:
            break
        if blocks == 1 and not size.hubs:  # nothing else moved meanwhile
            if _quality(new, "c", "inside_now", total) > best_q + tolerance:
                best = nodes
            break
        turn += 1
    return best


def _quality(new: DataFrame, label: str, inside: str, total: float) -> float:
    volume = new.groupBy(label).agg(F.sum("d").alias("v"), F.sum(inside).alias("i"))
    row = volume.agg(F.sum("i").alias("i"), F.sum(F.col("v") * F.col("v")).alias("v")).first()
    return row.i / total - row.v / total / total


def _moved(table: pa.Table, total: float) -> pa.Table:
    """One block: its nodes move until none gains, at most 20 times around."""
    col = {c: table.column(c).to_pylist() for c in table.column_names}
    degree, label, was, volume, near, inside = {}, {}, {}, {}, {}, {}
    for a, d, ca, va, b, own, cb, vb, w in zip(*(col[c] for c in ("a", "da", "ca", "va", "b", "self", "cb", "vb", "w")), strict=True):
        degree[a], label[a], was[a], volume[ca], volume[cb] = d, ca, ca, va, vb
        near.setdefault(a, []).append((None if own else b, cb, w, own))
        if ca == cb:
            inside[a] = inside.get(a, 0.0) + w
    order = sorted(near)
    for _ in range(20):
        moves = 0
        for a in order:
            k: dict = {}
            for b, cb, w, own in near[a]:
                if not own:
                    c = label.get(b, cb) if b is not None else cb
                    k[c] = k.get(c, 0.0) + w
            now, d = label[a], degree[a]
            gain = {c: x - d * (volume[c] - (d if c == now else 0.0)) / total for c, x in k.items()}
            if not gain:
                continue
            to = min(gain, key=lambda c: (-round(gain[c], 9), c))
            if to != now and gain[to] > gain.get(now, -d * (volume[now] - d) / total) + 1e-9:
                volume[now] -= d
                volume[to] += d
                label[a] = to
                moves += 1
        if not moves:
            break
    ends = {a: sum(w for b, cb, w, own in near[a] if own or (label.get(b, cb) if b is not None else cb) == label[a]) for a in order}
    kind = table.schema.field("a").type
    return pa.table(
        {
            "n": pa.array(order, kind), "d": [degree[a] for a in order], "c": pa.array([label[a] for a in order], kind), "was": pa.array([was[a] for a in order], kind),
            "links": pa.array([len(near[a]) for a in order], pa.int64()), "inside": [inside.get(a, 0.0) for a in order], "inside_now": [float(ends[a]) for a in order],
        }
    )


def _hubs(ends: DataFrame, total: float, turn: int) -> DataFrame:
    """Hubs move by the sums over what they are linked with, every second one in turn."""
    sums = ends.groupBy("a", "cb").agg(F.max("da").alias("d"), F.max("ca").alias("ca"), F.max("va").alias("va"), F.max("vb").alias("vb"), F.sum(F.when(F.col("a") != F.col("b"), F.col("w")).otherwise(0)).alias("k"), F.sum("w").alias("w"), F.count("*").alias("links"))
    gain = F.col("k") - F.col("d") * (F.col("vb") - F.when(F.col("cb") == F.col("ca"), F.col("d")).otherwise(0)) / total
    found = sums.groupBy("a").agg(
        F.max("d").alias("d"), F.max("ca").alias("was"), F.sum("links").alias("links"), F.sum(F.when(F.col("cb") == F.col("ca"), F.col("w")).otherwise(0)).alias("inside"),
        F.max_by(F.struct(F.col("cb").alias("to"), gain.alias("g")), F.struct(F.round(gain, 9), -F.xxhash64("cb"))).alias("x"),
        F.coalesce(F.max(F.when(F.col("cb") == F.col("ca"), gain)), -F.max(F.col("d") * (F.col("va") - F.col("d"))) / total).alias("stay"),
    )
    may = (F.pmod(F.xxhash64("a", F.lit(turn // 2)), F.lit(2)) == turn % 2) & (F.col("x.g") > F.col("stay") + 1e-9)
    return found.select(F.col("a").alias("n"), "d", F.when(may, F.col("x.to")).otherwise(F.col("was")).alias("c"), "was", "links", "inside", F.lit(0.0).alias("inside_now"))


def profile(found: DataFrame, kinds: DataFrame) -> DataFrame:
    """``(community, size, kind, n)``: how many nodes of each ``(node, kind)`` a community has."""
    each = found.join(kinds, "node").groupBy("community", "kind").agg(F.count("*").alias("n"))
    return each.join(found.groupBy("community").agg(F.count("*").alias("size")), "community").select("community", "size", "kind", "n")


def partition_quality(edges: DataFrame, found: DataFrame) -> DataFrame:
    """``(communities, modularity)`` of an undirected graph ``(a, b, w)`` under ``(node, community)``."""
    both = edges.select("a", "b", F.col("w").cast("double").alias("w"))
    both = _labelled(both.union(both.select("b", "a", "w")), found.toDF("n", "c"))
    each = both.groupBy(F.col("ca").alias("c")).agg(F.sum("w").alias("v"), F.sum(F.when(F.col("ca") == F.col("cb"), F.col("w")).otherwise(0)).alias("i"))
    all_ = each.agg(F.count("*").alias("communities"), F.sum("v").alias("t"), F.sum("i").alias("i"), F.sum(F.col("v") * F.col("v")).alias("vv"))
    return all_.select("communities", (F.col("i") / F.col("t") - F.col("vv") / F.col("t") / F.col("t")).alias("modularity"))
