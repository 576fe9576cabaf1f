"""Anomaly rules over award paths; each rule is one query that gives findings."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from tarnweave.functions.codes import money

#: Amounts from which a record is an outlier, and below which awards are direct.
OUTLIER, DIRECT, HIGH_SPLIT = 500_000_000, 40_000, 100_000


def _level(high: Column, medium: Column | None = None, low: str = "medium") -> Column:
    e = F.when(high, "high")
    return (e.when(medium, "medium") if medium is not None else e).otherwise(low)


def recurrent_pairs(paths: DataFrame, least: int = 3, high: int = 5) -> DataFrame:
    """Direct awards of one authority to one company: ``(sa, imp, n, total, severity)``."""
    p = paths.where("direct").groupBy("sa", "imp").agg(F.count_distinct("lot").alias("n"), money(F.col("amount")).alias("total"))
    return p.where((F.col("n") >= least) & (F.col("total") < OUTLIER)).withColumn("severity", _level(F.col("n") >= high))


def split_awards(paths: DataFrame, limit: float = DIRECT, high: float = HIGH_SPLIT) -> DataFrame:
    """Several small direct awards that together pass the limit."""
    small = paths.where("direct").where((F.col("amount") > 0) & (F.col("amount") < limit))
    p = small.groupBy("sa", "imp").agg(F.count_distinct("lot").alias("n"), money(F.col("amount")).alias("total"), F.max("amount").alias("largest"))
    kept = p.where((F.col("n") >= 2) & (F.col("total") > limit) & (F.col("total") < OUTLIER))
    return kept.withColumn("severity", _level(F.col("total") > high))


def dominant_winner(paths: DataFrame, least: int = 3, share: float = 0.5, high: float = 0.8) -> DataFrame:
    """A company with more than a share of the awarded lots of an authority."""
    n = paths.groupBy("sa", "imp").agg(F.count_distinct("lot").alias("n"))
    lots = paths.groupBy("sa").agg(F.count_distinct("lot").alias("lots"))
    x = n.join(lots, "sa").withColumn("share", F.col("n") / F.col("lots"))
    kept = x.where((F.col("lots") >= least) & (F.col("share") > share))
    return kept.withColumn("severity", _level(F.col("share") > high)).withColumn("share", F.round("share", 6))


def many_notices(notices: DataFrame, most: int = 3, high: int = 6) -> DataFrame:
    """Lots with more than ``most`` notices of any kind."""
    n = notices.groupBy("lot").agg(F.count("*").alias("n"))
    return n.where(F.col("n") > most).withColumn("severity", _level(F.col("n") > high))


def changed_contracts(notices: DataFrame, codes: tuple[str, ...]) -> DataFrame:
    """Lots with notices of a set of codes; high from the second one, else low."""
    n = notices.where(F.col("code").isin(*codes)).groupBy("lot").agg(F.count("*").alias("n"))
    return n.withColumn("severity", _level(F.col("n") > 1, low="low"))


def both_procedures(paths: DataFrame, first: tuple[str, ...], second: tuple[str, ...]) -> DataFrame:
    """Pairs with notices of both sets of codes, in any order of time."""
    n = paths.groupBy("sa", "imp").agg(*[F.count_if(F.col("code").isin(*s)).alias(k) for k, s in (("n_first", first), ("n_second", second))])
    return n.where("n_first >= 1 AND n_second >= 1").withColumn("severity", F.lit("medium"))


def captured_client(paths: DataFrame, floor: float = 10_000, share: float = 0.7, least: int = 3, high: float = 0.9) -> DataFrame:
    """Companies that get most of their amounts from one authority."""
    sane = paths.where((F.col("amount") > 0) & (F.col("amount") < OUTLIER))
    p = sane.groupBy("imp", "sa").agg(F.count("*").alias("n"), money(F.col("amount")).alias("total"))
    x = p.withColumn("all", F.sum("total").over(Window.partitionBy("imp"))).withColumn("share", F.col("total") / F.col("all"))
    kept = x.where((F.col("all") > floor) & (F.col("share") >= share) & (F.col("n") >= least))
    return kept.select("imp", "sa", "n", "total", F.round("share", 6).alias("share"), _level(F.col("share") >= high).alias("severity"))


def findings(**rules: DataFrame) -> DataFrame:
    """All findings as (rule, severity, severity_rank, detail)."""
    out = None
    for name, df in rules.items():
        one = df.select(F.lit(name).alias("rule"), "severity", F.to_json(F.struct(*[c for c in df.columns if c != "severity"])).alias("detail"))
        out = one if out is None else out.union(one)
    rank = F.when(F.col("severity") == "high", 0).when(F.col("severity") == "medium", 1).otherwise(2)
    return out.withColumn("severity_rank", rank)


def picked(found: DataFrame, entity=None, rule: str | None = None, limit: int | None = None) -> DataFrame:
    """Findings ``(rule, severity, sa, imp)`` of an entity in either role and of a rule, worst first; without them all."""
    part = lambda k: F.get_json_object("detail", f"$.{k}").cast("long").alias(k)
    rows = found.select("rule", "severity", "severity_rank", part("sa"), part("imp"))
    if rule is not None:
        rows = rows.where(F.col("rule") == rule)
    if entity is not None:
        rows = rows.where((F.col("sa") == entity) | (F.col("imp") == entity))
    rows = rows.orderBy("severity_rank", "rule", "sa", "imp").drop("severity_rank")
    return rows if limit is None else rows.limit(limit)


def run_rules(rules: dict[str, DataFrame], path: str) -> None:
    """Writes the findings of the rules that run, each in place of what it found before; other rules keep theirs.

    A rule that finds nothing any more has none left.
    """
    from tarnweave.sources.files import replace_slices

    seen = {name: Observation(uuid.uuid4().hex) for name in rules}
    watched = {name: df.observe(seen[name], F.count(F.lit(1)).alias("n")) for name, df in rules.items()}
    replace_slices(findings(**watched), path, "rule")
    spark = next(iter(rules.values())).sparkSession
    jvm = spark._jvm.org.apache.hadoop.fs
    for name in rules:
        if not seen[name].get["n"]:  # counted while it was written
            at = jvm.Path(f"{path}/rule={name}")
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def worst(found: DataFrame, k: int = 3) -> DataFrame:
    """``(rule, severity, lot, sa, imp, rank)``: the k worst findings of each rule, of equal ones those of the least keys."""
    part = lambda x: F.get_json_object("detail", f"$.{x}").cast("long").alias(x)
    rows = found.select("rule", "severity", "severity_rank", part("lot"), part("sa"), part("imp"))
    rank = F.row_number().over(Window.partitionBy("rule").orderBy("severity_rank", "lot", "sa", "imp"))
    return rows.withColumn("rank", rank.cast("long")).where(F.col("rank") <= k).drop("severity_rank")
