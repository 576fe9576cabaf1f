"""Chat formatting by perspective rotation, in DataFrame functions only.

For every participant of a conversation the dialogue is rendered with that speaker as
``assistant`` and all others as named users; ``system`` turns stay system turns and own no
perspective.  A rendering is cut into segments of at most ``span`` consecutive turn numbers, so a
conversation of any length is never gathered in one row; ``base`` is the number of code points
before the segment.  ``mask`` lists the spans (code points of the segment, end exclusive) on
which loss is taken: the assistant's text and its end mark.

Null roles count as ``unknown``, null texts as empty, null turns come first; ties are ordered by
role and text, repeated rows are kept.  Conversations without a participant give no row.
Control marks inside texts are broken up so that they cannot open or close a turn.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

OPEN, SHUT = "<|im_start|>", "<|im_end|>\n"


def _sum(a: Column) -> Column:
    return F.aggregate(a, F.lit(0).cast("long"), lambda s, x: s + x)


def render(df: DataFrame, span: int = 256) -> DataFrame:
    """``(conv_id, turn, role, text)`` to ``(conv_id, perspective, segment, base, n_turns,
    n_masked, rendered, mask)``."""
    turns = df.select(
        "conv_id",
        F.coalesce(F.floor(F.col("turn") / span), F.lit(-(2**62))).cast("long").alias("segment"),
        F.struct(
            "turn",
            F.coalesce("role", F.lit("unknown")).alias("role"),
            F.replace(F.coalesce("text", F.lit("")), F.lit("<|"), F.lit("< |")).alias("text"),
        ).alias("t"),
    )
    segments = turns.groupBy("conv_id", "segment").agg(F.sort_array(F.collect_list("t")).alias("ts"))
    who = (
        turns.select("conv_id", F.col("t.role").alias("perspective"))
        .where(F.col("perspective") != "system")
        .distinct()
    )
    said = segments.alias("a").join(who.alias("b"), F.expr("a.conv_id <=> b.conv_id")).select("a.*", "perspective")
    head = lambda r: F.when(r == F.col("perspective"), F.lit("assistant")).otherwise(
        F.when(r == "system", F.lit("system")).otherwise(F.concat(F.lit("user name="), r))
    )
    parts = said.withColumn(
        "parts",
        F.transform(
            "ts",
            lambda t: F.struct(
                F.concat(F.lit(OPEN), head(t["role"]), F.lit("\n")).alias("head"),
                F.concat(t["text"], F.lit(SHUT)).alias("body"),
                (t["role"] == F.col("perspective")).alias("on"),
            ),
        ),
    ).drop("ts")
    sized = parts.withColumn(
        "sizes", F.transform("parts", lambda p: (F.length(p["head"]) + F.length(p["body"])).cast("long"))
    )
    spans = F.filter(
        F.transform(
            "parts",
            lambda p, i: F.struct(
                p["on"].alias("on"),
                (_sum(F.slice("sizes", F.lit(1), i)) + F.length(p["head"])).alias("start"),
                (_sum(F.slice("sizes", F.lit(1), i)) + F.length(p["head"]) + F.length(p["body"]) - 1).alias("end"),
            ),
        ),
        lambda s: s["on"],
    )
    done = sized.select(
        "conv_id", "perspective", "segment",
        F.size("parts").cast("long").alias("n_turns"),
        F.array_join(F.transform("parts", lambda p: F.concat(p["head"], p["body"])), "").alias("rendered"),
        F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))).alias("mask"),
        _sum(F.col("sizes")).alias("n_chars"),
    )
    before = Window.partitionBy("conv_id", "perspective").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    offsets = done.select("conv_id", "perspective", "segment", "n_chars")
    offsets = offsets.withColumn("base", F.coalesce(F.sum("n_chars").over(before), F.lit(0))).drop("n_chars")
    same = F.expr("a.conv_id <=> b.conv_id AND a.perspective = b.perspective AND a.segment = b.segment")
    return done.alias("a").join(offsets.alias("b"), same).select("a.*", "b.base")


def op6_chat_formatting(spark, sf_dir: str) -> DataFrame:
    out = render(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    return out.select(
        "conv_id", "perspective", "segment", "base", "n_turns", "n_chars",
        F.size("mask").cast("long").alias("n_masked"), "rendered",
        F.array_join(F.transform("mask", lambda s: F.concat_ws(":", s["start"], s["end"])), ",").alias("masks"),
    )


OP6_SQL = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, 'unknown') AS role,
         replace(coalesce(text, ''), '<|', '< |') AS text, CAST(turn // 256 AS BIGINT) AS segment
  FROM conversations
), w AS (SELECT DISTINCT conv_id, role AS perspective FROM t WHERE role <> 'system'),
p AS (
  SELECT t.*, w.perspective,
    '<|im_start|>' || CASE WHEN role = perspective THEN 'assistant' WHEN role = 'system' THEN 'system'
      ELSE 'user name=' || role END || chr(10) AS head,
    text || '<|im_end|>' || chr(10) AS body
  FROM t JOIN w ON t.conv_id IS NOT DISTINCT FROM w.conv_id
), q AS (
  SELECT *, coalesce(sum(length(head) + length(body)) OVER (PARTITION BY conv_id, perspective, segment
      ORDER BY turn, role, text ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pre FROM p
), s AS (
  SELECT conv_id, perspective, segment, count(*) AS n_turns, CAST(sum(length(head) + length(body)) AS BIGINT) AS n_chars,
    count(*) FILTER (role = perspective) AS n_masked,
    string_agg(head || body, '' ORDER BY turn, role, text) AS rendered,
    coalesce(string_agg(CAST(pre + length(head) AS BIGINT) || ':' || CAST(pre + length(head) + length(body) - 1 AS BIGINT), ','
      ORDER BY turn, role, text) FILTER (role = perspective), '') AS masks
  FROM q GROUP BY ALL
)
SELECT *, CAST(coalesce(sum(n_chars) OVER (PARTITION BY conv_id, perspective ORDER BY segment
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS base FROM s
"""
