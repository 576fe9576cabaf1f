"""Quality rules as a bitmask ledger, in DataFrame functions only.

Every rule is evaluated once per document: its failure is one bit of ``mask`` and the
numbers behind it are kept beside it.  A policy is a named, versioned set of bits; applying
one or measuring an ablation only reads the ledger.

Words are runs of anything but ASCII white space.  Null and empty texts have no words and
fail the word count.  Repeated rows are judged independently, extra columns are ignored, and
an empty table gives an empty ledger.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]"
SYMBOLS = "#*$%&|<>"

#: Bit of each rule; the order is part of stored ledgers and only ever grows.
RULES = (
    "few_words",
    "repeated_windows",
    "symbol_ratio",
    "duplicate_lines",
    "word_length",
    "few_alphabetic",
    "shouting",
)
POLICIES = {
    "base": ("few_words", "repeated_windows"),
    "v1": RULES,
    "v2": tuple(r for r in RULES if r != "shouting"),
}


def policy_mask(policy: str) -> int:
    return sum(1 << RULES.index(r) for r in POLICIES[policy])


def measure(df: DataFrame) -> DataFrame:
    """Measurements of ``(doc_id, text)``; one row per input row."""
    t = F.coalesce(F.col("text"), F.lit(""))
    a = df.select(
        "doc_id",
        F.filter(F.split(t, SPACE), lambda w: w != "").alias("w"),
        F.filter(F.split(t, "\n"), lambda x: x.rlike(WORD)).alias("lines"),
        (F.length(t) - F.length(F.translate(t, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.length(F.regexp_replace(t, r"[^\p{L}]+", "")).cast("long").alias("n_letters"),
        F.length(F.regexp_replace(t, r"[^\p{Lu}]+", "")).cast("long").alias("n_upper"),
        F.length(F.regexp_replace(t, SPACE, "")).cast("long").alias("word_chars"),
    )
    n = F.size("w")
    b = a.select(
        "doc_id",
        n.cast("long").alias("n_words"),
        "word_chars",
        "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size("lines").cast("long").alias("n_lines"),
        "n_letters",
        "n_upper",
        F.size(F.filter("w", lambda w: w.rlike(r"\p{L}"))).cast("long").alias("n_alpha_words"),
        F.transform(
            F.slice("w", F.lit(1), F.greatest(n - 2, F.lit(0))),
            lambda w, i: F.xxhash64(w, F.get("w", i + 1), F.get("w", i + 2)),
        ).alias("win"),
    )
    # only texts with a window twice are sorted; equal windows then stand side by side
    c = b.withColumn(
        "s",
        F.when(
            F.size(F.array_distinct("win")) < F.size("win"),
            F.sort_array(F.transform("win", lambda h, i: F.struct(h.alias("h"), i.alias("p")))),
        ),
    ).drop("win")
    d = c.withColumn(
        "p",
        F.sort_array(
            F.transform(
                F.filter(
                    "s",
                    lambda x, k: (x["h"] == F.get("s", k - 1)["h"]) | (x["h"] == F.get("s", k + 1)["h"]),
                ),
                lambda x: x["p"],
            )
        ),
    ).drop("s")
    covered = F.aggregate(
        F.transform("p", lambda x, k: F.least(F.lit(3), F.coalesce(F.get("p", k + 1) - x, F.lit(3)))),
        F.lit(0),
        lambda s, x: s + x,
    )
    return d.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long")).drop("p")


def ledger(df: DataFrame) -> DataFrame:
    """``measure`` with ``mask``, the long whose bit i says that ``RULES[i]`` failed."""
    n = F.col("n_words")
    fails = (
        n < 50,
        100 * F.col("n_repeat_words") > 50 * n,
        10 * F.col("n_symbols") > n,
        10 * F.col("n_dup_lines") > 3 * F.col("n_lines"),
        (F.col("word_chars") < 2 * n) | (F.col("word_chars") > 15 * n),
        10 * F.col("n_alpha_words") < 7 * n,
        10 * F.col("n_upper") > 6 * F.col("n_letters"),
    )
    mask = F.lit(0).cast("long")
    for i, failed in enumerate(fails):
        mask = mask.bitwiseOR(F.when(failed, F.lit(1 << i)).otherwise(F.lit(0)).cast("long"))
    return measure(df).withColumn("mask", mask)


def apply_policy(rows: DataFrame, policy: str = "v1") -> DataFrame:
    """Adds ``kept`` and ``policy`` to a ledger."""
    return rows.withColumn("policy", F.lit(policy)).withColumn(
        "kept", F.col("mask").bitwiseAND(F.lit(policy_mask(policy))) == 0
    )


def ablation(rows: DataFrame, policy: str = "v1") -> DataFrame:
    """Per rule of a policy: documents it fails, and documents that only it fails."""
    hit = F.col("mask").bitwiseAND(F.lit(policy_mask(policy)))
    per_rule = [F.count_if(hit.bitwiseAND(F.lit(1 << RULES.index(r))) != 0).alias(f"f_{r}") for r in POLICIES[policy]]
    alone = [F.count_if(hit == (1 << RULES.index(r))).alias(f"a_{r}") for r in POLICIES[policy]]
    one = rows.agg(*per_rule, *alone)
    pairs = F.array(
        *[
            F.struct(F.lit(r).alias("rule"), F.col(f"f_{r}").alias("n_failed"), F.col(f"a_{r}").alias("n_only"))
            for r in POLICIES[policy]
        ]
    )
    return one.select(F.inline(pairs))


def op10_quality_rules(spark, sf_dir: str) -> DataFrame:
    rows = apply_policy(ledger(spark.read.parquet(f"{sf_dir}/documents.parquet")), "v1")
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (F.col("mask").bitwiseAND(F.lit(policy_mask("base"))) != 0).alias("base_failed"),
        "kept", "mask",
    )


OP10_SQL = r"""
WITH a AS (
  SELECT doc_id, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM documents
), b AS (
  SELECT *, len(w) AS n, CASE WHEN len(w) < 3 THEN [] ELSE list_transform(range(1, len(w) - 1),
         lambda i: struct_pack(a := w[i], b := w[i + 1], c := w[i + 2], p := i)) END AS x FROM a
), e AS (SELECT doc_id, unnest(x) AS y FROM b),
g AS (SELECT doc_id, y.p AS p, count(*) OVER (PARTITION BY doc_id, y.a, y.b, y.c) AS k FROM e),
h AS (SELECT doc_id, count(DISTINCT q) AS r FROM
      (SELECT doc_id, unnest([p, p + 1, p + 2]) AS q FROM g WHERE k > 1) GROUP BY doc_id),
m AS (
  SELECT b.doc_id, CAST(n AS BIGINT) AS n_words,
         CAST(length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(r, 0) AS BIGINT) AS n_repeat_words, len(l) AS n_lines,
         length(regexp_replace(t, '[^\p{L}]+', '', 'g')) AS letters,
         length(regexp_replace(t, '[^\p{Lu}]+', '', 'g')) AS upper,
         len(list_filter(w, lambda x: regexp_matches(x, '\p{L}'))) AS alpha
  FROM b LEFT JOIN h USING (doc_id)
), f AS (
  SELECT *, CAST((n_words < 50)::INT + 2 * (100 * n_repeat_words > 50 * n_words)::INT
    + 4 * (10 * n_symbols > n_words)::INT + 8 * (10 * n_dup_lines > 3 * n_lines)::INT
    + 16 * (word_chars < 2 * n_words OR word_chars > 15 * n_words)::INT
    + 32 * (10 * alpha < 7 * n_words)::INT + 64 * (10 * upper > 6 * letters)::INT AS BIGINT) AS mask FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (mask & 3) <> 0 AS base_failed, mask = 0 AS kept, mask FROM f
"""
