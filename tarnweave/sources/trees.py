"""Walks over JSON of any shape and depth, a level a round."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnweave.plans.durable import cut


def leaves(df: DataFrame, key: str, text: str) -> DataFrame:
    """``(key, path, name, value)`` of every scalar in the JSON ``text`` of each row; ``path`` holds the places on the way down,
    ``name`` is the last object key (null for an element of an array).

    Each round opens the objects and arrays of one level, so there are as many rounds as levels.  Text that is no JSON has no
    leaves, nulls are none.  Keys of an object come in their own order, not in that of the text.
    """
    spark = df.sparkSession
    level = df.select(F.col(key).alias("key"), F.array().cast("array<int>").alias("path"), F.try_parse_json(text).alias("v")).where("v IS NOT NULL")
    out = None
    while True:
        level.createOrReplaceTempView("_tree_level")
        opened = spark.sql(
            "SELECT l.key, concat(l.path, array(e.pos)) AS path, e.key AS name, e.value AS v, schema_of_variant(e.value) AS kind FROM _tree_level l, LATERAL variant_explode(l.v) e"
        )
        opened = cut(opened)
        nested = F.col("kind").startswith("OBJECT") | F.col("kind").startswith("ARRAY")
        here = opened.where(~nested & (F.col("kind") != "VOID")).select("key", "path", "name", F.expr("CAST(v AS STRING)").alias("value"), (F.col("kind") == "STRING").alias("is_text"))
        out = here if out is None else out.union(here)
        level = opened.where(nested).select("key", "path", "v")
        if level.isEmpty():
            spark.catalog.dropTempView("_tree_level")
            return out.select(F.col("key").alias(key), "path", "name", "value", "is_text")


def nested_links(df: DataFrame, key: str, text: str) -> DataFrame:
    """``(key, piattaforma, ted)``: the first address under a key with each of two fixed names, at any depth; rows without any have nulls."""
    names = {"piattaforma": "documenti_di_gara_link", "ted": "link_eform_ted"}
    found = leaves(df, key, text).where(F.col("is_text") & F.col("value").rlike("(?i)^https?://"))
    first = lambda x: F.min_by(F.when(F.lower("name").contains(x), F.col("value")), F.when(F.lower("name").contains(x), F.col("path")))
    links = found.groupBy(key).agg(*[first(x).alias(n) for n, x in names.items()])
    return df.select(key).join(links, key, "left")
