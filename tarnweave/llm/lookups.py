"""Joins of many rows with a table of unique keys, whatever the share of a key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lookup(rows: DataFrame, table: DataFrame, keys: list[str], weights: DataFrame | None = None, most: int = 1 << 10) -> DataFrame:
    """``rows`` with the columns of the row of ``table`` of the same keys (inner join).

    A key of more than 1/``most`` of all rows is hot; there are fewer than ``most`` of them, so their rows of the
    table are broadcast.  All others go by shuffle.  ``weights`` (keys, ``_weight``) says how many rows a key has,
    where that is known already.
    """
    if weights is None:
        weights = rows.groupBy(*keys).agg(F.count("*").alias("_weight"))
    total = weights.agg(F.sum("_weight")).first()[0] or 0
    hot = weights.where(F.col("_weight") * F.lit(most) > total).select(*keys)
    head = table.join(F.broadcast(hot), keys).withColumn("_hot", F.lit(True))
    extra = [c for c in table.columns if c not in keys]
    both = rows.join(F.broadcast(head), keys, "left")
    rest = both.where("_hot IS NULL").drop("_hot", *extra).join(table, keys)
    return both.where("_hot").drop("_hot").unionByName(rest)
