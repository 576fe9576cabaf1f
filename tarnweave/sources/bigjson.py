"""Records of one huge JSON document, cut by all tasks at once.

The file is read in byte ranges as pieces that end at a closing brace.  What a piece does to the reader's state (inside
a string or not, depth of brackets) is known for both states it may begin in; composed within each byte range and then over the ranges, one row
each, this gives every piece its true state.  A brace that closes back to the depth of the array's elements ends a
record, and the pieces since the last such brace are its text.  No task sees more than a byte range and single records.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Depth inside an array of the document's own object.
_ELEMENTS = 2


def _outside(text: Column) -> Column:
    """Text without escapes as it is outside of strings, if it begins there; an open string runs to the end."""
    return F.regexp_replace(text, '"[^"]*("|$)', "")


def _delta(text: Column, odd: Column) -> Column:
    """Brackets opened less closed, with the brace that ends the piece unless it stands in a string."""
    count = lambda x: F.length(text) - F.length(F.replace(text, F.lit(x)))
    return count("{") + count("[") - count("}") - count("]") - F.when(odd, 0).otherwise(1)


def _scanned(rows: DataFrame, value: Column, name: str, last: bool = False) -> DataFrame:
    """``rows`` with the sum (or the last known value) over all rows before, by byte range and then over the ranges."""
    within = Window.partitionBy("file", "start").orderBy("n").rowsBetween(Window.unboundedPreceding, -1)
    over = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("_v", value)
    take = (lambda x, w: F.last(x, True).over(w)) if last else (lambda x, w: F.coalesce(F.sum(x).over(w), F.lit(0)))
    all_ = F.max_by("_v", F.when(F.col("_v").isNotNull(), F.col("n"))) if last else F.sum("_v")
    ranges = rows.groupBy("file", "start").agg(all_.alias("_all")).select("file", "start", take(F.col("_all"), over).alias("_before"))
    both = rows.withColumn("_own", take(F.col("_v"), within)).join(ranges, ["file", "start"])
    joined = F.coalesce("_own", "_before") if last else F.col("_own") + F.col("_before")
    return both.withColumn(name, joined).drop("_v", "_own", "_before")


def json_records(spark: SparkSession, path: str, array: str = "releases") -> DataFrame:
    """``(file, number, text)``: the objects of the array ``array`` of a document ``{..., "releases": [{...}, ...], ...}``, in order of ``number``.

    Other keys may stand before and after it, with any values.  White space may be anywhere.
    """
    pieces = spark.read.option("lineSep", "}").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("n"), F.col("value").alias("piece")
    )
    bare = F.regexp_replace("piece", r"(?s)\\.", "")  # an escape never spans pieces: braces aren't escaped
    quotes = F.length(bare) - F.length(F.replace(bare, F.lit('"')))
    rest = F.regexp_replace(bare, '^[^"]*"?', "")  # after the end of the string that the piece begins in
    odd = quotes % 2 == 1
    read = pieces.select("*", quotes.alias("quotes"), _delta(_outside(bare), odd).alias("d0"), _delta(_outside(rest), ~odd).alias("d1"))
    read = _scanned(read, F.col("quotes"), "before")
    read = read.withColumn("inside", (F.col("before") + F.col("quotes")) % 2 == 1)
    read = read.withColumn("d", F.when(F.col("before") % 2 == 0, F.col("d0")).otherwise(F.col("d1"))).drop("quotes", "before", "d0", "d1")
    read = _scanned(read, F.col("d"), "depth")
    ends = ~F.col("inside") & (F.col("depth") + F.col("d") <= _ELEMENTS)
    read = read.withColumn("ends", ends)
    read = _scanned(read, F.when(F.col("ends"), 1).otherwise(0), "number")
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("start", "n", F.concat("piece", F.lit("}")).alias("t")))), lambda x: x["t"]), "")
    first = F.struct("start", "n")
    groups = read.groupBy("file", "number").agg(
        text.alias("text"), F.min_by("depth", first).alias("depth"), F.max_by(F.col("depth") + F.col("d"), first).alias("after"), F.max("start").alias("start"), F.max("n").alias("n")
    )  # one object and what stands before it
    body = F.when(F.col("depth") == 0, F.regexp_replace("text", r"^\s*\{", "")).otherwise(F.col("text"))
    head = F.regexp_extract(body, r'^((?:[^"{]++|"(?:[^"\\]++|\\.)*+")*+)\{', 1)
    name = F.regexp_extract(head, r'"([^"]*)"\s*:\s*\[\s*$', 1)
    opened = F.when(name != "", name).when(F.regexp_replace(head, r"[\s,]", "") != "", F.lit(""))  # an object under a key is in no array
    groups = groups.withColumn("head", head).withColumn("body", body).withColumn("opens", opened)
    groups = _scanned(groups, F.col("opens"), "open", last=True)
    mine = groups.where((F.col("after") == _ELEMENTS) & (F.coalesce("opens", "open") == array))
    return mine.select("file", "number", F.expr("substring(body, length(head) + 1)").alias("text"))
