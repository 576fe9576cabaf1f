"""Round trips through files, and streams that must equal their batch results."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tarnweave.operators.records import first_known, ordered_values
from tarnweave.sources import files
from tarnweave.streaming.incremental import Buckets, merge_batches, run_available, upsert_batches

from .durable import cut, shared_dir
from .registry import query


def _folder(t) -> str:
    return f"{shared_dir(t.spark)}/files-{uuid.uuid4().hex}"


@query("snk17_ndjson", "SELECT s_suppkey, s_name, s_nationkey FROM supplier")
def json_lines(t):
    df, path = t.supplier.select("s_suppkey", "s_name", "s_nationkey"), _folder(t)
    files.write_json_lines(df, path)
    return files.read_json_lines(t.spark, path, df.schema)


@query("src19_csv", "SELECT p_partkey, p_name || ', \"x\"' AS name FROM part")
def csv(t):
    df, path = t.part.select("p_partkey", F.concat("p_name", F.lit(', "x"')).alias("name")), _folder(t)
    files.write_csv(df, path)
    return files.read_csv(t.spark, path, df.schema)


@query(
    "src12_json_array",
    r"""SELECT 'R' || o_orderkey AS id, 'O' || o_custkey || '\"}{[' AS ocid, strftime(o_orderdate, '%Y-%m-%d') AS date FROM orders""",
)
def json_array(t):
    """One document of all orders in 64 byte ranges; strings hold quotes, backslashes and brackets."""
    from tarnweave.sources.adapters import huge_json

    path = _folder(t)
    release = F.struct(
        F.concat(F.lit("R"), "o_orderkey").alias("id"), F.concat(F.lit("O"), "o_custkey", F.lit('\\"}{[')).alias("ocid"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("date")
    )
    files.write_json_document(t.orders.select(release.alias("r")), path, '{"uri": "a{b", "publisher": {"name": "x"}, "links": [{"id": "no", "ocid": "no"}], "releases": [{}', ' ], "extra": [{"id": "no", "ocid": "no"}]}')
    size = files.bytes_of(t.spark, path)
    key = "spark.sql.files.maxPartitionBytes"
    before = t.spark.conf.get(key)
    t.spark.conf.set(key, str(size // 64 + 1))
    try:
        return cut(huge_json(t.spark, path).select("id", "ocid", "date"))
    finally:
        t.spark.conf.set(key, before)


@query("snk07_slice", "SELECT event_type, count(*) + CASE WHEN event_type = 'click' THEN 1 ELSE 0 END AS n FROM events GROUP BY 1")
def slices(t):
    path, e = _folder(t), t.events.select("event_id", "event_type")
    files.replace_slices(e, path, "event_type")
    more = e.where("event_type = 'click'").union(t.spark.createDataFrame([(-1, "click")], e.schema))
    files.replace_slices(more, path, "event_type")
    return t.spark.read.parquet(path).groupBy("event_type").agg(F.count("*").alias("n"))


@query("str01_stream_upsert", "SELECT user_id, arg_max(event_id, (ts, event_id)) AS event_id FROM events GROUP BY 1")
def stream_upsert(t):
    path = _folder(t)
    table = Buckets(t.spark, f"{path}/table", ["user_id"])
    stream = t.spark.readStream.schema(t.events.schema).option("pathGlobFilter", "events.parquet").parquet(t.folder)
    run_available(stream, upsert_batches(table, ["user_id"], [F.col("ts").desc(), F.col("event_id").desc()]), f"{path}/checkpoint")
    return table.read().select("user_id", "event_id")


def first_known_events(events):
    """Per user the first known value and purchase, and the event types in order."""
    order = F.struct("ts", "event_id")
    known = events.groupBy("user_id").agg(
        first_known("value", order).alias("value"), first_known(F.when(F.col("event_type") == "purchase", F.col("event_id")), order).alias("purchase")
    )
    types = ordered_values(events.withColumn("_o", order), ["user_id"], "event_type", "_o", "_types").withColumnRenamed("user_id", "_user")
    both = known.join(types, F.col("user_id").eqNullSafe(F.col("_user")), "left")
    return both.select("user_id", "value", "purchase", F.array_join(F.coalesce("_types", F.array().cast("array<string>")), ",").alias("types"))


@query("str02_stream_merge", "WITH f AS (SELECT user_id, event_type, min((ts, event_id)) AS o FROM events WHERE event_type IS NOT NULL GROUP BY ALL), t AS (SELECT user_id, string_agg(event_type, ',' ORDER BY o) AS types FROM f GROUP BY 1), v AS (SELECT user_id, arg_min(value, (ts, event_id)) FILTER (value IS NOT NULL) AS value, arg_min(event_id, (ts, event_id)) FILTER (event_type = 'purchase') AS purchase FROM events GROUP BY 1) SELECT user_id, value, purchase, coalesce(types, '') AS types FROM v LEFT JOIN t USING (user_id)")
def stream_merge(t):
    """The events of a user come in several batches."""
    path = _folder(t)
    t.events.repartition(3, "event_id").write.parquet(f"{path}/in")
    kept, merged = Buckets(t.spark, f"{path}/kept", ["user_id"]), Buckets(t.spark, f"{path}/merged", ["user_id"])
    stream = t.spark.readStream.schema(t.events.schema).option("maxFilesPerTrigger", 1).parquet(f"{path}/in")
    run_available(stream, merge_batches(kept, merged, ["user_id"], ["event_id"], [F.col("ts")], first_known_events), f"{path}/checkpoint")
    return merged.read()
