"""Session settings that results rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(master: str | None = None, **conf: str) -> SparkSession:
    """UTC, last value of repeated map keys, and adaptive plans with skew handling."""
    b = SparkSession.builder.appName("tarnweave")
    if master:
        b = b.master(master)
    base = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.parquet.filterPushdown": "true",
    }
    return b.config(map=base | {k.replace("_", "."): v for k, v in conf.items()}).getOrCreate()
