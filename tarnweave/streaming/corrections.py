"""Amendments kept as a stream: late ones never overwrite, whatever the order of arrival."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .incremental import Buckets, run_available, upsert_batches

#: State lives in the checkpoint; this provider spills to disk, writes what a batch has changed only, and doesn't look keys up to count them.
_STORE = "spark.sql.streaming.stateStore."
STATE = {
    f"{_STORE}providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    f"{_STORE}rocksdb.changelogCheckpointing.enabled": "true",
    f"{_STORE}rocksdb.trackTotalNumberOfRows": "false",
}


def amendments(stream: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row so far in ``order`` (ascending, nulls first) of each of ``keys`` that a batch names, for the update mode.

    A streaming aggregate: rows of a key meet before the shuffle, and the state is one row per lot and notice, so a placeholder lot of very
    many notices is no hot group.  There is no watermark: an amendment may come arbitrarily late, before or after what it amends.
    """
    for key, value in STATE.items():
        stream.sparkSession.conf.set(key, value)
    first = F.min_by(F.struct(*[F.col(c) for c in stream.columns]), F.struct(*[F.col(c) for c in order]))
    return stream.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(first.alias("_first")).select("_first.*")


def keep_amendments(stream: DataFrame, table: Buckets, keys: list[str], order: list[str], checkpoint: str) -> None:
    """Brings the table of amendments up to date with what has arrived; a batch that is repeated changes nothing."""
    run_available(amendments(stream, keys, order), upsert_batches(table, keys, [F.col(c).asc_nulls_first() for c in order]), checkpoint, "update")
