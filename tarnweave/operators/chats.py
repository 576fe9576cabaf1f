"""Stored conversations: tables of chats ``(id, title, updated, messages)`` and of messages ``(chat, at, role, text)``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def listed(chats: DataFrame, most: int = 50) -> DataFrame:
    """The chats that changed last, of equal times those of least id."""
    return chats.orderBy(F.col("updated").desc(), "id").limit(most)


def messages_of(messages: DataFrame, chat) -> DataFrame:
    return messages.where(F.col("chat") == F.lit(chat)).orderBy("at")


def appended(chats: DataFrame, messages: DataFrame, new: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both tables after new messages; counts and times of their chats follow.  Messages of unknown chats are left out."""
    new = new.join(chats.select(F.col("id").alias("chat")), "chat", "left_semi").select(messages.columns)
    more = new.groupBy(F.col("chat").alias("id")).agg(F.count("*").alias("_n"), F.max("at").alias("_at"))
    counted = chats.join(more, "id", "left").withColumns({"messages": F.col("messages") + F.coalesce("_n", F.lit(0)), "updated": F.greatest("updated", "_at")})
    return counted.select(chats.columns), messages.union(new)


def removed(chats: DataFrame, messages: DataFrame, ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both tables without the chats of ``(id)`` and their messages."""
    return chats.join(ids, "id", "left_anti"), messages.join(ids.select(F.col("id").alias("chat")), "chat", "left_anti").select(messages.columns)


def renamed(chats: DataFrame, titles: DataFrame) -> DataFrame:
    """Chats with the titles of ``(id, title)``, one a chat; empty titles change nothing."""
    new = titles.select("id", F.nullif(F.trim("title"), F.lit("")).alias("_t"))
    return chats.join(new, "id", "left").withColumn("title", F.coalesce("_t", "title")).select(chats.columns)
