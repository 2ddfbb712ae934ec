"""Queues and flags as tables: what a crawl's control is told, kept as rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .sinks import VersionedTable
from .tasks import queue_name


def enqueued(tasks: DataFrame, now: Column) -> DataFrame:
    """A row for each task in the queue of its priority, in the order of update times."""
    return tasks.select(queue_name(F.col("priority")).alias("queue"), "uid", "action", F.col("updateTime").alias("ordered_by"), now.alias("enqueued_at"))


def taken(queue: DataFrame, name: str, most: int) -> DataFrame:
    """The first rows of one queue."""
    return queue.where(F.col("queue") == name).orderBy("ordered_by", "uid").limit(most)


def without(queue: DataFrame, done: DataFrame) -> DataFrame:
    """The queue after its done rows have gone."""
    return queue.join(done.select("queue", "uid"), ["queue", "uid"], "left_anti").select(*queue.columns)


def set_flags(table: VersionedTable, flags: DataFrame) -> int:
    """Flags (key, value) into the control table, the last value winning; the table's new version."""
    return table.upsert(flags.select("key", "value"), ["key"])


def clear_flags(table: VersionedTable, keys: DataFrame) -> int:
    old = table.read()
    return table.replace(old.join(keys.select("key"), "key", "left_anti").select("key", "value")) if old is not None else 0
