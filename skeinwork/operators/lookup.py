"""Lookups by several kinds of identifier, latest rows, the read views."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import collections as C
from ..functions import numbers as N
from ..functions import text as X
from .catalog import newest


def latest_per(df: DataFrame, key: str, order: str = "id") -> DataFrame:
    return newest(df, [key], F.desc(order))


def exactly_one(df: DataFrame, what: str = "row") -> DataFrame:
    """df, which fails when it is run unless it has one row."""
    n = df.groupBy().agg(F.count("*").alias("__n"))
    checked = n.select(F.when(F.col("__n") == 1, F.lit(1)).otherwise(F.raise_error(F.concat(F.lit(f"expected one {what}, found "), F.col("__n").cast("string")))).alias("__ok"))
    return df.withColumn("__ok", F.lit(1)).join(F.broadcast(checked), "__ok").drop("__ok")


def resolve(identifiers: DataFrame, snapshots: DataFrame, websites: DataFrame) -> DataFrame:
    """identifier -> snapshot_id: by snapshot id, else job id, else the newest of a website id, else the newest of a website name. Null where nothing fits."""
    number = X.whole_number(F.col("identifier"))
    own = identifiers.select("identifier").distinct()
    s = snapshots.select(F.col("id").alias("snapshot_id"), "website_id", "rq_job_id")
    by_id = own.withColumn("n", number).join(s.select("snapshot_id"), F.col("n") == F.col("snapshot_id")).select("identifier", "snapshot_id", F.lit(1).alias("way"))
    by_job = own.where(X.uuid_like(F.col("identifier"))).join(s, F.col("identifier") == F.col("rq_job_id")).select("identifier", "snapshot_id", F.lit(2).alias("way"))
    last = s.groupBy("website_id").agg(F.max("snapshot_id").alias("snapshot_id"))
    by_site = own.withColumn("website_id", number).join(last, "website_id").select("identifier", "snapshot_id", F.lit(3).alias("way"))
    named = websites.select(F.col("id").alias("website_id"), F.col("name").alias("identifier"))
    by_name = own.join(named, "identifier").join(last, "website_id").select("identifier", "snapshot_id", F.lit(4).alias("way"))
    found = newest(by_id.union(by_job).union(by_site).union(by_name), ["identifier"], F.asc("way"), F.desc("snapshot_id"))
    return own.join(found.drop("way"), "identifier", "left")


def newest_first(df: DataFrame, created: str = "created_at", key: str = "id") -> DataFrame:
    return df.orderBy(F.desc(created), F.desc(key))


CARD = "struct<crawled:bigint,total:bigint,pending:bigint,success_ratio:double,health:struct<log_stalled:boolean,cdx_stalled:boolean,js_heavy:boolean>,http_status:map<string,bigint>,mime_distribution:map<string,bigint>>"


def cards(snapshots: DataFrame, websites: DataFrame) -> DataFrame:
    """What the dashboard shows of each snapshot, newest first; a note where there are no statistics."""
    stats = F.from_json("crawl_stats", CARD)
    w = websites.select(F.col("id").alias("website_id"), F.col("name").alias("website"))
    out = snapshots.withColumn("s", stats).join(w, "website_id", "left").withColumn("note", F.when(F.col("crawl_stats").isNull(), "No crawl statistics yet"))
    badges = F.array_compact(F.array(*[F.when(F.col(f"s.health.{k}"), F.lit(k)) for k in ("log_stalled", "cdx_stalled", "js_heavy")]))
    return newest_first(out).select("id", "website", "status", "created_at", "s.crawled", "s.pending", "s.success_ratio", badges.alias("badges"), C.labels_and_values(F.col("s.http_status")).alias("status_chart"), C.labels_and_values(F.col("s.mime_distribution")).alias("mime_chart"), "note")


def count_rows(snapshots: DataFrame, which: str) -> DataFrame:
    """id, key, n of one of the maps of the statistics."""
    return snapshots.select("id", F.explode(F.from_json("crawl_stats", CARD)[which]).alias("key", "n"))


def detail(snapshot: DataFrame, container: str) -> DataFrame:
    """The detail panel: memory and traffic in words; sections whose document is missing are null."""
    doc = F.from_json("container_stats", container)
    held = snapshot.withColumn("c", doc)
    there = F.col("c").isNotNull()
    size = lambda path: F.when(there, N.human_size(F.col(path)))
    return held.select(
        "id", "status", "progress", F.col("c.state").alias("state"), F.col("c.resources.cpu_percent").alias("cpu_percent"), size("c.resources.memory.usage_bytes").alias("memory"),
        size("c.io.network.rx_bytes").alias("received"), size("c.io.network.tx_bytes").alias("sent"), size("c.io.block.read_bytes").alias("read"), size("c.io.block.write_bytes").alias("written"),
        F.coalesce("process_stats", F.lit("{}")).alias("process_stats"),
    )


def to_json_rows(df: DataFrame, *columns: str | Column) -> DataFrame:
    return df.select(F.to_json(F.struct(*(columns or df.columns))).alias("json"))
