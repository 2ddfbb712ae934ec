"""The WARC catalog and what follows from it: upserts, publication, orphans, deletion.

Plain Parquet has no MERGE; an upsert is a union and the newest row of each key, and a deletion an anti-join, both to be
written to a new place. Where a table is partitioned, only the touched partitions need be rewritten.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import text as X


def newest(df: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """The first row of each key in the given order."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rank", F.row_number().over(w)).where("__rank = 1").drop("__rank")


def upsert(old: DataFrame, new: DataFrame, keys: list[str], keep_null: bool = True) -> DataFrame:
    """Rows of both by key. New values win; with keep_null a null new value leaves the old one. New rows of one key: the last by its other columns."""
    others = [c for c in old.columns if c not in keys]
    single = newest(new, keys, *[F.desc(c) for c in new.columns if c not in keys])
    marked = single.withColumn("__new", F.lit(True)).select(*keys, "__new", *[F.col(c).alias(f"__{c}") for c in others if c in new.columns])
    both = old.withColumn("__old", F.lit(True)).join(marked, keys, "full")
    value = lambda c: F.coalesce(f"__{c}", c) if keep_null else F.when(F.col("__new"), F.col(f"__{c}")).otherwise(F.col(c))
    return both.select(*keys, *[(value(c) if c in new.columns else F.col(c)).alias(c) for c in others])


def insert_if_absent(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """new's rows with `created`: false where the key was there, whose stored row stays as it is. Keys that repeat in new are created once."""
    single = newest(new, keys, *[F.asc(c) for c in new.columns if c not in keys] or [F.lit(1)])
    return single.join(old.select(*keys).distinct().withColumn("__there", F.lit(True)), keys, "left").withColumn("created", F.col("__there").isNull()).drop("__there")


def appended(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """old and those of new whose key it lacks."""
    made = insert_if_absent(old, new, keys).where("created").drop("created")
    return old.unionByName(made, allowMissingColumns=True)


def looked_up(rows: DataFrame, table: DataFrame, key: str, by: str) -> DataFrame:
    """rows beside those of table by a key of whole numbers or text, a left join. Rows without a key match nothing; they are spread by another column instead of meeting in one task."""
    text = F.xxhash64(F.col(key).cast("string"))
    spread = F.when(F.col(key).isNull(), F.xxhash64(by)).otherwise(text)
    return rows.withColumn("__spread", spread).join(table.withColumn("__spread", text), [key, "__spread"], "left").drop("__spread")


def without(rows: DataFrame, gone: DataFrame, keys: list[str]) -> DataFrame:
    return rows.join(gone.select(*keys), keys, "left_anti")


def rollup(warcs: DataFrame) -> DataFrame:
    """Files and bytes of each snapshot."""
    return warcs.groupBy("snapshot_id").agg(F.count("*").alias("item_count"), F.sum("size_bytes").alias("size"))


def production(warcs: DataFrame) -> DataFrame:
    return warcs.where(F.col("is_production"))


def register(catalog: DataFrame, listing: DataFrame, snapshot_id: int, tier: str = "longterm") -> DataFrame:
    """The catalog with a directory's files: keyed by snapshot and name; a production copy keeps the long-term path beside its own."""
    new = listing.where(X.has_suffix(F.col("filename"), ".warc", ".warc.gz")).withColumn("snapshot_id", F.lit(snapshot_id).cast("long")).withColumn("is_production", F.lit(tier == "production"))
    if tier == "production" and "production_path" in catalog.columns:
        new = new.withColumnRenamed("path", "production_path")
    return upsert(catalog, new, ["snapshot_id", "filename"])


def orphans(snapshots: DataFrame, directories: DataFrame) -> DataFrame:
    """Snapshots whose collection has no archive directory. directories: collection."""
    return snapshots.join(directories.select(F.col("collection").alias("replay_collection_id")), "replay_collection_id", "left_anti")


def orphan_summary(snapshots: DataFrame, gone: DataFrame) -> DataFrame:
    """checked and removed, in one row, by one union and one aggregate."""
    both = snapshots.select(F.lit(1).alias("c"), F.lit(0).alias("r")).union(gone.select(F.lit(0), F.lit(1)))
    return both.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("checked"), F.coalesce(F.sum("r"), F.lit(0)).alias("removed"))


def cascade_delete(gone: DataFrame, snapshots: DataFrame, warcs: DataFrame, deliveries: DataFrame, tasks: DataFrame) -> dict[str, DataFrame]:
    """The four tables without the snapshots: children go too, tasks only lose their reference."""
    ids = gone.select(F.col("id").alias("snapshot_id"))
    lost = looked_up(tasks, ids.withColumn("__gone", F.lit(True)), "snapshot_id", "uid")
    return {
        "snapshot": snapshots.join(ids, snapshots["id"] == ids["snapshot_id"], "left_anti"),
        "warc": without(warcs, ids, ["snapshot_id"]),
        "snapshot_response_delivery": without(deliveries, ids, ["snapshot_id"]),
        "task": lost.withColumn("snapshot_id", F.when(F.col("__gone").isNull(), F.col("snapshot_id"))).drop("__gone").select(*tasks.columns),
    }


def set_publication(snapshots: DataFrame, chosen: DataFrame, status: str) -> DataFrame:
    """snapshots with the chosen ids moved to `public` or `internal`."""
    held = snapshots.join(chosen.select(F.col("id").alias("__id")).distinct(), F.col("id") == F.col("__id"), "left")
    hit = F.col("__id").isNotNull()
    return held.withColumn("publication_status", F.when(hit, status).otherwise(F.col("publication_status"))).withColumn("published", F.when(hit, F.lit(status == "public")).otherwise(F.col("published"))).drop("__id")


def of_websites(snapshots: DataFrame, websites: DataFrame) -> DataFrame:
    """The snapshots of the given website ids: the fan-out of an operation on a website."""
    return snapshots.join(websites.select(F.col("id").alias("website_id")), "website_id", "left_semi")


def publish_index(index: DataFrame, lines: DataFrame) -> DataFrame:
    """CDX rows added; a line that is there already isn't added again."""
    return index.unionByName(lines.dropDuplicates().join(index, index.columns, "left_anti"))


def unpublish_index(index: DataFrame, lines: DataFrame) -> DataFrame:
    return index.join(lines.select(*index.columns).distinct(), index.columns, "left_anti")


def final_status(exits: DataFrame) -> DataFrame:
    """Snapshot status by the crawler's exit code."""
    return exits.withColumn("status", F.when(F.col("exit_code").isin(0, 137, 143), "completed").otherwise("failed"))


def fill_justification(snapshots: DataFrame, tasks: DataFrame, key: str = "publicationJustification") -> DataFrame:
    """Snapshots whose justification is null get the one of their newest task that has one."""
    told = tasks.select("snapshot_id", "created_at", "id", X.json_key(F.col("taskParameters"), key).alias("__text")).where(F.col("__text").isNotNull() & F.col("snapshot_id").isNotNull())
    told = newest(told, ["snapshot_id"], F.desc("created_at"), F.desc("id")).select(F.col("snapshot_id").alias("__snapshot"), "__text")
    out = snapshots.join(told, F.col("id") == F.col("__snapshot"), "left")
    return out.withColumn(key, F.coalesce(key, "__text")).drop("__snapshot", "__text")
