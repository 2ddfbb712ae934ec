"""Batch jobs: plans over the operators, each giving the tables it would write and a row of counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import catalog as K
from ..operators import tasks as Q
from ..sources import files


def import_tasks(documents: DataFrame, stored: DataFrame, snapshots: DataFrame, now: Column, locked: Column, force: bool = False, only_sync: bool = False) -> dict[str, DataFrame]:
    """Documents of the API to stored tasks and dispatches. only_sync stores and doesn't dispatch."""
    due = Q.gated(Q.imported(documents), now, locked)
    marked = K.insert_if_absent(stored, due, ["uid"])
    made = Q.with_payload_snapshot(marked.where("created").drop("created"), snapshots)
    chosen = marked.where(F.col("created") | F.lit(force)) if not only_sync else marked.limit(0)
    routed = Q.routed(chosen).withColumn("queue", Q.queue_name(F.col("priority")))
    return {"new": made, "dispatch": routed, "counts": Q.outcome(routed)}


def sync_tasks(documents: DataFrame, stored: DataFrame) -> DataFrame:
    """The stored state of the tasks that the API asks about, to be told again."""
    known = stored.select("uid", F.col("status").alias("own_status"), "snapshot_id", "taskResponse")
    return documents.select("uid", "status").join(known, "uid").select("uid", F.col("own_status").alias("status"), "snapshot_id", "taskResponse")


def requeue_failed(tasks: DataFrame, limit: int | None = None, dry_run: bool = False) -> dict[str, DataFrame]:
    """The oldest failed tasks back to their queue."""
    chosen = Q.failed_oldest(tasks, limit)
    counts = chosen.agg(F.count("*").alias("found"), F.lit(dry_run).alias("dry_run"))
    return {"requeue": Q.routed(chosen.limit(0) if dry_run else chosen.withColumn("status", F.lit("scheduled"))), "counts": counts}


def cleanup_orphans(snapshots: DataFrame, directories: DataFrame, warcs: DataFrame, deliveries: DataFrame, tasks: DataFrame, dry_run: bool = False) -> dict[str, DataFrame]:
    gone = K.orphans(snapshots, directories)
    out = {"orphans": gone, "counts": K.orphan_summary(snapshots, gone)}
    return out if dry_run else out | K.cascade_delete(gone.select("id"), snapshots, warcs, deliveries, tasks)


def archive(spark, catalog: DataFrame, directory: str, snapshot_id: int, target: str | None = None) -> dict[str, DataFrame]:
    """A finished crawl's files into the long-term catalog, with digests and the snapshot's totals; with a target they are copied there first, and are in the catalog by their new paths."""
    listed = files.warcs(spark, directory)
    if target:
        files.transferred(files.indexes(spark, directory), target).write.format("noop").mode("overwrite").save()
        hashed = files.transferred(listed, target)
    else:
        hashed = listed.join(files.digests(spark, directory, "*.{warc,warc.gz}"), "path")
    out = K.register(catalog, hashed, snapshot_id)
    return {"warc": out, "totals": K.rollup(out.where(F.col("snapshot_id") == snapshot_id))}


def publish(snapshots: DataFrame, chosen: DataFrame, index: DataFrame, lines: DataFrame) -> dict[str, DataFrame]:
    return {"snapshot": K.set_publication(snapshots, chosen, "public"), "index": K.publish_index(index, lines)}


def unpublish(snapshots: DataFrame, chosen: DataFrame, index: DataFrame, lines: DataFrame, warcs: DataFrame) -> dict[str, DataFrame]:
    kept = warcs.join(chosen.select(F.col("id").alias("snapshot_id")).withColumn("__off", F.lit(True)), "snapshot_id", "left")
    off = kept.withColumn("is_production", F.col("is_production") & F.col("__off").isNull()).drop("__off").select(*warcs.columns)
    return {"snapshot": K.set_publication(snapshots, chosen, "internal"), "index": K.unpublish_index(index, lines), "warc": off}


def repopulate(snapshots: DataFrame, chosen: DataFrame, index: DataFrame, lines: DataFrame) -> dict[str, DataFrame]:
    """Index rows taken out and put in again."""
    return publish(snapshots, chosen, K.unpublish_index(index, lines), lines)


def publish_website(snapshots: DataFrame, websites: DataFrame, index: DataFrame, lines: DataFrame) -> dict[str, DataFrame]:
    """All snapshots of the given websites."""
    return publish(snapshots, K.of_websites(snapshots, websites), index, lines)


def unpublish_website(snapshots: DataFrame, websites: DataFrame, index: DataFrame, lines: DataFrame, warcs: DataFrame) -> dict[str, DataFrame]:
    return unpublish(snapshots, K.of_websites(snapshots, websites), index, lines, warcs)
