"""Task import, gates, routing, eligibility and replies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions import times as T
from .catalog import insert_if_absent, looked_up, newest

#: action -> (queue group, whether the action needs a target task)
ACTIONS = {
    "admin_platform_lock": ("platform", False), "admin_platform_unlock": ("platform", False), "disable_adding_crawls": ("platform", False), "enable_adding_crawls": ("platform", False),
    "crawl_run": ("crawl", False), "crawl_force_finish": ("crawl", True), "crawl_cancel": ("crawl", True), "crawl_suspend": ("crawl", True), "crawl_resume": ("crawl", True), "crawl_stop": ("crawl", True),
    "website_publish_all": ("website", False), "website_unpublish_all": ("website", False), "website_group_set_schedule": ("website_group", False),
    "website_group_set_crawl_config": ("website_group", False), "website_group_priority_crawl": ("website_group", False),
    "replay_publish": ("replay", False), "replay_unpublish": ("replay", False), "replay_repopulate": ("replay", False), "export_archive": ("export", False),
}
#: Exports are named after where they go.
EXPORT = "export_"
PRIORITIES = ("low", "normal", "high", "priority")
EXEMPT = "enable_adding_crawls"


def imported(documents: DataFrame) -> DataFrame:
    """API documents as task columns: times parsed (null where they can't be), empty texts kept."""
    return documents.select(*[T.from_iso(F.col(c)).alias(c) if c.endswith("Time") or c == "runAt" else F.col(c) for c in documents.columns])


def due(run_at: Column, now: Column) -> Column:
    return run_at.isNull() | (run_at <= now)


def unlocked(action: Column, locked: Column) -> Column:
    return ~locked | (action == EXEMPT)


def gated(tasks: DataFrame, now: Column, locked: Column) -> DataFrame:
    """The tasks that may start now. Each goes by its own runAt."""
    return tasks.where(due(F.col("runAt"), now) & unlocked(F.col("action"), locked))


def to_dispatch(stored: DataFrame, incoming: DataFrame, force: bool = False) -> DataFrame:
    """incoming with `created`, only rows that are new unless forced."""
    marked = insert_if_absent(stored, incoming, ["uid"])
    return marked.where(F.col("created") | F.lit(force))


def routed(tasks: DataFrame) -> DataFrame:
    """Adds group, known and message by action; an action that isn't known fails."""
    actions = F.broadcast(tasks.sparkSession.createDataFrame([(a, g) for a, (g, _) in ACTIONS.items()], "action string, handler string"))  # a constant table
    out = tasks.join(actions, "action", "left").withColumn("handler", F.coalesce("handler", F.when(F.col("action").startswith(EXPORT), "export")))
    known = F.col("handler").isNotNull()
    return out.withColumn("dispatch_status", F.when(known, "dispatched").otherwise("failed")).withColumn("dispatch_message", F.when(~known, F.concat(F.lit("Unsupported task action: "), F.coalesce("action", F.lit("None")))))


def queue_name(priority: Column) -> Column:
    return F.concat(F.lit("crawls_"), F.when(priority.isin(*PRIORITIES), priority).otherwise("normal"))


def with_target(tasks: DataFrame, stored: DataFrame) -> DataFrame:
    """Each task beside the one that its parameters name: target_status, target_snapshot_id; target_found tells whether there is one."""
    aims = tasks.withColumn("target_uid", X.json_key(F.col("taskParameters"), "target_task_uid"))
    there = newest(stored, ["uid"], F.desc("id")).select(F.col("uid").alias("target_uid"), F.col("status").alias("target_status"), F.col("snapshot_id").alias("target_snapshot_id"), F.lit(True).alias("target_found"))
    return looked_up(aims, there, "target_uid", "uid").withColumn("target_found", F.coalesce("target_found", F.lit(False)))


def eligibility(action: Column, target_uid: Column, found: Column, status: Column, snapshot: Column) -> tuple[Column, Column]:
    """(status, message) of a control task: why it fails, or null for both."""
    aimed = action.isin(*[a for a, (_, t) in ACTIONS.items() if t])
    stops = action.isin("crawl_stop", "crawl_force_finish")
    rules = [
        (aimed & ~F.coalesce(X.truthy(target_uid), F.lit(False)), "No target task is named"),
        (aimed & ~found, "The target task is not known"),
        ((action == "crawl_suspend") & ~status.eqNullSafe("running"), "Only a running crawl can be suspended"),
        (stops & ~status.eqNullSafe("running"), "Only a running crawl can be finished"),
        ((action == "crawl_resume") & ~status.eqNullSafe("paused"), "Only a paused crawl can be resumed"),
        ((stops | (action == "crawl_suspend")) & snapshot.isNull(), "The target task has no snapshot"),
    ]
    message = F.lit(None).cast("string")
    for test, text in reversed(rules):
        message = F.when(test, text).otherwise(message)
    return F.when(message.isNotNull(), "failed"), message


#: What a control action makes of a target that is eligible.
NEXT = {"crawl_suspend": "paused", "crawl_resume": "running", "crawl_stop": "stopped", "crawl_force_finish": "stopped", "crawl_cancel": "cancelled"}


def controlled(tasks: DataFrame, stored: DataFrame) -> DataFrame:
    """Control tasks with the outcome: control_status failed and a message, or the state that their target goes to."""
    held = with_target(tasks, stored)
    failed, message = eligibility(F.col("action"), F.col("target_uid"), F.col("target_found"), F.col("target_status"), F.col("target_snapshot_id"))
    after = F.lit(None).cast("string")
    for action, state in NEXT.items():
        after = F.when(F.col("action") == action, state).otherwise(after)
    return held.withColumn("control_status", F.coalesce(failed, after)).withColumn("control_message", message)


def with_payload_snapshot(tasks: DataFrame, snapshots: DataFrame) -> DataFrame:
    """Tasks with the id of the snapshot that their parameters embed, if it is stored."""
    known = newest(snapshots.select("uid", "id"), ["uid"], F.asc("id")).select(F.col("uid").alias("__uid"), F.col("id").alias("payload_snapshot_id"))
    aims = tasks.withColumn("__uid", X.json_key(F.col("taskParameters"), "snapshot", "uid"))
    return looked_up(aims, known, "__uid", "uid").drop("__uid")


def lifecycle(tasks: DataFrame, finished: DataFrame, now: Column) -> DataFrame:
    """Tasks after their runs. finished: uid, error (null for success). A reply carries the time and the snapshot."""
    ended = finished.select("uid", "error", F.lit(True).alias("__ended"))
    out = tasks.join(ended, "uid", "left")
    status = F.when(F.col("__ended").isNull(), F.col("status")).when(F.col("error").isNull(), "success").otherwise("failed")
    reply = F.to_json(F.struct(T.to_iso(now).alias("updatedAt"), F.col("snapshot_id").alias("snapshotID")))
    return out.withColumn("status", status).withColumn("taskResponse", F.when(F.col("__ended"), reply).otherwise(F.col("taskResponse"))).withColumn("resultDescription", F.coalesce("error", "resultDescription")).drop("__ended", "error")


def failed_oldest(tasks: DataFrame, limit: int | None = None) -> DataFrame:
    """Failed tasks by time of update, oldest first."""
    out = tasks.where(F.col("status") == "failed").orderBy("updateTime", "uid")
    return out.limit(limit) if limit else out


def page(df: DataFrame, order: list[str], start: int, size: int) -> DataFrame:
    return df.orderBy(*order).offset(start).limit(size)


def outcome(dispatched: DataFrame) -> DataFrame:
    """Counts of a run: processed, dispatched, failed."""
    ok = F.col("dispatch_status") == "dispatched"
    return dispatched.agg(F.count("*").alias("processed"), F.count_if(ok).alias("dispatched"), F.count_if(~ok).alias("failed"))


def admin_start(websites: DataFrame) -> DataFrame:
    """started and skipped: an action on chosen websites starts the enabled ones."""
    on = F.coalesce("enabled", F.lit(False))
    return websites.agg(F.count_if(on).alias("started"), F.count_if(~on).alias("skipped"))
