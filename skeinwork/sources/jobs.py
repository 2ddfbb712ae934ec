"""Control tables: job registries, job lookups, flags."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def all_jobs(*registries: DataFrame) -> DataFrame:
    """The jobs of several registries, none dropped."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), registries)


def job_status(jobs: DataFrame, wanted: DataFrame) -> DataFrame:
    """Status of the wanted job_ids: the result only of finished jobs, an error for unknown ones."""
    out = wanted.select("job_id").join(jobs.select("job_id", "status", "result"), "job_id", "left")
    done = F.when(F.col("status") == "finished", F.col("result"))
    return out.select("job_id", "status", done.alias("result"), F.when(F.col("status").isNull(), "Job not found").alias("error"))


def flag(control: DataFrame, key: str) -> DataFrame:
    """One row with `raised`: whether a flag of the control table is set."""
    return control.where((F.col("key") == key) & F.col("value").isin("1", "true", "True")).agg((F.count("*") > 0).alias("raised"))


def active_queues(queues: DataFrame, excluded=("default", "task_sync", "cron")) -> DataFrame:
    """Queues that may be worked on: not excluded (names, or a table of them) and not paused."""
    held = queues.where(~F.coalesce("paused", F.lit(False)))
    if isinstance(excluded, DataFrame):
        return held.join(excluded.select("name"), "name", "left_anti").select(*queues.columns)
    return held.where(~F.col("name").isin(*excluded))
