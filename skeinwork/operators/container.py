"""Container documents: state, processor, memory, network and disk figures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import collections as C
from ..functions import numbers as N
from ..functions import times as T


def payload(containers: DataFrame, now: Column, any_case: bool = False) -> DataFrame:
    """The nested statistics of container documents (schemas.CONTAINER). A container that isn't running has zero figures; one that can't be reached only a status `unknown` and an error."""
    s, a = F.col("stats"), F.col("attrs")
    live = F.coalesce(a.State.Running, F.lit(False))
    cpu, before = s.cpu_stats, s.precpu_stats
    number = lambda x: F.coalesce(F.when(live, x), F.lit(0))
    percent = F.when(live, N.cpu_percent(cpu.cpu_usage.total_usage, before.cpu_usage.total_usage, cpu.system_cpu_usage, before.system_cpu_usage, cpu.cpu_usage.percpu_usage)).otherwise(0.0)
    memory = F.when(live, N.memory_percent(s.memory_stats.usage, s.memory_stats.limit)).otherwise(0.0)
    entries = s.blkio_stats.io_service_bytes_recursive
    state = F.struct(
        F.col("status"), a.State.Running.alias("running"), a.State.Paused.alias("paused"), a.State.OOMKilled.alias("oom_killed"), a.State.ExitCode.alias("exit_code"),
        a.State.Error.alias("error"), a.State.StartedAt.alias("started_at"), a.State.FinishedAt.alias("finished_at"), a.State.RestartCount.alias("restart_count"),
    )
    resources = F.struct(
        F.round(percent, 2).alias("cpu_percent"),
        F.struct(number(s.memory_stats.usage).alias("usage_bytes"), number(s.memory_stats.limit).alias("limit_bytes"), F.round(memory, 2).alias("percent")).alias("memory"),
        F.when(live, s.pids_stats.current).alias("pids"),
    )
    io = F.struct(
        F.struct(number(C.network_total(s.networks, "rx_bytes")).alias("rx_bytes"), number(C.network_total(s.networks, "tx_bytes")).alias("tx_bytes")).alias("network"),
        F.struct(number(C.block_total(entries, "Read", any_case)).alias("read_bytes"), number(C.block_total(entries, "Write", any_case)).alias("write_bytes")).alias("block"),
    )
    there = F.coalesce("available", F.lit(True))
    config = F.struct("id", "short_id", "name", a.Config.Image.alias("image"), a.Config.Cmd.alias("command"), a.Config.Labels.alias("labels"))
    gone = F.struct("id", F.lit(None).cast("string").alias("short_id"), "name", F.lit(None).cast("string").alias("image"), F.lit(None).cast("array<string>").alias("command"), F.lit(None).cast("map<string,string>").alias("labels"))
    unknown = state.withField("status", F.lit("unknown"))
    for f in ("running", "paused", "oom_killed"):
        unknown = unknown.withField(f, F.lit(None).cast("boolean"))
    return containers.select(
        F.when(there, config).otherwise(gone).alias("container"), F.when(there, state).otherwise(unknown).alias("state"), F.when(there, resources).alias("resources"), F.when(there, io).alias("io"),
        F.struct(T.to_iso(now).alias("collected_at")).alias("timestamps"), F.when(~there, "Container metadata unavailable").alias("error"),
    )


def with_snapshot(payloads: DataFrame, snapshots: DataFrame, websites: DataFrame, now: Column) -> DataFrame:
    """Container payloads (with snapshot_id) and what is known of their snapshot."""
    s = snapshots.select(F.col("id").alias("snapshot_id"), F.col("status").alias("snapshot_status"), "website_id")
    w = websites.select(F.col("id").alias("website_id"), F.col("url").alias("website_url"))
    out = payloads.join(s, "snapshot_id", "left").join(w, "website_id", "left")
    return out.withColumn("snapshot", F.struct(F.col("snapshot_id").alias("id"), F.col("website_url").alias("website"), F.col("snapshot_status").alias("status"), T.to_iso(now).alias("updated_at"))).drop("snapshot_status", "website_id", "website_url")


def stored(snapshots: DataFrame, payloads: DataFrame) -> DataFrame:
    """Snapshots with the newest figures of their container (rows of `with_snapshot`) in container_stats, as JSON; the others keep theirs."""
    document = F.to_json(F.struct(*[c for c in payloads.columns if c != "snapshot_id"]))
    new = payloads.groupBy(F.col("snapshot_id").alias("id")).agg(F.max_by(document, F.col("snapshot.updated_at")).alias("__stats"))
    return snapshots.join(new, "id", "left").withColumn("container_stats", F.coalesce("__stats", "container_stats")).select(*snapshots.columns)
