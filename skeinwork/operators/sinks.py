"""Sinks: latest-wins tables, audit logs, deliveries, JSON and YAML documents, the CDX table.

A delivery is at most once: an attempt is recorded whatever comes of it and never made again, which a batch id guards.
"""

from __future__ import annotations

import json
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .catalog import newest, upsert


def exists(spark: SparkSession, path: str) -> bool:
    from pyspark.errors import AnalysisException

    try:
        spark.read.parquet(path)
        return True
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "UNABLE_TO_INFER_SCHEMA" in str(e):
            return False
        raise


class VersionedTable:
    """A Parquet table that is replaced as a whole: each version is a folder, the highest finished one is read.

    A writer that dies leaves a folder without its _SUCCESS mark, which is never read. The last `keep` versions stay, for readers
    that have begun; older ones go when a new one is written.
    """

    def __init__(self, spark: SparkSession, path: str, keep: int = 3):
        self.spark, self.path, self.keep = spark, path.rstrip("/"), max(2, keep)

    def _versions(self) -> list[int]:
        p = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        fs = p.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not fs.exists(p):
            return []
        names = [s.getPath() for s in fs.listStatus(p)]
        done = [n for n in names if fs.exists(self.spark._jvm.org.apache.hadoop.fs.Path(n, "_SUCCESS"))]
        return sorted(int(n.getName().removeprefix("v")) for n in done if n.getName().startswith("v"))

    def read(self) -> DataFrame | None:
        v = self._versions()
        return self.spark.read.parquet(f"{self.path}/v{v[-1]}") if v else None

    def replace(self, df: DataFrame) -> int:
        n = (v[-1] if (v := self._versions()) else 0) + 1
        df.write.mode("overwrite").parquet(f"{self.path}/v{n}")
        for old in self._versions()[: -self.keep]:
            p = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/v{old}")
            p.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(p, True)
        return n

    def upsert(self, new: DataFrame, keys: list[str]) -> int:
        old = self.read()
        return self.replace(newest(new, keys, *[F.desc(c) for c in new.columns if c not in keys]) if old is None else upsert(old, new, keys))


def latest_wins(table: VersionedTable, keys: list[str]) -> Callable[[DataFrame, int], None]:
    """A foreachBatch function that keeps the newest row of each key."""
    def write(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            table.upsert(batch, keys)

    return write


def deliveries(payloads: DataFrame, key: str, url: Column, method: str, send: Callable[[str, str, str], tuple[int, str]], now: Column) -> DataFrame:
    """The audit rows of sending (key, payload) rows. send(method, url, payload) gives status and body, on the workers; what it raises is recorded."""
    @F.pandas_udf("http_status int, response_body string, error_message string")
    def attempt(target: pd.Series, payload: pd.Series) -> pd.DataFrame:
        out = []
        for t, p in zip(target, payload):
            try:
                status, body = send(method, t, p)
                out.append((status, body, ""))
            except Exception as e:  # noqa: BLE001 - every failure is a row
                out.append((None, "", str(e)))
        return pd.DataFrame(out, columns=["http_status", "response_body", "error_message"])

    sent = payloads.select(key, "payload", url.alias("target_url")).withColumn("r", attempt.asNondeterministic()("target_url", "payload"))
    ok = F.coalesce(F.col("r.http_status").between(200, 299), F.lit(False))
    uid = F.expr("uuid()")
    return sent.select(uid.alias("uid"), "payload", "target_url", F.lit(method).alias("http_method"), "r.http_status", "r.response_body", ok.alias("success"), "r.error_message", now.alias("created_at"), key)


def deliver_batches(path: str, key: str, url: Column, method: str, send) -> Callable[[DataFrame, int], None]:
    """A foreachBatch function: each batch's audit rows go to a folder of its number, and a batch that is there already isn't sent again."""
    def write(batch: DataFrame, batch_id: int) -> None:
        if not exists(batch.sparkSession, target := f"{path}/batch={batch_id}"):
            deliveries(batch, key, url, method, send, F.current_timestamp()).write.parquet(target)

    return write


def append_audit(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").parquet(path)


def write_json(df: DataFrame, path: str) -> None:
    """A line of JSON for each row."""
    df.select(F.to_json(F.struct(*df.columns)).alias("value")).write.mode("overwrite").text(path)


def yaml_text(document: Column) -> Column:
    """A JSON document as YAML, keys in their order. JSON is YAML; this is the block form of one level, deeper ones stay inline."""
    @F.pandas_udf("string")
    def block(texts: pd.Series) -> pd.Series:
        def one(t):
            if t is None:
                return None
            lines = []
            for k, v in json.loads(t).items():
                if isinstance(v, list):
                    lines += [f"{k}:", *[f"- {json.dumps(x, ensure_ascii=False)}" for x in v]]
                else:
                    lines.append(f"{k}: {json.dumps(v, ensure_ascii=False)}")
            return "\n".join(lines) + "\n"

        return texts.map(one)

    return block(document)


def write_crawler_configs(configs: DataFrame, path: str) -> None:
    """The YAML of each task's configuration, in a folder for each task."""
    configs.where("config is not null").select("uid", yaml_text(F.col("config")).alias("value")).write.mode("overwrite").partitionBy("uid").text(path)
