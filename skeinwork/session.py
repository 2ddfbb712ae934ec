"""Session settings shared by tests, bench and entry points."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import SparkSession

ROOT = str(Path(__file__).resolve().parent.parent)


def local_session(app: str = "skeinwork", cores: str = "*", partitions: int = 8, memory: str = "8g", **conf) -> SparkSession:
    """A local session with the settings that the queries are tested under."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]").appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return ship(spark)


def ship(spark: SparkSession) -> SparkSession:
    """Lets Python workers import this package from the checkout it runs from."""
    env = spark.sparkContext.environment
    parts = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if ROOT not in parts:
        env["PYTHONPATH"] = os.pathsep.join([*parts, ROOT])
    return spark


_own: list[str] = []
_made: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """A fresh path in the folder that spark.checkpoint.dir names, which all executors reach. Where that is unset: in local mode one that goes with the process, else one beside the warehouse."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base and spark.sparkContext.master.startswith("local") and "cluster" not in spark.sparkContext.master:
        if not _own:
            _own.append(tempfile.mkdtemp(prefix="skeinwork-"))
            atexit.register(shutil.rmtree, _own[0], ignore_errors=True)
        base = f"file://{_own[0]}"
    elif not base:
        base = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "-checkpoints"
    _made.append(f"{base.rstrip('/')}/skein-{uuid.uuid4().hex}")
    return _made[-1]


def release(spark: SparkSession) -> int:
    """Deletes the folders that this process made with `shared_folder`, for when the results that read them are used up; how many there were."""
    paths, _made[:] = list(_made), []
    for path in paths:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
    return len(paths)
