"""A streaming source that resumes every file of a directory at the byte where it stopped.

The offset is a map from path to byte and lives in the query's checkpoint, so a restart goes on where the last run ended. Only
lines that end are delivered: a line torn across two polls comes once, whole. Each file is a partition of a batch.
"""

from __future__ import annotations

import fnmatch
import os

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

SCHEMA = "path string, offset long, line string, bytes long"
STEP = 4 << 20


class Range(InputPartition):
    def __init__(self, path: str, start: int, end: int):
        self.path, self.start, self.end = path, start, end


class TailReader(DataSourceStreamReader):
    def __init__(self, options: dict):
        self.directory, self.patterns = options["path"].removeprefix("file:"), options.get("patterns", "*.log").split(",")

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        """The end of the last whole line of each file."""
        out = {}
        if os.path.isdir(self.directory):
            for name in sorted(os.listdir(self.directory)):
                path = os.path.join(self.directory, name)
                if os.path.isfile(path) and any(fnmatch.fnmatch(name, p) for p in self.patterns):
                    out[path] = self._last_end(path)
        return out

    @staticmethod
    def _last_end(path: str) -> int:
        with open(path, "rb") as f:
            at = f.seek(0, os.SEEK_END)
            while at > 0:
                start = max(0, at - STEP)
                f.seek(start)
                found = f.read(at - start).rfind(b"\n")
                if found >= 0:
                    return start + found + 1
                at = start
        return 0

    def partitions(self, start: dict, end: dict) -> list[Range]:
        return [Range(p, start.get(p, 0), e) for p, e in sorted(end.items()) if e > start.get(p, 0)]

    def read(self, partition: Range):
        with open(partition.path, "rb") as f:
            f.seek(partition.start)
            at = partition.start
            while at < partition.end:
                raw = f.readline()
                if not raw.endswith(b"\n") or at + len(raw) > partition.end:
                    break
                yield partition.path, at, raw.decode("utf-8", "replace").rstrip("\r\n"), len(raw)
                at += len(raw)

    def commit(self, end: dict) -> None:
        pass


class TailSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "tail"

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> TailReader:
        return TailReader(self.options)


def tail(spark: SparkSession, directory: str, patterns: str):
    """A stream of the whole lines of the files that fit one of the patterns, split by commas."""
    spark.dataSource.register(TailSource)
    return spark.readStream.format("tail").option("patterns", patterns).load(directory)
