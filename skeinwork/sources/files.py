"""Listings and digests of archive files."""

from __future__ import annotations

import hashlib
import os
import shutil
from datetime import datetime, timezone

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..functions import text as X

CHUNK = 1 << 20


def listing(spark: SparkSession, directory: str, pattern: str) -> DataFrame:
    """filename, path, size_bytes, created_at of the matching files; contents aren't read. No rows for a missing directory, nor for files of no bytes."""
    from pyspark.errors import AnalysisException

    try:
        files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(directory)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e):
            return spark.createDataFrame([], "filename string, path string, size_bytes long, created_at timestamp")
        raise
    return files.select(X.basename(F.col("path")).alias("filename"), "path", F.col("length").alias("size_bytes"), F.col("modificationTime").alias("created_at"))


def warcs(spark: SparkSession, directory: str) -> DataFrame:
    return listing(spark, directory, "*.{warc,warc.gz}")


def indexes(spark: SparkSession, directory: str) -> DataFrame:
    return listing(spark, directory, "*.{cdx,cdxj}")


def digests(spark: SparkSession, directory: str, pattern: str) -> DataFrame:
    """path and sha256 of files that fit into memory."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(directory)
    return files.select("path", F.sha2("content", 256).alias("sha256"))


@F.pandas_udf(StringType())
def chunked_sha256(path: pd.Series) -> pd.Series:
    """sha256 of files of any size, a chunk at a time, by paths that the workers can open."""
    def one(p):
        h = hashlib.sha256()
        with open(p.removeprefix("file:"), "rb") as f:
            while part := f.read(CHUNK):
                h.update(part)
        return h.hexdigest()

    return path.map(one)


COPIED = "filename string, path string, size_bytes long, sha256 string, created_at timestamp"


def transferred(listed: DataFrame, target: str, remove: bool = False) -> DataFrame:
    """Copies listed files (filename, path) into the folder `target`, on the workers: a row for each with its new path, size, digest and time.

    A copy is written beside its place, read back, compared and then renamed, so that doing it again does no harm; with `remove`
    the original goes only after that, and one that has gone is looked for at its target. Paths are ones that the workers can open.
    """
    folder = target.removeprefix("file://").removeprefix("file:")

    def digest(path: str) -> str:
        h = hashlib.sha256()
        with open(path, "rb") as f:
            while part := f.read(CHUNK):
                h.update(part)
        return h.hexdigest()

    def each(batches):
        os.makedirs(folder, exist_ok=True)
        for batch in batches:
            rows = []
            for name, path in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                source, place = path.removeprefix("file://").removeprefix("file:"), os.path.join(folder, name)
                if os.path.exists(source) and os.path.abspath(source) != os.path.abspath(place):
                    own = digest(source)
                    shutil.copy2(source, part := f"{place}.{os.getpid()}.part")
                    if digest(part) != own:
                        raise OSError(f"the copy of {source} differs from it")
                    os.replace(part, place)
                    if remove:
                        os.remove(source)
                else:
                    own = digest(place)
                stat = os.stat(place)
                rows.append((name, place, stat.st_size, own, datetime.fromtimestamp(stat.st_mtime, timezone.utc)))
            if rows:
                kinds = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.timestamp("us", "UTC")]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=[x.split()[0] for x in COPIED.split(", ")])

    return listed.select("filename", "path").mapInArrow(each, COPIED)


def removed(listed: DataFrame) -> DataFrame:
    """Deletes listed files, on the workers: path and whether it was there."""
    def each(batches):
        for batch in batches:
            paths, there = batch.column(0).to_pylist(), []
            for p in paths:
                try:
                    os.remove(p.removeprefix("file://").removeprefix("file:"))
                    there.append(True)
                except FileNotFoundError:
                    there.append(False)
            yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(there, pa.bool_())], names=["path", "removed"])

    return listed.select("path").mapInArrow(each, "path string, removed boolean")


def table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    """A stored table; filters and columns reach the scan."""
    return spark.read.parquet(f"{directory}/{name}.parquet")


def jdbc_table(spark: SparkSession, url: str, name: str, key: str | None = None, low: int = 0, high: int = 0, partitions: int = 8, **options) -> DataFrame:
    """A table of a relational database, read in ranges of its key where that is given."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", name).option("fetchsize", "10000").options(**options)
    if key:
        reader = reader.option("partitionColumn", key).option("lowerBound", str(low)).option("upperBound", str(high)).option("numPartitions", str(partitions))
    return reader.load()
