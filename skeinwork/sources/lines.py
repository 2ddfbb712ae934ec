"""Crawl logs and CDX indexes as DataFrames of lines and records."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import text as X
from ..schemas import CDX_RECORD, LOG_RECORD


def _missing(e: Exception) -> bool:
    return "PATH_NOT_FOUND" in str(e)


SCHEMA = "path string, offset long, line string, bytes long"
#: Parts of files whose starts are sent to all tasks at most; of more, the lines are brought to them by a join.
PARTS = 1_000_000


def _lines(batches):
    """Rows (path, part, size of the file, bytes of a line) in the order of the scan: each line with its place in its part."""
    names, kinds = ["path", "part", "inner", "line", "bytes"], [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64()]
    now, at = None, 0
    for batch in batches:
        path, part, raw = (batch.column(i).to_pylist() for i in range(3))
        rows = ([], [], [])
        for p, k, r in zip(path, part, raw):
            if (p, k) != now:
                now, at = (p, k), 0
            rows[0].append(at)
            rows[1].append(r.decode("utf-8", "replace").rstrip("\r"))
            rows[2].append(len(r) + 1)
            at += len(r) + 1
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip((path, part, *rows), kinds)], names=names)


def read_lines(spark: SparkSession, directory: str, pattern: str) -> DataFrame:
    """path, offset, line and bytes of every line of the matching files; no rows for a missing directory.

    Lines end with \\n, or \\r\\n, and nothing else, as for `read_text` and `tail`. Files are split like any text: each part of a
    file numbers its own lines, and the parts' sums, from a scan that reads no line into Python, tell where a part begins. So the
    offset is the byte of the file that a line begins at, and bytes add up to the file's size (of a packed file, to that of its
    content; a last line without an end counts one there).
    """
    from pyspark.errors import AnalysisException

    try:
        text = spark.read.option("pathGlobFilter", pattern).option("lineSep", "\n").text(directory)
    except AnalysisException as e:
        if _missing(e):
            return spark.createDataFrame([], SCHEMA)
        raise
    meta = F.col("_metadata")
    raw = text.select(meta.file_path.alias("path"), meta.file_block_start.alias("part"), F.col("value").cast("binary").alias("raw"), meta.file_size.alias("size"))
    sums = raw.groupBy("path", "part").agg(F.sum(F.octet_length("raw") + 1).alias("n"), F.first("size").alias("size"))
    start = F.sum("n").over(Window.partitionBy("path").orderBy("part").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")
    whole = F.sum("n").over(Window.partitionBy("path"))
    # One row a part. The last line of a file may have no end: then the lines' bytes exceed the file's by one.
    open_ = (whole == F.col("size") + 1) & ~F.lower("path").rlike(r"\.(gz|bz2|zst|lz4|deflate|snappy)$")
    parts = sums.select("path", "part", start.alias("start"), F.when(open_, F.col("size")).alias("ends"))
    parts = F.broadcast(parts) if parts.count() <= PARTS else parts
    held = raw.select("path", "part", "raw").mapInArrow(_lines, "path string, part long, inner long, line string, bytes long")
    placed = held.join(parts, ["path", "part"]).withColumn("offset", F.col("start") + F.col("inner"))
    own = F.col("bytes") - F.coalesce((F.col("offset") + F.col("bytes") > F.col("ends")).cast("long"), F.lit(0))
    return placed.select("path", "offset", "line", own.alias("bytes"))


def read_text(spark: SparkSession, directory: str, pattern: str) -> DataFrame:
    """path, line and bytes without positions: one scan, none of it in Python."""
    raw = spark.read.option("pathGlobFilter", pattern).option("lineSep", "\n").text(directory)
    return raw.select(F.col("_metadata.file_path").alias("path"), F.rtrim(F.col("value"), F.lit("\r")).alias("line"), (F.octet_length("value") + 1).cast("long").alias("bytes"))


def read_log_lines(spark: SparkSession, directory: str) -> DataFrame:
    return read_lines(spark, directory, "*.log")


def read_cdx_lines(spark: SparkSession, directory: str) -> DataFrame:
    return read_lines(spark, directory, "*.cdx*")


def log_records(lines: DataFrame, strict: bool = False) -> DataFrame:
    """The decoded lines of a crawl log; lines without a brace or of broken JSON are dropped."""
    held = lines.withColumn("payload", X.payload(F.col("line"))).where(F.col("payload").isNotNull())
    return X.decode(held, "payload", LOG_RECORD, "record", strict).drop("payload")


def cdx_records(lines: DataFrame, strict: bool = False) -> DataFrame:
    """The decoded lines of a CDXJ index; blank lines and lines of the old form without JSON are dropped. The number 0 is no status, the text "0" is one."""
    held = lines.where(X.strip(F.col("line")) != "").withColumn("payload", X.payload(F.col("line"))).where(F.col("payload").isNotNull())
    out = X.decode(held, "payload", CDX_RECORD, "record", strict)
    status = F.col("record.status")
    none = (status == "0") & F.col("payload").rlike(r'"status"\s*:\s*-?0\s*[,}]')
    return out.withColumn("record", F.col("record").withField("status", F.when(~none, status))).drop("payload")
