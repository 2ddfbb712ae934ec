"""Crawl statistics from log and CDX records.

Counters are one grouped aggregate each, combined on the map side. "Last" values go by position (file, byte offset), the order
in which lines arrived, and not by timestamp. All functions take an optional `by`: columns such as the snapshot that several
crawls are told apart by.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import collections as C
from ..functions import numbers as N
from ..functions import text as X
from ..functions import times as T


def volume(lines: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Lines and bytes, malformed lines and all."""
    return lines.groupBy(*by).agg(F.count("*").alias("lines"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"))


def counts(records: DataFrame, key: Column, name: str = "key", by: tuple[str, ...] = ()) -> DataFrame:
    """Records by a value; null and empty ones aren't counted."""
    return records.where(X.truthy(key.cast("string"))).groupBy(*by, key.alias(name)).agg(F.count("*").alias("n"))


def shares(counted: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Adds each row's part of its group's total. Without groups the total is one row beside all others (the counting's exchange is reused), so no task holds all keys."""
    if not by:
        total = F.broadcast(counted.agg(F.sum("n").alias("__total")).withColumn("__one", F.lit(1)))  # one row by construction
        held = counted.withColumn("__one", F.lit(1)).join(total, "__one")
        return held.withColumn("share", F.col("n") / F.greatest("__total", F.lit(1))).drop("__one", "__total")
    total = F.sum("n").over(Window.partitionBy(*by))
    return counted.withColumn("share", F.col("n") / F.greatest(total, F.lit(1)))


def context_counts(records: DataFrame, by=()) -> DataFrame:
    return counts(records, F.col("record.context"), "context", by)


def level_counts(records: DataFrame, by=()) -> DataFrame:
    return counts(records, F.col("record.logLevel"), "level", by)


def error_counts(records: DataFrame, by=()) -> DataFrame:
    """Error messages, a missing message being one of its own."""
    return records.where(F.col("record.logLevel") == "error").groupBy(*by, F.col("record.message").alias("message")).agg(F.count("*").alias("n"))


def request_types(records: DataFrame, by=()) -> DataFrame:
    r = F.col("record")
    start = (r.context == "worker") & (r.message == "Starting page")
    finish = (r.context == "pageStatus") & (r.message == "Page Finished")
    return records.groupBy(*by).agg(F.count_if(start).alias("page_start"), F.count_if(finish).alias("page_finished"))


def http_status_counts(records: DataFrame, by=()) -> DataFrame:
    return counts(records, F.col("record.status"), "http_status", by)


def mime_counts(records: DataFrame, by=()) -> DataFrame:
    return counts(records, F.col("record.mime"), "mime", by)


def extension_counts(records: DataFrame, by=()) -> DataFrame:
    return counts(records.where(X.truthy(F.col("record.url"))), X.url_extension(F.col("record.url")), "extension", by)


def last(value: Column, when: Column | None = None, *position: str) -> Column:
    """An aggregate: the value at the greatest position where it is there and the test holds."""
    test = value.isNotNull() if when is None else value.isNotNull() & when
    return F.max_by(F.when(test, value), F.when(test, F.struct(*position)))


def last_values(records: DataFrame, by=(), position: tuple[str, ...] = ("path", "offset")) -> DataFrame:
    """last_update, last_page, last_error and the carried counters of crawlStatus records."""
    r, status = F.col("record"), F.col("record.context") == "crawlStatus"
    pick = lambda v, t=None: last(v, t, *position)
    page = r.details.page
    return records.groupBy(*by).agg(
        pick(T.from_iso(r.timestamp)).alias("last_update"),
        pick(page, (r.context == "worker") & (r.message == "Starting page")).alias("last_page"),
        pick(r.message, r.logLevel == "error").alias("last_error"),
        *[F.coalesce(pick(r.details[k], status), F.lit(0)).alias(k) for k in ("crawled", "total", "pending", "failed")],
        F.coalesce(pick(r.details.limit.hit, status), F.lit(False)).alias("limit_hit"),
    )


def success(counted: DataFrame, by=()) -> DataFrame:
    """success_ratio and failure_ratio from counts by HTTP status; 0 and 1 where there are none."""
    good = F.coalesce(F.sum(F.when(F.col("http_status").startswith("2"), F.col("n"))), F.lit(0))
    share = N.ratio(good, F.coalesce(F.sum("n"), F.lit(0)))
    return counted.groupBy(*by).agg(share.alias("success_ratio"), (1 - share).alias("failure_ratio"))


def top(counted: DataFrame, k: int = 5, tie: str | None = None) -> DataFrame:
    """The k most frequent rows; ties by the given column (such as the first position)."""
    others = [c for c in counted.columns if c != "n"]
    return counted.orderBy(F.desc("n"), *([tie] if tie else others)).limit(k)


def as_map(counted: DataFrame, key: str, by=()) -> DataFrame:
    return counted.groupBy(*by).agg(C.count_map(key, "n").alias("counts"))


def beside(*rows: DataFrame) -> DataFrame:
    """One row of the columns of several frames of one row each."""
    out = rows[0].withColumn("__one", F.lit(1))
    for r in rows[1:]:
        out = out.join(F.broadcast(r.withColumn("__one", F.lit(1))), "__one")  # an aggregate without groups: one row by construction
    return out.drop("__one")


def report(log_lines: DataFrame, log: DataFrame, cdx_lines: DataFrame, cdx: DataFrame) -> DataFrame:
    """One row: the statistics document of a crawl, under the names that readers and writers use."""
    logs = volume(log_lines).select(F.col("lines").alias("log_lines"), F.col("bytes").alias("log_bytes"))
    indexes = volume(cdx_lines).select(F.col("lines").alias("cdx_lines"), F.col("bytes").alias("cdx_bytes"))
    status, mime, extension = http_status_counts(cdx), mime_counts(cdx), extension_counts(cdx)
    maps = [
        as_map(counted, key).withColumnRenamed("counts", name)
        for counted, key, name in (
            (status, "http_status", "by_http_status"), (mime, "mime", "by_mime"), (extension, "extension", "by_url_extension"), (context_counts(log), "context", "by_context"), (level_counts(log), "level", "by_level")
        )
    ]
    row = beside(last_values(log), logs, indexes, request_types(log), success(status), *maps)
    return row.select(
        "crawled", "total", "pending", "failed", "limit_hit", "log_lines", "cdx_lines", "log_bytes", "cdx_bytes",
        N.megabytes(F.col("log_bytes")).alias("log_mb_parsed"), N.megabytes(F.col("cdx_bytes")).alias("cdx_mb_parsed"),
        "by_http_status", "by_mime", "by_url_extension", "by_context", "by_level", F.struct("page_start", "page_finished").alias("by_request_type"),
        F.round("success_ratio", 3).alias("success_ratio"), "last_update", "last_page", "last_error",
    )


def stored_report(report_: DataFrame, derived: DataFrame, now: Column) -> DataFrame:
    """The document that is kept with a snapshot, as JSON; derived has one row of rates and flags."""
    both = beside(report_, derived)
    health = F.struct("log_stalled", "cdx_stalled", "js_heavy")
    # Readers ask for by_*; writers kept other names. Both are there.
    parts = [
        "crawled", "total", "pending", "failed", "limit_hit", "log_mb_parsed", "cdx_mb_parsed", F.col("by_http_status").alias("http_status"), F.col("by_mime").alias("mime_distribution"),
        F.col("by_url_extension").alias("url_extensions"), "by_http_status", "by_mime", "by_url_extension", "by_request_type", F.round("cdx_entries_per_sec", 2).alias("cdx_entries_per_sec"),
        F.round("cdx_bytes_per_sec", 1).alias("cdx_bytes_per_sec"), "success_ratio", health.alias("health"), T.to_iso(now).alias("updated_at"), "last_page",
    ]
    return both.select(F.to_json(F.struct(*parts)).alias("crawl_stats"))
