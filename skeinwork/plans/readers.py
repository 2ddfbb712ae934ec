"""Queries that read files through the engine's own readers: the driver's tables are written as logs, indexes, archives and task pages into the shared folder, and read back.

The SQL says what must come out of the files, from the tables alone.
"""

from __future__ import annotations

import json
import os

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions import times as T
from ..operators import catalog as K
from ..operators import container as B
from ..operators import crawl_stats as S
from ..operators import lookup as L
from ..operators import queues as U
from ..operators import serialize as Z
from ..operators import sinks
from ..operators import tasks as Q
from ..session import shared_folder
from ..sources import files, lines, requests, warc
from ..sources import jobs as registries
from ..sources.pages import task_pages
from ..streaming import monitor
from . import jobs
from . import standins as V
from .workload import _ACTION_LIST, _tasks, query

FILES = 4
#: Lines of a text file at most: larger tables make more files, not larger sorts.
LINES = 250_000


def _open_folder(spark: SparkSession) -> str:
    """A fresh folder in the shared place that workers can open as files: what WARC records, saved pages and copies need."""
    path = shared_folder(spark)
    plain = path.removeprefix("file://").removeprefix("file:")
    if "://" in plain:
        raise ValueError(f"{path} isn't mounted: files of this kind are read by path")
    os.makedirs(plain, exist_ok=True)
    return plain


def _text_files(df: DataFrame, column: str, order: str) -> str:
    """A folder of FILES text files of a column, or as many as LINES asks for, in order over their names."""
    df.repartitionByRange(max(FILES, -(-df.count() // LINES)), order).sortWithinPartitions(order).select(column).write.text(path := shared_folder(df.sparkSession))
    return path


def _log_files(spark: SparkSession, d: str) -> str:
    return _text_files(V.log_lines(spark, d), "line", "offset")


#: pages as an index: page 0 mod 5 has the number 0 for a status, 1 mod 5 the text "0"; 2 mod 7 is a blank line, 3 mod 7 one of the old form.
CDX_SQL = """
  with i as (select page_id, url, case when page_id % 5 = 0 then null when page_id % 5 = 1 then '0' when page_id % 5 = 2 then '404' else '200' end as status,
    case when page_id % 3 = 0 then 'image/png' when page_id % 3 = 1 then 'text/html' else '' end as mime from pages where page_id % 7 not in (2, 3))"""


def _index_files(spark: SparkSession, d: str) -> str:
    p = V.table(spark, d, "pages")
    k = F.col("page_id")
    status = F.when(k % 5 == 0, "0").when(k % 5 == 1, '"0"').when(k % 5 == 2, '"404"').otherwise("200")
    mime = F.when(k % 3 == 0, "image/png").when(k % 3 == 1, "text/html").otherwise("")
    document = F.concat(F.lit('{"url":'), F.to_json(F.array("url")).substr(F.lit(2), F.length(F.to_json(F.array("url"))) - 2), F.lit(',"status": '), status, F.lit(',"mime":"'), mime, F.lit('"}'))
    line = F.when(k % 7 == 2, " ").when(k % 7 == 3, "com,x)/ 2024 old form 200").otherwise(F.concat(F.lit("com,x)/ 20240101000000 "), document))
    return _text_files(p.select("page_id", line.alias("line")), "line", "page_id")


# Log and index files


@query(f"select count(*) as lines, cast(sum(strlen(line) + 1) as bigint) as bytes, cast(sum(strlen(line) + 1) as bigint) as ends from ({V.LINE_SQL})")
def log_file_positions(spark, d):
    """Lines and bytes of the files, and the sum of where each file's last line ends."""
    read = lines.read_lines(spark, _log_files(spark, d), "*.txt")
    each = read.groupBy("path").agg(F.count("*").alias("lines"), F.sum("bytes").alias("bytes"), F.max(F.col("offset") + F.col("bytes")).alias("ends"))
    return each.agg(*[F.sum(c).alias(c) for c in ("lines", "bytes", "ends")])


@query(f"select count(*) as lines, cast(sum(strlen(line) + 1) as bigint) as bytes, count(distinct line) as different, min(line) as first, max(line) as last from ({V.LINE_SQL})")
def log_file_text(spark, d):
    read = lines.read_text(spark, _log_files(spark, d), "*.txt")
    return S.beside(S.volume(read), read.agg(F.count_distinct("line").alias("different"), F.min("line").alias("first"), F.max("line").alias("last")))


@query(f"select context, lvl as level, count(*) as n from ({V.LOG_SQL}) group by 1, 2")
def log_file_records(spark, d):
    r = lines.log_records(lines.read_lines(spark, _log_files(spark, d), "*.txt"))
    return r.groupBy(F.col("record.context").alias("context"), F.col("record.logLevel").alias("level")).agg(F.count("*").alias("n"))


@query(CDX_SQL + """ select 'status' as kind, status as key, count(*) as n from i where status is not null group by 2 union all select 'mime', mime, count(*) from i where mime <> '' group by 2
  union all select 'lines', '', count(*) from pages""")
def index_file_counts(spark, d):
    read = lines.read_lines(spark, _index_files(spark, d), "*.txt")
    r = lines.cdx_records(read)
    row = lambda df, kind, key: df.select(F.lit(kind).alias("kind"), key.alias("key"), "n")
    return row(S.http_status_counts(r), "status", F.col("http_status")).union(row(S.mime_counts(r), "mime", F.col("mime"))).union(row(S.volume(read).withColumnRenamed("lines", "n"), "lines", F.lit("")))


REPORT_SQL = CDX_SQL + f""", e as ({V.LOG_SQL}), w as ({V.LINE_SQL}) select
  (select k from e where context = 'crawlStatus' order by event_id desc limit 1) as crawled, (select k + job from e where context = 'crawlStatus' order by event_id desc limit 1) as total,
  (select count(*) from e) as log_lines, (select cast(sum(strlen(line) + 1) as bigint) from w) as log_bytes, (select count(*) from pages) as cdx_lines,
  (select round(count(*) filter (where status like '2%') / greatest(count(status), 1), 3) from i) as success_ratio,
  (select count(*) from e where context = 'worker' and message = 'Starting page') as page_start, (select count(*) from e where context = 'pageStatus') as page_finished,
  (select 'http://p/' || event_id from e where context = 'worker' order by event_id desc limit 1) as last_page, (select message from e where lvl = 'error' order by event_id desc limit 1) as last_error,
  (select count(*) from i where status = '404') as not_found, (select count(*) from e where lvl = 'error') as errors"""


def _report(spark, d):
    log, index = lines.read_lines(spark, _log_files(spark, d), "*.txt"), lines.read_lines(spark, _index_files(spark, d), "*.txt")
    return S.report(log, lines.log_records(log), index, lines.cdx_records(index))


@query(REPORT_SQL)
def crawl_report(spark, d):
    """The whole report of a crawl from its files."""
    return _report(spark, d).select(
        "crawled", "total", "log_lines", "log_bytes", "cdx_lines", "success_ratio", F.col("by_request_type.page_start").alias("page_start"), F.col("by_request_type.page_finished").alias("page_finished"),
        "last_page", "last_error", F.col("by_http_status")["404"].alias("not_found"), F.col("by_level")["error"].alias("errors"),
    )


@query(f"""with r as ({REPORT_SQL}) select crawled, success_ratio, round(log_bytes / 1e6, 2) as log_mb, not_found, not_found as not_found_again, true as log_stalled, '2024-01-01T00:00:00Z' as updated_at, last_page from r""")
def stored_crawl_report(spark, d):
    """The document kept with a snapshot, read back from its JSON."""
    flags = [F.lit(v).alias(c) for c, v in (("log_stalled", True), ("cdx_stalled", False), ("js_heavy", False))]
    derived = spark.range(1).select(F.lit(1.25).alias("cdx_entries_per_sec"), F.lit(2.0).alias("cdx_bytes_per_sec"), *flags)
    stored = S.stored_report(_report(spark, d), derived, F.lit("2024-01-01").cast("timestamp"))
    schema = "crawled bigint, success_ratio double, log_mb_parsed double, http_status map<string,bigint>, by_http_status map<string,bigint>, health struct<log_stalled:boolean>, updated_at string, last_page string"
    s = X.once(stored, "s", F.from_json("crawl_stats", schema)).select("s.*")
    return s.select("crawled", "success_ratio", F.col("log_mb_parsed").alias("log_mb"), F.col("http_status")["404"].alias("not_found"), F.col("by_http_status")["404"].alias("not_found_again"), F.col("health.log_stalled").alias("log_stalled"), "updated_at", "last_page")


# The live monitor


def _followed(spark: SparkSession, df: DataFrame, order: list[str], mode: str = "update") -> DataFrame:
    """What a stream puts out until all that is there is read: the last row by the given order of each of its keys."""
    out, checkpoint = shared_folder(spark), shared_folder(spark)

    def sink(batch: DataFrame, number: int) -> None:
        batch.withColumn("__batch", F.lit(number)).write.mode("overwrite").parquet(f"{out}/batch={number}")

    before = spark.conf.get(monitor.PROVIDER, None)
    monitor.state_store(spark)
    try:
        monitor.start(df, sink, checkpoint, None, mode).awaitTermination()
    finally:
        spark.conf.unset(monitor.PROVIDER) if before is None else spark.conf.set(monitor.PROVIDER, before)
    schema = df.withColumn("__batch", F.lit(0)).schema
    rows = spark.read.schema(schema).parquet(out) if sinks.exists(spark, out) else spark.createDataFrame([], schema)  # an empty source has no batch
    return K.newest(rows, order, F.desc("__batch")).drop("__batch") if order else rows.drop("__batch")


def _crawl_stream(spark, d):
    log = monitor.tail(spark, _log_files(spark, d), "*.txt").withColumn("src", F.lit("log"))
    index = monitor.tail(spark, _index_files(spark, d), "*.txt").withColumn("src", F.lit("cdx"))
    return log.unionByName(index).withColumn("snapshot_id", F.lit(7).cast("long"))


@query(f"""with r as ({REPORT_SQL}) select 7::bigint as snapshot_id, log_lines, log_bytes, cdx_lines, crawled, total, last_page,
  (select strftime(max_by(ts, event_id), '%Y-%m-%dT%H:%M:%SZ') from events) as last_update from r""")
def monitor_polls(spark, d):
    """Both streams of a crawl through the stateful monitor, from its files to the last poll."""
    out = _followed(spark, monitor.polls(_crawl_stream(spark, d)), ["snapshot_id"])
    return out.select("snapshot_id", "log_lines", "log_bytes", "cdx_lines", "crawled", "total", "last_page", T.to_iso(F.col("last_update")).alias("last_update"))


@query(f"select context, count(*) as n from ({V.LOG_SQL}) group by 1")
def monitor_contexts(spark, d):
    return _followed(spark, monitor.context_counts(_crawl_stream(spark, d)), ["context"]).select("context", "n")


@query(f"select 'log' as src, count(*) as lines, cast(sum(strlen(line) + 1) as bigint) as bytes from ({V.LINE_SQL}) group by 1")
def monitor_volumes(spark, d):
    return _followed(spark, monitor.volumes(_crawl_stream(spark, d)), ["src"]).where("src = 'log'").select("src", "lines", "bytes")


# Archives


def _warc_files(spark: SparkSession, d: str) -> str:
    """pages as WARC files, one a task, every other one packed: a response of each page and a request record."""
    folder = _open_folder(spark)

    def each(batches):
        import gzip
        import uuid

        name = uuid.uuid4().hex
        packed = int(name, 16) % 2
        with open(f"{folder}/{name}.warc" + ".gz" * packed, "wb") as f:
            for batch in batches:
                for page, url, html in zip(*(batch.column(i).to_pylist() for i in range(3))):
                    reply = f"HTTP/1.1 {404 if page % 4 == 0 else 200} X\r\nContent-Type: {'text/html' if page % 3 else 'text/plain'}; charset=utf-8\r\n\r\n".encode() + (html or "").encode("utf-8", "replace")
                    for kind, body in (("response", reply), ("request", b"GET / HTTP/1.1\r\n\r\n")):
                        head = f"WARC/1.0\r\nWARC-Type: {kind}\r\nWARC-Target-URI: {url}\r\nWARC-Date: 2024-01-02T03:04:05Z\r\nContent-Length: {len(body)}\r\n\r\n".encode()
                        record = head + body + b"\r\n\r\n"
                        f.write(gzip.compress(record, 1) if packed else record)
        yield pa.RecordBatch.from_arrays([pa.array([name])], names=["name"])

    V.table(spark, d, "pages").select("page_id", "url", "html").repartition(FILES, "page_id").mapInArrow(each, "name string").collect()  # FILES names
    return folder


@query("select 'response' as type, case when page_id % 4 = 0 then '404' else '200' end as status, case when page_id % 3 = 0 then 'text/plain' else 'text/html' end as mime, count(*) as n, count(distinct url) as urls from pages group by 1, 2, 3 union all select 'request', null, null, count(*), count(distinct url) from pages")
def warc_file_records(spark, d):
    r = warc.warc_records(spark, _warc_files(spark, d))
    mime = F.when(F.col("type") == "response", F.col("mime"))
    return r.groupBy("type", "status", mime.alias("mime")).agg(F.count("*").alias("n"), F.count_distinct("url").alias("urls"))


@query("select regexp_extract(url, '^[a-z]+://([^/:?#]*)', 1) as host, count(*) as n, count(*) filter (where page_id % 4 = 0) as missing from pages group by 1")
def warc_to_index(spark, d):
    """Archive files to index lines to records."""
    made = warc.cdx_lines(warc.warc_records(spark, _warc_files(spark, d)))
    r = lines.cdx_records(made).select("record.*")
    return r.groupBy(F.regexp_extract("url", "^[a-z]+://([^/:?#]*)", 1).alias("host")).agg(F.count("*").alias("n"), F.count_if(F.col("status") == "404").alias("missing"))


def _named_files(spark: SparkSession, d: str) -> str:
    """A file for every nation, with its name as content."""
    folder = _open_folder(spark)

    def each(batches):
        for batch in batches:
            for key, name in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                with open(f"{folder}/{key}.warc", "w") as f:
                    f.write(name)
            yield batch

    V.table(spark, d, "nation").select("n_nationkey", "n_name").mapInArrow(each, "n_nationkey int, n_name string").write.format("noop").mode("overwrite").save()
    return folder


@query("select n_nationkey || '.warc' as filename, strlen(n_name) as size_bytes, sha256(n_name) as sha256 from nation")
def archive_copies(spark, d):
    """Files of a crawl moved to the archive tier and registered there by digest."""
    target = _open_folder(spark)
    catalog = spark.createDataFrame([], "snapshot_id long, filename string, path string, size_bytes long, sha256 string, created_at timestamp, is_production boolean")
    out = jobs.archive(spark, catalog, _named_files(spark, d), 9, target)["warc"]
    here = F.contains("path", F.lit(target.rsplit("/", 1)[-1]))
    return out.where(here).select("filename", "size_bytes", "sha256")


@query("select n_nationkey || '.warc' as filename, sha256(n_name) as sha256, true as agrees from nation")
def file_digests(spark, d):
    folder = _named_files(spark, d)
    held = files.warcs(spark, folder).join(files.digests(spark, folder, "*.warc"), "path")
    return held.select("filename", "sha256", (files.chunked_sha256("path") == F.col("sha256")).alias("agrees"))


# Tasks

PAGE = 1000


def _saved_pages(spark: SparkSession, d: str) -> tuple[str, int]:
    """The tasks as pages of an API, each a file, and how far they go."""
    folder = _open_folder(spark)

    def each(batches):
        """Rows come in order of their page, and all of a page in one task; one page is held at a time."""
        page, held = None, []
        for batch in batches:
            for number, item in zip(batch.column("page").to_pylist(), batch.column("item").to_pylist()):
                if number != page and held:
                    save(page, held)
                    held = []
                page = number
                held.append(item)
        if held:
            save(page, held)
        yield from ()

    def save(page, held):
        with open(f"{folder}/{page * PAGE}.json", "w") as f:
            f.write('{"runAt": "2024-01-01T00:00:00Z", "items": [' + ", ".join(held) + "]}")

    t = _tasks(spark, d).select("id", F.struct("uid", "action", "status", "priority", T.to_iso(F.col("updateTime")).alias("updateTime"), "taskParameters").alias("task"))
    # Where ids have gaps, pages are short or absent.
    low, high = t.agg(F.min("id"), F.max("id")).first()
    items = t.select("id", F.floor((F.col("id") - (low or 0)) / PAGE).cast("long").alias("page"), F.to_json("task").alias("item"))
    items.repartition("page").sortWithinPartitions("page", "id").select("page", "item").mapInArrow(each, "id long").write.format("noop").mode("overwrite").save()
    return folder, 0 if low is None else high - low + 1


TASKS_SQL = f"""
  with task as (select 't' || o_orderkey as uid, {_ACTION_LIST}[cast(o_orderkey % 20 + 1 as int)] as action, case o_orderstatus when 'F' then 'success' when 'O' then 'running' else 'failed' end as status, o_orderkey as id,
    'snap-' || ((o_orderkey * 3) % 20000) as payload_uid from orders)"""


@query(TASKS_SQL + " select action, status, count(*) as n, true as timed from task group by 1, 2")
def task_page_reader(spark, d):
    path, n = _saved_pages(spark, d)
    t = Q.imported(task_pages(spark, path, limit=PAGE, total=str(n)))
    return t.groupBy("action", "status").agg(F.count("*").alias("n"), F.bool_and(F.col("updateTime").isNotNull() & F.col("runAt").isNotNull()).alias("timed"))


@query(TASKS_SQL + " select count(*) filter (where id % 3 <> 0) as processed, count(*) filter (where id % 3 <> 0 and action <> 'no_such_action') as dispatched, count(*) filter (where id % 3 <> 0 and action = 'no_such_action') as failed from task")
def import_job(spark, d):
    """The pages imported beside a third that is stored already: the rest is new and dispatched."""
    path, n = _saved_pages(spark, d)
    stored = _tasks(spark, d).where("id % 3 = 0").select("uid")
    snapshots = V.snapshots(spark, d).select("uid", "id")
    out = jobs.import_tasks(task_pages(spark, path, limit=PAGE, total=str(n)), stored, snapshots, F.lit("2024-06-01").cast("timestamp"), F.lit(False))
    return out["counts"]


@query(TASKS_SQL + " select status, count(*) as n from task where id % 3 = 0 group by 1")
def sync_job(spark, d):
    t = _tasks(spark, d).withColumn("taskResponse", F.lit("{}"))
    return jobs.sync_tasks(t.select("uid", F.lit("scheduled").alias("status")), t.where("id % 3 = 0")).groupBy("status").agg(F.count("*").alias("n"))


@query(TASKS_SQL + " select count(*) as found, false as dry_run, count(*) filter (where action = 'no_such_action') as unknown from task where status = 'failed'")
def requeue_job(spark, d):
    out = jobs.requeue_failed(_tasks(spark, d))
    unknown = out["requeue"].agg(F.count_if((F.col("dispatch_status") == "failed") & (F.col("status") == "scheduled")).alias("unknown"))
    return S.beside(out["counts"], unknown)


@query("select (select count(*) from orders) as checked, (select count(*) from orders where not exists (select 1 from lineitem where l_orderkey = o_orderkey)) as removed, (select count(*) from orders where exists (select 1 from lineitem where l_orderkey = o_orderkey)) as remaining, (select count(*) from lineitem) as files")
def cleanup_job(spark, d):
    s, w = V.snapshots(spark, d), V.warcs(spark, d)
    directories = w.select(F.concat(F.lit("c"), F.col("snapshot_id")).alias("collection")).distinct()
    none = spark.createDataFrame([], "uid string, snapshot_id long")
    out = jobs.cleanup_orphans(s, directories, w, none, _tasks(spark, d))
    return S.beside(out["counts"], out["snapshot"].agg(F.count("*").alias("remaining")), out["warc"].agg(F.count("*").alias("files")))


@query("""select (select count(*) from orders join customer on c_custkey = o_custkey where c_acctbal < 0) as public, (select count(*) from lineitem) as indexed,
  (select count(*) from lineitem where l_returnflag = 'A' and not exists (select 1 from orders join customer on c_custkey = o_custkey where c_acctbal < 0 and o_orderkey = l_orderkey)) as production""")
def publish_job(spark, d):
    """All snapshots of some websites published, with the lines of an index, and taken back."""
    s = V.snapshots(spark, d).withColumn("publication_status", F.lit(None).cast("string"))
    w, sites = V.warcs(spark, d), V.websites(spark, d).where("isDeleted")
    own = w.select(F.concat_ws("/", "snapshot_id", "filename", "part", "supplier", "size_bytes").alias("key"), F.monotonically_increasing_id().cast("string").alias("line"))
    index = own.limit(0)
    on = jobs.publish_website(s, sites, index, own)
    off = jobs.unpublish_website(on["snapshot"], sites, on["index"], own, w)
    return S.beside(
        on["snapshot"].agg(F.count_if(F.col("publication_status") == "public").alias("public")), on["index"].agg(F.count("*").alias("indexed")), off["warc"].agg(F.count_if("is_production").alias("production"))
    )


@query(TASKS_SQL + """ select case when id % 2 = 1 then status when id % 4 = 0 then 'success' else 'failed' end as status, count(*) as n, count(*) filter (where id % 2 = 0) as replied, count(*) filter (where id % 4 = 2) as told from task group by 1""")
def task_lifecycle(spark, d):
    """Half of the tasks have ended, every second of these with an error."""
    t = _tasks(spark, d).withColumns({"taskResponse": F.lit(None).cast("string"), "resultDescription": F.lit(None).cast("string")})
    ended = t.where("id % 2 = 0").select("uid", F.when(F.col("id") % 4 == 2, "broke").alias("error"))
    out = Q.lifecycle(t, ended, F.lit("2024-01-01").cast("timestamp"))
    reply = F.get_json_object("taskResponse", "$.updatedAt") == "2024-01-01T00:00:00Z"
    return out.groupBy("status").agg(F.count("*").alias("n"), F.count_if(reply).alias("replied"), F.count_if(F.col("resultDescription") == "broke").alias("told"))


# Views and documents


def _with_stats(spark, d):
    s = V.snapshots(spark, d)
    k = F.col("id")
    stats = F.concat(F.lit('{"crawled":'), k, F.lit(',"pending":1,"success_ratio":0.5,"health":{"log_stalled":'), F.when(k % 3 == 0, "true").otherwise("false"), F.lit(',"cdx_stalled":false,"js_heavy":true},"http_status":{"404":'), k % 5, F.lit(',"200":'), k % 7, F.lit("}}"))
    return s.withColumn("crawl_stats", F.when(k % 2 == 0, stats))


@query("""select o_orderkey as id, c_name as website, case when o_orderkey % 2 = 0 then o_orderkey end as crawled, case when o_orderkey % 2 = 1 then '' when o_orderkey % 3 = 0 then 'log_stalled,js_heavy' else 'js_heavy' end as badges,
  case when o_orderkey % 2 = 0 then '200,404' end as labels, case when o_orderkey % 2 = 0 then (o_orderkey % 7) || ',' || (o_orderkey % 5) end as values, case when o_orderkey % 2 = 1 then 'No crawl statistics yet' end as note from orders left join customer on c_custkey = o_custkey""")
def dashboard_cards(spark, d):
    out = L.cards(_with_stats(spark, d), V.websites(spark, d))
    joined = lambda c: F.when(F.col(c).isNotNull(), F.array_join(F.col(c).cast("array<string>"), ","))
    return out.select("id", "website", "crawled", F.array_join("badges", ",").alias("badges"), joined("status_chart.labels").alias("labels"), joined("status_chart.values").alias("values"), "note")


@query("select o_orderkey as id, '404' as key, o_orderkey % 5 as n from orders where o_orderkey % 2 = 0 union all select o_orderkey, '200', o_orderkey % 7 from orders where o_orderkey % 2 = 0")
def statistics_rows(spark, d):
    return L.count_rows(_with_stats(spark, d), "http_status")


@query("""select 'snap-' || o_orderkey as snapshot, case when o_orderkey % 2 = 0 then 'w' || o_custkey end as website, case when o_orderkey % 2 = 0 then o_custkey end as website_id, case when o_orderkey % 4 = 0 then o_custkey end as config_id, case when o_orderkey % 4 = 0 then 'e' || o_custkey end as engine from orders""")
def task_parameter_doc(spark, d):
    """The parameters of a task: every second snapshot has its website, every second of these its configuration."""
    s = V.snapshots(spark, d)
    k, site = F.col("id"), F.when(F.col("id") % 2 == 0, F.col("id"))
    docs = s.select(k.alias("snapshot_id"), site.alias("website_id"), F.struct("uid").alias("document"))
    sites = s.where("id % 2 = 0").select(k.alias("website_id"), F.when(k % 4 == 0, F.col("website_id")).alias("website_crawl_parameters_id"), F.struct(F.concat(F.lit("w"), F.col("website_id")).alias("name"), F.col("website_id").alias("site")).alias("document"))
    configs = s.where("id % 4 = 0").select("website_id").distinct().select(F.col("website_id").alias("crawl_config_id"), F.concat(F.lit('{"crawlEngine":"e'), F.col("website_id"), F.lit('"}')).alias("document"))
    out = Z.task_parameters(docs, sites, configs)
    p = X.once(out, "p", F.from_json("parameters", "snapshot struct<uid:string>, website struct<name:string,site:bigint>, websiteId bigint, crawlConfigId bigint, crawlConfig struct<crawlEngine:string>"))
    return p.select(F.col("p.snapshot.uid").alias("snapshot"), F.col("p.website.name").alias("website"), F.col("p.website.site").alias("website_id"), F.col("p.crawlConfigId").alias("config_id"), F.col("p.crawlConfig.crawlEngine").alias("engine"))


@query("select o_orderkey as id, case o_orderstatus when 'F' then 'completed' when 'O' then 'crawling' else 'pending' end as status, 'http://site' || o_custkey || '.example/' as website, '2024-01-01T00:00:00Z' as updated from orders")
def container_with_snapshot(spark, d):
    s = V.snapshots(spark, d)
    out = B.with_snapshot(s.select(F.col("id").alias("snapshot_id")), s, V.websites(spark, d), F.lit("2024-01-01").cast("timestamp"))
    return out.select("snapshot.id", "snapshot.status", "snapshot.website", F.col("snapshot.updated_at").alias("updated"))


@query("select o_orderkey as id, 'up' as status, case when o_orderkey % 2 = 0 then o_orderkey || case when o_orderkey = 1 then ' byte' else ' bytes' end end as received from orders where o_orderkey < 1024 union all select o_orderkey, 'up', case when o_orderkey % 2 = 0 then case when o_orderkey >= 1048576 then printf('%.1f MB', o_orderkey / 1048576) else printf('%.1f KB', o_orderkey / 1024) end end from orders where o_orderkey >= 1024")
def detail_panel(spark, d):
    k = F.col("id")
    doc = F.when(k % 2 == 0, F.concat(F.lit('{"io":{"network":{"rx_bytes":'), k, F.lit("}}}")))
    s = V.snapshots(spark, d).select("id", F.lit("up").alias("status"), F.lit(0.5).alias("progress"), doc.alias("container_stats"), F.lit(None).cast("string").alias("process_stats"))
    schema = "state struct<status:string>, resources struct<cpu_percent:double,memory:struct<usage_bytes:bigint>>, io struct<network:struct<rx_bytes:bigint,tx_bytes:bigint>,block:struct<read_bytes:bigint,write_bytes:bigint>>"
    return L.detail(s, schema).select("id", "status", "received")


@query("select c_custkey as id, strip as name, strlen(c_name) as bytes from (select c_custkey, c_name, c_name as strip from customer)")
def stripped_names(spark, d):
    c = V.table(spark, d, "customer")
    padded = F.concat(F.lit(" \t"), F.col("c_name"), F.lit("\n "))
    return c.select(F.col("c_custkey").alias("id"), X.strip(padded).alias("name"), X.byte_length(F.col("c_name")).cast("long").alias("bytes"))


@query("select c_custkey as id, '{\"id\":' || c_custkey || ',\"name\":\"' || c_name || '\"}' as json from customer")
def json_rows(spark, d):
    """Rows as JSON, written as lines and read again."""
    c = V.table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    sinks.write_json(c, path := shared_folder(spark))
    read = spark.read.text(path).withColumnRenamed("value", "json")
    return read.select(F.get_json_object("json", "$.id").cast("long").alias("id"), "json")


@query("select p_partkey as id, 'name: \"' || p_name || '\"' || chr(10) || 'seeds:' || chr(10) || '- \"' || p_brand || '\"' || chr(10) || 'size: ' || p_size || chr(10) as yaml from part")
def yaml_documents(spark, d):
    p = V.table(spark, d, "part")
    document = F.to_json(F.struct(F.col("p_name").alias("name"), F.array("p_brand").alias("seeds"), F.col("p_size").alias("size")))
    return p.select(F.col("p_partkey").alias("id"), sinks.yaml_text(document).alias("yaml"))


@query("select s_suppkey as id, 200 as http_status, true as success, '' as error_message from supplier where s_suppkey % 3 = 0 union all select s_suppkey, 500, false, '' from supplier where s_suppkey % 3 = 1 union all select s_suppkey, null, false, 'no route' from supplier where s_suppkey % 3 = 2")
def delivery_audit(spark, d):
    """A reply for every supplier: a third succeeds, a third is refused, a third never arrives. Sent twice with the batch's number, recorded once."""
    def send(method: str, url: str, payload: str) -> tuple[int, str]:
        k = json.loads(payload)["k"]
        if k % 3 == 2:
            raise OSError("no route")
        return (200, "ok") if k % 3 == 0 else (500, "no")

    s = V.table(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), F.to_json(F.struct(F.col("s_suppkey").alias("k"))).alias("payload"))
    write = sinks.deliver_batches(path := shared_folder(spark), "id", F.lit("http://x/"), "PUT", send)
    write(s, 0)
    write(s, 0)
    return spark.read.parquet(f"{path}/batch=0").select("id", "http_status", "success", "error_message")


@query("select o_custkey as id, max(o_orderkey) as last from orders group by 1")
def versioned_upserts(spark, d):
    """The newest snapshot of each website in a table that keeps the last write: in three steps, the last one repeated."""
    table = sinks.VersionedTable(spark, shared_folder(spark))
    write = sinks.latest_wins(table, ["id"])
    s = V.snapshots(spark, d).select(F.col("website_id").alias("id"), F.col("id").alias("last"))
    bounds = s.agg(F.expr("percentile_approx(last, array(0.33, 0.66))").alias("p")).first()["p"] or [0, 0]
    for k, test in enumerate((F.col("last") <= bounds[0], (F.col("last") > bounds[0]) & (F.col("last") <= bounds[1]), F.col("last") > bounds[1], F.col("last") > bounds[1])):
        write(s.where(test).groupBy("id").agg(F.max("last").alias("last")), k)
    return table.read()


# Requests, queues, flags


@query("select c_custkey as id, case when c_custkey % 3 = 0 then c_mktsegment || ' & co' when c_custkey % 3 = 1 then '' end as tag, case when c_custkey % 2 = 0 then c_custkey end as body from customer")
def request_inputs(spark, d):
    c = V.table(spark, d, "customer")
    k = F.col("c_custkey")
    text = F.concat(F.lit("?page=2&tag="), F.replace(F.url_encode(F.concat("c_mktsegment", F.lit(" & co"))), F.lit("%20"), F.lit("+")), F.lit("&x=1"))
    sent = c.select(k.alias("id"), F.when(k % 3 == 0, text).when(k % 3 == 1, "tag=").otherwise("?tags=no").alias("query"), F.when(k % 2 == 0, F.concat(F.lit('{"id":'), k, F.lit("}"))).otherwise('{"id":').alias("body"))
    return sent.select("id", requests.query_parameter(F.col("query"), "tag").alias("tag"), requests.json_body(F.col("body"), "id bigint")["id"].alias("body"))


@query("select s_suppkey as id, case when s_suppkey % 4 <> 0 then s_name end as name, s_suppkey % 4 = 1 as granted from supplier")
def token_claims(spark, d):
    s = V.table(spark, d, "supplier")
    k = F.col("s_suppkey")
    payload = F.to_json(F.struct(F.col("s_name").alias("name"), F.when(k % 4 == 1, "read write").otherwise("read").alias("scope")))
    plain = lambda x: F.rtrim(F.translate(F.replace(F.base64(x.cast("binary")), F.lit("\r\n"), F.lit("")), "+/", "-_"), F.lit("="))
    token = F.when(k % 4 == 0, "no token").otherwise(F.concat(plain(F.lit('{"alg":"x"}')), F.lit("."), plain(payload), F.lit(".sig")))
    own = requests.claims(token)
    return s.select(k.alias("id"), F.get_json_object(own, "$.name").alias("name"), X.scope_granted(F.get_json_object(own, "$.scope"), "write").alias("granted"))


@query(TASKS_SQL.replace("o_orderkey as id,", "o_orderkey as id, o_orderdate as asked, 'crawls_' || case when o_orderpriority like '%LOW' then 'low' when o_orderpriority like '%HIGH' then 'high' else 'normal' end as queue,") + """,
  first as (select uid from task where queue = 'crawls_high' order by asked, uid limit 100) select queue, count(*) as waiting, count(*) filter (where queue = 'crawls_high' and uid in (select uid from first)) as again from task where not (queue = 'crawls_high' and uid in (select uid from first)) group by 1""")
def queue_table(spark, d):
    """All tasks enqueued, the first hundred of one queue taken and done."""
    U.enqueued(_tasks(spark, d), F.lit("2024-01-01").cast("timestamp")).write.parquet(path := shared_folder(spark))
    queue = spark.read.parquet(path)
    done = U.taken(queue, "crawls_high", 100)
    left = U.without(queue, done)
    again = left.join(done.select("queue", "uid", F.lit(1).alias("back")), ["queue", "uid"], "left")
    return again.groupBy("queue").agg(F.count("*").alias("waiting"), F.count("back").alias("again"))


@query("select n_name as key, n_nationkey % 2 = 0 as raised from nation where n_nationkey % 5 <> 0")
def control_flags(spark, d):
    """Flags set, set again and cleared."""
    n = V.table(spark, d, "nation")
    k = F.col("n_nationkey")
    table = sinks.VersionedTable(spark, shared_folder(spark))
    U.set_flags(table, n.select(F.col("n_name").alias("key"), F.lit("1").alias("value")))
    U.set_flags(table, n.where(k % 2 != 0).select(F.col("n_name").alias("key"), F.lit("0").alias("value")))
    U.clear_flags(table, n.where(k % 5 == 0).select(F.col("n_name").alias("key")))
    return table.read().select("key", F.col("value").isin("1", "true", "True").alias("raised"))


@query("select exists (select 1 from region where r_regionkey = 1) as raised")
def lock_flag(spark, d):
    r = V.table(spark, d, "region").select(F.concat(F.lit("k"), F.col("r_regionkey")).alias("key"), F.lit("true").alias("value"))
    return registries.flag(r, "k1")


@query("select o_orderkey as id, case when o_orderkey % 3 = 0 then 'exited' else 'old' end as status, case when o_orderkey % 3 = 0 then 'http://site' || o_custkey || '.example/' end as website from orders")
def stored_container_stats(spark, d):
    """The figures of every third snapshot's container written to it, the newest of two."""
    s = V.snapshots(spark, d)
    own = s.withColumn("container_stats", F.lit('{"state":{"status":"old"}}')).select("id", "container_stats")
    told = lambda status, day: B.with_snapshot(s.where("id % 3 = 0").select(F.col("id").alias("snapshot_id"), F.struct(F.lit(status).alias("status")).alias("state")), s, V.websites(spark, d), F.lit(day).cast("timestamp"))
    out = B.stored(own, told("running", "2024-01-01").unionByName(told("exited", "2024-01-02")))
    g = lambda path: F.get_json_object("container_stats", path)
    return out.select("id", g("$.state.status").alias("status"), g("$.snapshot.website").alias("website"))


@query("select r_name as name, (select count(*) from orders) as orders, least((select count(*) from orders), 100) as counted from region where r_regionkey = 1")
def point_lookup(spark, d):
    """One row or an error, and a count after a limit."""
    one = L.exactly_one(V.table(spark, d, "region").where("r_regionkey = 1"), "region").select(F.col("r_name").alias("name"))
    o = V.table(spark, d, "orders")
    return S.beside(one, o.agg(F.count("*").alias("orders")), o.limit(100).agg(F.count("*").alias("counted")))


@query("select count(*) as n, count(*) as different, count(*) as fitting from supplier")
def generated_ids(spark, d):
    s = V.table(spark, d, "supplier").select(F.expr("uuid()").alias("uid"))
    s.write.parquet(path := shared_folder(spark))
    held = spark.read.parquet(path)
    return held.agg(F.count("*").alias("n"), F.count_distinct("uid").alias("different"), F.count_if(X.uuid_like(F.col("uid"))).alias("fitting"))


@query("select false as before, true as after, (select count(*) from region) as n")
def missing_places(spark, d):
    """A place isn't there, and is once it is written."""
    path = shared_folder(spark)
    before = sinks.exists(spark, path)
    V.table(spark, d, "region").write.parquet(path)
    n = spark.read.parquet(path).agg(F.count("*").alias("n"))
    return n.select(F.lit(before).alias("before"), F.lit(sinks.exists(spark, path)).alias("after"), "n")


@query("select count(*) as told, count(*) as different from orders")
def change_notifications(spark, d):
    """Every saved snapshot told once, though each event comes twice."""
    s = V.snapshots(spark, d).select("uid", F.col("created_at").alias("updated_at"))
    s.unionByName(s).write.parquet(path := shared_folder(spark))
    stream = spark.readStream.schema(s.schema).parquet(path)
    out = _followed(spark, monitor.changes(stream), [], "append")
    return out.agg(F.count("*").alias("told"), F.count_distinct("uid").alias("different"))


# Jobs that run by the clock, monitors under control


@query(TASKS_SQL + " select status, count(*) as n, 2 as runs from task group by 1")
def periodic_import(spark, d):
    """The pages imported by a job that runs again and again: after two runs every task is stored once."""
    path, n = _saved_pages(spark, d)
    table, runs = sinks.VersionedTable(spark, shared_folder(spark)), []

    def job(run: int) -> None:
        if len(runs) < 2:
            new = Q.imported(task_pages(spark, path, limit=PAGE, total=str(n))).select("uid", "status")
            old = table.read()
            table.replace(new if old is None else K.appended(old, new, ["uid"]))
            runs.append(run)

    q = monitor.every(spark, job, shared_folder(spark), 0.5)
    while len(runs) < 2 and not q.awaitTermination(0.2):
        pass
    q.stop()
    return table.read().groupBy("status").agg(F.count("*").alias("n")).withColumn("runs", F.lit(len(runs)))


@query("select event_type as kind, count(*) as n, 'crawl_stop' as ended from events group by 1")
def governed_monitor(spark, d):
    """All of events as a stream that is suspended at the start, resumed from its checkpoint, and stopped when it has read all."""
    schema = spark.read.parquet(f"{d}/events.parquet").schema
    total = V.table(spark, d, "events").count()
    out, checkpoint, told = shared_folder(spark), shared_folder(spark), ["crawl_suspend", "crawl_suspend", "crawl_resume"]

    def sink(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={number}")

    def begin():
        stream = spark.readStream.schema(schema).parquet(f"{d}/event[s].parquet").select(F.col("event_type").alias("kind"))
        return monitor.start(stream, sink, checkpoint, 0.2, "append")

    def wanted():
        if told:
            return told.pop(0)
        return "crawl_stop" if not total or sinks.exists(spark, out) and spark.read.parquet(out).count() >= total else None

    ended = monitor.governed(begin, wanted, 0.2)
    read = spark.read.parquet(out) if sinks.exists(spark, out) else spark.createDataFrame([], "kind string")
    return read.groupBy("kind").agg(F.count("*").alias("n")).withColumn("ended", F.lit(ended))


@query("select 2 as shows, (select max(o_orderkey) from orders) as newest")
def refreshed_view(spark, d):
    """The newest snapshot shown twice."""
    seen: list = []
    monitor.refreshed(lambda: L.newest_first(V.snapshots(spark, d), "id").select("id").limit(1), seen.extend, 0, 2)
    return spark.createDataFrame([(len(seen), max(r["id"] for r in seen) if seen else None)], "shows int, newest long")
