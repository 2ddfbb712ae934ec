"""Registered queries over the driver tables and their SQL counterparts.

Every query runs an operator of this package over whole tables; its SQL says the same independently, for DuckDB.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import collections as C
from ..functions import numbers as N
from ..functions import text as X
from ..functions import times as T
from ..operators import catalog as K
from ..operators import container as B
from ..operators import crawl_stats as S
from ..operators import lookup as L
from ..operators import metrics as M
from ..operators import seeds
from ..operators import serialize as Z
from ..operators import tasks as Q
from ..schemas import CONTAINER
from ..session import shared_folder
from ..sources import jobs
from ..sources.lines import log_records
from . import standins as V

_QUERIES: dict[str, Callable] = {}
_SQL: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None):
    def add(f):
        _QUERIES[name or f.__name__] = f
        if sql:
            _SQL[name or f.__name__] = sql
        return f

    return add


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


# CDX statistics

EXT_SQL = r"""
  with p as (select regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://[^/?#]*)?([^?#]*)', 1) as path from pages where url is not null and url <> ''),
  b as (select regexp_replace(regexp_extract(path, '([^/]*)$', 1), ';.*$', '') as base from p),
  e as (select lower(regexp_extract(base, '^\.*[^.].*?(\.[^.]*)$', 1)) as x from b)"""


def _extensions(spark, d):
    return S.extension_counts(V.table(spark, d, "pages").select(F.struct("url").alias("record")))


@query(EXT_SQL + " select case when x = '' then 'html' else x end as extension, count(*) as n from e group by 1")
def url_extension_counts(spark, d):
    return _extensions(spark, d)


@query(EXT_SQL + ", c as (select case when x = '' then 'html' else x end as extension, count(*) as n from e group by 1) select extension, n, round(n / sum(n) over (), 6) as share from c")
def url_extension_share(spark, d):
    return S.shares(_extensions(spark, d)).withColumn("share", F.round("share", 6))


# log statistics


@query(f"select job, count(*) as lines, cast(sum(strlen(line) + 1) as bigint) as bytes from ({V.LINE_SQL}) group by 1")
def log_line_volume(spark, d):
    return S.volume(V.log_lines(spark, d), ("job",))


@query(f"select context, lvl as level, count(*) as n from ({V.LOG_SQL}) group by 1, 2")
def log_parse_roundtrip(spark, d):
    r = log_records(V.log_lines(spark, d))
    return r.groupBy(F.col("record.context").alias("context"), F.col("record.logLevel").alias("level")).agg(F.count("*").alias("n"))


@query(f"select context, count(*) as n from ({V.LOG_SQL}) where event_id % 7 <> 0 group by 1")
def malformed_line_filter(spark, d):
    return S.context_counts(log_records(V.log_lines(spark, d, cut=7)))


@query(f"select job, context, count(*) as n from ({V.LOG_SQL}) group by 1, 2")
def context_counts(spark, d):
    return S.context_counts(log_records(V.log_lines(spark, d)), ("job",))


@query(f"with c as (select job, lvl as level, count(*) as n from ({V.LOG_SQL}) group by 1, 2) select job, level, n, round(n / sum(n) over (partition by job), 6) as share from c")
def level_share(spark, d):
    return S.shares(S.level_counts(log_records(V.log_lines(spark, d)), ("job",)), ("job",)).withColumn("share", F.round("share", 6))


@query(f"select job, count(*) filter (where context = 'worker' and message = 'Starting page') as page_start, count(*) filter (where context = 'pageStatus' and message = 'Page Finished') as page_finished from ({V.LOG_SQL}) group by 1")
def request_type_pivot(spark, d):
    return S.request_types(log_records(V.log_lines(spark, d)), ("job",))


@query(f"select message, count(*) as n from ({V.LOG_SQL}) where lvl = 'error' group by 1")
def error_message_counts(spark, d):
    return S.error_counts(log_records(V.log_lines(spark, d)))


@query(f"""select job, strftime(max_by(ts, event_id), '%Y-%m-%dT%H:%M:%SZ') as last_update, max_by('http://p/' || event_id, event_id) filter (where context = 'worker') as last_page,
  max_by(message, event_id) filter (where lvl = 'error') as last_error, coalesce(max_by(k, event_id) filter (where context = 'crawlStatus'), 0) as crawled,
  coalesce(max_by(k + job, event_id) filter (where context = 'crawlStatus'), 0) as total, 0::bigint as pending, 0::bigint as failed, false as limit_hit from ({V.LOG_SQL}) group by 1""")
def last_value_per_job(spark, d):
    out = S.last_values(log_records(V.log_lines(spark, d)), ("job",))
    return out.withColumn("last_update", T.to_iso(F.col("last_update")))


@query(f"select job, event_id, last_value(case when context = 'crawlStatus' then k end ignore nulls) over (partition by job order by event_id rows between unbounded preceding and current row) as crawled from ({V.LOG_SQL})")
def carry_forward_counters(spark, d):
    e = log_records(V.log_lines(spark, d)).select("job", F.col("offset").alias("event_id"), F.when(F.col("record.context") == "crawlStatus", F.col("record.details.crawled")).alias("v"))
    return M.carried(e, "job", ["event_id"], bucket=F.floor(F.col("event_id") / 4096), crawled="v").drop("v")


@query("""select user_id as job, round(sum(case when code like '2%' then 1 else 0 end) / greatest(count(*), 1), 6) as success_ratio, round(1 - sum(case when code like '2%' then 1 else 0 end) / greatest(count(*), 1), 6) as failure_ratio
  from (select user_id, case event_type when 'error' then '500' when 'signup' then '301' else '200' end as code from events) group by 1""")
def success_ratio_per_job(spark, d):
    code = F.when(F.col("event_type") == "error", "500").when(F.col("event_type") == "signup", "301").otherwise("200")
    cdx = V.events(spark, d).select(F.col("user_id").alias("job"), F.struct(code.alias("status")).alias("record"))
    out = S.success(S.http_status_counts(cdx, ("job",)), ("job",))
    return out.select("job", F.round("success_ratio", 6).alias("success_ratio"), F.round("failure_ratio", 6).alias("failure_ratio"))


@query("with c as (select k % 10 as kind, count(*) as n, min(event_id) as first_seen from (select event_id, cast(json_extract_string(props, '$.k') as bigint) as k from events) group by 1) select kind, n from c order by n desc, first_seen limit 5")
def top5_types(spark, d):
    c = V.events(spark, d).groupBy((F.col("k") % 10).alias("kind")).agg(F.count("*").alias("n"), F.min("event_id").alias("first_seen"))
    return S.top(c, 5, "first_seen").select("kind", "n")


@query(f"select case when context = 'general' then 'other' else context end as key, count(*) as n from ({V.LOG_SQL}) group by 1")
def count_map_exploded(spark, d):
    m = S.as_map(S.context_counts(log_records(V.log_lines(spark, d))), "context")
    return m.select(F.explode("counts").alias("key", "n")).withColumn("key", F.when(F.col("key") == "general", "other").otherwise(F.col("key")))


# rates between polls

POLL_SQL = """
  with day as (select user_id as snapshot_id, date_trunc('day', ts) as poll, max(ts) as last_update, count(*) filter (where event_type in ('view', 'error')) as l, count(*) filter (where event_type = 'click') as c,
      coalesce(sum(strlen(props)) filter (where event_type in ('view', 'error')), 0) as lb, coalesce(sum(strlen(props)) filter (where event_type = 'click'), 0) as cb from events group by 1, 2),
  t as (select snapshot_id, poll, last_update, sum(l) over w as log_lines, sum(lb) over w as log_bytes, sum(c) over w as cdx_lines, sum(cb) over w as cdx_bytes from day
      window w as (partition by snapshot_id order by poll rows between unbounded preceding and current row)),
  g as (select *, (epoch_us(last_update) - epoch_us(lag(last_update) over v)) / 1e6 as dt, lag(log_lines) over v as pl, lag(log_bytes) over v as plb, lag(cdx_lines) over v as pc, lag(cdx_bytes) over v as pcb from t
      window v as (partition by snapshot_id order by last_update))"""


def _polls(spark, d):
    e = V.events(spark, d).withColumn("poll", F.date_trunc("day", "ts"))
    log, cdx = F.col("event_type").isin("view", "error"), F.col("event_type") == "click"
    day = e.groupBy(F.col("user_id").alias("snapshot_id"), "poll").agg(
        F.max("ts").alias("last_update"), F.count_if(log).alias("l"), F.count_if(cdx).alias("c"), F.coalesce(F.sum(F.when(log, F.octet_length("props"))), F.lit(0)).alias("lb"), F.coalesce(F.sum(F.when(cdx, F.octet_length("props"))), F.lit(0)).alias("cb")
    )
    return M.running(day, "snapshot_id", ["poll"], log_lines="l", log_bytes="lb", cdx_lines="c", cdx_bytes="cb").drop("l", "c", "lb", "cb")


@query(POLL_SQL.split(",\n  g as")[0] + " select snapshot_id, strftime(poll, '%Y-%m-%d') as day, cast(log_lines as bigint) as log_lines, cast(log_bytes as bigint) as log_bytes, cast(cdx_lines as bigint) as cdx_lines, cast(cdx_bytes as bigint) as cdx_bytes from t")
def running_totals(spark, d):
    return _polls(spark, d).select("snapshot_id", F.date_format("poll", "yyyy-MM-dd").alias("day"), "log_lines", "log_bytes", "cdx_lines", "cdx_bytes")


@query(POLL_SQL + """ select snapshot_id, strftime(poll, '%Y-%m-%d') as day, case when dt > 0 then round((log_lines - pl) / dt, 8) else 0.0 end as log_entries_per_sec, case when dt > 0 then round((log_bytes - plb) / dt, 6) else 0.0 end as log_bytes_per_sec,
  case when dt > 0 then round((cdx_lines - pc) / dt, 8) else 0.0 end as cdx_entries_per_sec, case when dt > 0 then round((cdx_bytes - pcb) / dt, 6) else 0.0 end as cdx_bytes_per_sec from g""")
def poll_rates(spark, d):
    out = M.derived(_polls(spark, d))
    return out.select("snapshot_id", F.date_format("poll", "yyyy-MM-dd").alias("day"), *[F.round(f"{c}_per_sec", n).alias(f"{c}_per_sec") for c, n in (("log_entries", 8), ("log_bytes", 6), ("cdx_entries", 8), ("cdx_bytes", 6))])


@query(POLL_SQL + """ select snapshot_id, strftime(poll, '%Y-%m-%d') as day, coalesce(dt > 0 and log_lines = pl, false) as log_stalled, coalesce(dt > 0 and cdx_lines = pc, false) as cdx_stalled,
  coalesce(dt > 0 and log_lines > pl and cdx_lines = pc, false) as js_heavy from g""")
def stall_flags(spark, d):
    return M.derived(_polls(spark, d)).select("snapshot_id", F.date_format("poll", "yyyy-MM-dd").alias("day"), "log_stalled", "cdx_stalled", "js_heavy")


# seeds and lists

TAG_SQL = """
  with bridge as (select distinct o_custkey as website_id, p_type as tag from orders join lineitem on l_orderkey = o_orderkey join part on p_partkey = l_partkey),
  joined as (select website_id, string_agg(tag, ',' order by tag) as tags from bridge group by 1)"""
SEED_SQL = TAG_SQL + """ select c_custkey as id, c_name as title, 'http://site' || c_custkey || '.example/' as url, coalesce(tags, '') as tags from customer left join joined on website_id = c_custkey
  where exists (select 1 from orders where o_custkey = c_custkey and o_orderstatus = 'F')"""


@query(SEED_SQL)
def seed_list_all(spark, d):
    return seeds.seed_list(V.websites(spark, d), V.snapshots(spark, d), V.website_tags(spark, d), V.tags(spark, d))


@query(SEED_SQL + " and exists (select 1 from bridge b where b.website_id = c_custkey and contains(lower(b.tag), 'econ'))")
def seed_list_tag(spark, d):
    return seeds.seed_list(V.websites(spark, d), V.snapshots(spark, d), V.website_tags(spark, d), V.tags(spark, d), "ECON")


@query(TAG_SQL + " select website_id, tags from joined")
def seed_tags_joined(spark, d):
    return seeds.tag_lists(V.website_tags(spark, d), V.tags(spark, d)).select("website_id", "tags")


@query("select o_orderkey as id, strftime(o_orderdate, '%Y-%m-%d') as day, row_number() over (order by o_orderdate desc, o_orderkey desc) as place from orders order by o_orderdate desc, o_orderkey desc limit 100")
def snapshot_list(spark, d):
    first = L.newest_first(V.snapshots(spark, d)).limit(100)
    place = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.desc("created_at"), F.desc("id")))
    return first.select("id", F.date_format("created_at", "yyyy-MM-dd").alias("day"), place.alias("place"))


def _tasks(spark, d):
    o = V.snapshots(spark, d)
    actions = list(Q.ACTIONS)
    action = F.element_at(F.array(*[F.lit(a) for a in [*actions, "no_such_action"]]), (F.col("id") % 20 + 1).cast("int"))
    status = F.when(F.col("status") == "completed", "success").when(F.col("status") == "crawling", "running").otherwise("failed")
    return o.select(
        F.concat(F.lit("t"), F.col("id")).alias("uid"), action.alias("action"), status.alias("status"), F.substring_index("order_priority", "-", -1).alias("p"), F.col("created_at").alias("updateTime"),
        F.when(F.col("id") % 3 != 0, F.col("created_at")).alias("runAt"), F.when(F.col("id") % 4 != 0, F.col("id")).alias("snapshot_id"), "id",
        F.concat(F.lit('{"target_task_uid":"t'), (F.col("id") * 7) % 20000, F.lit('","snapshot":{"uid":"snap-'), (F.col("id") * 3) % 20000, F.lit('"}}')).alias("taskParameters"),
    ).withColumn("priority", F.lower(F.when(F.col("p").isin("LOW", "HIGH"), F.col("p")).otherwise(F.lit("urgent")))).drop("p")


_ACTION_LIST = "[" + ",".join(f"'{a}'" for a in [*Q.ACTIONS, "no_such_action"]) + "]"
TASK_SQL = f"""
  with task as (select 't' || o_orderkey as uid, {_ACTION_LIST}[cast(o_orderkey % 20 + 1 as int)] as action, case o_orderstatus when 'F' then 'success' when 'O' then 'running' else 'failed' end as status,
    case when o_orderpriority like '%LOW' then 'low' when o_orderpriority like '%HIGH' then 'high' else 'urgent' end as priority, o_orderdate as update_time, case when o_orderkey % 3 <> 0 then o_orderdate end as run_at,
    case when o_orderkey % 4 <> 0 then o_orderkey end as snapshot_id, o_orderkey as id, 't' || ((o_orderkey * 7) % 20000) as target_uid, 'snap-' || ((o_orderkey * 3) % 20000) as payload_uid from orders)"""


@query(TASK_SQL + " select uid, strftime(update_time, '%Y-%m-%d') as day from task where status = 'failed' order by update_time, uid limit 50")
def requeue_failed_topn(spark, d):
    return Q.failed_oldest(_tasks(spark, d), 50).select("uid", F.date_format("updateTime", "yyyy-MM-dd").alias("day"))


@query("select o_orderkey as id from orders order by o_orderdate, o_orderkey limit 50 offset 100")
def paged_scan(spark, d):
    return Q.page(V.snapshots(spark, d), ["created_at", "id"], 100, 50).select("id")


@query("select o_custkey as website_id, max(o_orderkey) as id, max_by(o_orderstatus, o_orderkey) as status from orders group by 1")
def latest_snapshot_per_website(spark, d):
    out = L.latest_per(V.snapshots(spark, d), "website_id")
    return out.select("website_id", "id", F.when(F.col("status") == "completed", "F").when(F.col("status") == "crawling", "O").otherwise("P").alias("status"))


# catalog


@query("select l_orderkey as snapshot_id, count(*) as item_count, cast(sum(trunc(l_extendedprice)) as bigint) as size from lineitem group by 1")
def warc_rollup_per_snapshot(spark, d):
    return K.rollup(V.warcs(spark, d))


@query("select o_orderkey as id, count(*) as n, cast(sum(trunc(l_extendedprice)) as bigint) as size from orders join lineitem on l_orderkey = o_orderkey where l_returnflag = 'A' and o_orderstatus = 'F' group by 1")
def production_warcs(spark, d):
    s = V.snapshots(spark, d).where("published").select("id")
    return K.production(V.warcs(spark, d)).join(s, F.col("snapshot_id") == F.col("id")).groupBy("id").agg(F.count("*").alias("n"), F.sum("size_bytes").alias("size"))


@query("select l_orderkey as snapshot_id, 'part-' || l_linenumber || '.warc.gz' as filename, max(cast(trunc(l_extendedprice) as bigint)) as size_bytes from lineitem group by 1, 2")
def warc_catalog_upsert(spark, d):
    w = V.warcs(spark, d).select("snapshot_id", "filename", "size_bytes")
    return K.upsert(w.where("size_bytes < 0"), w, ["snapshot_id", "filename"])


def _directories(spark, d):
    return V.warcs(spark, d).select(F.concat(F.lit("c"), F.col("snapshot_id")).alias("collection")).distinct()


@query("select o_orderkey as id from orders where not exists (select 1 from lineitem where l_orderkey = o_orderkey)")
def orphan_snapshots(spark, d):
    return K.orphans(V.snapshots(spark, d), _directories(spark, d)).select("id")


@query("select count(*) as checked, count(*) filter (where not exists (select 1 from lineitem where l_orderkey = o_orderkey)) as removed from orders")
def orphan_counts(spark, d):
    s = V.snapshots(spark, d)
    return K.orphan_summary(s, K.orphans(s, _directories(spark, d)))


@query("select l_orderkey as snapshot_id, count(*) as n from lineitem where l_orderkey not in (select o_orderkey from orders where o_orderstatus = 'P') group by 1")
def cascade_delete(spark, d):
    s = V.snapshots(spark, d)
    tasks = _tasks(spark, d)
    none = spark.createDataFrame([], "uid string, snapshot_id long")
    left = K.cascade_delete(s.where("status = 'pending'").select("id"), s, V.warcs(spark, d), none, tasks)
    return left["warc"].groupBy("snapshot_id").agg(F.count("*").alias("n"))


@query("select case when c_acctbal < 0 then 'internal' when o_orderstatus = 'F' then 'public' end as publication_status, count(*) as n from orders join customer on c_custkey = o_custkey group by 1")
def publish_fan_out(spark, d):
    s = V.snapshots(spark, d).withColumn("publication_status", F.when(F.col("published"), "public"))
    gone = K.of_websites(s, V.websites(spark, d).where("isDeleted"))
    return K.set_publication(s, gone, "internal").groupBy("publication_status").agg(F.count("*").alias("n"))


@query("select status, count(*) as n from (select case when o_orderkey % 200 in (0, 137, 143) then 'completed' else 'failed' end as status from orders) group by 1")
def exit_status(spark, d):
    exits = V.snapshots(spark, d).select("id", (F.col("id") % 200).alias("exit_code"))
    return K.final_status(exits).groupBy("status").agg(F.count("*").alias("n"))


@query("select c_custkey as id, exists (select 1 from orders where o_custkey = c_custkey) as known from customer")
def insert_if_absent(spark, d):
    seen = V.snapshots(spark, d).select(F.col("website_id").alias("id"))
    out = K.insert_if_absent(seen, V.websites(spark, d).select("id", "name"), ["id"])
    return out.select("id", (~F.col("created")).alias("known"))


@query("""select coalesce(c_custkey, w) as id, coalesce(seg, c_mktsegment) as segment, c_name as name from customer full join (select o_custkey as w, case when max(o_orderkey) % 2 = 0 then 'S' || max(o_orderkey) end as seg from orders group by 1) n on w = c_custkey""")
def upsert_merge(spark, d):
    old = V.websites(spark, d).select("id", F.col("displayName").alias("segment"), "name")
    top = V.snapshots(spark, d).groupBy(F.col("website_id").alias("id")).agg(F.max("id").alias("k"))
    new = top.select("id", F.when(F.col("k") % 2 == 0, F.concat(F.lit("S"), F.col("k"))).alias("segment"))
    return K.upsert(old, new, ["id"])


@query("""with e as (select event_type, 'http://p/' || user_id || '/' || json_extract_string(props, '$.k') as url from events)
  select url, count(*) as n from e where event_type = 'view' and url not in (select url from e where event_type = 'error') group by 1""")
def cdx_unpublish(spark, d):
    e = V.events(spark, d).withColumn("url", F.concat(F.lit("http://p/"), F.col("user_id"), F.lit("/"), F.col("k")))
    index, lines = e.where("event_type = 'view'").select("url"), e.where("event_type = 'error'").select("url")
    return K.unpublish_index(index, lines).groupBy("url").agg(F.count("*").alias("n"))


@query("""select c_custkey as id, coalesce(case when c_acctbal >= 5000 then c_mktsegment end, (select 'why ' || (o_orderkey % 100) from orders where o_custkey = c_custkey order by o_orderdate desc, o_orderkey desc limit 1)) as justification from customer""")
def scalar_subquery_fill(spark, d):
    w = V.table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.when(F.col("c_acctbal") >= 5000, F.col("c_mktsegment")).alias("publicationJustification"))
    told = F.concat(F.lit('{"publicationJustification":"why '), F.col("id") % 100, F.lit('"}'))
    t = V.snapshots(spark, d).select(F.col("website_id").alias("snapshot_id"), "created_at", "id", told.alias("taskParameters"))
    return K.fill_justification(w, t).select("id", F.col("publicationJustification").alias("justification"))


# tasks


@query(TASK_SQL + " select action, case when action = 'no_such_action' then 'failed' else 'dispatched' end as dispatch_status, case when action = 'no_such_action' then 'Unsupported task action: no_such_action' end as dispatch_message, count(*) as n from task group by 1, 2, 3")
def task_routing(spark, d):
    return Q.routed(_tasks(spark, d)).groupBy("action", "dispatch_status", "dispatch_message").agg(F.count("*").alias("n"))


@query(TASK_SQL + " select count(*) as processed, count(*) filter (where action <> 'no_such_action') as dispatched, count(*) filter (where action = 'no_such_action') as failed from task")
def dispatch_counts(spark, d):
    return Q.outcome(Q.routed(_tasks(spark, d)))


@query(TASK_SQL + " select 'crawls_' || case when priority in ('low', 'high') then priority else 'normal' end as queue, count(*) as n from task group by 1")
def priority_queue(spark, d):
    return _tasks(spark, d).groupBy(Q.queue_name(F.col("priority")).alias("queue")).agg(F.count("*").alias("n"))


@query(TASK_SQL + """, j as (select a.*, b.uid is not null as found, b.status as ts, b.snapshot_id as tsnap from task a left join task b on b.uid = a.target_uid where a.action in ('crawl_suspend', 'crawl_stop', 'crawl_resume', 'crawl_cancel', 'crawl_force_finish'))
  select uid, case when not found then 'failed' when action = 'crawl_suspend' and (ts <> 'running' or tsnap is null) then 'failed' when action in ('crawl_stop', 'crawl_force_finish') and (ts <> 'running' or tsnap is null) then 'failed' when action = 'crawl_resume' then 'failed'
    when action = 'crawl_suspend' then 'paused' when action = 'crawl_cancel' then 'cancelled' else 'stopped' end as control_status from j""")
def eligibility(spark, d):
    t = _tasks(spark, d)
    control = t.where(F.col("action").isin(*Q.NEXT))
    return Q.controlled(control, t).select("uid", "control_status")


@query(TASK_SQL + " select uid from task where run_at is null or run_at <= timestamp '1997-01-01'")
def due_tasks(spark, d):
    return _tasks(spark, d).where(Q.due(F.col("runAt"), F.lit("1997-01-01").cast("timestamp"))).select("uid")


@query(TASK_SQL + " select uid, action from task where action = 'enable_adding_crawls'")
def lock_gate(spark, d):
    return _tasks(spark, d).where(Q.unlocked(F.col("action"), F.lit(True))).select("uid", "action")


@query(TASK_SQL + " select a.uid, a.target_uid, b.status as target_status, b.uid is not null as target_found from task a left join task b on b.uid = a.target_uid")
def target_self_join(spark, d):
    t = _tasks(spark, d)
    return Q.with_target(t, t).select("uid", "target_uid", "target_status", "target_found")


@query(TASK_SQL + " select uid, o_orderkey as payload_snapshot_id from task left join orders on 'snap-' || o_orderkey = payload_uid")
def payload_snapshot_join(spark, d):
    return Q.with_payload_snapshot(_tasks(spark, d), V.snapshots(spark, d)).select("uid", "payload_snapshot_id")


@query(TASK_SQL + " select uid from task where id % 5 = 0 or id % 2 = 1")
def created_or_forced(spark, d):
    t = _tasks(spark, d)
    stored, incoming = t.where("id % 2 = 0").select("uid"), t.select("uid", "id")
    return Q.to_dispatch(stored, incoming.where("id % 5 <> 0")).select("uid").union(Q.to_dispatch(stored, incoming.where("id % 5 = 0"), force=True).select("uid"))


@query("select count(*) filter (where c_acctbal >= 0) as started, count(*) filter (where c_acctbal < 0) as skipped from customer")
def admin_start(spark, d):
    return Q.admin_start(V.websites(spark, d))


@query("select o_orderkey as id, o_orderstatus as registry from orders union all select o_orderkey, 'all' from orders where o_orderkey % 10 = 0")
def job_union_all(spark, d):
    o = V.table(spark, d, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("registry"))
    parts = [o.where(F.col("registry") == s) for s in ("F", "O", "P")]
    return jobs.all_jobs(*parts, o.where("id % 10 = 0").withColumn("registry", F.lit("all")))


@query("select 'j' || (c_custkey * 11) as job_id, case o_orderstatus when 'F' then 'finished' else 'started' end as status, case when o_orderstatus = 'F' then 'r' || o_orderkey end as result, case when o_orderkey is null then 'Job not found' end as error from customer left join orders on o_orderkey = c_custkey * 11".replace("case o_orderstatus when 'F' then 'finished' else 'started' end", "case when o_orderstatus = 'F' then 'finished' when o_orderstatus is not null then 'started' end"))
def job_status(spark, d):
    o = V.table(spark, d, "orders")
    known = o.select(F.concat(F.lit("j"), F.col("o_orderkey")).alias("job_id"), F.when(F.col("o_orderstatus") == "F", "finished").otherwise("started").alias("status"), F.concat(F.lit("r"), F.col("o_orderkey")).alias("result"))
    wanted = V.table(spark, d, "customer").select(F.concat(F.lit("j"), F.col("c_custkey") * 11).alias("job_id"))
    return jobs.job_status(known, wanted)


@query("""select i as identifier, coalesce((select o_orderkey from orders where o_orderkey = try_cast(i as bigint)), (select max(o_orderkey) from orders where o_custkey = try_cast(i as bigint)), (select max(o_orderkey) from orders join customer on c_custkey = o_custkey where c_name = i)) as snapshot_id
  from (select case when c_custkey % 3 = 0 then c_name else cast(c_custkey * 20 as varchar) end as i from customer)""")
def resolve_identifier(spark, d):
    i = F.when(F.col("c_custkey") % 3 == 0, F.col("c_name")).otherwise((F.col("c_custkey") * 20).cast("string"))
    ids = V.table(spark, d, "customer").select(i.alias("identifier"))
    s = V.snapshots(spark, d).withColumn("rq_job_id", F.lit(None).cast("string"))
    return L.resolve(ids, s, V.websites(spark, d))


# functions


@query("select p_partkey as id, 'size' as key, cast(p_size as varchar) as value from part union all select p_partkey, 'brand', p_brand from part where p_partkey % 2 = 0")
def residual_keys(spark, d):
    p = V.table(spark, d, "part")
    m = F.create_map(F.lit("crawlScope"), F.col("p_name"), F.lit("size"), F.col("p_size").cast("string"), F.lit("brand"), F.when(F.col("p_partkey") % 2 == 0, F.col("p_brand")), F.lit("pageBehavior"), F.lit("x"))
    return p.select(F.col("p_partkey").alias("id"), F.explode(C.without_nulls(C.residual(m))).alias("key", "value"))


@query("select p_partkey as id, case when p_size > 25 then 1 else 0 end + 1 as n from part")
def drop_null_entries(spark, d):
    p = V.table(spark, d, "part")
    m = F.create_map(F.lit("name"), F.col("p_name"), F.lit("size"), F.when(F.col("p_size") > 25, F.col("p_size").cast("string")))
    return p.select(F.col("p_partkey").alias("id"), F.size(C.without_nulls(m)).alias("n"))


@query("select p_partkey as id, case when p_size > 25 then p_brand || '|' || p_type else p_type end as exclude from part")
def exclude_concat(spark, d):
    p = V.table(spark, d, "part")
    out = C.concatenated(F.when(F.col("p_size") > 25, F.array("p_brand")), F.array("p_type"))
    return p.select(F.col("p_partkey").alias("id"), X.join_pipes(out).alias("exclude"))


@query("select p_partkey as id, len(string_split(p_name, ' ')) as parts from part")
def pipe_split(spark, d):
    p = V.table(spark, d, "part")
    return p.select(F.col("p_partkey").alias("id"), F.size(X.split_pipes(F.concat(F.lit("|"), F.replace("p_name", F.lit(" "), F.lit("||"))))).cast("long").alias("parts"))


@query("select p_partkey as id, case when p_partkey % 2 = 0 then 'new' else p_brand end as brand, p_type as kind from part")
def params_merge(spark, d):
    p = V.table(spark, d, "part")
    base, change = F.create_map(F.lit("brand"), F.col("p_brand"), F.lit("kind"), F.col("p_type")), F.when(F.col("p_partkey") % 2 == 0, F.create_map(F.lit("brand"), F.lit("new")))
    return p.withColumn("m", C.merged(base, change)).select(F.col("p_partkey").alias("id"), F.col("m")["brand"].alias("brand"), F.col("m")["kind"].alias("kind"))


@query("select event_id, coalesce(try_cast(json_extract_string(props, '$.k') as bigint), 0) as k, coalesce(json_extract_string(props, '$.none'), 'default') as missing from events")
def json_path_default(spark, d):
    return V.table(spark, d, "events").select("event_id", F.coalesce(X.whole_number(X.json_key(F.col("props"), "k")), F.lit(0)).alias("k"), X.or_default(X.json_key(F.col("props"), "none"), "default").alias("missing"))


@query("select event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') || case when epoch_us(ts) % 1000000 = 0 then '' else '.' || lpad(cast(epoch_us(ts) % 1000000 as varchar), 6, '0') end || 'Z' as iso, true as round_trip from events")
def iso_timestamps(spark, d):
    e = V.events(spark, d).withColumn("iso", T.to_iso(F.col("ts")))
    return e.select("event_id", "iso", (T.from_iso(F.col("iso")) == F.col("ts")).alias("round_trip"))


@query("select l_orderkey as id, round(sum(trunc(l_extendedprice)) / 1e6, 2) as mb from lineitem group by 1")
def round_mb(spark, d):
    return K.rollup(V.warcs(spark, d)).select(F.col("snapshot_id").alias("id"), N.megabytes(F.col("size")).alias("mb"))


@query("select p_partkey as id, cast(floor(p_size * 700 / 1000) as bigint) as seconds, p_size * 1000 as ms, cast(trunc(p_retailprice * 1073741824) as bigint) as bytes from part")
def unit_conversions(spark, d):
    return V.table(spark, d, "part").select(F.col("p_partkey").alias("id"), N.whole_seconds(F.col("p_size") * 700).alias("seconds"), N.milliseconds(F.col("p_size")).alias("ms"), N.gigabytes_to_bytes(F.col("p_retailprice")).alias("bytes"))


@query("select doc_id, sha256(text) as digest, octet_length(encode(text)) as bytes from documents")
def sha256_names(spark, d):
    return V.table(spark, d, "documents").select("doc_id", X.sha256_hex(F.col("text")).alias("digest"), X.byte_length(F.col("text")).cast("long").alias("bytes"))


@query("select doc_id, regexp_full_match(substr(sha256(text), 1, cast(30 + doc_id % 8 as int)), '[0-9a-fA-F-]{32,36}') as fits from documents")
def uuid_like(spark, d):
    return V.table(spark, d, "documents").select("doc_id", X.uuid_like(F.substr(F.sha2("text", 256), F.lit(1), (30 + F.col("doc_id") % 8).cast("int"))).alias("fits"))


@query("select p_partkey as id, try_cast(case when p_size % 2 = 0 then cast(p_size as varchar) else p_name end as bigint) as number from part")
def safe_int_lookup(spark, d):
    return V.table(spark, d, "part").select(F.col("p_partkey").alias("id"), X.whole_number(F.when(F.col("p_size") % 2 == 0, F.col("p_size").cast("string")).otherwise(F.col("p_name"))).alias("number"))


@query("select o_orderkey as id, case when b >= 1099511627776 then printf('%.1f TB', b / 1099511627776) when b >= 1073741824 then printf('%.1f GB', b / 1073741824) when b >= 1048576 then printf('%.1f MB', b / 1048576) when b >= 1024 then printf('%.1f KB', b / 1024) else cast(cast(b as bigint) as varchar) || case when b = 1 then ' byte' else ' bytes' end end as size from (select o_orderkey, cast(o_orderkey * o_orderkey as double) as b from orders)")
def human_size(spark, d):
    o = V.table(spark, d, "orders")
    return o.select(F.col("o_orderkey").alias("id"), N.human_size(F.col("o_orderkey") * F.col("o_orderkey")).alias("size"))


@query("select url, regexp_extract(url, '([^/]*)$', 1) as base, regexp_matches(url, '(\\.html|/)$') as listed, regexp_replace('a/' || page_id || '//', '/+$', '') || '/x' as joined from pages")
def path_functions(spark, d):
    u = F.col("url")
    return V.table(spark, d, "pages").select("url", X.basename(u).alias("base"), X.has_suffix(u, ".html", "/").alias("listed"), X.join_path(F.concat(F.lit("a/"), F.col("page_id"), F.lit("//")), F.lit("x")).alias("joined"))


@query("select r_regionkey as id, coalesce(case when r_regionkey % 2 = 0 then 'c' || r_regionkey end, 'None') || '/' || r_name as url from region")
def replay_url(spark, d):
    r = V.table(spark, d, "region")
    return r.select(F.col("r_regionkey").alias("id"), X.relative_replay_url(F.when(F.col("r_regionkey") % 2 == 0, F.concat(F.lit("c"), F.col("r_regionkey"))), F.col("r_name")).alias("url"))


@query("select n_nationkey as id, n_name as name, contains(lower(n_name), 'an') as fits, n_name in ('nation_1', 'NATION_1') as named from nation")
def text_predicates(spark, d):
    n = V.table(spark, d, "nation")
    return n.select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"), X.contains_ignoring_case(F.col("n_name"), "AN").alias("fits"), F.col("n_name").isin("nation_1", "NATION_1").alias("named"))


@query("select s_suppkey as id, s_suppkey % 3 = 1 as granted from supplier")
def scope_claim(spark, d):
    s = V.table(spark, d, "supplier")
    claim = F.when(F.col("s_suppkey") % 3 == 0, "read").when(F.col("s_suppkey") % 3 == 1, "read write").otherwise("writer")
    return s.select(F.col("s_suppkey").alias("id"), X.scope_granted(claim, "write").alias("granted"))


@query("select n_name as name from nation where n_nationkey % 4 <> 0 and n_name not in (select n_name from nation where n_nationkey % 6 = 1)")
def active_queues(spark, d):
    n = V.table(spark, d, "nation").select(F.col("n_name").alias("name"), F.col("n_nationkey").alias("k"), (F.col("n_nationkey") % 4 == 0).alias("paused"))
    return jobs.active_queues(n, n.where("k % 6 = 1").select("name")).select("name")


# containers and documents

_CONTAINER_SQL = """
  with c as (select o_orderkey as id, o_orderkey % 5 <> 0 as live, o_orderkey % 7 = 0 as idle, o_totalprice as price, case when o_orderkey % 3 = 0 then 1 else 4 end as cpus from orders)
  select 'k' || id as id, case when live and not idle then round(cast(trunc(price) as bigint) / 1000000000 * cpus * 100.0, 2) else 0.0 end as cpu_percent,
    case when live then round(cast(trunc(price) as bigint) / 4000037 * 100.0, 2) else 0.0 end as memory_percent, case when live then 30 + 2 * id else 0 end as rx_bytes, case when live then id + 5 else 0 end as read_bytes, case when live then 7 else 0 end as write_bytes from c"""


@query(_CONTAINER_SQL)
def container_cpu_mem_net_io(spark, d):
    o = V.table(spark, d, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_totalprice").cast("long").alias("p"))
    k, idle = F.col("k"), F.col("k") % 7 == 0
    usage = F.when(k % 3 == 0, F.array().cast("array<bigint>")).otherwise(F.array(*[F.lit(1).cast("long")] * 4))
    document = F.struct(
        F.concat(F.lit("k"), k).alias("id"), F.lit("s").alias("short_id"), F.lit("n").alias("name"), F.lit("running").alias("status"), F.lit(True).alias("available"),
        F.struct(F.struct((k % 5 != 0).alias("Running")).alias("State"), F.struct(F.lit("img").alias("Image")).alias("Config")).alias("attrs"),
        F.struct(
            F.struct(F.struct(F.when(idle, 1000).otherwise(F.col("p") + 1000).alias("total_usage"), usage.alias("percpu_usage")).alias("cpu_usage"), F.lit(1000000500).alias("system_cpu_usage")).alias("cpu_stats"),
            F.struct(F.struct(F.lit(1000).alias("total_usage")).alias("cpu_usage"), F.lit(500).alias("system_cpu_usage")).alias("precpu_stats"),
            F.struct(F.col("p").alias("usage"), F.lit(4000037).alias("limit")).alias("memory_stats"),
            F.create_map(F.lit("eth0"), F.struct(k.alias("rx_bytes"), F.lit(0).alias("tx_bytes")), F.lit("eth1"), F.struct((k + 30).alias("rx_bytes"), F.lit(0).cast("int").alias("tx_bytes"))).alias("networks"),
            F.struct(F.array(F.struct(F.lit("Read").alias("op"), k.alias("value")), F.struct(F.lit("Read").alias("op"), F.lit(5).cast("long").alias("value")), F.struct(F.lit("read").alias("op"), F.lit(100).cast("long").alias("value")), F.struct(F.lit("Write").alias("op"), F.lit(7).cast("long").alias("value"))).alias("io_service_bytes_recursive")).alias("blkio_stats"),
        ).alias("stats"),
    )
    held = o.select(F.from_json(F.to_json(document), CONTAINER).alias("c")).select("c.*")
    p = B.payload(held, F.lit("2024-01-01").cast("timestamp"))
    return p.select("container.id", "resources.cpu_percent", F.col("resources.memory.percent").alias("memory_percent"), "io.network.rx_bytes", "io.block.read_bytes", "io.block.write_bytes")


def _full_snapshots(spark, d):
    s = V.snapshots(spark, d)
    more = {c: F.lit(None).cast("string") for c in ("crawl_stats", "container_stats", "publication_status", "warc_path", "crawlJustification", "publicationJustification")}
    stats = F.when(F.col("id") % 2 == 0, F.concat(F.lit('{"crawled":'), F.col("id"), F.lit("}")))
    return s.withColumns(more).withColumns({"crawl_stats": stats, "isDeleted": F.lit(False), "crawlStartTimestamp": F.col("created_at"), "crawlStopTimestamp": F.lit(None).cast("timestamp"), "size": F.lit(1).cast("long"), "item_count": F.lit(1).cast("long"), "crawlWarcSize": F.lit(1).cast("long")})


@query("""select 'snap-' || o_orderkey as uid, 'http://site' || o_custkey || '.example/' as url, 'none' as publication, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') as started, case when o_orderkey % 2 = 0 then o_orderkey else 0 end as crawled,
  coalesce(n, 0) as warcs, 'c' || o_orderkey || '/http://site' || o_custkey || '.example/' as replay from orders left join (select l_orderkey, count(*) as n from lineitem group by 1) on l_orderkey = o_orderkey""")
def nested_snapshot_doc(spark, d):
    w = V.warcs(spark, d).withColumns({"sha256": F.lit(""), "created_at": F.lit(None).cast("timestamp"), "path": F.lit("p")})
    doc = Z.snapshots(_full_snapshots(spark, d), V.websites(spark, d), w)
    return doc.select("document.uid", "document.url", F.col("document.publicationStatus").alias("publication"), F.col("document.crawlStartTimestamp").alias("started"), F.col("document.metadataTechnical.crawled").alias("crawled"), F.size("document.warcs").cast("long").alias("warcs"), F.col("document.replayRelativeUrl").alias("replay"))


@query(TAG_SQL + """, n as (select website_id, count(*) as n from bridge group by 1) select c_custkey as id, c_name as name, c_nationkey::bigint as organisation, coalesce(n, 0) as tags from customer left join n on website_id = c_custkey""")
def nested_website_doc(spark, d):
    w = V.websites(spark, d)
    for c, t in (("website_crawl_parameters_id", "long"), ("shortDescription", "string"), ("longDescription", "string"), ("doCrawl", "boolean"), ("suspendCrawlUntilTimestamp", "timestamp"), ("scope_type", "string"), ("generate_cdx", "boolean"), ("workers", "int"), ("page_load_timeout", "int"), ("disk_utilization", "int"), ("time_limit", "int"), ("auto_publish", "boolean")):
        w = w.withColumn(c, F.lit(None).cast(t))
    doc = Z.websites(w, V.website_tags(spark, d), V.tags(spark, d))
    return doc.select("document.id", "document.name", F.col("document.organisationId").alias("organisation"), F.size("document.tags").cast("long").alias("tags"))


@query("""select p_partkey as id, 'page' as scope, case when p_size % 3 = 0 then p_size end as pages, p_size * 1000 as load_ms, case when p_size > 25 then p_brand end as agent, case when p_size % 2 = 0 then 1 else 0 end as excluded, case when p_size % 5 = 0 then '"x"' else null end as extra from part""")
def crawl_config_doc(spark, d):
    p = V.table(spark, d, "part")
    empty, text = F.array().cast("array<string>"), F.lit("")
    size = F.col("p_size")
    row = p.select(
        F.col("p_partkey").alias("id"), F.lit("page").alias("scope_type"), F.array("p_name").alias("start_urls"), F.lit(False).alias("include_linked"), F.lit(None).cast("int").alias("max_depth"), empty.alias("url_prefixes"),
        empty.alias("additional_pages"), F.when(size % 2 == 0, F.array("p_type")).otherwise(empty).alias("exclude_text_matches"), empty.alias("exclude_regex_matches"), F.when(size % 3 == 0, size).otherwise(0).alias("max_pages"),
        F.lit(0).alias("time_limit"), F.lit(None).cast("double").alias("size_limit_gb"), F.lit(True).alias("auto_scroll"), F.lit(False).alias("auto_click"), size.alias("page_load_timeout"), F.lit(0).alias("post_load_delay_ms"),
        F.lit(0).alias("page_extra_delay_ms"), F.when(size > 25, F.col("p_brand")).otherwise(text).alias("user_agent"), text.alias("language"), text.alias("proxy_server"),
        F.when(size % 5 == 0, F.create_map(F.lit("extra"), F.lit('"x"'))).alias("extra_config"),
    )
    g = lambda path: F.get_json_object("document", f"$.engineConfig.{path}")
    return Z.crawl_configs(row).select(
        "crawl_config_id", g("crawlScope.type").alias("scope"), g("crawlLimits.maxPages").cast("int").alias("pages"), g("pageBehavior.pageLoadLimitMs").cast("int").alias("load_ms"), g("browserSettings.userAgent").alias("agent"),
        F.coalesce(F.size(F.from_json(g("crawlScope.excludePages.textMatches"), "array<string>")), F.lit(0)).alias("excluded"), F.when(g("extra").isNotNull(), F.concat(F.lit('"'), g("extra"), F.lit('"'))).alias("extra"),
    ).withColumnRenamed("crawl_config_id", "id")


@query("""select 't' || o_orderkey as uid, 'http://site' || o_custkey || '.example/' as seed, cast(o_orderkey % 4 as int) as depth, case when o_orderkey <> 0 then cast(floor(o_orderkey * 10 / 1000) as bigint) end as timeout, cast(trunc((o_orderkey % 3 + 0.5) * 1073741824) as bigint) as size, 'autoscroll' as behavior, 'c' || o_orderkey as collection from orders""")
def crawler_config_doc(spark, d):
    t = _tasks(spark, d).withColumn("snapshot_id", F.col("id"))
    config = F.concat(F.lit('{"crawlConfig":{"crawlEngine":"browsertrix","engineConfig":{"crawlScope":{"startUrls":[],"maxDepth":'), F.col("id") % 4, F.lit('},"crawlLimits":{"sizeLimitGB":'), F.col("id") % 3, F.lit('.5},"pageBehavior":{"autoScroll":true,"pageLoadLimitMs":'), F.col("id") * 10, F.lit("}}}}"))
    out = Z.crawler_configs(t.withColumn("taskParameters", config), V.snapshots(spark, d), V.websites(spark, d))
    g = lambda p: F.get_json_object("config", f"$.{p}")
    return out.select("uid", g("seeds[0]").alias("seed"), g("depth").cast("int").alias("depth"), g("pageLoadTimeout").cast("long").alias("timeout"), g("sizeLimit").cast("long").alias("size"), g("behaviors[0]").alias("behavior"), g("collection").alias("collection"))


@query("""select 't' || o_orderkey as uid, case when o_orderkey % 2 = 0 then 'page' else 'host' end as scope_type, case when o_orderkey % 2 = 0 then 'browsertrix' else 'other' end as engine_type, true as auto_scroll, o_orderkey % 9 as max_pages, case when o_orderkey % 2 = 1 then 'Unsupported crawl engine: other' end as error from orders""")
def parameters_from_doc(spark, d):
    even = F.col("id") % 2 == 0
    doc = F.concat(F.lit('{"crawlConfig":{"crawlEngine":"'), F.when(even, "browsertrix").otherwise("other"), F.lit('","engineConfig":{"crawlScope":{'), F.when(even, "").otherwise('"type":"host"'), F.lit('},"crawlLimits":{"maxPages":'), F.col("id") % 9, F.lit('},"more":1}}}'))
    out = Z.parameters_from_documents(_tasks(spark, d).withColumn("taskParameters", doc))
    return out.select("uid", "scope_type", "engine_type", "auto_scroll", F.col("max_pages").cast("long").alias("max_pages"), "error")


@query("""select 't' || o_orderkey as uid, case when o_orderkey % 2 = 0 then 'embedded' else c_name end as name, 'http://site' || o_custkey || '.example/' as url, c_acctbal >= 0 as enabled from orders join customer on c_custkey = o_custkey""")
def website_from_doc(spark, d):
    s = V.snapshots(spark, d)
    doc = F.when(F.col("id") % 2 == 0, F.concat(F.lit('{"website":{"id":'), F.col("website_id"), F.lit(',"name":"embedded"}}'))).otherwise(F.concat(F.lit('{"websiteId":'), F.col("website_id"), F.lit("}")))
    t = s.select(F.concat(F.lit("t"), F.col("id")).alias("uid"), doc.alias("taskParameters"))
    stored = V.websites(spark, d).withColumns({"shortDescription": F.lit(None).cast("string"), "longDescription": F.lit(None).cast("string"), "doCrawl": F.lit(True), "auto_publish": F.lit(True)})
    return Z.websites_from_documents(t, stored).select("uid", "name", "url", "enabled")


@query(TASK_SQL + " select uid, action, strftime(update_time, '%Y-%m-%dT%H:%M:%SZ') as updated, status from task")
def task_payload(spark, d):
    t = _tasks(spark, d)
    for c in ("user", "updateMessage", "result", "resultDescription", "runData", "schedule", "taskResponse"):
        t = t.withColumn(c, F.lit(None).cast("string"))
    for c in ("scheduleTime", "startTime", "finishTime"):
        t = t.withColumn(c, F.lit(None).cast("timestamp"))
    return Z.task_payloads(t).select("uid", "document.action", F.col("document.updateTime").alias("updated"), "document.status")


# streaming


@query("select event_type as context, count(*) as n, cast(sum(strlen(props)) as bigint) as bytes from events group by 1")
def stream_context_counts(spark, d):
    """All of events as a stream, run to its end, with its counters in state."""
    import uuid

    schema = spark.read.parquet(f"{d}/events.parquet").schema
    source = spark.readStream.schema(schema).parquet(f"{d}/event[s].parquet")
    counted = source.groupBy(F.col("event_type").alias("context")).agg(F.count("*").alias("n"), F.sum(F.octet_length("props")).alias("bytes"))
    name = f"counts_{uuid.uuid4().hex}"
    q = counted.writeStream.format("memory").queryName(name).option("checkpointLocation", shared_folder(spark)).outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.table(name)


