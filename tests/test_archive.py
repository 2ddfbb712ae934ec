import json
from collections import Counter

import pytest
from pyspark.sql import functions as F

from skeinwork.operators import catalog as K
from skeinwork.operators import lookup as L
from skeinwork.operators import serialize as Z
from skeinwork.operators import sinks
from skeinwork.operators import tasks as Q
from skeinwork.plans import jobs
from skeinwork.schemas import TABLES, violations
from skeinwork.sources.pages import task_pages


def frame(spark, table, *rows):
    """Rows of a stored table from dicts; absent columns are null."""
    return spark.createDataFrame([(json.dumps(r),) for r in rows], "j string").select(F.from_json("j", TABLES[table]).alias("r")).select("r.*")


def test_upsert_keeps_old_values_for_nulls_and_is_idempotent(spark):
    old = spark.createDataFrame([(1, "a", 1), (2, "b", 2)], "id long, x string, n long")
    new = spark.createDataFrame([(2, None, 5), (3, "c", 6)], "id long, x string, n long")
    once = K.upsert(old, new, ["id"])
    assert sorted(map(tuple, once.collect())) == [(1, "a", 1), (2, "b", 5), (3, "c", 6)]
    assert sorted(map(tuple, K.upsert(once, new, ["id"]).collect())) == sorted(map(tuple, once.collect()))
    assert sorted(map(tuple, K.upsert(old, new, ["id"], keep_null=False).collect()))[1] == (2, None, 5)


def test_insert_if_absent_marks_and_appends(spark):
    old, new = spark.createDataFrame([(1, "a")], "id long, x string"), spark.createDataFrame([(1, "z"), (2, "b"), (2, "b")], "id long, x string")
    assert sorted((r.id, r.created) for r in K.insert_if_absent(old, new, ["id"]).collect()) == [(1, False), (2, True)]
    assert sorted(map(tuple, K.appended(old, new, ["id"]).collect())) == [(1, "a"), (2, "b")]


@pytest.mark.parametrize("kind", ["long", "string"])
def test_rows_without_a_key_are_spread(spark, kind):
    """A snapshot without a website, or a website without a configuration, matches nothing: no task gets all of these."""
    s = spark.range(4000).select(F.col("id").alias("snapshot_id"), F.when(F.col("id") % 10 == 0, F.col("id").cast(kind)).alias("website_id"), F.struct("id").alias("document"))
    sites = spark.range(0, 4000, 20).select(F.col("id").cast(kind).alias("website_id"), F.when(F.col("id") % 100 == 0, F.col("id")).alias("website_crawl_parameters_id"), F.struct("id").alias("document"))
    configs = spark.range(0, 4000, 200).select(F.col("id").alias("crawl_config_id"), F.lit("{}").alias("document"))
    changed = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in changed}
    try:
        for k, v in changed.items():
            spark.conf.set(k, v)
        rows = Z.task_parameters(s, sites, configs).withColumn("part", F.spark_partition_id()).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    held = {r.snapshot_id: json.loads(r.parameters) for r in rows}
    assert len(rows) == len(held) == 4000 and max(Counter(r.part for r in rows).values()) < 2000
    assert all(("website" in x) == (k % 20 == 0) and ("crawlConfig" in x) == (k % 200 == 0) and ("websiteId" in x) == (k % 10 == 0) for k, x in held.items())


def test_orphans_go_with_their_children(spark):
    snaps = frame(spark, "snapshot", {"id": 1, "replay_collection_id": "c1"}, {"id": 2, "replay_collection_id": "c2"})
    dirs = spark.createDataFrame([("c1",)], "collection string")
    w, t = frame(spark, "warc", {"id": 1, "snapshot_id": 1}, {"id": 2, "snapshot_id": 2}), frame(spark, "task", {"id": 1, "snapshot_id": 2}, {"id": 2, "snapshot_id": 1})
    none = frame(spark, "snapshot_response_delivery")
    out = jobs.cleanup_orphans(snaps, dirs, w, none, t)
    assert out["counts"].first().asDict() == {"checked": 2, "removed": 1} and [r.id for r in out["warc"].collect()] == [1]
    assert sorted((r.id, r.snapshot_id) for r in out["task"].collect()) == [(1, None), (2, 1)]
    assert set(jobs.cleanup_orphans(snaps, dirs, w, none, t, dry_run=True)) == {"orphans", "counts"}


def test_publication_round_trip(spark):
    snaps = frame(spark, "snapshot", {"id": 1, "website_id": 5, "published": False}, {"id": 2, "website_id": 6, "published": False})
    index, lines = spark.createDataFrame([("k0", "x")], "key string, line string"), spark.createDataFrame([("k1", "a"), ("k1", "a")], "key string, line string")
    sites = spark.createDataFrame([(5,)], "id long")
    out = jobs.publish_website(snaps, sites, index, lines)
    assert {r.id: r.publication_status for r in out["snapshot"].collect()} == {1: "public", 2: None} and out["index"].count() == 2
    w = frame(spark, "warc", {"id": 1, "snapshot_id": 1, "is_production": True}, {"id": 2, "snapshot_id": 2, "is_production": True})
    back = jobs.unpublish_website(out["snapshot"], sites, out["index"], lines, w)
    assert back["index"].count() == 1 and {r.id: r.is_production for r in back["warc"].collect()} == {1: False, 2: True}


def test_archive_registers_files(spark, tmp_path):
    (tmp_path / "a.warc.gz").write_bytes(b"abc")
    out = jobs.archive(spark, frame(spark, "warc").drop("id"), str(tmp_path), 9)
    assert [(r.snapshot_id, r.filename, r.size_bytes, r.is_production) for r in out["warc"].collect()] == [(9, "a.warc.gz", 3, False)]
    assert out["totals"].first().asDict() == {"snapshot_id": 9, "item_count": 1, "size": 3}


def test_page_source_goes_on_until_a_short_page(spark, tmp_path):
    items = [{"uid": f"u{i}", "action": "crawl_run", "status": "scheduled", "priority": "high", "taskParameters": {"snapshot": {"uid": "s1"}}} for i in range(5)]
    for s in (0, 2, 4):
        (tmp_path / f"{s}.json").write_text(json.dumps({"items": items[s : s + 2], "runAt": None}))
    docs = task_pages(spark, str(tmp_path), ["scheduled", "created"], limit=2)
    assert sorted(r.uid for r in docs.collect()) == [f"u{i}" for i in range(5)]
    assert task_pages(spark, str(tmp_path), limit=2, total="5").count() == 5
    stored = frame(spark, "task", {"uid": "u1", "status": "success"})
    snaps = frame(spark, "snapshot", {"id": 4, "uid": "s1"})
    out = jobs.import_tasks(docs, stored, snaps, F.lit("2024-01-01").cast("timestamp"), F.lit(False))
    assert out["counts"].first().asDict() == {"processed": 4, "dispatched": 4, "failed": 0} and {r.payload_snapshot_id for r in out["new"].collect()} == {4}
    assert {r.queue for r in out["dispatch"].collect()} == {"crawls_high"}
    assert jobs.import_tasks(docs, stored, snaps, F.lit("2024-01-01").cast("timestamp"), F.lit(True))["dispatch"].count() == 0
    assert jobs.sync_tasks(docs, stored).first().status == "success"


def test_pages_are_read_in_runs(spark, tmp_path):
    """Many pages make few tasks; every page is read, one that is short or absent ends nothing."""
    from skeinwork.sources import pages

    held = {s: [f"u{s + i}" for i in range(2)] for s in range(0, 600, 2) if s != 40} | {600: ["u600"], 50: ["u50"]}
    for s, uids in held.items():
        (tmp_path / f"{s}.json").write_text(json.dumps({"items": [{"uid": u, "taskParameters": {"é": [1]}, "runAt": None} if u == "u3" else {"uid": u} for u in uids], "runAt": "2024"}))
    docs = pages.task_pages(spark, str(tmp_path), limit=2, total="601")
    got = {r.uid: r for r in docs.collect()}
    assert docs.count() == len(got) and set(got) == {u for uids in held.values() for u in uids} and docs.rdd.getNumPartitions() <= 5
    assert (got["u3"].runAt, got["u3"].taskParameters, got["u4"].runAt, got["u4"].taskParameters) == (None, '{"\\u00e9": [1]}', "2024", None)
    for tasks, n in ((1, 5), (8, 8), (10**6, 301)):
        runs = pages.PageReader({"limit": "2", "total": "601", "tasks": str(tasks)}).partitions()
        assert len(runs) in (n, n - 1) and [r.end for r in runs] == [*[r.start for r in runs[1:]], 601]
    assert pages.PageReader({"limit": "2", "total": "0", "tasks": "4"}).partitions() == []


def test_control_rules(spark):
    stored = frame(spark, "task", {"id": 1, "uid": "r", "status": "running", "snapshot_id": 1}, {"id": 2, "uid": "p", "status": "paused"}, {"id": 3, "uid": "n", "status": "running"})
    cases = [("crawl_suspend", "r", "paused"), ("crawl_suspend", "p", "failed"), ("crawl_suspend", "n", "failed"), ("crawl_resume", "p", "running"), ("crawl_resume", "r", "failed"), ("crawl_cancel", "p", "cancelled"), ("crawl_stop", "x", "failed"), ("crawl_stop", None, "failed"), ("crawl_stop", "r", "stopped")]
    df = spark.createDataFrame([(str(i), a, json.dumps({"target_task_uid": t}) if t else None, w) for i, (a, t, w) in enumerate(cases)], "uid string, action string, taskParameters string, want string")
    for r in Q.controlled(df, stored).collect():
        assert r.control_status == r.want and (r.control_message is not None) == (r.want == "failed"), r


def test_exports_are_known_by_their_prefix(spark):
    t = spark.createDataFrame([("crawl_run",), ("export_elsewhere",), ("nothing",), (None,)], "action string")
    assert {r.action: r.dispatch_status for r in Q.routed(t).collect()} == {"crawl_run": "dispatched", "export_elsewhere": "dispatched", "nothing": "failed", None: "failed"}


def test_requeue_and_lifecycle(spark):
    t = frame(spark, "task", {"uid": "a", "status": "failed", "action": "crawl_run", "updateTime": "2024-01-02T00:00:00Z"}, {"uid": "b", "status": "failed", "action": "x", "updateTime": "2024-01-01T00:00:00Z"}, {"uid": "c", "status": "running"})
    out = jobs.requeue_failed(t, 1)
    assert [r.uid for r in out["requeue"].collect()] == ["b"] and out["counts"].first().found == 1
    done = spark.createDataFrame([("c", None), ("a", "boom")], "uid string, error string")
    got = {r.uid: (r.status, r.resultDescription) for r in Q.lifecycle(t, done, F.lit("2024-01-01").cast("timestamp")).collect()}
    assert got == {"a": ("failed", "boom"), "b": ("failed", None), "c": ("success", None)}


def test_documents(spark):
    snap = frame(spark, "snapshot", {"id": 1, "website_id": 2, "uid": "s", "crawlStartTimestamp": "2024-01-01T00:00:00Z", "replay_collection_id": "c"})
    site = frame(spark, "website", {"id": 2, "url": "http://w/", "name": "w", "website_crawl_parameters_id": 3})
    w = frame(spark, "warc", {"snapshot_id": 1, "filename": "b", "sha256": ""}, {"snapshot_id": 1, "filename": "a", "sha256": "x"})
    s = Z.snapshots(snap, site, w)
    d = s.first().document
    assert (d.publicationStatus, d.crawlStartTimestamp, d.replayRelativeUrl, [x.filename for x in d.warcs], d.warcs[1].sha256, d.metadataTechnical.crawled) == ("none", "2024-01-01T00:00:00Z", "c/http://w/", ["a", "b"], None, 0)
    sites = Z.websites(site, spark.createDataFrame([(2, 8), (2, 7)], "website_id long, tag_id long"), spark.createDataFrame([(7, "x"), (8, "y")], "id long, name string"))
    assert [t.name for t in sites.first().document.tags] == ["x", "y"]
    params = frame(spark, "website_crawl_parameters", {"id": 3, "scope_type": "page", "start_urls": [], "max_depth": 0, "page_load_timeout": 5, "auto_scroll": True, "time_limit": 0, "user_agent": "", "exclude_text_matches": ["a"], "extra_config": {"more": "[1]", "browserSettings": "{}"}})
    c = Z.crawl_configs(params)
    assert json.loads(c.first().document) == {"crawlEngine": "browsertrix", "engineConfig": {"crawlScope": {"type": "page", "startUrls": [], "maxDepth": 0, "excludePages": {"textMatches": ["a"]}}, "pageBehavior": {"autoScroll": True, "pageLoadLimitMs": 5000}, "more": [1], "browserSettings": {}}}
    whole = json.loads(Z.task_parameters(s, sites, c).first().parameters)
    assert whole["crawlConfigId"] == 3 and whole["websiteId"] == 2 and whole["crawlConfig"]["crawlEngine"] == "browsertrix"
    task = frame(spark, "task", {"uid": "t", "snapshot_id": 1, "taskParameters": json.dumps({"crawlConfig": {"crawlEngine": "browsertrix", "engineConfig": {"crawlScope": {"startUrls": [], "excludePages": {"textMatches": ["a"], "regexMatches": ["b"]}}, "crawlLimits": {"sizeLimitGB": 0.5}, "pageBehavior": {"autoScroll": True, "delayAfterPageLoadMs": 1999}, "zz": {"q": 1}}}})}, {"uid": "u"})
    got = {r.uid: r for r in Z.crawler_configs(task, snap, site).collect()}
    assert json.loads(got["t"].config) == {"seeds": ["http://w/"], "scopeType": "page", "exclude": ["a", "b"], "sizeLimit": 1 << 29, "behaviors": ["autoscroll"], "postLoadDelay": 1, "generateCDX": True, "collection": "c", "cwd": "/crawls"}
    assert got["u"].config is None and got["u"].error
    back = Z.parameters_from_documents(task).first()
    assert (back.extra_config, back.exclude_regex_matches, back.size_limit_gb, back.auto_click) == ({"zz": '{"q":1}'}, ["b"], 0.5, False)


def test_dashboard(spark):
    snap = frame(spark, "snapshot", {"id": 1, "website_id": 2, "created_at": "2024-01-01T00:00:00Z", "crawl_stats": json.dumps({"crawled": 4, "health": {"log_stalled": True}, "http_status": {"200": 3}})}, {"id": 2, "created_at": "2024-01-02T00:00:00Z"})
    a, b = L.cards(snap, frame(spark, "website", {"id": 2, "name": "w"})).collect()
    assert (a.id, a.note, b.crawled, b.badges, b.status_chart["values"]) == (2, "No crawl statistics yet", 4, ["log_stalled"], [3])
    assert [(r.key, r.n) for r in L.count_rows(snap, "http_status").collect()] == [("200", 3)]
    with pytest.raises(Exception, match="expected one row"):
        L.exactly_one(snap).collect()
    assert L.exactly_one(snap.where("id = 1")).count() == 1


def test_sinks(spark, tmp_path):
    t = sinks.VersionedTable(spark, str(tmp_path / "t"))
    assert t.read() is None
    write = sinks.latest_wins(t, ["id"])
    write(spark.createDataFrame([(1, "a")], "id long, x string"), 0)
    write(spark.createDataFrame([(1, "b"), (2, "c")], "id long, x string"), 1)
    assert sorted(map(tuple, t.read().collect())) == [(1, "b"), (2, "c")]

    def send(method, url, payload):
        if "bad" in url:
            raise OSError("no route")
        return (200 if payload else 500), "ok"

    rows = spark.createDataFrame([(1, "{}", "u"), (2, "", "u"), (3, "{}", "bad")], "task_id long, payload string, url string")
    deliver = sinks.deliver_batches(str(tmp_path / "d"), "task_id", F.col("url"), "PUT", send)
    deliver(rows, 0)
    deliver(rows, 0)
    got = {r.task_id: (r.http_status, r.success, r.error_message) for r in spark.read.parquet(str(tmp_path / "d")).collect()}
    assert got == {1: (200, True, ""), 2: (500, False, ""), 3: (None, False, "no route")} and spark.read.parquet(str(tmp_path / "d")).count() == 3
    y = spark.createDataFrame([('{"seeds":["a"],"depth":2}',), (None,)], "j string").select(sinks.yaml_text(F.col("j"))).collect()
    assert [r[0] for r in y] == ['seeds:\n- "a"\ndepth: 2\n', None]


def test_enumerations(spark):
    bad = violations(frame(spark, "task", {"uid": "a", "status": "running"}, {"uid": "b", "status": "canceled"}, {"uid": "c"}), "task")
    assert [r.uid for r in bad.collect()] == ["b"]
