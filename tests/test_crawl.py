import json
import os
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from skeinwork.operators import container as B
from skeinwork.operators import crawl_stats as S
from skeinwork.operators import metrics as M
from skeinwork.schemas import CONTAINER
from skeinwork.sources import files, lines
from skeinwork.streaming import monitor


def record(i, context="worker", **details):
    return {"timestamp": f"2024-01-01T00:00:{i:02d}Z", "context": context, "logLevel": "info", "message": "Starting page", "details": {"page": f"http://p/{i}", **details}}


@pytest.fixture()
def crawl(tmp_path):
    logs, cdx = tmp_path / "logs", tmp_path / "cdx"
    logs.mkdir()
    cdx.mkdir()
    one = ["x " + json.dumps(record(1)), json.dumps(record(2, "crawlStatus", crawled=3, total=9, pending=1, failed=0, limit={"hit": True})), '{"torn', "no brace", json.dumps({"context": "c", "details": None, "timestamp": "bad", "logLevel": "error", "message": "é"}) + "\r"]
    two = [json.dumps(record(5, "crawlStatus", crawled=4)), json.dumps({"context": "pageStatus", "message": "Page Finished"})]
    (logs / "a.log").write_bytes("\n".join(one).encode() + b"\n")
    (logs / "b.log").write_bytes("\n".join(two).encode())
    rows = [("http://a/x.PDF", 200, "text/html"), ("http://a/", "404", "text/html"), ("http://a/y.js", 0, ""), ("", "-", None)]
    (cdx / "i.cdxj").write_text("\n".join(f"com,a)/ 2024 {json.dumps({'url': u, 'status': s, 'mime': m})}" for u, s, m in rows) + "\n\ncom,a)/ old style line\n")
    return str(logs), str(cdx)


def test_statistics_of_a_crawl(spark, crawl):
    log, cdx = lines.read_log_lines(spark, crawl[0]), lines.read_cdx_lines(spark, crawl[1])
    v = S.volume(log).first()
    assert (v["lines"], v["bytes"]) == (7, sum(os.path.getsize(f"{crawl[0]}/{f}") for f in os.listdir(crawl[0])))
    r = S.report(log, lines.log_records(log), cdx, lines.cdx_records(cdx)).first()
    assert (r.crawled, r.total, r.pending, r.failed, r.limit_hit, r.last_page, r.last_error) == (4, 9, 1, 0, True, "http://p/1", "é")
    assert r.by_http_status == {"200": 1, "404": 1, "-": 1} and r.by_mime == {"text/html": 2} and r.by_url_extension == {".pdf": 1, ".js": 1, "html": 1}
    assert r.by_context == {"worker": 1, "crawlStatus": 2, "c": 1, "pageStatus": 1} and r.success_ratio == 0.333 and r.by_request_type.page_start == 1 and r.cdx_lines == 6
    derived = spark.range(1).select(F.lit(1.5).alias("cdx_entries_per_sec"), F.lit(2.0).alias("cdx_bytes_per_sec"), *[F.lit(False).alias(c) for c in ("log_stalled", "cdx_stalled", "js_heavy")])
    stored = json.loads(S.stored_report(S.report(log, lines.log_records(log), cdx, lines.cdx_records(cdx)), derived, F.lit("2024-01-01").cast("timestamp")).first()[0])
    assert stored["mime_distribution"] == stored["by_mime"] == {"text/html": 2} and stored["updated_at"] == "2024-01-01T00:00:00Z"


def test_missing_directory_has_no_lines(spark, tmp_path):
    assert lines.read_log_lines(spark, str(tmp_path / "no")).count() == 0
    r = S.volume(lines.read_log_lines(spark, str(tmp_path / "no"))).first()
    assert (r["lines"], r["bytes"]) == (0, 0)
    assert files.warcs(spark, str(tmp_path / "no")).count() == 0


def test_shares_sum_to_one(spark):
    df = spark.createDataFrame([("a", n) for n in (1, 2, 3)] + [("b", 7)], "g string, n long")
    out = S.shares(df, ("g",)).groupBy("g").agg(F.sum("share").alias("s")).collect()
    assert all(abs(r.s - 1) < 1e-12 for r in out)


def test_rates_and_flags(spark):
    rows = [(1, "2024-01-01 00:00:00", 10, 100, 5, 50), (1, "2024-01-01 00:00:10", 30, 300, 5, 50), (1, "2024-01-01 00:00:10", 30, 300, 6, 60), (1, "2024-01-01 00:00:20", 30, 300, 16, 70), (2, None, 1, 1, 1, 1), (2, "2024-01-01 00:00:00", 2, 2, 2, 2)]
    df = spark.createDataFrame(rows, "snapshot_id long, t string, log_lines long, log_bytes long, cdx_lines long, cdx_bytes long").withColumn("last_update", F.col("t").cast("timestamp")).withColumn("n", F.monotonically_increasing_id())
    got = [tuple(r) for r in M.derived(df, order=["last_update", "cdx_lines"]).orderBy("snapshot_id", "last_update", "cdx_lines").select("log_entries_per_sec", "cdx_entries_per_sec", "log_stalled", "cdx_stalled", "js_heavy").collect()]
    assert got == [(0.0, 0.0, False, False, False), (2.0, 0.0, False, True, True), (0.0, 0.0, False, False, False), (0.0, 1.0, True, False, False), (0.0, 0.0, False, False, False), (0.0, 0.0, False, False, False)]


def test_running_values_in_buckets_equal_plain_ones(spark):
    r = random.Random(1)
    rows = [(r.choice(["a", "b"]), i, r.choice([None, i, 2 * i])) for i in range(300)]
    df = spark.createDataFrame(rows, "job string, n long, v long")
    for f in (M.running, M.carried):
        plain = sorted(map(tuple, f(df, "job", ["n"], x="v").collect()), key=lambda t: t[1])
        for width in (1, 7, 1000):
            assert sorted(map(tuple, f(df, "job", ["n"], bucket=F.floor(F.col("n") / width), x="v").select("job", "n", "v", "x").collect()), key=lambda t: t[1]) == plain


def container(**stats):
    return {"id": "1", "name": "n", "status": "running", "attrs": {"State": {"Running": True}, "Config": {"Image": "i"}}, "stats": stats}


def test_container_documents(spark):
    cpu = lambda t, s, p=None: {"cpu_usage": {"total_usage": t, "percpu_usage": p}, "system_cpu_usage": s}
    docs = [
        container(cpu_stats=cpu(300, 2000, [1, 1]), precpu_stats=cpu(100, 1000), memory_stats={"usage": 1, "limit": 3}, networks={"e": {"rx_bytes": 1, "tx_bytes": 2}, "f": {"rx_bytes": 3, "tx_bytes": 4}}, blkio_stats={"io_service_bytes_recursive": [{"op": "Read", "value": 5}, {"op": "read", "value": 9}]}),
        container(cpu_stats=cpu(100, 2000), precpu_stats=cpu(100, 1000), memory_stats={"usage": 1, "limit": 0}, networks=None),
        {"id": "2", "name": "x", "status": "exited", "attrs": {"State": {"Running": False, "ExitCode": 137}}, "stats": {"memory_stats": {"usage": 5, "limit": 5}}},
        {"id": "3", "name": "y", "available": False},
    ]
    df = spark.createDataFrame([(json.dumps(d),) for d in docs], "j string").select(F.from_json("j", CONTAINER).alias("c")).select("c.*")
    a, b, c, d = B.payload(df, F.lit("2024-01-01").cast("timestamp")).collect()
    assert (a.resources.cpu_percent, a.resources.memory.percent, a.io.network.rx_bytes, a.io.network.tx_bytes, a.io.block.read_bytes) == (40.0, 33.33, 4, 6, 5)
    assert (b.resources.cpu_percent, b.resources.memory.percent, b.io.network.rx_bytes) == (0.0, 0.0, 0)
    assert (c.state.exit_code, c.resources.memory.usage_bytes) == (137, 0) and (d.state.status, d.error, d.resources) == ("unknown", "Container metadata unavailable", None)


def test_stream_equals_batch_for_any_split(spark, tmp_path):
    """The tail source delivers torn lines once, whole, over restarts; counters and last values equal the batch's."""
    logs, cdx = tmp_path / "l", tmp_path / "c"
    logs.mkdir()
    cdx.mkdir()
    data = "".join(json.dumps(record(i % 60, random.Random(i).choice(["worker", "crawlStatus"]), crawled=i, total=2 * i)) + "\n" for i in range(60)).encode()
    index = b'k {"url":"http://a/b.css","status":"200","mime":"text/css"}\n' * 20
    monitor.state_store(spark)
    seen, polls = [], []
    for step in range(3):
        end = [len(data) // 3 + 7, 2 * len(data) // 3 + 5, len(data)][step]
        (logs / "a.log").write_bytes(data[:end])
        (cdx / "i.cdxj").write_bytes(index[: 300 * (step + 1)])
        q = monitor.start(monitor.lines(spark, str(logs), str(cdx), 7), lambda b, i: seen.extend(b.collect()), str(tmp_path / "k1"), None)
        q.awaitTermination()
        q = monitor.start(monitor.polls(monitor.lines(spark, str(logs), str(cdx), 7)), lambda b, i: polls.extend(b.collect()), str(tmp_path / "k2"), None)
        q.awaitTermination()
    own = [r for r in seen if r.src == "log"]
    assert [r.line for r in sorted(own, key=lambda r: r.offset)] == data.decode().splitlines() and sum(r.bytes for r in own) == len(data)
    batch = lines.read_log_lines(spark, str(logs))
    want = S.last_values(lines.log_records(batch)).first()
    last = polls[-1]
    assert (last.crawled, last.total, last.last_page, last.log_lines) == (want.crawled, want.total, want.last_page, 60)
    assert last.cdx_lines == len(index[:900].splitlines()) - (not index[:900].endswith(b"\n"))
    contexts = Counter(json.loads(r.line)["context"] for r in own)
    assert {r.context: r.n for r in S.context_counts(lines.log_records(batch)).collect()} == contexts


def test_lines_are_combined_before_they_meet(spark):
    """A crawl's task gets a bounded number of rows from each partition, which say what all its lines say."""
    import pandas as pd
    import pyarrow as pa

    r = random.Random(3)
    schema = "snapshot_id long, src string, path string, offset long, lines long, bytes long, seen_update timestamp, crawled long, total long, pending long, failed long, limit_hit boolean, last_page string"
    rows = [(r.choice([7, 8, None]), r.choice(["log", "cdx"]), r.choice("abc"), i, 1, r.randrange(99), None, *[r.choice([None] * 40 + [2**60 + i]) for _ in range(4)], r.choice([None] * 40 + [True, False]), r.choice([None, None, f"p{i}"])) for i in range(3000)]
    df = spark.createDataFrame(rows, schema)
    def said(held):
        out = {}
        for x in sorted(held, key=lambda x: (x.path or "", -1 if x.offset is None else x.offset)):
            own = out.setdefault(x.snapshot_id, Counter())
            own[x.src, "lines"] += x.lines
            own[x.src, "bytes"] += x.bytes
            for c in monitor.VALUES:
                if x[c] is not None:
                    own[c] = x[c]
        return out

    parts = monitor.poll_parts(df.repartition(4, "offset")).collect()
    assert said(parts) == said(df.collect()) and len(parts) <= 4 * 3 * (2 + len(monitor.VALUES))
    table = pa.Table.from_pandas(pd.DataFrame(rows, columns=df.columns).astype({"snapshot_id": "Int64", **{c: "Int64" for c in ("crawled", "total", "pending", "failed")}}))
    once = monitor.combined(table.set_column(6, "seen_update", pa.nulls(len(table), pa.timestamp("us"))))
    assert sorted(map(str, monitor.combined(once).to_pylist())) == sorted(map(str, once.to_pylist())) and monitor.combined(once.slice(0, 0)).num_rows == 0


def test_file_sources(spark, tmp_path):
    import hashlib

    (tmp_path / "a.warc.gz").write_bytes(b"abc")
    (tmp_path / "b.warc").write_bytes(b"d")
    (tmp_path / "c.txt").write_bytes(b"e")
    got = {r.filename: r.size_bytes for r in files.warcs(spark, str(tmp_path)).collect()}
    assert got == {"a.warc.gz": 3, "b.warc": 1}
    d = files.digests(spark, str(tmp_path), "*.warc*").withColumn("again", files.chunked_sha256("path")).collect()
    assert len(d) == 2 and all(r.sha256 == r.again for r in d) and hashlib.sha256(b"d").hexdigest() in {r.sha256 for r in d}
