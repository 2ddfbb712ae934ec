"""Line, archive and file readers at their edges; the plan of the decoder; control of a running monitor."""

import gzip
import json
import random

import pytest
from pyspark.sql import functions as F

from skeinwork import session
from skeinwork.functions import text as X
from skeinwork.operators import crawl_stats as S
from skeinwork.plans import standins, workload
from skeinwork.sources import files, lines, warc
from skeinwork.streaming import monitor


def cut(data: bytes):
    """(offset, line, bytes) of the lines of a file, \\n alone ending one."""
    out, at = [], 0
    for raw in data.split(b"\n"):
        n = len(raw) + (at + len(raw) < len(data))
        if n:
            out.append((at, raw.decode("utf-8", "replace").rstrip("\r"), n))
        at += n
    return out


@pytest.mark.parametrize("split", [None, 100])
def test_lines_of_split_files_keep_their_positions(spark, tmp_path, split):
    r = random.Random(1)
    big = b"\n".join(b"x" * r.randrange(0, 60) + random.Random(i).choice([b"", b"\r", b"\xff", "é".encode(), b"a\rb"]) for i in range(400))
    held = {"a.log": big, "b.log": b"one\r\ntwo\rstill two\n\nlast without end", "c.log": b"", "d.log": b"\n\n", "e.log": big + b"\n"}
    for name, data in held.items():
        (tmp_path / name).write_bytes(data)
    (tmp_path / "f.log.gz").write_bytes(gzip.compress(held["b.log"] + b"\n"))
    (tmp_path / "g.txt").write_bytes(b"no")
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    if split:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        got: dict = {}
        for x in lines.read_lines(spark, str(tmp_path), "*.log").collect():
            got.setdefault(x.path.rsplit("/", 1)[-1], []).append((x.offset, x.line, x.bytes))
        for name, data in held.items():
            assert sorted(got.get(name, [])) == cut(data), name
        assert "g.txt" not in got
        packed = lines.read_lines(spark, str(tmp_path), "*.gz").collect()
        assert [x.line for x in sorted(packed, key=lambda x: x.offset)] == ["one", "two\rstill two", "", "last without end"] and sum(x.bytes for x in packed) == len(held["b.log"]) + 1
        plain = lines.read_text(spark, str(tmp_path), "b.log").collect()
        assert [x.line for x in plain] == [x[1] for x in cut(held["b.log"])]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_the_number_zero_is_no_status(spark):
    rows = [f'k {{"url":"http://a/{i}","status":{s},"mime":"m"}}' for i, s in enumerate(["0", '"0"', " 0 ", "200", '"-"', "null", '"00"'])]
    r = lines.cdx_records(spark.createDataFrame([(x,) for x in rows], "line string"))
    assert r.count() == 7 and {x.http_status: x.n for x in S.http_status_counts(r).collect()} == {"0": 1, "200": 1, "-": 1, "00": 1}


@pytest.mark.parametrize("name", ["context_counts", "error_message_counts", "log_parse_roundtrip", "request_type_pivot", "last_value_per_job", "malformed_line_filter", "level_share"])
def test_a_line_is_parsed_once(spark, name):
    plan = workload.queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_strict_decoding(spark):
    rows = ['{"context":"a"}', '{"context":"b"} trailing', '{"context":"c"} junk}', '{"context":"d"', '{"context":"e"}  ', "no", None, '["x"]', "{}"]
    df = lines.log_records(spark.createDataFrame([(x,) for x in rows], "line string"))
    assert sorted(r.record.context or "" for r in df.collect()) == ["", "a", "c", "e"]
    df = lines.log_records(spark.createDataFrame([(x,) for x in rows], "line string"), strict=True)
    assert sorted(r.record.context or "" for r in df.collect()) == ["", "a", "e"]
    again = X.decode(spark.createDataFrame([('{"x":1}', "kept")], "t string, record string"), "t", "x int")
    assert again.columns == ["t", "record"] and again.first().record.x == 1


def test_fields_of_any_length(spark, tmp_path):
    long = "a" * 3_000_000
    body = f"HTTP/1.1 200 OK\r\nSet-Cookie: {long}\r\nContent-Type: text/css\r\n\r\nbody".encode()
    record = lambda kind, b, more="": f"WARC/1.0\r\nWARC-Type: {kind}\r\nWARC-Target-URI: http://a/\r\nX: {more}\r\nContent-Length: {len(b)}\r\n\r\n".encode() + b + b"\r\n\r\n"
    data = [record("response", body, long), record("metadata", b"z" * 2_000_000), record("response", b"q" * 2_000_000), record("response", body)]
    (tmp_path / "a.warc").write_bytes(b"".join(data))
    (tmp_path / "b.warc.gz").write_bytes(b"".join(map(gzip.compress, data)))
    rows = warc.warc_records(spark, str(tmp_path)).collect()
    for name in ("a.warc", "b.warc.gz"):
        own = sorted((r for r in rows if r.filename == name), key=lambda r: r.offset)
        assert [(r.type, r.status, r.mime) for r in own] == [("response", "200", "text/css"), ("metadata", None, None), ("response", None, None), ("response", "200", "text/css")]


def test_transfer_between_tiers(spark, tmp_path):
    source, target = tmp_path / "in", tmp_path / "out"
    source.mkdir()
    for i in range(5):
        (source / f"{i}.warc.gz").write_bytes(bytes([i]) * 1000 * (i + 1))
    listed = files.warcs(spark, str(source)).collect()
    df = spark.createDataFrame(listed)
    first = sorted(map(tuple, files.transferred(df, str(target)).collect()))
    again = sorted(map(tuple, files.transferred(df, str(target), remove=True).collect()))
    assert [r[:4] for r in first] == [r[:4] for r in again] and not list(source.iterdir()) and len(list(target.iterdir())) == 5
    moved = sorted(map(tuple, files.transferred(df, str(target), remove=True).collect()))  # a lost task's second run
    assert [r[:4] for r in moved] == [r[:4] for r in first]
    gone = files.warcs(spark, str(target)).where("filename < '2'")
    rows = spark.createDataFrame(gone.collect())
    assert [r.removed for r in files.removed(rows).collect()] == [True, True] and not any(r.removed for r in files.removed(rows).collect())
    assert len(list(target.iterdir())) == 3


def test_shared_folders_are_released(spark, tmp_path):
    path = session.shared_folder(spark)
    spark.range(3).write.parquet(path)
    assert spark.read.parquet(path).count() == 3 and session.release(spark) >= 1
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)


def test_a_job_runs_again_and_again(spark, tmp_path):
    runs = []
    q = monitor.every(spark, runs.append, str(tmp_path / "k"), 0.5)
    for _ in range(60):
        if len(runs) >= 2 or q.awaitTermination(1):
            break
    q.stop()
    assert runs[:2] == [0, 1]


def test_control_of_a_running_monitor(spark, tmp_path):
    (tmp_path / "l").mkdir()
    (tmp_path / "l" / "a.log").write_text("".join(json.dumps({"context": "c"}) + "\n" for _ in range(5)))
    seen, started = [], []

    def begin():
        started.append(1)
        return monitor.start(monitor.tail(spark, str(tmp_path / "l"), "*.log"), lambda b, i: seen.extend(b.collect()), str(tmp_path / "k"), 0.2, "append")

    def wanted():
        if not seen:
            return None
        return actions.pop(0) if actions else "crawl_cancel"

    actions = ["crawl_suspend", "crawl_suspend", "crawl_resume", "crawl_resume"]
    assert monitor.governed(begin, wanted, 0.1) == "crawl_cancel" and len(started) == 2 and len(seen) == 5


def test_standins_hold_their_lines_as_values(spark):
    plan = standins.log_lines(spark, "/root/testdata/sf0.001").where(F.col("line").contains("x"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("get_json_object") == 1


def test_requests(spark):
    from skeinwork.sources import requests as R

    rows = ["tag=a%20b", "?x=1&tag=a+b#f", "tags=1", "tag=", None, "x=tag=1", "tag=%zz"]
    df = spark.createDataFrame([(x,) for x in rows], "q string")
    assert [r[0] for r in df.select(R.query_parameter(F.col("q"), "tag")).collect()] == ["a b", "a b", None, "", None, None, None]
    bodies = spark.createDataFrame([(x,) for x in ('{"a":1}', '{"a":', "[1]", "", None, '{"b":2}')], "b string").select(R.json_body(F.col("b"), "a int").alias("r"))
    assert [r.r and r.r.a for r in bodies.collect()] == [1, None, None, None, None, None]
    tokens = spark.createDataFrame([(x,) for x in ("a.eyJhIjoiw6kifQ.c", "a.b.c", "", None, "a.W10.c", "a.!!!.c")], "t string")
    assert [r[0] for r in tokens.select(R.claims(F.col("t"))).collect()] == ['{"a":"é"}', None, None, None, None, None]
    now, made = [0.0], []
    source = R.TokenSource(lambda: (made.append(1) or f"t{len(made)}", 100), 30, lambda: now[0])
    assert source.get() == source.get() == "t1"
    now[0] = 71
    assert source.get() == "t2" and len(made) == 2


def test_views_are_shown_again(spark):
    seen = []
    monitor.refreshed(lambda: spark.range(len(seen)), seen.append, 0, 3)
    assert [len(x) for x in seen] == [0, 1, 2]


def test_old_versions_go(spark, tmp_path):
    import os

    from skeinwork.operators.sinks import VersionedTable

    table = VersionedTable(spark, str(tmp_path / "t"))
    for k in range(6):
        old = table.read()
        new = spark.createDataFrame([(k, k)], "id long, n long")
        table.replace(new if old is None else old.unionByName(new))
    assert table.read().count() == 6 and sorted(os.listdir(tmp_path / "t")) == ["v4", "v5", "v6"]


def test_saved_pages_of_ids_with_gaps(spark, tmp_path):
    """Ids far apart make short and absent pages; every task is read."""
    from skeinwork.plans import readers

    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    key = F.col("o_orderkey")
    orders.withColumn("o_orderkey", key + F.when(key % 2 == 0, F.lit(7)).otherwise(F.lit(25_000)).cast("long")).write.parquet(str(tmp_path / "orders.parquet"))
    assert {r.status: r.n for r in workload.queries()["task_page_reader"](spark, str(tmp_path)).groupBy("status").agg(F.sum("n").alias("n")).collect()} == {
        "success" if s == "F" else "running" if s == "O" else "failed": n for s, n in orders.groupBy("o_orderstatus").count().collect()
    }
    orders.limit(0).write.parquet(str(tmp_path / "none" / "orders.parquet"))
    assert readers._saved_pages(spark, str(tmp_path / "none"))[1] == 0 and workload.queries()["task_page_reader"](spark, str(tmp_path / "none")).count() == 0
