import hashlib
import json
from os.path import splitext
from urllib.parse import urlparse

import pytest
from pyspark.sql import functions as F

from skeinwork.functions import collections as C
from skeinwork.functions import numbers as N
from skeinwork.functions import text as X
from skeinwork.functions import times as T

URLS = [
    "http://a.b/x.PDF", "http://a.b/", "http://a.b", "http://a.b/.bashrc", "http://a.b/d.ir/file", "http://a.b/x.tar.gz?q=a.b#f.c", "http://a.b/x.html;p=1", "http://a.b/..foo", "a.b/x.js?q",
    "mailto:x@y.z", "http://a.b/a.", "http://a.b/a b.jpg", "//h/p.js", "rel/p.css", "http://a.b/x;y/z.png", "http://a.b/%2Ejs", "http://a.b/é.Jpg", "http://a.b/...x.y", "http://a.b/x.js?", "urn:a.b",
]


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


def test_url_extension_is_that_of_the_standard_library(spark):
    rows = spark.createDataFrame([(u,) for u in URLS], "u string").select("u", X.url_extension(F.col("u")).alias("e")).collect()
    for r in rows:
        assert r["e"] == (splitext(urlparse(r["u"]).path)[1].lower() or "html"), r["u"]


LINES = ['pre {"a":1}', '{"a":1} trailing', '{"a":1', "none", '{"a":NaN}', '{"a":1} junk}', '{"a":2}  ', "[1]", ""]


@pytest.mark.parametrize("strict", [False, True])
def test_decode_keeps_only_objects(spark, strict):
    df = spark.createDataFrame([(x,) for x in LINES], "line string").withColumn("p", X.payload(F.col("line"))).where("p is not null")
    got = sorted(r["line"] for r in X.decode(df, "p", "a double", strict=strict).collect())

    def good(x):
        try:
            json.loads(x[x.index("{") :])
            return True
        except ValueError:
            return False

    expected = [x for x in LINES if "{" in x and good(x)]
    assert got == sorted(expected + ([] if strict else ['{"a":1} junk}']))


def test_text_helpers(spark):
    r = one(
        spark, X.strip(F.lit(" \t a b\n")).alias("s"), X.split_pipes(F.lit("a||b|")).alias("p"), X.split_pipes(F.lit(None).cast("string")).alias("n"), X.join_pipes(F.array(F.lit("a"), F.lit("b"))).alias("j"),
        X.contains_ignoring_case(F.lit("50% off"), "%").alias("c"), X.contains_ignoring_case(F.lit("off"), "%").alias("d"), X.whole_number(F.lit("x1")).alias("w"), X.byte_length(F.lit("é")).alias("b"),
        X.join_path(F.lit("a/"), F.lit("b")).alias("q"), X.relative_replay_url(F.lit(None).cast("string"), F.lit("u")).alias("r"), X.sha256_hex(F.lit("x")).alias("h"), X.json_key(F.lit('{"a":{"b":"c"}}'), "a", "b").alias("k"),
    )
    assert (r.s, r.p, r.n, r.j, r.c, r.d, r.w, r.b, r.q, r.r, r.k) == ("a b", ["a", "b"], [], "a|b", True, False, None, 2, "a/b", "None/u", "c")
    assert r.h == hashlib.sha256(b"x").hexdigest()


def test_numbers(spark):
    none = F.lit(None).cast("bigint")
    cpus = F.array(F.lit(1), F.lit(1))
    r = one(
        spark, N.cpu_percent(F.lit(200), F.lit(100), F.lit(1000), F.lit(500), cpus).alias("a"), N.cpu_percent(F.lit(100), F.lit(100), F.lit(1000), F.lit(500), cpus).alias("b"),
        N.cpu_percent(F.lit(200), none, F.lit(1000), none, F.lit(None).cast("array<int>")).alias("c"), N.memory_percent(F.lit(1), F.lit(0)).alias("d"), N.memory_percent(F.lit(1), F.lit(4)).alias("e"),
        N.gigabytes_to_bytes(F.lit(1.5)).alias("f"), N.whole_seconds(F.lit(1999)).alias("g"), N.human_size(F.lit(0)).alias("h"), N.human_size(F.lit(1536)).alias("i"), N.ratio(F.lit(3), F.lit(0)).alias("j"),
    )
    assert (r.a, r.b, r.c, r.d, r.e, r.f, r.g, r.h, r.i, r.j) == (40.0, 0.0, 20.0, 0.0, 25.0, 1610612736, 1, "0 bytes", "1.5 KB", 3.0)
    assert N.python_round(2.675, 2) == round(2.675, 2) == 2.67


def test_times(spark):
    rows = spark.createDataFrame([("2024-01-02T03:04:05Z",), ("2024-01-02T03:04:05.250000+01:00",), ("2024-01-02",), ("bad",), (None,)], "t string")
    got = [r[0] for r in rows.select(T.to_iso(T.from_iso(F.col("t")))).collect()]
    assert got == ["2024-01-02T03:04:05Z", "2024-01-02T02:04:05.250000Z", "2024-01-02T00:00:00Z", None, None]


def test_collections(spark):
    m = F.create_map(F.lit("a"), F.lit("1"), F.lit("crawlScope"), F.lit("2"), F.lit("n"), F.lit(None).cast("string"))
    nets = F.create_map(F.lit("x"), F.struct(F.lit(1).cast("long").alias("rx")), F.lit("y"), F.struct(F.lit(2).cast("long").alias("rx")))
    io = F.array(*[F.struct(F.lit(o).alias("op"), F.lit(v).cast("long").alias("value")) for o, v in (("Read", 1), ("read", 2), ("Write", 4))])
    r = one(
        spark, C.residual(m).alias("a"), C.without_nulls(m).alias("b"), C.merged(m, F.create_map(F.lit("a"), F.lit("9"))).alias("c"), C.network_total(nets, "rx").alias("d"), C.block_total(io, "Read").alias("e"),
        C.block_total(io, "Read", True).alias("f"), C.concatenated(F.lit(None).cast("array<string>"), F.array(F.lit("z"))).alias("g"), C.labels_and_values(C.without_nulls(m)).alias("h"),
    )
    assert r.a == {"a": "1", "n": None} and r.b == {"a": "1", "crawlScope": "2"} and r.c == {"a": "9", "crawlScope": "2", "n": None}
    assert (r.d, r.e, r.f, r.g) == (3, 1, 3, ["z"]) and r.h.labels == ["a", "crawlScope"]
