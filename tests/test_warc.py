import gzip
import json

from skeinwork.sources import warc


def record(kind, url, body, **more):
    head = {"WARC-Type": kind, "WARC-Target-URI": url, "WARC-Date": "2024-01-02T03:04:05Z", "Content-Length": str(len(body)), **more}
    return b"WARC/1.0\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head.items()).encode() + b"\r\n" + body + b"\r\n\r\n"


def response(status, mime, size):
    return f"HTTP/1.1 {status} X\r\nContent-Type: {mime}; charset=x\r\n\r\n".encode() + b"z" * size


RECORDS = [record("warcinfo", "", b"a: b"), record("response", "http://A.example/x?q=1", response(200, "text/html", 3_000_000)), record("response", "http://b.c.example", response(404, "text/plain", 5)), record("request", "http://b.c.example", b"GET")]


def test_records_of_plain_and_packed_files(spark, tmp_path):
    (tmp_path / "a.warc").write_bytes(b"".join(RECORDS))
    packed = [gzip.compress(r) for r in RECORDS]
    (tmp_path / "b.warc.gz").write_bytes(b"".join(packed) + packed[1][:50])  # the last one breaks off
    (tmp_path / "c.warc").write_bytes(b"")
    rows = warc.warc_records(spark, str(tmp_path)).collect()
    for name, sizes in (("a.warc", [len(r) for r in RECORDS]), ("b.warc.gz", [len(p) for p in packed])):
        own = sorted((r for r in rows if r.filename == name), key=lambda r: r.offset)
        assert [r.offset for r in own] == [sum(sizes[:i]) for i in range(4)] and [r.length for r in own] == sizes
        assert [(r.type, r.status, r.mime) for r in own][1:3] == [("response", "200", "text/html"), ("response", "404", "text/plain")]
    lines = sorted(r.line for r in warc.cdx_lines(warc.warc_records(spark, str(tmp_path))).collect())
    assert len(lines) == 4 and lines[0].startswith("example,a)/x?q=1 20240102030405 {") and json.loads(lines[0].split(" ", 2)[2])["status"] == "200"
    assert lines[2].startswith("example,c,b)/ ")
