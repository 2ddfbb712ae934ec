"""WARC files to CDX rows: the records of each file with the place where they begin, read by path in one pass.

Plain files and files of one gzip member a record are read in steps of a megabyte, so the size of a file or record doesn't
matter. A file that breaks off gives the records before the break.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .files import warcs

STEP = 1 << 20
SCHEMA = "filename string, offset long, length long, type string, url string, date string, mime string, status string, payload_digest string"
END = b"\r\n\r\n"


def _told(head: bytes) -> bool:
    """Whether the start of a record says all that is asked: its own fields and, of an HTTP response, those of the reply."""
    own, end, body = head.partition(END)
    if not end:
        return False
    return _fields(own).get("warc-type") != "response" or END in body or len(body) > 5 and not body.startswith(b"HTTP/")


def _members(path: str) -> Iterator[tuple[int, int, bytes]]:
    """(offset, length in the file, content up to the end of its fields at least) of each record. Fields of any length are read whole; content isn't kept."""
    with open(path, "rb") as f:
        packed = f.read(2) == b"\x1f\x8b"
        f.seek(0)
        data, at, ended = b"", 0, False
        while True:
            if not data and not ended:
                data = f.read(STEP)
                ended = not data
            if not data:
                return
            head, told, used = b"", False, 0
            if packed:
                z = zlib.decompressobj(31)
                while not z.eof:
                    try:
                        out = z.decompress(data, STEP)
                    except zlib.error:
                        return
                    if not told:
                        head += out
                        told = _told(head)
                    rest = z.unused_data if z.eof else z.unconsumed_tail
                    used += len(data) - len(rest)
                    data = rest
                    if not z.eof and not data:
                        data = f.read(STEP)
                        if not data:
                            return
                yield at, used, head
            else:
                while END not in data and (more := f.read(STEP)):
                    data += more
                end = data.find(END)
                if end < 0:
                    return
                size = next((int(x.split(b":", 1)[1]) for x in data[:end].split(b"\r\n") if x.lower().startswith(b"content-length:")), 0)
                used = end + 4 + size + 4
                while len(data) < used and not _told(data[:used]) and (more := f.read(STEP)):
                    data += more
                yield at, used, data[:used]
                if len(data) < used:
                    f.seek(at + used)
                    data = b""
                else:
                    data = data[used:]
            at += used


def _fields(head: bytes) -> dict[str, str]:
    lines = head.split(END, 1)[0].decode("utf-8", "replace").split("\r\n")
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}


def records(path: str) -> Iterator[tuple]:
    for offset, length, head in _members(path):
        own = _fields(head)
        kind, mime, status = own.get("warc-type"), own.get("content-type"), None
        if kind == "response":
            body = head.partition(END)[2]
            first = body.split(b"\r\n", 1)[0].split(b" ")
            status = first[1].decode("ascii", "replace") if len(first) > 1 and first[0].startswith(b"HTTP/") else None
            mime = _fields(body).get("content-type", "").split(";")[0].strip() or None
        yield path.rsplit("/", 1)[-1], offset, length, kind, own.get("warc-target-uri"), own.get("warc-date"), mime, status, own.get("warc-payload-digest")


def warc_records(spark: SparkSession, directory: str) -> DataFrame:
    """One row a record of every WARC file of a directory; files are spread over tasks."""
    def each(batches):
        import pyarrow as pa

        kinds = [pa.string(), pa.int64(), pa.int64(), *[pa.string()] * 6]
        for batch in batches:
            for path in batch.column(0).to_pylist():
                held = []
                for r in records(path.removeprefix("file:")):
                    held.append(r)
                    if len(held) >= 10_000:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), kinds)], names=[x.split()[0] for x in SCHEMA.split(", ")])
                        held = []
                if held:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), kinds)], names=[x.split()[0] for x in SCHEMA.split(", ")])

    return warcs(spark, directory).select("path").mapInArrow(each, SCHEMA)


def cdx_lines(records_: DataFrame) -> DataFrame:
    """The responses as CDXJ lines, in the form that `lines.cdx_records` reads."""
    own = records_.where("type = 'response'")
    stamp = F.regexp_replace("date", "[^0-9]", "")
    host = F.lower(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/:?#]*)", 1))
    path = F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*(.*)$", 1)
    key = F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), F.when(path == "", "/").otherwise(path))
    document = F.to_json(F.struct("url", "mime", "status", F.col("payload_digest").alias("digest"), F.col("length").cast("string").alias("length"), F.col("offset").cast("string").alias("offset"), "filename"))
    return own.select(F.concat_ws(" ", key, stamp, document).alias("line"))


