"""A batch source over a paged task API, a partition for each run of pages.

A page is fetched by `start` and `limit` until one comes back short. The transport is a class path or a folder of saved pages
(`<start>.json`), so that tests and replays need no network.
"""

from __future__ import annotations

import json
import os
from importlib import import_module
from urllib.parse import urlencode
from urllib.request import Request, urlopen

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..schemas import TASK_DOCUMENT

LIMIT, TIMEOUT = 50, 10
FIELDS = [f.split()[0] for f in TASK_DOCUMENT.split(", ")]
#: Pages of a partition at most. One is read at a time, so memory is that of a page.
RUN = 64


def saved_pages(options: dict, start: int, limit: int) -> dict:
    path = os.path.join(options["path"], f"{start}.json")
    if not os.path.exists(path):
        return {"items": []}
    with open(path) as f:
        return json.load(f)


def http_pages(options: dict, start: int, limit: int) -> dict:
    query = {"start": start, "limit": limit} | ({"whereStatus": options["wherestatus"]} if options.get("wherestatus") else {})
    request = Request(f"{options['path'].rstrip('/')}?{urlencode(query)}", headers={"Accept": "application/json"} | ({"Authorization": f"Bearer {t}"} if (t := options.get("token")) else {}))
    with urlopen(request, timeout=TIMEOUT) as reply:
        return json.load(reply)


def fetcher(options: dict):
    if name := options.get("fetcher"):
        module, _, attribute = name.rpartition(".")
        return getattr(import_module(module), attribute)
    return http_pages if "://" in options["path"] else saved_pages


class Page(InputPartition):
    def __init__(self, start: int, end: int = -1):
        self.start, self.end = start, end


class PageReader(DataSourceReader):
    def __init__(self, options: dict):
        self.options, self.limit = options, int(options.get("limit", LIMIT))

    def partitions(self) -> list[Page]:
        """Runs of pages where the number of rows is told, `tasks` of them or more; else a single partition that goes on until a short page."""
        if not (total := self.options.get("total")):
            return [Page(-1)]
        pages = -(-int(total) // self.limit)
        rows = max(1, min(RUN, -(-pages // int(self.options.get("tasks", pages or 1))))) * self.limit
        return [Page(s, min(s + rows, int(total))) for s in range(0, int(total), rows)]

    def read(self, partition: Page | None):
        if partition is None:  # what Spark gives where there are no partitions
            return
        fetch, start = fetcher(self.options), max(partition.start, 0)
        while True:
            page = fetch(self.options, start, self.limit)
            items = page.get("items") or []
            absent = {"runAt": page.get("runAt")}
            columns = [pa.array([self._cell(item.get(f, absent.get(f))) for item in items], pa.string()) for f in FIELDS]
            yield pa.RecordBatch.from_arrays(columns, FIELDS)
            start += self.limit
            if start >= partition.end if partition.start >= 0 else len(items) < self.limit:
                return

    @staticmethod
    def _cell(x):
        return x if x is None or isinstance(x, str) else json.dumps(x)


class PageSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "task_pages"

    def schema(self):
        return TASK_DOCUMENT

    def reader(self, schema) -> PageReader:
        return PageReader(self.options)


def task_pages(spark: SparkSession, path: str, statuses: list[str] | None = None, limit: int = LIMIT, **options) -> DataFrame:
    """Task documents of the API at path; statuses are joined by pipes."""
    spark.dataSource.register(PageSource)
    reader = spark.read.format("task_pages").option("limit", str(limit)).option("tasks", str(spark.sparkContext.defaultParallelism))
    if statuses:
        reader = reader.option("whereStatus", "|".join(statuses))
    return reader.options(**options).load(path)
