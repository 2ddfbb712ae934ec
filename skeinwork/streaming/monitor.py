"""The live crawl monitor: log and CDX lines in one stream, statistics in state, rates from poll to poll.

State is bounded by the number of crawls and of distinct keys. Restarts go on from the checkpoint: the source at its byte, the
counters at their value.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from ..functions import text as X
from ..operators import crawl_stats as S
from ..schemas import LOG_RECORD
from ..sources.lines import cdx_records, log_records
from ..sources.tail import tail

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"


def lines(spark: SparkSession, logs: str, indexes: str, snapshot_id: int) -> DataFrame:
    """Both streams of a crawl as one, told apart by src."""
    log = tail(spark, logs, "*.log").withColumn("src", F.lit("log"))
    cdx = tail(spark, indexes, "*.cdx,*.cdxj").withColumn("src", F.lit("cdx"))
    return log.unionByName(cdx).withColumn("snapshot_id", F.lit(snapshot_id).cast("long"))


def log_events(lines_: DataFrame) -> DataFrame:
    return log_records(lines_.where("src = 'log'"))


def cdx_events(lines_: DataFrame) -> DataFrame:
    return cdx_records(lines_.where("src = 'cdx'"))


def context_counts(lines_: DataFrame) -> DataFrame:
    """Running counts by context: an aggregate in the state store, for the complete or update mode."""
    return S.counts(log_events(lines_), F.col("record.context"), "context", ("snapshot_id",))


def volumes(lines_: DataFrame) -> DataFrame:
    """Running lines and bytes of each source of each crawl."""
    return lines_.groupBy("snapshot_id", "src").agg(F.count("*").alias("lines"), F.sum("bytes").alias("bytes"))


POLL = "snapshot_id long, last_update timestamp, log_lines long, log_bytes long, cdx_lines long, cdx_bytes long, log_entries_per_sec double, log_bytes_per_sec double, cdx_entries_per_sec double, cdx_bytes_per_sec double, log_stalled boolean, cdx_stalled boolean, js_heavy boolean, crawled long, total long, pending long, failed long, limit_hit boolean, last_page string"
_STATE = "seen_update timestamp, base_update timestamp, log_lines long, log_bytes long, cdx_lines long, cdx_bytes long, base_log_lines long, base_log_bytes long, base_cdx_lines long, base_cdx_bytes long, crawled long, total long, pending long, failed long, limit_hit boolean, last_page string"
#: The values of which a poll keeps the last one told.
VALUES = ("crawled", "total", "pending", "failed", "limit_hit", "last_page", "seen_update")
#: Rows of lines that are held before they are combined.
HELD = 1 << 15


class PollProcessor(StatefulProcessor):
    """Totals of a crawl and the baseline of its last poll. A poll whose time didn't move gives zeros and leaves the baseline."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("poll", _STATE)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        names = [c.split()[0] for c in _STATE.split(", ")]
        old = dict(zip(names, self.state.get())) if self.state.exists() else dict.fromkeys(names)
        total = {k: old[k] or 0 for k in ("log_lines", "log_bytes", "cdx_lines", "cdx_bytes")}
        kept = {k: old[k] for k in VALUES}
        frame = pd.concat(list(rows)).sort_values(["path", "offset"], kind="stable")
        for src in ("log", "cdx"):
            own = frame[frame["src"] == src]
            total[f"{src}_lines"] += int(own["lines"].sum())
            total[f"{src}_bytes"] += int(own["bytes"].sum())
        for column in VALUES:
            told = frame[column].dropna()
            if len(told):
                v = told.iloc[-1]
                kept[column] = str(v) if column == "last_page" else bool(v) if column == "limit_hit" else v.to_pydatetime() if column == "seen_update" else int(v)
        now, before = kept["seen_update"], old["base_update"]
        seconds = (now - before).total_seconds() if now is not None and before is not None else 0.0
        rates, flags = dict.fromkeys(total, 0.0), (False, False, False)
        if seconds > 0:
            rates = {k: (total[k] - (old[f"base_{k}"] or 0)) / seconds for k in total}
            same = {k: total[k] == (old[f"base_{k}"] or 0) for k in ("log_lines", "cdx_lines")}
            flags = (same["log_lines"], same["cdx_lines"], not same["log_lines"] and same["cdx_lines"])
        moved = seconds > 0 or before is None and now is not None
        base = {f"base_{k}": total[k] if moved else old[f"base_{k}"] for k in total} | {"base_update": now if moved else before}
        new = {**total, **kept, **base}
        self.state.update(tuple(new[n] for n in names))
        yield pd.DataFrame([{
            "snapshot_id": key[0], "last_update": now, **total, "log_entries_per_sec": rates["log_lines"], "log_bytes_per_sec": rates["log_bytes"], "cdx_entries_per_sec": rates["cdx_lines"],
            "cdx_bytes_per_sec": rates["cdx_bytes"], "log_stalled": flags[0], "cdx_stalled": flags[1], "js_heavy": flags[2],
            **{k: kept[k] or 0 for k in ("crawled", "total", "pending", "failed")}, "limit_hit": bool(kept["limit_hit"]), "last_page": kept["last_page"],
        }])[[c.split()[0] for c in POLL.split(", ")]]

    def close(self) -> None:
        pass


def poll_rows(lines_: DataFrame) -> DataFrame:
    """What a poll needs of each line: all lines count, few have values. `lines` is how many a row stands for."""
    lines_ = X.once(lines_, "record", F.from_json(X.payload(F.col("line")), LOG_RECORD))
    r = F.col("record")
    log, status = F.col("src") == "log", r.context == "crawlStatus"
    start = (r.context == "worker") & (r.message == "Starting page")
    return lines_.select(
        "snapshot_id", "src", "path", "offset", F.lit(1).cast("long").alias("lines"), "bytes", F.when(log, r.timestamp.try_cast("timestamp")).alias("seen_update"),
        *[F.when(log & status, r.details[k]).alias(k) for k in ("crawled", "total", "pending", "failed")], F.when(log & status, r.details.limit.hit).alias("limit_hit"), F.when(log & start, r.details.page).alias("last_page"),
    )


def combined(rows: pa.Table) -> pa.Table:
    """Fewer rows that say the same to a poll: one with the lines and bytes of each source of a crawl, and of each value the row that tells it last, which counts no lines."""
    rows = rows.sort_by([("path", "ascending"), ("offset", "ascending")])
    volume = rows.group_by(["snapshot_id", "src"]).aggregate([("lines", "sum"), ("bytes", "sum")])
    own = {"snapshot_id": volume["snapshot_id"], "src": volume["src"], "lines": volume["lines_sum"], "bytes": volume["bytes_sum"]}
    counts = pa.table([own.get(f.name, pa.nulls(len(volume), f.type)) for f in rows.schema], schema=rows.schema)
    at = pa.array(range(len(rows)), pa.int64())
    told = pa.table({"snapshot_id": rows["snapshot_id"]} | {c: pc.if_else(pc.is_valid(rows[c]), at, None) for c in VALUES})
    ends = told.group_by("snapshot_id").aggregate([(c, "max") for c in VALUES])
    chosen = pc.unique(pc.drop_null(pa.chunked_array([x for c in VALUES for x in ends[f"{c}_max"].chunks], pa.int64())))
    last, none = rows.take(chosen), pa.array([0] * len(chosen), pa.int64())
    last = pa.table([none if f.name in ("lines", "bytes") else last[f.name] for f in rows.schema], schema=rows.schema)
    return pa.concat_tables([counts, last])


def poll_parts(rows: DataFrame) -> DataFrame:
    """Rows of lines combined in the task that reads them, so that the task of a crawl gets some ten rows of each and no lines.

    A partition of many crawls puts out what it holds, combined, whenever that is more than HELD rows.
    """
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        for batch in batches:
            held.append(pa.Table.from_batches([batch]))
            if sum(map(len, held)) > HELD:
                held = [combined(pa.concat_tables(held))]
                if len(held[0]) > HELD // 2:
                    yield from held.pop().to_batches()
        if held:
            yield from combined(pa.concat_tables(held)).to_batches()

    return rows.mapInArrow(each, rows.schema)


def polls(lines_: DataFrame) -> DataFrame:
    """A row for each crawl and micro-batch with rates and flags; needs the RocksDB state store (see `state_store`)."""
    return poll_parts(poll_rows(lines_)).groupBy("snapshot_id").transformWithStateInPandas(statefulProcessor=PollProcessor(), outputStructType=POLL, outputMode="Update", timeMode="None")


def state_store(spark: SparkSession) -> None:
    spark.conf.set(PROVIDER, ROCKSDB)


def start(df: DataFrame, sink, checkpoint: str, seconds: float | None = 5, mode: str = "update"):
    """Runs a stream into a foreachBatch sink every so many seconds, or once over all that is there if seconds is None."""
    writer = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(sink)
    return (writer.trigger(availableNow=True) if seconds is None else writer.trigger(processingTime=f"{seconds} seconds")).start()


def changes(snapshots: DataFrame, key: str = "uid") -> DataFrame:
    """One notification for each changed row of a stream of saved snapshots; repeats of an event are dropped within the watermark."""
    held = snapshots.withColumn("updated_at", F.col("updated_at").cast("timestamp")).withWatermark("updated_at", "10 minutes")
    return held.dropDuplicatesWithinWatermark([key, "updated_at"])


def every(spark: SparkSession, job: Callable[[int], None], checkpoint: str, seconds: float = 15):
    """A query that runs a batch job every so many seconds, given the number of the run: a periodic import of task pages, say. A run that takes longer puts the next one off; one that fails ends the query with its error."""
    ticks = spark.readStream.format("rate").option("rowsPerSecond", 1).load()
    return ticks.writeStream.option("checkpointLocation", checkpoint).foreachBatch(lambda batch, run: job(run)).trigger(processingTime=f"{seconds} seconds").start()


#: What a control action does to the query of a crawl's monitor.
ENDS = ("crawl_suspend", "crawl_stop", "crawl_force_finish", "crawl_cancel")


def governed(begin: Callable[[], StreamingQuery], wanted: Callable[[], str | None], seconds: float = 1) -> str | None:
    """Runs a monitor until it ends or a control action asks for that; what ended it.

    A suspended monitor waits for crawl_resume and goes on from its checkpoint with what `begin` starts; any other action of ENDS
    is the last. `wanted` tells the newest action, such as the last row of a control table.
    """
    query = begin()
    while True:
        action = wanted()
        if action in ENDS:
            query.stop()
            if action != "crawl_suspend":
                return action
            while (action := wanted()) != "crawl_resume":
                if action in ENDS and action != "crawl_suspend":
                    return action
                time.sleep(seconds)
            query = begin()
        if query.awaitTermination(seconds):
            return None


def refreshed(view: Callable[[], DataFrame], show: Callable[[list], None], seconds: float = 5, times: int | None = None) -> None:
    """Shows the rows of a bounded view (a page, a detail panel) again and again, as they are then."""
    k = 0
    while times is None or k < times:
        show(view().collect())
        k += 1
        if times is None or k < times:
            time.sleep(seconds)
