"""Rates, stalls and running totals over the polls of a crawl.

One window by crawl in the order of polls serves all of them, so a plan has one shuffle and one sort.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import times as T


def polls(by: str, order: list[str]) -> Window:
    return Window.partitionBy(by).orderBy(*order)


def _spread(df: DataFrame, by: str, order: list[str], bucket: Column, total, local, joined, columns: dict[str, str]) -> DataFrame:
    """A running aggregate in two steps: inside each (by, bucket), and over the buckets' totals, of which a crawl has few.

    bucket must not fall where the order rises. A crawl with a third of all rows is thus as many tasks as it has buckets.
    """
    held = df.withColumn("__bucket", bucket)
    sums = held.groupBy(by, "__bucket").agg(*[total(c).alias(f"__{n}") for n, c in columns.items()])
    before = Window.partitionBy(by).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    prior = sums.select(by, "__bucket", *[local(f"__{n}", before).alias(f"__{n}") for n in columns])
    inside = Window.partitionBy(by, "__bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = held.join(prior, [by, "__bucket"]).withColumns({n: joined(local(c, inside), F.col(f"__{n}")) for n, c in columns.items()})
    return out.drop("__bucket", *[f"__{n}" for n in columns])


def running(df: DataFrame, by: str, order: list[str], bucket: Column | None = None, **columns: str) -> DataFrame:
    """Adds running sums: name=column. bucket: see _spread."""
    if bucket is not None:
        add = lambda own, prior: F.when(own.isNull(), prior).otherwise(own + F.coalesce(prior, F.lit(0)))
        return _spread(df, by, order, bucket, F.sum, lambda c, w: F.sum(c).over(w), add, columns)
    w = polls(by, order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumns({name: F.sum(c).over(w) for name, c in columns.items()})


def carried(df: DataFrame, by: str, order: list[str], bucket: Column | None = None, **columns: str) -> DataFrame:
    """Adds the last value that isn't null so far: name=column. bucket: see _spread."""
    if bucket is not None:
        latest = lambda c: F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.struct(*order)))
        return _spread(df, by, order, bucket, latest, lambda c, w: F.last(c, ignorenulls=True).over(w), lambda own, prior: F.coalesce(own, prior), columns)
    w = polls(by, order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumns({name: F.last(c, ignorenulls=True).over(w) for name, c in columns.items()})


def rate(now: Column, before: Column, seconds: Column) -> Column:
    """Change a second; 0 for a first poll or where time stood still or went back."""
    return F.when(seconds > 0, (now - before) / seconds).otherwise(0.0)


def derived(df: DataFrame, by: str = "snapshot_id", time: str = "last_update", order: list[str] | None = None) -> DataFrame:
    """Adds rates and health flags to rows with cumulative log_lines, log_bytes, cdx_lines, cdx_bytes.

    A poll is held against the one before it. Without a baseline, or where either time is null, rates are 0 and flags false.
    """
    w = polls(by, order or [time])
    before = {c: F.lag(c).over(w) for c in ("log_lines", "log_bytes", "cdx_lines", "cdx_bytes")}
    seconds = T.seconds_between(F.col(time), F.lag(time).over(w))
    moved = F.coalesce(seconds > 0, F.lit(False))
    same = lambda c: moved & (F.col(c) == before[c])
    more = lambda c: moved & (F.col(c) > before[c])
    out = {f"{c.replace('lines', 'entries')}_per_sec": rate(F.col(c), before[c], seconds) for c in before}
    out |= {"log_stalled": same("log_lines"), "cdx_stalled": same("cdx_lines"), "js_heavy": more("log_lines") & same("cdx_lines")}
    return df.withColumns({k: F.coalesce(v, F.lit(False) if k.endswith(("stalled", "heavy")) else F.lit(0.0)) for k, v in out.items()})
