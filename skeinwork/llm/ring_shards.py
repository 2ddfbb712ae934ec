"""Sharding by a consistent-hash ring with virtual nodes and bounded loads.

Every shard owns `vnodes` points of a ring of CELLS cells; a key hashes to a cell and belongs to the next point clockwise.
A shard takes at most its bound of rows; the keys beyond it go on clockwise to the next shard that has room. With slack 0 the
bounds are the two whole numbers next to the mean and sum to the number of rows, so counts differ by one at most; with a
slack e each bound is ceil((1 + e) * mean) and fewer keys leave their own shard.

How many keys of each arc go where depends on the counts by arc alone, so the driver plans with at most shards * vnodes
numbers, whatever the input. Rows then need only their rank in their arc: an arc is cut into RANGES by a hash of the whole row,
whose counts are summed up along the arc, and a window over narrow rows (no text) ranks each range, so that a key with a third
of all rows is spread over as many tasks.

Cases: a null key hashes like any other value; null text has size 16 and the crc32 of the empty text; repeated rows are kept,
and ranked by multiplicity, so that one row that is a third of all is combined before the shuffle; an empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from bisect import bisect_left

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .common import table

CELLS, RANGES = 1 << 16, 64
#: Repeats of one row that are written out by one step of an explode.
REPEATS = 1 << 16


def _hash(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode(), digest_size=8).digest(), "big")


def ring(shards: int, vnodes: int) -> list[tuple[int, int]]:
    """(cell, shard) of every virtual node, in clockwise order; a taken cell is passed on to a rehash. A ring of one shard more has all of these points unless two meet in a cell."""
    if shards * vnodes * 4 > CELLS:
        raise ValueError(f"{shards} x {vnodes} virtual nodes need more than {CELLS} cells")
    taken: dict[int, int] = {}
    for shard in range(shards):
        for v in range(vnodes):
            k = 0
            while (cell := _hash(f"{shard}/{v}/{k}") % CELLS) in taken:
                k += 1
            taken[cell] = shard
    return sorted(taken.items())


def bounds(total: int, shards: int, slack: float, natural: list[int]) -> list[int]:
    """Rows that each shard may take; with slack 0 the fullest shards have the larger of the two bounds."""
    if slack > 0:
        return [math.ceil((1 + slack) * total / shards)] * shards
    low, rest = divmod(total, shards)
    caps = [low] * shards
    for s in sorted(range(shards), key=lambda s: (-natural[s], s))[:rest]:
        caps[s] += 1
    return caps


def plan(points: list[tuple[int, int]], counts: dict[int, int], shards: int, slack: float = 0.0) -> list[tuple[int, int, int, int, int]]:
    """(arc, first rank, rank after the last, shard, slot of the first) of every run of rows that stays together.

    First every arc leaves its shard as many rows as the bound allows, in ring order; then the rows left over walk on
    clockwise, arc by arc, to the next shard with room.
    """
    natural = [0] * shards
    for arc, n in counts.items():
        natural[points[arc][1]] += n
    room, used = bounds(sum(counts.values()), shards, slack, natural), [0] * shards
    runs: list[tuple[int, int, int, int, int]] = []
    over: list[tuple[int, int, int]] = []

    def put(arc: int, at: int, n: int, shard: int) -> int:
        k = min(n, room[shard] - used[shard])
        if k > 0:
            runs.append((arc, at, at + k, shard, used[shard]))
            used[shard] += k
        return max(k, 0)

    for arc in sorted(counts):
        n = counts[arc]
        if (k := put(arc, 0, n, points[arc][1])) < n:
            over.append((arc, k, n))
    for arc, at, n in over:
        step = arc
        while at < n:
            step = (step + 1) % len(points)
            at += put(arc, at, n - at, points[step][1])
    return runs


def shard_rows(df: DataFrame, key: str, shards: int, vnodes: int = 64, slack: float = 0.0, carry: dict[str, Column] | None = None) -> DataFrame:
    """df's key and the carried columns with `shard` and `slot` (gapless from 0 in each shard).

    carry: narrow columns by name; equal (key, carried) rows are interchangeable.
    """
    spark = df.sparkSession
    points = ring(shards, vnodes)
    cells = [c for c, _ in points]
    arcs = [(cell, bisect_left(cells, cell) % len(cells)) for cell in range(CELLS)]
    # CELLS rows of two integers, whatever the input: a bound that holds by construction.
    lookup = F.broadcast(spark.createDataFrame(arcs, "__cell int, __arc int"))
    spot = F.xxhash64(F.col(key))
    placed = df.select(F.col(key), *[c.alias(n) for n, c in (carry or {}).items()], spot.alias("__h"), F.pmod(spot, F.lit(CELLS)).cast("int").alias("__cell"))
    placed = placed.join(lookup, "__cell").drop("__cell")
    counted = df.select(F.pmod(spot, F.lit(CELLS)).cast("int").alias("__cell")).join(lookup, "__cell").groupBy("__arc").count()
    counts = {r["__arc"]: r["count"] for r in counted.collect()}  # shards * vnodes rows at most
    runs = spark.createDataFrame(plan(points, counts, shards, slack), "__arc int, __from long, __to long, shard int, __slot long")
    names = [key, *(carry or {})]
    part = F.pmod(F.xxhash64("__h", *names), F.lit(RANGES)).cast("int")
    many = placed.groupBy("__arc", part.alias("__range"), "__h", *names).agg(F.count("*").alias("__n"))
    # RANGES rows an arc: shards * vnodes * RANGES at most, brought to the rows by the keys that these are windowed by.
    ranges = placed.groupBy("__arc", part.alias("__range")).agg(F.count("*").alias("__in"))
    below = F.sum("__in").over(Window.partitionBy("__arc").orderBy("__range").rowsBetween(Window.unboundedPreceding, 0)) - F.col("__in")
    ranges = ranges.select("__arc", "__range", below.alias("__below"))
    order = Window.partitionBy("__arc", "__range").orderBy("__h", *[F.col(c).asc_nulls_first() for c in names])
    first = F.sum("__n").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("__n")
    ranked = many.select("__arc", "__range", *names, "__n", first.alias("__rank")).join(ranges, ["__arc", "__range"])
    ranked = ranked.select("__arc", *names, "__n", (F.col("__rank") + F.col("__below")).alias("__rank"))
    blocks = ranked.withColumn("__block", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(__n - 1) div {REPEATS}L"))))
    rows = blocks.withColumn("__k", F.explode(F.sequence(F.col("__block") * REPEATS, F.least((F.col("__block") + 1) * REPEATS, F.col("__n")) - 1)))
    rows = rows.withColumn("__rank", F.col("__rank") + F.col("__k"))
    # At most two runs an arc and one a shard: bounded like the ring.
    out = rows.join(F.broadcast(runs), (rows["__arc"] == runs["__arc"]) & (rows["__rank"] >= runs["__from"]) & (rows["__rank"] < runs["__to"]))
    return out.select(*names, "shard", (F.col("__slot") + F.col("__rank") - F.col("__from")).alias("slot"))


def measures(text: str = "text") -> dict[str, Column]:
    held = F.coalesce(F.col(text), F.lit(""))
    return {"size": (F.octet_length(held) + 16).cast("long"), "text_crc32": F.crc32(held.cast("binary"))}


def shard_documents(docs: DataFrame, shards: int = 40, vnodes: int = 64) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard under the law `rows`: counts differ by one at most."""
    out = shard_rows(docs, "doc_id", shards, vnodes, 0.0, measures())
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast(T.IntegerType()).alias("grown_shard"))


def op3_ring_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(table(spark, sf_dir, "documents"))
