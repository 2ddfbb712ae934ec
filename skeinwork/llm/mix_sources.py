"""Mixing sources to target weights by subset-sum budget fitting.

Targets come from water-filling over the sources (weights 5, 2, 1 in code-point order, null last, repeating; 150 % of all
words; at most twice a source's own words). A source with a target of r whole copies and a rest takes every document r times
and fits the rest: documents are counted by exact length, every length gives its even share, and a bounded-knapsack dynamic
program over the lengths fills what is left of the budget, as a rule to the word. The documents of each length are then chosen
by a seeded hash.

Sources are a table like any other: they are ranked by code point in ranges, and the level of the water is found in a few rounds
of two sums over all of them, so that a source may be a host name. The fit sees one row a (source, length), so its size is
bounded by the longest text and not by the number of rows. Words are counted once, and what follows works on narrow rows; texts
are read again only where they are carried. Ranks inside a (source, length) are taken in BUCKETS ranges of the seeded hash, so
that a source or a group of copies with a third of all rows is spread over as many tasks.

Cases: null or blank text has size 0 and is never taken; a null source is a source; repeated rows are documents of their own;
an empty table gives an empty result; extra columns are carried on request.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import settled, table

WEIGHTS, SHARE, MOST, SEED = (5.0, 2.0, 1.0), 1.5, 2.0, 20240607
BUCKETS = 1024
#: Words of budget that are left to the dynamic program at most; documents of every length are added in turn, longest first, until no more are left.
EXACT = 1 << 16


def targets(sizes: list[int], weights: list[float], budget: float, most: float = MOST) -> list[float]:
    """Shares of budget by weight; none above most times its size, the excess shared again by weight among the others."""
    out = [0.0] * len(sizes)
    open_ = {i for i, s in enumerate(sizes) if s > 0}
    left = min(float(budget), most * sum(sizes))
    while open_ and left > 0:
        unit = left / sum(weights[i] for i in open_)
        full = {i for i in open_ if weights[i] * unit >= most * sizes[i]}
        if not full:
            for i in open_:
                out[i] = weights[i] * unit
            break
        for i in full:
            out[i] = most * sizes[i]
            left -= out[i]
        open_ -= full
    return out


def fit(lengths: list[int], counts: list[int], budget: float) -> list[int]:
    """How many documents of each length to take so that their words come as near below the budget as can be."""
    total, room = sum(a * b for a, b in zip(lengths, counts)), int(budget)
    if total <= room:
        return list(counts)
    take = [c * room // total if n else 0 for n, c in zip(lengths, counts)]
    room -= sum(a * b for a, b in zip(lengths, take))
    order = sorted((i for i, n in enumerate(lengths) if n), key=lambda i: -lengths[i])
    most = 1
    while room > EXACT:  # one more of each length, longest first, then two more, and so on
        before = room
        for i in order:
            if room <= EXACT:
                break
            k = min(most, counts[i] - take[i], room // lengths[i])
            take[i] += k
            room -= k * lengths[i]
        if room == before and all(lengths[i] > room or take[i] == counts[i] for i in order):
            break
        most *= 2
    if room <= 0:
        return take
    # Bit s of reach: a sum of s can be made. by[s]: the step that first made it; its rest was made by an earlier one.
    mask, goal = (1 << (room + 1)) - 1, 1 << room
    reach, steps, by = 1, [], np.zeros(room + 1, dtype=np.int64)
    for i in order:
        spare, k = min(counts[i] - take[i], room // lengths[i]), 1
        while spare > 0 and not reach & goal:
            k = min(k, spare)
            if new := (reach << (k * lengths[i])) & mask & ~reach:
                made = np.frombuffer(new.to_bytes(room // 8 + 1, "little"), dtype=np.uint8)
                by[np.flatnonzero(np.unpackbits(made, bitorder="little"))] = len(steps)
                steps.append((i, k))
                reach |= new
            spare -= k
            k *= 2
        if reach & goal:
            break
    at = reach.bit_length() - 1
    while at:
        i, k = steps[by[at]]
        take[i] += k
        at -= k * lengths[i]
    return take


def words(text: str = "text"):
    r"""Runs of [^\x20\x09-\x0D] in the text; null has none."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targeted(sums: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """sums (__source, __none, words) with __target, as `targets` gives it, by aggregates alone."""
    ranges = sums.repartitionByRange("__none", "__source").withColumn("__range", F.spark_partition_id())
    ranges = settled(ranges)
    sizes = {r["__range"]: r["count"] for r in ranges.groupBy("__range").count().collect()}  # as many rows as partitions
    before, start = 0, {}
    for k in sorted(sizes):
        start[k] = before
        before += sizes[k]
    at = F.row_number().over(Window.partitionBy("__range").orderBy("__none", "__source")) - 1
    first = F.element_at(F.create_map(*[F.lit(x) for k, v in start.items() for x in (k, v)]), F.col("__range")) if start else F.lit(0)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(first + at, F.lit(len(weights))) + 1).cast("int"))
    held = settled(ranges.select("__source", "__none", "words", weight.alias("__weight")))
    total = held.agg(F.sum("words")).first()[0] or 0
    left, unit, full = min(share * total, most * total), 0.0, None
    while total:
        fills = F.col("__weight") * unit >= most * F.col("words")
        r = held.where("words > 0").agg(F.coalesce(F.sum(F.when(fills, F.col("words"))), F.lit(0)).alias("full"), F.coalesce(F.sum(F.when(~fills, F.col("__weight"))), F.lit(0.0)).alias("open")).first()
        if r["full"] == full or not r["open"]:
            break
        full = r["full"]
        unit = (left - most * full) / r["open"]
    return held.select("__source", "__none", "words", F.least(F.col("__weight") * unit, most * F.col("words")).alias("__target"))


def _planned(docs: DataFrame, carry: list[str], seed: int = SEED, weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """The carried columns, whatever their names, with __size, __source_size, __target and __copies."""
    held = docs.select(
        *[F.col(c) for c in carry],
        F.coalesce(F.col("source"), F.lit("")).alias("__source"), F.col("source").isNull().alias("__none"), words().alias("__size"),
        F.xxhash64(F.lit(seed), F.col("doc_id"), F.crc32(F.col("text").cast("binary"))).alias("__h"),
    ).withColumn("__bucket", F.pmod(F.col("__h"), F.lit(BUCKETS)).cast("int"))
    key = ["__source", "__none", "__size"]
    if "text" not in carry:
        held = settled(held)
    buckets = held.groupBy(*key, "__bucket").agg(F.count("*").alias("__n"))
    if "text" in carry:  # words are counted again where the texts are carried along, but not for the plan's two uses
        buckets = settled(buckets)
    lengths = settled(buckets.groupBy(*key).agg(F.sum("__n").alias("__n")))
    sums = targeted(lengths.groupBy("__source", "__none").agg(F.sum(F.col("__size") * F.col("__n")).alias("words")), weights, share, most)
    whole = F.when(F.col("words") > 0, F.floor(F.col("__target") / F.col("words"))).otherwise(0).cast("int")
    plan = sums.select("__source", "__none", F.col("words").alias("__source_size"), "__target", whole.alias("__whole"), (F.col("__target") - whole * F.col("words")).alias("__rest"))

    def fitted(pdf):
        pdf = pdf.sort_values("__size")
        pdf["__take"] = fit([int(x) for x in pdf["__size"]], [int(x) for x in pdf["__n"]], float(pdf["__rest"].iloc[0]))
        return pdf[["__source", "__none", "__size", "__take", "__source_size", "__target", "__whole"]]

    taken = lengths.join(plan, ["__source", "__none"]).groupBy("__source", "__none").applyInPandas(
        fitted, "__source string, __none boolean, __size long, __take long, __source_size long, __target double, __whole int"
    )
    # The take of a length falls on its buckets in order: all of the first ones, part of one, none of the rest.
    below = F.sum("__n").over(Window.partitionBy(*key).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, 0)) - F.col("__n")
    shares = buckets.join(taken, key).withColumn("__take", F.greatest(F.least(F.col("__take") - below, F.col("__n")), F.lit(0))).drop("__n")
    rank = F.row_number().over(Window.partitionBy(*key, "__bucket").orderBy("__h", *[F.col(c).asc_nulls_first() for c in carry if c in ("doc_id", "text")]))
    out = held.join(shares, [*key, "__bucket"]).withColumn("__rank", rank)
    copies = F.when(F.col("__size") == 0, 0).otherwise(F.col("__whole") + (F.col("__rank") <= F.col("__take")).cast("int"))
    return out.select(*carry, "__size", "__source_size", "__target", copies.cast("int").alias("__copies"))


def mix(docs: DataFrame, carry: list[str], **options) -> DataFrame:
    """The carried columns with size, source_size, target, copies and taken (copies * size)."""
    own = {"size": F.col("__size"), "source_size": F.col("__source_size"), "target": F.col("__target"), "copies": F.col("__copies"), "taken": (F.col("__copies") * F.col("__size")).cast("long")}
    return _planned(docs, carry, **options).select(*carry, *[c.alias(n) for n, c in own.items()])


def mixed_rows(docs: DataFrame, **options) -> DataFrame:
    """docs as mixed: every row as often as the mix takes it."""
    names = docs.columns
    out = _planned(docs, names, **options).where("__copies > 0")
    return out.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies")))).select(*names)


def op9_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mix(table(spark, sf_dir, "documents").select("doc_id", "text", "source"), ["doc_id", "source"])
    return out.select("doc_id", "size", "source_size", "target", "taken", "source", "copies")
