"""Helpers that several operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_folder

#: Rows of whole texts that one Arrow batch is cut into before arrays are built on it: characters at most, one text at least.
SLICE_CHARS = 1 << 21


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def row_key() -> Column:
    """128 bits in hex that stand for (doc_id, text); a null text is the empty one."""
    return F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.coalesce("text", F.lit(""))).cast("binary"))


def slices(texts: list[str], limit: int = SLICE_CHARS) -> Iterator[tuple[int, int]]:
    """Runs [a, b) of texts with at most limit characters in all, or one longer text."""
    a, size = 0, 0
    for i, t in enumerate(texts):
        if i > a and size + len(t) > limit:
            yield a, i
            a, size = i, 0
        size += len(t)
    if texts:
        yield a, len(texts)


def map_arrow(df: DataFrame, f: Callable, schema: str) -> DataFrame:
    """mapInArrow of a function from one record batch to batches."""
    def each(batches):
        for batch in batches:
            if batch.num_rows:
                yield from f(batch)

    return df.mapInArrow(each, schema)


def settled(df: DataFrame) -> DataFrame:
    """df written to the shared folder and read again: its lineage is cut, and a lost executor loses nothing."""
    spark = df.sparkSession
    df.write.option("compression", "zstd").parquet(path := shared_folder(spark))
    return spark.read.schema(df.schema).parquet(path)
