"""The corpus pipeline: language ID, near-dedup, decontamination, mixing, sharding, each stage on all that the one before kept.

Every stage is written to the shared folder as Parquet and read again, so a lost executor costs at most its own stage's tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from skeinwork.llm import benchmark_leaks, byte_convnet, mix_sources, ring_shards, simhash_groups
from skeinwork.llm.common import settled, table


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a letter and those that are more likely of no language than of any; learns as op2 does."""
    net = byte_convnet.learn(docs.where(byte_convnet.fold() != 2).select("doc_id", "text", "lang"))
    marked = byte_convnet.identified(docs, net, "__lang", "__score", "__any")
    return marked.where(f"__lang <> '{byte_convnet.UNKNOWN}' and __any >= {byte_convnet.SURE}").drop("__lang", "__score", "__any")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return simhash_groups.distinct_documents(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item, whole or edited."""
    return benchmark_leaks.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix of sources takes it."""
    return mix_sources.mixed_rows(docs)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every row of the mix."""
    return ring_shards.shard_documents(docs)


STAGES = [("language ID", language_id), ("SimHash near-dedup", near_dedup), ("benchmark decontamination", decontamination), ("mixing", mixing), ("sharding", sharding)]

#: A trained network and a search that is repeated to a target recall can't be written in SQL; tests/llm holds run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to documents."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = settled(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
