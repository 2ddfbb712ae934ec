"""The seed list: websites with a published snapshot, and their tags."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as X


def tag_lists(bridge: DataFrame, tags: DataFrame) -> DataFrame:
    """website_id and the tags of each website, in order, as an array and joined by commas."""
    named = bridge.join(tags.select(F.col("id").alias("tag_id"), F.col("name").alias("tag")), "tag_id")
    return named.groupBy("website_id").agg(F.sort_array(F.collect_set("tag")).alias("tag_names")).withColumn("tags", F.array_join("tag_names", ","))


def seed_list(websites: DataFrame, snapshots: DataFrame, bridge: DataFrame, tags: DataFrame, tag: str | None = None) -> DataFrame:
    """title, url, tags of every website with a published snapshot. A tag picks the websites that have one like it (part of the name, in any case; wildcards are plain) and doesn't shorten the tags shown."""
    published = snapshots.where(F.col("published")).select(F.col("website_id").alias("id"))
    held = websites.join(published, "id", "left_semi")
    if tag:
        like = tags.where(X.contains_ignoring_case(F.col("name"), tag)).select(F.col("id").alias("tag_id"))
        held = held.join(bridge.join(like, "tag_id", "left_semi").select(F.col("website_id").alias("id")), "id", "left_semi")
    out = held.join(tag_lists(bridge, tags), F.col("id") == F.col("website_id"), "left")
    return out.select("id", F.col("name").alias("title"), "url", F.coalesce("tags", F.lit("")).alias("tags")).orderBy("id")
