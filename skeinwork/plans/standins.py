"""The driver's tables seen as an archive's: orders as snapshots, customers as websites, line items as WARC files, events as log lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as X


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def websites(spark, d) -> DataFrame:
    c = table(spark, d, "customer")
    return c.select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.concat(F.lit("http://site"), F.col("c_custkey"), F.lit(".example/")).alias("url"), F.col("c_nationkey").cast("long").alias("organisation_id"),
        (F.col("c_acctbal") < 0).alias("isDeleted"), (F.col("c_acctbal") >= 0).alias("enabled"), F.col("c_mktsegment").alias("displayName"),
    )


STATUS = {"F": "completed", "O": "crawling", "P": "pending"}


def snapshots(spark, d) -> DataFrame:
    o = table(spark, d, "orders")
    status = F.when(F.col("o_orderstatus") == "F", "completed").when(F.col("o_orderstatus") == "O", "crawling").otherwise("pending")
    return o.select(
        F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("website_id"), F.concat(F.lit("snap-"), F.col("o_orderkey")).alias("uid"), status.alias("status"),
        (F.col("o_orderstatus") == "F").alias("published"), F.col("o_orderdate").cast("timestamp").alias("created_at"), F.col("o_orderpriority").alias("order_priority"),
        F.concat(F.lit("c"), F.col("o_orderkey")).alias("replay_collection_id"), F.col("o_totalprice").alias("price"),
    )


def warcs(spark, d) -> DataFrame:
    item = table(spark, d, "lineitem")
    return item.select(
        F.col("l_orderkey").alias("snapshot_id"), F.concat(F.lit("part-"), F.col("l_linenumber"), F.lit(".warc.gz")).alias("filename"), F.col("l_extendedprice").cast("long").alias("size_bytes"),
        (F.col("l_returnflag") == "A").alias("is_production"), F.col("l_partkey").alias("part"), F.col("l_suppkey").alias("supplier"),
    )


def website_tags(spark, d) -> DataFrame:
    """website_id and tag_id (a part type): what a website's snapshots hold."""
    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_custkey").alias("website_id"))
    item = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("k"), F.col("l_partkey").alias("p"))
    part = table(spark, d, "part").select(F.col("p_partkey").alias("p"), F.col("p_type").alias("tag_id"))
    return o.join(item, "k").join(part, "p").select("website_id", "tag_id").distinct()


def tags(spark, d) -> DataFrame:
    return table(spark, d, "part").select(F.col("p_type").alias("id"), F.col("p_type").alias("name")).distinct()


def events(spark, d) -> DataFrame:
    return X.once(table(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp")), "k", F.get_json_object("props", "$.k").cast("long"))


def log_lines(spark, d, cut: int | None = None) -> DataFrame:
    """Log lines made of events: a prefix, then JSON; every cut-th line is torn. Position: (path, offset)."""
    e = events(spark, d)
    kind = F.col("event_type")
    context = F.when(kind == "view", "worker").when(kind == "click", "pageStatus").when(kind == "purchase", "crawlStatus").otherwise("general")
    level = F.when(kind == "error", "error").otherwise("info")
    message = F.when(kind == "view", "Starting page").when(kind == "click", "Page Finished").when(kind == "error", F.concat(F.lit("code "), F.col("k") % 7)).otherwise("status")
    text = F.concat(
        F.lit("crawl "), F.lit('{"timestamp":"'), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit('Z","context":"'), context, F.lit('","logLevel":"'), level, F.lit('","message":"'), message,
        F.lit('","details":{"crawled":'), F.col("k"), F.lit(',"total":'), F.col("k") + F.col("user_id"), F.lit(',"page":"http://p/'), F.col("event_id"), F.lit('"}}'),
    )
    if cut:
        text = F.when(F.col("event_id") % cut == 0, F.substring(text, 1, 40)).otherwise(text)
    # A line is a value, as if read: filters and fields don't make it anew.
    held = X.once(e.select(F.col("user_id").alias("job"), F.lit("all.log").alias("path"), F.col("event_id").alias("offset"), text.alias("text")), "line", F.col("text"))
    return held.drop("text").withColumn("bytes", (F.octet_length("line") + 1).cast("long"))


LOG_SQL = """
  select user_id as job, event_id, ts, event_type, cast(json_extract_string(props, '$.k') as bigint) as k,
    case event_type when 'view' then 'worker' when 'click' then 'pageStatus' when 'purchase' then 'crawlStatus' else 'general' end as context,
    case when event_type = 'error' then 'error' else 'info' end as lvl,
    case event_type when 'view' then 'Starting page' when 'click' then 'Page Finished' when 'error' then 'code ' || (cast(json_extract_string(props, '$.k') as bigint) % 7) else 'status' end as message
  from events"""
LINE_SQL = f"""
  select *, 'crawl {{"timestamp":"' || strftime(ts, '%Y-%m-%dT%H:%M:%S') || 'Z","context":"' || context || '","logLevel":"' || lvl || '","message":"' || message ||
    '","details":{{"crawled":' || k || ',"total":' || (k + job) || ',"page":"http://p/' || event_id || '"}}}}' as line from ({LOG_SQL})"""
