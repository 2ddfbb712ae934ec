"""Stored rows to API documents and back.

Documents are structs; `to_json` leaves null fields out, which is how the sparse ones (crawl configuration) come about.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import collections as C
from ..functions import numbers as N
from ..functions import text as X
from ..functions import times as T
from ..schemas import ENGINE_CONFIG, WEBSITE_DOCUMENT
from .catalog import looked_up

ENGINES = ("browsertrix", "heritrix")
STATS = "struct<crawled:bigint,total:bigint,pending:bigint,failed:bigint,limit_hit:boolean,by_request_type:map<string,bigint>,by_mime:map<string,bigint>,by_http_status:map<string,bigint>,by_url_extension:map<string,bigint>>"


def unless_falsy(x: Column, kind: str) -> Column:
    """x, or null where it is 0, false, an empty text or an empty array."""
    if kind == "array":
        return F.when(F.size(x) > 0, x)
    return F.when(x != {"number": F.lit(0), "text": F.lit(""), "flag": F.lit(False)}[kind], x)


def unless_empty(struct: Column, *fields: Column) -> Column:
    return F.when(F.coalesce(*[f.cast("string") for f in fields]).isNotNull(), struct)


def warc_document() -> Column:
    return F.struct(
        "filename", "size_bytes", F.nullif(F.col("sha256"), F.lit("")).alias("sha256"), T.to_iso(F.col("created_at")).alias("created_at"), "path", F.col("is_production").alias("production")
    )


def nested(rows: DataFrame, key: str, document: Column, name: str, order: str) -> DataFrame:
    """key and the array of its rows' documents, in order."""
    return rows.groupBy(key).agg(F.sort_array(F.collect_list(F.struct(F.col(order).alias("__order"), document.alias("d")))).alias("__rows")).select(key, F.transform("__rows", lambda r: r["d"]).alias(name))


def snapshots(snapshots_: DataFrame, websites: DataFrame, warcs: DataFrame) -> DataFrame:
    """snapshot_id and document; absent statistics count as empty, times are text."""
    files = nested(warcs, "snapshot_id", warc_document(), "warcs", "filename")
    sites = websites.select(F.col("id").alias("website_id"), F.col("url").alias("url"))
    held = snapshots_.join(sites, "website_id", "left").join(files, snapshots_["id"] == files["snapshot_id"], "left").drop("snapshot_id")
    held = held.withColumn("s", F.from_json("crawl_stats", STATS))
    number = lambda k: F.coalesce(F.col(f"s.{k}"), F.lit(0)).alias(k)
    start, stop = T.to_iso(F.col("crawlStartTimestamp")), T.to_iso(F.col("crawlStopTimestamp"))
    technical = F.struct(
        number("crawled"), number("total"), number("pending"), number("failed"), F.coalesce("s.limit_hit", F.lit(False)).alias("limit_hit"),
        "s.by_request_type", "s.by_mime", "s.by_http_status", "s.by_url_extension", start.alias("crawlStartTimestamp"), stop.alias("crawlStopTimestamp"), "warc_path", "crawlWarcSize",
    )
    empty = F.array().cast(files.schema["warcs"].dataType)
    document = F.struct(
        "uid", F.col("website_id").alias("websiteId"), "url", "isDeleted", "status", X.or_default(F.col("publication_status"), "none").alias("publicationStatus"),
        start.alias("crawlStartTimestamp"), stop.alias("crawlStopTimestamp"), "size", F.col("item_count").alias("itemCount"), F.col("warc_path").alias("warcPath"),
        F.coalesce("replay_collection_id", F.lit("None")).alias("replayCollectionId"), F.coalesce("warcs", empty).alias("warcs"),
        F.struct(F.array().cast("array<string>").alias("extra")).alias("metadataArchival"), technical.alias("metadataTechnical"),
        F.col("crawl_stats").alias("crawlStats"), F.col("container_stats").alias("containerStats"), "crawlJustification", "publicationJustification",
        X.relative_replay_url(F.col("replay_collection_id"), F.col("url")).alias("replayRelativeUrl"),
    )
    return held.select(F.col("id").alias("snapshot_id"), F.col("website_id"), document.alias("document"))


def websites(websites_: DataFrame, bridge: DataFrame, tags: DataFrame) -> DataFrame:
    """website_id and document, with the id and name of each tag."""
    named = bridge.join(tags.select(F.col("id").alias("tag_id"), "name"), "tag_id")
    lists = nested(named, "website_id", F.struct(F.col("tag_id").alias("id"), "name"), "tag_list", "tag_id")
    held = websites_.join(lists, websites_["id"] == lists["website_id"], "left").drop("website_id")
    technical = F.struct(
        F.col("scope_type").alias("scopeType"), F.col("generate_cdx").alias("generateCdx"), "workers", F.col("page_load_timeout").alias("pageLoadTimeout"),
        F.col("disk_utilization").alias("diskUtilization"), F.col("time_limit").alias("timeLimit"),
    )
    document = F.struct(
        "id", F.col("organisation_id").alias("organisationId"), "url", "isDeleted", "name", "displayName", "shortDescription", "longDescription", "doCrawl",
        T.to_iso(F.col("suspendCrawlUntilTimestamp")).alias("suspendCrawlUntilTimestamp"), F.coalesce("tag_list", F.array().cast(lists.schema["tag_list"].dataType)).alias("tags"),
        F.struct(F.col("auto_publish").alias("autoPublish"), "enabled").alias("metadataArchival"), technical.alias("metadataTechnical"),
    )
    return held.select(F.col("id").alias("website_id"), "website_crawl_parameters_id", document.alias("document"))


def crawl_configs(parameters: DataFrame) -> DataFrame:
    """crawl_config_id and document: JSON text without falsy keys, extra keys last and winning."""
    num, text, arr, flag = (lambda c, k=k: unless_falsy(F.col(c), k) for k in ("number", "text", "array", "flag"))
    texts, patterns = arr("exclude_text_matches"), arr("exclude_regex_matches")
    excluded = F.struct(texts.alias("textMatches"), patterns.alias("regexMatches"))
    scope = F.struct(
        F.col("scope_type").alias("type"), F.col("start_urls").alias("startUrls"), flag("include_linked").alias("includeLinked"), F.col("max_depth").alias("maxDepth"),
        arr("url_prefixes").alias("urlPrefixes"), arr("additional_pages").alias("additionalPages"), unless_empty(excluded, texts, patterns).alias("excludePages"),
    )
    pages, seconds, size = num("max_pages"), num("time_limit"), F.col("size_limit_gb")
    limits = F.struct(pages.alias("maxPages"), seconds.alias("timeLimitSeconds"), size.alias("sizeLimitGB"))
    behavior = F.struct(
        F.col("auto_scroll").alias("autoScroll"), F.col("auto_click").alias("autoClick"), N.milliseconds(num("page_load_timeout")).alias("pageLoadLimitMs"),
        num("post_load_delay_ms").alias("delayAfterPageLoadMs"), num("page_extra_delay_ms").alias("delayBeforeNextPageMs"),
    )
    agent, language, proxy = text("user_agent"), text("language"), text("proxy_server")
    browser = F.struct(agent.alias("userAgent"), language.alias("language"), proxy.alias("proxyServer"))
    # Each part as JSON in a map, so that extra keys can replace it.
    own = F.create_map(
        F.lit("crawlScope"), F.to_json(scope), F.lit("crawlLimits"), F.to_json(unless_empty(limits, pages, seconds, size)),
        F.lit("pageBehavior"), F.to_json(behavior), F.lit("browserSettings"), F.to_json(unless_empty(browser, agent, language, proxy)),
    )
    all_ = C.merged(C.without_nulls(own), F.col("extra_config"))
    quoted = lambda e: F.concat(F.to_json(F.struct(e["key"].alias("k"))).substr(F.lit(6), F.length(F.to_json(F.struct(e["key"].alias("k")))) - 6), F.lit(":"), e["value"])
    engine = F.concat(F.lit("{"), F.array_join(F.transform(F.map_entries(all_), quoted), ","), F.lit("}"))
    return parameters.select(F.col("id").alias("crawl_config_id"), F.concat(F.lit('{"crawlEngine":"browsertrix","engineConfig":'), engine, F.lit("}")).alias("document"))


def parameters_from_documents(tasks: DataFrame, column: str = "taskParameters") -> DataFrame:
    """Columns of website_crawl_parameters from the configuration that tasks embed; an engine that isn't known gives an error.

    Keys besides the four known parts are kept in extra_config, as JSON texts.
    """
    document = F.get_json_object(column, "$.crawlConfig")
    config = F.get_json_object(document, "$.engineConfig")
    held = tasks.where(document.isNotNull()).withColumn("e", F.from_json(config, ENGINE_CONFIG)).withColumn("all", F.from_json(config, "map<string,string>"))
    engine = F.get_json_object(document, "$.crawlEngine")
    s, limits, b, w = (F.col(f"e.{k}") for k in C.ENGINE_KEYS)
    empty = F.array().cast("array<string>")
    return held.select(
        "uid", F.get_json_object(document, "$.name").alias("name"), F.get_json_object(document, "$.description").alias("description"), engine.alias("engine_type"),
        F.coalesce(s.type, s.scopeType, F.lit("page")).alias("scope_type"), F.coalesce(s.startUrls, empty).alias("start_urls"), F.coalesce(s.includeLinked, F.lit(False)).alias("include_linked"),
        s.maxDepth.alias("max_depth"), F.coalesce(s.urlPrefixes, empty).alias("url_prefixes"), F.coalesce(s.additionalPages, empty).alias("additional_pages"),
        F.coalesce(s.excludePages.textMatches, empty).alias("exclude_text_matches"), F.coalesce(s.excludePages.regexMatches, empty).alias("exclude_regex_matches"),
        limits.maxPages.alias("max_pages"), limits.sizeLimitGB.alias("size_limit_gb"), F.coalesce(limits.timeLimitSeconds, F.lit(86400)).alias("time_limit"),
        F.coalesce(b.autoScroll, F.lit(True)).alias("auto_scroll"), F.coalesce(b.autoClick, F.lit(False)).alias("auto_click"),
        F.coalesce(N.whole_seconds(b.pageLoadLimitMs).cast("int"), F.lit(25)).alias("page_load_timeout"),
        F.coalesce(b.delayAfterPageLoadMs, F.lit(0)).alias("post_load_delay_ms"), F.coalesce(b.delayBeforeNextPageMs, F.lit(0)).alias("page_extra_delay_ms"),
        *[F.coalesce(w[k], F.lit("")).alias(c) for k, c in (("userAgent", "user_agent"), ("language", "language"), ("proxyServer", "proxy_server"))],
        C.residual(F.col("all")).alias("extra_config"),
        F.when(~F.coalesce(engine.isin(*ENGINES), F.lit(False)), F.concat(F.lit("Unsupported crawl engine: "), F.coalesce(engine, F.lit("None")))).alias("error"),
    )


def websites_from_documents(tasks: DataFrame, stored: DataFrame, column: str = "taskParameters") -> DataFrame:
    """uid and the website row of each task: the embedded document over the stored row, else the row of websiteId, else an error."""
    w = F.from_json(F.get_json_object(column, "$.website"), WEBSITE_DOCUMENT)
    held = tasks.select("uid", w.alias("w"), F.coalesce(w.id, X.whole_number(F.get_json_object(column, "$.websiteId"))).alias("website_id"))
    old = stored.select(F.col("id").alias("website_id"), *[F.col(c).alias(f"old_{c}") for c in ("name", "url", "displayName", "shortDescription", "longDescription", "doCrawl", "isDeleted", "auto_publish")])
    both = looked_up(held, old, "website_id", "uid")
    pick = lambda new, c: F.coalesce(F.col("w")[new], F.col(f"old_{c}")).alias(c)
    deleted = F.coalesce(F.col("w.isDeleted"), F.col("old_isDeleted"), F.lit(False))
    return both.select(
        "uid", "website_id", pick("name", "name"), pick("url", "url"), pick("displayName", "displayName"), pick("shortDescription", "shortDescription"), pick("longDescription", "longDescription"),
        pick("doCrawl", "doCrawl"), deleted.alias("isDeleted"), (~deleted).alias("enabled"), pick("autoPublish", "auto_publish"), T.from_iso(F.col("w.suspendCrawlUntilTimestamp")).alias("suspendCrawlUntilTimestamp"),
        F.when(F.col("w").isNull() & F.col("old_url").isNull(), "No website is embedded or known").alias("error"),
    )


def crawler_config(engine: Column, website_url: Column, collection: Column) -> Column:
    """The crawler's own configuration (a struct, nulls to be left out) from an ENGINE_CONFIG struct."""
    s, limits, b, w = (engine[k] for k in C.ENGINE_KEYS)
    seconds = lambda k: N.whole_seconds(unless_falsy(b[k], "number"))
    exclude, behaviors = C.concatenated(s.excludePages.textMatches, s.excludePages.regexMatches), F.array_compact(F.array(F.when(b.autoScroll, F.lit("autoscroll")), F.when(b.autoClick, F.lit("autoclick"))))
    return F.struct(
        F.coalesce(unless_falsy(s.startUrls, "array"), F.array(website_url)).alias("seeds"), F.coalesce(s.scopeType, s.type, F.lit("page")).alias("scopeType"), s.maxDepth.alias("depth"),
        unless_falsy(s.includeLinked, "flag").alias("includeLinked"), unless_falsy(s.urlPrefixes, "array").alias("scopeIncludeRx"), unless_falsy(s.additionalPages, "array").alias("extraPages"),
        unless_falsy(exclude, "array").alias("exclude"), unless_falsy(limits.maxPages, "number").alias("pageLimit"), unless_falsy(limits.timeLimitSeconds, "number").alias("timeLimit"),
        N.gigabytes_to_bytes(F.when(limits.sizeLimitGB != 0, limits.sizeLimitGB)).alias("sizeLimit"), unless_falsy(behaviors, "array").alias("behaviors"),
        seconds("pageLoadLimitMs").alias("pageLoadTimeout"), seconds("delayAfterPageLoadMs").alias("postLoadDelay"), seconds("delayBeforeNextPageMs").alias("pageExtraDelay"),
        unless_falsy(w.userAgent, "text").alias("userAgent"), unless_falsy(w.language, "text").alias("lang"), unless_falsy(w.proxyServer, "text").alias("proxyServer"),
        F.lit(True).alias("generateCDX"), collection.cast("string").alias("collection"), F.lit("/crawls").alias("cwd"),
    )


def crawler_configs(tasks: DataFrame, snapshots_: DataFrame, sites: DataFrame) -> DataFrame:
    """uid and config of each crawl task, as JSON; an error where its parameters hold no configuration."""
    s = snapshots_.select(F.col("id").alias("snapshot_id"), "website_id", "replay_collection_id")
    w = sites.select(F.col("id").alias("website_id"), F.col("url").alias("website_url"))
    config = F.get_json_object("taskParameters", "$.crawlConfig.engineConfig")
    held = looked_up(looked_up(tasks, s, "snapshot_id", "uid"), w, "website_id", "uid").withColumn("e", F.from_json(config, ENGINE_CONFIG))
    document = F.to_json(crawler_config(F.col("e"), F.col("website_url"), F.col("replay_collection_id")))
    return held.select("uid", F.when(config.isNotNull(), document).alias("config"), F.when(config.isNull(), "The task parameters hold no crawlConfig").alias("error"))


def task_payloads(tasks: DataFrame) -> DataFrame:
    """uid and the task document that the API is sent: without its parameters."""
    time = lambda c: T.to_iso(F.col(c)).alias(c)
    document = F.struct(
        "action", "uid", "user", time("scheduleTime"), time("startTime"), time("updateTime"), "updateMessage", time("finishTime"),
        "status", "result", "resultDescription", "runData", "priority", "schedule", "taskResponse",
    )
    return tasks.select("uid", document.alias("document"))


def task_parameters(snapshots_: DataFrame, sites: DataFrame, configs: DataFrame) -> DataFrame:
    """snapshot_id and parameters with the snapshot, its website and configuration and their ids, as JSON. Inputs: the documents made above."""
    s = snapshots_.select("snapshot_id", "website_id", F.col("document").alias("snapshot"))
    w = sites.select("website_id", F.col("website_crawl_parameters_id").alias("crawl_config_id"), F.col("document").alias("website"))
    c = configs.select("crawl_config_id", F.col("document").alias("config"))
    held = looked_up(looked_up(s, w, "website_id", "snapshot_id"), c, "crawl_config_id", "snapshot_id")
    fixed = F.to_json(F.struct("snapshot", "website", F.col("website_id").alias("websiteId"), F.when(F.col("config").isNotNull(), F.col("crawl_config_id")).alias("crawlConfigId")))
    whole = F.when(F.col("config").isNull(), fixed).otherwise(F.concat(F.substring(fixed, 1, F.length(fixed) - 1), F.lit(',"crawlConfig":'), F.col("config"), F.lit("}")))
    return held.select("snapshot_id", whole.alias("parameters"))
