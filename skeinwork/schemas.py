"""Structures of the stored tables and of the documents that are read, as DDL text: readers and from_json take it without a session."""

from __future__ import annotations


LOG_RECORD = (
    "timestamp string, context string, logLevel string, message string, "
    "details struct<crawled:bigint,total:bigint,pending:bigint,failed:bigint,limit:struct<hit:boolean>,page:string>"
)
CDX_RECORD = ("url string, status string, mime string")

_USAGE = "struct<cpu_usage:struct<total_usage:bigint,percpu_usage:array<bigint>>,system_cpu_usage:bigint>"
CONTAINER = (
    "id string, short_id string, name string, status string, available boolean, "
    "attrs struct<State:struct<Running:boolean,Paused:boolean,OOMKilled:boolean,ExitCode:int,Error:string,StartedAt:string,FinishedAt:string,RestartCount:int>,"
    "Config:struct<Image:string,Cmd:array<string>,Labels:map<string,string>>>, "
    f"stats struct<cpu_stats:{_USAGE},precpu_stats:{_USAGE},memory_stats:struct<usage:bigint,limit:bigint>,pids_stats:struct<current:bigint>,"
    "networks:map<string,struct<rx_bytes:bigint,tx_bytes:bigint>>,blkio_stats:struct<io_service_bytes_recursive:array<struct<op:string,value:bigint>>>>"
)

TASK_DOCUMENT = (
    "action string, uid string, user string, scheduleTime string, startTime string, updateTime string, updateMessage string, finishTime string, "
    "status string, result string, resultDescription string, runData string, priority string, schedule string, taskParameters string, taskResponse string, runAt string"
)
ENGINE_CONFIG = (
    "crawlScope struct<type:string,scopeType:string,startUrls:array<string>,includeLinked:boolean,maxDepth:int,urlPrefixes:array<string>,additionalPages:array<string>,"
    "excludePages:struct<textMatches:array<string>,regexMatches:array<string>>>, "
    "crawlLimits struct<maxPages:int,timeLimitSeconds:int,sizeLimitGB:double>, "
    "pageBehavior struct<autoScroll:boolean,autoClick:boolean,pageLoadLimitMs:int,delayAfterPageLoadMs:int,delayBeforeNextPageMs:int>, "
    "browserSettings struct<userAgent:string,language:string,proxyServer:string>"
)
WEBSITE_DOCUMENT = (
    "id bigint, name string, url string, displayName string, shortDescription string, longDescription string, doCrawl boolean, isDeleted boolean, suspendCrawlUntilTimestamp string, autoPublish boolean"
)

_CRAWL = "scope_type string, generate_cdx boolean, workers int, page_load_timeout int, disk_utilization int, time_limit int"
TABLES = {
    "tag": ("id bigint, name string"),
    "organisation": ("id bigint, name string, slug string, created_at timestamp, parentId int"),
    "user_profile": ("id bigint, user_id bigint, organisation_id bigint, phone string, emailActivated boolean, status string"),
    "website_crawl_parameters": (
        f"id bigint, {_CRAWL}, name string, description string, is_default boolean, engine_type string, start_urls array<string>, include_linked boolean, max_depth int, "
        "url_prefixes array<string>, additional_pages array<string>, exclude_text_matches array<string>, exclude_regex_matches array<string>, max_pages int, size_limit_gb double, "
        "auto_scroll boolean, auto_click boolean, post_load_delay_ms int, page_extra_delay_ms int, user_agent string, language string, proxy_server string, "
        "extra_config map<string,string>, created_at timestamp, updated_at timestamp"
    ),
    "website": (
        "id bigint, organisation_id bigint, website_crawl_parameters_id bigint, name string, url string, isDeleted boolean, auto_publish boolean, displayName string, shortDescription string, "
        f"longDescription string, doCrawl boolean, suspendCrawlUntilTimestamp timestamp, created_by bigint, created_at timestamp, {_CRAWL}, enabled boolean"
    ),
    "website_tags": ("website_id bigint, tag_id bigint"),
    "website_group": ("id bigint, name string, description string"),
    "website_group_websites": ("website_group_id bigint, website_id bigint"),
    "snapshot": (
        "id bigint, website_id bigint, uid string, created_by bigint, created_at timestamp, status string, progress double, stats string, machine string, error string, published boolean, "
        "auto_update boolean, result string, rq_job_id string, isDeleted boolean, publication_status string, crawlStartTimestamp timestamp, crawlStopTimestamp timestamp, size bigint, "
        "item_count bigint, warc_path string, replay_collection_id string, process_id string, process_stats string, crawl_stats string, container_stats string, crawler string, "
        "crawlerConfiguration string, crawlerOutput string, crawlWarcSize bigint, crawlJustification string, publicationJustification string, updated_at timestamp"
    ),
    "crawl_config": ("id bigint, parentId int, name string, description string, status string, crawlEngine string, yamlConfig string"),
    "schedule_config": ("id bigint, parentId int, name string, description string, status string, yamlConfig string"),
    "task": (
        "id bigint, uid string, snapshot_id bigint, action string, user string, scheduleTime timestamp, startTime timestamp, finishTime timestamp, updateTime timestamp, updateMessage string, "
        "status string, result string, resultDescription string, runData string, created_at timestamp, priority string, schedule string, taskParameters string, taskResponse string"
    ),
    "warc": ("id bigint, snapshot_id bigint, filename string, path string, size_bytes bigint, sha256 string, created_at timestamp, is_production boolean"),
    "global_config": ("id bigint, key string, value string, entry_class string"),
    "task_response_delivery": ("uid string, payload string, target_url string, http_method string, http_status int, response_body string, success boolean, error_message string, created_at timestamp, task_id bigint"),
    "snapshot_response_delivery": ("uid string, payload string, target_url string, http_method string, http_status int, response_body string, success boolean, error_message string, created_at timestamp, snapshot_id bigint"),
}

ENUMS = {
    ("snapshot", "status"): ("pending", "crawling", "suspended", "stopped", "cancelled", "completed", "failed"),
    ("snapshot", "publication_status"): ("internal", "public"),
    ("task", "status"): ("scheduled", "created", "running", "paused", "stopped", "cancelled", "success", "failed"),
    ("task", "priority"): ("low", "normal", "high", "priority"),
    ("user_profile", "status"): ("request", "active", "suspended", "closed"),
    ("crawl_config", "status"): ("disabled", "restricted", "predefined", "custom"),
    ("schedule_config", "status"): ("disabled", "restricted", "predefined", "custom"),
}


def violations(df, table: str):
    """Rows of a table with a value outside its enumerations."""
    from pyspark.sql import functions as F

    test = F.lit(False)
    for (name, column), values in ENUMS.items():
        if name == table and column in df.columns:
            test = test | (F.col(column).isNotNull() & ~F.col(column).isin(*values))
    return df.where(test)
