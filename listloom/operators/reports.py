"""Coverage, state, access and error reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed, names
from .scope import base_type_name
from .text import is_throttled


def _sum(c: str | Column) -> Column:
    return F.coalesce(F.sum(c), F.lit(0)).cast("bigint")


def landing_stats(lists: DataFrame, items: DataFrame, attachments: DataFrame) -> DataFrame:
    """Items, files and bytes per list with web totals and a grand total.

    ``level`` is 0 for a list, 1 for a web and 3 for everything. Lists without rows
    appear with 0. Both fact tables are counted per list before the join.
    """
    per_list = items.groupBy("list_guid").agg(F.count(F.lit(1)).alias("items"))
    per_file = attachments.groupBy("list_guid").agg(
        F.count(F.lit(1)).alias("files"), F.sum("bytes").alias("file_bytes")
    )
    joined = (
        lists.select(F.col("guid").alias("list_guid"), "web_url")
        .join(per_list, "list_guid", "left")
        .join(per_file, "list_guid", "left")
    )
    return joined.rollup("web_url", "list_guid").agg(
        F.grouping_id().cast("bigint").alias("level"),
        F.count(F.lit(1)).alias("lists"),
        _sum("items").alias("items"),
        _sum("files").alias("files"),
        _sum("file_bytes").alias("file_bytes"),
    )


def state_summary(list_state: DataFrame) -> DataFrame:
    return list_state.groupBy("status").agg(F.count(F.lit(1)).alias("lists"))


def failed_lists(list_state: DataFrame) -> DataFrame:
    return list_state.filter(F.col("status") == "failed").select("list_guid", "error")


def run_counts(
    webs: DataFrame, lists: DataFrame, list_state: DataFrame, attachments: DataFrame, warnings: DataFrame, edges: DataFrame, synced: DataFrame
) -> DataFrame:
    """The 13 counters of a run as (counter, n) rows; each input is read once."""
    state = F.col("status")
    parts = [
        webs.agg(F.count(F.lit(1)).alias("webs_discovered")),
        lists.agg(F.count(F.lit(1)).alias("lists_discovered"), F.count_if("in_scope").alias("lists_in_scope")),
        list_state.agg(
            F.count_if(state == "complete").alias("lists_succeeded"),
            F.count_if(state == "failed").alias("lists_failed"),
            F.count_if(state == "skipped").alias("lists_skipped"),
            _sum("items_written").alias("items_written"),
        ),
        synced.agg(_sum("deleted").alias("items_deleted")),
        attachments.agg(
            F.count_if("downloaded").alias("files_downloaded"),
            F.count_if(~F.col("downloaded") & F.col("skip_reason").isNotNull()).alias("files_skipped"),
            _sum(F.when(F.col("downloaded"), F.col("bytes"))).alias("file_bytes"),
        ),
        warnings.agg(F.count(F.lit(1)).alias("decoder_warnings")),
        edges.agg(F.count_if("dangling").alias("dangling_edges")),
    ]
    rows = [
        p.select(F.inline(F.array(*[F.struct(F.lit(c).alias("counter"), F.col(c).cast("bigint").alias("n")) for c in p.columns])))
        for p in parts
    ]
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out


def skip_reasons(attachments: DataFrame) -> DataFrame:
    """Skipped files by the reason in front of the first colon."""
    reason = F.substring_index("skip_reason", ":", 1).alias("reason")
    return attachments.filter(F.col("skip_reason").isNotNull()).groupBy(reason).agg(F.count(F.lit(1)).alias("n"))


def estimate_extraction(lists: DataFrame, page_size: int, downloads: bool) -> DataFrame:
    """Pages and requests a full read of each list takes."""
    n = F.coalesce(F.col("item_count"), F.lit(0))
    pages = F.greatest(F.lit(1), F.ceil(n / page_size)).cast("bigint")
    per_file = F.when(F.lit(downloads) & ((F.col("base_type") == "1") | F.col("enable_attachments")), n).otherwise(F.lit(0))
    return lists.select(
        "web_url",
        F.col("guid").alias("list_guid"),
        F.col("title").alias("list_title"),
        base_type_name(F.col("base_type")).alias("base_type"),
        n.cast("bigint").alias("items"),
        pages.alias("pages"),
        (pages + 1 + per_file).cast("bigint").alias("estimated_requests"),
        "has_unique_scopes",
    )


def estimate_totals(estimates: DataFrame, webs: DataFrame, rate: float) -> DataFrame:
    """One row: webs, lists, items, requests and minutes at ``rate`` requests per second."""
    rows = estimates.select(F.lit(0).alias("web"), F.lit(1).alias("list"), "items", "estimated_requests").unionByName(
        webs.select(F.lit(1).alias("web"), F.lit(0).alias("list"), F.lit(0).cast("bigint").alias("items"), F.lit(1).cast("bigint").alias("estimated_requests"))
    )
    requests = _sum("estimated_requests") + 1
    return rows.agg(
        _sum("web").alias("webs"),
        _sum("list").alias("lists"),
        _sum("items").alias("items"),
        requests.alias("estimated_requests"),
        F.bround(requests / (rate or 1) / 60, 1).alias("estimated_minutes"),
    )


def collection_sizes(counts: DataFrame) -> DataFrame:
    """Collections biggest first, unreadable ones last; reads name, entries and error."""
    folded = F.replace(F.lower("name"), F.lit("ß"), F.lit("ss"))
    flagged = counts.withColumn("oversized", F.coalesce(F.col("entries") > fixed.VIEW_THRESHOLD, F.lit(False)))
    return flagged.orderBy(F.col("entries").isNull(), F.desc("entries"), folded)


def collection_totals(counts: DataFrame) -> DataFrame:
    return counts.agg(
        F.count(F.lit(1)).alias("collections"),
        _sum("entries").alias("entries"),
        F.count_if(F.col("entries").isNull()).alias("failed"),
        F.count_if(F.col("entries") == 0).alias("empty"),
        F.count_if(F.col("entries") > fixed.VIEW_THRESHOLD).alias("oversized"),
    )


def oversized_lists(lists: DataFrame, major: int | None) -> DataFrame:
    """Lists a throttling server would refuse to scan, as one line each."""
    line = F.format_string("%s :: %s (%,d items)", "web_url", "title", "item_count").alias("line")
    if major is None or major < fixed.THRESHOLD_SINCE_MAJOR:
        return lists.filter(F.lit(False)).select(line)
    return lists.filter(F.col("item_count") > fixed.VIEW_THRESHOLD).select(line)


def unique_scope_lists(lists: DataFrame) -> DataFrame:
    return lists.filter("has_unique_scopes").select(F.format_string("%s :: %s", "web_url", "title").alias("line"))


def access_by_web(web_access: DataFrame, list_access: DataFrame) -> DataFrame:
    """Per web: readable or why not, its lists and how many of them are readable."""
    per_web = list_access.groupBy("web_url").agg(
        F.count(F.lit(1)).alias("lists"),
        F.count_if("readable").alias("readable_lists"),
        F.count_if("has_unique_scopes").alias("unique_scope_lists"),
    )
    zero = F.lit(0).cast("bigint")
    return web_access.join(per_web, "web_url", "left").select(
        "web_url", "readable", "reason", *[F.coalesce(c, zero).alias(c) for c in ("lists", "readable_lists", "unique_scope_lists")]
    )


def access_summary(by_web: DataFrame) -> DataFrame:
    return by_web.agg(
        F.count_if("readable").alias("readable_webs"),
        F.count_if(~F.col("readable")).alias("denied_webs"),
        _sum("lists").alias("total_lists"),
        _sum("readable_lists").alias("readable_lists"),
        _sum("unique_scope_lists").alias("unique_scope_lists"),
        F.coalesce(F.every(F.col("readable") & (F.col("lists") == F.col("readable_lists"))), F.lit(True)).alias("complete"),
    )


def access_details(list_access: DataFrame) -> DataFrame:
    """Lists in report order: denied first, then by size."""
    return list_access.orderBy("web_url", F.col("readable").asc(), F.desc("item_count"))


def file_census(attachments: DataFrame, name: str, by: str, item: str) -> DataFrame:
    """Files and distinct items that carry one: by list and kind, by list, by kind and over all.

    ``level`` tells them apart; ``list`` and ``kind`` are NULL where a level runs over all of them. One pass over the
    files for all levels. ``item`` has to tell items of different lists apart. A list of NULL is a list of its own.
    """
    rows = attachments.select(F.col(by).alias("list"), names.file_kind(F.col(name)).alias("kind"), F.col(item).alias("_item"))
    both = [F.col("list"), F.col("kind")]
    counted = rows.groupingSets([both, both[:1], both[1:], []], *both).agg(
        F.grouping_id().alias("_level"), F.count(F.lit(1)).alias("files"), F.countDistinct("_item").alias("items")
    )
    level = F.element_at(F.array(*[F.lit(x) for x in ("list and kind", "list", "kind", "all")]), (F.col("_level") + 1).cast("int"))
    return counted.select(level.alias("level"), "list", "kind", "files", "items")


def error_report(run_errors: DataFrame) -> DataFrame:
    """Errors per scope, list and type, throttling faults counted apart."""
    marked = run_errors.withColumn("throttled", is_throttled(F.col("message")))
    return marked.groupBy("scope", "list_guid", "error_type").agg(
        F.count(F.lit(1)).alias("errors"), F.count_if("throttled").alias("throttled")
    )


def ingest_gate(counts: DataFrame) -> DataFrame:
    """One row: may the run be ingested; not while a list has failed."""
    failed = _sum(F.when(F.col("counter") == "lists_failed", F.col("n")))
    return counts.agg(failed.alias("lists_failed"), (failed == 0).alias("accepted"))


def require_ingestible(counts: DataFrame) -> None:
    row = ingest_gate(counts).first()
    if not row["accepted"]:
        raise ValueError(f"{row['lists_failed']} lists failed; the run must not be ingested")


# Rank error of a quantile from a sketch of this size, with 99 % confidence; a sketch takes some kilobytes.
SKETCH_SIZE = 800
SKETCH_ERROR = 0.01


def traffic_sketches(request_log: DataFrame, by: Sequence[str] = ("operation", "status")) -> DataFrame:
    """Sums and a KLL sketch of the durations per group; rows of finer groups, days say, can be merged later."""
    return request_log.groupBy(*by).agg(
        F.count(F.lit(1)).alias("requests"),
        _sum("bytes").alias("bytes"),
        F.sum("duration").alias("duration"),
        F.coalesce(F.sum("wait"), F.lit(0.0)).alias("wait"),
        F.sum("rows").alias("rows"),
        F.count("duration").alias("timed"),
        F.kll_sketch_agg_double(F.col("duration").cast("double"), SKETCH_SIZE).alias("durations"),
    )


def merge_traffic(sketches: DataFrame, by: Sequence[str] = ("operation", "status"), quantile: float = 0.5) -> DataFrame:
    """The traffic report from sketches of equal or finer groups.

    ``median_duration`` is a duration whose rank is within ``SKETCH_ERROR`` of the middle; it is NULL where no request was timed.
    """
    merged = sketches.groupBy(*by).agg(
        F.sum("requests").alias("requests"),
        F.sum("bytes").alias("bytes"),
        F.sum("duration").alias("duration"),
        F.sum("wait").alias("wait"),
        F.sum("rows").alias("rows"),
        F.sum("timed").alias("timed"),
        F.kll_merge_agg_double("durations").alias("durations"),
    )
    middle = F.when(F.col("timed") > 0, F.kll_sketch_get_quantile_double("durations", F.lit(quantile)))
    speed = F.try_divide(F.col("rows"), F.col("duration"))
    return merged.select(*by, "requests", "bytes", "duration", "wait", middle.alias("median_duration"), speed.alias("rows_per_second"))


def traffic_report(request_log: DataFrame) -> DataFrame:
    """Requests, bytes, time, wait, median duration and rows per second by operation and status."""
    return merge_traffic(traffic_sketches(request_log))
