"""Queries of change feeds, resume, paging and samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import incremental as inc
from ..operators import ordering
from .derive import FEED_SQL, base_items, change_feed
from .registry import Tables, query


def _latest(t: Tables) -> DataFrame:
    return inc.latest_per_key(change_feed(t), ["item_id"])


@query("latest_per_key", f"WITH {FEED_SQL} SELECT list_guid, item_id, change_type, title, seq FROM latest")
def latest_per_key(t: Tables) -> DataFrame:
    return _latest(t)


@query(
    "apply_changes",
    f"""WITH {FEED_SQL} SELECT list_guid, item_id, title FROM base WHERE item_id NOT IN (SELECT item_id FROM latest)
UNION ALL SELECT list_guid, item_id, title FROM latest WHERE change_type <> 'Delete'""",
)
def apply_changes(t: Tables) -> DataFrame:
    return inc.apply_latest(base_items(t), _latest(t))


@query(
    "apply_unordered_changes",
    """SELECT c_custkey AS item_id, c_mktsegment AS title FROM customer WHERE c_custkey NOT IN (SELECT user_id FROM events WHERE event_type IN ('error', 'signup'))
UNION ALL SELECT user_id, 'n' || count(*) FROM events WHERE event_type = 'signup' GROUP BY user_id""",
)
def apply_unordered_changes(t: Tables) -> DataFrame:
    """Sets without an order: a key that is both changed and deleted stays, changed."""
    feed = change_feed(t).drop("title")
    changed = feed.join(t.events.filter("event_type = 'signup'").select(F.col("event_id").alias("seq")), "seq", "left_semi")
    upserts = changed.groupBy("list_guid", "item_id").agg(F.concat(F.lit("n"), F.count(F.lit(1)).cast("string")).alias("title"))
    deletes = feed.filter("change_type = 'Delete'").select("list_guid", "item_id")
    return inc.apply_changes(base_items(t), upserts, deletes).select("item_id", "title")


@query(
    "sync_report",
    f"""WITH {FEED_SQL}, k AS (SELECT list_guid, item_id, count(*) FILTER (change_type = 'Update') AS u, count(*) FILTER (change_type = 'Delete') AS d FROM latest GROUP BY ALL)
SELECT k.list_guid, CAST(sum(u) AS BIGINT) AS updated, CAST(sum(d) AS BIGINT) AS deleted, count(b.item_id) AS replaced,
  count(b.item_id) FILTER (d > 0 AND u = 0) AS removed FROM k LEFT JOIN base b ON k.item_id = b.item_id GROUP BY k.list_guid""",
)
def sync_report(t: Tables) -> DataFrame:
    return inc.sync_report(base_items(t), *inc.split_changes(_latest(t)))


_ITEMS_SQL = "items AS (SELECT o_orderpriority AS list_guid, o_orderkey AS item_id, o_orderstatus AS title FROM orders)"


def _items(t: Tables) -> DataFrame:
    return t.orders.select(F.col("o_orderpriority").alias("list_guid"), F.col("o_orderkey").alias("item_id"), F.col("o_orderstatus").alias("title"))


_STATE_SQL = """state AS (SELECT list_guid, CASE substr(list_guid, 1, 1) WHEN '1' THEN 'complete' WHEN '2' THEN 'in_progress' WHEN '3' THEN 'failed' WHEN '4' THEN 'pending' ELSE 'complete' END AS status,
  CASE WHEN substr(list_guid, 1, 1) IN ('1', '2') THEN max(item_id) // 2 ELSE 0 END AS last_item_id, count(*) AS items_written,
  CASE WHEN substr(list_guid, 1, 1) IN ('1', '2', '5') THEN 'token' END AS change_token, NULL AS error FROM items GROUP BY list_guid)"""


def _state(t: Tables) -> DataFrame:
    head = F.substring("list_guid", 1, 1)
    status = F.when(head == "1", "complete").when(head == "2", "in_progress").when(head == "3", "failed").when(head == "4", "pending").otherwise("complete")
    per_list = _items(t).groupBy("list_guid").agg(F.max("item_id").alias("top"), F.count(F.lit(1)).alias("items_written"))
    return per_list.select(
        "list_guid", status.alias("status"), F.when(head.isin("1", "2"), F.expr("top div 2")).otherwise(0).alias("last_item_id"), "items_written",
        F.when(head.isin("1", "2", "5"), "token").alias("change_token"), F.when(status == "failed", "timeout").alias("error"),
    )


# One list has no state, and one no checkpoint.
_GAPS_SQL = f"{_STATE_SQL}, gaps AS (SELECT list_guid, status, CASE WHEN substr(list_guid, 1, 1) <> '3' THEN last_item_id END AS last_item_id FROM state WHERE substr(list_guid, 1, 1) <> '4')"


def _gaps(t: Tables) -> DataFrame:
    head = F.substring("list_guid", 1, 1)
    return _state(t).filter(head != "4").withColumn("last_item_id", F.when(head != "3", F.col("last_item_id")))


@query(
    "truncate_after",
    f"""WITH {_ITEMS_SQL}, {_GAPS_SQL} SELECT i.list_guid, item_id, title FROM items i LEFT JOIN gaps USING (list_guid)
WHERE status IS NULL OR status = 'complete' OR coalesce(last_item_id, 0) = 0 OR item_id <= last_item_id""",
)
def truncate_after(t: Tables) -> DataFrame:
    return inc.truncate_after(_items(t), _gaps(t)).select("list_guid", "item_id", "title")


@query(
    "append_new",
    f"""WITH {_ITEMS_SQL}, old AS (SELECT * FROM items WHERE item_id % 3 = 0 AND item_id < 700 AND list_guid <> '5-LOW')
SELECT i.* FROM items i LEFT JOIN (SELECT list_guid, max(item_id) AS high FROM old GROUP BY 1) h USING (list_guid) WHERE high IS NULL OR item_id > high""",
)
def append_new(t: Tables) -> DataFrame:
    old = _items(t).filter("item_id % 3 = 0 AND item_id < 700 AND list_guid <> '5-LOW'")
    return inc.append_new(old, _items(t))


@query("append_unseen", f"WITH {_ITEMS_SQL} SELECT * FROM items WHERE item_id % 3 <> 0")
def append_unseen(t: Tables) -> DataFrame:
    return inc.append_unseen(_items(t).filter("item_id % 3 = 0"), _items(t), ["list_guid", "item_id"])


@query(
    "route_changes",
    f"""WITH {_ITEMS_SQL}, {_STATE_SQL} SELECT list_guid, CASE WHEN change_token IS NULL OR status <> 'complete' OR substr(list_guid, 1, 1) = '5' THEN 'full_then_prime' ELSE 'incremental' END AS action,
  CASE WHEN change_token IS NULL OR status <> 'complete' THEN 'no_token' WHEN substr(list_guid, 1, 1) = '5' THEN 'token_invalid' END AS reason FROM state""",
)
def route_changes(t: Tables) -> DataFrame:
    invalid = (F.substring("list_guid", 1, 1) == "5") & (F.col("item_id") % 100 == 0)
    return inc.route_changes(_items(t).select("list_guid", invalid.alias("token_invalid")), _state(t), 12)


@query("route_changes_old_server", "SELECT DISTINCT o_orderpriority AS list_guid, 'full' AS action, 'no_change_tokens' AS reason FROM orders")
def route_changes_old_server(t: Tables) -> DataFrame:
    return inc.route_changes(_items(t).select("list_guid", F.lit(False).alias("token_invalid")), _state(t), 11)


@query(
    "route_resume",
    f"""WITH {_ITEMS_SQL}, {_GAPS_SQL}, r AS (SELECT list_guid, CASE WHEN status = 'complete' THEN 'skip' WHEN last_item_id <> 0 THEN 'continue' ELSE 'reset' END AS action,
  CASE WHEN status <> 'complete' THEN coalesce(last_item_id, 0) ELSE 0 END AS after_id FROM (SELECT DISTINCT list_guid FROM items) LEFT JOIN gaps USING (list_guid))
SELECT r.list_guid, action, CAST(after_id AS BIGINT) AS after_id, count(i.item_id) AS to_load FROM r LEFT JOIN items i ON r.list_guid = i.list_guid AND action <> 'skip' AND item_id > after_id GROUP BY ALL""",
)
def route_resume(t: Tables) -> DataFrame:
    routes = inc.route_resume(_gaps(t), _items(t))
    known = inc.route_resume(_gaps(t))
    loads = inc.pages_to_load(_items(t), known).groupBy("list_guid").agg(F.count(F.lit(1)).alias("n"))
    return routes.join(loads, "list_guid", "left").select("list_guid", "action", "after_id", F.coalesce("n", F.lit(0)).alias("to_load"))


@query(
    "advance_state",
    f"""WITH {_ITEMS_SQL}, {_STATE_SQL}, changed AS (SELECT list_guid, max(item_id) AS high FROM items WHERE item_id % 7 = 0 AND list_guid < '4' GROUP BY 1), cnt AS (SELECT list_guid, count(*) AS n FROM items WHERE item_id % 2 = 0 GROUP BY 1)
SELECT list_guid, CASE WHEN high IS NOT NULL THEN 'complete' ELSE status END AS status, greatest(last_item_id, coalesce(high, 0)) AS last_item_id, n AS items_written,
  CASE WHEN list_guid < '4' THEN 'next' ELSE change_token END AS change_token, CAST(NULL AS VARCHAR) AS error,
  CASE WHEN list_guid < '4' THEN TIMESTAMP '2024-01-31 12:00:00' END AS last_sync FROM state LEFT JOIN changed USING (list_guid) LEFT JOIN cnt USING (list_guid)""",
)
def advance_state(t: Tables) -> DataFrame:
    changed = _items(t).filter("item_id % 7 = 0 AND list_guid < '4'")
    tokens = changed.select("list_guid").distinct().withColumn("change_token", F.lit("next"))
    at = F.lit("2024-01-31 12:00:00").cast("timestamp")
    after = inc.advance_state(_state(t), changed, tokens, _items(t).filter("item_id % 2 = 0"), at)
    return after.withColumn("last_sync", F.col("last_sync").cast("timestamp_ntz"))


@query(
    "append_schema_report",
    f"""WITH {_ITEMS_SQL}, n AS (SELECT list_guid, count(*) AS of_rows, count(*) FILTER (item_id % 13 = 0) AS no_id, count(*) FILTER (title = 'P') AS no_web FROM items GROUP BY list_guid)
SELECT list_guid, 'item_id' AS key, 'stored' AS side, no_id AS rows, of_rows FROM n WHERE no_id > 0
UNION ALL SELECT list_guid, 'web', 'stored', of_rows, of_rows FROM n UNION ALL SELECT list_guid, 'web', 'incoming', no_web, of_rows FROM n WHERE no_web > 0
UNION ALL SELECT list_guid, 'lost', s.side, of_rows, of_rows FROM n, (VALUES ('stored'), ('incoming')) AS s(side)""",
)
def append_schema_report(t: Tables) -> DataFrame:
    """Stored rows that have lost some ids and have no web yet, incoming ones of which some have none."""
    stored = _items(t).withColumn("item_id", F.when(F.col("item_id") % 13 != 0, F.col("item_id")))
    incoming = _items(t).withColumn("web", F.when(F.col("title") != "P", F.lit("w")))
    return inc.append_schema_report(stored, incoming, ["item_id", "web", "lost"])


@query("state_summary", f"WITH {_ITEMS_SQL}, {_STATE_SQL} SELECT status, count(*) AS lists FROM state GROUP BY status")
def state_summary(t: Tables) -> DataFrame:
    from ..operators.reports import state_summary as summary

    return summary(_state(t))


@query("failed_lists", f"WITH {_ITEMS_SQL}, {_STATE_SQL} SELECT list_guid, 'timeout' AS error FROM state WHERE status = 'failed'")
def failed_lists(t: Tables) -> DataFrame:
    from ..operators.reports import failed_lists as failed

    return failed(_state(t))


@query(
    "snapshot_diff",
    """SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN 'added' WHEN doc_id % 7 = 0 THEN 'removed' ELSE 'changed' END AS change FROM documents
WHERE (doc_id % 5 = 0) <> (doc_id % 7 = 0) OR (doc_id % 5 <> 0 AND doc_id % 7 <> 0 AND doc_id % 11 = 0)""",
)
def snapshot_diff(t: Tables) -> DataFrame:
    def shaped(text: Column, moved: Column) -> DataFrame:
        """The same values in a map, a variant, and one of two columns."""
        names = F.create_map(F.lit("text"), text, F.lit("lang"), F.col("lang"))
        fields = F.parse_json(F.to_json(F.struct(text.alias("text"))))
        here, there = F.when(moved, None).otherwise(F.col("lang")), F.when(moved, F.col("lang"))
        return t.documents.select("doc_id", names.alias("names"), fields.alias("fields"), here.alias("a"), there.alias("b"))

    # Of the changed rows, every second one has its text edited, the others a value moved to the next column.
    changed = F.col("doc_id") % 11 == 0
    even = F.col("doc_id") % 2 == 0
    d = shaped(F.col("text"), F.lit(False))
    edited = shaped(F.when(changed & even, F.concat("text", F.lit("!"))).otherwise(F.col("text")), changed & ~even)
    # Documents divisible by both are in neither run.
    return inc.snapshot_diff(d.filter("doc_id % 5 <> 0"), edited.filter("doc_id % 7 <> 0"))


@query(
    "dual_completeness",
    """SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN 'raw_only' ELSE 'items_only' END AS side FROM documents WHERE (doc_id % 5 = 0) <> (doc_id % 7 = 0)""",
)
def dual_completeness(t: Tables) -> DataFrame:
    return inc.dual_completeness(t.documents.filter("doc_id % 5 <> 0"), t.documents.filter("doc_id % 7 <> 0"))


@query(
    "backend_parity",
    """SELECT o_orderkey AS doc_id, 'Total' AS field, CASE WHEN o_orderkey % 9 = 0 THEN 'left_only' WHEN o_orderkey % 8 = 0 THEN 'right_only' ELSE 'differs' END AS problem
FROM orders WHERE (o_orderkey % 9 = 0) <> (o_orderkey % 8 = 0) OR (o_orderkey % 9 <> 0 AND o_orderkey % 8 <> 0 AND o_orderkey % 10 = 1)""",
)
def backend_parity(t: Tables) -> DataFrame:
    k = F.col("o_orderkey")
    rows = t.orders.select(k.alias("doc_id"), F.lit("Total").alias("field"), F.col("o_totalprice").alias("v_double"), F.col("o_orderstatus").alias("v_string"))
    noise = F.when(F.col("doc_id") % 10 == 1, F.col("v_double") * 1.5).otherwise(F.col("v_double") * (1 + 1e-13))
    return inc.backend_parity(rows.filter("doc_id % 8 <> 0"), rows.withColumn("v_double", noise).filter("doc_id % 9 <> 0"), ["v_double", "v_string"])


_PAGED_SQL = f"{_ITEMS_SQL}, paged AS (SELECT *, row_number() OVER (PARTITION BY list_guid ORDER BY item_id) AS row_no FROM items)"


def _paged(t: Tables) -> DataFrame:
    return ordering.assign_pages(_items(t), ["list_guid"], [F.col("item_id")], 200)


@query("assign_pages", f"WITH {_PAGED_SQL} SELECT list_guid, item_id, title, row_no, CAST(ceil(row_no / 200.0) AS BIGINT) AS page_no FROM paged")
def assign_pages(t: Tables) -> DataFrame:
    return _paged(t)


@query(
    "page_progress",
    f"""WITH {_PAGED_SQL}, p AS (SELECT list_guid, CAST(ceil(row_no / 200.0) AS BIGINT) AS page_no, count(*) AS rows, max(item_id) AS checkpoint_id, max(row_no) AS written FROM paged GROUP BY ALL),
c AS (SELECT list_guid, count(*) AS item_count FROM items GROUP BY 1)
SELECT p.*, c.item_count, CAST(round_even(written * 100 / item_count, 0) AS INTEGER) AS percent FROM p JOIN c USING (list_guid)""",
)
def page_progress(t: Tables) -> DataFrame:
    totals = _items(t).groupBy("list_guid").agg(F.count(F.lit(1)).alias("item_count"))
    return ordering.page_progress(_paged(t), ["list_guid"], "item_id", totals)


_STALL_SQL = f"""{_PAGED_SQL}, p AS (SELECT list_guid, CAST(ceil(row_no / 20.0) AS BIGINT) AS page_no, max(item_id) AS top FROM paged GROUP BY ALL),
pages AS (SELECT list_guid, page_no, CASE WHEN page_no % 7 = 0 AND list_guid > '3' THEN 1 ELSE top END AS max_id FROM p),
stalled AS (SELECT list_guid, min(page_no) AS stalled_page FROM (SELECT *, lag(max_id) OVER (PARTITION BY list_guid ORDER BY page_no) AS prev FROM pages) WHERE max_id <= coalesce(prev, 0) GROUP BY 1)"""


def _stall_pages(t: Tables) -> DataFrame:
    pages = ordering.page_progress(ordering.assign_pages(_items(t), ["list_guid"], [F.col("item_id")], 20), ["list_guid"], "item_id")
    broken = (F.col("page_no") % 7 == 0) & (F.col("list_guid") > "3")
    return pages.select("list_guid", "page_no", F.when(broken, F.lit(1)).otherwise(F.col("checkpoint_id")).alias("max_id"))


@query("find_stalled_pages", f"WITH {_STALL_SQL} SELECT * FROM stalled")
def find_stalled_pages(t: Tables) -> DataFrame:
    return ordering.find_stalled_pages(_stall_pages(t), ["list_guid"])


@query("accepted_pages", f"WITH {_STALL_SQL} SELECT pages.* FROM pages LEFT JOIN stalled USING (list_guid) WHERE stalled_page IS NULL OR page_no < stalled_page")
def accepted_pages(t: Tables) -> DataFrame:
    return ordering.accepted_pages(_stall_pages(t), ["list_guid"])


@query("limit_new_rows", f"WITH {_PAGED_SQL} SELECT list_guid, item_id FROM paged WHERE row_no <= 600")
def limit_new_rows(t: Tables) -> DataFrame:
    return ordering.limit_new_rows(_paged(t), 450, 200).select("list_guid", "item_id")


@query(
    "stratified_pick",
    """WITH r AS (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS turn, min(doc_id) OVER (PARTITION BY source) AS first_seen FROM documents)
SELECT source, doc_id, turn FROM r ORDER BY turn, first_seen LIMIT 50""",
)
def stratified_pick(t: Tables) -> DataFrame:
    return ordering.stratified_pick(t.documents.select("source", "doc_id"), "source", "doc_id", 50).select("source", "doc_id", F.col("turn").cast("bigint").alias("turn"))


@query(
    "spread_sample",
    """WITH r AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS idx, greatest(1, count(*) OVER () // 200) AS step FROM orders)
SELECT o_orderkey FROM r WHERE idx % step = 0 AND idx < step * 200""",
)
def spread_sample(t: Tables) -> DataFrame:
    return ordering.spread_sample(t.orders.select("o_orderkey", "o_orderdate"), [F.col("o_orderdate"), F.col("o_orderkey")], 200).select("o_orderkey")


@query(
    "unique_file_names",
    """WITH f AS (SELECT doc_id, source AS item, CASE WHEN doc_id % 9 = 4 THEN lang || '(' || (doc_id % 4) || ').txt' ELSE lang || '.txt' END AS name FROM documents),
r AS (SELECT *, row_number() OVER (PARTITION BY item, name ORDER BY doc_id) AS copy FROM f),
used AS (SELECT DISTINCT item, regexp_extract(name, '^(.*)\\((\\d+)\\)(\\.txt)$', 1) || '.txt' AS name, CAST(regexp_extract(name, '^(.*)\\((\\d+)\\)', 2) AS BIGINT) AS num FROM f WHERE name LIKE '%(%'),
free AS (SELECT n.item, n.name, g.num, row_number() OVER (PARTITION BY n.item, n.name ORDER BY g.num) AS d
  FROM (SELECT item, name, max(copy) + 4 AS top FROM r GROUP BY ALL) n, (SELECT unnest(generate_series(1, (SELECT count(*) FROM documents))) AS num) g
  WHERE g.num <= top AND (n.item, n.name, g.num) NOT IN (SELECT item, name, num FROM used))
SELECT r.doc_id, CASE WHEN copy = 1 THEN r.name ELSE regexp_replace(r.name, '\\.txt$', '') || '(' || free.num || ').txt' END AS unique_name
FROM r LEFT JOIN free ON r.item = free.item AND r.name = free.name AND free.d = copy - 1""",
)
def unique_file_names(t: Tables) -> DataFrame:
    k = F.col("doc_id")
    numbered = F.concat("lang", F.lit("("), (k % 4).cast("string"), F.lit(").txt"))
    files = t.documents.select("doc_id", F.col("source").alias("item"), F.when(k % 9 == 4, numbered).otherwise(F.concat("lang", F.lit(".txt"))).alias("name"))
    return ordering.unique_file_names(files, "item", "name", "doc_id").select("doc_id", "unique_name")


@query("top_lists", "SELECT CAST(l_suppkey AS VARCHAR) AS list_guid, count(*) AS items FROM lineitem GROUP BY 1 ORDER BY items DESC, list_guid LIMIT 40")
def top_lists(t: Tables) -> DataFrame:
    stats = t.lineitem.groupBy(F.col("l_suppkey").cast("string").alias("list_guid")).agg(F.count(F.lit(1)).alias("items"))
    return ordering.top_lists(stats)
