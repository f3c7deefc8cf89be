"""Queries of readers, writers and streams.

Each query lets Spark write captured pages derived from the test tables below the
shared folder, then reads them back through the library.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import decode, graph, scope
from ..operators import files as file_rows
from ..operators.incremental import latest_items
from ..session import scratch_path, store
from ..sinks import contract
from ..sinks import landing as sink
from ..sources import captured
from ..sources import landing as source
from ..streaming import feeds
from .derive import FEED_SQL, base_items, change_feed, clock, money, order_fields, order_rows, raw_orders, segment_lists
from .registry import Tables, query
from .relating import customer_lists

PAGE = 200
LEAST_TASKS = 200
TASK_ITEMS = 25_000
# The extension whose files are not fetched.
EXCLUDED = ".pdf"
ORDER_COLUMNS = ["ID", "Title", "Customer", "Total", "Opened"]


def _escaped(c: Column) -> Column:
    for char, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        c = F.replace(c, F.lit(char), F.lit(entity))
    return c


def _tag(name: str, attributes: dict[str, Column], body: Column | None = None) -> Column:
    """One XML element; NULL attributes are left out."""
    pairs = [
        F.coalesce(F.concat(F.lit(f' {a}="'), _escaped(c), F.lit('"')), F.lit("")) for a, c in attributes.items()
    ]
    end = [F.lit("/>")] if body is None else [F.lit(">"), body, F.lit(f"</{name}>")]
    return F.concat(F.lit(f"<{name}"), *pairs, *end)


def _tasks(df: DataFrame) -> int:
    return max(LEAST_TASKS, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def _save(df: DataFrame, file: Column, element: Column, name: str) -> str:
    """Write captured elements as documents, one file per value of ``file``.

    ``file`` cuts a running number into runs of fixed length, so no document grows. Files are dealt to a
    fixed number of tasks: by the compressed size that Spark sees, documents many times larger would meet in one task.
    """
    rows = df.select(F.floor(file).cast("bigint").alias("file"), element.alias("element")).repartition(_tasks(df), "file")
    body = F.array_join(F.collect_list("element"), "")
    docs = rows.groupBy("file").agg(F.concat(F.lit('<?xml version="1.0"?>\n<captured>'), body, F.lit("</captured>")).alias("value"))
    path = scratch_path(df.sparkSession, name)
    docs.write.partitionBy("file").text(path)
    return path


def _rowset_files(t: Tables) -> str:
    """Orders as item pages of 200 rows; a page is the unit that is grouped."""
    key = F.col("o_orderkey").cast("string")
    values = [
        key, F.concat(F.lit(" Order & <"), key, F.lit(">")), F.concat(F.col("o_custkey").cast("string"), F.lit(";#"), F.col("c_name")),
        money("o_totalprice"), clock("o_orderdate"),
    ]
    row = _tag("z:row", {f"ows_{n}": v for n, v in zip(ORDER_COLUMNS, values, strict=True)})
    rows = order_rows(t).select(F.floor(F.col("o_orderkey") / PAGE).alias("page_no"), row.alias("row"))
    pages = rows.groupBy("page_no").agg(F.collect_list("row").alias("rows"))
    head = {"ItemCount": F.size("rows").cast("string"), "ListItemCollectionPositionNext": F.concat(F.lit("Paged=TRUE&p_ID="), F.col("page_no").cast("string"))}
    return _save(pages, F.col("page_no") / 50, _tag("rs:data", head, F.array_join("rows", "")), "rowset")


_ROWSET_SQL = """SELECT o_orderkey AS item_id, ' Order & <' || o_orderkey || '>' AS title, o_custkey || ';#' || c_name AS customer,
  CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) || '0000000000' AS total FROM orders JOIN customer ON o_custkey = c_custkey"""


def _shown(rows: DataFrame) -> DataFrame:
    def attr(name: str) -> Column:
        return F.try_element_at("raw", F.lit(f"ows_{name}"))

    return rows.select("item_id", attr("Title").alias("title"), attr("Customer").alias("customer"), attr("Total").alias("total"))


@query("read_rowset_pages", _ROWSET_SQL)
def read_rowset_pages(t: Tables) -> DataFrame:
    return _shown(captured.page_rows(captured.read_rowset_pages(t.spark, _rowset_files(t), ORDER_COLUMNS)))


@query(
    "rowset_page_info",
    f"SELECT 'Paged=TRUE&p_ID=' || o_orderkey // {PAGE} AS position_next, count(*) AS item_count, CAST(count(*) AS INTEGER) AS n FROM orders GROUP BY 1",
)
def rowset_page_info(t: Tables) -> DataFrame:
    pages = captured.read_rowset_pages(t.spark, _rowset_files(t), ORDER_COLUMNS)
    return pages.select("position_next", "item_count", F.size("rows").alias("n"))


CHANGE_COLUMNS = ["ID", "Title"]


def _change_files(t: Tables) -> str:
    """Events as change pages of 100; every page also deletes an id that is no number."""
    deleted = F.lower("change_type") == "delete"
    key = F.col("item_id").cast("string")
    gone = F.when(deleted, _tag("Id", {"ChangeType": F.lit("Delete")}, key))
    row = F.when(~deleted, _tag("z:row", {"ows_ID": key, "ows_Title": F.col("title")}))
    rows = change_feed(t).select(F.floor(F.col("seq") / 100).alias("page_no"), "seq", gone.alias("gone"), row.alias("row"))
    pages = rows.groupBy("page_no").agg(F.array_sort(F.collect_list(F.struct("seq", "gone", "row"))).alias("r"))
    # array_join leaves out the NULLs.
    ids = F.concat(_tag("Id", {"ChangeType": F.lit("Delete")}, F.lit("n/a")), F.array_join("r.gone", ""))
    changes = _tag("Changes", {"LastChangeToken": F.concat(F.lit("1;3;"), F.col("page_no").cast("string")), "MoreChanges": F.lit("TRUE")}, ids)
    listed = _tag("rs:data", {"ItemCount": F.size("r").cast("string")}, F.array_join("r.row", ""))
    return _save(pages, F.col("page_no") / 20, _tag("listitems", {}, F.concat(changes, listed)), "changes")


@query(
    "read_change_pages",
    """SELECT '1;3;' || event_id // 100 AS last_change_token, true AS more_changes, false AS token_invalid, CAST(count(*) FILTER (event_type = 'error') + 1 AS INTEGER) AS deleted,
  CAST(count(*) FILTER (event_type <> 'error') AS INTEGER) AS rows FROM events GROUP BY 1""",
)
def read_change_pages(t: Tables) -> DataFrame:
    pages = captured.read_change_pages(t.spark, _change_files(t), CHANGE_COLUMNS)
    return pages.select("last_change_token", "more_changes", "token_invalid", F.size("deleted").alias("deleted"), F.size("rows").alias("rows"))


@query("undecodable_deletes", "SELECT 'n/a' AS raw, 'undecodable_delete_id' AS event, count(DISTINCT event_id // 100) AS n FROM events")
def undecodable_deletes(t: Tables) -> DataFrame:
    pages = captured.read_change_pages(t.spark, _change_files(t), CHANGE_COLUMNS)
    return captured.undecodable_deletes(pages).groupBy("raw", "event").agg(F.count(F.lit(1)).alias("n"))


def _token_page(c: Column) -> Column:
    """Page number of a derived change page, taken from its token."""
    return F.substring_index(c, ";", -1).cast("bigint")


# Within a page all deletes come before all rows.
_PAGED_FEED_SQL = """feed AS (SELECT user_id AS item_id, event_type AS title, event_type = 'error' AS gone, event_id // 100 AS page, event_id FROM events),
latest AS (SELECT * FROM feed QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY page DESC, gone, event_id DESC) = 1)"""


def _paged_changes(t: Tables) -> DataFrame:
    pages = captured.read_change_pages(t.spark, _change_files(t), CHANGE_COLUMNS).withColumn("page_no", _token_page(F.col("last_change_token")))
    rows = captured.change_rows(pages, F.lit("{E}"))
    return rows.select("list_guid", "item_id", "change_type", F.try_element_at("raw", F.lit("ows_Title")).alias("title"), "seq")


@query("change_rows", f"WITH {_PAGED_FEED_SQL} SELECT item_id, CASE WHEN gone THEN 'delete' ELSE 'update' END AS change_type, CASE WHEN NOT gone THEN title END AS title FROM feed")
def change_rows(t: Tables) -> DataFrame:
    return _paged_changes(t).select("item_id", "change_type", "title")


@query(
    "change_stream",
    f"""WITH {_PAGED_FEED_SQL} SELECT c_custkey AS item_id, c_mktsegment AS title FROM customer WHERE c_custkey NOT IN (SELECT item_id FROM latest)
UNION ALL SELECT item_id, title FROM latest WHERE NOT gone""",
)
def change_stream(t: Tables) -> DataFrame:
    """The feed as a stream of pages applied to the customers, then folded in and read back."""
    spark, table = t.spark, scratch_path(t.spark, "table")
    base = t.customer.select(F.lit("{E}").alias("list_guid"), F.col("c_custkey").alias("item_id"), F.col("c_mktsegment").alias("title"))
    sink.publish_snapshot(base, table)
    pages = feeds.stream_change_pages(spark, _change_files(t), CHANGE_COLUMNS, F.lit("{E}"), 3)
    pages = pages.withColumn("page_no", _token_page(F.col("last_change_token")))

    def shape(rows: DataFrame) -> DataFrame:
        return rows.select("list_guid", "item_id", "change_type", F.try_element_at("raw", F.lit("ows_Title")).alias("title"), "seq")

    feeds.change_stream(pages, table, scratch_path(spark, "progress"), shape).awaitTermination()
    feeds.compact(spark, table)
    return feeds.current_rows(spark, table).select("item_id", "title")


# Pages are dealt to so many lists; every second one is refused in the middle of its feed.
_FEEDS = 4


@query(
    "change_stream_refused",
    f"""WITH p AS (SELECT user_id AS item_id, event_type AS title, event_type = 'error' AS gone, event_id // 100 AS page, event_id, (event_id // 100) % {_FEEDS} AS list FROM events),
stops AS (SELECT list, median_page AS stop FROM (SELECT list, min(page) + (max(page) - min(page)) // 2 AS median_page FROM p GROUP BY list) WHERE list % 2 = 1),
feed AS (SELECT p.* FROM p LEFT JOIN stops USING (list) WHERE stop IS NULL OR page < stop),
latest AS (SELECT * FROM feed QUALIFY row_number() OVER (PARTITION BY list, item_id ORDER BY page DESC, gone, event_id DESC) = 1),
base AS (SELECT l AS list, c_custkey AS item_id, c_mktsegment AS title FROM customer, range({_FEEDS}) AS r(l)),
rows AS (SELECT list, item_id, title FROM base ANTI JOIN latest USING (list, item_id) UNION ALL SELECT list, item_id, title FROM latest WHERE NOT gone)
SELECT 'few files a batch' AS run, 'L' || list AS list_guid, item_id, title FROM rows UNION ALL SELECT 'one batch', 'L' || list, item_id, title FROM rows""",
)
def change_stream_refused(t: Tables) -> DataFrame:
    """Four lists in one feed, two of them refused half-way: these end at that page, however the pages are cut into batches."""
    guid = F.concat(F.lit("L"), (_token_page(F.col("last_change_token")) % _FEEDS).cast("string"))
    lists = t.spark.range(_FEEDS).select(F.concat(F.lit("L"), F.col("id").cast("string")).alias("list_guid"))
    base = t.customer.select(F.col("c_custkey").alias("item_id"), F.col("c_mktsegment").alias("title")).join(F.broadcast(lists), F.lit(True)).select("list_guid", "item_id", "title")
    page = F.floor(F.col("event_id") / 100).cast("bigint")
    ends = t.events.groupBy((page % _FEEDS).alias("list")).agg(F.min(page).alias("a"), F.max(page).alias("b")).collect()  # one row a list
    refused = [r["a"] + (r["b"] - r["a"]) // 2 for r in ends if r["list"] % 2 == 1]
    # A stop falls on a page of its own list, or on the next one.
    files = _change_files(t)

    def shape(rows: DataFrame) -> DataFrame:
        return rows.select("list_guid", "item_id", "change_type", F.try_element_at("raw", F.lit("ows_Title")).alias("title"), "seq")

    def load(per_batch: int | None, run: str) -> DataFrame:
        table = scratch_path(t.spark, "table")
        sink.publish_snapshot(base, table)
        pages = feeds.stream_change_pages(t.spark, files, CHANGE_COLUMNS, guid, per_batch).withColumn("page_no", _token_page(F.col("last_change_token")))
        number = F.col("page_no")
        half = F.lit(False)
        for r, stop in zip([r for r in ends if r["list"] % 2 == 1], refused):
            half = half | ((number % _FEEDS == r["list"]) & (number >= stop) & (number < stop + _FEEDS))
        pages = pages.withColumn("token_invalid", half)
        feeds.change_stream(pages, table, scratch_path(t.spark, "progress"), shape).awaitTermination()
        return feeds.current_rows(t.spark, table).select(F.lit(run).alias("run"), "list_guid", "item_id", "title")

    return load(4, "few files a batch").unionByName(load(None, "one batch"))


@query("page_stream", _ROWSET_SQL)
def page_stream(t: Tables) -> DataFrame:
    spark, out = t.spark, scratch_path(t.spark, "streamed")
    pages = feeds.stream_pages(spark, _rowset_files(t), ORDER_COLUMNS, 4)
    feeds.page_stream(pages, out, scratch_path(spark, "progress")).awaitTermination()
    return _shown(spark.read.parquet(out))


@query("live_threads", "SELECT event_id, user_id, event_type, strftime(ts, '%Y-%m-%d %H:%M:%S') AS at FROM events")
def live_threads(t: Tables) -> DataFrame:
    """Every event sent twice; the repeat is dropped within the allowed lateness."""
    spark, path, out = t.spark, scratch_path(t.spark, "sent"), scratch_path(t.spark, "live")
    sent = t.events.select("event_id", "user_id", "event_type", F.col("ts").cast("timestamp").alias("ts"))
    sent.unionByName(sent).write.parquet(path)
    stream = spark.readStream.schema(sent.schema).parquet(path)
    live = feeds.live_threads(stream, "ts", ["event_id"], "60 days")
    job = live.writeStream.format("parquet").option("path", out).option("checkpointLocation", scratch_path(spark, "progress"))
    job.trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(sent.schema).parquet(out).select("event_id", "user_id", "event_type", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("at"))


@query(
    "live_children",
    """WITH p AS (SELECT event_id AS ticket, user_id, ts FROM events WHERE event_type = 'signup'),
c AS (SELECT event_id AS comment, user_id, ts FROM events WHERE event_type <> 'signup')
SELECT ticket, p.user_id, comment FROM p LEFT JOIN c ON c.user_id = p.user_id AND c.ts >= p.ts - INTERVAL 10 MINUTE AND c.ts <= p.ts + INTERVAL 6 HOUR""",
)
def live_children(t: Tables) -> DataFrame:
    """Signups with the user's other events around them, both as streams whose rows come in any order."""
    spark = t.spark
    events = t.events.select("event_id", "user_id", F.col("event_type") == "signup", F.col("ts").cast("timestamp").alias("ts")).toDF("event_id", "user_id", "opens", "ts")
    # A last row far ahead says on both sides that all is in.
    end = events.agg(F.max("ts").alias("ts")).select(F.lit(-1).cast("bigint").alias("event_id"), F.lit(-1).cast("bigint").alias("user_id"), (F.col("ts") + F.expr("INTERVAL 90 DAYS")).alias("ts"))

    def arriving(rows: DataFrame, key: str, at: str) -> DataFrame:
        path = scratch_path(spark, key)
        shown = [F.col("event_id").alias(key), F.col("user_id").alias(f"{key}_user"), F.col("ts").alias(at)]
        rows.select(*shown).repartition(4, F.xxhash64("event_id")).write.parquet(f"{path}/part=0")
        end.select(*shown).coalesce(1).write.parquet(f"{path}/part=1")
        return spark.readStream.schema(f"{key} bigint, {key}_user bigint, {at} timestamp").option("latestFirst", "false").parquet(f"{path}/part=*")

    tickets, comments = arriving(events.filter("opens"), "ticket", "opened"), arriving(events.filter("NOT opens"), "comment", "said")
    # The delay covers the whole table, since files of one stream come in any order.
    live = feeds.live_children(tickets, comments, "ticket_user", "comment_user", "opened", "said", "60 days", "10 MINUTES", "6 HOURS")
    out = scratch_path(spark, "live")
    job = live.select("ticket", F.col("ticket_user").alias("user_id"), "comment").writeStream.format("parquet").option("path", out)
    job.option("checkpointLocation", scratch_path(spark, "progress")).trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema("ticket bigint, user_id bigint, comment bigint").parquet(out).filter("ticket >= 0")


def _documents_of(t: Tables, body: Column, name: str, grouped: DataFrame) -> str:
    """One JSON document per row, each a file of its own."""
    path = scratch_path(t.spark, name)
    grouped.select(F.col("n_nationkey").alias("file"), body.alias("value")).repartition("file").write.partitionBy("file").text(path)
    return path


@query(
    "read_states",
    """SELECT '{C-' || c_custkey || '}' AS list_guid, 'http://farm/' || c_nationkey AS web_url, CASE c_custkey % 3 WHEN 0 THEN 'complete' WHEN 1 THEN 'failed' ELSE 'in_progress' END AS status,
  c_custkey * 10 AS last_item_id, CASE WHEN c_custkey % 3 = 1 THEN 'timeout' END AS error FROM customer WHERE c_nationkey % 10 <> 9""",
)
def read_states(t: Tables) -> DataFrame:
    """A state document per nation with its customers as lists; those of some nations are damaged."""
    k = F.col("c_custkey")
    entry = F.struct(
        F.concat(F.lit("http://farm/"), F.col("c_nationkey").cast("string")).alias("web_url"), F.when(k % 3 == 0, "complete").when(k % 3 == 1, "failed").otherwise("in_progress").alias("status"),
        (k * 10).alias("last_item_id"), F.when(k % 3 == 1, "timeout").alias("error"),
    )
    guid = F.concat(F.lit("{C-"), k.cast("string"), F.lit("}"))
    grouped = t.customer.groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(F.map_from_entries(F.collect_list(F.struct(guid, entry))).alias("lists"))
    whole = F.to_json(F.struct("lists"))
    body = F.when(F.col("n_nationkey") % 10 == 9, F.substr(whole, F.lit(1), F.length(whole) - 5)).otherwise(whole)
    return source.read_states(t.spark, _documents_of(t, body, "states", grouped)).select("list_guid", "web_url", "status", "last_item_id", "error")


@query(
    "read_manifests",
    """SELECT 'count' AS part, c_mktsegment AS key, 'run ' || c_nationkey AS command, count(*) AS n FROM customer WHERE c_nationkey % 10 <> 9 GROUP BY ALL
UNION ALL SELECT 'error', '{C-' || c_custkey || '}', 'run ' || c_nationkey, 1 FROM customer WHERE c_nationkey % 10 <> 9 AND c_custkey % 7 = 0
UNION ALL SELECT 'warning', 'large', 'run ' || n_nationkey, 1 FROM nation WHERE n_nationkey % 10 <> 9 AND n_nationkey IN (SELECT c_nationkey FROM customer)""",
)
def read_manifests(t: Tables) -> DataFrame:
    """A manifest per nation: counters by segment, an error for every seventh customer; some are damaged."""
    key = F.col("c_nationkey").alias("n_nationkey")
    counters = t.customer.groupBy(key, "c_mktsegment").agg(F.count(F.lit(1)).alias("n")).groupBy("n_nationkey").agg(F.map_from_entries(F.collect_list(F.struct("c_mktsegment", "n"))).alias("counts"))
    failed = F.when(F.col("c_custkey") % 7 == 0, F.struct(F.concat(F.lit("{C-"), F.col("c_custkey").cast("string"), F.lit("}")).alias("list_guid"), F.lit("items").alias("scope"), F.lit("boom").alias("message")))
    errors = t.customer.groupBy(key).agg(F.collect_list(failed).alias("errors"))
    whole = F.to_json(F.struct(F.concat(F.lit("run "), F.col("n_nationkey").cast("string")).alias("command"), "counts", "errors", F.array(F.lit("large")).alias("warnings")))
    body = F.when(F.col("n_nationkey") % 10 == 9, F.substr(whole, F.lit(2))).otherwise(whole)
    tables = source.read_manifests(t.spark, _documents_of(t, body, "manifests", counters.join(errors, "n_nationkey")))
    one = F.lit(1).cast("bigint").alias("n")
    out = tables["counts"].select(F.lit("count").alias("part"), F.col("counter").alias("key"), "command", "n")
    out = out.unionByName(tables["errors"].select(F.lit("error").alias("part"), F.col("list_guid").alias("key"), "command", one))
    return out.unionByName(tables["warnings"].select(F.lit("warning").alias("part"), F.col("warning").alias("key"), "command", one))


_FEED_ROWS_SQL = """SELECT o_orderkey AS item_id, 'Order "' || o_orderkey || '"' AS title, o_custkey AS customer, CASE WHEN o_orderkey % 2 = 0 THEN c_name END AS label,
  CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS total, o_orderkey % 3 = 0 AS closed FROM orders JOIN customer ON o_custkey = c_custkey"""


def _feed_shown(rows: DataFrame, *more: Column) -> DataFrame:
    def get(path: str, kind: str) -> Column:
        return F.try_variant_get("row", path, kind)

    return rows.select(
        get("$.Id", "bigint").alias("item_id"), get("$.Title", "string").alias("title"), get("$.KundeId", "bigint").alias("customer"),
        get("$.Kunde.Title", "string").alias("label"), get("$.Summe", "string").alias("total"), get("$.Erledigt", "boolean").alias("closed"), *more,
    )


@query("read_odata_json", _FEED_ROWS_SQL)
def read_odata_json(t: Tables) -> DataFrame:
    """Feed pages of up to 5000 orders, one file per page, in three shapes."""
    k = F.col("o_orderkey")
    stub = F.to_json(F.struct(F.struct(F.lit("x").alias("uri")).alias("__deferred")))
    kunde = F.when(k % 2 == 0, F.to_json(F.struct(F.col("o_custkey").alias("Id"), F.col("c_name").alias("Title")))).otherwise(stub)
    body = F.to_json(
        F.struct(
            k.alias("Id"), F.concat(F.lit('Order "'), k.cast("string"), F.lit('"')).alias("Title"), F.col("o_custkey").alias("KundeId"), F.parse_json(kunde).alias("Kunde"),
            F.col("o_totalprice").cast("decimal(18,2)").cast("string").alias("Summe"), (k % 3 == 0).alias("Erledigt"),
        )
    )
    page = F.floor(k / 5000).cast("bigint")
    single = k % 5000 == 1
    rows = order_rows(t).select(page.alias("page"), single.alias("single"), body.alias("body"))
    pages = rows.groupBy("page", "single").agg(F.array_join(F.collect_list("body"), ",").alias("b"))
    listed = F.when(F.col("page") % 2 == 0, F.concat(F.lit('{"d":{"results":['), "b", F.lit(',5],"__next":"u"}}'))).otherwise(F.concat(F.lit('{"d":['), "b", F.lit("]}")))
    text = pages.select("page", "single", F.when(F.col("single"), F.concat(F.lit('{"d":'), "b", F.lit("}"))).otherwise(listed).alias("value"))
    path = scratch_path(t.spark, "feed")
    text.repartition("page", "single").write.partitionBy("page", "single").text(path)
    return _feed_shown(captured.read_odata_json(t.spark, path))


def _cell(name: str, c: Column, edm: str | None = None) -> Column:
    return _tag(f"d:{name}", {"m:type": F.lit(edm).cast("string")}, _escaped(c))


ATOM_PROPERTIES = ["Id", "Title", "KundeId", "Summe", "Erledigt", "Status", "Leer"]


@query(
    "read_odata_atom",
    """SELECT o_orderkey AS item_id, 'Order "' || o_orderkey || '"' AS title, o_custkey AS customer, CASE WHEN o_orderkey % 2 = 0 THEN c_name END AS label,
  CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS total, o_orderkey % 3 = 0 AS closed, o_orderstatus || ',z' AS status, true AS empty_is_null, o_orderkey % 2 = 1 AS deferred
FROM orders JOIN customer ON o_custkey = c_custkey""",
)
def read_odata_atom(t: Tables) -> DataFrame:
    k = F.col("o_orderkey")
    elements = F.concat(_tag("d:element", {}, F.col("o_orderstatus")), _tag("d:element", {}, F.lit("z")))
    own = F.concat(
        _cell("Id", k.cast("string"), "Edm.Int32"), _cell("Title", F.concat(F.lit('Order "'), k.cast("string"), F.lit('"'))),
        _cell("KundeId", F.col("o_custkey").cast("string"), "Edm.Int32"),
        _cell("Summe", F.col("o_totalprice").cast("decimal(18,2)").cast("string"), "Edm.Decimal"), _cell("Erledigt", (k % 3 == 0).cast("string"), "Edm.Boolean"),
        _tag("d:Status", {"m:type": F.lit("Collection(Edm.String)")}, elements), _tag("d:Leer", {"m:type": F.lit("Edm.Int32"), "m:null": F.lit("true")}),
    )
    customer = F.concat(_cell("Id", F.col("o_custkey").cast("string"), "Edm.Int32"), _cell("Title", F.col("c_name")))

    def entry(*parts: Column, properties: Column) -> Column:
        return _tag("entry", {}, F.concat(*parts, _tag("content", {"type": F.lit("application/xml")}, _tag("m:properties", {}, properties))))

    target = {"rel": F.lit("urn:x/related/Kunde"), "href": F.lit("a(1)/Kunde")}
    expanded = _tag("link", target, _tag("m:inline", {}, entry(properties=customer)))
    link = F.when(k % 2 == 0, expanded).otherwise(_tag("link", target))
    edit = _tag("link", {"rel": F.lit("edit"), "href": F.lit("a(1)")})
    rows = captured.read_odata_atom(t.spark, _save(order_rows(t), k / 5000, entry(edit, link, properties=own), "atom"), ATOM_PROPERTIES)
    status = F.array_join(F.try_variant_get("row", "$.Status.results", "array<string>"), ",")
    more = [
        status.alias("status"), F.is_variant_null(F.try_variant_get("row", "$.Leer", "variant")).alias("empty_is_null"),
        F.try_variant_get("row", "$.Kunde.__deferred.uri", "string").isNotNull().alias("deferred"),
    ]
    return _feed_shown(rows, *more)


def _schema_files(t: Tables) -> str:
    lists, fields = customer_lists(t)
    # Dealt by number as in ``_save``, while they are narrow: texts of fields compress well, too.
    per_list = fields.repartition(_tasks(fields), "list_guid").withColumn("pos", F.array_position(F.array(*[F.lit(n) for n in ("Nation", "Parent", "Gone", "Owner", "Blank")]), F.col("name")))
    field = _tag(
        "Field",
        {
            "Name": F.lit(""), "StaticName": F.col("name"), "DisplayName": F.lit("Anzeige"), "Type": F.col("type"), "List": F.col("lookup_list"),
            "Mult": F.col("mult").cast("string"), "MaxLength": F.lit("0"),
        },
    )
    grouped = per_list.groupBy(F.col("list_guid").alias("guid")).agg(F.array_sort(F.collect_list(F.struct("pos", field.alias("f")))).alias("fs"))
    head = {
        "ID": F.lower("guid"), "Title": F.col("title"), "BaseType": F.col("base_type"), "ItemCount": F.concat(F.lit(" "), F.col("item_count").cast("string")),
        "HasUniqueScopes": F.lit("TRUE"),
    }
    body = _tag("Fields", {}, F.coalesce(F.array_join("fs.f", ""), F.lit("")))
    number = F.regexp_extract("guid", r"(\d+)", 1).cast("bigint")
    # Merged: the broadcast that their compressed size allows would hold all texts in every task.
    return _save(lists.join(grouped.hint("merge"), "guid", "left"), number / 5000, _tag("List", head, body), "schemas")


@query(
    "read_list_schemas",
    """SELECT '{C-' || c_custkey || '}' AS list_guid, p.name, CAST(p.pos AS INTEGER) AS pos, 'Anzeige' AS display_name, p.type,
  CASE p.name WHEN 'Nation' THEN '{N-' || c_nationkey || '}' WHEN 'Parent' THEN 'Self' WHEN 'Gone' THEN '{X}' WHEN 'Owner' THEN '{U}' ELSE '' END AS lookup_list, p.name = 'Parent' AS mult, CAST(NULL AS INTEGER) AS max_length
FROM customer, (VALUES ('Nation', 0, 'Lookup'), ('Parent', 1, 'Lookup'), ('Gone', 2, 'LookupMulti'), ('Owner', 3, 'User'), ('Blank', 4, 'Lookup')) AS p(name, pos, type)""",
)
def read_list_schemas(t: Tables) -> DataFrame:
    _lists, fields = captured.read_list_schemas(t.spark, _schema_files(t))
    return fields.select("list_guid", "name", "pos", "display_name", "type", "lookup_list", "mult", "max_length")


@query(
    "read_list_inventory",
    """SELECT '{C-' || c_custkey || '}' AS guid, c_name AS title, CAST(c_custkey % 7 AS VARCHAR) AS base_type, length(c_name) AS item_count, true AS has_unique_scopes FROM customer
UNION ALL SELECT '{N-' || n_nationkey || '}', n_name, '0', 0, true FROM nation""",
)
def read_list_inventory(t: Tables) -> DataFrame:
    return captured.read_list_inventory(t.spark, _schema_files(t)).select("guid", "title", "base_type", "item_count", "has_unique_scopes")


@query("read_web_inventory", "SELECT 'Page ' || page_id AS title, url FROM pages WHERE page_id % 10 <> 0")
def read_web_inventory(t: Tables) -> DataFrame:
    url = F.when(F.col("page_id") % 10 == 0, F.lit("")).otherwise(F.col("url"))
    web = _tag("Web", {"Title": F.concat(F.lit("Page "), F.col("page_id").cast("string")), "Url": url})
    return captured.read_web_inventory(t.spark, _save(t.pages, F.col("page_id") / 5000, web, "webs")).select("title", "url")


def _with_empty_list(lists: DataFrame) -> DataFrame:
    named = {"guid": F.lit("{EMPTY}"), "title": F.lit("Empty"), "item_count": F.lit(0).cast("bigint"), "web_url": F.lit("http://farm/empty")}
    return lists.unionByName(lists.limit(1).withColumns(named))


KEYS = ["list_guid", "item_id"]


def _kept(t: Tables) -> tuple[DataFrame, DataFrame, DataFrame, int]:
    """The items of a full run in their last version, the field definitions, the lists, and the number of tasks for them."""
    # Small, but counted from all orders and read by every output.
    fields, lists = store(order_fields(t), "fields"), store(segment_lists(t), "lists")
    # So many that a task sorts and groups its items in memory; compressed, they look many times smaller than they are.
    tasks = max(t.spark.sparkContext.defaultParallelism, t.orders.count() // TASK_ITEMS)
    # Every fifth item was sent before, in an older version.
    sent = raw_orders(t, tasks).withColumn("page", F.lit(2))
    older = F.map_from_arrays(F.array(F.lit("ows_ID"), F.lit("ows_Title")), F.array(F.col("item_id").cast("string"), F.lit("outdated")))
    resent = sent.filter("item_id % 5 = 0 AND item_id % 101 <> 3").withColumns({"page": F.lit(1), "raw": older})
    kept, _dropped = decode.split_by_item_id(sent.unionByName(resent))
    # Records, fields, raw lines and files all read it. By id first, which tells rows apart when they are sorted.
    last = latest_items(kept.repartition(tasks, *KEYS), ["page"], KEYS[::-1]).drop("page")
    return store(last, "kept", "zstd"), fields, lists, tasks


def _outputs(kept: DataFrame, fields: DataFrame, lists: DataFrame, tasks: int) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame, DataFrame, DataFrame]:
    records = scope.build_items(kept, lists, keep_raw=True, identified=True)
    # Dealt by item before the rows of its columns are made, which are then grouped where they are.
    decoded = decode.decode_items(kept.repartition(tasks, *KEYS), fields)
    named = records.select("doc_id", "web_url", "list_guid", "item_id")
    planned = file_rows.plan_files(kept, lists).filter(~F.col("needs_listing")).withColumn("bytes", F.lit(None).cast("bigint"))
    judged = file_rows.skip_policy(planned, "file_name", "bytes", 1_000_000, [EXCLUDED])
    files = judged.join(named, KEYS).select(
        "doc_id", "web_url", *KEYS, F.col("file_name").alias("filename"), "url", F.lit(None).cast("string").alias("local_path"),
        "bytes", F.lit(None).cast("string").alias("sha256"), F.lit(False).alias("downloaded"), "skip_reason",
    )
    return records, decoded, fields, lists, _with_empty_list(lists), files


def _run(t: Tables) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame, DataFrame, DataFrame]:
    """A full run: raw records, decoded fields, field definitions, lists, one of them empty, and files."""
    return _outputs(*_kept(t))


def _landing(t: Tables) -> str:
    """Both outputs and the schemas of a run."""
    root = scratch_path(t.spark, "landing")
    kept = _kept(t)
    records, decoded, fields, lists, all_lists, files = _outputs(*kept)
    # Dealt as the decoded fields are, so that both meet without another shuffle.
    items = records.drop("raw").repartition(kept[-1], *KEYS)
    sink.write_landing(sink.contract_items(items, decoded, fields), records, all_lists, root, files)
    sink.write_list_schemas(lists, fields, root)
    return root


def _contract_documents(t: Tables, lists: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame, DataFrame]:
    fields = order_fields(t)
    webs = scope.normalise_webs(lists.select(F.initcap(F.substring_index("web_url", "/", -1)).alias("title"), F.col("web_url").alias("url"), F.lit(0).alias("pos")))
    return lists, fields, webs, graph.build_graph_nodes(lists), graph.build_graph_edges(lists, fields)


def _contract(t: Tables) -> str:
    """The same run laid out for other tools."""
    root = scratch_path(t.spark, "contract")
    kept = _kept(t)
    records, decoded, fields, _, lists, files = _outputs(*kept)
    # Dealt as the decoded fields are, so that all meet without another shuffle.
    records, files = (df.repartition(kept[-1], *KEYS) for df in (records, files))
    contract.write_contract_landing(sink.contract_items(records, decoded, fields), *_contract_documents(t, lists), root, files)
    return root


def _documents_only(t: Tables) -> str:
    root = scratch_path(t.spark, "documents")
    contract.write_contract_documents(*_contract_documents(t, _with_empty_list(segment_lists(t))), root)
    return root


@query(
    "write_landing",
    """SELECT o_orderkey AS item_id, 'Order ' || o_orderkey AS title, o_custkey AS customer_id, c_name AS customer,
  CASE WHEN o_orderkey % 17 <> 0 THEN CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) END AS total, o_orderstatus AS status,
  CASE WHEN o_orderkey % 19 <> 0 THEN strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') END AS opened, 'Kunde' AS shown, lower(c_mktsegment) AS list_slug
FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderkey % 101 <> 3""",
)
def write_landing(t: Tables) -> DataFrame:
    def get(path: str, kind: str) -> Column:
        return F.try_variant_get("fields", path, kind)

    return source.read_items(t.spark, _landing(t)).select(
        "item_id", get("$.Title", "string").alias("title"), get("$.Customer.id", "bigint").alias("customer_id"), get("$.Customer.value", "string").alias("customer"),
        get("$.Total", "double").alias("total"), get("$.Status[0]", "string").alias("status"), get("$.Opened", "string").alias("opened"),
        F.try_element_at("field_display_names", F.lit("Customer")).alias("shown"), "list_slug",
    )


@query(
    "landing_attachments",
    f"""WITH o AS (SELECT o_orderkey, lower(c_mktsegment) AS list_slug, length(c_mktsegment) % 2 = 1 AS library FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderkey % 101 <> 3)
SELECT list_slug, o_orderkey || '_.000' AS filename, 'http://farm/sites/x/' || o_orderkey || '_.000' AS url, NULL AS skip_reason, false AS downloaded FROM o WHERE library AND o_orderkey % 40 <> 0
UNION ALL SELECT list_slug, 'scan one.pdf', 'http://farm/a/' || o_orderkey || '/scan%20one.pdf', 'extension_excluded:{EXCLUDED}', false FROM o WHERE NOT library AND o_orderkey % 6 = 0
UNION ALL SELECT list_slug, 'log.txt', 'http://farm/a/' || o_orderkey || '/log.txt', NULL, false FROM o WHERE NOT library AND o_orderkey % 6 = 0""",
)
def landing_attachments(t: Tables) -> DataFrame:
    """Planned, judged by the policy, written beside the items and read back."""
    return source.read_attachments(t.spark, _landing(t)).select("list_slug", "filename", "url", "skip_reason", "downloaded")


@query(
    "read_contract_landing",
    """WITH o AS (SELECT o_orderkey, o_custkey, c_name, c_mktsegment, length(c_mktsegment) % 2 = 1 AS library FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderkey % 101 <> 3)
SELECT o_orderkey AS item_id, 'Order ' || o_orderkey AS title, lower(c_mktsegment) AS list_slug, 'Order ' || o_orderkey AS raw_title, o_custkey || ';#' || c_name AS raw_customer, 18 AS raw_attributes,
  CASE WHEN library AND o_orderkey % 40 <> 0 THEN 1 WHEN NOT library AND o_orderkey % 6 = 0 THEN 2 ELSE 0 END AS files,
  CASE WHEN library AND o_orderkey % 40 <> 0 THEN 'http://farm/sites/x/' || o_orderkey || '_.000' WHEN NOT library AND o_orderkey % 6 = 0 THEN 'http://farm/a/' || o_orderkey || '/log.txt' END AS first_url FROM o""",
)
def read_contract_landing(t: Tables) -> DataFrame:
    """Items, their files and their raw attributes from the paths of the contract, tied by item id."""
    root = _contract(t)
    items = source.read_contract_items(t.spark, root).select(
        "item_id", F.try_variant_get("fields", "$.Title", "string").alias("title"), "list_slug", F.size("attachments").alias("files"), F.get("attachments", F.lit(0))["url"].alias("first_url")
    )
    raw = source.read_contract_raw_items(t.spark, root)

    def get(name: str) -> Column:
        return F.try_element_at("raw", F.lit(name))

    id_only = F.substring_index(get("ID"), ";#", 1).cast("bigint")
    flat = raw.select(id_only.alias("item_id"), get("Title").alias("raw_title"), get("Customer").alias("raw_customer"), F.size("raw").alias("raw_attributes"))
    return items.join(flat, "item_id")


@query(
    "contract_schemas",
    """SELECT '{' || c_mktsegment || '}' AS list_guid, lower(c_mktsegment) AS slug, p.name, p.type FROM (SELECT DISTINCT c_mktsegment FROM customer JOIN orders ON o_custkey = c_custkey),
(VALUES ('Title', 'Text'), ('Customer', 'Lookup'), ('Total', 'Currency'), ('Opened', 'DateTime'), ('Status', 'MultiChoice'), ('Priority', 'Choice'), ('Estimate', 'Calculated'), ('Closed', 'Boolean'),
 ('Parent', 'Lookup'), ('Archive', 'LookupMulti')) AS p(name, type) UNION ALL SELECT '{EMPTY}', 'empty', NULL, NULL""",
)
def contract_schemas(t: Tables) -> DataFrame:
    """``list.json`` of every list, also of the one without columns and items."""
    from ..functions import names

    lists, fields = source.read_contract_schemas(t.spark, _documents_only(t))
    shown = lists.select(F.col("guid").alias("list_guid"), names.guid_slug(F.col("guid")).alias("slug"))
    return shown.join(fields.select("list_guid", "name", "type"), "list_guid", "left")


@query(
    "contract_webs",
    """SELECT lower(c_mktsegment) AS title, 'http://farm/sites/' || lower(c_mktsegment) AS url, 'farm_sites_' || lower(c_mktsegment) AS slug, CAST(1 AS BIGINT) AS list_count, '{' || c_mktsegment || '}' AS guid, count(*) AS item_count
FROM customer JOIN orders ON o_custkey = c_custkey GROUP BY c_mktsegment UNION ALL SELECT 'empty', 'http://farm/empty', 'farm_empty', 1, '{EMPTY}', 0""",
)
def contract_webs(t: Tables) -> DataFrame:
    webs, lists = source.read_contract_webs(t.spark, _documents_only(t))
    return webs.join(lists.select("web_id", "guid", "item_count"), "web_id").select(F.lower("title").alias("title"), "url", "slug", "list_count", "guid", "item_count")


@query(
    "contract_graph",
    """WITH s AS (SELECT c_mktsegment, count(*) AS n FROM customer JOIN orders ON o_custkey = c_custkey GROUP BY c_mktsegment)
SELECT 'node' AS part, '{' || c_mktsegment || '}' AS list_guid, NULL AS field_name, n AS item_count, NULL AS multi, NULL AS self_reference, NULL AS dangling FROM s
UNION ALL SELECT 'node', '{EMPTY}', NULL, 0, NULL, NULL, NULL
UNION ALL SELECT 'edge', '{' || c_mktsegment || '}', p.f, NULL, p.m, p.s, p.d FROM s, (VALUES ('Customer', false, false, true), ('Parent', false, true, false), ('Archive', true, false, true)) AS p(f, m, s, d)""",
)
def contract_graph(t: Tables) -> DataFrame:
    nodes, edges = source.read_contract_graph(t.spark, _documents_only(t))
    flags = ["multi", "self_reference", "dangling"]
    shown = nodes.select(F.lit("node").alias("part"), "list_guid", F.lit(None).cast("string").alias("field_name"), "item_count", *[F.lit(None).cast("boolean").alias(f) for f in flags])
    return shown.unionByName(edges.select(F.lit("edge").alias("part"), F.col("source_list_guid").alias("list_guid"), "field_name", F.lit(None).cast("bigint").alias("item_count"), *flags))


@query("landing_completeness", "SELECT count(*) AS raw_rows, CAST(0 AS BIGINT) AS one_sided, CAST(0 AS BIGINT) AS skipped FROM orders WHERE o_orderkey % 101 <> 3")
def landing_completeness(t: Tables) -> DataFrame:
    from ..operators.incremental import dual_completeness

    root = _landing(t)
    items, raw = source.read_items(t.spark, root), source.read_raw_items(t.spark, root)
    one = F.lit(1)
    rows = raw.select(one.alias("r"), F.lit(0).alias("o"), F.lit(0).alias("s"))
    rows = rows.unionByName(dual_completeness(items, raw).select(F.lit(0).alias("r"), one.alias("o"), F.lit(0).alias("s")))
    rows = rows.unionByName(source.skipped_lines(t.spark, root).select(F.lit(0).alias("r"), F.lit(0).alias("o"), one.alias("s")))
    return rows.agg(F.sum("r").alias("raw_rows"), F.sum("o").alias("one_sided"), F.sum("s").alias("skipped"))


@query(
    "stored_schemas",
    """SELECT '{' || c_mktsegment || '}' AS list_guid, p.pos, p.name, p.display_name FROM (SELECT DISTINCT c_mktsegment FROM customer JOIN orders ON o_custkey = c_custkey),
(VALUES (0, 'Title', 'Titel'), (1, 'Customer', 'Kunde'), (2, 'Total', 'Summe'), (3, 'Opened', 'Eröffnet'), (4, 'Status', 'Status'), (5, 'Priority', 'Priorität'),
 (6, 'Estimate', 'Schätzung'), (7, 'Closed', 'Erledigt'), (8, 'Parent', 'Vorgänger'), (9, 'Archive', 'Archiv')) AS p(pos, name, display_name)""",
)
def stored_schemas(t: Tables) -> DataFrame:
    root = scratch_path(t.spark, "schemas")
    sink.write_list_schemas(segment_lists(t), order_fields(t), root)
    return source.read_stored_schemas(t.spark, root)[1].select("list_guid", "pos", "name", "display_name")


@query(
    "write_graph",
    "SELECT count(*) + (SELECT count(*) FROM nation) AS nodes, 3 * count(*) AS edges, count(*) AS dangling FROM customer",
)
def write_graph(t: Tables) -> DataFrame:
    root = scratch_path(t.spark, "graph")
    lists, fields = customer_lists(t)
    sink.write_graph(graph.build_graph_nodes(lists), graph.build_graph_edges(lists, fields), root)
    edges = t.spark.read.schema("dangling boolean").json(f"{root}/graph/edges").select(F.lit(0).alias("n"), F.lit(1).alias("e"), F.col("dangling").cast("int").alias("d"))
    nodes = t.spark.read.schema("list_guid string").json(f"{root}/graph/nodes").select(F.lit(1).alias("n"), F.lit(0).alias("e"), F.lit(0).alias("d"))
    return nodes.unionByName(edges).agg(F.sum("n").alias("nodes"), F.sum("e").alias("edges"), F.sum("d").alias("dangling"))


@query("write_webs", "SELECT lower(n_name) AS title, 'http://farm/' || n_nationkey AS url FROM nation")
def write_webs(t: Tables) -> DataFrame:
    root = scratch_path(t.spark, "webs")
    webs = t.nation.select(F.lower("n_name").alias("title"), F.concat(F.lit("HTTP://Farm/"), F.col("n_nationkey").cast("string"), F.lit("/")).alias("url"), F.col("n_nationkey").alias("pos"))
    sink.write_webs(scope.normalise_webs(webs), root)
    return t.spark.read.schema("title string, url string").json(f"{root}/webs")


@query(
    "run_report",
    """SELECT 'count' AS part, event_type AS key, count(*) AS n FROM events GROUP BY event_type
UNION ALL SELECT 'error', CAST(n_nationkey AS VARCHAR), 1 FROM nation WHERE n_nationkey % 4 = 0 UNION ALL SELECT 'warning', 'two lists are large', 1""",
)
def run_report(t: Tables) -> DataFrame:
    root = scratch_path(t.spark, "runs")
    counts = t.events.groupBy(F.col("event_type").alias("counter")).agg(F.count(F.lit(1)).alias("n"))
    failed = t.nation.filter("n_nationkey % 4 = 0").select(F.lit("items").alias("scope"), F.col("n_nationkey").cast("string").alias("list_guid"), F.lit("boom").alias("message"))
    sink.write_run_report(t.spark, root, "crawl", counts, failed, ["two lists are large"])
    tables = source.read_run_tables(t.spark, root)
    one = F.lit(1).cast("bigint").alias("n")
    out = tables["counts"].select(F.lit("count").alias("part"), F.col("counter").alias("key"), "n")
    out = out.unionByName(tables["errors"].select(F.lit("error").alias("part"), F.col("list_guid").alias("key"), one))
    return out.unionByName(tables["warnings"].select(F.lit("warning").alias("part"), F.col("warning").alias("key"), one))


@query(
    "hash_files",
    "SELECT source, sha256(string_agg(text || chr(10), '' ORDER BY doc_id)) AS sha256, CAST(sum(octet_length(encode(text)) + 1) AS BIGINT) AS bytes, count(*) >= 200 AS streamed FROM documents GROUP BY source",
)
def hash_files(t: Tables) -> DataFrame:
    """One file per source; those with many documents are streamed in parts."""
    from ..operators import files

    path = scratch_path(t.spark, "sources")
    t.documents.select("source", "doc_id", F.col("text").alias("value")).repartition("source").sortWithinPartitions("source", "doc_id").drop("doc_id").write.partitionBy("source").text(path)
    sizes = t.documents.groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("text") + 1).alias("b"))
    # The bound between the two ways, taken so that it parts the sources as the result says.
    large = sizes.agg(F.max(F.when(F.col("n") < 200, F.col("b"))).alias("b")).first()["b"] or 0
    hashed = files.hash_files(t.spark, path, "*.txt", whole_bytes=large)
    return hashed.select(F.regexp_extract("path", "source=([^/]*)/", 1).alias("source"), "sha256", "bytes", (F.col("bytes") > large).alias("streamed"))


@query("read_files", "SELECT CAST(sum(octet_length(encode(html)) + 1) AS BIGINT) AS bytes, true AS hashed FROM pages")
def read_files(t: Tables) -> DataFrame:
    from ..operators.files import hash_inventory

    path = scratch_path(t.spark, "files")
    t.pages.select("html").write.text(path)
    hashed = hash_inventory(source.read_files(t.spark, path, "*.txt"))
    return hashed.agg(F.sum("bytes").alias("bytes"), F.every(F.length("sha256") == 64).alias("hashed"))


@query(
    "publish_snapshot",
    f"""WITH {FEED_SQL} SELECT list_guid, item_id, title FROM base WHERE item_id NOT IN (SELECT item_id FROM latest)
UNION ALL SELECT list_guid, item_id, title FROM latest WHERE change_type <> 'Delete'""",
)
def publish_snapshot(t: Tables) -> DataFrame:
    """A table published, changed through its own snapshot, and published again."""
    from ..operators.incremental import apply_latest, latest_per_key

    table = scratch_path(t.spark, "table")
    sink.publish_snapshot(base_items(t), table)
    latest = latest_per_key(change_feed(t), ["item_id"])
    sink.publish_snapshot(apply_latest(sink.read_snapshot(t.spark, table), latest), table)
    return sink.read_snapshot(t.spark, table)
