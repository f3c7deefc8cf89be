"""Wire-format tables derived from the test tables, and their SQL twins.

Orders become list items, market segments become lists, nations become webs. All of
it is computed by Spark from the given tables, so the work grows with them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .registry import Tables

WIRE_CLOCK = "yyyy-MM-dd'T'HH:mm:ss'Z'"


def money(c: str | Column) -> Column:
    """A currency as the wire sends it, with twelve decimals."""
    return F.concat(F.col(c).cast("decimal(18,2)").cast("string") if isinstance(c, str) else c, F.lit("0000000000"))


def clock(c: str) -> Column:
    return F.date_format(F.col(c).cast("timestamp"), WIRE_CLOCK)


def wired(
    df: DataFrame, key: str, wire_type: str, text: Column, result_type: str | None = None, field: str = "Value", guid: Column | None = None
) -> DataFrame:
    """One wire value per row, ready for the decode job."""
    return df.select(
        (F.lit("{L}") if guid is None else guid).alias("list_guid"),
        F.col(key).cast("bigint").alias("item_id"),
        F.lit(field).alias("field"),
        F.lit(wire_type).alias("wire_type"),
        F.lit(result_type).cast("string").alias("result_type"),
        text.alias("raw"),
    )


def pick(key: str | Column, n: int, *options: Column) -> Column:
    """The option for ``key mod n``; the last one serves the rest."""
    rest = F.pmod(F.col(key) if isinstance(key, str) else key, F.lit(n))
    out = F.when(rest == 0, options[0])
    for i, o in enumerate(options[1:-1], 1):
        out = out.when(rest == i, o)
    return out.otherwise(options[-1])


def order_rows(t: Tables) -> DataFrame:
    return t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))


def raw_orders(t: Tables, tasks: int | None = None) -> DataFrame:
    """Orders as raw list items; about one in a hundred has lost its id. ``tasks`` deals out the orders while they are narrow."""
    rows = t.spread("orders").join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    if tasks is not None:
        rows = rows.repartition(tasks, "o_orderkey")
    # Texts used more than once are columns of their own.
    rows = rows.select(
        "*", F.col("o_orderkey").cast("string").alias("key"), clock("o_orderdate").alias("day"), money("o_totalprice").alias("total")
    )
    k, key, day, total = F.col("o_orderkey"), F.col("key"), F.col("day"), F.col("total")
    pair = F.concat(key, F.lit(";#"), key)
    files = F.concat(
        F.lit("http://farm/a/"), key, F.lit("/scan%20one.pdf;#http://farm/a/"), key, F.lit("/log.txt")
    )
    lost = k % 101 == 3
    entries = {
        "ows_ID": F.when(lost, F.lit(None)).when(k % 50 == 7, pair).otherwise(key),
        "ows_Title": F.concat(F.lit("Order "), key),
        "ows_Customer": F.concat(F.col("o_custkey").cast("string"), F.lit(";#"), F.col("c_name")),
        "ows_Total": F.when(k % 17 == 0, F.lit("n/a")).otherwise(total),
        "ows_Opened": F.when(k % 19 == 0, F.lit("someday")).otherwise(day),
        "ows_Status": F.concat(F.lit(";#"), F.col("o_orderstatus"), F.lit(";#")),
        "ows_Priority": F.col("o_orderpriority"),
        "ows_Estimate": F.concat(F.when(k % 23 == 0, F.lit("odd;#")).otherwise(F.lit("float;#")), total),
        "ows_Closed": F.when(k % 2 == 0, F.lit("1")).otherwise(F.lit("0")),
        "ows_FSObjType": F.concat(key, F.when(k % 40 == 0, F.lit(";#1")).otherwise(F.lit(";#0"))),
        "ows_ContentType": F.lit("Order"),
        "ows_Created": day,
        "ows_Modified": day,
        "ows_FileRef": F.concat(key, F.lit(";#sites/x/Lists/Orders/"), key, F.lit("_.000")),
        "ows_FileLeafRef": F.concat(key, F.lit(";#"), key, F.lit("_.000")),
        "ows_EncodedAbsUrl": F.concat(F.lit("http://farm/sites/x/"), key, F.lit("_.000")),
        "ows_MetaInfo": F.lit("bag"),
        "ows_Attachments": F.when(k % 3 == 0, F.lit("1")).otherwise(F.lit("0")),
        "ows_AttachmentUrls": F.when(k % 6 == 0, files).otherwise(F.lit("")),
        "other": F.lit("not wire data"),
    }
    attributes = F.map_from_arrays(F.array(*[F.lit(n) for n in entries]), F.array(*entries.values()))
    rows = rows.select(segment_guid().alias("list_guid"), k.alias("item_id"), lost.alias("lost"), attributes.alias("m"))
    raw = F.when(F.col("lost"), F.map_filter("m", lambda _k, v: v.isNotNull())).otherwise(F.col("m"))
    return rows.select("list_guid", "item_id", raw.alias("raw"))


def segment_guid() -> Column:
    return F.concat(F.lit("{"), F.col("c_mktsegment"), F.lit("}"))


# name, display name, type, lookup target, show field, result type
ORDER_FIELDS = [
    ("Title", "Titel", "Text", None, None, None),
    ("Customer", "Kunde", "Lookup", "{customers}", "Name", None),
    ("Total", "Summe", "Currency", None, None, None),
    ("Opened", "Eröffnet", "DateTime", None, None, None),
    ("Status", "Status", "MultiChoice", None, None, None),
    ("Priority", "Priorität", "Choice", None, None, None),
    ("Estimate", "Schätzung", "Calculated", None, None, "Number"),
    ("Closed", "Erledigt", "Boolean", None, None, None),
    ("Parent", "Vorgänger", "Lookup", "Self", "Title", None),
    ("Archive", "Archiv", "LookupMulti", "{gone}", "Title", None),
]


def segments(t: Tables) -> DataFrame:
    return t.customer.select("c_mktsegment").distinct()


def order_fields(t: Tables) -> DataFrame:
    """Field definitions of every segment list."""
    rows = F.array(
        *[
            F.struct(
                F.lit(i).alias("pos"),
                F.lit(n).alias("name"),
                F.lit(d).alias("display_name"),
                F.lit(ty).alias("type"),
                F.lit(target).cast("string").alias("lookup_list"),
                F.lit(show).cast("string").alias("show_field"),
                F.lit(result).cast("string").alias("result_type"),
                F.lit(False).alias("mult"),
            )
            for i, (n, d, ty, target, show, result) in enumerate(ORDER_FIELDS)
        ]
    )
    return segments(t).select(segment_guid().alias("list_guid"), F.inline(rows))


def segment_lists(t: Tables) -> DataFrame:
    """One list per market segment; item_count is its number of orders."""
    counts = order_rows(t).groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("item_count"))
    seg = F.col("c_mktsegment")
    return counts.select(
        segment_guid().alias("guid"),
        seg.alias("title"),
        F.lit("").alias("description"),
        F.when(F.length(seg) % 2 == 1, F.lit("1")).otherwise(F.lit("0")).alias("base_type"),
        "item_count",
        F.lit(False).alias("hidden"),
        F.concat(F.lit("/sites/x/"), F.lower(seg)).alias("root_folder"),
        F.when(F.length(seg) > 8, F.lit("")).otherwise(F.concat(F.lit("/sites/x/Lists/"), seg, F.lit(" a/AllItems.aspx"))).alias("default_view_url"),
        F.lit(True).alias("enable_attachments"),
        F.lit(False).alias("has_unique_scopes"),
        F.concat(F.lit("http://farm/sites/"), F.lower(seg)).alias("web_url"),
    )


def nation_lists(t: Tables) -> DataFrame:
    """One list per nation and segment; nations are the webs."""
    rows = order_rows(t).join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    counts = rows.groupBy("n_nationkey", "n_name", "c_mktsegment").agg(F.count(F.lit(1)).alias("item_count"))
    n, seg = F.col("n_nationkey"), F.col("c_mktsegment")
    return counts.select(
        F.concat(F.lit("{"), n.cast("string"), F.lit("-"), seg, F.lit("}")).alias("guid"),
        F.when((n == 3) & (seg == "BUILDING"), F.lit("Style Library")).otherwise(F.concat(seg, F.lit(" "), n.cast("string"))).alias("title"),
        (n % 6).cast("string").alias("base_type"),
        "item_count",
        (n % 7 == 0).alias("hidden"),
        F.concat(F.lit("Lists/"), seg).alias("root_folder"),
        F.lit("").alias("default_view_url"),
        (n % 2 == 0).alias("enable_attachments"),
        (n % 5 == 0).alias("has_unique_scopes"),
        F.concat(F.lit("http://farm/"), F.lower("n_name")).alias("web_url"),
    )


NATION_LISTS_SQL = """
nation_lists AS (
  SELECT '{' || n_nationkey || '-' || c_mktsegment || '}' AS guid,
    CASE WHEN n_nationkey = 3 AND c_mktsegment = 'BUILDING' THEN 'Style Library'
         ELSE c_mktsegment || ' ' || n_nationkey END AS title,
    CAST(n_nationkey % 6 AS VARCHAR) AS base_type, count(*) AS item_count,
    n_nationkey % 7 = 0 AS hidden, n_nationkey % 2 = 0 AS enable_attachments,
    n_nationkey % 5 = 0 AS has_unique_scopes, 'http://farm/' || lower(n_name) AS web_url, n_nationkey
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  GROUP BY n_nationkey, n_name, c_mktsegment)
"""


def change_feed(t: Tables) -> DataFrame:
    """Events as a change feed: the item is the user, errors are deletes."""
    return t.events.select(
        F.concat(F.lit("{"), F.pmod(F.col("user_id"), F.lit(4)).cast("string"), F.lit("}")).alias("list_guid"),
        F.col("user_id").alias("item_id"),
        F.when(F.col("event_type") == "error", F.lit("Delete")).otherwise(F.lit("Update")).alias("change_type"),
        F.col("event_type").alias("title"),
        F.col("event_id").alias("seq"),
    )


def base_items(t: Tables) -> DataFrame:
    """The stored rows the feed is applied to: customers by id."""
    return t.customer.select(
        F.concat(F.lit("{"), F.pmod(F.col("c_custkey"), F.lit(4)).cast("string"), F.lit("}")).alias("list_guid"),
        F.col("c_custkey").alias("item_id"),
        F.col("c_mktsegment").alias("title"),
    )


FEED_SQL = """
feed AS (
  SELECT '{' || (user_id % 4) || '}' AS list_guid, user_id AS item_id,
    CASE WHEN event_type = 'error' THEN 'Delete' ELSE 'Update' END AS change_type, event_type AS title, event_id AS seq
  FROM events),
latest AS (SELECT * FROM feed QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY seq DESC) = 1),
base AS (SELECT '{' || (c_custkey % 4) || '}' AS list_guid, c_custkey AS item_id, c_mktsegment AS title FROM customer)
"""
