"""Queries of joins, lookups, matching and the list graph."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import names
from ..operators import decode, graph, joins, scope
from .derive import NATION_LISTS_SQL, nation_lists, order_rows, pick, segment_guid, segments, wired
from .registry import Tables, query


def _lines(t: Tables) -> DataFrame:
    undated = F.pmod("l_linenumber", F.lit(7)) == 0
    return t.lineitem.withColumn("created", F.when(~undated, F.col("l_shipdate")))


_LINE_IDS = ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
_LINES_SQL = "lines AS (SELECT *, CASE WHEN l_linenumber % 7 <> 0 THEN l_shipdate END AS created FROM lineitem)"


@query(
    "attach_children",
    f"""WITH {_LINES_SQL}, threads AS (SELECT l_orderkey, count(*) AS n, string_agg(CAST(l_partkey AS VARCHAR), ','
   ORDER BY created NULLS FIRST, l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS parts FROM lines GROUP BY l_orderkey)
SELECT o_orderkey, CAST(0 AS BIGINT) AS part, coalesce(n, 0) AS n, coalesce(parts, '') AS parts FROM orders LEFT JOIN threads ON o_orderkey = l_orderkey""",
)
def attach_children(t: Tables) -> DataFrame:
    out = joins.attach_children_in_parts(
        t.orders.select("o_orderkey"), _lines(t), "o_orderkey", "l_orderkey", F.col("created"), [F.col(c) for c in _LINE_IDS], ["l_partkey"], 10_000
    )
    parts = F.array_join(F.transform("comments", lambda c: c["l_partkey"].cast("string")), ",")
    return out.select("o_orderkey", "part", F.size("comments").cast("bigint").alias("n"), parts.alias("parts"))


@query(
    "thread_order",
    f"""WITH {_LINES_SQL} SELECT l_suppkey, l_partkey, l_extendedprice,
  row_number() OVER (PARTITION BY l_suppkey ORDER BY created NULLS FIRST, l_orderkey, l_linenumber, l_partkey, l_extendedprice) AS position FROM lines""",
)
def thread_order(t: Tables) -> DataFrame:
    ids = [F.col(c) for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")]
    return joins.thread_order(_lines(t), "l_suppkey", F.col("created"), ids).select("l_suppkey", "l_partkey", "l_extendedprice", "position")


_CHILDREN_SQL = """children AS (SELECT *, CASE WHEN l_linenumber % 5 = 0 THEN NULL
  WHEN l_orderkey % 13 = 0 THEN l_orderkey + 1000000000 ELSE l_orderkey END AS fk FROM lineitem)"""


def _children(t: Tables) -> DataFrame:
    k = F.col("l_orderkey")
    fk = F.when(F.col("l_linenumber") % 5 == 0, F.lit(None)).when(k % 13 == 0, k + 1000000000).otherwise(k)
    return t.lineitem.withColumn("fk", fk)


@query(
    "join_coverage",
    f"""WITH {_CHILDREN_SQL} SELECT (SELECT count(*) FROM orders) AS parents,
  (SELECT count(*) FROM orders WHERE o_orderkey IN (SELECT fk FROM children)) AS matched_parents, count(*) AS children,
  count(*) FILTER (fk IS NULL) AS orphans, count(DISTINCT CASE WHEN fk NOT IN (SELECT o_orderkey FROM orders) THEN fk END) AS unmatched_parents FROM children""",
)
def join_coverage(t: Tables) -> DataFrame:
    return joins.join_coverage(t.orders, _children(t), "o_orderkey", "fk")


@query("orphans", "SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_linenumber % 5 = 0")
def orphans(t: Tables) -> DataFrame:
    return joins.orphans(_children(t), "fk").select("l_orderkey", "l_linenumber", "l_partkey")


@query(
    "unmatched_parents",
    f"WITH {_CHILDREN_SQL} SELECT fk, count(*) AS children FROM children WHERE fk IS NOT NULL AND fk NOT IN (SELECT o_orderkey FROM orders) GROUP BY fk",
)
def unmatched_parents(t: Tables) -> DataFrame:
    return joins.unmatched_parents(t.orders, _children(t), "o_orderkey", "fk")


_CANDIDATES_SQL = """scored AS (
  SELECT 'TicketNumberId' AS candidate, count(*) FILTER (l_orderkey IN (SELECT o_orderkey FROM orders)) AS hits, count(*) AS populated FROM lineitem
  UNION ALL SELECT 'PartID', count(*) FILTER (l_partkey IN (SELECT o_orderkey FROM orders)), count(*) FROM lineitem
  UNION ALL SELECT 'parent_supplier', count(*) FILTER (l_suppkey IN (SELECT o_orderkey FROM orders) AND l_suppkey % 2 = 0), count(*) FILTER (l_suppkey % 2 = 0) FROM lineitem)"""


def _candidates(t: Tables) -> DataFrame:
    s = F.col("l_suppkey")
    return t.spread("lineitem").select(
        F.col("l_orderkey").alias("TicketNumberId"),
        F.concat(F.lit(" "), F.col("l_partkey").cast("string")).alias("PartID"),
        F.when(s % 2 == 0, s.cast("string")).otherwise(F.lit("none")).alias("parent_supplier"),
        F.col("l_orderkey").alias("CreatedById"),
        F.col("l_orderkey").alias("Id"),
        F.col("l_orderkey").alias("owshiddenversionId"),
    )


@query("score_parent_keys", f"WITH {_CANDIDATES_SQL} SELECT * FROM scored WHERE hits > 0")
def score_parent_keys(t: Tables) -> DataFrame:
    return joins.score_parent_keys(_candidates(t), t.orders, "o_orderkey")


@query("detect_parent_key", f"WITH {_CANDIDATES_SQL} SELECT * FROM scored WHERE hits > 0 ORDER BY hits DESC, populated DESC, candidate DESC LIMIT 1")
def detect_parent_key(t: Tables) -> DataFrame:
    return joins.detect_parent_key(_candidates(t), t.orders, "o_orderkey")


@query(
    "parent_value",
    """SELECT event_id, user_id AS from_number, CASE WHEN event_id % 2 = 0 THEN user_id END AS from_text, user_id AS from_object,
  CASE event_id % 4 WHEN 0 THEN user_id WHEN 1 THEN user_id WHEN 2 THEN user_id END AS from_variant FROM events""",
)
def parent_value(t: Tables) -> DataFrame:
    u = F.col("user_id").cast("string")
    text = F.when(F.col("event_id") % 2 == 0, F.concat(F.lit(" "), u, F.lit(" "))).otherwise(F.concat(u, F.lit("x")))
    body = pick("event_id", 4, u, F.concat(F.lit('"'), u, F.lit('"')), F.concat(F.lit('{"Id":'), u, F.lit(',"Title":"t"}')), F.lit("true"))
    obj = T.StructType([T.StructField("ID", T.LongType()), T.StructField("Title", T.StringType())])
    rows = t.events.select("event_id", "user_id", text.alias("text"), F.struct(F.col("user_id").alias("ID"), F.lit("t").alias("Title")).alias("obj"), F.parse_json(body).alias("v"))
    return rows.select(
        "event_id",
        joins.parent_value(F.col("user_id"), T.LongType()).alias("from_number"),
        joins.parent_value(F.col("text"), T.StringType()).alias("from_text"),
        joins.parent_value(F.col("obj"), obj).alias("from_object"),
        joins.parent_value(F.col("v"), T.VariantType()).alias("from_variant"),
    )


def customer_lists(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Customers and nations as lists: a customer looks up its nation, itself, and a list nobody has."""
    c, n = F.col("c_custkey").cast("string"), F.col("c_nationkey").cast("string")
    empty = {"web_url": F.lit("http://farm"), "base_type": F.lit("0")}
    own = t.customer.select(
        F.concat(F.lit("{C-"), c, F.lit("}")).alias("guid"), F.col("c_name").alias("title"), empty["web_url"].alias("web_url"),
        F.length("c_name").cast("bigint").alias("item_count"), F.pmod("c_custkey", F.lit(7)).cast("string").alias("base_type"),
    )
    nations = t.nation.select(
        F.concat(F.lit("{N-"), F.col("n_nationkey").cast("string"), F.lit("}")).alias("guid"), F.col("n_name").alias("title"),
        empty["web_url"].alias("web_url"), F.lit(0).cast("bigint").alias("item_count"), empty["base_type"].alias("base_type"),
    )
    targets = F.array(
        F.struct(F.lit("Nation").alias("name"), F.lit("Lookup").alias("type"), F.concat(F.lit("n-"), n).alias("lookup_list"), F.lit(False).alias("mult")),
        F.struct(F.lit("Parent").alias("name"), F.lit("Lookup").alias("type"), F.lit("Self").alias("lookup_list"), F.lit(True).alias("mult")),
        F.struct(F.lit("Gone").alias("name"), F.lit("LookupMulti").alias("type"), F.lit("{x}").alias("lookup_list"), F.lit(False).alias("mult")),
        F.struct(F.lit("Owner").alias("name"), F.lit("User").alias("type"), F.lit("{u}").alias("lookup_list"), F.lit(False).alias("mult")),
        F.struct(F.lit("Blank").alias("name"), F.lit("Lookup").alias("type"), F.lit("").alias("lookup_list"), F.lit(False).alias("mult")),
    )
    fields = t.customer.select(F.concat(F.lit("{C-"), c, F.lit("}")).alias("list_guid"), F.inline(targets)).select(
        "*", F.lit("").alias("display_name"), F.lit("Title").alias("show_field")
    )
    return own.unionByName(nations), fields


@query(
    "graph_edges",
    """SELECT '{C-' || c_custkey || '}' AS source_list_guid, p.field AS field_name, p.multi,
  CASE p.field WHEN 'Nation' THEN '{N-' || c_nationkey || '}' WHEN 'Parent' THEN '{C-' || c_custkey || '}' ELSE '{X}' END AS target_list_guid,
  CASE p.field WHEN 'Nation' THEN n_name WHEN 'Parent' THEN c_name END AS target_list_title,
  p.field = 'Parent' AS self_reference, p.field = 'Gone' AS dangling
FROM customer JOIN nation ON c_nationkey = n_nationkey, (VALUES ('Nation', false), ('Parent', true), ('Gone', true)) AS p(field, multi)""",
)
def graph_edges(t: Tables) -> DataFrame:
    lists, fields = customer_lists(t)
    return graph.build_graph_edges(lists, fields).select(
        "source_list_guid", "field_name", "multi", "target_list_guid", "target_list_title", "self_reference", "dangling"
    )


@query(
    "graph_nodes",
    """SELECT '{C-' || c_custkey || '}' AS list_guid, c_name AS title, CASE c_custkey % 7 WHEN 0 THEN 'generic_list' WHEN 1 THEN 'document_library'
  WHEN 3 THEN 'discussion_board' WHEN 4 THEN 'survey' WHEN 5 THEN 'issue_tracking' ELSE 'unknown_' || (c_custkey % 7) END AS base_type_name FROM customer
UNION ALL SELECT '{N-' || n_nationkey || '}', n_name, 'generic_list' FROM nation""",
)
def graph_nodes(t: Tables) -> DataFrame:
    return graph.build_graph_nodes(customer_lists(t)[0]).select("list_guid", "title", "base_type_name")


@query(
    "graph_summary",
    """SELECT (SELECT count(*) FROM customer) + (SELECT count(*) FROM nation) AS lists, 3 * count(*) AS edges, count(*) AS dangling_edges,
  count(*) AS self_references, 2 * count(*) AS multi_value_edges FROM customer""",
)
def graph_summary(t: Tables) -> DataFrame:
    lists, fields = customer_lists(t)
    return graph.graph_summary(graph.build_graph_nodes(lists), graph.build_graph_edges(lists, fields))


def _resolved(t: Tables) -> DataFrame:
    """Order lookups to customers; some labels have changed since, some customers are gone."""
    k = F.col("o_custkey").cast("string")
    text = F.concat(k, F.lit(";#"), F.col("c_name"))
    refs = decode.decode_fields(wired(order_rows(t), "o_orderkey", "Lookup", text, field="Customer", guid=segment_guid()))
    # Every segment has a list of orders that looks up its list of customers.
    target = F.concat(F.lit("{C-"), F.col("c_mktsegment"), F.lit("}"))
    edges = segments(t).select(
        segment_guid().alias("source_list_guid"), F.lit("Customer").alias("field_name"), target.alias("target_list_guid"), F.lit("Name").alias("show_field")
    )
    there = t.customer.filter("c_custkey % 25 <> 3")
    name = F.when(F.col("c_custkey") % 10 == 0, F.concat("c_name", F.lit(" AG"))).otherwise(F.col("c_name"))
    targets = decode.decode_fields(wired(there, "c_custkey", "Text", name, field="Name", guid=target))
    items = there.select(target.alias("list_guid"), F.col("c_custkey").alias("item_id"))
    return joins.resolve_lookups(refs, edges, joins.show_labels(items, targets, edges))


_RESOLVED_SQL = """resolved AS (SELECT o_orderkey AS item_id, o_custkey AS target_id, c_name AS stored_label,
  CASE WHEN c_custkey % 25 <> 3 THEN CASE WHEN c_custkey % 10 = 0 THEN c_name || ' AG' ELSE c_name END END AS current_label,
  c_custkey % 25 <> 3 AS target_found FROM orders JOIN customer ON o_custkey = c_custkey)"""
_RESOLVED = ["item_id", "target_id", "stored_label", "current_label"]


@query("resolve_lookups", f"WITH {_RESOLVED_SQL} SELECT * FROM resolved")
def resolve_lookups(t: Tables) -> DataFrame:
    return _resolved(t).select(*_RESOLVED, "target_found")


@query(
    "resolve_lookups_twice",
    """WITH o AS (SELECT o_orderkey, o_custkey, c_name, c_nationkey FROM orders JOIN customer ON o_custkey = c_custkey), n AS (SELECT n_nationkey, n_name || ' neu' AS name FROM nation WHERE n_nationkey % 5 <> 1)
SELECT 1 AS level, 'Customer' AS field, o_orderkey AS item_id, o_custkey AS target_id, c_name AS stored_label, c_name AS current_label, true AS target_found FROM o
UNION ALL SELECT 1, 'Nation', c_custkey, c_nationkey, 'alt', name, name IS NOT NULL FROM customer LEFT JOIN n ON c_nationkey = n_nationkey
UNION ALL SELECT 2, 'Customer/Nation', o_orderkey, c_nationkey, 'alt', name, name IS NOT NULL FROM o LEFT JOIN n ON c_nationkey = n_nationkey""",
)
def resolve_lookups_twice(t: Tables) -> DataFrame:
    """Orders to customers, customers to nations, and orders through their customers to nations."""
    number = F.col("o_custkey").cast("string")
    orders = decode.decode_fields(wired(order_rows(t), "o_orderkey", "Lookup", F.concat(number, F.lit(";#"), F.col("c_name")), field="Customer", guid=F.lit("{O}")))
    home = decode.decode_fields(wired(t.customer, "c_custkey", "Lookup", F.concat(F.col("c_nationkey").cast("string"), F.lit(";#alt")), field="Nation", guid=F.lit("{C}")))
    named = decode.decode_fields(wired(t.customer, "c_custkey", "Text", F.col("c_name"), field="Name", guid=F.lit("{C}")))
    there = t.nation.filter("n_nationkey % 5 <> 1")
    nations = decode.decode_fields(wired(there, "n_nationkey", "Text", F.concat("n_name", F.lit(" neu")), field="Title", guid=F.lit("{N}")))
    edges = t.spark.createDataFrame([("{O}", "Customer", "{C}", "Name"), ("{C}", "Nation", "{N}", None)], "source_list_guid string, field_name string, target_list_guid string, show_field string")
    items = t.customer.select(F.lit("{C}").alias("list_guid"), F.col("c_custkey").alias("item_id")).unionByName(there.select(F.lit("{N}").alias("list_guid"), F.col("n_nationkey").cast("bigint").alias("item_id")))
    fields = orders.unionByName(home).unionByName(named).unionByName(nations)
    found = joins.resolve_lookups(fields, edges, joins.show_labels(items, fields, edges), depth=2)
    return found.select("level", "field", "item_id", "target_id", "stored_label", "current_label", "target_found")


@query("stale_labels", f"WITH {_RESOLVED_SQL} SELECT item_id, target_id, stored_label, current_label FROM resolved WHERE target_found AND stored_label IS DISTINCT FROM current_label")
def stale_labels(t: Tables) -> DataFrame:
    return joins.stale_labels(_resolved(t)).select(*_RESOLVED)


@query("dangling_refs", f"WITH {_RESOLVED_SQL} SELECT item_id, target_id, stored_label, current_label FROM resolved WHERE NOT target_found")
def dangling_refs(t: Tables) -> DataFrame:
    return joins.dangling_refs(_resolved(t)).select(*_RESOLVED)


@query("resolve_people", "SELECT event_id, user_id, c_name AS author FROM events LEFT JOIN (SELECT * FROM customer WHERE c_custkey % 3 <> 0) ON user_id = c_custkey")
def resolve_people(t: Tables) -> DataFrame:
    users = t.customer.filter("c_custkey % 3 <> 0").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    return joins.resolve_people(t.events.select("event_id", "user_id"), users, "user_id")


_MATCH_SQL = """available AS (SELECT p_name AS name, min(p_partkey) AS pos FROM part GROUP BY p_name
  UNION ALL SELECT upper(p_name), min(p_partkey) + 1000000000 FROM part GROUP BY p_name),
wanted AS (SELECT DISTINCT CASE p_partkey % 5 WHEN 0 THEN p_name WHEN 1 THEN replace(p_name, ' ', '_') WHEN 2 THEN upper(substr(p_name, 1, 1)) || substr(p_name, 2)
  WHEN 3 THEN replace(p_name, ' ', 'ü') ELSE substr(p_name, 3, 6) || '-x' END AS wanted FROM part),
opts AS (SELECT name, pos, u.p AS priority, CASE u.p WHEN 0 THEN name WHEN 1 THEN lower(name) WHEN 2 THEN lower(regexp_replace(name, '[^\\p{L}\\p{N}]', '', 'g'))
  ELSE lower(regexp_replace(name, '[^0-9a-zA-Z]', '', 'g')) END AS key FROM available, (VALUES (0), (1), (2), (3)) AS u(p)),
hits AS (SELECT wanted, priority, name, pos FROM (SELECT wanted, u.p AS priority, CASE u.p WHEN 0 THEN wanted WHEN 1 THEN lower(wanted)
    WHEN 2 THEN lower(regexp_replace(wanted, '[^\\p{L}\\p{N}]', '', 'g')) ELSE lower(regexp_replace(wanted, '[^0-9a-zA-Z]', '', 'g')) END AS key
  FROM wanted, (VALUES (0), (1), (2), (3)) AS u(p)) JOIN opts USING (priority, key)),
best AS (SELECT wanted, arg_min(name, pos) AS match, priority, count(*) AS n FROM hits GROUP BY wanted, priority
  QUALIFY row_number() OVER (PARTITION BY wanted ORDER BY priority) = 1)"""


def _match_inputs(t: Tables) -> tuple[DataFrame, DataFrame]:
    n = F.col("p_name")
    firsts = t.part.groupBy(n.alias("name")).agg(F.min("p_partkey").alias("pos"))
    available = firsts.unionByName(firsts.select(F.upper("name").alias("name"), (F.col("pos") + 1000000000).alias("pos")))
    name = pick(
        "p_partkey", 5, n, F.replace(n, F.lit(" "), F.lit("_")), F.concat(F.upper(F.substring(n, 1, 1)), F.substr(n, F.lit(2))),
        F.replace(n, F.lit(" "), F.lit("ü")), F.concat(F.substring(n, 3, 6), F.lit("-x")),
    )
    return t.part.select(name.alias("name")), available


@query(
    "match_collections",
    f"WITH {_MATCH_SQL} SELECT w.wanted, match, priority, coalesce(n > 1, false) AS ambiguous, match IS NULL AS fallback FROM wanted w LEFT JOIN best USING (wanted)",
)
def match_collections(t: Tables) -> DataFrame:
    return joins.match_collections(*_match_inputs(t))


@query(
    "near_names",
    f"""WITH {_MATCH_SQL} SELECT w.wanted, count(a.name) AS near, arg_min(a.name, a.pos) AS first_near
FROM wanted w LEFT JOIN available a ON contains(lower(a.name), lower(substr(w.wanted, 1, 6))) WHERE w.wanted NOT IN (SELECT wanted FROM best) GROUP BY w.wanted""",
)
def near_names(t: Tables) -> DataFrame:
    wanted, available = _match_inputs(t)
    missed = joins.match_collections(wanted, available).filter("fallback").select(F.col("wanted").alias("name"))
    return joins.near_names(missed, available)


@query(
    "merge_list_metadata",
    f"""WITH {NATION_LISTS_SQL} SELECT guid, CASE WHEN n_nationkey % 3 = 0 THEN item_count ELSE item_count + 1 END AS item_count,
  enable_attachments OR n_nationkey % 3 = 1 AS enable_attachments, CASE WHEN n_nationkey % 3 = 2 THEN 'new' ELSE 'Lists/' || regexp_extract(guid, '-(.*)}}', 1) END AS root_folder,
  base_type FROM nation_lists""",
)
def merge_list_metadata(t: Tables) -> DataFrame:
    lists = nation_lists(t)
    n = F.regexp_extract("guid", r"\{(\d+)-", 1).cast("int") % 3
    said = lists.select(
        "guid", F.when(n == 0, 0).otherwise(F.col("item_count") + 1).alias("item_count"), (n == 1).alias("enable_attachments"),
        F.lit(False).alias("has_unique_scopes"), F.when(n == 2, "new").otherwise("").alias("root_folder"), F.lit("").alias("default_view_url"), F.lit("9").alias("base_type"),
    )
    return scope.merge_list_metadata(lists, said).select("guid", "item_count", "enable_attachments", "root_folder", "base_type")


@query("scope_webs", "SELECT c_custkey FROM customer WHERE (contains(lower(c_mktsegment), 'build') OR contains(lower(c_name), '7')) AND NOT contains(lower(c_name), '99')")
def scope_webs(t: Tables) -> DataFrame:
    webs = t.customer.select("c_custkey", F.col("c_name").alias("url"), F.col("c_mktsegment").alias("title"))
    return scope.scope_webs(webs, ["BUILD", "7"], ["99"]).select("c_custkey")


@query(
    "scope_lists",
    f"""WITH {NATION_LISTS_SQL}, r AS (SELECT guid, CASE WHEN title = 'Style Library' THEN 'system_list' WHEN hidden THEN 'hidden' WHEN base_type = '1' THEN 'document_library_excluded'
  WHEN NOT (contains(lower(title), 'b') OR contains(lower(guid), '-m') OR contains(lower(title), '2')) THEN 'not_in_include_lists' WHEN contains(lower(title), '12') THEN 'excluded' END AS reason FROM nation_lists)
SELECT guid, reason, reason IS NULL AS in_scope FROM r""",
)
def scope_lists(t: Tables) -> DataFrame:
    return scope.scope_lists(nation_lists(t), ["B", "-m", "2"], ["12"], libraries_too=False).select("guid", "reason", "in_scope")


_UUID5 = """substr(s,1,8)||'-'||substr(s,9,4)||'-5'||substr(s,14,3)||'-'||
  CASE WHEN substr(s,17,1) IN ('0','4','8','c') THEN '8' WHEN substr(s,17,1) IN ('1','5','9','d') THEN '9' WHEN substr(s,17,1) IN ('2','6','a','e') THEN 'a' ELSE 'b' END
  ||substr(s,18,3)||'-'||substr(s,21,12)"""


@query(
    "normalise_webs",
    f"""WITH w AS (SELECT regexp_extract(url, '^(https?)://', 1) || '://' || lower(regexp_extract(url, '^https?://([^/?#]*)', 1)) ||
    rtrim(regexp_extract(url, '^https?://[^/?#]*([^?#]*)', 1), '/') AS url, page_id FROM pages
  UNION ALL SELECT 'http://called.example.com/Root', -1),
g AS (SELECT url, coalesce(arg_min('Page ' || page_id, page_id) FILTER (page_id >= 0 AND page_id % 3 <> 0), '') AS title,
  sha1(unhex('6ba7b8119dad11d180b400c04fd430c8') || encode(url)) AS s FROM w GROUP BY url)
SELECT url, title, {_UUID5} AS web_id FROM g""",
)
def normalise_webs(t: Tables) -> DataFrame:
    title = F.when(F.col("page_id") % 3 == 0, F.lit("")).otherwise(F.concat(F.lit("Page "), F.col("page_id").cast("string")))
    scheme = F.upper(F.substring_index("url", ":", 1))
    loud = F.concat(F.when(F.col("page_id") % 2 == 0, scheme).otherwise(F.lower(scheme)), F.substr("url", F.length(scheme) + 1))
    webs = t.pages.select(title.alias("title"), loud.alias("url"), F.col("page_id").alias("pos"))
    return scope.normalise_webs(webs, "HTTP://Called.Example.com/Root/")


@query(
    "web_slugs",
    """SELECT page_id, substr(trim(regexp_replace(lower(regexp_extract(url, '^https?://([^/?#]*)', 1)) ||
  rtrim(regexp_extract(url, '^https?://[^/?#]*([^?#]*)', 1), '/'), '[^0-9a-zA-Z._-]+', '_', 'g'), '_'), 1, 150) AS slug FROM pages""",
)
def web_slugs(t: Tables) -> DataFrame:
    return t.pages.select("page_id", names.web_slug(F.col("url")).alias("slug"))


_EDGES_SQL = """edges AS (SELECT 'root' AS parent, 'r' || r_regionkey AS child, r_name AS title FROM region
  UNION ALL SELECT 'r' || n_regionkey, 'n' || n_nationkey, n_name FROM nation
  UNION ALL SELECT 'n' || c_nationkey, 'c' || c_custkey, c_name FROM customer
  UNION ALL SELECT 'c' || o_custkey, 'o' || o_orderkey, '' FROM orders
  UNION ALL SELECT 'o' || o_orderkey, 'root', 'Root' FROM orders WHERE o_orderkey % 1000 = 0)"""


def hierarchy(t: Tables) -> DataFrame:
    def edge(df: DataFrame, parent: str, p: str, child: str, c: str, title) -> DataFrame:
        return df.select(
            F.concat(F.lit(parent), F.col(p).cast("string")).alias("parent"), F.concat(F.lit(child), F.col(c).cast("string")).alias("child"),
            title.alias("title"), F.col(c).cast("bigint").alias("pos"),
        )

    regions = t.region.select(F.lit("root").alias("parent"), F.concat(F.lit("r"), F.col("r_regionkey").cast("string")).alias("child"), F.col("r_name").alias("title"), F.col("r_regionkey").cast("bigint").alias("pos"))
    back = t.orders.filter("o_orderkey % 1000 = 0").select(
        F.concat(F.lit("o"), F.col("o_orderkey").cast("string")).alias("parent"), F.lit("root").alias("child"), F.lit("Root").alias("title"), F.lit(0).cast("bigint").alias("pos")
    )
    out = regions.unionByName(edge(t.nation, "r", "n_regionkey", "n", "n_nationkey", F.col("n_name")))
    out = out.unionByName(edge(t.customer, "n", "c_nationkey", "c", "c_custkey", F.col("c_name")))
    return out.unionByName(edge(t.orders, "c", "o_custkey", "o", "o_orderkey", F.lit(""))).unionByName(back)


@query(
    "walk_hierarchy",
    f"""WITH RECURSIVE {_EDGES_SQL},
walk(url, depth) AS (SELECT 'root', 0 UNION SELECT child, depth + 1 FROM walk JOIN edges ON parent = url
  WHERE depth < 6 AND url NOT IN (SELECT 'n' || n_nationkey FROM nation WHERE n_nationkey % 6 = 0)),
f AS (SELECT url, min(depth) AS depth FROM walk GROUP BY url)
SELECT f.url, f.depth, coalesce(max(e.title), '') AS title,
  CASE WHEN f.url IN (SELECT 'n' || n_nationkey FROM nation WHERE n_nationkey % 6 = 0) THEN 'unreadable' ELSE 'read' END AS status
FROM f LEFT JOIN edges e ON e.child = f.url AND e.title <> '' GROUP BY f.url, f.depth""",
)
def walk_hierarchy(t: Tables) -> DataFrame:
    closed = t.nation.filter("n_nationkey % 6 = 0").select(F.concat(F.lit("n"), F.col("n_nationkey").cast("string")).alias("url"))
    return graph.walk_hierarchy(hierarchy(t), "root", closed)


@query("walk_depth_limit", "SELECT count(*) + 1 + (SELECT count(*) FROM region) AS webs, 1 AS depth_reached, CAST(0 AS BIGINT) AS unreadable, count(*) AS depth_limited, false AS complete FROM nation")
def walk_depth_limit(t: Tables) -> DataFrame:
    return graph.walk_summary(graph.walk_hierarchy(hierarchy(t), "root", max_depth=2))
