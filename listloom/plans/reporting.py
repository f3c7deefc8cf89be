"""Queries of files, captured bodies, documents and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import names
from ..operators import decode, files, graph, reports, scope, text
from .derive import NATION_LISTS_SQL, nation_lists, pick, raw_orders, segment_lists
from .registry import Tables, query
from .relating import customer_lists


@query(
    "plan_files",
    """WITH o AS (SELECT o_orderkey, '{' || c_mktsegment || '}' AS list_guid, length(c_mktsegment) % 2 = 1 AS library FROM orders JOIN customer ON o_custkey = c_custkey),
a AS (SELECT list_guid, o_orderkey AS item_id, 0 AS pos, 'http://farm/sites/x/' || o_orderkey || '_.000' AS url, o_orderkey || '_.000' AS file_name, false AS needs_listing FROM o WHERE library AND o_orderkey % 40 <> 0
  UNION ALL SELECT list_guid, o_orderkey, 0, 'http://farm/a/' || o_orderkey || '/scan%20one.pdf', 'scan one.pdf', false FROM o WHERE NOT library AND o_orderkey % 6 = 0
  UNION ALL SELECT list_guid, o_orderkey, 1, 'http://farm/a/' || o_orderkey || '/log.txt', 'log.txt', false FROM o WHERE NOT library AND o_orderkey % 6 = 0
  UNION ALL SELECT list_guid, o_orderkey, 0, NULL, NULL, true FROM o WHERE NOT library AND o_orderkey % 6 = 3) SELECT * FROM a""",
)
def plan_files(t: Tables) -> DataFrame:
    return files.plan_files(raw_orders(t), segment_lists(t))


@query(
    "safe_file_names",
    """WITH p AS (SELECT page_id, regexp_extract(url, '^https?://[^/?#]*([^?#]*)', 1) AS path FROM pages)
SELECT page_id, CASE WHEN string_split(path, '/')[-1] = '' THEN 'unnamed' ELSE string_split(path, '/')[-1] END AS from_url,
  CASE WHEN page_id % 3 = 0 THEN 'a_b_' || page_id || ' c.txt. ' WHEN page_id % 3 = 1 THEN repeat('n', 116) || '.txt' ELSE repeat('m', 120) END AS safe FROM p""",
)
def safe_file_names(t: Tables) -> DataFrame:
    k = F.col("page_id").cast("string")
    odd = pick("page_id", 3, F.concat(F.lit(" a/b?"), k, F.lit(" c.txt. ..")), F.lit("n" * 200 + ".txt"), F.lit("m" * 130 + ".longextension"))
    # The third name loses its end because its extension is too long to keep.
    return t.pages.select("page_id", names.file_name_from_url(F.col("url")).alias("from_url"), names.safe_file_name(odd).alias("safe"))


_FILES_SQL = """files AS (SELECT doc_id, source, n_chars, CASE doc_id % 6 WHEN 0 THEN source || '.PDF' WHEN 1 THEN source || '.tar.gz' WHEN 2 THEN '.bashrc' WHEN 3 THEN lang || '.log'
  WHEN 4 THEN 'photo.JPeG' ELSE 'readme' END AS name FROM documents)"""


def _files(t: Tables) -> DataFrame:
    name = pick(
        "doc_id", 6, F.concat("source", F.lit(".PDF")), F.concat("source", F.lit(".tar.gz")), F.lit(".bashrc"), F.concat("lang", F.lit(".log")),
        F.lit("photo.JPeG"), F.lit("readme"),
    )
    return t.documents.select("doc_id", "source", "n_chars", name.alias("name"))


@query(
    "skip_policy",
    f"""WITH {_FILES_SQL} SELECT doc_id, CASE WHEN doc_id % 6 = 1 THEN 'extension_excluded:.gz' WHEN doc_id % 6 = 2 THEN 'extension_excluded:.bashrc'
  WHEN n_chars > 5000 THEN 'too_large:' || n_chars || '>5000' END AS skip_reason FROM files""",
)
def skip_policy(t: Tables) -> DataFrame:
    return files.skip_policy(_files(t), "name", "n_chars", 5000, [".gz", ".bashrc"]).select("doc_id", "skip_reason")


@query(
    "skip_reasons",
    f"""WITH {_FILES_SQL}, s AS (SELECT CASE WHEN doc_id % 6 IN (1, 2) THEN 'extension_excluded' WHEN n_chars > 5000 THEN 'too_large' END AS reason FROM files)
SELECT reason, count(*) AS n FROM s WHERE reason IS NOT NULL GROUP BY 1""",
)
def skip_reasons(t: Tables) -> DataFrame:
    return reports.skip_reasons(files.skip_policy(_files(t), "name", "n_chars", 5000, [".gz", ".bashrc"]))


def _binary(t: Tables) -> DataFrame:
    return t.spread("documents").select(F.col("doc_id").cast("string").alias("path"), F.encode("text", "UTF-8").alias("content"))


@query("hash_inventory", "SELECT CAST(doc_id AS VARCHAR) AS path, CAST(octet_length(encode(text)) AS BIGINT) AS bytes, sha256(text) AS sha256 FROM documents")
def hash_inventory(t: Tables) -> DataFrame:
    return files.hash_inventory(_binary(t))


@query(
    "duplicates_by_content",
    "SELECT sha256(text) AS sha256, CAST(octet_length(encode(any_value(text))) AS BIGINT) AS bytes, count(*) AS copies, min(CAST(doc_id AS VARCHAR)) AS first_path FROM documents GROUP BY 1 HAVING count(*) > 1",
)
def duplicates_by_content(t: Tables) -> DataFrame:
    return files.duplicates_by_content(files.hash_inventory(_binary(t)))


@query("file_kind", f"WITH {_FILES_SQL} SELECT doc_id, CASE doc_id % 6 WHEN 0 THEN 'document' WHEN 1 THEN 'archive' WHEN 3 THEN 'text' WHEN 4 THEN 'image' ELSE 'other' END AS kind FROM files")
def file_kind(t: Tables) -> DataFrame:
    return _files(t).select("doc_id", names.file_kind(F.col("name")).alias("kind"))


@query(
    "file_census",
    f"""WITH {_FILES_SQL}, k AS (SELECT source AS list, CASE doc_id % 6 WHEN 0 THEN 'document' WHEN 1 THEN 'archive' WHEN 3 THEN 'text' WHEN 4 THEN 'image' ELSE 'other' END AS kind, n_chars FROM files)
SELECT CASE GROUPING(list) * 2 + GROUPING(kind) WHEN 0 THEN 'list and kind' WHEN 1 THEN 'list' WHEN 2 THEN 'kind' ELSE 'all' END AS level, list, kind, count(*) AS files, count(DISTINCT n_chars) AS items
FROM k GROUP BY GROUPING SETS ((list, kind), (list), (kind), ())""",
)
def file_census(t: Tables) -> DataFrame:
    return reports.file_census(_files(t), "name", "source", "n_chars")


@query(
    "verify_payloads",
    """SELECT page_id, CASE page_id % 5 WHEN 0 THEN false WHEN 1 THEN true WHEN 2 THEN false WHEN 3 THEN true ELSE false END AS is_file FROM pages""",
)
def verify_payloads(t: Tables) -> DataFrame:
    html = F.col("html")
    rows = t.pages.select(
        "page_id",
        pick("page_id", 5, F.lit("a.pdf"), F.lit("a.HTML"), F.lit("a.zip"), F.lit("a.json"), F.lit("a.txt")).alias("name"),
        pick("page_id", 5, F.lit("application/pdf"), F.lit("text/html"), F.lit("application/json;v=1"), F.lit("application/json"), F.lit("text/plain")).alias("content_type"),
        pick("page_id", 5, F.concat(F.lit("\n "), html), html, F.concat(F.lit(' {"d":'), F.to_json(F.array(html)), F.lit("}")), F.to_json(F.array(html)), F.lit("")).alias("content"),
    )
    return files.verify_payloads(rows).select("page_id", "is_file")


def _bodies(t: Tables) -> DataFrame:
    """Pages as captured bodies: plain, wrapped in an envelope, as a login form, behind a long head."""
    html = F.col("html")
    envelope = F.concat(F.lit("<soap:Envelope><soap:Body>"), F.replace(F.replace(html, F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;")), F.lit("</soap:Body></soap:Envelope>"))
    fault = F.concat(F.lit("<soap:Envelope><soap:Fault><faultstring>Server did not recognize the value of HTTP Header SOAPAction: "), F.col("url"), F.lit("</faultstring></soap:Fault></soap:Envelope>"))
    login = F.concat(F.lit('<FORM action="x"><input name="__VIEWSTATE"/>'), html)
    late = F.concat(F.repeat(F.lit(" x"), F.lit(6000)), F.lit("<soap:Envelope>"), html)
    return t.pages.select("page_id", "url", "html", pick("page_id", 6, html, envelope, fault, login, F.lit(" \n"), late).alias("body"))


@query(
    "classify_payloads",
    """SELECT page_id, CASE page_id % 6 WHEN 0 THEN CASE WHEN instr(lower(html), 'login.aspx') > 0 THEN 'login_form'
      WHEN instr(lower(html), '<html') > 0 THEN 'html_page' ELSE 'not_an_envelope' END
  WHEN 1 THEN 'envelope_without_result' WHEN 2 THEN 'unsupported_operation' WHEN 3 THEN 'login_form' WHEN 4 THEN 'empty' ELSE 'html_page' END AS payload FROM pages""",
)
def classify_payloads(t: Tables) -> DataFrame:
    return text.classify_payloads(_bodies(t)).select("page_id", "payload")


@query(
    "extract_error_message",
    r"""WITH f AS (SELECT doc_id, trim(regexp_replace(text, '\s+', ' ', 'g')) AS folded FROM documents)
SELECT doc_id, md5(CASE doc_id % 5 WHEN 0 THEN folded WHEN 1 THEN 'plain ' || doc_id WHEN 2 THEN 'xml reason ' || doc_id WHEN 3 THEN '(empty body)' ELSE folded END) AS message_md5 FROM f""",
)
def extract_error_message(t: Tables) -> DataFrame:
    k = F.col("doc_id").cast("string")
    nested = F.to_json(F.struct(F.struct(F.struct(F.lit("en").alias("lang"), F.col("text").alias("value")).alias("message")).alias("error")))
    body = pick(
        "doc_id", 5, nested, F.concat(F.lit('{"error":{"message":"plain '), k, F.lit('"}}')),
        F.concat(F.lit("<m:error><m:message xml:lang='de'> xml\n reason "), k, F.lit("</m:message></m:error>")), F.lit(" "), F.col("text"),
    )
    out = text.extract_error_message(t.spread("documents").select("doc_id", body.alias("body")))
    return out.select("doc_id", F.md5("message").alias("message_md5"))


@query(
    "extract_faults",
    """SELECT page_id, CASE page_id % 4 WHEN 0 THEN 'list view threshold <' || page_id || '>' WHEN 1 THEN 'unknown SOAP fault' END AS faultstring,
  CASE page_id % 4 WHEN 0 THEN 'soap:Server' END AS faultcode, CASE page_id % 4 WHEN 0 THEN '0x80070024' END AS errorcode, page_id % 4 < 2 AS application_error FROM pages""",
)
def extract_faults(t: Tables) -> DataFrame:
    k = F.col("page_id").cast("string")
    full = F.concat(
        F.lit("<soap:Envelope><soap:Body><soap:Fault><faultcode>soap:Server</faultcode><faultstring> list view threshold &lt;"), k,
        F.lit('&gt; </faultstring><detail><errorcode xmlns="x">0x80070024</errorcode></detail></soap:Fault></soap:Body></soap:Envelope>'), F.col("html"),
    )
    bare = F.concat(F.lit("<SOAP-ENV:Fault><detail/></SOAP-ENV:Fault>"), F.col("html"))
    broken = F.concat(F.lit('<List DefaultViewUrl="/fault/x"'), F.col("html"))
    rows = t.pages.select("page_id", pick("page_id", 4, full, bare, broken, F.col("html")).alias("body"))
    return text.extract_faults(rows).select("page_id", "faultstring", "faultcode", "errorcode", "application_error")


@query(
    "redact",
    """WITH r AS (SELECT doc_id, replace(replace(replace(replace(text, 'Passwort', '***REDACTED***'), 'token', '***REDACTED***'), 'que', '***REDACTED***'), 'the', '***REDACTED***') AS t,
  CASE doc_id % 2 WHEN 0 THEN 'Basic ***REDACTED***' ELSE 'pw=***REDACTED***' END AS h FROM documents)
SELECT doc_id, md5(t) AS text_md5, md5(h) AS header_md5, md5(t) AS variant_md5, 'h ***REDACTED***' AS map_key FROM r""",
)
def redact(t: Tables) -> DataFrame:
    header = F.when(F.col("doc_id") % 2 == 0, F.lit("Basic dXNlcjpQYXNzd29ydA==")).otherwise(F.lit("pw=Passwort"))
    rows = t.spread("documents").select(
        "doc_id", "text", F.struct(F.map_from_arrays(F.array(F.lit("auth")), F.array(header)).alias("headers")).alias("request"),
        F.parse_json(F.to_json(F.struct(F.col("text").alias("body")))).alias("fields"), F.create_map(F.lit("h Passwort"), F.lit(1)).alias("named"),
    )
    out = text.redact(rows, ["Passwort", "token", "que", "the", "x"], "user")
    return out.select(
        "doc_id", F.md5("text").alias("text_md5"), F.md5(F.col("request.headers")["auth"]).alias("header_md5"),
        F.md5(F.try_variant_get("fields", "$.body", "string")).alias("variant_md5"), F.map_keys("named")[0].alias("map_key"),
    )


@query(
    "document_lookups",
    """SELECT 'D' || o_orderkey AS id, 'Customer' AS field, '{C}' AS target_list_guid, o_custkey AS target_item_id FROM orders WHERE o_orderkey % 40 <> 0
UNION ALL SELECT 'D' || o_orderkey, 'Related', '{O}', o_orderkey + d FROM orders, (VALUES (1), (2)) AS v(d) WHERE o_orderkey % 40 <> 0 AND o_orderkey % 3 = 0""",
)
def document_lookups(t: Tables) -> DataFrame:
    """A customer for each order and two further orders for every third; folders are no documents."""
    k = F.col("o_orderkey")
    one = F.struct(F.lit("Customer").alias("field"), F.lit("Lookup").alias("wire_type"), F.concat(F.col("o_custkey").cast("string"), F.lit(";#x")).alias("raw"))
    pair = F.concat((k + 1).cast("string"), F.lit(";#a;#"), (k + 2).cast("string"), F.lit(";#b"))
    more = F.struct(F.lit("Related").alias("field"), F.lit("LookupMulti").alias("wire_type"), F.when(k % 3 == 0, pair).otherwise(F.lit("")).alias("raw"))
    rows = t.orders.select(F.lit("{O}").alias("list_guid"), k.alias("item_id"), F.inline(F.array(one, more)))
    fields = decode.decode_fields(rows.withColumn("result_type", F.lit(None).cast("string")))
    edges = t.spark.createDataFrame([("{O}", "Customer", "{C}"), ("{O}", "Related", "{O}")], "source_list_guid string, field_name string, target_list_guid string")
    items = t.orders.select(F.lit("{O}").alias("list_guid"), k.alias("item_id"), F.concat(F.lit("D"), k.cast("string")).alias("doc_id"), (k % 40 == 0).alias("is_folder"))
    return text.document_lookups(fields, edges, items)


@query(
    "document_files",
    "SELECT 'D' || o_orderkey AS id, o_orderpriority AS filename, 'files/' || o_orderkey AS local_path FROM orders WHERE o_orderstatus = 'F'",
)
def document_files(t: Tables) -> DataFrame:
    key = F.col("o_orderkey").cast("string")
    files = t.orders.select(
        F.concat(F.lit("D"), key).alias("doc_id"), F.col("o_orderpriority").alias("filename"), F.concat(F.lit("files/"), key).alias("local_path"), (F.col("o_orderstatus") == "F").alias("downloaded")
    )
    return text.document_files(files)


_PEOPLE = [("Name", "Name", "Text"), ("Segment", "Sparte", "Choice"), ("Balance", "Saldo", "Integer"), ("Nation", "Land", "Lookup"), ("Empty", "Leer", "Text")]


@query(
    "build_documents",
    """SELECT '{L}:' || c_custkey AS id, 'Name: ' || c_name || chr(10) || 'Sparte: ' || c_mktsegment || chr(10) ||
  CASE WHEN c_custkey % 4 = 0 THEN '' ELSE 'Saldo: ' || c_custkey || chr(10) END || 'Land: ' || n_name AS text FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_custkey % 10 <> 0""",
)
def build_documents(t: Tables) -> DataFrame:
    rows = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    values = {
        "Name": F.col("c_name"), "Segment": F.col("c_mktsegment"),
        "Balance": F.when(F.col("c_custkey") % 4 == 0, F.lit("")).otherwise(F.col("c_custkey").cast("string")),
        "Nation": F.concat(F.col("c_nationkey").cast("string"), F.lit(";#"), F.col("n_name")), "Empty": F.lit(""),
    }
    entries = F.array(*[F.struct(F.lit(n).alias("field"), F.lit(ty).alias("wire_type"), values[n].alias("raw")) for n, _d, ty in _PEOPLE])
    exploded = rows.select(F.lit("{L}").alias("list_guid"), F.col("c_custkey").alias("item_id"), F.inline(entries))
    fields = F.array(*[F.struct(F.lit(i).alias("pos"), F.lit(n).alias("name"), F.lit(d).alias("display_name")) for i, (n, d, _t) in enumerate(_PEOPLE)])
    list_fields = t.spark.range(1).select(F.lit("{L}").alias("list_guid"), F.inline(fields))
    k = F.col("c_custkey")
    items = rows.select(
        F.lit("{L}").alias("list_guid"), k.alias("item_id"), F.concat(F.lit("{L}:"), k.cast("string")).alias("doc_id"), F.lit("u").alias("display_url"),
        F.lit("Kunden").alias("list_title"), F.lit("m").alias("modified"), (k % 10 == 0).alias("is_folder"),
    )
    return text.build_documents(items, decode.decode_fields(exploded), list_fields).select("id", "text")


@query(
    "landing_stats",
    f"""WITH {NATION_LISTS_SQL}, o AS (SELECT '{{' || c_nationkey || '-' || c_mktsegment || '}}' AS guid, * FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderkey % 5 <> 0),
i AS (SELECT guid, count(*) AS items FROM o GROUP BY 1), f AS (SELECT guid, count(*) AS files, sum(l_partkey) AS file_bytes FROM o JOIN lineitem ON l_orderkey = o_orderkey WHERE c_nationkey % 3 = 0 GROUP BY 1)
SELECT web_url, guid AS list_guid, CAST(GROUPING(web_url, guid) AS BIGINT) AS level, count(*) AS lists, CAST(coalesce(sum(items), 0) AS BIGINT) AS items,
  CAST(coalesce(sum(files), 0) AS BIGINT) AS files, CAST(coalesce(sum(file_bytes), 0) AS BIGINT) AS file_bytes
FROM nation_lists LEFT JOIN i USING (guid) LEFT JOIN f USING (guid) GROUP BY ROLLUP (web_url, guid)""",
)
def landing_stats(t: Tables) -> DataFrame:
    owned = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).filter("o_orderkey % 5 <> 0")
    guid = F.concat(F.lit("{"), F.col("c_nationkey").cast("string"), F.lit("-"), F.col("c_mktsegment"), F.lit("}"))
    items = owned.select(guid.alias("list_guid"), "o_orderkey", "c_nationkey")
    attached = items.filter("c_nationkey % 3 = 0").join(t.lineitem, F.col("o_orderkey") == F.col("l_orderkey"))
    return reports.landing_stats(nation_lists(t), items, attached.select("list_guid", F.col("l_partkey").alias("bytes")))


@query(
    "run_counts",
    f"""WITH {NATION_LISTS_SQL} SELECT 'webs_discovered' AS counter, (SELECT count(*) FROM nation) AS n
UNION ALL SELECT 'lists_discovered', count(*) FROM nation_lists UNION ALL SELECT 'lists_in_scope', count(*) FROM nation_lists WHERE NOT hidden AND title <> 'Style Library'
UNION ALL SELECT 'lists_succeeded', count(*) FROM nation_lists WHERE item_count % 3 = 0 UNION ALL SELECT 'lists_failed', count(*) FROM nation_lists WHERE item_count % 3 = 1
UNION ALL SELECT 'lists_skipped', count(*) FROM nation_lists WHERE item_count % 3 = 2 UNION ALL SELECT 'items_written', CAST(sum(item_count) AS BIGINT) FROM nation_lists
UNION ALL SELECT 'items_deleted', count(*) FROM events WHERE event_type = 'error' UNION ALL SELECT 'files_downloaded', count(*) FROM documents WHERE n_chars <= 5000
UNION ALL SELECT 'files_skipped', count(*) FROM documents WHERE n_chars > 5000 UNION ALL SELECT 'file_bytes', CAST(sum(n_chars) AS BIGINT) FROM documents WHERE n_chars <= 5000
UNION ALL SELECT 'decoder_warnings', count(*) FROM lineitem WHERE l_orderkey % 17 = 0 UNION ALL SELECT 'dangling_edges', count(*) FROM customer""",
)
def run_counts(t: Tables) -> DataFrame:
    lists = scope.scope_lists(nation_lists(t))
    rest = F.pmod("item_count", F.lit(3))
    state = lists.select(F.when(rest == 0, "complete").when(rest == 1, "failed").otherwise("skipped").alias("status"), F.col("item_count").alias("items_written"))
    small = F.col("n_chars") <= 5000
    attached = t.documents.select(small.alias("downloaded"), F.col("n_chars").alias("bytes"), F.when(~small, "too_large:1>0").alias("skip_reason"))
    warned = t.lineitem.filter("l_orderkey % 17 = 0")
    synced = t.events.filter("event_type = 'error'").select(F.lit(1).alias("deleted"))
    all_lists, fields = customer_lists(t)
    return reports.run_counts(t.nation, lists, state, attached, warned, graph.build_graph_edges(all_lists, fields), synced)


@query("ingest_gate", f"WITH {NATION_LISTS_SQL} SELECT count(*) FILTER (item_count % 3 = 1) AS lists_failed, count(*) FILTER (item_count % 3 = 1) = 0 AS accepted FROM nation_lists")
def ingest_gate(t: Tables) -> DataFrame:
    return reports.ingest_gate(run_counts(t))


_ESTIMATE_SQL = f"""{NATION_LISTS_SQL}, e AS (SELECT web_url, guid AS list_guid, title AS list_title,
  CASE base_type WHEN '0' THEN 'generic_list' WHEN '1' THEN 'document_library' WHEN '3' THEN 'discussion_board' WHEN '4' THEN 'survey' WHEN '5' THEN 'issue_tracking' ELSE 'unknown_' || base_type END AS base_type,
  item_count AS items, greatest(1, CAST(ceil(item_count / 20.0) AS BIGINT)) AS pages,
  greatest(1, CAST(ceil(item_count / 20.0) AS BIGINT)) + 1 + CASE WHEN base_type = '1' OR enable_attachments THEN item_count ELSE 0 END AS estimated_requests, has_unique_scopes FROM nation_lists)"""


@query("estimate_extraction", f"WITH {_ESTIMATE_SQL} SELECT * FROM e")
def estimate_extraction(t: Tables) -> DataFrame:
    return reports.estimate_extraction(nation_lists(t), 20, True)


@query(
    "estimate_totals",
    f"""WITH {_ESTIMATE_SQL} SELECT (SELECT count(*) FROM nation) AS webs, count(*) AS lists, CAST(sum(items) AS BIGINT) AS items,
  CAST(sum(estimated_requests) + (SELECT count(*) FROM nation) + 1 AS BIGINT) AS estimated_requests,
  round_even((sum(estimated_requests) + (SELECT count(*) FROM nation) + 1) / 4.0 / 60, 1) AS estimated_minutes FROM e""",
)
def estimate_totals(t: Tables) -> DataFrame:
    return reports.estimate_totals(reports.estimate_extraction(nation_lists(t), 20, True), t.nation, 4.0)


_SIZES_SQL = "counts AS (SELECT p_brand || ' ' || p_type AS name, CASE WHEN min(p_partkey) % 7 <> 3 THEN CAST(sum(p_size) * 20 * (min(p_partkey) % 5) AS BIGINT) END AS entries FROM part GROUP BY p_brand, p_type)"


def _sizes(t: Tables) -> DataFrame:
    grouped = t.part.groupBy("p_brand", "p_type").agg(F.min("p_partkey").alias("k"), F.sum("p_size").alias("s"))
    entries = F.when(F.col("k") % 7 != 3, F.col("s") * 20 * (F.col("k") % 5))
    return grouped.select(F.concat_ws(" ", "p_brand", "p_type").alias("name"), entries.alias("entries"), F.when(entries.isNull(), "timeout").alias("error"))


@query("collection_sizes", f"WITH {_SIZES_SQL} SELECT name, entries, coalesce(entries > 5000, false) AS oversized FROM counts")
def collection_sizes(t: Tables) -> DataFrame:
    return reports.collection_sizes(_sizes(t)).select("name", "entries", "oversized")


@query(
    "collection_totals",
    f"""WITH {_SIZES_SQL} SELECT count(*) AS collections, CAST(coalesce(sum(entries), 0) AS BIGINT) AS entries, count(*) FILTER (entries IS NULL) AS failed,
  count(*) FILTER (entries = 0) AS empty, count(*) FILTER (entries > 5000) AS oversized FROM counts""",
)
def collection_totals(t: Tables) -> DataFrame:
    return reports.collection_totals(_sizes(t))


@query(
    "oversized_lists",
    """SELECT 'http://farm :: ' || l_suppkey || ' (' || format('{:,}', sum(l_partkey)) || ' items)' AS line FROM lineitem GROUP BY l_suppkey HAVING sum(l_partkey) > 5000""",
)
def oversized_lists(t: Tables) -> DataFrame:
    lists = t.lineitem.groupBy(F.col("l_suppkey").cast("string").alias("title")).agg(F.sum("l_partkey").alias("item_count"))
    return reports.oversized_lists(lists.withColumn("web_url", F.lit("http://farm")), 14)


@query("unique_scope_lists", f"WITH {NATION_LISTS_SQL} SELECT web_url || ' :: ' || title AS line FROM nation_lists WHERE has_unique_scopes")
def unique_scope_lists(t: Tables) -> DataFrame:
    return reports.unique_scope_lists(nation_lists(t))


def _access(t: Tables) -> tuple[DataFrame, DataFrame]:
    readable = F.col("n_nationkey") % 9 != 4
    webs = t.nation.select(F.concat(F.lit("http://farm/"), F.lower("n_name")).alias("web_url"), readable.alias("readable"), F.when(~readable, "401").alias("reason"))
    lists = nation_lists(t)
    allowed = F.col("item_count") % 4 != 1
    return webs, lists.select("web_url", "guid", "item_count", "has_unique_scopes", allowed.alias("readable"))


_ACCESS_SQL = f"""{NATION_LISTS_SQL}, w AS (SELECT 'http://farm/' || lower(n_name) AS web_url, n_nationkey % 9 <> 4 AS readable, CASE WHEN n_nationkey % 9 = 4 THEN '401' END AS reason FROM nation),
by_web AS (SELECT w.web_url, w.readable, w.reason, count(l.guid) AS lists, count(l.guid) FILTER (l.item_count % 4 <> 1) AS readable_lists, count(l.guid) FILTER (l.has_unique_scopes) AS unique_scope_lists
  FROM w LEFT JOIN nation_lists l ON w.web_url = l.web_url GROUP BY ALL)"""


@query("access_by_web", f"WITH {_ACCESS_SQL} SELECT * FROM by_web")
def access_by_web(t: Tables) -> DataFrame:
    return reports.access_by_web(*_access(t))


@query(
    "access_summary",
    f"""WITH {_ACCESS_SQL} SELECT count(*) FILTER (readable) AS readable_webs, count(*) FILTER (NOT readable) AS denied_webs, CAST(sum(lists) AS BIGINT) AS total_lists,
  CAST(sum(readable_lists) AS BIGINT) AS readable_lists, CAST(sum(unique_scope_lists) AS BIGINT) AS unique_scope_lists, bool_and(readable AND lists = readable_lists) AS complete FROM by_web""",
)
def access_summary(t: Tables) -> DataFrame:
    return reports.access_summary(reports.access_by_web(*_access(t)))


@query("access_details", f"WITH {NATION_LISTS_SQL} SELECT web_url, guid, item_count, item_count % 4 <> 1 AS readable FROM nation_lists")
def access_details(t: Tables) -> DataFrame:
    return reports.access_details(_access(t)[1]).select("web_url", "guid", "item_count", "readable")


@query(
    "error_report",
    """SELECT event_type AS scope, CAST(user_id AS VARCHAR) AS list_guid, 'E' || (event_id % 2) AS error_type, count(*) AS errors, count(*) FILTER (event_id % 5 < 3) AS throttled
FROM events GROUP BY ALL""",
)
def error_report(t: Tables) -> DataFrame:
    message = pick(
        "event_id", 5, F.lit("Exceeds the List View limit"), F.lit("Zu viele Zeilen, Schwellenwert für die Listenansicht erreicht"), F.lit("code 0x80070024"),
        F.concat(F.lit("timeout "), F.col("props")), F.lit("list view"),
    )
    kind = F.concat(F.lit("E"), (F.col("event_id") % 2).cast("string"))
    return reports.error_report(t.events.select(F.col("event_type").alias("scope"), F.col("user_id").cast("string").alias("list_guid"), kind.alias("error_type"), message.alias("message")))


@query(
    "traffic_report",
    """SELECT event_type AS operation, CASE WHEN event_id % 10 = 0 THEN 500 ELSE 200 END AS status, count(*) AS requests, CAST(sum(user_id) AS BIGINT) AS bytes,
  CAST(sum(event_id % 997 / 4) AS DOUBLE) AS duration, CAST(coalesce(sum(CASE WHEN event_id % 3 = 0 THEN 0.5 END), 0) AS DOUBLE) AS wait,
  CAST(round(sum(user_id % 7) / sum(event_id % 997 / 4), 6) AS DOUBLE) AS rows_per_second, true AS median_is_near FROM events GROUP BY ALL""",
)
def traffic_report(t: Tables) -> DataFrame:
    """Sketched by day, merged; the rank of each median in its group's durations tells whether it is within the stated error."""
    e = F.col("event_id")
    log = t.events.select(
        F.col("event_type").alias("operation"), F.when(e % 10 == 0, 500).otherwise(200).alias("status"), F.col("user_id").alias("bytes"),
        ((e % 997) / 4).alias("duration"), F.when(e % 3 == 0, F.lit(0.5)).alias("wait"), (F.col("user_id") % 7).alias("rows"), F.to_date("ts").alias("day"),
    )
    out = reports.merge_traffic(reports.traffic_sketches(log, ["operation", "status", "day"]))
    medians = F.broadcast(out.select("operation", "status", "median_duration"))  # a row for each kind of request
    below = F.avg((F.col("duration") < F.col("median_duration")).cast("double")).alias("_below")
    upto = F.avg((F.col("duration") <= F.col("median_duration")).cast("double")).alias("_upto")
    ranks = log.join(medians, ["operation", "status"]).groupBy("operation", "status").agg(below, upto)
    near = (F.col("_below") - reports.SKETCH_ERROR <= 0.5) & (F.col("_upto") + reports.SKETCH_ERROR >= 0.5)
    judged = out.join(ranks, ["operation", "status"]).withColumn("median_is_near", near)
    return judged.withColumn("rows_per_second", F.round("rows_per_second", 6)).drop("median_duration", "_below", "_upto")
