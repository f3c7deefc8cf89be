"""Queries of the decode rules."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import names, wire
from ..operators import decode, odata, scope
from .derive import NATION_LISTS_SQL, money, nation_lists, order_fields, order_rows, pick, raw_orders, segment_lists, wired
from .registry import Tables, query

TS = "yyyy-MM-dd HH:mm:ss"


@query(
    "split_tokens",
    """SELECT o_orderkey, CAST(CASE WHEN o_orderkey % 5 < 2 THEN 2 WHEN o_orderkey % 5 = 2 THEN 3 ELSE 0 END AS BIGINT) AS n,
  CASE WHEN o_orderkey % 5 < 2 THEN o_orderpriority || '|' || o_orderstatus
       WHEN o_orderkey % 5 = 2 THEN o_orderpriority || '||' || o_orderstatus ELSE '' END AS parts FROM orders""",
)
def split_tokens(t: Tables) -> DataFrame:
    a, b, d = F.col("o_orderpriority"), F.col("o_orderstatus"), F.lit(";#")
    text = pick("o_orderkey", 5, F.concat(d, a, d, b, d), F.concat(F.lit(" "), a, d, b), F.concat(d, a, d, d, b, d), F.lit("  "), d)
    parts = wire.tokens(text)
    return t.orders.select("o_orderkey", F.size(parts).cast("bigint").alias("n"), F.array_join(parts, "|").alias("parts"))


@query("decode_text", "SELECT doc_id, md5(text) AS text_md5, length(text) AS n_chars FROM documents")
def decode_text(t: Tables) -> DataFrame:
    out = decode.decode_fields(wired(t.documents, "doc_id", "Note", F.col("text")))
    return out.select(F.col("item_id").alias("doc_id"), F.md5("v_string").alias("text_md5"), F.length("v_string").cast("bigint").alias("n_chars"))


@query(
    "decode_number",
    """SELECT l_returnflag, l_linestatus, count(*) AS n,
  count(*) FILTER (l_orderkey % 17 NOT IN (0, 1)) AS decoded,
  CAST(sum(CASE WHEN l_orderkey % 17 NOT IN (0, 1) THEN CAST(l_extendedprice AS DECIMAL(18,2)) END) * 100 AS BIGINT) AS cents,
  count(*) FILTER (l_orderkey % 17 = 0) AS warned
FROM lineitem GROUP BY ALL""",
)
def decode_number(t: Tables) -> DataFrame:
    damaged = F.pmod("l_orderkey", F.lit(17))
    text = F.when(damaged == 0, F.concat(F.lit("EUR "), money("l_extendedprice"))).when(damaged == 1, F.lit(" ")).otherwise(money("l_extendedprice"))
    keyed = t.spread("lineitem").select("l_returnflag", "l_linestatus", text.alias("raw")).select(
        F.lit("{L}").alias("list_guid"), "l_returnflag", "l_linestatus", F.lit("Price").alias("field"), F.lit("Currency").alias("wire_type"), "raw"
    )
    out = decode.decode_fields(keyed)
    return out.groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("n"),
        F.count("v_double").alias("decoded"),
        F.sum((F.col("v_double").cast("decimal(18,2)") * 100).cast("bigint")).alias("cents"),
        F.count_if(F.array_contains("warnings", "number_unparseable")).alias("warned"),
    )


@query(
    "decode_integer",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 6 < 3 THEN o_custkey WHEN o_orderkey % 6 = 3 THEN -o_custkey END AS v,
  CASE WHEN o_orderkey % 6 = 4 THEN 'int_unparseable' ELSE '' END AS warning FROM orders""",
)
def decode_integer(t: Tables) -> DataFrame:
    c = F.col("o_custkey").cast("string")
    text = pick("o_orderkey", 6, c, F.concat(c, F.lit(".0000000000")), F.concat(F.lit(" \t"), c, F.lit(" ")), F.concat(F.lit("-"), c), F.concat(c, F.lit("_x")), F.lit(""))
    out = decode.decode_fields(wired(t.orders, "o_orderkey", "Integer", text))
    return out.select(F.col("item_id").alias("o_orderkey"), F.col("v_bigint").alias("v"), F.array_join("warnings", ",").alias("warning"))


@query(
    "decode_boolean",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 11 < 5 THEN true WHEN o_orderkey % 11 < 9 THEN false END AS v,
  CASE WHEN o_orderkey % 11 = 9 THEN 'boolean_unparseable' ELSE '' END AS warning FROM orders""",
)
def decode_boolean(t: Tables) -> DataFrame:
    words = ["1", "TRUE", " Yes", "on", "-1", "0", "False", "no ", "OFF", "maybe", " "]
    text = pick("o_orderkey", 11, *[F.lit(w) for w in words])
    out = decode.decode_fields(wired(t.orders, "o_orderkey", "Boolean", text))
    return out.select(F.col("item_id").alias("o_orderkey"), F.col("v_bool").alias("v"), F.array_join("warnings", ",").alias("warning"))


@query(
    "decode_datetime",
    """SELECT event_id, CASE WHEN event_id % 10 IN (6, 9) THEN NULL
  WHEN event_id % 10 IN (2, 5) THEN strftime(date_trunc('day', ts), '%Y-%m-%d %H:%M:%S')
  WHEN event_id % 10 = 4 THEN strftime(ts - INTERVAL 2 HOUR, '%Y-%m-%d %H:%M:%S')
  WHEN event_id % 10 = 8 THEN strftime(date_trunc('minute', ts), '%Y-%m-%d %H:%M:%S')
  ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS v,
  CASE WHEN event_id % 10 = 3 THEN CAST(extract('microseconds' FROM ts) % 1000000 AS BIGINT) END AS micros,
  CASE WHEN event_id % 10 = 6 THEN 'datetime_unparseable' ELSE '' END AS warning FROM events""",
)
def decode_datetime(t: Tables) -> DataFrame:
    ts = F.col("ts").cast("timestamp")

    def f(pattern: str):
        return F.date_format(ts, pattern)

    text = pick(
        "event_id", 10, f("yyyy-MM-dd'T'HH:mm:ss'Z'"), f("yyyy-MM-dd HH:mm:ss"), f("yyyy-MM-dd"),
        f("yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"), f("yyyy-MM-dd'T'HH:mm:ss'+02:00'"), f("yyyyMMdd"), f("'week' yyyy"),
        f("yyyyMMdd'T'HHmmss'Z'"), f("yyyy-MM-dd'T'HH:mm'Z'"), F.lit(" "),
    )
    out = decode.decode_fields(wired(t.events, "event_id", "DateTime", text))
    micros = F.when(F.pmod("item_id", F.lit(10)) == 3, F.pmod(F.unix_micros("v_ts"), F.lit(1000000)))
    return out.select(F.col("item_id").alias("event_id"), F.date_format("v_ts", TS).alias("v"), micros.alias("micros"), F.array_join("warnings", ",").alias("warning"))


@query(
    "decode_choices",
    """SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN c_mktsegment || ',' || c_name WHEN c_custkey % 4 = 1 THEN c_mktsegment
    WHEN c_custkey % 4 = 2 THEN '' ELSE c_mktsegment || ',' || c_name END AS many,
  CASE WHEN c_custkey % 3 = 0 THEN c_mktsegment WHEN c_custkey % 3 = 1 THEN c_name ELSE NULL END AS one FROM customer""",
)
def decode_choices(t: Tables) -> DataFrame:
    seg, name, d = F.col("c_mktsegment"), F.col("c_name"), F.lit(";#")
    many = pick("c_custkey", 4, F.concat(d, seg, d, name, d), F.concat(d, seg, d), F.lit("  "), F.concat(d, seg, d, d, name, d))
    one = pick("c_custkey", 3, F.concat(d, seg, d, name, d), name, F.lit(";#;#"))
    rows = wired(t.customer, "c_custkey", "MultiChoice", many).unionByName(wired(t.customer, "c_custkey", "Choice", one))
    out = decode.decode_fields(rows)
    return out.groupBy(F.col("item_id").alias("c_custkey")).agg(
        F.max(F.array_join("v_strings", ",")).alias("many"), F.max("v_string").alias("one")
    )


@query(
    "decode_lookup",
    """SELECT o_orderkey,
  CASE WHEN o_orderkey % 7 IN (0, 1, 3, 5) THEN o_custkey END AS id,
  CASE o_orderkey % 7 WHEN 0 THEN c_name WHEN 2 THEN c_name WHEN 3 THEN c_mktsegment || ';#' || c_name
    WHEN 4 THEN 'x;#' || c_name END AS label,
  CASE o_orderkey % 7 WHEN 2 THEN 'lookup_without_id' WHEN 3 THEN 'lookup_odd_tokens' ELSE '' END AS warning
FROM orders JOIN customer ON o_custkey = c_custkey""",
)
def decode_lookup(t: Tables) -> DataFrame:
    k, name, seg, d = F.col("o_custkey").cast("string"), F.col("c_name"), F.col("c_mktsegment"), F.lit(";#")
    # A value ending in the delimiter is an id alone, because the wrapping one is dropped.
    text = pick("o_orderkey", 7, F.concat(k, d, name), k, name, F.concat(k, d, seg, d, name), F.concat(F.lit("x;#"), name), F.concat(k, d), F.lit(""))
    out = decode.decode_fields(wired(order_rows(t), "o_orderkey", "Lookup", text))
    ref = F.get("v_refs", F.lit(0))
    return out.select(F.col("item_id").alias("o_orderkey"), ref["id"].alias("id"), ref["value"].alias("label"), F.array_join("warnings", ",").alias("warning"))


@query(
    "decode_lookup_multi",
    """SELECT l_returnflag, count(*) AS n, CAST(sum(CASE WHEN l_orderkey % 5 = 4 THEN 0 ELSE 2 END) AS BIGINT) AS refs,
  CAST(sum(CASE WHEN l_orderkey % 5 = 4 THEN 0 ELSE l_partkey + l_suppkey END) AS BIGINT) AS id_sum,
  count(*) FILTER (l_orderkey % 5 = 3) AS odd FROM lineitem GROUP BY l_returnflag""",
)
def decode_lookup_multi(t: Tables) -> DataFrame:
    p, s, d = F.col("l_partkey").cast("string"), F.col("l_suppkey").cast("string"), F.lit(";#")
    good = F.concat(p, d, F.lit("part"), d, s, d, F.lit("supplier"))
    text = pick("l_orderkey", 5, good, F.concat(d, good, d), good, F.concat(good, d, F.lit("9")), F.lit(""))
    rows = t.spread("lineitem").select("l_returnflag", F.lit("Refs").alias("field"), F.lit("LookupMulti").alias("wire_type"), text.alias("raw"))
    out = decode.decode_fields(rows)
    ids = F.aggregate("v_refs", F.lit(0).cast("bigint"), lambda a, r: a + r["id"])
    return out.groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.size("v_refs")).alias("refs"),
        F.sum(ids).alias("id_sum"),
        F.count_if(F.array_contains("warnings", "lookup_multi_odd_tokens")).alias("odd"),
    )


_TERM_SQL = "substr(md5(CAST(p_partkey AS VARCHAR)),1,8)||'-'||substr(md5(CAST(p_partkey AS VARCHAR)),9,4)||'-'||substr(md5(CAST(p_partkey AS VARCHAR)),13,4)||'-'||substr(md5(CAST(p_partkey AS VARCHAR)),17,4)||'-'||substr(md5(CAST(p_partkey AS VARCHAR)),21,12)"


@query(
    "decode_taxonomy",
    f"""SELECT p_partkey, p_partkey AS id,
  CASE p_partkey % 3 WHEN 0 THEN p_name WHEN 1 THEN p_name || '|' || p_brand ELSE p_brand || '|' || p_name END AS label,
  CASE WHEN p_partkey % 3 <> 1 THEN {_TERM_SQL} END AS term FROM part""",
)
def decode_taxonomy(t: Tables) -> DataFrame:
    h = F.md5(F.col("p_partkey").cast("string"))
    guid = F.upper(F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.substring(h, 13, 4), F.substring(h, 17, 4), F.substring(h, 21, 12)))
    bar, name, brand = F.lit("|"), F.col("p_name"), F.col("p_brand")
    label = pick("p_partkey", 3, F.concat(name, bar, guid), F.concat(name, bar, brand), F.concat(brand, bar, name, bar, guid))
    out = decode.decode_fields(wired(t.part, "p_partkey", "TaxonomyFieldType", F.concat(F.col("p_partkey").cast("string"), F.lit(";#"), label)))
    ref = F.get("v_refs", F.lit(0))
    return out.select(F.col("item_id").alias("p_partkey"), ref["id"].alias("id"), ref["value"].alias("label"), ref["term_guid"].alias("term"))


@query(
    "decode_taxonomy_multi",
    f"""SELECT p_partkey, 1 AS pos, p_partkey AS id, p_name AS label, {_TERM_SQL} AS term FROM part UNION ALL SELECT p_partkey, 2, p_partkey + 1, p_brand, NULL FROM part WHERE p_partkey % 2 = 0""",
)
def decode_taxonomy_multi(t: Tables) -> DataFrame:
    """A tagged term, and for every second part a plain one behind it."""
    h = F.md5(F.col("p_partkey").cast("string"))
    guid = F.upper(F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.substring(h, 13, 4), F.substring(h, 17, 4), F.substring(h, 21, 12)))
    first = F.concat(F.col("p_partkey").cast("string"), F.lit(";#"), F.col("p_name"), F.lit("|"), guid)
    second = F.concat(F.lit(";#"), (F.col("p_partkey") + 1).cast("string"), F.lit(";#"), F.col("p_brand"))
    text = F.when(F.col("p_partkey") % 2 == 0, F.concat(first, second)).otherwise(first)
    out = decode.decode_fields(wired(t.part, "p_partkey", "TaxonomyFieldTypeMulti", text))
    refs = out.select(F.col("item_id").alias("p_partkey"), F.posexplode("v_refs").alias("pos", "r"))
    return refs.select("p_partkey", (F.col("pos") + 1).alias("pos"), F.col("r.id").alias("id"), F.col("r.value").alias("label"), F.col("r.term_guid").alias("term"))


@query(
    "decode_url",
    """SELECT page_id, CASE WHEN page_id % 4 <> 3 THEN url END AS url,
  CASE page_id % 4 WHEN 0 THEN 'see, also ' || page_id END AS description FROM pages""",
)
def decode_url(t: Tables) -> DataFrame:
    u = F.col("url")
    text = pick("page_id", 4, F.concat(u, F.lit(", see, also "), F.col("page_id").cast("string")), F.concat(F.lit(" "), u), F.concat(u, F.lit(",  ")), F.lit(" "))
    out = decode.decode_fields(wired(t.pages, "page_id", "URL", text))
    return out.select(F.col("item_id").alias("page_id"), F.col("v_url.url").alias("url"), F.col("v_url.description").alias("description"))


@query(
    "decode_calculated",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 7 IN (0, 6) THEN CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) END AS v_double,
  CASE WHEN o_orderkey % 7 = 1 THEN o_custkey END AS v_bigint,
  CASE WHEN o_orderkey % 7 = 2 THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS v_ts,
  CASE WHEN o_orderkey % 7 = 3 THEN o_orderkey % 2 = 0 END AS v_bool,
  CASE o_orderkey % 7 WHEN 4 THEN o_orderpriority || ';#x' WHEN 5 THEN o_orderstatus END AS v_string,
  CASE WHEN o_orderkey % 7 = 5 THEN 'calculated_unknown_prefix' ELSE '' END AS warning FROM orders""",
)
def decode_calculated(t: Tables) -> DataFrame:
    k = F.col("o_orderkey")
    text = pick(
        k, 7, F.concat(F.lit("Float;#"), money("o_totalprice")), F.concat(F.lit("integer;#"), F.col("o_custkey").cast("string")),
        F.concat(F.lit("datetime;#"), F.date_format(F.col("o_orderdate").cast("timestamp"), TS)),
        F.concat(F.lit("bool;#"), F.when(k % 2 == 0, F.lit("1")).otherwise(F.lit("0"))),
        F.concat(F.lit("string;#"), F.col("o_orderpriority"), F.lit(";#x")), F.concat(F.lit("colour;#"), F.col("o_orderstatus")), money("o_totalprice"),
    )
    out = decode.decode_fields(wired(t.orders, "o_orderkey", "Calculated", text, result_type="Number"))
    return out.select(
        F.col("item_id").alias("o_orderkey"), "v_double", "v_bigint", F.date_format("v_ts", TS).alias("v_ts"), "v_bool", "v_string",
        F.array_join("warnings", ",").alias("warning"),
    )


@query(
    "decode_attachment_flag",
    """SELECT event_id, CASE event_id % 5 WHEN 0 THEN false WHEN 1 THEN true WHEN 2 THEN false WHEN 3 THEN true END AS v FROM events""",
)
def decode_attachment_flag(t: Tables) -> DataFrame:
    text = pick("event_id", 5, F.lit("0"), F.lit(" 1"), F.lit(""), F.concat(F.lit("http://farm/"), F.col("event_type")), F.lit(None).cast("string"))
    out = decode.decode_fields(wired(t.events, "event_id", "Attachments", text))
    return out.select(F.col("item_id").alias("event_id"), F.col("v_bool").alias("v"))


@query(
    "decode_by_name",
    """SELECT page_id, CASE WHEN page_id % 3 < 2 THEN CAST(page_id % 2 AS BIGINT) END AS folder,
  CASE page_id % 3 WHEN 0 THEN url || '|http://farm/x' WHEN 1 THEN url ELSE '' END AS urls FROM pages""",
)
def decode_by_name(t: Tables) -> DataFrame:
    bit = F.pmod("page_id", F.lit(2)).cast("string")
    folder = pick("page_id", 3, F.concat(F.lit("7;#"), bit), bit, F.lit("7;#none"))
    urls = pick("page_id", 3, F.concat(F.lit(";#"), F.col("url"), F.lit(";# ;#http://farm/x ;#")), F.col("url"), F.lit(""))
    rows = wired(t.pages, "page_id", "Integer", folder, field="FSObjType").unionByName(wired(t.pages, "page_id", "Text", urls, field="AttachmentUrls"))
    out = decode.decode_fields(rows)
    return out.groupBy(F.col("item_id").alias("page_id")).agg(F.max("v_bigint").alias("folder"), F.max(F.array_join("v_strings", "|")).alias("urls"))


@query(
    "decode_items",
    """WITH o AS (SELECT *, '{' || c_mktsegment || '}' AS list_guid FROM orders JOIN customer ON o_custkey = c_custkey),
f AS (
  SELECT list_guid, 'Total' AS field, 'Currency' AS wire_type, count(*) AS n, count(*) FILTER (o_orderkey % 17 <> 0) AS filled,
    count(*) FILTER (o_orderkey % 17 = 0) AS warned FROM o GROUP BY list_guid
  UNION ALL SELECT list_guid, 'Opened', 'DateTime', count(*), count(*) FILTER (o_orderkey % 19 <> 0), count(*) FILTER (o_orderkey % 19 = 0) FROM o GROUP BY list_guid
  UNION ALL SELECT list_guid, 'Estimate', 'Calculated', count(*), count(*), count(*) FILTER (o_orderkey % 23 = 0) FROM o GROUP BY list_guid
  UNION ALL SELECT list_guid, 'ID', 'Counter', count(*) FILTER (o_orderkey % 101 <> 3), count(*) FILTER (o_orderkey % 101 <> 3 AND o_orderkey % 50 <> 7), count(*) FILTER (o_orderkey % 101 <> 3 AND o_orderkey % 50 = 7) FROM o GROUP BY list_guid
  UNION ALL SELECT list_guid, p.field, p.wire_type, count(*), count(*), 0 FROM o, (VALUES ('Title','Text'),('Customer','Lookup'),('Status','MultiChoice'),
    ('Priority','Choice'),('Closed','Boolean'),('FSObjType','Integer'),('ContentType','Text'),('Created','DateTime'),('Modified','DateTime'),
    ('FileRef','Lookup'),('FileLeafRef','Lookup'),('EncodedAbsUrl','Text'),('Attachments','Attachments'),('AttachmentUrls','Text')) AS p(field, wire_type) GROUP BY ALL)
SELECT * FROM f""",
)
def decode_items(t: Tables) -> DataFrame:
    out = decode.decode_items(raw_orders(t), order_fields(t))
    filled = (
        F.col("v_string").isNotNull() | F.col("v_double").isNotNull() | F.col("v_bigint").isNotNull() | F.col("v_bool").isNotNull()
        | F.col("v_ts").isNotNull() | F.col("v_refs").isNotNull() | F.col("v_strings").isNotNull() | F.col("v_url").isNotNull()
    )
    return out.groupBy("list_guid", "field", "wire_type").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(filled).alias("filled"), F.count_if(F.size("warnings") > 0).alias("warned")
    )


@query(
    "decode_warnings",
    """WITH o AS (SELECT *, '{' || c_mktsegment || '}' AS list_guid FROM orders JOIN customer ON o_custkey = c_custkey)
SELECT list_guid, 'number_unparseable' AS event, count(*) AS n FROM o WHERE o_orderkey % 17 = 0 GROUP BY 1
UNION ALL SELECT list_guid, 'datetime_unparseable', count(*) FROM o WHERE o_orderkey % 19 = 0 GROUP BY 1
UNION ALL SELECT list_guid, 'calculated_unknown_prefix', count(*) FROM o WHERE o_orderkey % 23 = 0 GROUP BY 1
UNION ALL SELECT list_guid, 'int_unparseable', count(*) FROM o WHERE o_orderkey % 50 = 7 AND o_orderkey % 101 <> 3 GROUP BY 1""",
)
def decode_warnings(t: Tables) -> DataFrame:
    return decode.count_warnings(decode.decode_items(raw_orders(t), order_fields(t)))


@query(
    "feed_instant",
    """SELECT event_id, CASE event_id % 5 WHEN 4 THEN NULL
  WHEN 1 THEN strftime(date_trunc('second', ts) - INTERVAL 90 MINUTE, '%Y-%m-%d %H:%M:%S')
  WHEN 2 THEN strftime(date_trunc('second', ts) + INTERVAL 90 MINUTE, '%Y-%m-%d %H:%M:%S')
  ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS v FROM events""",
)
def feed_instant(t: Tables) -> DataFrame:
    ms = F.unix_millis(F.col("ts").cast("timestamp")).cast("string")
    text = pick(
        "event_id", 5, F.concat(F.lit("/Date("), ms, F.lit(")/")), F.concat(F.lit("/Date("), ms, F.lit("+0130)/")),
        F.concat(F.lit("/Date("), ms, F.lit("-0130)/")), F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss"), F.lit("/Date(soon)/"),
    )
    return t.events.select("event_id", F.date_format(wire.feed_instant(text), TS).alias("v"))


@query(
    "verify_datetimes",
    """SELECT '{' || c_mktsegment || '}' AS list_guid, o_orderkey AS item_id, p.field, p.display_name,
  CASE WHEN p.field = 'Opened' AND o_orderkey % 19 = 0 THEN 'someday' ELSE strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') END AS raw_wire_value,
  CASE WHEN p.field = 'Opened' AND o_orderkey % 19 = 0 THEN NULL ELSE strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') END AS decoded_utc,
  CASE WHEN length(c_mktsegment) > 8 THEN 'http://farm/sites/x/' || lower(c_mktsegment) || CASE WHEN length(c_mktsegment) % 2 = 1 THEN '/Forms' ELSE '' END
       ELSE 'http://farm/sites/x/Lists/' || c_mktsegment || '%20a' END || '/DispForm.aspx?ID=' || o_orderkey AS display_url
FROM orders JOIN customer ON o_custkey = c_custkey,
  (VALUES ('Opened', 'Eröffnet'), ('Created', 'Created'), ('Modified', 'Modified')) AS p(field, display_name)""",
)
def verify_datetimes(t: Tables) -> DataFrame:
    raw, fields = raw_orders(t), order_fields(t)
    return decode.verify_datetimes(decode.decode_items(raw, fields), fields, segment_lists(t))


@query("instant_to_json", "SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS v FROM events")
def instant_to_json(t: Tables) -> DataFrame:
    return t.events.select("event_id", wire.instant_to_json(F.col("ts").cast("timestamp")).alias("v"))


def _feed_entities(t: Tables) -> DataFrame:
    """Orders as feed entities: German property names, a scalar id beside each lookup."""
    k = F.col("o_orderkey")
    label = F.when(k % 2 == 0, F.to_json(F.named_struct(F.lit("Id"), F.col("o_custkey"), F.lit("Title"), F.col("c_name"))))
    body = F.concat(
        F.lit('{"Id":'), k.cast("string"), F.lit(',"Titel":"Order '), k.cast("string"), F.lit('","KundeId":'), F.col("o_custkey").cast("string"),
        F.lit(',"Kunde":'), F.coalesce(label, F.lit('{"__deferred":{"uri":"x"}}')),
        F.lit(',"Summe":"'), F.col("o_totalprice").cast("decimal(18,2)").cast("string"), F.lit('","Eröffnet":"/Date('),
        F.unix_millis(F.col("o_orderdate").cast("timestamp")).cast("string"), F.lit(')/","Status":{"results":["'), F.col("o_orderstatus"), F.lit('","z"]},'),
        F.lit('"Fremd":true,"Erledigt":'), (k % 2 == 0).cast("string"), F.lit(',"Priorität":null,"__metadata":{"etag":"1"}}'),
    )
    guid = F.concat(F.lit("{"), F.col("c_mktsegment"), F.lit("}"))
    rows = t.spread("orders").join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    return rows.select(guid.alias("list_guid"), k.alias("item_id"), F.parse_json(body).alias("row"))


@query(
    "map_feed_rows",
    """WITH o AS (SELECT *, o_orderkey AS item_id FROM orders JOIN customer ON o_custkey = c_custkey)
SELECT item_id, 'Customer' AS field, true AS mapped, CAST(o_custkey AS VARCHAR) || ':' || CASE WHEN o_orderkey % 2 = 0 THEN c_name ELSE '' END AS v FROM o
UNION ALL SELECT item_id, 'Title', true, 'Order ' || o_orderkey FROM o
UNION ALL SELECT item_id, 'Total', true, CAST(CAST(CAST(o_totalprice AS DECIMAL(18,2)) * 100 AS BIGINT) AS VARCHAR) FROM o
UNION ALL SELECT item_id, 'Opened', true, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') FROM o
UNION ALL SELECT item_id, 'Status', true, o_orderstatus || ',z' FROM o
UNION ALL SELECT item_id, 'Closed', true, CASE WHEN o_orderkey % 2 = 0 THEN 'true' ELSE 'false' END FROM o
UNION ALL SELECT item_id, 'Priority', true, NULL FROM o
UNION ALL SELECT item_id, 'Fremd', false, 'true' FROM o
UNION ALL SELECT item_id, 'Id', true, CAST(item_id AS VARCHAR) FROM o
UNION ALL SELECT item_id, 'ID', true, CAST(item_id AS VARCHAR) FROM o""",
)
def map_feed_rows(t: Tables) -> DataFrame:
    out = odata.map_odata_rows(_feed_entities(t), order_fields(t))
    ref = F.get("v_refs", F.lit(0))
    text = F.coalesce(
        "v_string", (F.col("v_double").cast("decimal(18,2)") * 100).cast("bigint").cast("string"), F.col("v_bigint").cast("string"),
        F.col("v_bool").cast("string"), wire.instant_to_json(F.col("v_ts")), F.array_join("v_strings", ","),
        F.when(ref.isNotNull(), F.concat(ref["id"].cast("string"), F.lit(":"), F.coalesce(ref["value"], F.lit("")))),
    )
    return out.select("item_id", "field", "mapped", text.alias("v"))


@query(
    "harmonise_columns",
    """SELECT event_id, CAST(event_id AS VARCHAR) AS key, CASE WHEN event_id % 4 < 3 THEN strftime(ts, '%Y-%m-%d') END AS created,
  CAST(CAST(json_extract_string(props, '$.k') AS BIGINT) AS VARCHAR) AS k FROM events""",
)
def harmonise_columns(t: Tables) -> DataFrame:
    spelling = pick("event_id", 4, F.lit("Id,Created"), F.lit("ID,Erstellt"), F.lit("id,created"), F.lit("iD,Other"))
    key, day = F.split(spelling, ",", -1)[0], F.split(spelling, ",", -1)[1]
    body = F.concat(
        F.lit('{"'), key, F.lit('":'), F.col("event_id").cast("string"), F.lit(',"'), day, F.lit('":"'),
        F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd"), F.lit('","k":'), F.get_json_object("props", "$.k"), F.lit("}"),
    )
    pages = t.events.select("event_id", F.parse_json(body).alias("row"))
    return odata.harmonise_columns(pages, {"key": ["Id", "ID"], "created": ["Created", "Erstellt"], "k": ["k"]})


@query(
    "item_ids",
    """SELECT count(*) AS n, count(*) FILTER (o_orderkey % 101 <> 3) AS kept, count(*) FILTER (o_orderkey % 101 = 3) AS dropped,
  CAST(sum(CASE WHEN o_orderkey % 101 <> 3 THEN o_orderkey END) AS BIGINT) AS id_sum FROM orders""",
)
def item_ids(t: Tables) -> DataFrame:
    ids = wire.item_id(F.col("raw"))
    return raw_orders(t).agg(
        F.count(F.lit(1)).alias("n"), F.count(ids).alias("kept"), F.count_if(ids.isNull()).alias("dropped"), F.sum(ids).alias("id_sum")
    )


@query(
    "strip_wire_prefix",
    "SELECT o_orderkey AS item_id, CASE WHEN o_orderkey % 101 = 3 THEN 17 ELSE 18 END AS n, 'Order ' || o_orderkey AS title FROM orders",
)
def strip_wire_prefix(t: Tables) -> DataFrame:
    out = raw_orders(t).select("item_id", wire.strip_wire_prefix(F.col("raw")).alias("raw"))
    return out.select("item_id", F.size("raw").alias("n"), F.try_element_at("raw", F.lit("Title")).alias("title"))


@query(
    "explode_fields",
    """SELECT o_orderkey AS item_id, p.field, p.wire_type, CASE p.field WHEN 'Estimate' THEN 'Number' END AS result_type FROM orders,
(VALUES ('ID', 'Counter'), ('Title', 'Text'), ('Customer', 'Lookup'), ('Total', 'Currency'), ('Opened', 'DateTime'), ('Status', 'MultiChoice'), ('Priority', 'Choice'), ('Estimate', 'Calculated'),
 ('Closed', 'Boolean'), ('FSObjType', 'Integer'), ('ContentType', 'Text'), ('Created', 'DateTime'), ('Modified', 'DateTime'), ('FileRef', 'Lookup'), ('FileLeafRef', 'Lookup'), ('EncodedAbsUrl', 'Text'),
 ('Attachments', 'Attachments'), ('AttachmentUrls', 'Text')) AS p(field, wire_type) WHERE NOT (p.field = 'ID' AND o_orderkey % 101 = 3)""",
)
def explode_fields(t: Tables) -> DataFrame:
    return decode.explode_fields(raw_orders(t), order_fields(t)).select("item_id", "field", "wire_type", "result_type")


@query(
    "project_view_fields",
    """SELECT o_orderkey AS item_id, 'Order ' || o_orderkey AS "Title", o_custkey || ';#' || c_name AS "Customer", o_orderpriority AS "Priority",
  CAST(NULL AS VARCHAR) AS "Parent", CAST(NULL AS VARCHAR) AS "Author", CAST(CASE WHEN o_orderkey % 3 = 0 THEN '1' ELSE '0' END AS VARCHAR) AS "Attachments",
  CAST(24 AS INTEGER) AS n_columns, '{' || c_mktsegment || '}' AS list_guid
FROM orders JOIN customer ON o_custkey = c_custkey""",
)
def project_view_fields(t: Tables) -> DataFrame:
    """Every list by its own columns; the results are put together by those that all have."""
    raw, fields = raw_orders(t), order_fields(t)
    shown = ["list_guid", "item_id", "Title", "Customer", "Priority", "Parent", "Author", "Attachments"]
    wide = [decode.project_view_fields(raw, fields, r["list_guid"]) for r in fields.select("list_guid").distinct().collect()]  # one row a list
    parts = [w.select(*shown, F.lit(len(w.columns) - 1).alias("n_columns")) for w in wide]
    empty = raw.limit(0).select("list_guid", "item_id", *[F.lit(None).cast("string").alias(c) for c in shown[2:]], F.lit(0).alias("n_columns"))
    return reduce(DataFrame.unionByName, parts, empty)


@query(
    "escaped_names",
    """SELECT p_partkey, p_name || ' ü' AS plain,
  replace(regexp_replace(p_name, '[^a-z0-9 ]', '?', 'g'), ' ', '_x0020_') || '_x0020__x00fc_' AS escaped FROM part""",
)
def escaped_names(t: Tables) -> DataFrame:
    rows = t.part.select("p_partkey", F.concat("p_name", F.lit(" ü")).alias("field"))
    escaped = decode.rename_fields(rows, "escape").select("p_partkey", F.col("field").alias("escaped"), "field")
    return decode.rename_fields(escaped, "unescape").select("p_partkey", F.col("field").alias("plain"), "escaped")


@query(
    "build_items",
    """WITH o AS (SELECT *, 'http://farm/sites/' || lower(c_mktsegment) AS web_url FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderkey % 101 <> 3),
h AS (SELECT *, sha1(unhex('6ba7b8119dad11d180b400c04fd430c8') || encode(web_url)) AS s FROM o),
w AS (SELECT *, substr(s,1,8)||'-'||substr(s,9,4)||'-5'||substr(s,14,3)||'-'||
  CASE substr(s,17,1) WHEN '0' THEN '8' WHEN '1' THEN '9' WHEN '2' THEN 'a' WHEN '3' THEN 'b' WHEN '4' THEN '8' WHEN '5' THEN '9' WHEN '6' THEN 'a' WHEN '7' THEN 'b'
   WHEN '8' THEN '8' WHEN '9' THEN '9' WHEN 'a' THEN 'a' WHEN 'b' THEN 'b' WHEN 'c' THEN '8' WHEN 'd' THEN '9' WHEN 'e' THEN 'a' ELSE 'b' END
  ||substr(s,18,3)||'-'||substr(s,21,12) AS web_id FROM h)
SELECT web_id || ':{' || c_mktsegment || '}:' || o_orderkey AS doc_id, c_mktsegment AS list_title, o_orderkey AS item_id,
  CASE WHEN length(c_mktsegment) > 8 THEN 'http://farm/sites/x/' || lower(c_mktsegment) || CASE WHEN length(c_mktsegment) % 2 = 1 THEN '/Forms' ELSE '' END
       ELSE 'http://farm/sites/x/Lists/' || c_mktsegment || '%20a' END || '/DispForm.aspx?ID=' || o_orderkey AS display_url,
  'Order' AS content_type, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS created, o_orderkey % 40 = 0 AS is_folder,
  'sites/x/Lists/Orders/' || o_orderkey || '_.000' AS file_ref, o_orderkey || '_.000' AS file_name FROM w""",
)
def build_items(t: Tables) -> DataFrame:
    out = scope.build_items(raw_orders(t), segment_lists(t))
    return out.select("doc_id", "list_title", "item_id", "display_url", "content_type", "created", "is_folder", "file_ref", "file_name")


@query(
    "display_url",
    f"""WITH {NATION_LISTS_SQL} SELECT l.guid, 'http://farm' || replace(regexp_extract(web_url, '^http://farm(.*)$', 1), ' ', '%20') || '/Lists/' || regexp_extract(guid, '-(.*)}}', 1) ||
  CASE WHEN base_type = '1' THEN '/Forms' ELSE '' END || '/DispForm.aspx?ID=' || item_count AS url FROM nation_lists l""",
)
def display_url(t: Tables) -> DataFrame:
    return nation_lists(t).select(
        "guid",
        names.display_url(F.col("web_url"), F.col("default_view_url"), F.col("root_folder"), F.col("base_type") == "1", F.col("item_count")).alias("url"),
    )


@query(
    "harmonise_tables",
    """SELECT c_custkey AS key, CAST(c_nationkey AS BIGINT) AS place, c_name AS name, NULL AS region FROM customer UNION ALL SELECT s_suppkey, s_nationkey, s_name, NULL FROM supplier
UNION ALL SELECT n_nationkey, NULL, n_name, n_regionkey FROM nation""",
)
def harmonise_tables(t: Tables) -> DataFrame:
    """Three tables that spell the same columns differently; one of them has a column of its own."""
    customers = t.customer.select(F.col("c_custkey").alias("Id"), F.col("c_nationkey").cast("bigint").alias("Ort"), "c_name").withColumnRenamed("c_name", "Titel")
    suppliers = t.supplier.select(F.col("s_suppkey").alias("ID"), F.col("s_nationkey").cast("bigint").alias("place"), F.col("s_name").alias("title"))
    nations = t.nation.select(F.col("n_nationkey").cast("bigint").alias("id"), F.col("n_name").alias("Title"), F.col("n_regionkey").cast("bigint").alias("region"))
    return odata.harmonise_tables([customers, suppliers, nations], {"key": ["Id", "ID"], "place": ["Place", "Ort"], "name": ["Title", "Titel"]})
