"""Bulk decode of raw rows: one narrow pass from wire text to typed columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed, names, wire
from ..scale import broadcast_if_small

ITEM_FIELD_COLUMNS = [
    "v_string",
    "v_double",
    "v_bigint",
    "v_bool",
    "v_ts",
    "v_refs",
    "v_strings",
    "v_url",
    "warnings",
]


def _system_type(field: Column) -> Column:
    known = F.create_map(*[F.lit(x) for pair in fixed.SYSTEM_FIELD_TYPES.items() for x in pair])
    return F.coalesce(F.try_element_at(known, field), F.lit("Text"))


def explode_fields(raw_items: DataFrame, list_fields: DataFrame) -> DataFrame:
    """One row per (item, field) with its declared type.

    The type comes from the list schema, else from the system columns, else Text.
    The schema side is broadcast after a size check; otherwise the join shuffles.
    """
    carried = [c for c in raw_items.columns if c != "raw"]
    n = len(fixed.WIRE_PREFIX)
    rows = (
        # The outer form, because the plain one makes the optimizer test the size of the
        # map first and so compute it twice; the filter drops what an empty map gives.
        raw_items.select(*carried, F.explode_outer("raw").alias("attribute", "raw"))
        .filter(F.col("attribute").startswith(fixed.WIRE_PREFIX))
        .withColumn("field", F.substr("attribute", F.lit(n + 1)))
        .filter(F.col("field") != fixed.PROPERTY_BAG)
        .drop("attribute")
    )
    declared = list_fields.select(
        "list_guid", F.col("name").alias("field"), F.col("type").alias("_type"), "result_type"
    )
    joined = rows.join(broadcast_if_small(declared), ["list_guid", "field"], "left")
    return joined.select(
        *carried,
        "field",
        F.coalesce("_type", _system_type(F.col("field"))).alias("wire_type"),
        "result_type",
        "raw",
    )


def _rule(wire_type: Column, field: Column, raw: Column, result_type: Column) -> Column:
    """Which decode rule a value takes; two columns go by name, the rest by type.

    Kept small on purpose: every slot and every pushed-down filter repeats it.
    """
    calculated = F.coalesce(wire.calculated_rule(raw, result_type), F.lit("unknown"))
    return (
        F.when(field == "FSObjType", "folder")
        .when(field == "AttachmentUrls", "urls")
        .when(wire_type == "Calculated", F.when(wire.is_blank(raw), "blank").otherwise(calculated))
        .otherwise(wire.declared_rule(wire_type))
    )


def _warning(rule: Column, text: Column, plain: Column, parts: Column) -> Column:
    bad = F.when((rule == "number") & F.col("v_double").isNull(), "number_unparseable")
    bad = bad.when((rule == "integer") & F.col("v_bigint").isNull(), "int_unparseable")
    bad = bad.when((rule == "boolean") & F.col("v_bool").isNull(), "boolean_unparseable")
    bad = bad.when((rule == "datetime") & F.col("v_ts").isNull(), "datetime_unparseable")
    delim = F.instr(plain, fixed.DELIM)
    no_id = (plain != "") & (delim == 0) & F.get("v_refs", F.lit(0))["id"].isNull()
    odd = F.instr(F.substr(plain, delim + len(fixed.DELIM)), fixed.DELIM) > 0
    bad = bad.when(
        rule.isin("lookup", "taxonomy"),
        F.when(no_id, "lookup_without_id").when((delim > 0) & odd, "lookup_odd_tokens"),
    )
    bad = bad.when(rule.isin("lookup_multi", "taxonomy_multi") & (F.size(parts) % 2 == 1), "lookup_multi_odd_tokens")
    return F.when(rule == "unknown", "calculated_unknown_prefix").when(text != "", bad)


_VERBATIM = ["text", "choice", "url", "flag", "unknown", "blank"]
_LISTED = ["lookup_multi", "taxonomy_multi", "multi_choice", "urls"]


def decode_fields(exploded: DataFrame) -> DataFrame:
    """Typed slots for every (item, field); reads wire_type, field, raw and result_type.

    One narrow pass without a shuffle. Rule, text and unwrapped text come out of
    one-row generators first: slots then refer to plain columns, where the optimizer
    would otherwise copy those expressions into every slot and pushed-down filter.
    """
    carried = [c for c in exploded.columns if c != "result_type"]
    raw = F.col("raw")
    result_type = F.col("result_type") if "result_type" in exploded.columns else F.lit(None).cast("string")
    body = F.when(F.col("wire_type") == "Calculated", wire.calculated_body(raw)).otherwise(raw)
    head = F.struct(_rule(F.col("wire_type"), F.col("field"), raw, result_type).alias("_rule"), body.alias("_body"))
    staged = exploded.select(*carried, F.inline(F.array(head)))
    rule, body = F.col("_rule"), F.col("_body")
    staged = staged.select("*", F.when(~rule.isin(_VERBATIM), wire.strip(body)).alias("_text"))
    text = F.col("_text")
    cut = F.struct(F.when(rule.isin(*_LISTED, "lookup", "taxonomy", "folder"), wire.unwrap(text)).alias("_plain"))
    staged = staged.select("*", F.inline(F.array(cut)))
    plain, parts = F.col("_plain"), F.col("_parts")
    staged = staged.select("*", F.when(rule.isin(_LISTED) & plain.isNotNull(), wire.tokens_from(plain)).alias("_parts"))
    single = wire.lookup_from(plain)
    slots = {
        "v_string": F.when(rule.isin("text", "unknown"), body).when(rule == "choice", wire.choice(body)),
        "v_double": F.when(rule == "number", wire.number_from(text)),
        "v_bigint": F.when(rule == "integer", wire.integer_from(text)).when(
            rule == "folder", wire.folder_flag_from(plain).cast("bigint")
        ),
        "v_bool": F.when(rule == "boolean", wire.boolean_from(text)).when(rule == "flag", wire.attachment_flag(body)),
        "v_ts": F.when(rule == "datetime", wire.instant_from(text)),
        "v_refs": F.when((rule == "lookup") & (plain != ""), F.array(single))
        .when((rule == "taxonomy") & (plain != ""), F.array(wire.with_term(single)))
        .when((rule == "lookup_multi") & parts.isNotNull(), wire.lookup_multi_from(parts))
        .when(
            (rule == "taxonomy_multi") & parts.isNotNull(),
            F.transform(wire.lookup_multi_from(parts), wire.with_term),
        ),
        "v_strings": F.when(rule == "multi_choice", F.array_remove(parts, "")).when(
            rule == "urls", F.filter(F.transform(parts, wire.strip), lambda u: u != "")
        ),
        "v_url": F.when(rule == "url", wire.link(body)),
    }
    decoded = staged.select(
        *carried, "_rule", "_text", "_plain", "_parts", *[c.alias(k) for k, c in slots.items()]
    )
    code = _warning(rule, text, plain, parts)
    return decoded.select(*carried, *slots, F.array_compact(F.array(code)).alias("warnings"))


def decode_items(raw_items: DataFrame, list_fields: DataFrame) -> DataFrame:
    """Raw rows to the long typed table."""
    return decode_fields(explode_fields(raw_items, list_fields))


def decode_warnings(item_fields: DataFrame) -> DataFrame:
    """One row per warning with where it came from and the value that caused it."""
    place = [c for c in ("list_guid", "web_url", "item_id", "field") if c in item_fields.columns]
    return item_fields.select(F.explode("warnings").alias("event"), *place, "raw")


def count_warnings(item_fields: DataFrame) -> DataFrame:
    return decode_warnings(item_fields).groupBy("list_guid", "event").agg(F.count(F.lit(1)).alias("n"))


def split_by_item_id(raw_items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows with a usable item id, and the rows dropped for want of one."""
    read = raw_items.withColumn("item_id", wire.item_id(F.col("raw")))
    kept = read.filter(F.col("item_id").isNotNull())
    dropped = read.filter(F.col("item_id").isNull()).withColumn("event", F.lit("row_without_id"))
    return kept, dropped


def value_variant(item_fields: DataFrame) -> DataFrame:
    """Add ``value``: the decoded value in its contract shape, as a variant."""
    many = F.col("wire_type").isin(fixed.LOOKUP_MULTI_TYPES + fixed.TAXONOMY_MULTI_TYPES)
    term = F.col("wire_type").isin(fixed.TAXONOMY_TYPES + fixed.TAXONOMY_MULTI_TYPES)

    def plain(r: Column) -> Column:
        return F.struct(r["id"].alias("id"), r["value"].alias("value"))

    def as_variant(c: Column) -> Column:
        return F.parse_json(F.to_json(c, {"ignoreNullFields": "false"}))

    refs = F.col("v_refs")
    plain_refs = F.transform(refs, plain)
    ref_value = (
        F.when(many & term, as_variant(refs))
        .when(many, as_variant(plain_refs))
        .when(term, as_variant(F.get(refs, F.lit(0))))
        .otherwise(as_variant(F.get(plain_refs, F.lit(0))))
    )
    value = F.coalesce(
        F.col("v_string").cast("variant"),
        F.col("v_double").cast("variant"),
        F.col("v_bigint").cast("variant"),
        F.col("v_bool").cast("variant"),
        wire.instant_to_json(F.col("v_ts")).cast("variant"),
        F.when(refs.isNotNull(), ref_value),
        F.when(F.col("v_strings").isNotNull(), as_variant(F.col("v_strings"))),
        F.when(F.col("v_url").isNotNull(), as_variant(F.col("v_url"))),
    )
    return item_fields.withColumn("value", value)


def verify_datetimes(item_fields: DataFrame, list_fields: DataFrame, lists: DataFrame) -> DataFrame:
    """Wire text beside the decoded instant for every date column of every item, with a link to the item.

    Column names and links come from the lists' own small tables: the fields are not shuffled.
    """
    dated = item_fields.filter(
        (F.col("wire_type").isin(fixed.DATETIME_TYPES) | F.col("field").isin("Created", "Modified"))
        & F.col("raw").isNotNull()
    )
    shown = list_fields.select("list_guid", F.col("name").alias("field"), "display_name")
    form = names.display_form(F.col("web_url"), F.col("default_view_url"), F.col("root_folder"), F.col("base_type") == "1")
    forms = lists.select(F.col("guid").alias("list_guid"), form.alias("_form"))
    return (
        dated.join(broadcast_if_small(shown), ["list_guid", "field"], "left")
        .join(broadcast_if_small(forms), "list_guid", "left")
        .select(
            "list_guid",
            "item_id",
            "field",
            F.coalesce("display_name", "field").alias("display_name"),
            F.col("raw").alias("raw_wire_value"),
            wire.instant_to_json(F.col("v_ts")).alias("decoded_utc"),
            F.concat("_form", F.col("item_id").cast("string")).alias("display_url"),
        )
    )


def project_view_fields(raw_items: DataFrame, list_fields: DataFrame, list_guid: str) -> DataFrame:
    """Wide rows of one list: its schema columns in order, then the system columns.

    Only the column names of that one list come to the driver, to build the projection.
    """
    raw_items = raw_items.filter(F.col("list_guid") == list_guid)
    own = list_fields.filter(F.col("list_guid") == list_guid)
    listed = [
        r["name"]
        for r in own.filter(F.coalesce(F.col("name"), F.lit("")) != "").orderBy("pos").select("name").collect()
    ]
    wanted = list(dict.fromkeys(n for n in listed + fixed.ALWAYS_PROJECTED if n != fixed.PROPERTY_BAG))
    return raw_items.select(
        "list_guid",
        "item_id",
        *[F.try_element_at("raw", F.lit(fixed.WIRE_PREFIX + n)).alias(n) for n in wanted],
    )


def rename_fields(df: DataFrame, mode: str, column: str = "field") -> DataFrame:
    """Unescape or escape the names held in ``column``."""
    change = {"unescape": names.unescape_name, "escape": names.escape_name}[mode]
    return df.withColumn(column, change(F.col(column)))
