"""Readers for captured XML pages, JSON and Atom feeds, schemas and inventories.

All readers pass explicit all-text schemas: inference would turn text numbers
into numbers. A page is one element of bounded size, so rows are split per page.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import fixed, names, wire

RAW = "map<string,string>"


def _text_struct(columns: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def _xml(spark: SparkSession, row_tag: str, schema: T.StructType):
    return (
        spark.read.format("xml")
        .option("rowTag", row_tag)
        .option("ignoreSurroundingSpaces", "false")
        .schema(schema)
    )


def _attributes(columns: Sequence[str]) -> list[str]:
    return [f"_{fixed.WIRE_PREFIX}{c}" for c in columns]


def _as_map(row: Column, columns: Sequence[str]) -> Column:
    """Attributes of one row as a map, absent ones left out."""
    keys = F.array(*[F.lit(fixed.WIRE_PREFIX + c) for c in columns])
    values = F.array(*[row[a] for a in _attributes(columns)])
    return F.map_filter(F.map_from_arrays(keys, values), lambda _k, v: v.isNotNull())


def _page_no() -> Column:
    """Page number: the last number in the file name."""
    name = F.substring_index(F.col("path"), "/", -1)
    return F.regexp_extract(name, r"^.*?(\d+)\D*$", 1).try_cast("bigint")


def rowset_schema(columns: Sequence[str]) -> T.StructType:
    return T.StructType(
        [
            T.StructField("_ItemCount", T.StringType()),
            T.StructField("_ListItemCollectionPositionNext", T.StringType()),
            T.StructField("z:row", T.ArrayType(_text_struct(_attributes(columns)))),
        ]
    )


def rowset_pages(captured: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Shape captured rowset elements as pages with their rows as maps."""
    rows = F.transform(F.col("z:row"), lambda r: _as_map(r, columns))
    return captured.select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_ItemCount").try_cast("bigint").alias("item_count"),
        F.col("_ListItemCollectionPositionNext").alias("position_next"),
        F.coalesce(rows, F.array().cast(f"array<{RAW}>")).alias("rows"),
    )


def read_rowset_pages(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """Captured item pages: one row per page with count, continuation and rows."""
    return rowset_pages(_xml(spark, "rs:data", rowset_schema(columns)).load(path), columns)


def page_rows(pages: DataFrame) -> DataFrame:
    """One raw row per item of every page, with its id and page position."""
    return pages.select("path", F.posexplode("rows").alias("pos", "raw")).withColumn("item_id", wire.item_id(F.col("raw")))


def change_schema(columns: Sequence[str]) -> T.StructType:
    change_id = T.StructType([T.StructField("_VALUE", T.StringType()), T.StructField("_ChangeType", T.StringType())])
    changes = T.StructType(
        [
            T.StructField("_LastChangeToken", T.StringType()),
            T.StructField("_MoreChanges", T.StringType()),
            T.StructField("Id", T.ArrayType(change_id)),
        ]
    )
    return T.StructType([T.StructField("Changes", changes), T.StructField("rs:data", rowset_schema(columns))])


def change_pages(captured: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Shape captured change elements: rows, deleted ids, token and flags per page."""
    ids = F.coalesce(F.col("Changes.Id"), F.array().cast("array<struct<_VALUE:string,_ChangeType:string>>"))

    def of_type(*kinds: str) -> Column:
        return F.filter(ids, lambda i: F.lower(F.coalesce(i["_ChangeType"], F.lit(""))).isin(*kinds))

    rows = F.transform(F.col("rs:data")["z:row"], lambda r: _as_map(r, columns))
    return captured.select(
        F.col("_metadata.file_path").alias("path"),
        F.col("Changes._LastChangeToken").alias("last_change_token"),
        F.coalesce(F.upper("Changes._MoreChanges") == "TRUE", F.lit(False)).alias("more_changes"),
        (F.size(of_type("invalidtoken", "invalid")) > 0).alias("token_invalid"),
        F.transform(of_type("delete"), lambda i: wire.strip(i["_VALUE"])).alias("deleted"),
        F.coalesce(rows, F.array().cast(f"array<{RAW}>")).alias("rows"),
        F.col("_metadata.file_block_start").alias("block"),
    ).withColumn("page_no", _page_no())


def page_key() -> Column:
    """What orders pages: their number, then their file; pages without a number come first."""
    return F.struct(F.coalesce("page_no", F.lit(-1)).cast("bigint").alias("page_no"), F.col("path").alias("path"))


def read_change_pages(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    return change_pages(_xml(spark, "listitems", change_schema(columns)).load(path), columns)


def change_rows(pages: DataFrame, list_guid: Column) -> DataFrame:
    """Upserts and deletes of all pages in feed order; within a page the rows come last.

    ``seq`` is a struct: page number and file, place of the page in its file, place in the page. It is never
    NULL, holds pages of any size and several pages of one file.
    """
    pages = pages.withColumn("_row", F.monotonically_increasing_id())
    gone = F.transform(
        "deleted",
        lambda d, i: F.struct(d.try_cast("bigint").alias("item_id"), F.lit("delete").alias("change_type"), F.lit(None).cast(RAW).alias("raw"), i.alias("pos")),
    )
    kept = F.transform(
        "rows",
        lambda r, i: F.struct(wire.item_id(r).alias("item_id"), F.lit("update").alias("change_type"), r.alias("raw"), (i + F.size("deleted")).alias("pos")),
    )
    block = F.col("block") if "block" in pages.columns else F.lit(0).cast("bigint")
    place = F.struct(page_key().alias("page"), block.alias("block"), F.col("_row").alias("row"))
    rows = pages.select(list_guid.alias("list_guid"), place.alias("place"), F.inline(F.concat(gone, kept)))
    seq = F.struct("place.page", "place.block", "place.row", "pos")
    return rows.filter(F.col("item_id").isNotNull()).select("list_guid", "item_id", "change_type", "raw", seq.alias("seq"))


def undecodable_deletes(pages: DataFrame) -> DataFrame:
    """Deleted ids that are no whole number."""
    ids = pages.select("path", F.explode("deleted").alias("raw"))
    return ids.filter(F.col("raw").try_cast("bigint").isNull()).withColumn("event", F.lit("undecodable_delete_id"))


def feed_rows(text: DataFrame) -> DataFrame:
    """Rows of JSON feed bodies in ``value``: a results list, a bare list or a single object."""
    d = F.try_variant_get(F.try_parse_json("value"), "$.d", "variant")
    staged = text.select("path", d.alias("d"))
    listed = F.try_variant_get("d", "$.results", "array<variant>")
    bare = F.try_variant_get("d", "$", "array<variant>")
    single = F.when(F.schema_of_variant("d").startswith("OBJECT"), F.array("d"))
    rows = staged.select(
        "path",
        F.try_variant_get("d", "$.__next", "string").alias("next"),
        F.posexplode(F.coalesce(listed, bare, single)).alias("pos", "row"),
    )
    return rows.filter(F.schema_of_variant("row").startswith("OBJECT"))


def read_odata_json(spark: SparkSession, path: str) -> DataFrame:
    """Captured JSON feed pages, one row per entity; anything else gives no rows."""
    text = spark.read.option("wholetext", "true").text(path)
    return feed_rows(text.select(F.col("_metadata.file_path").alias("path"), "value"))


NESTED_PROPERTIES = ["Id", "Title", "Value", "Name"]
_CELL = T.StructType(
    [
        T.StructField("_VALUE", T.StringType()),
        T.StructField("_m:type", T.StringType()),
        T.StructField("_m:null", T.StringType()),
        T.StructField("d:element", T.ArrayType(T.StringType())),
    ]
)


def _properties_schema(properties: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(f"d:{p}", _CELL) for p in properties])


def _content_schema(properties: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField("m:properties", _properties_schema(properties))])


def atom_schema(properties: Sequence[str], nested: Sequence[str]) -> T.StructType:
    inner = T.StructType([T.StructField("content", _content_schema(nested))])
    inline = T.StructType(
        [
            T.StructField("entry", inner),
            T.StructField("feed", T.StructType([T.StructField("entry", T.ArrayType(inner))])),
        ]
    )
    link = T.StructType(
        [T.StructField("_rel", T.StringType()), T.StructField("_href", T.StringType()), T.StructField("m:inline", inline)]
    )
    return T.StructType(
        [
            T.StructField("content", _content_schema(properties)),
            T.StructField("m:properties", _properties_schema(properties)),
            T.StructField("link", T.ArrayType(link)),
        ]
    )


_TRUE = "^(?i:true)\\z"


def _json_text(c: Column) -> Column:
    """A text as JSON string, quotes included; most texts need no escaping."""
    wrapped = F.to_json(F.array(c))
    special = c.rlike(r'["\\\x00-\x1f]')
    return F.when(special, F.substr(wrapped, F.lit(2), F.length(wrapped) - 2)).otherwise(
        F.concat(F.lit('"'), c, F.lit('"'))
    )


def _cell_json(cell: Column) -> Column:
    """One property as the JSON feed sends it; 64-bit, decimal and date values stay text."""
    edm = F.coalesce(cell["_m:type"], F.lit("Edm.String"))
    text = F.coalesce(cell["_VALUE"], F.lit(""))
    whole = wire.strip(text).try_cast("bigint").cast("string")
    real = F.to_json(F.struct(wire.number(text).alias("n")))
    elements = F.transform(cell["d:element"], lambda e: F.coalesce(e, F.lit("")))
    return (
        F.when(wire.strip(cell["_m:null"]).rlike(_TRUE), F.lit("null"))
        .when(F.size(cell["d:element"]) > 0, F.concat(F.lit('{"results":'), F.to_json(elements), F.lit("}")))
        .when(edm == "Edm.Boolean", wire.strip(text).rlike(_TRUE).cast("string"))
        .when(edm.isin("Edm.Int16", "Edm.Int32", "Edm.Byte", "Edm.SByte"), F.coalesce(whole, _json_text(text)))
        .when(
            edm.isin("Edm.Double", "Edm.Single") & wire.number(text).isNotNull(),
            F.regexp_extract(real, r":(.*)\}$", 1),
        )
        .otherwise(_json_text(text))
    )


def _members(container: Column, properties: Sequence[str]) -> list[Column]:
    """Each property as a member of a JSON object, NULL for an absent one."""
    return [
        F.when(container[f"d:{p}"].isNotNull(), F.concat(F.lit(f'"{p}":'), _cell_json(container[f"d:{p}"])))
        for p in properties
    ]


def _object(members: Sequence[Column]) -> Column:
    """An object of texts and arrays of texts; unlike an array of them, this is compiled. NULLs are left out."""
    return F.concat(F.lit("{"), F.concat_ws(",", *members), F.lit("}"))


def atom_rows(captured: DataFrame, properties: Sequence[str], nested: Sequence[str]) -> DataFrame:
    """Shape captured Atom entries as the JSON feed would have delivered them.

    Columns of an expanded link stay inside that link and never reach the parent.
    """
    own = F.coalesce(F.col("content")["m:properties"], F.col("m:properties"))

    def inner(e: Column) -> Column:
        return _object(_members(e["content"]["m:properties"], nested))

    def link_json(k: Column) -> Column:
        inline = k["m:inline"]
        rows = F.transform(inline["feed"]["entry"], inner)
        return (
            F.when(inline["feed"].isNotNull(), F.concat(F.lit('{"results":['), F.array_join(rows, ","), F.lit("]}")))
            .when(inline["entry"].isNotNull(), inner(inline["entry"]))
            .when(inline.isNull(), F.concat(F.lit('{"__deferred":{"uri":'), _json_text(F.coalesce(k["_href"], F.lit(""))), F.lit("}}")))
        )

    related = F.filter(F.coalesce(F.col("link"), F.array()), lambda k: F.contains(k["_rel"], F.lit("/related/")))
    linked = F.transform(
        related,
        lambda k: F.concat(_json_text(F.substring_index(k["_rel"], "/related/", -1)), F.lit(":"), link_json(k)),
    )
    members = [*_members(own, properties), linked]
    return captured.select(F.col("_metadata.file_path").alias("path"), F.try_parse_json(_object(members)).alias("row"))


def read_odata_atom(
    spark: SparkSession, path: str, properties: Sequence[str], nested: Sequence[str] = tuple(NESTED_PROPERTIES)
) -> DataFrame:
    """Captured Atom feed pages, one row per entry of the outer feed."""
    return atom_rows(_xml(spark, "entry", atom_schema(properties, nested)).load(path), properties, nested)


LIST_ATTRIBUTES = [
    "ID", "Guid", "Title", "Description", "BaseType", "ServerTemplate", "ItemCount", "Hidden", "RootFolder",
    "DefaultViewUrl", "EnableAttachments", "HasUniqueScopes", "Created", "Modified",
]
FIELD_ATTRIBUTES = [
    "ID", "Name", "StaticName", "DisplayName", "Type", "Required", "Hidden", "ReadOnly", "List", "ShowField", "Mult",
    "ColName", "Format", "ResultType", "MaxLength",
]


def _flag(c: Column) -> Column:
    return F.coalesce(F.lower(wire.strip(c)).isin("true", "1", "yes"), F.lit(False))


def _filled(c: Column) -> Column:
    return F.when(c != "", c)


def _list_columns(web_url: Column) -> list[Column]:
    a = {n: F.col(f"_{n}") for n in LIST_ATTRIBUTES}
    empty = F.lit("")
    return [
        names.normalise_guid(F.coalesce(_filled(a["ID"]), _filled(a["Guid"]))).alias("guid"),
        F.coalesce(a["Title"], empty).alias("title"),
        F.coalesce(a["Description"], empty).alias("description"),
        F.coalesce(a["BaseType"], F.lit("0")).alias("base_type"),
        F.coalesce(a["ServerTemplate"], empty).alias("server_template"),
        F.coalesce(wire.strip(a["ItemCount"]).try_cast("bigint"), F.lit(0)).alias("item_count"),
        _flag(a["Hidden"]).alias("hidden"),
        F.coalesce(a["RootFolder"], empty).alias("root_folder"),
        F.coalesce(a["DefaultViewUrl"], empty).alias("default_view_url"),
        _flag(a["EnableAttachments"]).alias("enable_attachments"),
        _flag(a["HasUniqueScopes"]).alias("has_unique_scopes"),
        a["Created"].alias("created"),
        a["Modified"].alias("modified"),
        web_url.alias("web_url"),
    ]


def read_list_inventory(spark: SparkSession, path: str, web_url: Column | None = None) -> DataFrame:
    """``<List>`` entries of captured inventories."""
    schema = _text_struct([f"_{a}" for a in LIST_ATTRIBUTES])
    return _xml(spark, "List", schema).load(path).select(*_list_columns(F.lit("") if web_url is None else web_url))


def read_web_inventory(spark: SparkSession, path: str) -> DataFrame:
    """``<Web>`` entries with a url; ``pos`` orders them by file, part of the file, and place in it."""
    rows = _xml(spark, "Web", _text_struct(["_Title", "_Url"])).load(path)
    pos = F.struct(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )
    return rows.select(F.coalesce("_Title", F.lit("")).alias("title"), F.col("_Url").alias("url"), pos.alias("pos")).filter(
        F.coalesce(F.col("url"), F.lit("")) != ""
    )


def read_list_schemas(spark: SparkSession, path: str, web_url: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """``lists`` and ``list_fields`` of captured schema replies."""
    field = T.StructType(
        [T.StructField(f"_{a}", T.StringType()) for a in FIELD_ATTRIBUTES]
        + [
            T.StructField("CHOICES", T.StructType([T.StructField("CHOICE", T.ArrayType(T.StringType()))])),
            T.StructField("Formula", T.StringType()),
        ]
    )
    schema = T.StructType(
        _text_struct([f"_{a}" for a in LIST_ATTRIBUTES]).fields
        + [T.StructField("Fields", T.StructType([T.StructField("Field", T.ArrayType(field))]))]
    )
    captured = _xml(spark, "List", schema).load(path)
    lists = captured.select(*_list_columns(F.lit("") if web_url is None else web_url))
    guid = _list_columns(F.lit(""))[0]
    rows = captured.select(guid.alias("list_guid"), F.posexplode("Fields.Field").alias("pos", "f"))
    return lists, rows.select("list_guid", "pos", *_field_columns(F.col("f")))


def _field_columns(f: Column) -> list[Column]:
    name = F.coalesce(_filled(f["_Name"]), _filled(f["_StaticName"]), _filled(f["_DisplayName"]), F.lit(""))
    target = f["_List"]
    length = wire.strip(f["_MaxLength"]).try_cast("int")
    raw = F.map_from_arrays(
        F.array(*[F.lit(a) for a in FIELD_ATTRIBUTES]), F.array(*[f[f"_{a}"] for a in FIELD_ATTRIBUTES])
    )
    return [
        name.alias("name"),
        F.coalesce(f["_DisplayName"], name).alias("display_name"),
        F.coalesce(f["_Type"], F.lit("Text")).alias("type"),
        _flag(f["_Required"]).alias("required"),
        _flag(f["_Hidden"]).alias("hidden"),
        _flag(f["_ReadOnly"]).alias("read_only"),
        F.when(F.coalesce(target, F.lit("")).isin("", "Self"), target).otherwise(names.normalise_guid(target)).alias("lookup_list"),
        f["_ShowField"].alias("show_field"),
        _flag(f["_Mult"]).alias("mult"),
        f["_Format"].alias("format"),
        f["_ResultType"].alias("result_type"),
        F.when(length != 0, length).alias("max_length"),
        F.transform(F.coalesce(f["CHOICES"]["CHOICE"], F.array().cast("array<string>")), wire.strip).alias("choices"),
        f["Formula"].alias("formula"),
        F.map_filter(raw, lambda _k, v: v.isNotNull()).alias("raw_attributes"),
    ]
