"""Rows of the JSON and Atom feeds: property names to fields, values to typed slots."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed, names, wire
from ..scale import broadcast_if_small


def property_names(list_fields: DataFrame) -> DataFrame:
    """Folded spelling to field per list; the first field in schema order wins."""
    spelled = F.array(
        *[
            F.struct(F.lit(i).alias("candidate"), F.lit(j).alias("fold"), names.fold_name(c, bool(j)).alias("key"))
            for i, c in enumerate([F.col("display_name"), names.unescape_name(F.col("name")), F.col("name")])
            for j in (0, 1)
        ]
    )
    return (
        list_fields.select("list_guid", "name", "type", "pos", F.inline(spelled))
        .filter(F.col("key").isNotNull() & (F.col("key") != ""))
        .groupBy("list_guid", "key")
        .agg(F.min_by(F.struct("name", "type"), F.struct("pos", "candidate", "fold")).alias("hit"))
        .select("list_guid", "key", F.col("hit.name").alias("name"), F.col("hit.type").alias("type"))
    )


def _name_maps(list_fields: DataFrame) -> DataFrame:
    """One row per list: every folded spelling of its columns with the column's name and type."""
    entry = F.struct("key", F.struct("name", "type"))
    return property_names(list_fields).groupBy("list_guid").agg(F.map_from_entries(F.collect_list(entry)).alias("_names"))


def _find(name: Column) -> Column:
    """The column a property means: by its Unicode fold, then by its ASCII fold."""
    return F.coalesce(*[F.try_element_at("_names", names.fold_name(name, bool(fold))) for fold in (0, 1)])


def _properties() -> Column:
    """The properties of one entity that carry data, each with the field it fills."""

    def described(e: Column) -> Column:
        kind = F.schema_of_variant(e["value"])
        scalar_id = e["key"].endswith("Id") & (F.length(e["key"]) > 2) & (kind == "BIGINT")
        base = F.when(scalar_id, _find(F.substr(e["key"], F.lit(1), F.length(e["key"]) - 2)))
        return F.struct(e["key"].alias("key"), e["value"].alias("value"), kind.alias("kind"), _find(e["key"]).alias("own"), base.alias("base"))

    def filled(e: Column) -> Column:
        is_id = e["base"].isNotNull()
        hit = F.when(is_id, e["base"]).otherwise(e["own"])
        plain_id = e["own"].isNull() & (e["key"] == "Id")

        def entry(field: Column) -> Column:
            return F.struct(
                field.alias("field"), e["key"].alias("key"), e["value"].alias("value"), e["kind"].alias("kind"), is_id.alias("is_id"),
                hit["type"].alias("wire_type"), (hit.isNotNull() | (e["key"] == "Id")).alias("mapped"),
            )

        own = entry(F.coalesce(hit["name"], e["key"]))
        return F.when(~is_id & plain_id, F.array(entry(F.lit("Id")), entry(F.lit("ID")))).otherwise(F.array(own))

    cells = F.map_entries(F.try_variant_get("row", "$", "map<string,variant>"))
    data = F.filter(cells, lambda e: ~e["key"].isin(fixed.CONTROL_KEYS) & F.try_variant_get(e["value"], "$.__deferred", "variant").isNull())
    return F.flatten(F.transform(F.transform(data, described), filled))


def _last_of_field(entries: Column) -> Column:
    """Of several properties that mean the same field, the last by name; entries come in the order of their names."""
    fields = F.transform(entries, lambda e: e["field"])
    later = lambda e, i: F.array_contains(F.slice(fields, i + 2, F.size(fields)), e["field"])
    return F.when(F.size(F.array_distinct(fields)) == F.size(fields), entries).otherwise(F.filter(entries, lambda e, i: ~later(e, i)))


def _merged() -> Column:
    """One entry per field of an entity: its own value, and the id that a scalar property gives."""
    own, ids = F.col("_own_props"), F.col("_id_props")

    def with_id(e: Column) -> Column:
        ref = F.filter(ids, lambda r: r["field"] == e["field"])
        return F.struct(
            e["field"].alias("field"),
            F.struct(e["value"].alias("value"), e["kind"].alias("_kind")).alias("_own"),
            F.try_variant_get(F.get(ref, F.lit(0))["value"], "$", "bigint").alias("_ref_id"),
            e["wire_type"].alias("wire_type"),
            e["mapped"].alias("mapped"),
        )

    def id_only(e: Column) -> Column:
        return F.struct(
            e["field"].alias("field"),
            F.lit(None).cast("struct<value:variant,_kind:string>").alias("_own"),
            F.try_variant_get(e["value"], "$", "bigint").alias("_ref_id"),
            e["wire_type"].alias("wire_type"),
            e["mapped"].alias("mapped"),
        )

    alone = F.filter(ids, lambda r: ~F.exists(own, lambda e: e["field"] == r["field"]))
    return F.concat(F.transform(own, with_id), F.transform(alone, id_only))


def map_odata_rows(pages: DataFrame, list_fields: DataFrame) -> DataFrame:
    """Feed rows in the long typed shape, keyed by internal field names.

    Reads ``list_guid``, ``item_id`` and ``row`` (variant). Deferred stubs are
    dropped, ``XId`` scalars give lookup X its id, unmapped properties stay under
    their own name with ``mapped`` false. Names are resolved and properties of a field merged
    inside each entity, so nothing is shuffled and two versions of an item are not mixed.
    """
    known = broadcast_if_small(_name_maps(list_fields))
    named = pages.select("list_guid", "item_id", "row").join(known, "list_guid", "left")
    props = named.select("list_guid", "item_id", _properties().alias("_props"))
    sides = {"_own_props": F.filter("_props", lambda e: ~e["is_id"]), "_id_props": F.filter("_props", lambda e: e["is_id"])}
    split = props.select("list_guid", "item_id", *[_last_of_field(c).alias(k) for k, c in sides.items()])
    return _typed(split.select("list_guid", "item_id", F.inline(_merged())))


def _typed(merged: DataFrame) -> DataFrame:
    """Typed slots of merged properties, in stages so that no value is read twice."""
    keys = ["list_guid", "item_id", "field", "wire_type", "mapped"]
    v, kind = F.col("_own.value"), F.col("_kind")
    read = merged.select(*keys, "_ref_id", "_own", F.coalesce("_own._kind", F.lit("VOID")).alias("_kind")).select(
        *keys,
        "_ref_id",
        "_kind",
        v.alias("_v"),
        F.when(kind == "STRING", F.try_variant_get(v, "$", "string")).alias("_text"),
        F.when(kind == "BIGINT", F.try_variant_get(v, "$", "bigint")).alias("_whole"),
        F.when(kind.startswith("DECIMAL") | kind.isin("DOUBLE", "FLOAT"), F.try_variant_get(v, "$", "double")).alias("_wide"),
        F.when(kind == "BOOLEAN", F.try_variant_get(v, "$", "boolean")).alias("v_bool"),
        F.when(kind.startswith("OBJECT"), F.try_variant_get(v, "$.results", "array<variant>")).alias("_many"),
        F.when(kind.startswith("OBJECT"), F.try_variant_get(v, "$.Id", "variant")).isNotNull().alias("_nested"),
    )
    v, text, whole, many = F.col("_v"), F.col("_text"), F.col("_whole"), F.col("_many")
    # The scalar id completes a label, or stands alone where no label came.
    from_id = F.col("_ref_id").isNotNull() & kind.isin("STRING", "VOID")
    declared = F.coalesce("wire_type", F.lit("Text"))
    first = F.get(many, F.lit(0))
    staged = read.select(
        "*",
        from_id.alias("_from_id"),
        F.coalesce(F.schema_of_variant(first).startswith("OBJECT"), F.lit(False)).alias("_ref_rows"),
        F.when(~from_id & declared.isin("Number", "Currency"), wire.number(text)).alias("_number"),
        F.when(~from_id & declared.isin("Integer", "Counter"), wire.integer(text)).alias("_integer"),
        F.when(~from_id & (declared == "DateTime"), wire.feed_instant(text)).alias("v_ts"),
        declared.isin("Number", "Currency").alias("_numeric"),
    )

    def one_ref(x: Column) -> Column:
        label = F.coalesce(*[F.nullif(F.try_variant_get(x, f"$.{k}", "string"), F.lit("")) for k in ("Title", "Value", "Name")])
        return wire.ref(F.try_variant_get(x, "$.Id", "bigint"), label)

    refs = (
        F.when(F.col("_from_id"), F.array(wire.ref(F.col("_ref_id"), text)))
        .when(F.col("_nested"), F.array(one_ref(v)))
        .when(F.col("_ref_rows"), F.transform(many, one_ref))
    )
    untyped = ~F.col("_from_id") & F.col("_number").isNull() & F.col("_integer").isNull() & F.col("v_ts").isNull()
    other = kind.startswith("OBJECT") & ~F.col("_nested") & many.isNull()
    return staged.select(
        *keys,
        F.when(untyped & text.isNotNull(), text).when(other, F.to_json(v)).alias("v_string"),
        F.coalesce("_number", "_wide", F.when(F.col("_numeric"), whole.cast("double"))).alias("v_double"),
        F.coalesce("_integer", F.when(~F.col("_numeric"), whole)).alias("v_bigint"),
        "v_bool",
        "v_ts",
        refs.alias("v_refs"),
        F.when(many.isNotNull() & ~F.col("_ref_rows"), F.transform(many, lambda x: F.try_variant_get(x, "$", "string"))).alias("v_strings"),
    )


def _spelled_like(alias: str):
    return lambda k: F.lower(k) == alias.lower()


def harmonise_columns(pages: DataFrame, roles: Mapping[str, Sequence[str]]) -> DataFrame:
    """One column per role over pages that spell it differently; exact spelling first.

    Reads ``row`` (variant). Values come back as text.
    """
    carried = [c for c in pages.columns if c != "row"]
    cells = F.try_variant_get("row", "$", "map<string,string>")
    staged = pages.select(*carried, cells.alias("_cells"))

    def role(aliases: Sequence[str]) -> Column:
        m = F.col("_cells")
        names_ = F.map_keys(m)
        exact = [F.when(F.array_contains(names_, a), F.lit(a)) for a in aliases]
        loose = [F.get(F.filter(names_, _spelled_like(a)), F.lit(0)) for a in aliases]
        return F.try_element_at(m, F.coalesce(*exact, *loose))

    return staged.select(*carried, *[role(a).alias(r) for r, a in roles.items()])


def harmonise_tables(tables: Sequence[DataFrame], roles: Mapping[str, Sequence[str]]) -> DataFrame:
    """The same for typed tables: each role takes its column from each table."""
    from .joins import resolve_name

    def one(df: DataFrame) -> DataFrame:
        found = {r: resolve_name(df.columns, a) for r, a in roles.items()}
        picked = [(F.col(f"`{c}`") if c else F.lit(None)).alias(r) for r, c in found.items()]
        rest = [F.col(f"`{c}`") for c in df.columns if c not in found.values()]
        return df.select(*picked, *rest)

    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [one(t) for t in tables])
