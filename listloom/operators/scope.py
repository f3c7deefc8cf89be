"""Webs, lists and item records: scope, identity and metadata."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed, names, wire
from ..scale import broadcast_if_small


def _contains_any(columns: Sequence[Column], patterns: Sequence[str]) -> Column:
    tests = [F.contains(F.lower(c), F.lit(p.lower())) for c in columns for p in patterns]
    return F.coalesce(reduce(lambda a, b: a | b, tests), F.lit(False)) if tests else F.lit(False)


def scope_webs(webs: DataFrame, include: Sequence[str] = (), exclude: Sequence[str] = ()) -> DataFrame:
    """Keep webs whose url or title contains an include pattern and no exclude pattern."""
    text = [F.coalesce(F.col("url"), F.lit("")), F.coalesce(F.col("title"), F.lit(""))]
    kept = webs.filter(_contains_any(text, include)) if include else webs
    return kept.filter(~_contains_any(text, exclude)) if exclude else kept


def scope_lists(
    lists: DataFrame,
    include: Sequence[str] = (),
    exclude: Sequence[str] = (),
    hidden_too: bool = False,
    libraries_too: bool = True,
) -> DataFrame:
    """Add ``in_scope`` and the first ``reason`` a list is left out."""
    text = [F.coalesce(F.col("title"), F.lit("")), F.coalesce(F.col("guid"), F.lit(""))]
    reason = F.when(F.col("title").isin(fixed.SYSTEM_LIST_TITLES), "system_list")
    if not hidden_too:
        reason = reason.when(F.col("hidden"), "hidden")
    if not libraries_too:
        reason = reason.when(F.col("base_type") == "1", "document_library_excluded")
    if include:
        reason = reason.when(~_contains_any(text, include), "not_in_include_lists")
    if exclude:
        reason = reason.when(_contains_any(text, exclude), "excluded")
    return lists.withColumn("reason", reason).withColumn("in_scope", F.col("reason").isNull())


def normalise_webs(webs: DataFrame, root_url: str | None = None) -> DataFrame:
    """One row per normalised url; the first title that is not empty wins.

    Reads ``title``, ``url`` and ``pos``, which may be anything that orders the entries. The called root is
    always present.
    """
    listed = webs.filter(F.coalesce(F.col("url"), F.lit("")) != "").select(
        names.normalise_url(F.col("url")).alias("url"), "title", "pos"
    )
    if root_url is not None:
        root = webs.sparkSession.range(1).select(
            names.normalise_url(F.lit(root_url)).alias("url"),
            F.lit("").alias("title"),
            F.lit(None).cast(listed.schema["pos"].dataType).alias("pos"),
        )
        listed = listed.unionByName(root)
    titled = F.coalesce(F.col("title"), F.lit("")) != ""
    return (
        listed.groupBy("url")
        .agg(F.coalesce(F.min_by("title", F.when(titled, F.col("pos"))), F.lit("")).alias("title"))
        .withColumn("web_id", names.web_id(F.col("url")))
    )


def merge_list_metadata(inventory: DataFrame, schema: DataFrame) -> DataFrame:
    """Inventory rows filled from the schema reply; the reply wins where it says something."""
    said = schema.select("guid", *[F.col(c).alias(f"_{c}") for c in _MERGED])
    joined = inventory.join(said, "guid", "full")

    def meaningful(c: Column, kind: str) -> Column:
        empty = {"text": c == "", "count": c == 0, "flag": ~c}[kind]
        return F.when(~empty, c)

    merged = {
        name: F.coalesce(meaningful(F.col(f"_{name}"), kind), F.col(name))
        for name, kind in _MERGED.items()
        if name != "base_type"
    }
    merged["base_type"] = F.coalesce(meaningful(F.col("base_type"), "text"), F.col("_base_type"))
    return joined.select(*[merged.get(c, F.col(c)).alias(c) for c in inventory.columns])


_MERGED = {
    "item_count": "count",
    "enable_attachments": "flag",
    "has_unique_scopes": "flag",
    "root_folder": "text",
    "default_view_url": "text",
    "base_type": "text",
}


def add_slugs(rows: DataFrame, lists: DataFrame) -> DataFrame:
    """Add ``web_slug`` and ``list_slug``, the folder names of a row's place; reads ``web_url`` and ``list_guid``.

    The slug of a web takes many patterns, so it is made once for each web of ``lists``. Rows of other webs, or of webs
    that are too many to broadcast, make their own.
    """
    own = names.web_slug(F.col("web_url"))
    webs = lists.select("web_url").filter(F.col("web_url").isNotNull()).distinct()
    known = broadcast_if_small(webs)
    placed = rows.withColumn("web_slug", own) if known is webs else _known_slugs(rows, known, own)
    return placed.withColumn("list_slug", names.guid_slug(F.col("list_guid")))


def _known_slugs(rows: DataFrame, known: DataFrame, own: Column) -> DataFrame:
    joined = rows.join(F.broadcast(known.withColumn("_slug", own)), "web_url", "left")
    return joined.select(*rows.columns, F.coalesce("_slug", own).alias("web_slug"))


def base_type_name(c: Column) -> Column:
    out = F.when(F.lit(False), "")
    for code, name in fixed.BASE_TYPE_NAMES.items():
        out = out.when(c == code, name)
    return out.otherwise(F.concat(F.lit("unknown_"), c))


def build_items(raw_items: DataFrame, lists: DataFrame, keep_raw: bool = False, identified: bool = False) -> DataFrame:
    """Item records straight from the raw map: one narrow pass and one join to ``lists``.

    Rows without a usable id are left out; ``split_by_item_id`` lists them. With
    ``keep_raw`` the raw map stays beside the record, prefixes stripped. ``identified`` rows come from ``split_by_item_id``:
    the id it read is not read again, and rows that are dealt by it stay so.
    """
    # What depends on the list alone is computed once per list.
    placed = lists.select(
        F.col("guid").alias("list_guid"),
        F.col("title").alias("list_title"),
        "web_url",
        names.web_id(names.normalise_url(F.col("web_url"))).alias("web_id"),
        names.display_form(
            F.col("web_url"), F.col("default_view_url"), F.col("root_folder"), F.col("base_type") == "1"
        ).alias("_form"),
    )
    read = raw_items if identified else raw_items.withColumn("item_id", wire.item_id(F.col("raw")))
    rows = read.filter(F.col("item_id").isNotNull())
    drop = [c for c in rows.columns if c in ("web_url", "list_title")]
    rows = rows.drop(*drop).join(broadcast_if_small(placed), "list_guid", "left")

    def attr(name: str) -> Column:
        return F.try_element_at("raw", F.lit(fixed.WIRE_PREFIX + name))

    # Each attribute is read and stripped once, then unwrapped once.
    kept = [*placed.columns, "item_id", *(["raw"] if keep_raw else [])]
    rows = rows.select(
        *kept,
        attr("ContentType").alias("content_type"),
        *[wire.strip(attr(n)).alias(f"_{n}") for n in ("Created", "Modified", "FSObjType", "FileRef", "FileLeafRef")],
    )
    rows = rows.select(
        *kept,
        "content_type",
        "_Created",
        "_Modified",
        *[wire.unwrap(F.col(f"_{n}")).alias(f"_{n}") for n in ("FSObjType", "FileRef", "FileLeafRef")],
    )
    return rows.select(
        names.doc_id(F.col("web_id"), F.col("list_guid"), F.col("item_id")).alias("doc_id"),
        "web_url",
        "web_id",
        "list_guid",
        "list_title",
        "item_id",
        F.concat("_form", F.col("item_id").cast("string")).alias("display_url"),
        "content_type",
        wire.instant_to_json(wire.instant_from(F.col("_Created"))).alias("created"),
        wire.instant_to_json(wire.instant_from(F.col("_Modified"))).alias("modified"),
        F.coalesce(wire.folder_flag_from(F.col("_FSObjType")) == 1, F.lit(False)).alias("is_folder"),
        wire.lookup_from(F.col("_FileRef"))["value"].alias("file_ref"),
        wire.lookup_from(F.col("_FileLeafRef"))["value"].alias("file_name"),
        *([wire.strip_wire_prefix(F.col("raw")).alias("raw")] if keep_raw else []),
    )
