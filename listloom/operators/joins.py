"""Parent and child rows, lookups, people and name matching."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import fixed, names, wire
from ..scale import HOT_ROWS, broadcast_if_small, collect_in_parts, rank_within


def thread_order(
    children: DataFrame, fk: str, created: Column, ids: Sequence[Column], name: str = "position", hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Position of each child in its thread: undated first, then by instant, then by id."""
    order = [created.asc_nulls_first(), *[c.asc_nulls_first() for c in ids]]
    return rank_within(children.filter(F.col(fk).isNotNull()), [fk], order, name, hot_rows)


def attach_children_in_parts(
    parents: DataFrame,
    children: DataFrame,
    pk: str,
    fk: str,
    created: Column,
    ids: Sequence[Column],
    columns: Sequence[str],
    part_rows: int,
    name: str = "comments",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """One row per parent and part, with the ordered children of that part; without children one empty array.

    The caller says how many children make a part; all children are kept. ``thread_order`` is the long form, a row per child.
    """
    ranked = thread_order(children, fk, created, ids, "_rank", hot_rows)
    entry = F.struct(*[F.col(c) for c in columns])
    threads = collect_in_parts(ranked.select(fk, "_rank", *[c for c in columns if c != fk]), [fk], "_rank", entry, name, part_rows)
    threads = threads.withColumnRenamed(fk, "_fk")
    joined = parents.join(threads, parents[pk] == threads["_fk"], "left")
    empty = F.array().cast(threads.schema[name].dataType)
    return joined.select(
        *[parents[c] for c in parents.columns],
        F.coalesce("part", F.lit(0).cast("bigint")).alias("part"),
        F.coalesce(F.col(name), empty).alias(name),
    )


def orphans(children: DataFrame, fk: str) -> DataFrame:
    return children.filter(F.col(fk).isNull())


def unmatched_parents(parents: DataFrame, children: DataFrame, pk: str, fk: str) -> DataFrame:
    """Parent ids named by children that no parent row has. Duplicates go before the join."""
    named = children.filter(F.col(fk).isNotNull()).groupBy(fk).agg(F.count(F.lit(1)).alias("children"))
    return named.join(parents.select(F.col(pk).alias(fk)), fk, "left_anti")


def join_coverage(parents: DataFrame, children: DataFrame, pk: str, fk: str) -> DataFrame:
    """One row: parents, matched parents, children, orphans, unmatched parent ids."""
    named = children.groupBy(F.col(fk).alias("_k")).agg(F.count(F.lit(1)).alias("_c"))
    owned = parents.groupBy(F.col(pk).alias("_k")).agg(F.count(F.lit(1)).alias("_p"))
    both = owned.join(named, "_k", "full")
    c, p = F.col("_c"), F.col("_p")

    def total(x: Column) -> Column:
        return F.coalesce(F.sum(x), F.lit(0)).cast("bigint")

    return both.agg(
        total(p).alias("parents"),
        total(F.when(c.isNotNull(), p)).alias("matched_parents"),
        total(c).alias("children"),
        total(F.when(F.col("_k").isNull(), c)).alias("orphans"),
        F.count_if(F.col("_k").isNotNull() & p.isNull()).alias("unmatched_parents"),
    )


def parent_value(c: Column, dtype: T.DataType) -> Column:
    """The parent id in a column of any shape: whole number, digit text or nested object."""
    none = F.lit(None).cast("bigint")
    if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return c.cast("bigint")
    if isinstance(dtype, T.StringType):
        return F.when(wire.strip(c).rlike("^[0-9]+$"), wire.strip(c).try_cast("bigint"))
    if isinstance(dtype, T.StructType):
        key = resolve_name(dtype.names, fixed.KEY_ALIASES)
        whole = key is not None and isinstance(dtype[key].dataType, (T.IntegerType, T.LongType))
        return c[key].cast("bigint") if whole else none
    if isinstance(dtype, T.VariantType):
        kind = F.schema_of_variant(c)
        text = wire.strip(F.try_variant_get(c, "$", "string"))
        inner = F.coalesce(*[F.try_variant_get(c, f"$.{k}", "bigint") for k in fixed.KEY_ALIASES])
        return (
            F.when(kind == "BIGINT", F.try_variant_get(c, "$", "bigint"))
            .when((kind == "STRING") & text.rlike("^[0-9]+$"), text.try_cast("bigint"))
            .when(kind.startswith("OBJECT"), inner)
        )
    return none


def resolve_name(present: Sequence[str], aliases: Sequence[str]) -> str | None:
    """The name that fits best: exact spelling before any case, then the order of the aliases, then the later name."""
    ranked = [
        (name != alias, place, -at, name)
        for place, alias in enumerate(aliases)
        for at, name in enumerate(present)
        if name.lower() == alias.lower()
    ]
    return min(ranked)[-1] if ranked else None


def candidate_parent_keys(columns: Sequence[str]) -> list[str]:
    """Columns whose name could hold a key of another list.

    A reference is named after a parent or ends as an id; the row's own key and what the server keeps for itself are none.
    """
    own = {name.lower() for name in (*fixed.KEY_ALIASES, *fixed.HOUSEKEEPING_KEYS)}
    references = (c for c in columns if "parent" in c.lower() or c[-2:] in ("Id", "ID"))
    return [c for c in references if c.lower() not in own and not c.lower().startswith("owshiddenversion")]


def score_parent_keys(children: DataFrame, parents: DataFrame | None, pk: str | None = None) -> DataFrame:
    """Per candidate column: how many values are parent ids, and how many are filled.

    Equal values are counted before the join, so a value shared by many children
    travels once per task. All rows are scored.
    """
    found = candidate_parent_keys(children.columns)
    if not found:
        return children.sparkSession.createDataFrame([], "candidate string, hits bigint, populated bigint")
    entries = [
        F.struct(F.lit(c).alias("candidate"), parent_value(F.col(f"`{c}`"), children.schema[c].dataType).alias("v"))
        for c in found
    ]
    values = children.select(F.inline(F.array(*entries))).filter(F.col("v").isNotNull())
    counted = values.groupBy("candidate", "v").agg(F.count(F.lit(1)).alias("n"))
    if parents is None:
        hit = F.col("n")
    else:
        known = parents.select(F.col(pk).cast("bigint").alias("v")).distinct().withColumn("_hit", F.lit(True))
        counted = counted.join(known, "v", "left")
        hit = F.when(F.col("_hit"), F.col("n")).otherwise(F.lit(0))
    return (
        counted.groupBy("candidate")
        .agg(F.sum(hit).alias("hits"), F.sum("n").alias("populated"))
        .filter(F.col("hits") > 0)
    )


def detect_parent_key(children: DataFrame, parents: DataFrame | None, pk: str | None = None) -> DataFrame:
    """The best scored candidate; ties go to the fuller column, then to the later name."""
    scored = score_parent_keys(children, parents, pk)
    return scored.orderBy(F.desc("hits"), F.desc("populated"), F.desc("candidate")).limit(1)


def show_labels(items: DataFrame, item_fields: DataFrame, edges: DataFrame) -> DataFrame:
    """Current label of every row of every list that is the target of an edge."""
    wanted = edges.select(
        F.col("target_list_guid").alias("list_guid"), F.coalesce("show_field", F.lit("Title")).alias("field")
    ).distinct()
    wanted = broadcast_if_small(wanted)
    rows = items.select("list_guid", "item_id").join(wanted, "list_guid")
    text = F.coalesce(
        F.col("v_string"), F.get("v_refs", F.lit(0))["value"], F.col("v_bigint").cast("string"), F.col("v_double").cast("string")
    )
    values = item_fields.select("list_guid", "item_id", "field", text.alias("label"))
    values = values.join(wanted, ["list_guid", "field"], "left_semi")
    return rows.join(values, ["list_guid", "item_id", "field"], "left")


def resolve_lookups(item_fields: DataFrame, edges: DataFrame, labels: DataFrame, depth: int = 1) -> DataFrame:
    """Every lookup reference with the current label of its target, joined on id only.

    ``depth`` > 1 follows the targets' own lookups; ``level`` says how far a row is. An item that leads to the same target
    by the same fields in several ways has one row for it, so ways do not multiply from level to level.
    The label side has one row per target, so a hot id skews only the reference
    side, which is split at run time.
    """
    edge = broadcast_if_small(
        edges.select(
            F.col("source_list_guid").alias("list_guid"),
            F.col("field_name").alias("field"),
            "target_list_guid",
            F.coalesce("show_field", F.lit("Title")).alias("show_field"),
        )
    )
    refs = (
        item_fields.filter(F.col("v_refs").isNotNull())
        .select("list_guid", "item_id", "field", F.posexplode("v_refs").alias("pos", "ref"))
        .join(edge, ["list_guid", "field"])
        .select("*", F.col("ref.id").alias("target_id"), F.col("ref.value").alias("stored_label"))
        .drop("ref")
    )
    target = labels.select(
        F.col("list_guid").alias("target_list_guid"),
        F.col("item_id").alias("target_id"),
        F.col("field").alias("show_field"),
        F.col("label").alias("current_label"),
        F.lit(True).alias("target_found"),
    )

    def labelled(rows: DataFrame, level: int) -> DataFrame:
        out = rows.join(target, ["target_list_guid", "target_id", "show_field"], "left")
        return out.select(
            "list_guid", "item_id", "field", "pos", "target_list_guid", "target_id", "stored_label", "current_label",
            F.coalesce("target_found", F.lit(False)).alias("target_found"), F.lit(level).alias("level"),
        )

    out = labelled(refs, 1)
    reached = refs
    for level in range(2, depth + 1):
        onward = refs.select(
            F.col("list_guid").alias("target_list_guid"),
            F.col("item_id").alias("target_id"),
            F.col("field").alias("_f"),
            F.col("pos").alias("_p"),
            F.col("target_list_guid").alias("_tg"),
            F.col("target_id").alias("_ti"),
            F.col("show_field").alias("_s"),
            F.col("stored_label").alias("_l"),
        )
        reached = reached.drop("show_field", "stored_label").join(onward, ["target_list_guid", "target_id"]).select(
            "list_guid", "item_id", F.concat_ws("/", "field", "_f").alias("field"), F.col("_p").alias("pos"),
            F.col("_tg").alias("target_list_guid"), F.col("_ti").alias("target_id"),
            F.col("_s").alias("show_field"), F.col("_l").alias("stored_label"),
        )
        way = ["list_guid", "item_id", "field", "target_list_guid", "target_id", "show_field"]
        reached = reached.groupBy(*way).agg(F.min("pos").alias("pos"), F.min("stored_label").alias("stored_label"))
        out = out.unionByName(labelled(reached, level))
    return out


def stale_labels(resolved: DataFrame) -> DataFrame:
    """References whose stored label is not the current one."""
    same = F.col("stored_label").eqNullSafe(F.col("current_label"))
    return resolved.filter(F.col("target_found") & ~same)


def dangling_refs(resolved: DataFrame) -> DataFrame:
    """References whose id has no target row."""
    return resolved.filter(~F.col("target_found"))


def resolve_people(children: DataFrame, users: DataFrame | None, id_column: str, name: str = "author") -> DataFrame:
    """Names for numeric author ids; without a user table the ids stay alone."""
    if users is None:
        return children.withColumn(name, F.lit(None).cast("string"))
    table = users.select(F.col("id").alias(id_column), F.col("name").alias(name))
    return children.join(broadcast_if_small(table), id_column, "left")


def _match_keys(name: Column) -> Column:
    """Match keys of a name in falling priority."""
    options = [name, F.lower(name), names.fold_name(name), names.fold_name(name, ascii_only=True)]
    return F.array(*[F.struct(F.lit(i).alias("priority"), k.alias("key")) for i, k in enumerate(options)])


def match_collections(wanted: DataFrame, available: DataFrame) -> DataFrame:
    """Each wanted name with the collection it means.

    Exact, then without case, then folded with and without Unicode letters. Several
    hits of the same priority give the first by ``pos`` and set ``ambiguous``.
    """
    options = (
        available.select("name", "pos", F.inline(_match_keys(F.col("name"))))
        .groupBy("priority", "key")
        .agg(F.min_by("name", "pos").alias("match"), F.count(F.lit(1)).alias("_n"))
    )
    asked = wanted.select(F.col("name").alias("wanted")).distinct()
    tried = asked.select("wanted", F.inline(_match_keys(F.col("wanted"))))
    hits = tried.join(options, ["priority", "key"])
    best = hits.groupBy("wanted").agg(F.min(F.struct("priority", "match", "_n")).alias("_b"))
    return asked.join(best, "wanted", "left").select(
        "wanted",
        F.col("_b.match").alias("match"),
        F.col("_b.priority").alias("priority"),
        F.coalesce(F.col("_b._n") > 1, F.lit(False)).alias("ambiguous"),
        F.col("_b").isNull().alias("fallback"),
    )


def near_names(misses: DataFrame, available: DataFrame, letters: int = 6) -> DataFrame:
    """For names without a match: how many names contain their first letters, and the first one.

    Available names are cut into all runs of the needed lengths and counted per
    run before the join, so no pairs of names are formed.
    """
    low = F.lower(F.col("name"))
    lengths = F.array(*[F.lit(i) for i in range(1, letters + 1)])
    starts = F.sequence(F.lit(1), F.greatest(F.length(low), F.lit(1)))
    runs = F.array_distinct(
        F.flatten(
            F.transform(
                lengths,
                lambda k: F.transform(
                    F.filter(starts, lambda s: s + k - 1 <= F.length(low)), lambda s: F.substr(low, s, k)
                ),
            )
        )
    )
    per_run = (
        available.select("name", "pos", F.explode(runs).alias("run"))
        .groupBy("run")
        .agg(F.count(F.lit(1)).alias("near"), F.min_by("name", "pos").alias("first_near"))
    )
    asked = misses.select(F.col("name").alias("wanted")).distinct()
    asked = asked.withColumn("run", F.substr(F.lower("wanted"), F.lit(1), F.lit(letters)))
    return asked.join(per_run, "run", "left").select(
        "wanted", F.coalesce("near", F.lit(0)).cast("bigint").alias("near"), "first_near"
    )
