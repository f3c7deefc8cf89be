"""Change feeds, resume and state."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..scale import broadcast_if_small
from ..session import materialise

KEY = ["list_guid", "item_id"]


def latest_per_key(changes: DataFrame, keys: Sequence[str] = KEY, seq: str = "seq") -> DataFrame:
    """The last change of each key in feed order, combined on the map side.

    ``seq`` may be a number or a struct; a change without one comes before all others and is not lost.
    """
    rest = [c for c in changes.columns if c not in keys]
    last = F.max_by(F.struct(*rest), F.struct(seq)).alias("_last")
    return changes.groupBy(*keys).agg(last).select(*[*keys, "_last.*"]).select(*changes.columns)


def latest_items(raw_items: DataFrame, order: Sequence[str], keys: Sequence[str] = KEY) -> DataFrame:
    """The last version of items that came more than once (overlapping pages, a resumed run), whole rows only."""
    place = F.struct(*order).alias("_place")
    return latest_per_key(raw_items.withColumn("_place", place), keys, "_place").drop("_place")


def split_changes(latest: DataFrame, change_type: str = "change_type") -> tuple[DataFrame, DataFrame]:
    """Latest changes as rows to write and keys to delete."""
    deleted = F.lower(F.col(change_type)) == "delete"
    return latest.filter(~deleted), latest.filter(deleted)


def apply_changes(
    target: DataFrame, upserts: DataFrame, deletes: DataFrame, keys: Sequence[str] = KEY
) -> DataFrame:
    """Target without the changed and deleted keys, plus the changed rows.

    A key that is both changed and deleted stays, with the changed row. Use
    ``latest_per_key`` first when the feed order is known.
    """
    gone = upserts.select(*keys).unionByName(deletes.select(*keys)).distinct()
    kept = target.join(gone, list(keys), "left_anti")
    return kept.unionByName(upserts.select(*target.columns))


def apply_latest(target: DataFrame, latest: DataFrame, keys: Sequence[str] = KEY) -> DataFrame:
    """``apply_changes`` for one change per key, as ``latest_per_key`` gives them.

    The reduced feed is computed once. While its keys are few they are broadcast, so
    that the target is read without a shuffle.
    """
    last = materialise(latest)
    upserts, _deletes = split_changes(last)
    kept = target.join(broadcast_if_small(last.select(*keys)), list(keys), "left_anti")
    return kept.unionByName(upserts.select(*target.columns))


def sync_report(
    target: DataFrame, upserts: DataFrame, deletes: DataFrame, keys: Sequence[str] = KEY, by: str = "list_guid"
) -> DataFrame:
    """Per list: rows written, ids the feed deleted, target rows replaced and target rows removed."""
    marks = upserts.select(*keys, F.lit("u").alias("m")).unionByName(
        deletes.select(*keys).distinct().select(*keys, F.lit("d").alias("m"))
    )
    hit = target.select(*keys).join(marks.select(*keys).distinct(), list(keys), "left_semi")
    rows = marks.select(*keys, "m").unionByName(hit.select(*keys, F.lit("t").alias("m")))
    per_key = rows.groupBy(*keys).agg(
        F.count_if(F.col("m") == "u").alias("u"),
        F.count_if(F.col("m") == "d").alias("d"),
        F.count_if(F.col("m") == "t").alias("t"),
    )
    return per_key.groupBy(by).agg(
        F.sum("u").alias("updated"),
        F.sum("d").alias("deleted"),
        F.sum("t").alias("replaced"),
        F.sum(F.when((F.col("d") > 0) & (F.col("u") == 0), F.col("t")).otherwise(F.lit(0))).alias("removed"),
    )


def truncate_after(target: DataFrame, list_state: DataFrame) -> DataFrame:
    """Rows up to the checkpoint of lists that go on behind one; rows of all other lists stay as they are.

    Of a list that goes on, rows without an id go too.
    """
    going_on = route_resume(list_state).filter(F.col("action") == "continue").select("list_guid", F.col("after_id").alias("_mark"))
    joined = target.join(broadcast_if_small(going_on), "list_guid", "left")
    return joined.filter(F.col("_mark").isNull() | (F.col("item_id") <= F.col("_mark"))).select(*target.columns)


def append_new(target: DataFrame, source: DataFrame, by: str = "list_guid", key: str = "item_id") -> DataFrame:
    """Source rows above the highest key already stored for their collection."""
    # One row per collection; stored, so that measuring it does not read the target again.
    high = materialise(target.groupBy(by).agg(F.max(key).alias("_high")))
    joined = source.join(broadcast_if_small(high), by, "left")
    return joined.filter(F.col("_high").isNull() | (F.col(key) > F.col("_high"))).select(*source.columns)


def append_unseen(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """For collections without a rising key: source rows whose keys are not stored."""
    return source.join(target.select(*keys).distinct(), list(keys), "left_anti")


def _route(change_tokens: bool) -> tuple[Column, Column]:
    if not change_tokens:
        return F.lit("full"), F.lit("no_change_tokens")
    token = F.coalesce(F.col("change_token"), F.lit(""))
    unknown = (token == "") | (F.coalesce(F.col("status"), F.lit("pending")) != "complete")
    rejected = F.coalesce(F.col("token_invalid"), F.lit(False))
    return (
        F.when(unknown, "full_then_prime").when(rejected, "full_then_prime").otherwise("incremental"),
        F.when(unknown, "no_token").when(rejected, "token_invalid"),
    )


def route_changes(batches: DataFrame, list_state: DataFrame, major: int | None) -> DataFrame:
    """Per list how its changes are taken in: incremental, or a full reload and why.

    ``batches`` has one or more rows per list with ``token_invalid``. Servers before
    major version 12 have no change tokens.
    """
    state = list_state.select("list_guid", "status", "change_token")
    per_list = batches.groupBy("list_guid").agg(F.max("token_invalid").alias("token_invalid"))
    action, reason = _route(major is not None and major >= 12)
    return per_list.join(state, "list_guid", "left").select("list_guid", action.alias("action"), reason.alias("reason"))


def route_resume(list_state: DataFrame, lists: DataFrame | None = None) -> DataFrame:
    """Per list: skip when complete, continue behind a checkpoint, else reset.

    ``lists`` (``list_guid``) adds lists that have no state yet; they are reset.
    """
    if "status" not in list_state.columns:
        list_state = list_state.withColumn("status", F.lit(None).cast("string"))
    if lists is not None:
        list_state = lists.select("list_guid").distinct().join(list_state, "list_guid", "full")
    mark = F.coalesce(F.col("last_item_id"), F.lit(0))
    action = F.when(F.col("status") == "complete", "skip").when(mark != 0, "continue").otherwise("reset")
    return list_state.select("list_guid", action.alias("action"), F.when(action == "continue", mark).otherwise(F.lit(0)).alias("after_id"))


def pages_to_load(pages: DataFrame, routes: DataFrame) -> DataFrame:
    """Rows that a resumed run still has to take in; a list without a route is loaded whole."""
    joined = pages.join(broadcast_if_small(routes.select("list_guid", "action", "after_id")), "list_guid", "left")
    behind = F.col("action").isNull() | (F.col("action") == "reset") | (F.col("item_id") > F.col("after_id"))
    return joined.filter(behind & (F.coalesce("action", F.lit("reset")) != "skip")).select(*pages.columns)


def advance_state(
    list_state: DataFrame, changed: DataFrame, tokens: DataFrame, target: DataFrame, at: Column | None = None
) -> DataFrame:
    """State after a sync: highest id seen, new token, status, and rows counted afresh.

    The other columns of the state stay (url, title, instants); a list that was synced loses its error and, given
    ``at``, has it as ``last_sync``.
    """
    high = changed.groupBy("list_guid").agg(F.max("item_id").alias("_high"))
    count = target.groupBy("list_guid").agg(F.count(F.lit(1)).alias("_rows"))
    joined = (
        list_state.join(high, "list_guid", "full").join(count, "list_guid", "full").join(
            tokens.select("list_guid", F.col("change_token").alias("_token")), "list_guid", "full"
        )
    )
    synced = F.col("_high").isNotNull() | F.col("_token").isNotNull()
    own = {"list_guid", "status", "last_item_id", "items_written", "change_token"}
    rest = {c: F.col(c) for c in list_state.columns if c not in own}
    if "error" in rest:
        rest["error"] = F.when(~synced, F.col("error"))
    if at is not None:
        before = rest.get("last_sync", F.lit(None).cast("timestamp"))
        rest["last_sync"] = F.when(synced, at).otherwise(before)
    return joined.select(
        "list_guid",
        F.when(synced, "complete").otherwise(F.coalesce("status", F.lit("pending"))).alias("status"),
        F.greatest(F.coalesce("last_item_id", F.lit(0)), F.coalesce("_high", F.lit(0))).alias("last_item_id"),
        F.coalesce("_rows", F.lit(0)).alias("items_written"),
        F.coalesce("_token", "change_token").alias("change_token"),
        *[c.alias(name) for name, c in rest.items()],
    )


def append_schema_report(existing: DataFrame, incoming: DataFrame, keys: Sequence[str], by: str = "list_guid") -> DataFrame:
    """Rows of each collection without a value for a key column, on either side: such rows cannot be told from new ones.

    A column that a side does not have counts as absent in all its rows. One row per collection, key and side that has any;
    ``rows`` says how many of ``of_rows``.
    """

    def side(df: DataFrame, name: str) -> DataFrame:
        gone = [F.count(F.lit(1)) if k not in df.columns else F.count_if(F.col(f"`{k}`").isNull()) for k in keys]
        entries = F.array(*[F.struct(F.lit(k).alias("key"), n.alias("rows")) for k, n in zip(keys, gone)])
        counted = df.groupBy(by).agg(F.count(F.lit(1)).alias("of_rows"), entries.alias("_e"))
        return counted.select(by, F.lit(name).alias("side"), "of_rows", F.inline("_e"))

    return side(existing, "stored").unionByName(side(incoming, "incoming")).filter(F.col("rows") > 0).select(by, "key", "side", "rows", "of_rows")


def check_append_schema(existing: DataFrame, incoming: DataFrame, key: str) -> None:
    """Refuse to append when the stored rows lack the key column in use now."""
    if key not in incoming.columns:
        raise ValueError(f"the incoming rows have no key column {key!r}")
    if key not in existing.columns:
        stored = ", ".join(sorted(existing.columns))
        raise ValueError(f"stored rows have no column {key!r}; they have: {stored}")


def _comparable(c: Column, dtype: T.DataType) -> Column:
    """The value with map entries in the order of their keys, so that equal values have equal texts."""
    if isinstance(dtype, T.MapType):
        return F.transform(
            F.array_sort(F.map_keys(c)),
            lambda k: F.struct(k.alias("k"), _comparable(F.try_element_at(c, k), dtype.valueType).alias("v")),
        )
    if isinstance(dtype, T.ArrayType):
        return F.transform(c, lambda x: _comparable(x, dtype.elementType))
    if isinstance(dtype, T.StructType):
        parts = [_comparable(c[f.name], f.dataType).alias(f.name) for f in dtype.fields]
        return F.when(c.isNotNull(), F.struct(*parts))
    return c


def row_digest(df: DataFrame, columns: Sequence[str]) -> Column:
    """A digest of the named columns; NULLs count with their place, variants and maps by content."""
    parts = [_comparable(F.col(f"`{c}`"), df.schema[c].dataType).alias(c) for c in columns]
    return F.sha2(F.to_json(F.struct(*parts), {"ignoreNullFields": "false"}), 256)


# Buckets of keys whose digests two snapshots compare first.
DIFF_BUCKETS = 1 << 14


def bucket_digests(df: DataFrame, key: str, columns: Sequence[str], buckets: int = DIFF_BUCKETS) -> DataFrame:
    """``bucket`` and 128 bits that depend on all keys and rows in it but not on their order; combined on the map side."""
    digest = row_digest(df, columns)
    rows = df.select(_bucket(F.col(f"`{key}`"), buckets).alias("bucket"), *[F.xxhash64(F.lit(seed), F.col(f"`{key}`"), digest).alias(f"_h{seed}") for seed in (1, 2)])
    # Sums of halves do not overflow and, other than exclusive or, tell rows that come twice.
    halves = [h for seed in (1, 2) for h in (F.col(f"_h{seed}").bitwiseAND(0xFFFFFFFF), F.shiftrightunsigned(f"_h{seed}", 32))]
    return rows.groupBy("bucket").agg(F.array(F.count(F.lit(1)), *[F.sum(h) for h in halves]).alias("digest"))


def _bucket(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def snapshot_diff(before: DataFrame, after: DataFrame, key: str = "doc_id", buckets: int = DIFF_BUCKETS) -> DataFrame:
    """Keys added, removed or changed between two runs, compared by digests of whole rows.

    Digests of key buckets are compared first, so equal runs of any size shuffle nothing else; rows are compared in buckets
    that differ only.
    """
    columns = sorted(c for c in before.columns if c != key)
    old = bucket_digests(before, key, columns, buckets).withColumnRenamed("digest", "_old")
    new = bucket_digests(after, key, columns, buckets).withColumnRenamed("digest", "_new")
    # At most one row a bucket.
    differing = materialise(old.join(new, "bucket", "full").filter(~F.col("_old").eqNullSafe(F.col("_new"))).select("bucket"))
    if differing.isEmpty():
        return before.select(key, F.lit("").alias("change")).limit(0)
    some = broadcast_if_small(differing)

    def picked(df: DataFrame, name: str) -> DataFrame:
        rows = df.withColumn("_bucket", _bucket(F.col(f"`{key}`"), buckets))
        return rows.join(some, rows["_bucket"] == some["bucket"], "left_semi").select(key, row_digest(df, columns).alias(name))

    a, b = picked(before, "_a"), picked(after, "_b")
    change = (
        F.when(F.col("_a").isNull(), "added").when(F.col("_b").isNull(), "removed").when(F.col("_a") != F.col("_b"), "changed")
    )
    return a.join(b, key, "full").select(key, change.alias("change")).filter(F.col("change").isNotNull())


def dual_completeness(items: DataFrame, raw: DataFrame, key: str = "doc_id") -> DataFrame:
    """Keys present in one of the two outputs only, and in which."""
    a = items.select(key, F.lit(True).alias("_i")).distinct()
    b = raw.select(key, F.lit(True).alias("_r")).distinct()
    side = F.when(F.col("_r").isNull(), "items_only").when(F.col("_i").isNull(), "raw_only")
    return a.join(b, key, "full").select(key, side.alias("side")).filter(F.col("side").isNotNull())


def backend_parity(
    left: DataFrame, right: DataFrame, values: Sequence[str], keys: Sequence[str] = ("doc_id", "field"), tolerance: float = 1e-9
) -> DataFrame:
    """Fields that two backends report differently, or only one of them reports."""
    a = left.select(*keys, F.struct(*values).alias("_a"))
    b = right.select(*keys, F.struct(*values).alias("_b"))

    def equal(v: str) -> Column:
        x, y = F.col(f"_a.{v}"), F.col(f"_b.{v}")
        if left.schema[v].dataType.typeName() == "double":
            return x.eqNullSafe(y) | F.coalesce(F.abs(x - y) <= tolerance * F.greatest(F.abs(x), F.abs(y)), F.lit(False))
        return x.eqNullSafe(y)

    agree = equal(values[0])
    for v in values[1:]:
        agree = agree & equal(v)
    problem = F.when(F.col("_b").isNull(), "left_only").when(F.col("_a").isNull(), "right_only").when(~agree, "differs")
    return a.join(b, list(keys), "full").select(*keys, problem.alias("problem")).filter(F.col("problem").isNotNull())
