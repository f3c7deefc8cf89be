"""Writers: item lines, schema documents, run reports and versioned snapshots."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.decode import value_variant
from ..operators.scope import add_slugs
from ..scale import broadcast_if_small
from ..session import load_if_there, materialise, require_utc

_PLACE = ["web_slug", "list_slug"]
_FILE = ["filename", "url", "local_path", "bytes", "sha256", "downloaded", "skip_reason"]


def contract_items(items: DataFrame, item_fields: DataFrame, list_fields: DataFrame) -> DataFrame:
    """Item records in their contract shape: fields as one object, and the names of the fields.

    An item has one row per column of its list, so the per-item maps are bounded by
    the schema and not by the data. Attachments have an output of their own (``write_landing``) or
    join the lines at the end (``contract.write_contract_landing``).
    Items that were sent more than once must be reduced to their last version first
    (``latest_items``); what is left twice here, with equal values or not, keeps one line per item.
    Frames dealt by ``list_guid`` and ``item_id`` to as many tasks are tied where they are.
    """
    # By id first: it tells items apart where few lists have most of them.
    keys = ["item_id", "list_guid"]
    # A number counts as its text does, so that it is written as it is read.
    value = F.when(F.col("v_double").isNotNull(), F.parse_json(F.to_json("value"))).otherwise(F.col("value")).alias("value")
    merged = value_variant(item_fields).groupBy(*keys).agg(F.collect_list(F.struct("field", value)).alias("_p"))
    merged = _one_value_a_field(merged, "_p").select(*keys, F.to_variant_object(F.map_from_entries("_p")).alias("fields"))
    shown = list_fields.groupBy("list_guid").agg(
        F.map_from_entries(F.collect_list(F.struct("name", "display_name"))).alias("field_display_names")
    )
    items = items.dropDuplicates(keys)
    joined = items.join(merged, keys, "left").select(*items.columns, "fields")
    return joined.join(broadcast_if_small(shown), "list_guid", "left").select(*_front(items.columns), "fields", "field_display_names")


def _one_value_a_field(df: DataFrame, name: str) -> DataFrame:
    """Pairs of ``field`` and ``value`` with one of each field: any value before none, then the greatest as text."""
    pairs = F.col(name)
    twice = F.size(F.array_distinct(pairs["field"])) < F.size(pairs)
    ranked = F.transform(pairs, lambda x, i: F.struct(x["field"].alias("field"), F.to_json(x["value"]).alias("text"), i.alias("i")))
    df = df.withColumn("_ranked", F.when(twice, F.sort_array(ranked)))
    last = F.filter("_ranked", lambda x, i: F.coalesce(F.get("_ranked", i + 1)["field"] != x["field"], F.lit(True)))
    best = F.transform(last, lambda x: F.struct(x["field"].alias("field"), F.get(name, x["i"])["value"].alias("value")))
    return df.withColumn(name, F.coalesce(best, pairs)).drop("_ranked")


def _front(columns: Sequence[str]) -> list[str]:
    """The keys of a list and of an item in front, as joins on them put them."""
    return ["list_guid", "item_id", *[c for c in columns if c not in ("list_guid", "item_id")]]


def _write_lines(lines: DataFrame, blanks: DataFrame, path: str) -> None:
    """Replace the partitions of all lists in ``lines`` and ``blanks``.

    Rebalancing splits a huge list over many files and keeps small lists in one. Lines repeat their names, so files are
    compressed, which readers see by their suffix.
    """
    out = lines.unionByName(blanks).hint("rebalance", *[F.col(p) for p in _PLACE])
    out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*_PLACE).text(path, compression="gzip")


def write_landing(
    items: DataFrame, raw: DataFrame, lists: DataFrame, root: str, attachments: DataFrame | None = None
) -> None:
    """Write each item to the decoded and to the raw output, replacing what was there.

    ``items`` is the contract shape; ``raw`` has doc_id, web_url, list_guid and the raw map
    without prefixes (``build_items(keep_raw=True)``). ``lists`` names every list of the
    run: one without rows gets a blank line, which readers skip, so that its old rows go
    and the output is present. ``attachments`` has one row per file of an item (``doc_id,
    web_url, list_guid`` and the file's columns) and replaces those of the same lists.
    """
    require_utc(items.sparkSession)
    keep_nulls = {"ignoreNullFields": "false"}
    occupied = raw.select("web_url", "list_guid").distinct()
    empty = lists.select("web_url", F.col("guid").alias("list_guid")).join(occupied, ["web_url", "list_guid"], "left_anti")
    # One row per list at most; both outputs use it.
    blanks = materialise(add_slugs(empty, lists).select(F.lit("").alias("value"), *_PLACE))
    body = F.to_json(F.struct(*items.columns), keep_nulls)
    _write_lines(add_slugs(items, lists).select(body.alias("value"), *_PLACE), blanks, f"{root}/items")
    raw_body = F.to_json(F.struct("doc_id", "raw"), keep_nulls)
    _write_lines(add_slugs(raw, lists).select(raw_body.alias("value"), *_PLACE), blanks, f"{root}/items_raw")
    if attachments is not None:
        rows = add_slugs(attachments.select("doc_id", "web_url", "list_guid", *_FILE), lists)
        body = F.to_json(F.struct("doc_id", *_FILE), keep_nulls)
        _write_lines(rows.select(body.alias("value"), *_PLACE), blanks, f"{root}/attachments")


def write_list_schemas(lists: DataFrame, list_fields: DataFrame, root: str) -> None:
    """One JSON document per list with its fields in order."""
    columns = [c for c in list_fields.columns if c not in ("list_guid", "raw_attributes")]
    grouped = list_fields.groupBy(F.col("list_guid").alias("guid")).agg(
        F.array_sort(F.collect_list(F.struct("pos", F.struct(*[c for c in columns if c != "pos"]).alias("f")))).alias("_f")
    )
    info = F.struct(*[c for c in lists.columns if c != "raw_attributes"])
    docs = lists.join(grouped, "guid", "left").select(info.alias("list_info"), F.col("_f.f").alias("fields"))
    docs.write.mode("overwrite").json(f"{root}/lists")


def write_webs(webs: DataFrame, root: str) -> None:
    webs.write.mode("overwrite").json(f"{root}/webs")


def write_graph(nodes: DataFrame, edges: DataFrame, root: str) -> None:
    nodes.write.mode("overwrite").json(f"{root}/graph/nodes")
    edges.write.mode("overwrite").json(f"{root}/graph/edges")


def write_run_report(
    spark: SparkSession, root: str, command: str, counts: DataFrame, errors: DataFrame, warnings: Sequence[str] = ()
) -> str:
    """Append a run: one manifest line, its counters and its errors, tied by ``run_id``.

    Errors stay a table of their own, so a run with very many of them needs no giant row.
    """
    run_id = uuid.uuid4().hex
    now = F.lit(datetime.now(UTC))
    key = F.lit(run_id).alias("run_id")
    row = spark.range(1).select(
        key,
        F.lit(command).alias("command"),
        now.alias("finished_at"),
        F.array(*[F.lit(w) for w in warnings]).cast("array<string>").alias("warnings"),
    )
    counts.select(key, "counter", "n").write.mode("append").json(f"{root}/run_counts")
    errors.select(key, *errors.columns).write.mode("append").json(f"{root}/run_errors")
    # The manifest line comes last: a run without one has not finished.
    row.coalesce(1).write.mode("append").json(f"{root}/runs")
    return run_id


_POINTER = "path string, batch_id bigint, version bigint"


def _versions(spark: SparkSession, table: str) -> DataFrame | None:
    return load_if_there(spark.read.schema(_POINTER), f"{table}/_versions", "parquet")


def current_version(spark: SparkSession, table: str) -> dict | None:
    """The newest published version, or ``None``."""
    log = _versions(spark, table)
    if log is None:
        return None
    row = log.orderBy(F.desc("version")).first()
    return row.asDict() if row else None


def published_version(spark: SparkSession, table: str) -> int | None:
    """The number of the newest published version by the names of the pointers alone; no job runs."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{table}/_versions/version=*/part-*")
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = [int(f.getPath().getParent().getName().partition("=")[2]) for f in fs.globStatus(folder) or []]
    return max(found, default=None)


def publish_snapshot(df: DataFrame, table: str, batch_id: int | None = None) -> int:
    """Write a full new version, then add its pointer; readers see either version whole.

    Data has a path of its own, so two writers never touch each other's files; the pointer of a version is
    written once, and the later of two writers fails.
    """
    spark = df.sparkSession
    last = current_version(spark, table)
    version = (last["version"] if last else 0) + 1
    path = f"{table}/data/{version}-{uuid.uuid4().hex}"
    df.write.mode("errorifexists").parquet(path)
    pointer = spark.range(1).select(F.lit(path).alias("path"), F.lit(batch_id).cast("bigint").alias("batch_id"))
    pointer.coalesce(1).write.mode("errorifexists").parquet(f"{table}/_versions/version={version}")
    return version


def read_snapshot(spark: SparkSession, table: str) -> DataFrame:
    last = current_version(spark, table)
    if last is None:
        raise ValueError(f"nothing published below {table}")
    return spark.read.parquet(last["path"])


def prune_versions(spark: SparkSession, table: str, keep: int = 2) -> None:
    """Delete all but the newest ``keep`` versions, pointers first; readers of the newest one are never disturbed."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path
    fs = path(table).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    pointers = {int(f.getPath().getName().partition("=")[2]): f.getPath() for f in fs.globStatus(path(f"{table}/_versions/version=*")) or []}
    old = sorted(pointers)[:-keep]
    for version in old:
        fs.delete(pointers[version], True)
    for data in fs.globStatus(path(f"{table}/data/*")) or []:
        if int(data.getPath().getName().partition("-")[0]) in old:
            fs.delete(data.getPath(), True)
