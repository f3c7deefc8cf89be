"""File targets, names, policy, hashes and payload checks."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fixed, names, wire
from ..scale import broadcast_if_small
from ..stores import open_store


def plan_files(raw_items: DataFrame, lists: DataFrame) -> DataFrame:
    """One row per file to fetch, or a ``needs_listing`` row where only the flag says so.

    Library rows carry their own url; other rows carry attachment urls, as do rows of a
    list that nobody described. Narrow but for the join with ``lists``.
    """
    base = lists.select(F.col("guid").alias("list_guid"), (F.col("base_type") == "1").alias("is_library"))
    rows = raw_items.join(broadcast_if_small(base), "list_guid", "left")
    rows = rows.withColumn("is_library", F.coalesce("is_library", F.lit(False)))

    def attr(name: str) -> Column:
        return F.try_element_at("raw", F.lit(fixed.WIRE_PREFIX + name))

    folder = F.coalesce(wire.folder_flag(attr("FSObjType")) == 1, F.lit(False))
    own_url = attr("EncodedAbsUrl")
    leaf = F.coalesce(attr("FileLeafRef"), F.lit(""))
    own_name = F.when(leaf != "", names.safe_file_name(F.substring_index(leaf, fixed.DELIM, -1)))
    urls = wire.attachment_urls(attr("AttachmentUrls"))
    flagged = F.coalesce(wire.attachment_flag(attr("Attachments")), F.lit(False))
    target_type = "array<struct<url:string,file_name:string,needs_listing:boolean>>"
    none = F.array().cast(target_type)
    listed = F.transform(
        urls, lambda u: F.struct(u.alias("url"), names.file_name_from_url(u).alias("file_name"), F.lit(False).alias("needs_listing"))
    ).cast(target_type)
    own = F.array(
        F.struct(
            own_url.alias("url"),
            F.coalesce(own_name, names.file_name_from_url(own_url)).alias("file_name"),
            F.lit(False).alias("needs_listing"),
        )
    ).cast(target_type)
    unlisted = F.array(
        F.struct(
            F.lit(None).cast("string").alias("url"), F.lit(None).cast("string").alias("file_name"), F.lit(True).alias("needs_listing")
        )
    ).cast(target_type)
    has_own = F.coalesce(own_url, F.lit("")) != ""
    targets = (
        F.when(F.col("is_library"), F.when(~folder & has_own, own).otherwise(none))
        .when(F.size(urls) > 0, listed)
        .when(flagged, unlisted)
        .otherwise(none)
    )
    return rows.select("list_guid", "item_id", F.posexplode(targets).alias("pos", "_t")).select(
        "list_guid", "item_id", "pos", "_t.*"
    )


def skip_policy(
    files: DataFrame, name: str, size: str, max_bytes: int, excluded: Sequence[str] = (), downloads: bool = True
) -> DataFrame:
    """Add ``skip_reason``: downloads off, extension excluded, or too large."""
    if not downloads:
        return files.withColumn("skip_reason", F.lit("downloads_disabled"))
    ext = names.policy_extension(F.col(name))
    over = F.concat(F.lit("too_large:"), F.col(size).cast("string"), F.lit(f">{max_bytes}"))
    reason = F.when(ext.isin(list(excluded)) & (ext != ""), F.concat(F.lit("extension_excluded:"), ext))
    return files.withColumn("skip_reason", reason.when(F.col(size) > max_bytes, over))


def hash_inventory(binary: DataFrame) -> DataFrame:
    """Bytes and SHA-256 of each file."""
    return binary.select(
        "path", F.length("content").cast("bigint").alias("bytes"), F.sha2("content", 256).alias("sha256")
    )


# Files up to this size are read whole by Spark, larger ones are streamed in parts.
WHOLE_BYTES = 64 * 1024 * 1024
PART_BYTES = 8 * 1024 * 1024


def stream_digest(path: str, part_bytes: int = PART_BYTES) -> tuple[int, str]:
    """Bytes and SHA-256 of a file of any size, one part in memory at a time."""
    store, place = open_store(path)
    sha, size = hashlib.sha256(), 0
    with store.open_input_stream(place) as stream:
        while part := stream.read(part_bytes):
            sha.update(part)
            size += len(part)
    return size, sha.hexdigest()


def hash_files(spark: SparkSession, path: str, pattern: str | None = None, whole_bytes: int = WHOLE_BYTES) -> DataFrame:
    """``path, bytes, sha256`` of all files below ``path``, of those too that do not fit a row.

    Spark lists the files without reading them. Those up to ``whole_bytes`` go through ``hash_inventory``; larger ones are dealt
    out one by one and streamed in parts by the task that has them. A folder without files gives no rows.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if pattern is not None:
        reader = reader.option("pathGlobFilter", pattern)
    found = reader.load(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column(0).to_pylist():
                size, digest = stream_digest(name)
                yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([size], pa.int64()), pa.array([digest])], names=["path", "bytes", "sha256"])

    # Dealt by a hash of the path, so that a task does not get all large files of a folder.
    large = found.filter(F.col("length") > whole_bytes).select("path").repartition("path")
    return hash_inventory(found.filter(F.col("length") <= whole_bytes)).unionByName(large.mapInArrow(run, "path string, bytes bigint, sha256 string"))


def duplicates_by_content(hashed: DataFrame) -> DataFrame:
    """Contents stored more than once: how often, and the first path. Groups are never collected."""
    return (
        hashed.groupBy("sha256", "bytes")
        .agg(F.count(F.lit(1)).alias("copies"), F.min("path").alias("first_path"))
        .filter(F.col("copies") > 1)
    )


def verify_payloads(files: DataFrame) -> DataFrame:
    """Add ``is_file``: false for empty bodies, feed envelopes and pages that pose as a file.

    Reads ``name``, ``content_type`` and ``content`` (text or binary).
    """
    body = F.col("content").cast("string")
    start = F.lower(F.ltrim(body, F.lit(" \t\n\r\x0b\x0c")))
    kind = F.lower(F.coalesce(F.col("content_type"), F.lit("")))
    suffix = names.file_suffix(F.col("name"))
    empty = F.coalesce(F.length("content") == 0, F.lit(True))
    envelope = kind.contains("json") & (start.startswith("{") | start.startswith("["))
    page = kind.contains("html") | start.startswith("<!doctype html") | start.startswith("<html")
    verdict = F.when(empty, False).when(envelope, suffix == ".json").when(page, suffix.isin(".html", ".htm"))
    return files.withColumn("is_file", verdict.otherwise(F.lit(True)))
