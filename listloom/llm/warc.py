"""Operator 6: WARC archives without repeated payloads, by revisit records."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..scale import broadcast_if_small
from ..session import scratch_path
from .common import stored

# Uncompressed bytes of an archive file on average.
FILE_BYTES = 32 << 20
# Payloads of fewer bytes are never replaced by a revisit record.
LEAST_BYTES = 1000

# Fixed values of the format.
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = "\r\n"
RECORD_END = "\r\n\r\n"

RECORD_SCHEMA = (
    "record_id string, page_id bigint, url string, record_type string, payload_bytes bigint, "
    "payload_digest string, refers_to_record string, payload string"
)


def _urn(name: Column) -> Column:
    """A record id that depends on ``name`` only."""
    return F.concat(F.lit("urn:uuid:"), F.regexp_replace(F.md5(name), "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5"))


def _header(name: str, value: Column) -> Column:
    """One header line; none for a null. Line breaks inside a value are escaped."""
    clean = F.replace(F.replace(value, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    return F.coalesce(F.concat(F.lit(f"{name}: "), clean, F.lit(END)), F.lit(""))


def page_records(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """``page_id, url, payload, payload_bytes, payload_digest, record_id`` of each page; null html counts as empty."""
    payload = F.coalesce(F.col(f"`{html}`"), F.lit(""))
    page = F.col(f"`{key}`").cast("bigint")
    return pages.select(
        page.alias("page_id"),
        F.col(f"`{url}`").alias("url"),
        payload.alias("payload"),
        F.octet_length(payload).cast("bigint").alias("payload_bytes"),
        F.sha1(payload.cast("binary")).alias("payload_digest"),
    ).withColumn("record_id", _urn(F.concat_ws("|", F.lit("page"), "page_id", "payload_digest")))


def mark_revisits(records: DataFrame, least: int = LEAST_BYTES) -> DataFrame:
    """Adds ``original``: for a revisit record the id and url of the response it refers to, else null.

    Headers only are grouped by payload digest, combined before the shuffle; digests of one page leave. The
    response is the page with the largest id. Pages that repeat this id and payload are all
    responses; a null id gives way to any other.
    """
    large = records.where(F.col("payload_bytes") >= least)
    newest = F.max(F.struct("page_id", "record_id", "url")).alias("newest")
    groups = large.groupBy("payload_digest").agg(F.count(F.lit(1)).alias("_n"), newest).where("_n > 1").drop("_n")
    shared = broadcast_if_small(stored(groups, "warc-originals"))
    joined = records.join(shared, "payload_digest", "left")
    other = F.col("newest").isNotNull() & (F.col("payload_bytes") >= least) & ~F.col("page_id").eqNullSafe(F.col("newest.page_id"))
    return joined.select(*records.columns, F.when(other, F.col("newest")).alias("original"))


def record_text(date: str) -> Column:
    """A whole record but for its end, with fresh headers, for rows of ``mark_revisits``."""
    revisit = F.col("original").isNotNull()
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{END}Content-Type: text/html; charset=UTF-8{END}Content-Length: "),
        F.col("payload_bytes").cast("string"),
        F.lit(RECORD_END),
    )
    block = F.concat(http, F.when(revisit, F.lit("")).otherwise(F.col("payload")))

    def of_revisit(value: Column) -> Column:
        return F.when(revisit, value)

    return F.concat(
        F.lit(VERSION + END),
        _header("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        _header("WARC-Record-ID", F.concat(F.lit("<"), F.col("record_id"), F.lit(">"))),
        _header("WARC-Date", F.lit(date)),
        _header("WARC-Target-URI", F.col("url")),
        _header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        _header("WARC-Profile", of_revisit(F.lit(REVISIT_PROFILE))),
        _header("WARC-Refers-To", of_revisit(F.concat(F.lit("<"), F.col("original.record_id"), F.lit(">")))),
        _header("WARC-Refers-To-Target-URI", of_revisit(F.col("original.url"))),
        _header("WARC-Refers-To-Date", of_revisit(F.lit(date))),
        _header("X-Page-Id", F.col("page_id").cast("string")),
        _header("Content-Type", F.lit("application/http;msgtype=response")),
        _header("Content-Length", F.octet_length(block).cast("string")),
        F.lit(END),
        block,
    )


def write_archives(pages: DataFrame, path: str, date: str, least: int = LEAST_BYTES, file_bytes: int = FILE_BYTES) -> None:
    """Write one record per page below ``path``: gzip files of about ``file_bytes`` before compression.

    Spark's text writer ends each record by two line breaks, as the format asks, and commits files by task,
    so a lost executor leaves no half or double file.
    """
    marked = mark_revisits(page_records(pages), least)
    total = pages.agg(F.sum(F.octet_length("html"))).first()[0] or 0
    files = 1 + int(total) // file_bytes
    deal = F.pmod(F.xxhash64("record_id", "url"), F.lit(files))
    texts = marked.select(record_text(date).alias("value"), deal.alias("_file"))
    # The number of the file is that of the partition: a hash of it would put several files into one task and none into others.
    dealt = texts.repartitionById(files, F.col("_file").cast("int")).select("value")
    dealt.write.option("lineSep", RECORD_END).option("compression", "gzip").text(path)


def _unzip(data: bytes) -> bytes:
    """All members of a gzip file; other data as it is."""
    if data[:2] != b"\x1f\x8b":
        return data
    out = []
    while data[:2] == b"\x1f\x8b":
        unzip = zlib.decompressobj(31)
        out.append(unzip.decompress(data) + unzip.flush())
        data = unzip.unused_data
    return b"".join(out)


def parse_archive(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (names in lower case) and block of every record; lengths come from the headers only."""
    at = 0
    while at < len(data):
        start = data.find(b"WARC/", at)
        if start < 0:
            return
        stop = data.index(b"\r\n\r\n", start)
        lines = data[start:stop].decode("utf-8", "replace").split("\r\n")[1:]
        headers = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}
        size = int(headers["content-length"])
        yield headers, data[stop + 4 : stop + 4 + size]
        at = stop + 4 + size + 4


def _http(block: bytes) -> tuple[dict[str, str], bytes]:
    head, _, body = block.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")[1:]
    return {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}, body


def _record(headers: dict[str, str], block: bytes, with_payload: bool) -> tuple:
    kind = headers.get("warc-type")
    http, body = _http(block)
    page = headers.get("x-page-id")
    declared = headers.get("warc-payload-digest", "").partition(":")[2].lower() or None
    if kind == "revisit":
        size = int(http["content-length"]) if "content-length" in http else None
        digest, payload = declared, None
    else:
        size, digest = len(body), hashlib.sha1(body).hexdigest()
        if declared and declared != digest:
            raise ValueError(f"record {headers.get('warc-record-id')}: the payload does not have its digest")
        payload = body.decode("utf-8", "replace") if with_payload else None
    strip = lambda v: v.strip("<>") if v else None
    return (
        strip(headers.get("warc-record-id")), int(page) if page else None, headers.get("warc-target-uri"),
        kind, size, digest, strip(headers.get("warc-refers-to")), payload,
    )


def read_archives(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """All response and revisit records below ``path``; a response whose payload breaks its digest ends the read.

    A file is one row of Spark's binary reader, so files stay below the 2 GB of a row; ``write_archives`` keeps them small.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = [c.split()[0] for c in RECORD_SCHEMA.split(", ")]
        for batch in batches:
            for content in batch["content"]:
                rows = [
                    _record(h, b, with_payload)
                    for h, b in parse_archive(_unzip(content))
                    if h.get("warc-type") in ("response", "revisit")
                ]
                out = pd.DataFrame(rows, columns=columns)
                yield out.astype({"page_id": "Int64", "payload_bytes": "Int64"})

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    return files.mapInPandas(run, RECORD_SCHEMA)


def resolve_revisits(records: DataFrame) -> DataFrame:
    """Adds ``refers_to``, the page id of the response a revisit record names; null for all others and where it is missing.

    Headers are shuffled by payload digest; a digest of many revisits is split at run time. Repeated
    responses count once.
    """
    responses = records.where("record_type = 'response'").groupBy("payload_digest", F.col("record_id").alias("refers_to_record"))
    originals = responses.agg(F.max("page_id").alias("refers_to"))
    return records.drop("payload").join(originals, ["payload_digest", "refers_to_record"], "left")


def archive_pages(pages: DataFrame, date: str = "2024-01-01T00:00:00Z", least: int = LEAST_BYTES) -> DataFrame:
    """Write all pages to archives in the shared folder, read them back, and say what each record holds.

    ``page_id, payload_bytes, payload_digest, record_type, refers_to``, from the archives alone. Null html is an empty payload,
    a null url has no header, null ids stay null. Repeated pages come back as often as they were given.
    An empty table gives no rows. Other columns are not read.
    """
    path = scratch_path(pages.sparkSession, "warc")
    write_archives(pages, path, date, least)
    resolved = resolve_revisits(read_archives(pages.sparkSession, path, with_payload=False))
    return resolved.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
