"""Readers for what the sinks wrote: item lines, schemas, run tables, files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..scale import broadcast_if_small
from ..session import load_if_there, scratch_path

ITEM_SCHEMA = (
    "doc_id string, web_url string, web_id string, list_guid string, list_title string, item_id bigint, "
    "display_url string, content_type string, created string, modified string, is_folder boolean, file_ref string, "
    "file_name string, fields variant, field_display_names map<string,string>"
)
LIST_SCHEMA = (
    "list_info struct<guid:string,title:string,description:string,base_type:string,server_template:string,"
    "item_count:bigint,hidden:boolean,root_folder:string,default_view_url:string,enable_attachments:boolean,"
    "has_unique_scopes:boolean,created:string,modified:string,web_url:string>, "
    "fields array<struct<name:string,display_name:string,type:string,required:boolean,hidden:boolean,read_only:boolean,"
    "lookup_list:string,show_field:string,mult:boolean,format:string,result_type:string,max_length:int,"
    "choices:array<string>,formula:string>>"
)
_CORRUPT = "_corrupt_record"
# Slugs are texts, also where they look like numbers.
_LINES = "value string, web_slug string, list_slug string"
ATTACHMENT = "filename:string,url:string,local_path:string,bytes:bigint,sha256:string,downloaded:boolean,skip_reason:string"


def _item_lines(spark: SparkSession, root: str) -> DataFrame:
    schema = f"{ITEM_SCHEMA}, {_CORRUPT} string, web_slug string, list_slug string"
    return spark.read.schema(schema).option("columnNameOfCorruptRecord", _CORRUPT).json(f"{root}/items")


def read_items(spark: SparkSession, root: str) -> DataFrame:
    """Decoded item lines of a landing; blank and malformed lines are left out."""
    lines = _item_lines(spark, root)
    return lines.filter(F.col(_CORRUPT).isNull() & F.col("item_id").isNotNull()).drop(_CORRUPT)


def read_attachments(spark: SparkSession, root: str) -> DataFrame:
    """Attachments of a landing, one row each with the ``doc_id`` of their item; a landing without any gives no rows."""
    schema = f"doc_id string, {ATTACHMENT.replace(':', ' ').replace(',', ', ')}, web_slug string, list_slug string"
    return _good_lines(spark, f"{root}/attachments", schema, "doc_id")


def skipped_lines(spark: SparkSession, root: str) -> DataFrame:
    """Malformed item lines, to be counted per list."""
    lines = spark.read.schema(_LINES).text(f"{root}/items")
    parsed = F.try_variant_get(F.try_parse_json("value"), "$.item_id", "bigint")
    return lines.filter((F.trim("value") != "") & parsed.isNull()).select("web_slug", "list_slug", "value")


def read_raw_items(spark: SparkSession, root: str) -> DataFrame:
    """Raw rows of a landing; the id is accepted under any of its spellings."""
    lines = spark.read.schema(_LINES).text(f"{root}/items_raw")
    row = F.from_json("value", "doc_id string, raw map<string,string>")
    return lines.filter(F.trim("value") != "").select(row.alias("_r"), "web_slug", "list_slug").select("_r.*", "web_slug", "list_slug").filter(
        F.col("doc_id").isNotNull()
    )


def read_stored_schemas(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    """``lists`` and ``list_fields`` from stored documents; unreadable ones are skipped."""
    docs = spark.read.schema(f"{LIST_SCHEMA}, {_CORRUPT} string").option("columnNameOfCorruptRecord", _CORRUPT).json(f"{root}/lists")
    return _schemas(docs)


def _schemas(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    good = docs.filter(F.col(_CORRUPT).isNull() & F.col("list_info.guid").isNotNull())
    fields = good.select(F.col("list_info.guid").alias("list_guid"), F.posexplode("fields").alias("pos", "f"))
    return good.select("list_info.*"), fields.select("list_guid", "pos", "f.*")


_ERRORS = (
    "when string, scope string, web_url string, list_guid string, list_title string, operation string, "
    "error_type string, message string"
)


def _good_lines(spark: SparkSession, path: str, schema: str, required: str) -> DataFrame:
    """JSON lines without the damaged ones; a folder nobody wrote gives no rows."""
    reader = spark.read.schema(f"{schema}, {_CORRUPT} string").option("columnNameOfCorruptRecord", _CORRUPT)
    docs = load_if_there(reader, path, "json")
    if docs is None:
        return spark.createDataFrame([], schema)
    return docs.filter(F.col(_CORRUPT).isNull() & F.col(required).isNotNull()).drop(_CORRUPT)


def read_run_tables(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """Runs, counters, errors and warnings of all finished runs."""
    runs = _good_lines(spark, f"{root}/runs", "run_id string, command string, finished_at timestamp, warnings array<string>", "run_id")
    finished = broadcast_if_small(runs.select("run_id"))
    counts = _good_lines(spark, f"{root}/run_counts", "run_id string, counter string, n bigint", "run_id")
    errors = _good_lines(spark, f"{root}/run_errors", f"run_id string, {_ERRORS}", "run_id")
    return {
        "runs": runs.drop("warnings"),
        "counts": counts.join(finished, "run_id", "left_semi"),
        "errors": errors.join(finished, "run_id", "left_semi"),
        "warnings": runs.select("run_id", F.explode("warnings").alias("warning")),
    }


def read_manifests(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """Captured manifest documents as the same tables; a damaged document gives no rows."""
    schema = (
        "command string, started_at timestamp, finished_at timestamp, counts map<string,bigint>, warnings array<string>, "
        f"errors array<struct<{_ERRORS.replace(' string', ':string')}>>, {_CORRUPT} string"
    )
    docs = spark.read.schema(schema).option("multiLine", "true").option("columnNameOfCorruptRecord", _CORRUPT).json(path)
    good = docs.filter(F.col(_CORRUPT).isNull() & F.col("command").isNotNull())
    return {
        "runs": good.select("command", "started_at", "finished_at"),
        "counts": good.select("command", "started_at", F.explode("counts").alias("counter", "n")),
        "errors": good.select("command", "started_at", F.inline("errors")),
        "warnings": good.select("command", "started_at", F.explode("warnings").alias("warning")),
    }


def read_states(spark: SparkSession, path: str) -> DataFrame:
    """Captured state documents as one row per list; a damaged document gives no rows."""
    entry = (
        "struct<web_url:string,list_title:string,last_full_crawl:timestamp,last_sync:timestamp,last_item_id:bigint,"
        "items_written:bigint,change_token:string,status:string,error:string>"
    )
    schema = f"lists map<string,{entry}>, {_CORRUPT} string"
    docs = spark.read.schema(schema).option("multiLine", "true").option("columnNameOfCorruptRecord", _CORRUPT).json(path)
    good = docs.filter(F.col(_CORRUPT).isNull() & F.col("lists").isNotNull())
    return good.select(F.explode("lists").alias("list_guid", "s")).select("list_guid", "s.*")


# The layout that other tools write: webs/{web}/lists/{list}/ with list.json, items.jsonl and items_raw.jsonl.
CONTRACT_LISTS = "webs/*/lists/*"


def _contract_place() -> list[Column]:
    """Web and list folder of a file in the contract's layout."""
    path = F.col("_metadata.file_path")
    return [F.regexp_extract(path, "/webs/([^/]+)/lists/([^/]+)/", i).alias(name) for i, name in ((1, "web_slug"), (2, "list_slug"))]


def read_contract_items(spark: SparkSession, root: str) -> DataFrame:
    """Items of a landing in the contract's layout, ``attachments`` included; damaged and blank lines are left out."""
    schema = f"{ITEM_SCHEMA}, attachments array<struct<{ATTACHMENT}>>, {_CORRUPT} string"
    reader = spark.read.schema(schema).option("columnNameOfCorruptRecord", _CORRUPT)
    lines = reader.json(f"{root}/{CONTRACT_LISTS}/items.jsonl").select("*", *_contract_place())
    return lines.filter(F.col(_CORRUPT).isNull() & F.col("item_id").isNotNull()).drop(_CORRUPT)


def contract_attachments(items: DataFrame) -> DataFrame:
    """Attachments of contract items as rows of their own, in the shape of ``read_attachments``."""
    return items.select("doc_id", "web_slug", "list_slug", F.inline("attachments"))


def read_contract_raw_items(spark: SparkSession, root: str) -> DataFrame:
    """Raw rows of a landing in the contract's layout; each line is one object of attributes."""
    lines = spark.read.text(f"{root}/{CONTRACT_LISTS}/items_raw.jsonl").select("value", *_contract_place())
    row = F.from_json("value", "map<string,string>")
    return lines.filter(F.trim("value") != "").select(row.alias("raw"), "web_slug", "list_slug").filter(F.col("raw").isNotNull())


def read_contract_schemas(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    """``lists`` and ``list_fields`` from the ``list.json`` documents; an unreadable one is skipped."""
    reader = spark.read.schema(f"{LIST_SCHEMA}, {_CORRUPT} string").option("columnNameOfCorruptRecord", _CORRUPT)
    return _schemas(reader.option("multiLine", "true").json(f"{root}/{CONTRACT_LISTS}/list.json"))


def read_contract_webs(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    """Webs with their number of lists, and the lists by web, from ``webs.json``."""
    info = LIST_SCHEMA[LIST_SCHEMA.index("struct<") : LIST_SCHEMA.index(">,") + 1]
    schema = f"count bigint, webs array<struct<web_id:string,title:string,url:string,slug:string,list_count:bigint,lists:array<{info}>>>"
    webs = spark.read.schema(schema).option("multiLine", "true").json(f"{root}/webs.json").select(F.inline("webs"))
    return webs.drop("lists"), webs.select("web_id", F.inline("lists"))


def _visible(spark: SparkSession, path: str) -> str:
    """A copy of a run's own document below the shared folder: Spark takes files whose names begin with ``_`` for hidden."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    copy = scratch_path(spark, "document")
    there, here = jvm.org.apache.hadoop.fs.Path(path), jvm.org.apache.hadoop.fs.Path(copy)
    jvm.org.apache.hadoop.fs.FileUtil.copy(there.getFileSystem(conf), there, here.getFileSystem(conf), here, False, conf)
    return copy


def read_contract_manifest(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The tables of ``read_manifests`` from ``_manifest.json``."""
    return read_manifests(spark, _visible(spark, f"{root}/_manifest.json"))


def read_contract_state(spark: SparkSession, root: str) -> DataFrame:
    """The lists of ``read_states`` from ``_state.json``."""
    return read_states(spark, _visible(spark, f"{root}/_state.json"))


def read_contract_graph(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    """Nodes and edges from ``_graph.json``."""
    node = "list_guid:string,title:string,web_url:string,item_count:bigint,base_type:string,base_type_name:string"
    edge = (
        "source_list_guid:string,source_list_title:string,source_web_url:string,target_list_guid:string,target_list_title:string,"
        "field_name:string,field_display_name:string,show_field:string,multi:boolean,self_reference:boolean,dangling:boolean"
    )
    docs = spark.read.schema(f"nodes array<struct<{node}>>, edges array<struct<{edge}>>").option("multiLine", "true").json(_visible(spark, f"{root}/_graph.json"))
    return docs.select(F.inline("nodes")), docs.select(F.inline("edges"))


def read_files(spark: SparkSession, path: str, pattern: Column | str | None = None) -> DataFrame:
    """File bytes with path and size, below ``path``."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if pattern is not None:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(path).select("path", F.col("length").alias("bytes"), "content")
